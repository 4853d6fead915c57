"""Repeated and nearly repeated lines, in DataFrame functions only.

Lines are compared without white space at their ends; words are what stands
between single spaces.  Of equal lines the earliest (smallest id, then line number) stays.  A line of ``min_words``
words or more is also removed if an earlier line, itself of ``min_words`` words or more, of as many
words, one fewer or one more
lies within an edit distance of one word (a word replaced, inserted or
removed); for shorter lines the bound is 0 on either side.  Lines are judged on the input, not on what is left; blank
lines stay.

The deletion neighbourhood of a line is the line and all variants of it with one word
deleted, as hashed keys.  The hash of a word sequence is the
exclusive-or of hashes of (word, place), so running totals over the words of a line
give all its variants in linear time, whatever its length.

1. Equal lines are folded to their first occurrence (partial aggregation).
2. Two lines within one word share their first or their last
   half (of the shorter one).  Lines that share neither with another line
   leave no variants; this loses none.
3. The others emit their variants.  Lines that share everything but the word
   at the same place are all within one word of each other, so
   each is joined with the earliest of them only; a line joins the variants that
   equal it whole.  Both joins make a row per variant at most.
4. The earliest neighbour of each line is verified on the words themselves.

Defined results: null texts have one blank line, as empty ones; a null id
comes after all others; rows that repeat an id and a text are one document, and
show the same result; lines end at ``\\n`` alone; an empty table gives an
empty result; further columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.common import write_table

MIN_WORDS = 5
_DOC = ["_id", "_k"]
_AT = [*_DOC, "_no"]


_SPACE = " \t\n\x0b\x0c\r"


def _folded(line: Column) -> Column:
    return F.btrim(line, F.lit(_SPACE))


def _words(line: Column) -> Column:
    """Number of words, without splitting the line."""
    return (F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1).cast("int")


def _half(line: Column, kind: str, size: Column) -> Column:
    """Key of the first or last half of a line as one of ``size`` words."""
    p = F.floor(size / 2).cast("int")
    part = F.call_function("substring_index", line, F.lit(" "), p if kind == "first" else -p)
    return F.xxhash64(F.lit(kind), size, part)


def _within_one_word(x: Column, y: Column) -> Column:
    """Whether word arrays differ by one replaced, inserted or removed word."""
    short, long = F.when(F.size(x) <= F.size(y), x).otherwise(y), F.when(F.size(x) <= F.size(y), y).otherwise(x)
    differs = lambda a, b: a != b
    first = F.array_position(F.zip_with(short, F.slice(long, F.lit(1), F.size(short)), differs), True).cast("int")
    replaced = F.size(F.filter(F.zip_with(x, y, differs), lambda d: d)) <= 1
    rest = F.size(short) + 1
    moved = (first == 0) | (F.slice(short, F.greatest(first, F.lit(1)), rest)
                            == F.slice(long, F.greatest(first, F.lit(1)) + 1, rest))
    return F.when(F.size(x) == F.size(y), replaced).when(F.size(long) - F.size(short) == 1, moved).otherwise(False)


def _variants(lines: DataFrame) -> DataFrame:
    """Per word of a line: the hash of the line without it (_v), and of the
    whole line (_full)."""
    words = lines.select(*_AT, "_n", F.posexplode(F.split("_line", " ")).alias("_i", "_w")).select(
        *_AT, "_n", "_i", F.xxhash64("_w", "_i").alias("_x"), F.xxhash64("_w", F.col("_i") - 1).alias("_y"))
    by_line = Window.partitionBy(*_AT).orderBy("_i")
    before = F.coalesce(F.bit_xor("_x").over(by_line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    through = F.bit_xor("_y").over(by_line.rowsBetween(Window.unboundedPreceding, 0))
    all_y = F.bit_xor("_y").over(Window.partitionBy(*_AT))
    all_x = F.bit_xor("_x").over(Window.partitionBy(*_AT))
    return words.select(
        *_AT, "_n", "_i", before.bitwiseXOR(through).bitwiseXOR(all_y).alias("_v"), all_x.alias("_full"))


def drop_repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        min_words: int = MIN_WORDS) -> DataFrame:
    """Per row: id, n_lines, n_equal and n_near (lines removed), kept (the
    other lines, joined by \\n)."""
    doc, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = df.select(doc.alias("_doc"), F.coalesce(doc.cast("long"), F.lit(2**63 - 1)).alias("_id"),
                     F.xxhash64(doc.cast("string"), text).alias("_k"), text.alias("_text"))
    split = rows.select("_doc", *_DOC, F.split("_text", "\n").alias("_lines"))
    lines = split.select(*_DOC, F.posexplode("_lines").alias("_no", "_raw")).select(
        *_AT, _folded(F.col("_raw")).alias("_line")).where("_line <> ''").select(*_AT, "_line", _words(F.col("_line")).alias("_n"))
    keys = F.when(F.col("_n") >= min_words, F.array(
        *(_half(F.col("_line"), kind, size) for kind in ("first", "last") for size in (F.col("_n"), F.col("_n") - 1))))
    distinct = lines.select(
        F.xxhash64("_line").alias("_h"), F.xxhash64(F.lit(7), "_line").alias("_g"),
        F.struct(*_AT, keys.alias("_keys")).alias("_one")).groupBy("_h", "_g").agg(F.min("_one").alias("_one"))
    firsts = write_table(distinct.select("_one.*"), "lines-firsts")

    keyed = firsts.where("_keys is not null").select(*_AT, F.explode(F.array_distinct("_keys")).alias("_key"))
    shared = write_table(keyed.groupBy("_key").agg(F.count("*").alias("_n")).where("_n > 1").select("_key"), "lines-shared")
    chosen = keyed.join(shared, "_key", "left_semi").select(*_AT).distinct().groupBy(*_DOC).agg(
        F.collect_list("_no").alias("_nos"))
    # a join stands between the split and its uses, so it is not evaluated for each element
    near = write_table(
        split.join(chosen, _DOC).select(*_DOC, F.explode(F.transform(
            "_nos", lambda i: F.struct(i.alias("_no"), F.get("_lines", i).alias("_raw")))).alias("_e"))
        .select(*_DOC, "_e._no", _folded(F.col("_e._raw")).alias("_line")).withColumn("_n", _words(F.col("_line")))
        .dropDuplicates(_AT), "lines-near")

    variants = write_table(_variants(near), "lines-variants")
    at = F.struct(*_AT)
    group = ["_v", "_n", "_i"]
    leads = write_table(variants.groupBy(*group).agg(
        F.min(at).alias("_early"), F.count("*").alias("_m")).where("_m > 1"), "lines-leads")
    replaced = variants.join(leads, group).select(at.alias("_late"), "_early").where("_late <> _early")
    whole = variants.where("_i = 0").select(F.col("_full").alias("_v"), (F.col("_n") + 1).alias("_n"), at.alias("_other"))
    moved = variants.select("_v", "_n", at.alias("_at")).join(whole, ["_v", "_n"]).select(
        F.greatest("_at", "_other").alias("_late"), F.least("_at", "_other").alias("_early"))
    pairs = replaced.union(moved).groupBy("_late").agg(F.min("_early").alias("_early"))
    text_of = near.select(at.alias("_at"), "_line")
    removed = pairs.join(text_of.withColumnsRenamed({"_at": "_late", "_line": "_x"}), "_late").join(
        text_of.withColumnsRenamed({"_at": "_early", "_line": "_y"}), "_early").where(
        _within_one_word(F.split("_x", " "), F.split("_y", " "))).select("_late.*")

    stays = firsts.select(*_AT).join(removed.withColumn("_near", F.lit(1)), _AT, "left")
    by_doc = write_table(stays.groupBy(*_DOC).agg(
        F.collect_list(F.when(F.col("_near").isNull(), F.col("_no"))).alias("_stay"),
        F.count("*").alias("_firsts"), F.count("_near").alias("_nears")), "lines-stay")
    both = split.join(by_doc, _DOC, "left").select(
        "_doc", "_lines", F.coalesce("_stay", F.array().cast("array<int>")).alias("_stay"),
        F.coalesce("_firsts", F.lit(0)).alias("_firsts"), F.coalesce("_nears", F.lit(0)).alias("_nears"),
        F.filter(F.transform("_lines", lambda x, i: F.when(_folded(x) == "", i)), lambda i: i.isNotNull()).alias("_blank"))
    return both.select(
        F.col("_doc").alias(id_col), F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_blank") - F.col("_firsts")).cast("long").alias("n_equal"),
        F.col("_nears").cast("long").alias("n_near"),
        F.array_join(F.transform(F.array_sort(F.concat("_stay", "_blank")), lambda i: F.get("_lines", i)), "\n").alias("kept"))
