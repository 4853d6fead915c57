"""Near duplicates by MinHash over five-word shingles.

1. Each document gets its set of distinct shingles (64-bit hashes), a
   128-bit hash of the whole set, and 128 universal-hash minima.  Documents
   with equal sets form a class.  The classes are numbered in order of their
   smallest id, then set hash; the number stands for the class from here on, so
   classes that share their smallest id are nodes of their own.
2. 32 bands of 4 minima each make the bucket keys.  Every member of a bucket
   is paired with the bucket's smallest node only, so a bucket of m members
   gives m - 1 pairs.
3. Pairs whose signatures agree in fewer than ``SIFT`` of the minima are
   left out (0.75 similarity lies five standard deviations above); the rest are
   confirmed on the full shingle sets of both texts.
4. Links become components by alternating large-star and small-star.
5. Buckets whose members are still in different components may hide links
   between members that are not the smallest node.  The documents of such
   buckets go through an exact prefix filter: with the shingles
   in order of rising frequency, two linked sets share one within the first ``size -
   overlap + 1`` of each.  Shingles that no other of these documents has come first and
   meet nothing, so altered copies beyond the threshold drop out without a
   pair.  Pairs of different components that share such a shingle go through 3
   and 4 again.

With 32 bands of 4, a pair at 0.75 similarity shares no bucket with a
probability of 6e-6, and falls below ``SIFT`` with one of 1e-6; these are all that is missed.

Defined results: null texts and texts without words have an empty set and
are linked with nothing (component_id is their own id); with fewer than
five words the whole sequence is one shingle; rows that share an id are one
node if their sets are equal, and are judged each by its text if not; a null id
comes after all others, and is the component_id of a component without any other.  Of a
component stay the rows of its smallest node that have the smallest id.  Empty tables
give empty results; further columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm import words as WD
from farebox.llm.common import ROW, quoted, row, ship, write_table

SHINGLE = 5
PERCENT = 75
HASHES, BAND = 128, 4
SIFT = 72            # of 128 minima
BLOCK = 4096         # shingles hashed at a time
_PAIR = "_x long, _y long"
_RNG = np.random.Generator(np.random.PCG64(20240607))
_A = _RNG.integers(0, 2**63, (HASHES, 1), np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, (HASHES, 1), np.uint64)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a whole text."""
    h = WD.hashes(WD.split(text, lower=True))
    if not len(h):
        return h
    n = max(1, len(h) - size + 1)
    out = np.full(n, min(size, len(h)), np.uint64)
    for j in range(min(size, len(h))):
        out = WD.mix(out * WD.BASE + h[j:j + n])
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def _minima(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.minimum.reduceat((_A * x + _B) >> np.uint64(32), starts, axis=1).astype(np.uint32)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of minima per non-empty set."""
    out = np.empty((len(sets), HASHES), np.uint32)
    own, held = [], 0

    def flush():
        if own:
            starts = np.concatenate(([0], np.cumsum([len(sets[k]) for k in own])[:-1]))
            out[own] = _minima(np.concatenate([sets[k] for k in own]), starts).T

    for k, s in enumerate(sets):
        if len(s) > BLOCK:
            out[k] = np.min([_minima(s[a:a + BLOCK], np.zeros(1, np.int64))[:, 0] for a in range(0, len(s), BLOCK)], axis=0)
            continue
        if held + len(s) > BLOCK:
            flush()
            own, held = [], 0
        own.append(k)
        held += len(s)
    flush()
    return out


def _features(batches):
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            sets = [shingles(t.as_py()) for t in part.column("_text")]
            full = [k for k, s in enumerate(sets) if len(s)]
            sigs: list = [None] * len(sets)
            for k, row in zip(full, signatures([sets[k] for k in full])):
                sigs[k] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [part.column("_id"), part.column("_h"), part.column("_g"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                 pa.array(sigs, pa.binary())], ["_id", "_h", "_g", "_n", "_set", "_sig"])


def _buckets(batches):
    for batch in batches:
        for a in range(0, batch.num_rows, 1024):
            part = batch.slice(a, 1024)
            ids = np.asarray(part.column("_id"))
            sig = np.frombuffer(b"".join(part.column("_sig").to_pylist()), np.uint32).reshape(-1, HASHES)
            keys = np.empty((len(ids), HASHES // BAND), np.uint64)
            for b in range(HASHES // BAND):
                h = np.full(len(ids), b + 1, np.uint64)
                for j in range(BAND):
                    h = WD.mix(h * WD.BASE + sig[:, b * BAND + j])
                keys[:, b] = h
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(ids, keys.shape[1]))], ["_key", "_id"])


def _sift(batches):
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in ("_sx", "_sy"))
        good = pa.array((x == y).sum(axis=1) >= SIFT)
        yield pa.RecordBatch.from_arrays([batch.column("_x").filter(good), batch.column("_y").filter(good)], ["_x", "_y"])


def _confirm(batches):
    for batch in batches:
        xs, ys, known = [], [], {}
        for x, y, tx, ty in zip(batch.column("_x").to_pylist(), batch.column("_y").to_pylist(),
                                batch.column("_tx"), batch.column("_ty")):
            if y not in known:  # one of a bucket's pairs share their smallest node
                known = {y: shingles(ty.as_py())}
            a, b = shingles(tx.as_py()), known[y]
            common = len(np.intersect1d(a, b, assume_unique=True))
            if common and 100 * common >= PERCENT * (len(a) + len(b) - common):
                xs.append(x), ys.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(ys, pa.int64())], ["_x", "_y"])


def likely(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (_x, _y) whose signatures agree enough."""
    sig = reps.select("_id", "_sig")
    return write_table(
        pairs.join(sig.withColumnsRenamed({"_id": "_x", "_sig": "_sx"}), "_x")
        .join(sig.withColumnsRenamed({"_id": "_y", "_sig": "_sy"}), "_y")
        .mapInArrow(_sift, _PAIR), "minhash-likely")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (_x, _y) that are links, checked on full sets."""
    return write_table(
        pairs.join(texts.withColumnsRenamed({"_id": "_x", "_text": "_tx"}), "_x")
        .join(texts.withColumnsRenamed({"_id": "_y", "_text": "_ty"}), "_y")
        .mapInArrow(_confirm, _PAIR), "minhash-links")


def _tokens(batches):
    for batch in batches:
        for a in range(0, batch.num_rows, 64):
            part = batch.slice(a, 64)
            sets = [shingles(t.as_py()) for t in part.column("_text")]
            size = np.array([len(x) for x in sets])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.asarray(part.column("_id")), size)), pa.array(np.repeat(size, size).astype(np.int32)),
                 pa.array(np.concatenate(sets).view(np.int64))], ["_id", "_n", "_h"])


def _prefix_pairs(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of members (_id, _c) of different components that can be links."""
    tokens = write_table(texts.join(members, "_id", "left_semi").mapInArrow(
        _tokens, "_id long, _n int, _h long"), "minhash-tokens")
    often = write_table(tokens.groupBy("_h").agg(F.count("*").alias("_f")).where("_f > 1"), "minhash-often")
    # place of a shingle in its document's order: those that it has alone come first
    known = tokens.join(often, "_h").groupBy("_id", "_n").agg(F.array_sort(F.collect_list(F.struct("_f", "_h"))).alias("_t"))
    prefix = known.select(
        "_id", "_n", (F.col("_n") - F.size("_t")).alias("_alone"),
        F.posexplode(F.slice("_t", F.lit(1), F.greatest(
            F.lit(0), F.floor(F.col("_n") * (100 - PERCENT) / 100).cast("int") + 1 - (F.col("_n") - F.size("_t"))))).alias("_p", "_e"))
    prefix = prefix.select("_id", "_n", "_e._h", (F.col("_alone") + F.col("_p")).alias("_p")).join(members, "_id")
    mixed = prefix.groupBy("_h").agg(F.min("_c").alias("_lo"), F.max("_c").alias("_hi")).where("_lo <> _hi").select("_h")
    prefix = write_table(prefix.join(mixed, "_h", "left_semi"), "minhash-prefix")
    x = prefix.select("_h", F.col("_id").alias("_x"), F.col("_n").alias("_nx"), F.col("_p").alias("_px"), F.col("_c").alias("_cx"))
    y = prefix.select("_h", F.col("_id").alias("_y"), F.col("_n").alias("_ny"), F.col("_p").alias("_py"), F.col("_c").alias("_cy"))
    overlap = F.expr(f"cast(ceil({PERCENT} * (_nx + _ny) / {100 + PERCENT}) as int)")
    return x.join(y, "_h").where(
        (F.col("_cx") != F.col("_cy")) & (F.col("_x") > F.col("_y"))
        & (F.col("_px") <= F.col("_nx") - overlap) & (F.col("_py") <= F.col("_ny") - overlap)
    ).select("_x", "_y").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("_x", "_y").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(_x, _y) links -> one row (_x, _y) per linked node that is not the
    smallest of its component, _y being the smallest."""
    edges = write_table(links.select(F.greatest("_x", "_y").alias("_x"), F.least("_x", "_y").alias("_y"))
                        .where("_x <> _y").distinct(), "minhash-edges")
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select("_y", "_x"))
        # a table of its own, so that Spark can split the partition of a component's centre in the join
        least = write_table(both.groupBy("_x").agg(F.least(F.min("_y"), F.col("_x")).alias("_m")), "minhash-least")
        large = both.join(least, "_x").where("_y > _x").select(F.col("_y").alias("_x"), F.col("_m").alias("_y")).distinct()
        large = write_table(large, "minhash-large")
        least = write_table(large.groupBy("_x").agg(F.min("_y").alias("_m")), "minhash-least")
        small = large.join(least, "_x").select(
            F.explode(F.array(F.struct("_x", F.col("_m").alias("_y")),
                              F.struct(F.col("_y").alias("_x"), F.col("_m").alias("_y")))).alias("e")
        ).select("e.*").where("_x <> _y").distinct()
        edges = write_table(small, "minhash-edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges


def _text_keys(text_col: str) -> list:
    """Two hashes that tell the texts of rows with one id apart."""
    text = F.col(f"`{text_col}`")
    return [F.xxhash64(text), F.xxhash64(F.lit(7), text)]


def _judged(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: _id, _h and _g (keys of its text), _n, _c (component_id), _kept."""
    ship(df.sparkSession)
    h, g = _text_keys(text_col)
    texts = df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), h.alias("_h"), g.alias("_g"), F.col(f"`{text_col}`").alias("_text"))
    rows = write_table(texts.mapInArrow(
        _features, "_id long, _h long, _g long, _n long, _set binary, _sig binary"), "minhash-rows")
    found = write_table(rows.where("_set is not null").groupBy("_set").agg(F.min("_id").alias("_rep")), "minhash-classes")
    classes = write_table(found.orderBy(F.asc_nulls_last("_rep"), "_set").select(
        "_set", "_rep", F.monotonically_increasing_id().alias("_node")), "minhash-nodes")
    # one row stands for a node; _m of them at most repeat its id and text
    reps = write_table(
        rows.join(classes, "_set").where("_id <=> _rep").groupBy(F.col("_node").alias("_id"), "_rep").agg(
            F.min(F.struct("_h", "_g", "_sig")).alias("_one"), F.count("*").alias("_m"))
        .select("_id", "_rep", "_one.*", "_m"), "minhash-reps")
    slim = reps.select("_id", "_sig").mapInArrow(_buckets, "_key long, _id long")
    # classes and shared are tables of their own, so that Spark can split the partition of a hot
    # class or bucket in a join
    shared = write_table(slim.groupBy("_key").agg(F.count("*").alias("_n"), F.min("_id").alias("_first")).where(
        "_n > 1").select("_key", "_first"), "minhash-shared")
    buckets = write_table(slim.join(shared, "_key"), "minhash-buckets")

    stars = likely(buckets.where("_id <> _first").select(
        F.col("_id").alias("_x"), F.col("_first").alias("_y")).distinct(), reps)
    # whoever shares a bucket may be hidden by its star
    wanted = reps.join(buckets.select("_id").distinct(), "_id").select(F.col("_id").alias("_node"), "_rep", F.col("_h").alias("_rh"), F.col("_g").alias("_rg"), "_m")
    # the only join that moves whole texts; the same plan at every size
    moved = write_table(
        texts.join(wanted.hint("merge"), F.expr("_id <=> _rep and _h = _rh and _g = _rg")).select(
            F.col("_node").alias("_id"), "_m", "_text"), "minhash-texts")
    repeated = write_table(moved.where("_m > 1").groupBy("_id").agg(F.first("_text").alias("_text")), "minhash-repeated")
    own = moved.where("_m = 1").select("_id", "_text").union(repeated)
    links = confirmed(stars, own)
    component = components(links)

    member = buckets.join(component.withColumnsRenamed({"_x": "_id", "_y": "_c"}), "_id", "left").select(
        "_key", "_id", F.coalesce("_c", "_id").alias("_c"))
    mixed = member.groupBy("_key").agg(F.min("_c").alias("_lo"), F.max("_c").alias("_hi")).where("_lo <> _hi")
    unsure = write_table(member.join(mixed.select("_key"), "_key", "left_semi").groupBy("_id").agg(
        F.min("_c").alias("_c")), "minhash-unsure")
    extra = confirmed(likely(_prefix_pairs(unsure, own), reps), own)
    if not extra.isEmpty():
        component = components(component.union(extra))

    # the smallest node of a component is not among its _x
    named = component.join(classes.select(F.col("_node").alias("_y"), F.col("_rep").alias("_top")), "_y").select(
        F.col("_x").alias("_node"), "_top", F.lit(True).alias("_linked"))
    node = classes.join(named, "_node", "left").select(
        "_set", "_rep", F.when(F.col("_linked"), F.col("_top")).otherwise(F.col("_rep")).alias("_c"),
        F.col("_linked").isNull().alias("_smallest"))
    return rows.select("_id", "_h", "_g", "_n", "_set").join(node, "_set", "left").select(
        "_id", "_h", "_g", "_n", F.when(F.col("_set").isNull(), F.col("_id")).otherwise(F.col("_c")).alias("_c"),
        (F.col("_set").isNull() | (F.col("_smallest") & F.col("_id").eqNullSafe(F.col("_rep")))).alias("_kept"))


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id, kept."""
    return _judged(df, id_col, text_col).select(
        F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), F.col("_c").alias("component_id"), F.col("_kept").alias("kept"))


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay of their component, by id and text."""
    keep = _judged(df, id_col, text_col).where("_kept").select(
        F.col("_id").alias("_keep"), F.col("_h").alias("_keep_h"), F.col("_g").alias("_keep_g"))
    h, g = _text_keys(text_col)
    rows = df.select(row(df.columns), quoted(id_col).cast("long").alias("_id"), h.alias("_h"), g.alias("_g"))
    return rows.join(keep, F.expr("_id <=> _keep and _h = _keep_h and _g = _keep_g"), "left_semi").select(f"{ROW}.*")
