"""Operators over documents against their brute-force versions: on the
small tables, and on odd rows (nulls, repeats, ties, very long and empty texts)."""

import collections
import hashlib
import os
import sys
import tracemalloc

import numpy as np
import public_tokenizers
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402
from llm_cases import SF, TEXTS, by_id, labels, no_docs, odd_docs  # noqa: E402, F401

from farebox.llm import bpe, decontaminate, exact, lines, minhash, queries, quality, substring  # noqa: E402

sha = brute.sha


def table(name):
    return brute.pq.read_table(f"{SF}/{name}.parquet").to_pydict()


def test_queries_against_brute_force(spark):
    docs = brute.docs("sf0.001")
    items = table("benchmark")
    want = {"op1_byte_bpe": brute.op1(docs), "op3_exact_dedup": brute.op3(docs), "op4_substring": brute.op4(docs),
            "op5_line_dedup": brute.op5(docs), "op9_decontaminate": brute.op9(docs, dict(zip(items["item_id"], items["text"]))),
            "op10_minhash": brute.op10(docs)}
    for name, rows in want.items():
        got = {r[0]: tuple(r) for r in queries.QUERIES[name](spark, SF).collect()}
        assert got == rows, name


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_against_sql(spark, name):
    con = pytest.importorskip("duckdb").connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = con.execute(queries.ORACLES[name])
    df = queries.QUERIES[name](spark, SF)
    assert [c[0] for c in found.description] == df.columns
    assert sorted(map(str, found.fetchall())) == sorted(str(tuple(r)) for r in df.collect())


def test_bpe_odd_rows(odd_docs, no_docs):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.encode(odd_docs, ranks, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "text", "_id", "_n", "ids"]  # a clashing column is replaced
    rows = bpe.decode(coded, ranks).collect()
    assert len(rows) == len(TEXTS)
    want = brute.op1({k: t for k, (_, t) in enumerate(TEXTS)})
    ids = collections.Counter((r["text"], sha(" ".join(map(str, r["ids"])))) for r in rows)
    assert ids == collections.Counter((t, want[k][2]) for k, (_, t) in enumerate(TEXTS))
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in rows)
    assert bpe.decode(bpe.encode(no_docs, ranks, public_tokenizers.PATTERN), ranks).count() == 0


def test_bpe_tasks_hold_little(odd_docs):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    ids = np.arange(2_000_000) % len(ranks)
    whole = b"".join(ranks[i] for i in ids[:len(ranks)])
    tracemalloc.start()
    try:
        data, lens = bpe.Tokens(ranks).decode(ids)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert data[:len(whole)].tobytes() == whole and len(data) == lens.sum()
    assert peak < 10 * len(data)
    # a column that stays goes to the tasks once
    assert bpe._source(odd_docs, ["doc_id", "text"], "text")[0].columns == ["_row"]
    assert bpe._source(odd_docs, ["doc_id"], "text")[0].columns == ["_row", "_in"]


def test_bpe_rejects_unknown_ids():
    v = bpe.Vocabulary(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    with pytest.raises(ValueError):
        v.decode(bpe.np.array([10**6]))


def test_exact_odd_rows(odd_docs, no_docs):
    rows = by_id(exact.exact_groups(odd_docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert len(rows) == len(TEXTS)
    at = collections.defaultdict(list)
    for r in rows:
        at[r[0]].append(r[1:])
    assert at[1] == [(2, 4, False, at[2][0][3])]            # two spaces more: the longest text stays
    assert at[8] == [at[1][0], at[1][0]] and at[2][0][2]
    assert at[3][0][:2] == (5, 4) and at[5][0][2]           # null, empty and blank are equal; 5 has most code points
    assert at[7][0][:3] == (6, 2, False)
    assert at[None][0][0] is None or at[None][1][0] is None
    assert exact.exact_groups(no_docs).count() == 0
    kept = exact.drop_copies(odd_docs)
    assert kept.columns == odd_docs.columns and kept.where("doc_id in (1, 3, 4, 7, 8)").count() == 0


def test_exact_drop_judges_each_row_of_an_id(spark):
    rows = [(0, "z z\x0b"), (1, "zz"), (1, "a"), (2, "\ta\x0c\r"), (3, None), (4, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id(exact.drop_copies(df), "doc_id", "text") == [(0, "z z\x0b"), (2, "\ta\x0c\r"), (4, " ")]
    df = spark.createDataFrame([*rows[:3], (None, "a"), (None, "b")], "doc_id long, text string")
    assert by_id(exact.drop_copies(df), "doc_id", "text") == [(0, "z z\x0b"), (1, "a"), (None, "b")]


def test_trie_spills_and_finds_all(tmp_path):
    import random
    random.seed(3)
    texts = ["".join(random.choices("ab", k=random.randint(0, 40))).encode() for _ in range(4000)]
    trie = exact.Trie(budget=20_000)
    for k, t in enumerate(texts):
        trie.insert(t, t, (0, False, k))
        assert trie.held <= 20_000 + 2000
    want = {t: (texts.index(t), texts.count(t)) for t in set(texts)}
    got = {text: (best[2], n) for text, key, best, n in trie.texts() if text == key}
    assert got == want


def test_substring_odd_rows(odd_docs, no_docs):
    rows = substring.remove_repeats(odd_docs).collect()
    assert len(rows) == len(TEXTS)
    want = brute.op4({k: t for k, (_, t) in enumerate(TEXTS)})
    assert sorted((r["n_words"], r["n_removed"], sha(r["kept"])) for r in rows) == sorted(w[1:] for w in want.values())
    one = next(r for r in rows if r["doc_id"] == 9)
    assert one["spans"] == [[2, 52]] and one["kept"] == "one two three"
    assert substring.remove_repeats(no_docs).count() == 0


def test_lines_odd_rows(odd_docs, no_docs):
    rows = {r["doc_id"]: r for r in lines.drop_repeated_lines(odd_docs).collect()}
    assert rows[15]["kept"] == "line one of five words\n\nlast" and (rows[15]["n_equal"], rows[15]["n_near"]) == (1, 1)
    assert rows[3]["kept"] == rows[4]["kept"] == "" and rows[3]["n_lines"] == 1
    assert rows[7]["kept"] == "" and rows[6]["kept"]
    assert rows[8]["n_equal"] == 1
    assert lines.drop_repeated_lines(no_docs).count() == 0


@pytest.mark.parametrize("x, y, near", [
    ("a b c d e", "a b X d e", True), ("a b c d e", "a b c d", False), ("a b c d e", "a b c d e f", True),
    ("a b c d e", "z a b c d e", True), ("a b c d e", "b c d e a", False), ("a b c d e", "a X c Y e", False),
    ("a a a a a", "a a a a a a", True)])
def test_lines_within_one_word(spark, x, y, near):
    df = spark.createDataFrame([(1, f"{x}\n{y}")], "doc_id long, text string")
    assert lines.drop_repeated_lines(df).first()["n_near"] == int(near)


def test_decontaminate_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame(
        [(1, "CAT sat"), (2, None), (3, "..."), (4, " ".join(f"PASS{i}" for i in range(12))), (4, "café"), (None, "dog")],
        "item_id long, text string")
    rows = decontaminate.find_leaks(odd_docs, bench).collect()
    got = collections.defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append((r["n_hit"], list(r["items"])))
    assert got[1] == [(2, ["1"])] and got[9] == [(12, ["4"])] and got[12] == [(1, ["4"])]
    assert got[3] == got[4] == [(0, [])] and got[11] == [(0, [])]
    one = next(r for r in rows if r["doc_id"] == 1)
    a, b = one["spans"][0]
    assert dict((i, t) for i, t in TEXTS)[1][a:b] == "cat sat"
    split = decontaminate.find_leaks(odd_docs, bench, max_bytes=100).collect()  # several automata, the same result
    assert sorted(map(str, split)) == sorted(map(str, rows))
    assert decontaminate.find_leaks(no_docs, bench).count() == 0
    assert decontaminate.find_leaks(odd_docs, bench.limit(0)).where("n_hit > 0").count() == 0
    clean = decontaminate.drop_leaks(odd_docs, bench)
    assert clean.where("doc_id in (1, 2, 8, 9, 10, 12)").count() == 0 and clean.columns == odd_docs.columns
    assert by_id(decontaminate.drop_leaks(odd_docs, bench, max_bytes=800), "*") == by_id(clean, "*")


def test_decontaminate_items_without_an_id(spark, tmp_path):
    """The registered query and its SQL on a benchmark with null ids."""
    docs = spark.createDataFrame(
        [(1, "The cat sat by the dog"), (2, "a dog"), (3, "a cat sat"), (4, "none"), (5, None), (6, "one bird")],
        "doc_id long, text string")
    bench = spark.createDataFrame([(1, "CAT sat"), (None, "dog"), (None, "bird"), (2, "bird")], "item_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    con = pytest.importorskip("duckdb").connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    got = by_id(queries.op9_decontaminate(spark, str(tmp_path)), "*")
    assert got == sorted(con.execute(queries.ORACLES["op9_decontaminate"]).fetchall(), key=str)
    assert [r[2] for r in got] == [3, 1, 2, 0, 0, 1]
    whole, split = (decontaminate.find_leaks(docs, bench, unnamed=True, max_bytes=m) for m in (1 << 30, 200))
    assert by_id(whole, "*") == by_id(split, "*")
    assert by_id(decontaminate.drop_leaks(docs, bench), "doc_id") == [(4,), (5,)]


def test_benchmark_parts_are_bounded_and_whole(spark):
    bench = spark.createDataFrame(
        [(i, " ".join(f"w{i}q{j}" for j in range(30))) for i in range(40)], "item_id long, text string")
    one, = decontaminate.patterns(bench, "item_id", "text", 10, 1 << 30)
    parts = decontaminate.patterns(bench, "item_id", "text", 10, 50_000)
    sizes = [sum(len(r["_w"]) * 40 + len(r["_items"]) * 120 for r in p.collect()) for p in parts]
    assert len(parts) > 5 and max(sizes) < 100_000 and one.count() == 40 * 21
    assert sorted(bytes(r["_w"]) for p in parts for r in p.collect()) == sorted(bytes(r["_w"]) for r in one.collect())


def test_minhash_odd_rows(odd_docs, no_docs):
    rows = by_id(minhash.near_groups(odd_docs), "doc_id", "n_shingles", "component_id", "kept")
    assert len(rows) == len(TEXTS)
    at = {r[0]: r[1:] for r in rows}
    assert at[1] == (7, 1, True) and at[2] == (7, 1, False) and at[8] == (7, 1, False)
    assert at[3] == (0, 3, True) and at[4] == (0, 4, True) and at[7][1:] == (6, False)
    assert at[None][1] is None
    assert minhash.near_groups(no_docs).count() == 0


def test_minhash_judges_each_text_of_an_id(spark):
    a = " ".join(f"a{i}" for i in range(60))
    near_a, b, near_b = f"{a} more", a.replace("a", "b"), a.replace("a", "b") + " more"
    for rows, kept in [
            ([(5, a), (5, b), (7, near_a), (8, near_b)], [(5, a), (5, b)]),          # both texts of 5 have their links
            ([(3, near_a), (5, a), (5, b)], [(3, near_a), (5, b)]),                  # the clean text of 5 stays
            ([(1, a), (None, a), (None, b)], [(1, a), (None, b)]),                   # a copy without id goes
            ([(1, a), (None, near_a), (None, b), (None, near_b)], None),             # so does a near copy
            ([(5, a), (5, a), (6, near_a), (6, near_a)], [(5, a), (5, a)])]:
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = by_id(minhash.drop_near_copies(df), "doc_id", "text")
        if kept is None:
            assert got in ([(1, a), (None, b)], [(1, a), (None, near_b)])
        else:
            assert got == kept
        assert minhash.near_groups(df).where("kept").count() == len(got)
    rows = [(5, a), (5, b), (7, near_a), (8, near_b), (9, None)]
    groups = minhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert by_id(groups, "doc_id", "component_id", "kept") == [
        (5, 5, True), (5, 5, True), (7, 5, False), (8, 5, False), (9, 9, True)]


def test_minhash_links_beyond_the_first_of_a_bucket(spark):
    """A chain of texts, each near the next only, and a crowd of altered copies."""
    base = [f"t{i}" for i in range(120)]
    rows, words = [], list(base)
    for k in range(25):
        rows.append((k, " ".join(words)))
        words[(k * 17) % 120] = f"new{k}"
    for k in range(25, 120):
        altered = [w if (i * 7 + k * 13) % 23 > k % 5 else f"{w}v{k}" for i, w in enumerate(base)]
        rows.append((k, " ".join(altered)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: tuple(r) for r in minhash.near_groups(docs).collect()}
    assert got == brute.op10(dict(rows))


def test_components_of_a_long_chain(spark):
    from farebox.llm.common import write_table
    links = write_table(spark.range(1, 200).selectExpr("id as _x", "id - 1 as _y"), "chain")
    got = minhash.components(links)
    assert got.count() == 199 and got.where("_y <> 0").count() == 0


def test_quality_held_out(spark):
    rows = queries.op6_quality(spark, "/root/testdata/sf0.01").collect()
    label = brute.pq.read_table("/root/testdata/sf0.01/labels.parquet").to_pydict()
    label = dict(zip(label["doc_id"], label["quality"]))
    import zlib
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [(r["predicted"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    assert sum(p == y for p, y in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_quality_odd_rows(spark, odd_docs, no_docs, labels):
    model = quality.fit(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    rows = quality.score(odd_docs, model).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score(no_docs, model).count() == 0
    assert quality.drop_rejects(odd_docs, model).columns == odd_docs.columns
    ones = quality.fit(odd_docs, spark.createDataFrame([(1, 1), (2, 1), (6, None)], "doc_id long, quality int"))
    assert ones.constant == 1.0
    assert quality.fit(no_docs, labels.limit(0)).score("x") == 1.0


def test_quality_blocks_of_a_long_text():
    text = "Some words, then MORE words!! " * 60_000
    old, quality.BLOCK = quality.BLOCK, 1000
    try:
        cut = quality.features(text)
    finally:
        quality.BLOCK = old
    assert (cut == quality.features(text)).all()


def test_signature_estimates_similarity():
    a, b = (minhash.shingles(" ".join(f"w{i}" for i in range(s, s + 1000))) for s in (0, 100))
    x, y = minhash.signatures([a, b])
    assert abs((x == y).mean() - len(set(a) & set(b)) / len(set(a) | set(b))) < 0.15
    assert hashlib.sha256(x.tobytes()).digest() == hashlib.sha256(minhash.signatures([a])[0].tobytes()).digest()


def test_minhash_pair_of_one_bucket_hidden_by_a_star(spark):
    """Two linked texts that share one bucket only, whose smallest member is linked with neither."""
    import random
    rng, mh = random.Random(8601), minhash
    w = [f"w{rng.randrange(10**6)}" for _ in range(136)]
    x, y = w[:120], w[:104] + w[120:]
    sig = mh.signatures([mh.shingles(" ".join(t)) for t in (x, y)]).reshape(2, mh.HASHES // mh.BAND, mh.BAND)
    (band,) = [b for b in range(sig.shape[1]) if (sig[0, b] == sig[1, b]).all()]
    runs = [x[i:i + 5] for i in range(100)]                 # the common shingles
    one = mh.np.concatenate([mh.shingles(" ".join(r)) for r in runs])
    least = ((mh._A * one + mh._B) >> mh.np.uint64(32))[band * mh.BAND:(band + 1) * mh.BAND].argmin(axis=1)
    z = [word for i in least for word in runs[i]]
    assert (mh.signatures([mh.shingles(" ".join(z))]).reshape(sig.shape[1:])[band] == sig[0, band]).all()
    df = spark.createDataFrame([(1, " ".join(z)), (2, " ".join(x)), (3, " ".join(y))], "doc_id long, text string")
    assert by_id(minhash.near_groups(df), "doc_id", "component_id") == [(1, 1), (2, 2), (3, 2)]


def test_quality_against_plain_dual_descent(spark):
    """Scores of the query on sf0.001 equal those of a fit over dense rows, written anew."""
    import brute_quality
    marks = table("labels")
    want = brute_quality.scores(brute.docs("sf0.001"), dict(zip(marks["doc_id"], marks["quality"])))
    got = {r["doc_id"]: r["score"] for r in queries.op6_quality(spark, SF).collect()}
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in want) < 1e-6


def test_quality_sample_is_bounded_in_rows_and_bytes(spark):
    words = [" ".join(f"w{(i * j) % 97}" for j in range(40)) for i in range(60)]
    docs = spark.createDataFrame([(i % 20, w) for i, w in enumerate(words)] + [(7, "the same")] * 500, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    vectors = spark.createDataFrame([(i % 2, bytes([i] * 4 * (i + 1))) for i in range(100)], "_y int, _x binary")
    for rows, size in ((30, 1 << 20), (100, 5000), (1000, 1 << 20), (1, 1)):
        kept = quality._bounded(vectors, rows, size).collect()
        assert len(kept) <= rows and (sum(len(r["_x"]) for r in kept) <= size or len(kept) == 1) and kept
        assert len(kept) == 100 or (rows, size) != (1000, 1 << 20)
    model = quality.fit(docs, labels, max_fit_rows=10, max_fit_bytes=2000)
    assert 0 <= model.score(words[0]) <= 1


def test_window_of_many_items(spark):
    """20,000 items with one common window: the parts stay as they are, the items are all found."""
    same = " ".join(f"common{i}" for i in range(10))
    bench = spark.range(20_000).selectExpr("concat('q', id) AS item_id", f"'{same}' AS text").unionByName(
        spark.createDataFrame([(None, same), ("other", " ".join(f"word{i}" for i in range(12)))], "item_id string, text string"))
    parts = decontaminate.patterns(bench, "item_id", "text", 10, 10_000)
    rows = [r for p in parts for r in p.collect()]
    assert len(parts) <= 3 and len(rows) == 1 + 3 and max(len(r["_items"]) for r in rows) <= decontaminate.FEW
    docs = spark.createDataFrame([(1, f"a {same} b"), (2, "nothing"), (3, " ".join(f"word{i}" for i in range(11))),
                                  (4, f"{same} " + " ".join(f"word{i}" for i in range(10))), (1, f"a {same} b")], "doc_id long, text string")
    all_of = sorted([f"q{i}" for i in range(20_000)])
    for unnamed, size in ((False, 1 << 20), (False, 10_000), (True, 1 << 20)):
        got = decontaminate.find_leaks(docs, bench, unnamed=unnamed, max_bytes=size).collect()
        end = [None] if unnamed else []
        assert sorted((r["doc_id"], r["n_hit"], len(r["items"])) for r in got) == [
            (1, 10, 20_000 + len(end)), (1, 10, 20_000 + len(end)), (2, 0, 0), (3, 11, 1), (4, 20, 20_001 + len(end))]
        assert all(r["items"] == all_of + end for r in got if r["doc_id"] == 1)
        assert next(r["items"] for r in got if r["doc_id"] == 4) == sorted([*all_of, "other"]) + end
    assert by_id(decontaminate.drop_leaks(docs, bench), "doc_id") == [(2,)]
