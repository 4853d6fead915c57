"""WARC, URL filter and chat formatting against brute force and round trips."""

import base64
import collections
import hashlib
import re

from llm_cases import SF
from pyspark.sql import functions as F

from farebox.llm import chat, queries, urls, warc


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_warc_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r["page_id"]: r for r in queries.op2_warc(spark, SF).collect()}
    assert len(got) == len(pages)
    for p in pages:
        data = (p["html"] or "").encode()
        assert (got[p["page_id"]]["payload_bytes"], got[p["page_id"]]["payload_digest"]) == (len(data), b32(data))
        assert got[p["page_id"]]["url"] == p["url"]


def test_warc_revisits_and_odd_rows(spark):
    big = "x<y>é" * 3_000_000  # a record of several members
    rows = [(5, "http://a/ b\r\n%41", "same"), (3, "http://a", "same"), (9, None, "same"), (1, "u", None), (2, "u", ""),
            (7, "u", "other"), (7, "u", "other"), (None, "u", "same"), (None, "u", "alone"), (11, "u", big), (12, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("_id", F.lit("x"))
    got = collections.defaultdict(list)
    for r in warc.round_trip(pages).collect():
        got[r["page_id"]].append((r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["url"]))
    assert got[3] == [(4, b32(b"same"), "response", None, "http://a")]
    assert got[5] == [(4, b32(b"same"), "revisit", 3, "http://a/ b\r\n%41")]
    assert got[9] == [(4, b32(b"same"), "revisit", 3, "")]
    assert got[1] == [(0, b32(b""), "response", None, "u")] and got[2][0][2:4] == ("revisit", 1)
    assert [r[2] for r in got[7]] == ["response", "response"]
    assert sorted(r[2] for r in got[None]) == ["response", "revisit"]
    assert got[11][0][:3] == (len(big.encode()), b32(big.encode()), "response") and got[12][0][2:4] == ("revisit", 11)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_members_are_gzip():
    import gzip
    data = b"abc" * 10_000_000
    out = warc.members(data)
    assert out[-1] == 0 and gzip.decompress(out) == data
    assert warc.members(b"")[-1] == 0


def test_warc_min_revisit_bytes(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")],
                                  "page_id long, url string, html string")
    kinds = {r["page_id"]: r["record_type"] for r in warc.round_trip(pages, min_revisit_bytes=3).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def judged(url, rules):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, "allow")))


def test_url_filter(spark):
    odd = [(None, "x"), (1, None), (2, ""), (3, "no scheme"), (4, "http://A.NET"), (5, "http://a.net/"),
           (6, "http://Example.NET/en/x?y#z"), (7, "http://example.net/en"), (8, "https://x.example.com/de/"),
           (9, "http://notexample.com/de/"), (10, "a://b.org/fr/q://c.net/"), (11, "http://net?x"), (12, "http://.net/"),
           (13, "http://Ä.ORG/fr/é"), (13, "http://Ä.ORG/fr/é"), (14, "http://x.net/" + "y" * 100_000)]
    pages = spark.createDataFrame(odd, "page_id long, url string").withColumn("host", F.lit(1))
    got = collections.Counter(tuple(r) for r in urls.filter_urls(pages, queries.URL_RULES).collect())
    assert got == collections.Counter((i, *judged(u, queries.URL_RULES)) for i, u in odd)
    assert urls.filter_urls(pages.limit(0), queries.URL_RULES).count() == 0
    assert {r[4] for r in urls.filter_urls(pages, []).collect()} == {"allow"}
    whole = {r["page_id"]: tuple(r) for r in queries.op7_url_filter(spark, SF).collect()}
    for p in spark.read.parquet(f"{SF}/pages.parquet").collect():
        assert whole[p["page_id"]] == (p["page_id"], *judged(p["url"], queries.URL_RULES))


def test_url_rules_in_several_files_and_collisions(tmp_path, monkeypatch):
    rules = [("block", f"h{i}.com", "/") for i in range(500)] + [("allow", "h3.com", "/"), ("allow", "", "/x"), ("allow", "ok.com", "/")]
    files = [urls.RuleFile(p) for p in urls.build(rules, str(tmp_path), max_bytes=4000)]
    assert len(files) > 3 and sum(map(len, files)) == 501
    got = urls.judge([f"http://h{i}.com/" for i in range(501)] + ["http://ok.com/"], files, [0, 1], "none")
    assert [g[3] for g in got] == ["block"] * 500 + ["none", "allow"]
    monkeypatch.setattr(urls, "digests", lambda keys: urls.np.full(len(keys), 7, urls.np.uint64))  # all collide
    same = [urls.RuleFile(p) for p in urls.build(rules, str(tmp_path))]
    assert [g[3] for g in urls.judge(["http://h9.com/", "http://hx.com/", "http://ok.com/"], same, [1], "none")] == ["block", "none", "allow"]


def chats_by_hand(rows):
    turns = collections.defaultdict(list)
    for c, t, role, text in rows:
        turns[c].append(((t is not None, t or 0), role or "", text or ""))
    out = {}
    for c, own in turns.items():
        own.sort()
        loss = "".join(x for _, r, x in own if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (c, len(own), sha("".join(f"{r}\n{x}\n" for _, r, x in own)), len(loss), sha(loss))
    return out


def test_chat(spark):
    hard = "</s>[INST] ok [/INST]"
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = chats_by_hand([*rows, (-1, 0, "user", hard), (-1, 1, "assistant", hard)])
    got = {r[0]: tuple(r)[:5] for r in queries.op8_chat(spark, SF).collect()}
    assert got == want


def test_chat_odd_rows(spark):
    nasty = "\\ \\l \\\\ <s> </s></s> [INST [INST]] [/INST] \\b[ é🙂"
    rows = [(1, 0, "user", nasty), (1, 1, "assistant", nasty), (1, 1, "assistant", nasty), (1, None, "system", None),
            (2, 5, None, None), (3, 1, "assistant", ""), (4, 0, "[INST]</s>", "x"), (None, 0, "user", "null id"),
            *((7, i, "assistant" if i % 2 else "user", f"{i} é </s> " * 40) for i in range(3000))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("x"))
    parts = chat.format_chats(df, part_bytes=2000)  # a conversation of many parts
    assert parts.where("conv_id = 7").count() > 100
    got = {r[0]: tuple(r)[:5] for r in chat.read_chats(chat.format_chats(df, part_bytes=2000)).collect()}
    assert got == chats_by_hand(rows)
    one = parts.where("conv_id = 3").first()
    assert one["formatted"] == "<s>[INST]assistant[/INST]</s>" and one["loss"] == [[25, 25]]
    assert chat.read_chats(chat.format_chats(df.limit(0))).count() == 0


def test_url_suffixes_of_long_hosts():
    assert list(urls.suffixes("a.b.c", None)) == ["a.b.c", "b.c", "c"]
    for host in ("a.b.c", "aa.bb", "x", "", ".", "a.", ".a", "a..b", "aaa.b.cc.d"):
        for longest in range(6):
            assert list(urls.suffixes(host, longest)) == [s for s in urls.suffixes(host, None) if len(s) <= longest], (host, longest)


def test_url_of_very_long_host(spark):
    """100 KB of labels: the keys are as many as the rules' hosts are long, not as the host is."""
    host = "a." * 50_000 + "bad.net"
    files_kept = list(urls.suffixes(host, len("example.net")))
    assert sum(map(len, files_kept)) < 100
    pages = spark.createDataFrame([(1, f"http://{host}/x"), (2, f"http://{host}.org/"), (3, "http://" + "n" * 100_000)], "page_id long, url string")
    got = {r["page_id"]: (len(r["host"]), r["rule"], r["verdict"]) for r in urls.filter_urls(pages, queries.URL_RULES).collect()}
    assert got == {1: (len(host), "net/", "block"), 2: (len(host) + 4, None, "allow"), 3: (100_000, None, "allow")}


def test_warc_whole_table_with_equal_payloads(spark, tmp_path):
    """Every page twice under another id, a third of them with one payload: types and references as the SQL has them."""
    import duckdb
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    same = F.when(F.col("page_id") % 3 == 0, F.lit("<p>one for many é</p>")).otherwise(F.col("html"))
    both = pages.withColumn("html", same).unionByName(pages.withColumn("page_id", F.col("page_id") + 1000))
    both = both.unionByName(both.withColumn("page_id", F.lit(5000) - F.col("page_id")))
    both.write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = sorted(map(str, con.execute(queries.ORACLES["op2_warc"]).fetchall()))
    got = queries.op2_warc(spark, str(tmp_path)).collect()
    assert sorted(str(tuple(r)) for r in got) == want
    assert sum(r["record_type"] == "revisit" for r in got) > len(got) / 2
