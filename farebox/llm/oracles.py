"""The registered queries in DuckDB SQL, where SQL can express them.

The others are held against brute-force versions and round trips in
``tests/llm``: rank merges (op1), edit distances over a neighbourhood (op5) and
the classifier (op6)."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_NORMAL = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
           r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP2 = """
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS h FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first, sha1(h) AS x FROM p)
SELECT page_id, strlen(h) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((CAST('0x' || substr(x, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1, 1)
         FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, url FROM g"""

OP3 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n FROM documents),
r AS (
  SELECT doc_id, n, first_value(doc_id) OVER (PARTITION BY n ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY n) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n) AS text_sha256 FROM r"""

OP4 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
dup AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM win JOIN dup USING (s)),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN hit USING (doc_id, p)
  GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

OP7 = r"""
WITH u AS (
  SELECT page_id, coalesce(strpos(url, '://'), 0) AS mark, substr(url, strpos(url, '://') + 3) AS rest FROM pages),
p AS (
  SELECT page_id, CASE WHEN mark = 0 THEN '' ELSE translate(regexp_extract(rest, '^[^/?#]*'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS host,
         CASE WHEN mark = 0 THEN '' ELSE regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) END AS path FROM u),
rules(v, h, s) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                          ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fit AS (
  SELECT page_id, arg_max(h || s, length(h || s)) AS rule, arg_max(v, length(h || s)) AS verdict
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN fit USING (page_id)"""

def _escaped(text: str) -> str:
    """The template's escapes: backslashes doubled, then each control string's first character."""
    out = f"replace({text}, chr(92), chr(92) || chr(92))"
    for c, letter in (("<s>", "l"), ("</s>", "l"), ("[INST]", "b"), ("[/INST]", "b")):
        out = f"replace({out}, '{c}', chr(92) || '{letter}{c[1:]}')"
    return out


_TURNS = "ORDER BY turn NULLS FIRST, role, text"
OP8 = f"""
WITH r AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {_TURNS})) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' {_TURNS}) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(length('<s>') + sum(length('[INST][/INST]</s>') + length({_escaped("role")}) + length({_escaped("text")})) AS BIGINT)
         AS formatted_chars
FROM r GROUP BY conv_id"""

OP9 = f"""
WITH d AS (SELECT doc_id, {_NORMAL} AS w FROM documents),
b AS (SELECT item_id, {_NORMAL} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM iw))),
found AS (SELECT doc_id, n, i, item_id FROM dw JOIN iw USING (n, s)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

OP10 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
often AS (SELECT x FROM s GROUP BY x HAVING count(*) > 1),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM (SELECT * FROM s SEMI JOIN often USING (x)) a JOIN (SELECT * FROM s SEMI JOIN often USING (x)) b
    ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, r) AS (
  SELECT a, b FROM both_ways
  UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.r),
c AS (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(r, doc_id)) AS component_id,
       doc_id <= coalesce(r, doc_id) AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)"""

OP11 = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents),
win AS (SELECT doc_id, i, md5(t[i + 1:i + 400]) AS s
        FROM (SELECT doc_id, t, unnest(range(0, octet_length(t) - 399)) AS i FROM d WHERE octet_length(t) >= 400)),
dup AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
hit AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM win SEMI JOIN dup USING (s)),
runs AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 400 THEN 1 ELSE 0 END)
                OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hit),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 400 AS b FROM runs GROUP BY doc_id, run),
gaps AS (SELECT doc_id, b, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS next, b - a AS n FROM spans
         UNION ALL SELECT doc_id, 0, min(a), 0 FROM spans GROUP BY doc_id),
cut AS (SELECT doc_id, string_agg(hex(t[b + 1:coalesce(next, octet_length(t))]), '' ORDER BY b) AS k,
               sum(n) AS n_removed, count(*) - 1 AS n_spans FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, octet_length(t) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(coalesce(unhex(k), t)) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)"""

OP12 = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
m AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, len(regexp_extract_all(t, '[A-Z]')) AS capitals FROM d),
f AS (
  SELECT part, quality = 1 AS good, toxic = 1 AS bad,
         (CASE WHEN len(w) < 100 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END)
         + (CASE WHEN 100 * capitals > 10 * length(t) THEN 4 ELSE 0 END)
         + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
         + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS mask
  FROM m LEFT JOIN labels USING (doc_id)),
letters(x, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
perms AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
  JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS bit,
                 coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS before
          FROM (SELECT *, unnest(range(1, 6)) AS step FROM perms)),
judged AS (SELECT part, filter_order, step, bit, mask, good, bad, mask & bit > 0 AS fails, mask & before > 0 AS gone FROM f, steps),
c AS (
  SELECT part, filter_order, step, bit, count(*) FILTER (NOT gone AND NOT fails) AS kept, count(*) FILTER (NOT gone AND fails) AS removed,
         count(*) FILTER (gone AND fails) AS redundant, count(*) FILTER (mask = bit) AS unique_fails,
         count(*) FILTER (NOT gone AND fails AND good) AS good_lost, count(*) FILTER (NOT gone AND fails AND bad) AS toxic_lost
  FROM judged GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM c"""


def _op13(rounds: int = 10) -> str:
    """One pair of tables per round: the nearest centroid of each vector, the moved centroids."""
    nearest = """
near{r} AS MATERIALIZED (
  SELECT row, arg_min(k, (d, k)) AS k, min(d) AS d FROM (
    SELECT v.row, c.k, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS d
    FROM comp v JOIN cent{r} c USING (j) GROUP BY v.row, c.k) GROUP BY row),"""
    moved = """
cent{n} AS MATERIALIZED (
  SELECT c.k, c.j, CASE WHEN s.n IS NULL THEN c.x ELSE CAST((s.s - ((s.s % s.n) + s.n) % s.n) // s.n AS BIGINT) END AS x
  FROM cent{r} c LEFT JOIN (SELECT k, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM near{r} JOIN comp USING (row) GROUP BY k, j) s
  USING (k, j)),"""
    body = "".join(nearest.format(r=r) + moved.format(r=r, n=r + 1) for r in range(rounds)) + nearest.format(r=rounds)
    return f"""
WITH vec AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS row, embedding AS e FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
comp AS MATERIALIZED (
  SELECT row, unnest(range(1, 65)) AS j, CAST(floor(1024 * unnest(e)::DOUBLE) AS BIGINT) AS x FROM vec),
start AS (SELECT row, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k FROM vec QUALIFY k < 8),
cent0 AS MATERIALIZED (SELECT k, j, x FROM start JOIN comp USING (row)),{body}
hashes AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM cent{rounds} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM near{rounds} JOIN vec USING (row) JOIN hashes USING (k)"""


ORACLES = {"op2_warc": OP2, "op3_exact_dedup": OP3, "op4_substring": OP4, "op7_url_filter": OP7, "op8_chat": OP8,
           "op9_decontaminate": OP9, "op10_minhash": OP10,
           "op11_suffix_array": OP11, "op12_filter_audit": OP12, "op13_centroids": _op13()}
