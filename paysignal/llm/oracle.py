"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

OP8_MIX = rf"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         (('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '') || ':'), 1, 13))::BIGINT::DOUBLE
          + 0.5) / 4503599627370496.0 AS u
  FROM documents),
rows_ AS (SELECT *, floor(u * 65536)::INTEGER AS part FROM docs),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM rows_ GROUP BY source),
placed AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, source COLLATE C) - 1 AS place FROM sizes),
weighed AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
         source_size * 3.0::DOUBLE AS full_ FROM placed),
levels AS (
  SELECT *, full_ / w AS full_at,
         (sum(source_size) OVER () - coalesce(sum(full_) OVER (ORDER BY full_ / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY full_ / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM weighed),
common AS (SELECT coalesce(arg_min(level, {{'a': full_at, 'b': place}}), NULL) AS common FROM levels WHERE level <= full_at),
targets AS (
  SELECT source, source_size, CASE WHEN full_at < coalesce(common, 'Infinity'::DOUBLE) THEN full_ ELSE common * w END AS target
  FROM levels, common),
plan AS (
  SELECT *, floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END + 1e-12)::INTEGER AS whole FROM targets),
rest AS (SELECT *, greatest(0.0, target - whole * source_size) AS rest FROM plan),
parts AS (SELECT source, part, sum(size) AS words, count(*) AS n FROM rows_ GROUP BY source, part),
run AS (
  SELECT p.*, r.rest,
         sum(words) OVER (PARTITION BY p.source ORDER BY part) AS cum_w,
         sum(n) OVER (PARTITION BY p.source ORDER BY part) AS cum_n
  FROM parts p JOIN rest r ON p.source IS NOT DISTINCT FROM r.source),
crossing AS (
  SELECT *, min(CASE WHEN cum_w > rest THEN cum_n - n END) OVER (PARTITION BY source) AS at_ FROM run),
zone AS (
  SELECT source, min(part) AS lo, max(part) AS hi, min(cum_w - words) AS before
  FROM crossing WHERE cum_n > at_ - 256 AND cum_n - n < at_ + 256 GROUP BY source),
all_ AS (
  SELECT d.doc_id, d.size, d.u, d.part, d.source, r.source_size, r.target, r.whole, r.rest, z.lo, z.hi, z.before,
         CASE WHEN r.rest / r.source_size > 0
              THEN (d.u / (1 - d.u)) / ((r.rest / r.source_size) / (1 - r.rest / r.source_size)) ELSE d.u END AS q,
         coalesce(d.part BETWEEN z.lo AND z.hi, false) AS inside
  FROM rows_ d JOIN rest r ON d.source IS NOT DISTINCT FROM r.source
  LEFT JOIN zone z ON d.source IS NOT DISTINCT FROM z.source),
fit AS (
  SELECT *, rest > 0 AND before + cum <= rest AS fits FROM (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, doc_id, size ROWS UNBOUNDED PRECEDING) AS cum
    FROM all_ WHERE inside)),
gaps AS (
  SELECT *, rest - before - sum(CASE WHEN fits THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap FROM fit),
crossed AS (
  SELECT *, NOT fits AND before + cum - size <= rest AS crossing FROM gaps),
overs AS (
  SELECT *, max(CASE WHEN crossing THEN size END) OVER (PARTITION BY source) - gap AS over_ FROM crossed),
offs AS (
  SELECT *, coalesce(abs(size - CASE WHEN fits THEN over_ ELSE gap END), 'Infinity'::DOUBLE) AS off_ FROM overs),
nearest AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY off_, q, doc_id, size) = 1 AND off_ < gap AS flips FROM offs),
swaps AS (
  SELECT *, bool_or(flips AND fits) OVER (PARTITION BY source) AND crossing AS swaps FROM nearest),
taken AS (
  SELECT doc_id, size, source_size, target, whole + CASE WHEN fits <> flips OR swaps THEN 1 ELSE 0 END AS copies FROM swaps
  UNION ALL
  SELECT doc_id, size, source_size, target, whole + CASE WHEN rest > 0 AND part < lo THEN 1 ELSE 0 END FROM all_ WHERE NOT inside)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken FROM taken
"""

OP1_TOPK = """
WITH clean AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0)))::BIGINT AS score
  FROM clean q JOIN clean c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# crc32 (reflected polynomial 0xEDB88320) by a table of 256 values: tab, and crc of any text.
CRC = """
tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS tab)"""


def crc32(text: str) -> str:
    code = f"hex(encode({text}))"
    ints = f"list_transform(range(length({code}) // 2), lambda i: ('0x' || substr({code}, (2 * i + 1)::BIGINT, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {ints}), lambda c, b: xor(c // 256, tab[(xor(c, b) % 256) + 1])), 4294967295)"


OP13_PREFIX_TRIE = f"""
WITH {CRC},
own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (SELECT conv_id, turns, conv_id - conv_id % 5 AS base, {crc32('conv_id::VARCHAR')} % 9 AS h FROM own, tab),
built AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS turns
  FROM hashed a LEFT JOIN own b ON a.base = b.conv_id),
prefixes AS (
  SELECT conv_id, d AS depth, turns[1:d] AS node, d = len(turns) AS ends
  FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM built)),
nodes AS (
  SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256,
         CASE WHEN depth > 0 THEN (count(*) - 1) * strlen(any_value(node)[depth].text) ELSE 0 END AS saved
  FROM prefixes GROUP BY depth, node),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
         (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.node[1:n.depth] = n.node) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]),
above AS (SELECT node[1:d] AS node, d AS depth, saved, n_children FROM (SELECT *, unnest(range(depth + 1)) AS d FROM linked)),
sums AS (
  SELECT depth, node, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves FROM above GROUP BY depth, node)
SELECT l.conv_id, l.depth::BIGINT AS depth, l.parent_conv_id, l.n_convs::BIGINT AS n_convs, l.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, l.ends_sha256
FROM linked l JOIN sums s ON l.depth = s.depth AND l.node = s.node
"""

OP12_SPELLING = f"""
WITH RECURSIVE {CRC},
found AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY 1, 2),
hashed AS (SELECT run, times, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM found, tab),
words AS (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
less AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS cut
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN words b ON a.cut = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN words b ON a.cut = b.word),
best AS (
  SELECT *, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near COLLATE C) AS place FROM pairs),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near,
         CASE WHEN b.near_n >= 10 * w.n THEN b.near END AS form, CASE WHEN b.near_n >= 10 * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word AND b.place = 1),
chain AS (
  SELECT word, word AS at_ FROM forms
  UNION SELECT c.word, f.form FROM chain c JOIN forms f ON c.at_ = f.word WHERE f.form IS NOT NULL),
roots AS (SELECT c.word, c.at_ AS root FROM chain c JOIN forms f ON c.at_ = f.word WHERE f.form IS NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, r.root FROM forms f JOIN roots r ON f.word = r.word
"""


def llm_sql() -> dict[str, str]:
    return {
        "op1_topk": OP1_TOPK,
        "op8_mix": OP8_MIX,
        "op12_spelling": OP12_SPELLING,
        "op13_prefix_trie": OP13_PREFIX_TRIE,
    }
