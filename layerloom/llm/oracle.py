"""DuckDB SQL with the rows of the queries here that SQL can express."""

from __future__ import annotations

from layerloom.llm import license_scan, mixing, prefix_trie, sharding
from layerloom.llm.common import HASH_BITS, SQL_CONTENT_MD5


def _templates() -> str:
    rows = ",\n".join(f"({i}, '{n}', '{t.replace(chr(39), chr(39) * 2)}')" for i, (n, t) in enumerate(license_scan.TEMPLATES))
    return f"SELECT * FROM (VALUES\n{rows}) AS v(template, licence, text)"


_WORDS = r"string_split(trim(regexp_replace(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g'), ' '), ' ')"

def _telling() -> str:
    rows = license_scan.telling_bigrams(license_scan.TEMPLATES, license_scan.DEFAULT_THRESHOLD)
    values = ",\n".join(f"('{a} {b}', {place}, {size})" for a, b, place, size in rows)
    return f"SELECT * FROM (VALUES\n{values}) AS v(gram, place, size)"


_LOW, _HIGH = (f"round(len(wanted) * {f}, 9)" for f in ("0.8 / 1.2", "1.2 / 0.8"))

OP1 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents WHERE text IS NOT NULL),
split AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS nth
  FROM docs),
lines AS (
  SELECT r, nth, list_filter({_WORDS.format('line')}, lambda x: x <> '') AS w FROM split),
placed AS (
  SELECT r, nth, len(w) AS n, sum(len(w)) OVER (PARTITION BY r ORDER BY nth) AS stop,
    sum(CASE WHEN len(w) = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY nth) AS paragraph
  FROM lines),
whole AS (SELECT r, flatten(list(w ORDER BY nth)) AS w FROM lines GROUP BY r),
telling AS ({_telling()}),
hits AS (
  SELECT r, unnest(list_transform(list_zip(w[1:len(w) - 1], w[2:]), lambda p: p[1] || ' ' || p[2])) AS gram,
    unnest(range(0, len(w) - 1)) AS place_in, len(w) AS n FROM whole),
spans AS (
  SELECT r, stop - n AS start, stop FROM placed
  UNION SELECT r, min(stop - n), max(stop) FROM placed GROUP BY r, paragraph
  UNION SELECT r, 0, len(w) FROM whole
  UNION SELECT r, greatest(place_in - place, 0), least(place_in - place + size, n)
    FROM hits JOIN telling USING (gram)),
known AS (
  SELECT template, licence, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS wanted
  FROM (SELECT template, licence, {_WORDS.format('text')} AS w FROM ({_templates()}))),
units AS (
  SELECT r, start::BIGINT AS start, stop::BIGINT AS stop, w[start::BIGINT + 1:stop::BIGINT] AS w
  FROM spans JOIN whole USING (r)
  WHERE stop - start >= 2 AND stop - start - 1 <= (SELECT max({_HIGH}) FROM known)),
grams AS (
  SELECT r, start, stop,
    list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS grams
  FROM units),
rivals AS (
  SELECT a.template, b.template AS rival FROM known AS a JOIN known AS b ON a.template <> b.template
    AND 2 * len(list_intersect(a.wanted, b.wanted)) >= least(len(a.wanted), len(b.wanted))),
shared AS (
  SELECT r, licence, template, start, stop, len(list_intersect(grams, wanted)) AS shared, len(grams) + len(wanted) AS sizes
  FROM grams JOIN known ON len(grams) >= {_LOW} AND len(grams) <= {_HIGH} AND stop - start - 1 <= {_HIGH}),
found AS (
  SELECT *, 2 * shared / sizes AS dice FROM shared WHERE 2 * shared / sizes >= {license_scan.DEFAULT_THRESHOLD}),
best AS (
  SELECT * FROM found AS x WHERE NOT EXISTS (
    SELECT 1 FROM found AS y
    WHERE y.r = x.r AND y.template = x.template
      AND 2 * (least(x.stop, y.stop) - greatest(x.start, y.start)) >= least(x.stop - x.start, y.stop - y.start)
      AND (-y.dice, y.stop - y.start, y.start) < (-x.dice, x.stop - x.start, x.start)))
SELECT doc_id, licence, max(dice) AS dice, count(*) AS n_notices
FROM best AS x JOIN docs USING (r)
WHERE NOT EXISTS (
  SELECT 1 FROM best AS y JOIN rivals ON rival = y.template
  WHERE y.r = x.r AND rivals.template = x.template
    AND 2 * (least(x.stop, y.stop) - greatest(x.start, y.start)) >= least(x.stop - x.start, y.stop - y.start)
    AND (-y.shared, -y.dice, y.template) < (-x.shared, -x.dice, x.template))
GROUP BY doc_id, licence
"""

OP2 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
asked AS (SELECT DISTINCT vec_id, q FROM v WHERE vec_id % 50 = 0),
scored AS (
  SELECT a.vec_id AS query_id, v.vec_id, list_dot_product(a.q, v.q)::BIGINT AS score
  FROM asked a JOIN v ON a.vec_id <> v.vec_id AND len(a.q) = len(v.q)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP9 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, strlen(coalesce(text, '')) AS n_bytes,
    ('0x' || substr({SQL_CONTENT_MD5}, 1, {HASH_BITS // 4}))::BIGINT AS h FROM documents),
levels AS (SELECT r, h >> ({HASH_BITS} - l) AS prefix, l, n_bytes FROM d, range(0, {HASH_BITS + 1}) AS t(l)),
buckets AS (SELECT l, prefix, sum(n_bytes) AS total, count(*) AS n FROM levels GROUP BY ALL),
leaves AS (
  SELECT r, min(l) AS depth FROM levels JOIN buckets USING (l, prefix)
  WHERE total <= {sharding.DEFAULT_MAX_BYTES} OR n <= 1 GROUP BY r)
SELECT doc_id, n_bytes, depth AS shard_depth,
  right(lpad(bin(h >> ({HASH_BITS} - depth)), {HASH_BITS}, '0'), depth::INT) AS shard
FROM d JOIN leaves USING (r)
"""

OP10 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, {SQL_CONTENT_MD5} AS id, strlen(coalesce(text, '')) + 1 AS n
  FROM documents),
sizes AS (SELECT source, sum(n) AS bytes, pow(sum(n)::DOUBLE, 0.7) AS weight FROM d GROUP BY source),
rates AS (
  SELECT source, weight / (SELECT sum(weight) FROM sizes) * (SELECT sum(bytes) FROM sizes)::DOUBLE / bytes AS rate
  FROM sizes),
parted AS (
  SELECT source, greatest(1, ceil(rate / {mixing.PART_MEAN}))::INT AS parts,
    rate / greatest(1, ceil(rate / {mixing.PART_MEAN})) AS mean FROM rates),
terms AS (
  SELECT source, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1.0))) OVER (PARTITION BY source ORDER BY k) AS cdf
  FROM parted, range(0, {mixing.TERMS + 1}) AS t(k)),
draws AS (
  SELECT d.r, d.doc_id, d.source, d.id, part,
    ('0x' || substr(md5('17:' || d.id || ':' || part::VARCHAR), 1, {mixing.UNIFORM_DIGITS}))::BIGINT
      / {float(16**mixing.UNIFORM_DIGITS)!r} AS u
  FROM d JOIN parted p ON d.source IS NOT DISTINCT FROM p.source, unnest(range(1, p.parts + 1)) AS t(part)),
copies AS (
  SELECT w.r, w.doc_id, w.source, w.id, count(*) AS copies
  FROM draws w JOIN terms t ON w.source IS NOT DISTINCT FROM t.source AND t.cdf <= w.u GROUP BY ALL)
SELECT doc_id, source, copy, ('0x' || substr(md5('17:order:' || id || ':' || copy::VARCHAR), 1, 15))::BIGINT AS shuffle_key
FROM copies, unnest(range(1, copies + 1)) AS t(copy)
"""

_STEP = "sha256(length(role)::VARCHAR || ':' || role || text)"

#: CRC-32 of a string of digits and signs, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda s: ascii(s)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
      lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

OP11 = f"""
WITH given AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT c, {_STEP} AS step, length(text) AS size,
    row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, {_STEP}) AS place FROM given),
ids AS (SELECT c, {_CRC32.format('c::VARCHAR')} % {prefix_trie.BORROWED} AS h FROM (SELECT DISTINCT c FROM given)),
turns AS (
  SELECT i.c, place, step, size FROM ids i JOIN own o ON o.c = i.c - i.c % {prefix_trie.FAMILY} AND place <= h
  UNION ALL
  SELECT c, place + {prefix_trie.BORROWED}, step, size FROM own JOIN ids USING (c) WHERE place > h),
steps AS (
  SELECT c, row_number() OVER w AS depth, string_agg(step, '') OVER w AS node, size,
    count(*) OVER (PARTITION BY c) AS n_turns
  FROM turns WINDOW w AS (PARTITION BY c ORDER BY place)),
members AS (
  SELECT c, depth, node, size, depth = n_turns AS ends FROM steps
  UNION ALL
  SELECT c, 0, '', 0, c NOT IN (SELECT c FROM steps) FROM ids),
nodes AS (
  SELECT node, depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM members GROUP BY node, depth),
children AS (
  SELECT left(node, 64 * (depth - 1)) AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
subtrees AS (
  SELECT left(n.node, 64 * k) AS node, sum(n.saved)::BIGINT AS saved_tokens,
    count(*) FILTER (WHERE n.node NOT IN (SELECT node FROM children)) AS n_leaves
  FROM nodes n, range(0, n.depth + 1) AS t(k) GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
  saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees USING (node) LEFT JOIN children USING (node)
LEFT JOIN nodes p ON n.depth > 0 AND p.node = left(n.node, 64 * (n.depth - 1))
"""

ORACLES: dict[str, str] = {"op1_license_scan": OP1, "op2_topk": OP2, "op9_sharding": OP9, "op10_mixing": OP10, "op11_prefix_trie": OP11}
