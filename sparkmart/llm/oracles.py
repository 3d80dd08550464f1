"""DuckDB SQL of the queries that SQL can express, written from their definitions."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def band(c: str, cells: int = 32) -> str:
    """Number of a logarithmic cell: `cells` per power of two."""
    high = f"(length(bin({c})) - 6)"
    return f"CASE WHEN {c} < {2 * cells} THEN {c} ELSE ({c} >> {high}) + {cells} * {high} END"


def hash32(key: str) -> str:
    return f"CAST('0x' || substr(md5(coalesce(CAST({key} AS VARCHAR), '')), 1, 8) AS BIGINT)"


MIX = f"""
WITH d AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM d GROUP BY source),
w AS (SELECT source, source_size, CASE r % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight FROM s),
c AS (SELECT *, 2.0 * source_size / weight AS full_at FROM w),
levels AS (
  SELECT a.full_at, ((SELECT 1.5 * sum(source_size) FROM w) - coalesce(sum(2.0 * b.source_size) FILTER (b.full_at < a.full_at), 0)) / sum(b.weight) FILTER (b.full_at >= a.full_at) AS level
  FROM (SELECT DISTINCT full_at FROM c) a, c b GROUP BY a.full_at),
chosen AS (SELECT arg_min(level, full_at) AS level FROM levels WHERE level <= full_at),
t AS (SELECT source, source_size, CASE WHEN (SELECT level FROM chosen) IS NULL THEN 2.0 * source_size ELSE least(2.0 * source_size, (SELECT level FROM chosen) * weight) END::DOUBLE AS target FROM c),
k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {band("size")}, {hash32("doc_id")}, doc_id, size) AS r FROM d),
j AS (
  SELECT k.doc_id, k.size, t.source_size, t.target, k.r, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         CAST('0x' || substr(md5('mix:' || coalesce(k.source, '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS o
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source),
x AS (SELECT *, CAST(floor(rate * r + o) - floor(rate * (r - 1) + o) AS BIGINT) AS copies FROM j)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM x
"""


def quality(metrics: dict, least_docs: int, reach: float, cells: int) -> str:
    """Measures by definition, fences by nearest-rank quantiles over logarithmic cells."""
    exprs = {m: e.replace(" div ", " // ") for m, (e, _, _) in metrics.items()}
    top = f"CASE WHEN cell < {2 * cells} THEN cell ELSE ((cell - {cells} * (cell // {cells} - 1) + 1) << CAST(cell // {cells} - 1 AS BIGINT)) - 1 END"
    values = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS metric, {band(f'({e})', cells)} AS cell, {v[2]} AS slack FROM b, LATERAL (SELECT 1) WHERE NOT base_failed" for (m, e), v in zip(exprs.items(), metrics.values()))

    def level(by: str) -> str:
        group = f"{by + ', ' if by else ''}metric"
        return (
            f"SELECT {group}, max(n) AS n, min({top}) FILTER (upto >= ceil(n * 0.25)) AS q1, min({top}) FILTER (upto >= ceil(n * 0.75)) AS q3, max(slack) AS slack FROM "
            f"(SELECT *, count(*) OVER (PARTITION BY {group}) AS n, row_number() OVER (PARTITION BY {group} ORDER BY cell) AS upto FROM v) GROUP BY {group}"
        )

    checks = []
    for m, (_, side, _) in metrics.items():
        low = f"({exprs[m]}) >= f.q1 - greatest((f.q3 - f.q1) * {reach}, f.slack)" if side == "both" else "true"
        checks.append(f"WHEN f.metric = '{m}' THEN {low} AND ({exprs[m]}) <= f.q3 + greatest((f.q3 - f.q1) * {reach}, f.slack)")
    return rf"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {WORDS} AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
u AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (SELECT doc_id, i, x, lead(x) OVER o AS y, lead(x, 2) OVER o AS z FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x, y, z) AS n FROM g WHERE z IS NOT NULL),
p AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, (VALUES (0), (1), (2)) AS o(k) WHERE n > 1 GROUP BY doc_id),
a AS (
  SELECT w.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN p ON w.doc_id = p.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a),
v AS ({values}),
one AS ({level("lang, source")}), two AS ({level("lang")}), three AS ({level("")}),
f AS (
  SELECT k.lang, k.source, three.metric, CASE WHEN one.n >= {least_docs} THEN one.q1 WHEN two.n >= {least_docs} THEN two.q1 ELSE three.q1 END AS q1,
         CASE WHEN one.n >= {least_docs} THEN one.q3 WHEN two.n >= {least_docs} THEN two.q3 ELSE three.q3 END AS q3, three.slack
  FROM (SELECT DISTINCT lang, source FROM b) k CROSS JOIN three
  LEFT JOIN two ON two.metric = three.metric AND two.lang IS NOT DISTINCT FROM k.lang
  LEFT JOIN one ON one.metric = three.metric AND one.lang IS NOT DISTINCT FROM k.lang AND one.source IS NOT DISTINCT FROM k.source),
ok AS (
  SELECT b.doc_id, bool_and(CASE {" ".join(checks)} END) AS ok FROM b JOIN f ON b.lang IS NOT DISTINCT FROM f.lang AND b.source IS NOT DISTINCT FROM f.source WHERE NOT base_failed GROUP BY b.doc_id)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(ok, false) AS kept FROM b LEFT JOIN ok ON b.doc_id = ok.doc_id
"""


SHARDS = """
WITH RECURSIVE d AS (SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents),
draws AS (
  SELECT doc_id, s, -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(s AS VARCHAR)), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) AS bid
  FROM d, range(25) AS r(s)),
place AS (SELECT doc_id, CAST(arg_min(s, bid) FILTER (s < 24) AS INT) AS shard, CAST(arg_min(s, bid) AS INT) AS grown_shard FROM draws GROUP BY doc_id),
nibble(i, step, v) AS (SELECT i, 0, i FROM range(16) AS r(i) UNION ALL SELECT i, step + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM nibble WHERE step < 4),
t AS (SELECT list(v ORDER BY i) AS t FROM nibble WHERE step = 4),
crc AS (
  SELECT doc_id, octet_length(raw) + 8 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(hex(raw), ''), lambda c: CAST('0x' || c AS BIGINT))),
      lambda acc, c, i: CASE WHEN i % 2 = 0 THEN acc * 16 + c
        ELSE xor(t[1 + (xor(xor(t[1 + (xor(acc // 16, c) & 15)], (acc // 16) // 16), acc % 16) & 15)], xor(t[1 + (xor(acc // 16, c) & 15)], (acc // 16) // 16) // 16) END), 4294967295) AS text_crc32
  FROM d, t WHERE octet_length(raw) > 0
  UNION ALL SELECT doc_id, 8, 0 FROM d WHERE octet_length(raw) = 0)
SELECT p.doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY """ + hash32("p.doc_id") + """, p.doc_id) - 1 AS slot, grown_shard
FROM place p JOIN crc ON p.doc_id = crc.doc_id
"""

NEAR = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
l AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id, least(d.doc_id, coalesce(low, d.doc_id)) = d.doc_id AS kept
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN l ON l.a = d.doc_id
"""


COLLOCATIONS = r"""
WITH p AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (SELECT lang, s AS words, array_to_string(w[i : i + s - 1], ' ') AS phrase FROM s, range(1, 5) AS r(s) WHERE i + s - 1 <= len(w)),
f AS (SELECT lang, words, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND f >= 30),
k AS (SELECT c.*, unnest(range(1, words)) AS k FROM c),
z AS (SELECT k.lang, k.phrase, a, k, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * a // (x.f + y.f) AS BIGINT) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.w[1 : k], ' ') JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.w[k + 1 : k.words], ' ')),
b AS (SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
t AS (
  SELECT * FROM b WHERE NOT EXISTS (
    SELECT 1 FROM (SELECT lang, array_to_string(w[i : i + s - 1], ' ') AS phrase, max(a) AS most FROM c, range(2, 4) AS r(s), range(1, 4) AS q(i) WHERE s < words AND i + s - 1 <= words GROUP BY ALL) o
    WHERE o.lang = b.lang AND o.phrase = b.phrase AND 100 * CAST(most AS HUGEINT) >= 80 * CAST(b.a AS HUGEINT)))
SELECT t.lang, CAST(row_number() OVER (PARTITION BY t.lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank, phrase, a, l, r, n, score
FROM t JOIN n ON t.lang = n.lang QUALIFY rank <= 2000
"""
