"""HIER, NST and UDF queries."""

from pyspark.sql import functions as F

from sparkmart.functions import crc32_text, id15to18, money, path_first, path_last, path_to_column, regexp_to_array, salted_hash, trunc_to
from sparkmart.operators import hierarchy as H, nested as N, windows as wn
from sparkmart.plans.registry import dsum, query

# A customer's parent is the customer with the last digit cut off; customers of one
# segment are treated as deleted, which leaves children without their parent row.
FOREST_SQL = "SELECT c_custkey AS id, CASE WHEN c_custkey >= 10 THEN c_custkey // 10 END AS parent_id FROM customer WHERE c_mktsegment <> 'MACHINERY'"
LINEAGE_SQL = f"""
WITH RECURSIVE n AS ({FOREST_SQL}), a AS (SELECT id, parent_id, true AS v FROM n UNION ALL SELECT DISTINCT parent_id, NULL::BIGINT, false FROM n WHERE parent_id IS NOT NULL AND parent_id NOT IN (SELECT id FROM n)),
 r AS (SELECT id, parent_id, v, [id] AS l FROM a WHERE parent_id IS NULL UNION ALL SELECT a.id, a.parent_id, a.v, list_append(r.l, a.id) FROM r JOIN a ON a.parent_id = r.id)"""


def forest(t):
    return t.customer.filter("c_mktsegment <> 'MACHINERY'").select(F.col("c_custkey").alias("id"), F.expr("CASE WHEN c_custkey >= 10 THEN c_custkey div 10 END").alias("parent_id"))


def joined(c, sep="/"):
    return F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), sep).alias(c)


@query("hier_1_lineage", LINEAGE_SQL + " SELECT id, parent_id, array_to_string(l, '/') AS lineage, l[1] AS ultimate_parent_id, len(l) AS depth, v AS is_currently_valid FROM r WHERE id <> 0")
def _(t):
    return H.lineage(forest(t), "id", "parent_id").select("id", "parent_id", joined("lineage"), "ultimate_parent_id", "depth", "is_currently_valid")


VERSIONS_SQL = """SELECT c_custkey AS id, CASE WHEN c_custkey >= 10 THEN c_custkey // 10 END AS parent_id, TIMESTAMP '1994-01-01' AS lo, f AS hi FROM v UNION ALL SELECT c_custkey, CASE WHEN c_custkey >= 7 THEN c_custkey // 7 END, f, TIMESTAMP '2002-01-01' FROM v"""


@query("hier_2_lineage_scd", f"""
WITH RECURSIVE v AS (SELECT o_custkey AS c_custkey, MIN(o_orderdate) AS f FROM orders GROUP BY 1), n AS ({VERSIONS_SQL}),
 r AS (SELECT id, [id] AS l, lo, hi FROM n WHERE parent_id IS NULL AND hi > lo UNION ALL SELECT n.id, list_append(r.l, n.id), greatest(r.lo, n.lo), least(r.hi, n.hi) FROM r JOIN n ON n.parent_id = r.id AND NOT list_contains(r.l, n.id) AND greatest(r.lo, n.lo) < least(r.hi, n.hi))
SELECT id, array_to_string(l, '/') AS lineage, l[1] AS ultimate_parent_id, len(l) AS depth, lo AS lineage_valid_from, hi AS lineage_valid_to FROM r""")
def _(t):
    first = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("f"))
    two = F.array(
        F.struct(F.expr("CASE WHEN o_custkey >= 10 THEN o_custkey div 10 END").alias("parent_id"), F.lit("1994-01-01").cast("timestamp_ntz").alias("lo"), F.col("f").alias("hi")),
        F.struct(F.expr("CASE WHEN o_custkey >= 7 THEN o_custkey div 7 END").alias("parent_id"), F.col("f").alias("lo"), F.lit("2002-01-01").cast("timestamp_ntz").alias("hi")))
    versions = first.select(F.col("o_custkey").alias("id"), F.inline(two))
    out = H.lineage_scd(versions, "id", "parent_id", "lo", "hi")
    return out.select("id", joined("lineage"), "ultimate_parent_id", "depth", "lineage_valid_from", "lineage_valid_to")


MOVED_SQL = "SELECT o_orderkey AS id, CASE WHEN o_orderkey >= 10 AND o_orderstatus <> 'F' THEN o_orderkey // 10 END AS nxt FROM orders"


def moved(t):
    """An open order was 'moved to' the order with the last digit cut off: chains of at most one order per digit."""
    return t.orders.select("o_orderkey", F.expr("CASE WHEN o_orderkey >= 10 AND o_orderstatus <> 'F' THEN o_orderkey div 10 END").alias("nxt"))


@query("hier_3_resolve_chain", f"""
WITH RECURSIVE n AS ({MOVED_SQL}), r AS (SELECT id, [id] AS l FROM n WHERE nxt IS NULL UNION ALL SELECT n.id, list_prepend(n.id, r.l) FROM r JOIN n ON n.nxt = r.id)
SELECT id AS o_orderkey, array_to_string(l, '/') AS chain, l[-1] AS last_id, l[-1] <> id AS is_moved FROM r""")
def _(t):
    return H.resolve_chain(moved(t), "o_orderkey", "nxt").select("o_orderkey", joined("chain"), "last_id", "is_moved")


RENEWAL_SQL = """
RECURSIVE k AS (SELECT o_custkey, o_orderkey, dense_rank() OVER (PARTITION BY o_custkey ORDER BY date_trunc('year', o_orderdate)) AS g FROM orders),
 b AS (SELECT o_custkey, g - 1 AS g, list_sort(list(o_orderkey)) AS nx FROM k GROUP BY 1, 2), n AS (SELECT o_orderkey AS id, nx FROM k JOIN b USING (o_custkey, g)),
 e AS (SELECT id, unnest(nx) AS nxt FROM n), leaf AS (SELECT o_orderkey AS id FROM k WHERE o_orderkey NOT IN (SELECT id FROM n)),
 r AS (SELECT id, [id] AS l FROM leaf UNION ALL SELECT e.id, list_prepend(e.id, r.l) FROM r JOIN e ON e.nxt = r.id),
 best AS (SELECT id, l FROM r QUALIFY row_number() OVER (PARTITION BY id ORDER BY len(l) DESC, array_to_string(l, ',')) = 1),
 opt AS (SELECT n.id, len(b.l) AS ln, array_to_string(list_concat([n.id], n.nx, b.l[2:]), ',') AS s FROM n JOIN e USING (id) JOIN best b ON b.id = e.nxt UNION ALL SELECT id, 0, CAST(id AS VARCHAR) FROM leaf),
 lin AS (SELECT CAST(id AS VARCHAR) AS o_orderkey, s AS lineage FROM opt QUALIFY row_number() OVER (PARTITION BY id ORDER BY ln DESC, s) = 1)"""


def renewals(t):
    """An order is renewed by all orders of the customer's next year with any."""
    k = wn.dense_rank(t.orders.select("o_custkey", "o_orderkey", F.year("o_orderdate").alias("y")), "g", ["o_custkey"], "y")
    nxt = k.groupBy("o_custkey", (F.col("g") - 1).alias("g")).agg(F.array_sort(F.collect_list("o_orderkey")).alias("renewals"))
    return k.join(nxt, ["o_custkey", "g"], "left").select("o_orderkey", "renewals")


@query("hier_4_renewal_lineage", f"WITH {RENEWAL_SQL} SELECT * FROM lin")
def _(t):
    return H.renewal_lineage(renewals(t), "o_orderkey", "renewals")


@query("hier_5_lineage_parentage", f"""
WITH {RENEWAL_SQL}, flat AS (SELECT o_orderkey AS parent, unnest(string_split(lineage, ',')) AS child, generate_subscripts(string_split(lineage, ','), 1) AS depth FROM lin),
 base AS (SELECT parent, child, CAST(date_trunc('month', o_orderdate) AS DATE) AS cohort FROM (SELECT * FROM flat QUALIFY depth = MAX(depth) OVER (PARTITION BY child)) JOIN orders ON CAST(o_orderkey AS VARCHAR) = parent),
 win AS (SELECT parent, child, cohort FROM base QUALIFY row_number() OVER (PARTITION BY child ORDER BY cohort, parent) = 1),
 lost AS (SELECT w.parent, b.parent AS child, w.cohort FROM base b JOIN win w ON w.child = b.child WHERE b.parent <> w.parent)
SELECT child, parent AS ultimate_parent, CAST(cohort AS VARCHAR) AS cohort FROM (SELECT * FROM win UNION ALL SELECT * FROM lost) QUALIFY row_number() OVER (PARTITION BY child ORDER BY cohort, parent) = 1""")
def _(t):
    lineages = H.renewal_lineage(renewals(t), "o_orderkey", "renewals")
    cohorts = t.orders.select("o_orderkey", F.trunc("o_orderdate", "month").alias("cohort"))
    return H.lineage_parentage(lineages, "o_orderkey", cohorts, "cohort")


@query("hier_6_rollup_to_root", LINEAGE_SQL + f"""
SELECT l[1] AS ultimate_parent_id, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month, {dsum('o_totalprice')} AS amount FROM r JOIN orders ON o_custkey = id WHERE id <> 0 GROUP BY 1, 2""")
def _(t):
    lineages = H.lineage(forest(t), "id", "parent_id")
    facts = t.orders.select(F.col("o_custkey").alias("id"), F.trunc("o_orderdate", "month").alias("month"), "o_totalprice")
    return H.rollup_to_root(facts, lineages, "id", ["month"], amount=F.sum(money("o_totalprice")))


# ---------------------------------------------------------------- nested

AREAS = "country string, factor double, metro_areas array<struct<name: string, factor: double, parts: array<struct<name: string, factor: double>>>>"


@query("nst_1_flatten_levels", """
SELECT s_suppkey, s_name AS country, CASE WHEN s_acctbal > 5000 THEN NULL WHEN s_nationkey < 12 THEN x.n ELSE x.m END AS area, CASE WHEN s_acctbal > 5000 THEN 0.5 WHEN s_nationkey < 12 THEN x.f ELSE 0.9 END::DOUBLE AS factor
FROM (SELECT *, unnest(CASE WHEN s_acctbal > 5000 THEN [{'n': NULL, 'm': NULL, 'f': NULL}] WHEN s_nationkey < 12 THEN [{'n': 'P1', 'm': 'M', 'f': 0.1}, {'n': 'P2', 'm': 'M', 'f': 0.2}] ELSE [{'n': NULL, 'm': 'M', 'f': NULL}] END) AS x FROM supplier)""")
def _(t):
    doc = F.when(F.col("s_acctbal") > 5000, F.concat(F.lit('{"country": "'), "s_name", F.lit('", "factor": 0.5}'))).when(
        F.col("s_nationkey") < 12, F.concat(F.lit('{"country": "'), "s_name", F.lit('", "factor": 0.5, "metro_areas": [{"name": "M", "factor": 0.9, "parts": [{"name": "P1", "factor": 0.1}, {"name": "P2", "factor": 0.2}]}]}'))).otherwise(
        F.concat(F.lit('{"country": "'), "s_name", F.lit('", "factor": 0.5, "metro_areas": [{"name": "M", "factor": 0.9}]}')))
    df = t.supplier.select("s_suppkey", doc.alias("doc"))
    return N.flatten_levels(df, "doc", AREAS, [("metro", "__doc.metro_areas"), ("part", "metro.parts")],
                            {"country": ["__doc.country"], "area": ["part.name", "metro.name"], "factor": ["part.factor", "metro.factor", "__doc.factor"]}).drop("doc")


@query("nst_2_flatten_paths", """
SELECT event_id, unnest(['uid', 'e.kind', 'e.m.value', 'e.m.n.o.p[0].q', 'tags[0]', 'tags[1].t']) AS path, unnest([CAST(user_id AS VARCHAR), event_type, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR), CAST(event_id AS VARCHAR), 'x', event_type]) AS value, false AS too_deep FROM events""")
def _(t):
    doc = F.format_string('{"uid": %d, "e": {"kind": "%s", "m": {"value": %d, "n": {"o": {"p": [{"q": %d}]}}}}, "tags": ["x", {"t": "%s"}]}', "user_id", "event_type", F.round(F.col("value") * 100).cast("long"), "event_id", "event_type")
    return N.flatten_paths(t.events.select("event_id", doc.alias("doc")), "event_id", "doc")


@query("nst_3_extract_context", "SELECT event_id, event_type AS plan, user_id AS project_id FROM events WHERE event_type <> 'error'")
def _(t):
    ctx = F.format_string('{"data": [{"schema": "web/1", "data": {"plan": "none"}}, {"schema": "%s/2", "data": {"plan": "%s", "project_id": "%d"}}]}',
                          F.when(F.col("event_type") == "error", "other").otherwise("standard"), "event_type", "user_id")
    return N.extract_context(t.events.select("event_id", ctx.alias("contexts")), "contexts", "standard/%", {"plan": "string", "project_id": "bigint"})


@query("nst_4_unpack_event", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'masked' WHEN event_type = 'click' THEN json_extract_string(props, '$.k') END AS click_k FROM events""")
def _(t):
    payload = F.concat(F.lit('{"data": {"data": '), "props", F.lit("}}"))
    df = t.events.select("event_id", "event_type", payload.alias("payload"))
    return N.unpack_event(df, "event_type", "payload", "click", ["k"], "click", masked=("error",)).select("event_id", "click_k")


@query("nst_5_parse_kv_text", """
SELECT o_orderkey, o_custkey AS customer_id, o_orderpriority AS name, CAST(floor(o_totalprice) AS BIGINT) AS namespace_id, o_orderdate AS created_at, o_orderdate + INTERVAL 1 DAY AS updated_at, o_orderstatus = 'F' AS is_trial FROM orders""")
def _(t):
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    later = F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd HH:mm:ss")
    text = F.concat(F.lit("customer_id: "), F.col("o_custkey").cast("string"), F.lit("\nname: '"), F.col("o_orderpriority"), F.lit("'\nns: id-"), F.floor("o_totalprice").cast("string"),
                    F.lit(" x\ncreated_at: &1 "), stamp, F.lit("\nupdated_at: !local\n  utc: a\n  zone: b\n  "), later, F.lit("\ntrial: "), F.when(F.col("o_orderstatus") == "F", "true").otherwise("''"))
    spec = {"customer_id": ("customer_id", "bigint"), "name": ("name", "string"), "ns": ("namespace_id", "digits"), "created_at": ("created_at", "timestamp"), "updated_at": ("updated_at", "timestamp"), "trial": ("is_trial", "boolean")}
    return N.parse_kv_text(t.orders.select("o_orderkey", text.alias("object")), "object", spec).drop("object")


@query("nst_6_extract_refs", r"""
SELECT doc_id, 'mail' AS link_type, unnest(regexp_extract_all(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+')) AS link_id FROM documents UNION ALL SELECT doc_id, 'link', unnest(regexp_extract_all(text, 'https?://([a-z.]+)', 1)) FROM documents""")
def _(t):
    return N.extract_refs(t.documents.select("doc_id", "text"), "text", {"mail": ("[A-Za-z0-9._]+@[A-Za-z0-9.]+", 0), "link": ("https?://([a-z.]+)", 1)})


@query("nst_7_explode_tags", "SELECT p_partkey, unnest(list_filter(string_split_regex(lower(p_name) || ' ,' || p_type, '[ ,]'), lambda x: x <> '')) AS tag FROM part")
def _(t):
    return N.explode_tags(t.part.select("p_partkey", F.concat(F.lower("p_name"), F.lit(" ,"), "p_type").alias("tags")), "tags", delimiters=" ,")


@query("nst_8_name_dimensions", "SELECT s_suppkey, s_nationkey, n_name AS dimension_name FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND n_regionkey < 3")
def _(t):
    seed = t.nation.filter("n_regionkey < 3").withColumnRenamed("n_name", "dimension_name")
    return N.name_dimensions(t.supplier.select("s_suppkey", "s_nationkey"), seed, "s_nationkey", "n_nationkey", "dimension_name")


@query("nst_9_path_parts", """
SELECT page_id, split_part(host, '.', 1) AS first_part, split_part(host, '.', -1) AS last_part, replace(host, '.', '_') AS column_name FROM (SELECT page_id, split_part(url, '/', 3) AS host FROM pages)""")
def _(t):
    df = t.pages.select("page_id", F.split_part("url", F.lit("/"), F.lit(3)).alias("host"))
    return df.select("page_id", path_first("host").alias("first_part"), path_last("host").alias("last_part"), path_to_column("host").alias("column_name"))


@query("nst_10_project_payload", """
SELECT event_id, CASE WHEN k >= 0 THEN k END AS counter, event_type AS kind, NULL::DOUBLE AS missing FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) - 50 AS k FROM events)""")
def _(t):
    doc = F.format_string('{"counts": {"k": %d}, "kind": "%s"}', F.get_json_object("props", "$.k").cast("long") - 50, "event_type")
    return N.project_payload(t.events.select("event_id", doc.alias("payload")), "payload", {"counter": ("$.counts.k", "bigint"), "kind": ("$.kind", "string"), "missing": ("$.none", "double")})


# ---------------------------------------------------------------- UDF

def _check_char(start):
    bits = " + ".join(f"CASE WHEN substr(s, {start + j}, 1) BETWEEN 'A' AND 'Z' THEN {1 << j} ELSE 0 END" for j in range(5))
    return f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ012345', ({bits}) + 1, 1)"


@query("udf_1_id15to18", f"""
SELECT doc_id, CASE WHEN length(s) = 15 THEN s || {_check_char(1)} || {_check_char(6)} || {_check_char(11)} ELSE s END AS id18 FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN substr(base64(unhex(md5(text))), 1, 15) ELSE source END AS s FROM documents)""")
def _(t):
    s = F.when(F.col("lang") == "en", F.substring(F.base64(F.unhex(F.md5("text"))), 1, 15)).otherwise(F.col("source"))
    return t.documents.select("doc_id", s.alias("s")).select("doc_id", id15to18("s").alias("id18"))


@query("udf_2_regexp_to_array", "SELECT doc_id, array_to_string(regexp_extract_all(text, '[0-9]+'), '|') AS numbers, len(regexp_extract_all(text, '[0-9]+')) AS n FROM documents")
def _(t):
    found = regexp_to_array("text", "[0-9]+")
    return t.documents.select("doc_id", F.array_join(found, "|").alias("numbers"), F.size(found).alias("n"))


@query("udf_3_crc32", """
WITH RECURSIVE nibble(i, step, v) AS (SELECT i, 0, i FROM range(16) AS r(i) UNION ALL SELECT i, step + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM nibble WHERE step < 4),
 t AS (SELECT list(v ORDER BY i) AS t FROM nibble WHERE step = 4),
 digits AS (SELECT c_custkey, list_transform(string_split(hex(encode(c_name)), ''), lambda c: CAST('0x' || c AS BIGINT)) AS h FROM customer),
 low_first AS (SELECT c_custkey, list_transform(range(len(h)), lambda i: CASE WHEN i % 2 = 0 THEN h[i + 2] ELSE h[i] END) AS h FROM digits)
SELECT c_custkey, xor(list_reduce(list_prepend(4294967295::BIGINT, h), lambda crc, n: xor(t[1 + (xor(crc, n) & 15)], crc // 16)), 4294967295) AS crc FROM low_first, t""")
def _(t):
    return t.customer.select("c_custkey", crc32_text("c_name").alias("crc"))


@query("udf_4_salted_hash", "SELECT c_custkey, sha256(trim(lower(c_name || 'Pepper'))) AS name_hash FROM customer")
def _(t):
    return t.customer.select("c_custkey", salted_hash("c_name", "Pepper").alias("name_hash"))
