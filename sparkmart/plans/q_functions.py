"""FN queries: one per function family."""

from pyspark.sql import functions as F

from sparkmart.functions.ip import parse_ip
from sparkmart.functions import (
    boundary_diff, date_id, day_of_week, decode, div0, div_null, greatest_strict, ipv4_number, json_path, least_strict,
    month_of, rlike_full, tokens, trunc_to, url_parameter,
)
from sparkmart.plans.registry import query


@query("fn_null_conditional", """
SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN o_custkey END, -1) AS c1, CASE WHEN o_totalprice > 100000 THEN 'big' ELSE 'small' END AS c2, nullif(o_orderstatus, 'P') AS c3, coalesce(CASE WHEN o_orderstatus = 'F' THEN o_custkey END, 0) AS c4, nullif(o_custkey % 3, 0) AS c5,
 CASE WHEN o_orderstatus IS NOT DISTINCT FROM 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 2 ELSE 0 END AS c6, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE least(o_custkey, o_orderkey) END AS c7, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE greatest(o_custkey, o_orderkey) END AS c8 FROM orders""")
def _(t):
    c, s = F.col, F.col("o_orderstatus")
    key = F.when(s != "P", c("o_custkey"))
    return t.orders.select(
        "o_orderkey", F.coalesce(F.when(s == "F", c("o_custkey")), F.lit(-1)).alias("c1"), F.when(c("o_totalprice") > 100000, "big").otherwise("small").alias("c2"), F.nullif(s, F.lit("P")).alias("c3"),
        F.zeroifnull(F.when(s == "F", c("o_custkey"))).alias("c4"), F.nullifzero(c("o_custkey") % 3).alias("c5"), decode(s, [("F", 1), ("O", 2)], 0).alias("c6"),
        least_strict(key, "o_orderkey").alias("c7"), greatest_strict(key, "o_orderkey").alias("c8"))


@query("fn_numeric", """
SELECT o_orderkey, CASE WHEN o_custkey % 4 = 0 THEN 0 ELSE round(o_orderkey / (o_custkey % 4), 6) END::DOUBLE AS d0, round(o_orderkey / nullif(o_custkey % 4, 0), 6) AS dn, abs(o_custkey - 500) AS a, round(o_totalprice / 7, 2) AS r, CAST(floor(o_totalprice / 1000) AS BIGINT) AS f, o_orderkey % 7 AS m, CAST(trunc(o_totalprice / 1000) AS BIGINT) AS tr FROM orders""")
def _(t):
    c = F.col
    return t.orders.select("o_orderkey", F.round(div0("o_orderkey", c("o_custkey") % 4), 6).alias("d0"), F.round(div_null("o_orderkey", c("o_custkey") % 4), 6).alias("dn"), F.abs(c("o_custkey") - 500).alias("a"),
                           F.round(c("o_totalprice") / 7, 2).alias("r"), F.floor(c("o_totalprice") / 1000).alias("f"), (c("o_orderkey") % 7).alias("m"), (c("o_totalprice") / 1000).cast("bigint").alias("tr"))


@query("fn_string", """
SELECT p_partkey, lower(p_brand) AS s1, upper(p_name) AS s2, trim('  ' || p_name || ' ') AS s3, ltrim(p_name, 'sr') AS s4, replace(p_name, ' ', '_') AS s5, split_part(p_name, ' ', 2) AS s6, split_part(p_name, ' ', -1) AS s7, left(p_name, 3) AS s8, right(p_name, 3) AS s9, substr(p_name, 2, 4) AS s10, length(p_name) AS s11,
 instr(p_name, 'e') AS s12, contains(p_name, 'bolt') AS s13, p_name || '-' || p_brand AS s14, repeat('ab', p_size % 3) AS s15, regexp_replace(p_brand, '[0-9]', 'n', 'g') AS s16, regexp_full_match(p_name, 'small .*') AS s17, regexp_extract(p_brand, '[0-9]+') AS s18, len(regexp_extract_all(p_name, '[aeiou]')) AS s19, md5(p_name) AS s20, sha256(p_name) AS s21, left(p_name, 1) || 'XX' || substr(p_name, 4) AS s22, upper(hex(p_partkey)) AS s23 FROM part""")
def _(t):
    n, b = F.col("p_name"), F.col("p_brand")
    return t.part.select(
        "p_partkey", F.lower(b).alias("s1"), F.upper(n).alias("s2"), F.trim(F.concat(F.lit("  "), n, F.lit(" "))).alias("s3"), F.ltrim(n, F.lit("sr")).alias("s4"), F.replace(n, F.lit(" "), F.lit("_")).alias("s5"),
        F.split_part(n, F.lit(" "), F.lit(2)).alias("s6"), F.split_part(n, F.lit(" "), F.lit(-1)).alias("s7"), F.left(n, F.lit(3)).alias("s8"), F.right(n, F.lit(3)).alias("s9"), F.substring(n, 2, 4).alias("s10"), F.length(n).alias("s11"),
        F.instr(n, "e").alias("s12"), F.contains(n, F.lit("bolt")).alias("s13"), F.concat(n, F.lit("-"), b).alias("s14"), F.repeat(F.lit("ab"), F.col("p_size") % 3).alias("s15"), F.regexp_replace(b, "[0-9]", "n").alias("s16"),
        rlike_full(n, "small .*").alias("s17"), F.regexp_extract(b, "[0-9]+", 0).alias("s18"), F.regexp_count(n, F.lit("[aeiou]")).alias("s19"), F.md5(n).alias("s20"), F.sha2(n, 256).alias("s21"), F.overlay(n, F.lit("XX"), 2, 2).alias("s22"), F.hex("p_partkey").alias("s23"))


@query("fn_url_tokens", """
SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page_param, nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm, array_to_string(list_filter(string_split_regex(url, '[/]'), lambda x: x <> ''), '|') AS parts FROM pages""")
def _(t):
    return t.pages.select("page_id", url_parameter("url", "page").alias("page_param"), url_parameter("url", "utm_source").alias("utm"), F.array_join(tokens("url", "/"), "|").alias("parts"))


@query("fn_split_to_table", "SELECT conv_id, turn, unnest(range(len(w))) AS idx, unnest(w) AS line FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS w FROM conversations)")
def _(t):
    return t.conversations.select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("idx", "line")).withColumn("idx", F.col("idx").cast("long"))


@query("fn_date", """
SELECT event_id, date_trunc('week', ts)::TIMESTAMP AS d1, date_trunc('quarter', ts)::TIMESTAMP AS d2, ts + INTERVAL 10 DAY AS d3, ts + INTERVAL 2 MONTH AS d4, date_diff('month', ts, TIMESTAMP '2024-03-01') AS d5, date_diff('day', date_trunc('week', ts), TIMESTAMP '2024-02-26') // 7 AS d6, date_diff('hour', ts, TIMESTAMP '2024-02-01') AS d7, date_diff('minute', ts, TIMESTAMP '2024-02-01') AS d8,
 year(ts) AS d9, month(ts) AS d10, weekofyear(ts) AS d11, day(ts) AS d12, hour(ts) AS d13, strftime(ts, '%a') AS d14, strftime(ts, '%b') AS d15, dayofweek(ts) AS d16, CAST(last_day(ts) AS VARCHAR) AS d17, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Tokyo' AS d18, CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) AS d19, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS d20 FROM events""")
def _(t):
    ts = F.col("ts")
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    return t.events.select(
        "event_id", trunc_to("week", ts).alias("d1"), trunc_to("quarter", ts).alias("d2"), (ts + F.expr("INTERVAL 10 DAY")).alias("d3"), (ts + F.expr("INTERVAL 2 MONTH")).alias("d4"), boundary_diff("month", ts, at("2024-03-01")).alias("d5"),
        boundary_diff("week", ts, at("2024-03-01")).alias("d6"), boundary_diff("hour", ts, at("2024-02-01")).alias("d7"), boundary_diff("minute", ts, at("2024-02-01")).alias("d8"), F.year(ts).alias("d9"), F.month(ts).alias("d10"),
        F.weekofyear(ts).alias("d11"), F.dayofmonth(ts).alias("d12"), F.hour(ts).alias("d13"), F.date_format(ts, "E").alias("d14"), F.monthname(ts).alias("d15"), day_of_week(ts).alias("d16"), F.last_day(ts).alias("d17"),
        F.convert_timezone(F.lit("UTC"), F.lit("Asia/Tokyo"), ts).alias("d18"), month_of(ts).alias("d19"), date_id(ts).alias("d20"))


@query("fn_cast", """
SELECT o_orderkey, TRY_CAST(left(o_orderpriority, 1) AS INTEGER) AS n1, TRY_CAST(o_orderpriority AS INTEGER) AS n2, TRY_CAST(CASE WHEN o_orderstatus = 'F' THEN '2024-02-30' ELSE '2024-02-28' END AS DATE)::VARCHAR AS n3, TRY_CAST(CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'no' ELSE 'maybe' END AS BOOLEAN) AS n4, CAST(TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(18,2)) AS DOUBLE) AS n5,
 CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE)::VARCHAR END AS n6 FROM orders""")
def _(t):
    c, s = F.col, F.col("o_orderstatus")
    text = F.date_format("o_orderdate", "dd/MM/yyyy")
    return t.orders.select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).try_cast("int").alias("n1"), c("o_orderpriority").try_cast("int").alias("n2"), F.when(s == "F", "2024-02-30").otherwise("2024-02-28").try_cast("date").alias("n3"),
        F.when(s == "F", "true").when(s == "O", "no").otherwise("maybe").try_cast("boolean").alias("n4"), F.try_to_number(F.format_string("%.2f", "o_totalprice"), F.lit("999999999999.99")).alias("n5"),
        F.try_to_timestamp(F.when(s == "P", "bad").otherwise(text), F.lit("dd/MM/yyyy")).cast("date").alias("n6"))


@query("fn_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.none') AS missing, NOT json_valid(left(props, CASE WHEN event_type = 'error' THEN 4 ELSE 100 END)) AS broken, CASE WHEN user_id % 2 = 0 THEN 'BIGINT' ELSE 'STRING' END AS kind, '{"t":"' || event_type || '","u":' || user_id || '}' AS obj FROM events""")
def _(t):
    v = F.parse_json("props")
    cut = F.when(F.col("event_type") == "error", F.substring("props", 1, 4)).otherwise(F.col("props"))
    mixed = F.when(F.col("user_id") % 2 == 0, F.parse_json(F.lit("1"))).otherwise(F.parse_json(F.lit('"x"')))
    return t.events.select("event_id", F.try_variant_get(v, "$.k", "int").alias("k"), json_path("props", "$.none").alias("missing"), F.try_parse_json(cut).isNull().alias("broken"), F.schema_of_variant(mixed).alias("kind"),
                           F.to_json(F.struct(F.col("event_type").alias("t"), F.col("user_id").alias("u"))).alias("obj"))


@query("fn_array", """
SELECT vec_id, len(a) AS n, array_to_string(list_append(a, 9), ',') AS a1, array_to_string(list_prepend(8, a), ',') AS a2, array_to_string(a[1:2], ',') AS a3, list_contains(a, 3) AS a4 FROM (SELECT vec_id, [label, CAST(vec_id % 5 AS INTEGER), 3 + label] AS a FROM embeddings)""")
def _(t):
    a = F.array(F.col("label"), (F.col("vec_id") % 5).cast("int"), F.col("label") + 3)
    join = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return t.embeddings.select("vec_id", F.size(a).alias("n"), join(F.array_append(a, 9)).alias("a1"), join(F.array_insert(a, 1, 8)).alias("a2"), join(F.slice(a, 1, 2)).alias("a3"), F.array_contains(a, 3).alias("a4"))


@query("fn_ip", """
SELECT event_id, CASE WHEN o < 256 THEN 10 * 16777216 + (user_id % 256) * 65536 + (event_id % 256) * 256 + o END AS ip_number FROM (SELECT *, event_id % 300 AS o FROM events)""")
def _(t):
    ip = F.format_string("10.%d.%d.%d", F.col("user_id") % 256, F.col("event_id") % 256, F.col("event_id") % 300)
    return t.events.select("event_id", ipv4_number(ip).alias("ip_number"))


V4, V6 = ["ipv4", "ipv4_range_start", "ipv4_range_end"], ["hex_ip", "hex_ip_range_start", "hex_ip_range_end"]
NIBBLES = "array_to_string(list_transform(range(0, 32), lambda i: substr('0123456789abcdef', 1 + 8 * CAST(b[4 * i + 1] AS INT) + 4 * CAST(b[4 * i + 2] AS INT) + 2 * CAST(b[4 * i + 3] AS INT) + CAST(b[4 * i + 4] AS INT), 1)), '')"


@query("fn_parse_ip", f"""
WITH e AS (SELECT event_id, 167772160 + (user_id % 256) * 65536 + (event_id % 256) * 256 + event_id % 300 AS n, event_id % 300 < 256 AND event_id % 35 <= 32 AS ok, event_id % 35 AS p4, event_id % 131 AS p6,
 lpad(bin(536939960), 32, '0') || lpad(bin(user_id % 65536), 16, '0') || repeat('0', 48) || lpad(bin(event_id % 65536), 16, '0') || lpad(bin((event_id * 7) % 65536), 16, '0') AS bits FROM events),
 f AS (SELECT event_id, unnest([0, 1, 2]) AS which, unnest([bits, left(bits, p6) || repeat('0', greatest(128 - p6, 0)), left(bits, p6) || repeat('1', greatest(128 - p6, 0))]) AS b FROM e WHERE p6 <= 128),
 h AS (SELECT event_id, MAX(x) FILTER (which = 0) AS hex_ip, MAX(x) FILTER (which = 1) AS hex_ip_range_start, MAX(x) FILTER (which = 2) AS hex_ip_range_end FROM (SELECT event_id, which, {NIBBLES} AS x FROM f) GROUP BY 1)
SELECT event_id, CASE WHEN ok THEN n END AS ipv4, CASE WHEN ok THEN n - n % (1::BIGINT << greatest(32 - p4, 0)) END AS ipv4_range_start,
 CASE WHEN ok THEN n - n % (1::BIGINT << greatest(32 - p4, 0)) + (1::BIGINT << greatest(32 - p4, 0)) - 1 END AS ipv4_range_end, hex_ip, hex_ip_range_start, hex_ip_range_end, CASE WHEN ok THEN 4 END AS family_4, CASE WHEN hex_ip IS NOT NULL THEN 6 END AS family_6
FROM e LEFT JOIN h USING (event_id)""")
def _(t):
    u, e = F.col("user_id"), F.col("event_id")
    four = F.format_string("10.%d.%d.%d/%d", u % 256, e % 256, e % 300, e % 35)
    six = F.format_string("2001:DB8:%x::%x:%x/%d", u % 65536, e % 65536, (e * 7) % 65536, e % 131)
    both = t.events.select("event_id", parse_ip(four).alias("a"), parse_ip(six).alias("b"))
    return both.select("event_id", *[F.col("a")[c].alias(c) for c in V4], *[F.col("b")[c].alias(c) for c in V6], F.col("a.family").alias("family_4"), F.col("b.family").alias("family_6"))
