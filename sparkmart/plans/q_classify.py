"""CLS queries."""

from pyspark.sql import functions as F

from sparkmart.functions import slugify, version_parts
from sparkmart.operators import classify as C, rules as R
from sparkmart.plans.registry import query


def lit(v):
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


def sql_ranges(c, table):
    tests = []
    for lo, hi, label, *strict in table:
        cond = " AND ".join(x for x in (f"{c} >= {lo}" if lo is not None else "", f"{c} {'<' if strict else '<='} {hi}" if hi is not None else "") if x)
        tests.append(f"WHEN {cond} THEN {lit(label)}")
    return "CASE " + " ".join(tests) + " END"


def sql_in(c, table, default):
    return "CASE " + " ".join(f"WHEN {c} IN ({', '.join(map(lit, v))}) THEN {lit(k)}" for k, v in table.items()) + f" ELSE {default} END"


def sql_enum(c, table):
    return "CASE " + " ".join(f"WHEN {c} = {k} THEN {lit(v)}" for k, v in table.items()) + " END"


def sql_likes(c, table, default="NULL"):
    return "CASE " + " ".join("WHEN " + " OR ".join(f"lower({c}) LIKE {lit(p)}" for p in pats) + f" THEN {lit(label)}" for pats, label in table) + f" ELSE {default} END"


def pick(c, options):
    """Spark column choosing a value by key modulo the list length: gives each row of a table a rule input."""
    arr = F.array(*[F.lit(o) for o in options])
    return F.get(arr, F.pmod(F.col(c), F.lit(len(options))).cast("int"))


def sql_pick(c, options):
    arr = "[" + ", ".join("NULL" if o is None else lit(o) for o in options) + "]"
    return f"{arr}[CAST({c} % {len(options)} AS INTEGER) + 1]"


@query("cls_1_arr_buckets", f"SELECT o_orderkey, {sql_ranges('(o_totalprice * 4 - 20000)', R.ARR_BUCKETS)} AS bucket FROM orders")
def _(t):
    return t.orders.select("o_orderkey", C.arr_bucket(F.col("o_totalprice") * 4 - 20000).alias("bucket"))


@query("cls_2_day_buckets", f"SELECT l_orderkey, l_linenumber, l_partkey, {sql_ranges(chr(40) + 'date_diff(' + chr(39) + 'day' + chr(39) + ', l_shipdate, TIMESTAMP ' + chr(39) + '2001-12-31' + chr(39) + '))', R.DAY_BUCKETS)} AS bucket FROM lineitem")
def _(t):
    days = F.datediff(F.lit("2001-12-31").cast("date"), F.col("l_shipdate"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", C.day_bucket(days).alias("bucket"))


@query("cls_3_seat_buckets", f"SELECT l_orderkey, l_linenumber, l_partkey, {sql_ranges('(CAST(l_quantity AS BIGINT) * l_linenumber * 4 - 20)', R.SEAT_BUCKETS)} AS bucket FROM lineitem")
def _(t):
    seats = F.col("l_quantity").cast("long") * F.col("l_linenumber") * 4 - 20
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", C.seat_bucket(seats).alias("bucket"))


@query("cls_4_deal_size", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '5 - Unknown' WHEN o_totalprice < 5000 THEN '1 - Small (<5k)' WHEN o_totalprice < 25000 THEN '2 - Medium (5k - 25k)'
 WHEN o_totalprice < 100000 THEN '3 - Big (25k - 100k)' ELSE '4 - Jumbo (>100k)' END AS deal_size FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", C.deal_size(F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))).alias("deal_size"))


@query("cls_5_arr_segmentation", """
SELECT o_custkey, arr_rank, CASE WHEN arr < 5000 THEN 'Under 5K' WHEN arr < 50000 THEN '5K to 50K' WHEN arr < 100000 THEN '50K to 100K' WHEN arr < 500000 THEN '100K to 500K'
 WHEN arr < 1000000 THEN '500K to 1M' ELSE '1M and above' END AS arr_segmentation,
 CASE WHEN arr_rank < 26 THEN 'First 25 Customer' WHEN arr_rank < 51 THEN '26 - 50 Customer' WHEN arr_rank < 101 THEN '51 - 100 Customer' WHEN arr_rank < 501 THEN '101 - 500 Customer'
 WHEN arr_rank < 1001 THEN '501 - 1000 Customer' WHEN arr_rank < 5001 THEN '1001 - 5000 Customer' ELSE '5000+ Customer' END AS rank_segmentation
FROM (SELECT *, rank() OVER (ORDER BY arr DESC) AS arr_rank FROM (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS arr FROM orders GROUP BY 1))""")
def _(t):
    arr = t.orders.groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("arr"))
    # The rank is global: distinct values are counted inside bands, from the highest band down.
    df = C.arr_segmentation(arr, "arr", chunk=lambda v: F.floor(v / 10000))
    return df.drop("arr")


SEGMENTS = ["smb", "Mid-Market", "mid market", "UNKNOWN", None, "pubsec", "Public Sector", "large"]


@query("cls_6_sales_segment", f"""
SELECT c_custkey, CASE WHEN lower(s) IN ('smb','unknown') OR s IS NULL THEN 'SMB' WHEN lower(s) LIKE 'mid%market' THEN 'Mid-Market' WHEN lower(s) = 'pubsec' THEN 'PubSec'
 WHEN lower(s) = 'public sector' THEN 'Public Sector' ELSE 'Large' END AS plain,
 CASE WHEN lower(s) IN ('smb','unknown') OR s IS NULL THEN 'SMB' WHEN lower(s) LIKE 'mid%market' THEN 'Mid-Market' WHEN lower(s) IN ('pubsec','public sector') THEN 'PubSec' ELSE s END AS hierarchy,
 CASE WHEN s IN ('Large') THEN 'x' WHEN g = 'AMER' AND s = 'pubsec' THEN 'pubsec' ELSE coalesce(s, 'Missing segment_region_grouped') END AS grouped
FROM (SELECT c_custkey, {sql_pick('c_custkey', SEGMENTS)} AS s, {sql_pick('c_nationkey', ['AMER', 'EMEA', 'APAC'])} AS g FROM customer)""")
def _(t):
    df = t.customer.select("c_custkey", pick("c_custkey", SEGMENTS).alias("s"), pick("c_nationkey", ["AMER", "EMEA", "APAC"]).alias("g"))
    return df.select("c_custkey", C.sales_segment("s").alias("plain"), C.sales_segment("s", True, True).alias("hierarchy"),
                     C.segment_region("s", "g", F.lit("West")).alias("grouped"))


REGION_SEG = ["Large", "PubSec", "SMB", None]
REGION_GEO = ["AMER", "LATAM", "APAC", "EMEA", "Other"]
REGION_REG = ["West", "East", "LATAM", "PubSec", "South", "Central", "x"]


@query("cls_6_segment_region", f"""
SELECT c_custkey, CASE WHEN big AND g = 'AMER' AND r = 'West' THEN 'US West' WHEN big AND g IN ('AMER','LATAM') AND r IN ('East','LATAM') THEN 'US East' WHEN big AND g IN ('APAC','EMEA') THEN g
 WHEN big AND r = 'PubSec' THEN 'PubSec' WHEN big THEN 'Large Other' WHEN s IS NULL THEN 'Missing segment_region_grouped' ELSE s END AS region_group
FROM (SELECT *, s IN ('Large','PubSec') AS big FROM (SELECT c_custkey, {sql_pick('c_custkey', REGION_SEG)} AS s, {sql_pick('c_custkey', REGION_GEO)} AS g, {sql_pick('c_custkey', REGION_REG)} AS r FROM customer))""")
def _(t):
    df = t.customer.select("c_custkey", pick("c_custkey", REGION_SEG).alias("s"), pick("c_custkey", REGION_GEO).alias("g"), pick("c_custkey", REGION_REG).alias("r"))
    return df.select("c_custkey", C.segment_region("s", "g", "r").alias("region_group"))


SOURCES = ["BDR Generated", "Web", "Partner", "Trial - Enterprise", "AE Generated", "Drift", "Clearbit", "Nowhere", "Education", "Free Registration", "Conference"]


@query("cls_7_source_remap", f"""
SELECT c_custkey, CASE WHEN s = 'BDR Generated' THEN 'SDR Generated' ELSE s END AS qualified, {sql_in('s', R.LEAD_SOURCE_CATEGORY, "'Other'")} AS category, {sql_in('s', R.LEAD_SOURCE_BUCKET, "'Other'")} AS bucket
FROM (SELECT c_custkey, {sql_pick('c_custkey', SOURCES)} AS s FROM customer)""")
def _(t):
    s = pick("c_custkey", SOURCES)
    return t.customer.select("c_custkey", C.qualified_source(s).alias("qualified"), C.lead_source_category(s).alias("category"), C.lead_source_bucket(s).alias("bucket"))


CHANNELS = ["Direct", "Display.Google", "IQM.IQM", "Trial.Trial", "Email", "Unheard Of", "Paid Search.Bing"]


@query("cls_8_marketing_channel", f"SELECT event_id, {sql_in('s', R.MARKETING_CHANNEL, chr(39) + 'Other' + chr(39))} AS channel FROM (SELECT event_id, {sql_pick('user_id', CHANNELS)} AS s FROM events)")
def _(t):
    return t.events.select("event_id", C.marketing_channel(pick("user_id", CHANNELS)).alias("channel"))


PARTNERS = ["Google Cloud EMEA", "AWS Marketplace", "Amazon", "IBM (OEM) x", "Carahsoft", None]
ENGAGE = ["Partner Sourced", "Co-sell", "Direct"]
ORDER_TYPES = ["1. New - First Order", "2. New - Connected", "4. Contraction", "5. Churn - Partial", "6. Churn - Final", None, "3. Growth"]


@query("cls_9_alliance_channel", f"""
SELECT c_custkey, CASE WHEN p LIKE 'Google%' THEN 'Google Cloud' WHEN p IN ('AWS Marketplace','Amazon') THEN 'Amazon Web Services' WHEN p LIKE 'IBM%' THEN 'IBM (OEM)' WHEN p IS NOT NULL THEN 'Non-Alliance Partners' END AS alliance,
 CASE WHEN p LIKE 'Google%' THEN 'GCP' WHEN p IN ('AWS Marketplace','Amazon') THEN 'AWS' WHEN p LIKE 'IBM%' THEN 'IBM' WHEN p IS NOT NULL THEN 'Non-Alliance' END AS alliance_short,
 CASE WHEN e = 'Direct' THEN NULL ELSE CASE WHEN e = 'Co-sell' THEN 'Co-sell' ELSE 'Sourced' END || CASE WHEN o LIKE '1.%' THEN ' - New' ELSE ' - Growth' END END AS channel
FROM (SELECT c_custkey, {sql_pick('c_custkey', PARTNERS)} AS p, {sql_pick('c_nationkey', ENGAGE)} AS e, {sql_pick('c_custkey', ORDER_TYPES)} AS o FROM customer)""")
def _(t):
    p, e, o = pick("c_custkey", PARTNERS), pick("c_nationkey", ENGAGE), pick("c_custkey", ORDER_TYPES)
    return t.customer.select("c_custkey", C.alliance_type(p, p).alias("alliance"), C.alliance_type(p, p, True).alias("alliance_short"), C.channel_type(e, o).alias("channel"))


DOMAINS = ["gmail.com", "yahoo.co.uk", "acme.com", None, "me.com", "example.org"]


@query("cls_10_email_domain", f"""
SELECT c_custkey, CASE WHEN c_nationkey % 11 = 0 THEN 'Bulk load or list purchase or spam impacted' WHEN d IS NULL THEN 'Missing email domain'
 WHEN d IN ('gmail.com','yahoo.co.uk','me.com') THEN 'Personal email domain' ELSE 'Business email domain' END AS domain_type
FROM (SELECT c_custkey, c_nationkey, {sql_pick('c_custkey', DOMAINS)} AS d FROM customer)""")
def _(t):
    source = F.when(F.col("c_nationkey") % 11 == 0, "Zoominfo").otherwise("Web")
    return t.customer.select("c_custkey", C.email_domain_type(pick("c_custkey", DOMAINS), source, ["gmail", "yahoo"], ["me.com"]).alias("domain_type"))


TITLES = ["CTO", "Director of Engineering", "IT Manager", "Project Manager Systems", "Software Developer", "Sales Rep", "Head IT", "cio, emea", "Engineering Manager", None]
TITLE_LEVEL = ["IT Decision Maker", "IT Decision Maker", "IT Manager", "IT Individual Contributor", "IT Individual Contributor", None,
               "IT Decision Maker", "IT Decision Maker", "IT Manager", None]


@query("cls_11_job_title", f"SELECT c_custkey, {sql_pick('c_custkey', TITLE_LEVEL)} AS title_level FROM customer")
def _(t):
    return t.customer.select("c_custkey", C.job_title_level(pick("c_custkey", TITLES)).alias("title_level"))


DEPARTMENTS = ["Awareness", "CEO", "Sales", "Field Operations", "Marketing Ops"]


@query("cls_12_department_group", f"""
SELECT c_custkey, CASE d WHEN 'Awareness' THEN 'Awareness, Communications, Community Relations, Owned Events' WHEN 'CEO' THEN 'People Success, CEO' WHEN 'Field Operations'
 THEN 'Field Ops - Child, Field Operations' WHEN 'Marketing Ops' THEN 'Field Marketing, Marketing Ops' ELSE d END AS department_group FROM (SELECT c_custkey, {sql_pick('c_custkey', DEPARTMENTS)} AS d FROM customer)""")
def _(t):
    return t.customer.select("c_custkey", C.grouped(pick("c_custkey", DEPARTMENTS), R.DEPARTMENT_GROUP).alias("department_group"))


@query("cls_13_enum_maps", f"""
SELECT event_id, {sql_enum('user_id % 14', R.ACTION_TYPE)} AS action, {sql_enum('user_id % 6', R.STATE)} AS state, {sql_enum('user_id % 27', R.PIPELINE_FAILURE)} AS failure,
 {sql_enum('user_id % 10', R.USER_ROLE)} AS role, {sql_enum('user_id % 4', R.RESOURCE_EVENT)} AS resource_event FROM events""")
def _(t):
    u = F.col("user_id")
    return t.events.select("event_id", C.enum(u % 14, R.ACTION_TYPE).alias("action"), C.enum(u % 6, R.STATE).alias("state"),
                           C.enum(u % 27, R.PIPELINE_FAILURE).alias("failure"), C.enum(u % 10, R.USER_ROLE).alias("role"), C.enum(u % 4, R.RESOURCE_EVENT).alias("resource_event"))


PRODUCTS = ["Gold Plan", "Silver", "Ultimate", "Premium x", "bronze", "Starter", "Plus 1", "standard", "Basic", "Trueup", "Discount 5%", "Widget", "CI Runner", "Quick Start with HA", " Admin Training ", "File Locking", "trueup"]


@query("cls_14_product_delivery", f"""
SELECT p_partkey, cat AS category, {sql_likes('cat', R.DELIVERY, sql_in('cat', R.DELIVERY_NAMES, 'NULL'))} AS delivery, CASE p WHEN 'Silver' THEN 2 WHEN 'Ultimate' THEN 3 WHEN 'Starter' THEN 1 ELSE 0 END AS product_rank
FROM (SELECT *, {sql_likes('p', R.PRODUCT_CATEGORY, sql_in('trim(p)', R.PRODUCT_CATEGORY_NAMES, "'Not Applicable'"))} AS cat FROM (SELECT p_partkey, {sql_pick('p_partkey', PRODUCTS)} AS p FROM part))""")
def _(t):
    p = pick("p_partkey", PRODUCTS)
    df = t.part.select("p_partkey", C.product_category(p).alias("category"), C.product_rank(p).alias("product_rank"))
    return df.withColumn("delivery", C.delivery("category"))


@query("cls_15_path_events", r"""
SELECT page_id, 'paged_view' AS event_type FROM pages WHERE regexp_full_match(url, 'https?://[^/]+/[a-z]{2}/[0-9]+.*') AND NOT regexp_full_match(url, '.*#top')
UNION ALL SELECT page_id, 'blog_view' FROM pages WHERE regexp_full_match(url, 'https?://blog\..*')
UNION ALL SELECT page_id, 'campaign_view' FROM pages WHERE regexp_full_match(url, '.*[?&]utm_source=.*') AND NOT regexp_full_match(url, 'https?://m\..*')""")
def _(t):
    specs = {
        "paged_view": (["https?://[^/]+/[a-z]{2}/[0-9]+.*"], [".*#top"]),
        "blog_view": ([r"https?://blog\..*"], []),
        "campaign_view": ([".*[?&]utm_source=.*"], [r"https?://m\..*"]),
    }
    return C.path_events(t.pages.select("page_id", "url"), "url", specs).drop("url")


BACKENDS = ["main_https_git", "registry", "api", "canary_web", "pages_http", "pages_https", "websockets", "ssh", "sshx"]
BACKEND_OUT = ["HTTPs Git Data Transfer", "Registry Data Transfer", "API Data Transfer", "Web Data Transfer", "Pages Data Transfer", "Pages Data Transfer",
               "WebSockets Data Transfer", "SSH Data Transfer", "TBD"]


@query("cls_16_backend_category", f"SELECT event_id, {sql_pick('user_id', BACKEND_OUT)} AS category FROM events")
def _(t):
    return t.events.select("event_id", C.backend_category(pick("user_id", BACKENDS)).alias("category"))


@query("cls_17_sla_met", """
SELECT event_id, coalesce((m <= 30 AND p = 'urgent') OR (m <= lim AND p <> 'urgent') OR (p <> 'urgent' AND dow = 5 AND h >= fri AND m <= 2880 + lim) OR (p <> 'urgent' AND dow = 6)
 OR (dow = 0 AND m <= 2880 + 1440), false) AS sla_met FROM (SELECT *, CASE p WHEN 'high' THEN 240 WHEN 'normal' THEN 480 WHEN 'low' THEN 1440 END AS lim, CASE p WHEN 'high' THEN 20 WHEN 'normal' THEN 16 ELSE 1 END AS fri
 FROM (SELECT event_id, ['urgent','high','normal','low'][CAST(user_id % 4 AS INTEGER) + 1] AS p, CAST(floor(value * 30) AS BIGINT) AS m, dayofweek(ts) AS dow, hour(ts) AS h FROM events))""")
def _(t):
    df = t.events.select("event_id", "ts", pick("user_id", ["urgent", "high", "normal", "low"]).alias("p"), F.floor(F.col("value") * 30).alias("m"))
    return df.select("event_id", C.sla_met("p", "ts", "m").alias("sla_met"))


@query("cls_18_nps", """
SELECT user_id, CAST(SUM(w) AS BIGINT) AS nps_sum, COUNT(*) FILTER (b = 'promoter') AS promoters, round(SUM(w)::DOUBLE / COUNT(*), 6) AS nps FROM
 (SELECT user_id, CASE WHEN s >= 9 THEN 'promoter' WHEN s >= 7 THEN 'passive' ELSE 'detractor' END AS b, CASE WHEN s >= 9 THEN 100 WHEN s >= 7 THEN 0 ELSE -100 END AS w
  FROM (SELECT user_id, CAST(floor(value) AS BIGINT) % 11 AS s FROM events)) GROUP BY 1""")
def _(t):
    text, weight = C.nps("s")
    df = t.events.select("user_id", (F.floor("value") % 11).alias("s")).select("user_id", text.alias("b"), weight.alias("w"))
    return df.groupBy("user_id").agg(F.sum("w").alias("nps_sum"), F.count_if(F.col("b") == "promoter").alias("promoters"),
                                     F.round(F.sum("w").cast("double") / F.count(F.lit(1)), 6).alias("nps"))


@query("cls_19_severity", """
SELECT o_orderkey, CASE WHEN k = 4 OR p IN (1) THEN 'S1' WHEN k = 3 OR p = 2 THEN 'S2' WHEN k = 2 OR p = 3 THEN 'S3' WHEN k = 1 OR p = 4 THEN 'S4' END AS severity
FROM (SELECT o_orderkey, o_orderkey % 9 AS k, CAST(o_orderpriority[1] AS INTEGER) AS p FROM orders)""")
def _(t):
    label = F.concat(F.lit("severity::"), F.substring("o_orderpriority", 1, 1))
    return t.orders.select("o_orderkey", C.severity(F.array(F.lit("bug"), label), F.col("o_orderkey") % 9).alias("severity"))


VERSIONS = ["13.9.2-ee", "14.0.0-pre", "12.10.1", "v15.3", ""]


@query("cls_20_version_parts", f"""
SELECT event_id, nullif(regexp_replace(v, '[^0-9.]', '', 'g'), '') AS cleaned_version, lower(v) LIKE '%-pre' AS is_prerelease, TRY_CAST(split_part(regexp_replace(v, '[^0-9.]', '', 'g'), '.', 1) AS INTEGER) AS major_version,
 TRY_CAST(split_part(regexp_replace(v, '[^0-9.]', '', 'g'), '.', 2) AS INTEGER) AS minor_version,
 TRY_CAST(split_part(regexp_replace(v, '[^0-9.]', '', 'g'), '.', 1) AS INTEGER) * 100 + TRY_CAST(split_part(regexp_replace(v, '[^0-9.]', '', 'g'), '.', 2) AS INTEGER) AS major_minor_version_id
FROM (SELECT event_id, {sql_pick('user_id', VERSIONS)} AS v FROM events)""")
def _(t):
    parts = version_parts(pick("user_id", VERSIONS))
    return t.events.select("event_id", *[c.alias(n) for n, c in parts.items() if n != "major_minor_version"])


@query("cls_21_slugify", r"""
SELECT doc_id, trim(lower(regexp_replace(regexp_replace(regexp_replace(text, '\s+\|{2}\s+', '|', 'g'), '[ ]{2,}', ' ', 'g'), '[^A-Za-z0-9|]', '-', 'g'))) AS slug,
 md5(trim(lower(regexp_replace(regexp_replace(regexp_replace(text, '\s+\|{2}\s+', '|', 'g'), '[ ]{2,}', ' ', 'g'), '[^A-Za-z0-9|]', '', 'g')))) AS bare_md5 FROM documents""")
def _(t):
    return t.documents.select("doc_id", slugify("text").alias("slug"), F.md5(slugify("text", "")).alias("bare_md5"))


@query("cls_22_growth_type", f"""
SELECT c_custkey, CASE WHEN o IS NULL THEN 'Missing growth_type' WHEN o NOT LIKE '1.%' AND b = 0 THEN 'Add-On Growth' WHEN left(o, 1) IN ('2','3') THEN 'Growth on Renewal' WHEN left(o, 1) IN ('4','5') AND b <> 0 THEN 'Contraction on Renewal'
 WHEN left(o, 1) = '6' AND b <> 0 THEN 'Lost on Renewal' ELSE 'Missing growth_type' END AS growth FROM (SELECT c_custkey, {sql_pick('c_custkey', ORDER_TYPES)} AS o, c_nationkey % 3 AS b FROM customer)""")
def _(t):
    return t.customer.select("c_custkey", C.growth_type(pick("c_custkey", ORDER_TYPES), F.col("c_nationkey") % 3).alias("growth"))


@query("cls_23_cluster_applications", """
SELECT l_orderkey, l_linenumber, l_partkey, o_custkey AS owner_id, o_orderstatus AS cluster_state FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def _(t):
    apps = t.lineitem.select(F.col("l_orderkey").alias("cluster_id"), "l_linenumber", "l_partkey")
    clusters = t.orders.select(F.col("o_orderkey").alias("cluster_id"), F.col("o_custkey").alias("owner_id"), F.col("o_orderstatus").alias("cluster_state"))
    return C.enrich_applications(apps, clusters, "cluster_id", ["owner_id", "cluster_state"]).withColumnRenamed("cluster_id", "l_orderkey")


@query("cls_24_certificates", """
SELECT s_suppkey, s_nationkey AS correct_responses, 25 AS total_responses, s_nationkey < 10 AS is_team_member,
 CASE WHEN s_nationkey < 10 THEN lower(s_name) || '@home.org' ELSE md5(' ' || s_name || '@x.org') END AS submitter_email, 'intro' AS certificate_name FROM supplier""")
def _(t):
    score = F.concat(F.lit(" "), F.col("s_nationkey").cast("string"), F.lit(" / 25"))
    email = F.concat(F.lit(" "), F.col("s_name"), F.when(F.col("s_nationkey") < 10, "@home.org").otherwise("@x.org"))
    df = t.supplier.select("s_suppkey", score.alias("score"), email.alias("email"))
    return C.certificates(df, "intro", "score", "email", "home.org").drop("score", "email")


@query("cls_25_opportunity_fields", """
SELECT o_orderkey, age_days, CASE WHEN age_days <= 6 THEN '[01] 0-6 Days' WHEN age_days <= 14 THEN '[02] 7-14 Days' WHEN age_days <= 21 THEN '[03] 15-21 Days' WHEN age_days <= 30 THEN '[04] 22-30 Days'
 WHEN age_days <= 60 THEN '[05] 31-60 Days' WHEN age_days <= 90 THEN '[06] 61-90 Days' WHEN age_days <= 120 THEN '[07] 91-120 Days' WHEN age_days <= 180 THEN '[08] 121-180 Days' WHEN age_days <= 365 THEN '[09] 181-365 Days'
 WHEN age_days <= 730 THEN '[10] 1-2 Years' WHEN age_days <= 1095 THEN '[11] 2-3 Years' ELSE '[12] 3+ Years' END AS age_bucket,
 CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_closed_won, CASE WHEN p >= 1 THEN 1 ELSE 0 END AS is_stage_1_plus,
 CASE WHEN o_custkey % 2 = 0 THEN 'Add-On Growth' ELSE 'Growth on Renewal' END AS growth_type, CASE WHEN o_totalprice < 20000 THEN 1 ELSE 0 END AS is_excluded
FROM (SELECT *, CAST(o_orderpriority[1] AS INTEGER) - 1 AS p, CASE WHEN o_orderstatus = 'O' OR TIMESTAMP '1999-06-30' < o_orderdate + INTERVAL 90 DAY
  THEN date_diff('day', o_orderdate, TIMESTAMP '1999-06-30') ELSE 90 END AS age_days FROM orders WHERE o_orderdate < TIMESTAMP '1999-06-30')""")
def _(t):
    as_of = F.lit("1999-06-30").cast("timestamp_ntz")
    df = t.orders.filter(F.col("o_orderdate") < as_of)
    stage = F.substring("o_orderpriority", 1, 1).cast("int") - 1
    closed = F.col("o_orderdate") + F.expr("INTERVAL 90 DAY")
    out = C.opportunity_fields(df, "o_orderdate", closed, as_of, F.col("o_orderstatus") == "O", F.col("o_orderstatus") == "F", stage,
                               (F.lit("3. Growth"), F.col("o_custkey") % 2), F.col("o_totalprice") < 20000)
    return out.select("o_orderkey", "age_days", "age_bucket", "is_closed_won", "is_stage_1_plus", "growth_type", "is_excluded")


MOTIONS = [
    ("Blog Push", [[("page", ["%//blog.%"]), ("kind", ["en", "fr"])]]),
    ("Paid", [[("page", ["%utm_source=%", "%ref=x%"])], [("kind", ["es"])]]),
    ("Mobile", [[("page", ["%//m.%"])]]),
]


@query("cls_26_motion", """
SELECT page_id, CASE WHEN url LIKE '%//blog.%' AND lang IN ('en','fr') THEN 'Blog Push' WHEN url LIKE '%utm_source=%' OR url LIKE '%ref=x%' OR lang = 'es' THEN 'Paid' WHEN url LIKE '%//m.%' THEN 'Mobile' ELSE 'None' END AS motion
FROM (SELECT page_id, url, split_part(url, '/', 4) AS lang FROM pages)""")
def _(t):
    inputs = {"page": ["url"], "kind": [F.split_part("url", F.lit("/"), F.lit(4))]}
    return C.motion(t.pages.select("page_id", "url"), "motion", MOTIONS, inputs, "None").drop("url")
