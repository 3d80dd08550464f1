"""Rule classifiers: every rule table compiles to one CASE expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkmart.functions import as_col, boundary_diff, day_of_week, like_any, pad_both, rlike_full
from sparkmart.operators import rules as R
from sparkmart.operators import windows as wn


def case(rules, default=None) -> Column:
    """First matching (condition, value) pair; value may be a literal or a column."""
    out = None
    for cond, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    if default is not None:
        out = out.otherwise(default if isinstance(default, Column) else F.lit(default))
    return out


def classify(df: DataFrame, output: str, rules, default=None) -> DataFrame:
    return df.withColumn(output, case(rules, default))


# -------------------------------------------------------------- rule kinds

def ranges(c, table) -> list:
    c = as_col(c)
    out = []
    for low, high, label, *strict in table:
        cond = F.lit(True)
        if low is not None:
            cond = cond & (c >= low)
        if high is not None:
            cond = cond & (c < high if strict else c <= high)
        out.append((cond, label))
    return out


def below(c, table) -> list:
    c = as_col(c)
    return [(c.isNotNull() if bound is None else c < bound, label) for bound, label in table]


def members(c, table: dict) -> list:
    return [(as_col(c).isin(*values), label) for label, values in table.items()]


def likes(c, table) -> list:
    return [(like_any(F.lower(as_col(c)), patterns), label) for patterns, label in table]


def regexes(c, table) -> list:
    return [(rlike_full(c, pattern), label) for pattern, label in table]


def enum(c, table: dict) -> Column:
    """Id to name; unknown ids become NULL."""
    return case([(as_col(c) == key, name) for key, name in table.items()])


# -------------------------------------------------------------- named classifiers

def arr_bucket(c) -> Column:
    """0 sits in the first bucket and a shared edge in the lower one."""
    return case(ranges(c, R.ARR_BUCKETS))


def day_bucket(c) -> Column:
    return case(ranges(c, R.DAY_BUCKETS))


def seat_bucket(c) -> Column:
    return case(ranges(c, R.SEAT_BUCKETS))


def deal_size(c) -> Column:
    return case(below(c, R.DEAL_SIZES), "5 - Unknown")


def arr_segmentation(df, arr, level_cols=(), chunk=None) -> DataFrame:
    """Value segment, rank by value within the level and rank segment."""
    arr = as_col(arr)
    df = wn.rank_of_value(df, "arr_rank", list(level_cols), arr, descending=True, chunk=chunk)
    df = classify(df, "arr_segmentation", below(arr, R.ARR_SEGMENTS))
    return classify(df, "rank_segmentation", below("arr_rank", R.RANK_SEGMENTS))


def sales_segment(c, unify_public=False, keep_case=False) -> Column:
    c = as_col(c)
    low = F.lower(c)
    rules = [(low == "smb", "SMB"), (low.like("mid%market"), "Mid-Market"), (low == "unknown", "SMB"),
             (low.isNull(), "SMB"), (low == "pubsec", "PubSec")]
    if unify_public:
        rules.append((low == "public sector", "PubSec"))
    return case(rules, c if keep_case else F.initcap(c))


def segment_region(segment, geo, region) -> Column:
    """Large and public-sector segments split by geography, others stay whole."""
    segment, geo, region = as_col(segment), as_col(geo), as_col(region)
    large = segment.isin("Large", "PubSec")
    return case([
        (large & (geo == "AMER") & (F.lower(region) == "west"), "US West"),
        (large & geo.isin("AMER", "LATAM") & F.lower(region).isin("east", "latam"), "US East"),
        (large & geo.isin("APAC", "PubSec", "EMEA", "Global"), geo),
        (large & (region == "PubSec"), "PubSec"),
        (large & ~geo.isin("West", "East", "APAC", "PubSec", "EMEA", "Global"), "Large Other"),
        (~large, segment),
    ], "Missing segment_region_grouped")


def qualified_source(c) -> Column:
    c = as_col(c)
    return case([(c == "BDR Generated", "SDR Generated")], c)


def lead_source_category(c, own: dict | None = None) -> Column:
    return case(members(c, {**(own or {}), **R.LEAD_SOURCE_CATEGORY}), "Other")


def lead_source_bucket(c, own: dict | None = None) -> Column:
    return case(members(c, {**(own or {}), **R.LEAD_SOURCE_BUCKET}), "Other")


def marketing_channel(c) -> Column:
    return case(members(c, R.MARKETING_CHANNEL), "Other")


def alliance_type(name, partner, short=False) -> Column:
    table = [(p, s if short else full) for p, full, s in R.ALLIANCE]
    rest = "Non-Alliance" if short else "Non-Alliance Partners"
    return case([*likes(name, table), (as_col(partner).isNotNull(), rest)])


def channel_type(engagement, order_type) -> Column:
    engagement = as_col(engagement)
    first = as_col(order_type).eqNullSafe("1. New - First Order")
    return case([
        ((engagement == "Partner Sourced") & first, "Sourced - New"),
        (engagement == "Partner Sourced", "Sourced - Growth"),
        ((engagement == "Co-sell") & first, "Co-sell - New"),
        (engagement == "Co-sell", "Co-sell - Growth"),
    ])


def email_domain_type(domain, lead_source, partial, full, bulk=R.BULK_LEAD_SOURCES) -> Column:
    """Personal, business, missing or bulk-loaded; `partial`/`full` come from a seed of personal providers."""
    domain = as_col(domain)
    return case([
        (as_col(lead_source).isin(*bulk), "Bulk load or list purchase or spam impacted"),
        (domain.isNull(), "Missing email domain"),
        (like_any(domain, [f"%{p}%" for p in partial]) | domain.isin(*full), "Personal email domain"),
    ], "Business email domain")


def job_title_level(c) -> Column:
    title = F.lower(as_col(c))
    padded = pad_both(title)
    word = lambda w: F.array_contains(F.split(title, " "), w) | F.array_contains(F.split(title, ","), w)
    decider = like_any(padded, R.JOB_DECIDER_PATTERNS)
    for w in R.JOB_DECIDER_WORDS:
        decider = decider | word(w)
    project = F.array_contains(F.split(title, " "), "project")
    return case([
        (decider, "IT Decision Maker"),
        (like_any(padded, R.JOB_MANAGER_PATTERNS) & ~project, "IT Manager"),
        (like_any(padded, R.JOB_WORKER_PATTERNS), "IT Individual Contributor"),
    ])


def grouped(c, groups) -> Column:
    """Members of a group carry the group's joined name, others their own."""
    c = as_col(c)
    return case([(c.isin(*g), ", ".join(g)) for g in groups], c)


def product_category(c, own=()) -> Column:
    """`own` adds (patterns, label) rules for a company's own product names."""
    rules = [*likes(c, R.PRODUCT_CATEGORY), *likes(F.ltrim(as_col(c)), R.PRODUCT_CATEGORY_LEADING), *members(F.trim(as_col(c)), R.PRODUCT_CATEGORY_NAMES), *likes(c, own)]
    return case(rules, "Not Applicable")


def delivery(category) -> Column:
    return case([*likes(category, R.DELIVERY), *members(category, R.DELIVERY_NAMES)])


def product_rank(c) -> Column:
    return F.coalesce(enum(c, R.PRODUCT_RANK), F.lit(0))


def backend_category(c) -> Column:
    return case(regexes(c, R.BACKEND_CATEGORY), "TBD")


def path_events(df, path, specs) -> DataFrame:
    """One output row per event name whose include patterns match and exclude patterns do not.

    specs: {event: (include patterns, exclude patterns)}, whole-string regexes.
    A single scan tests all events.
    """
    hits = []
    for name, (include, exclude) in specs.items():
        cond = F.lit(True)
        for p in include:
            cond = cond & rlike_full(path, p)
        for p in exclude:
            cond = cond & ~rlike_full(path, p)
        hits.append(F.when(cond, F.lit(name)))
    return df.withColumn("event_type", F.explode(F.array_compact(F.array(*hits))))


def sla_met(priority, created_at, reply_minutes) -> Column:
    """Was the first reply in time?

    Urgent tickets run round the clock, others skip the weekend. The weekend rule
    groups as (priority AND Saturday) OR (Sunday AND in time): AND binds first, so
    Saturday tickets pass untimed and Sunday ones pass whatever their priority.
    """
    priority, created, reply = as_col(priority), as_col(created_at), as_col(reply_minutes)
    dow, hour = day_of_week(created), F.hour(created)
    met = (reply <= R.URGENT_MINUTES) & (priority == "urgent")
    for p, minutes in R.SLA_MINUTES.items():
        over_weekend = R.WEEKEND_MINUTES + minutes
        met = met | ((reply <= minutes) & (priority == p))
        met = met | ((priority == p) & (dow == 5) & (hour >= R.SLA_FRIDAY_HOUR[p]) & (reply <= over_weekend))
        met = met | (((priority == p) & (dow == 6)) | ((dow == 0) & (reply <= over_weekend)))
    return F.coalesce(met, F.lit(False))


def nps(score) -> tuple[Column, Column]:
    """Bucket text and its +100 / 0 / -100 weight."""
    text = case([(as_col(score) >= 9, "promoter"), (as_col(score) >= 7, "passive"), (as_col(score) >= 0, "detractor")])
    return text, enum(text, {"promoter": 100, "passive": 0, "detractor": -100})


def severity(labels, level=None) -> Column:
    """S1…S4 from an enum (4 is the gravest) or a label array."""
    labels = as_col(labels)
    rules = []
    for i in (1, 2, 3, 4):
        cond = F.array_contains(labels, f"severity::{i}") | F.array_contains(labels, f"s{i}")
        if level is not None:
            cond = (as_col(level) == 5 - i) | cond
        rules.append((cond, f"S{i}"))
    return case(rules)


def growth_type(order_type, arr_basis) -> Column:
    order_type, basis = as_col(order_type), as_col(arr_basis)
    new, contraction, partial, final = "1. New - First Order", "4. Contraction", "5. Churn - Partial", "6. Churn - Final"
    return case([
        ((order_type != new) & (basis == 0), "Add-On Growth"),
        (~order_type.isin(new, contraction, partial, final) & (basis != 0), "Growth on Renewal"),
        (order_type.isin(contraction, partial) & (basis != 0), "Contraction on Renewal"),
        ((order_type == final) & (basis != 0), "Lost on Renewal"),
    ], "Missing growth_type")


def enrich_applications(apps, clusters, key, cols) -> DataFrame:
    """Per-application rows with the owner columns of their cluster."""
    return apps.join(clusters.select(key, *cols), key)


def certificates(df, name, score, email, domain) -> DataFrame:
    """Split 'right / total' scores; outside addresses are hashed."""
    inside = F.coalesce(F.lower(as_col(email)).like(f"%@{domain}"), F.lit(False))
    part = lambda i: F.trim(F.split_part(as_col(score), F.lit("/"), F.lit(i))).try_cast("int")
    return (
        df.withColumn("correct_responses", part(1)).withColumn("total_responses", part(2))
        .withColumn("is_team_member", inside)
        .withColumn("submitter_email", F.when(inside, F.trim(F.lower(as_col(email)))).otherwise(F.md5(as_col(email))))
        .withColumn("certificate_name", F.lit(name))
    )


def opportunity_fields(df, created, closed, as_of, is_open, is_won, stage, basis_order, excluded) -> DataFrame:
    """Age, stage flags and exclusion of opportunity snapshots.

    An opportunity ages to the snapshot date while open or not yet closed at
    that date, and to its close date afterwards.
    """
    created, closed, as_of = as_col(created), as_col(closed), as_col(as_of)
    running = as_col(is_open) | (as_of < closed)
    return (
        df.withColumn("age_days", F.when(running, boundary_diff("day", created, as_of)).otherwise(boundary_diff("day", created, closed)))
        .withColumn("age_bucket", day_bucket("age_days"))
        .withColumn("is_closed_won", (as_col(is_won) & ~as_col(is_open)).cast("int"))
        .withColumn("is_stage_1_plus", (as_col(stage) >= 1).cast("int"))
        .withColumn("growth_type", growth_type(basis_order[0], basis_order[1]))
        .withColumn("is_excluded", F.coalesce(excluded, F.lit(False)).cast("int"))
    )


def motion(df, output, rules, inputs: dict, default=None) -> DataFrame:
    """Go-to-market motion: each rule names a label and alternatives; an alternative
    is a list of (input, patterns) tests that must all hold."""
    compiled = []
    for label, alternatives in rules:
        cond = F.lit(False)
        for tests in alternatives:
            both = F.lit(True)
            for name, patterns in tests:
                one = F.lit(False)
                for c in inputs[name]:
                    one = one | F.coalesce(like_any(c, patterns), F.lit(False))
                both = both & one
            cond = cond | both
        compiled.append((cond, label))
    return classify(df, output, compiled, default)
