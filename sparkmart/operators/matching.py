"""Entity matching and attribution."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkmart.functions import as_col, ratio
from sparkmart.operators import classify as cls, topk, windows as wn
from sparkmart.operators.windows import join_back, window

# Weight of each kind of member.
WEIGHTS = {"creator": 0.60, "owner": 0.30, "user": 0.10}


def _zero(c):
    return F.coalesce(c, F.lit(0.0))


def match_score(df, group, org, role, user, weights=None) -> DataFrame:
    """Best organisation of each group with its score and match type.

    Members are counted distinct per (group, member) and per (group, organisation), one aggregate
    each; totals, the two largest organisations and the best one are windows over the latter, so a
    group weighs as many rows as organisations it touches, whatever its members. The match type
    grades how far creators, owners and users point at the same organisation (7 best, 0 none).
    """
    weights = weights or WEIGHTS
    d = df.select(as_col(group).alias("g"), as_col(org).alias("o"), as_col(role).alias("r"), as_col(user).alias("u")).distinct()
    person = d.groupBy("g", "u").agg(*[F.max((F.col("r") == k).cast("int")).alias(f"is_{k}") for k in weights])
    totals = person.groupBy("g").agg(F.count("u").alias("total_members"), *[F.coalesce(F.sum(f"is_{k}"), F.lit(0)).alias(f"total_{k}") for k in weights])
    per = d.filter("o IS NOT NULL").groupBy("g", "o").agg(*[F.count_if(F.col("r") == k).alias(f"n_{k}") for k in weights])
    s = per.join(totals, "g")
    nc, no, nu = F.col("n_creator"), F.col("n_owner"), F.col("n_user")
    both = lambda a, b: F.when((a > 0) & (b > 0), 1).otherwise(0)
    s = s.withColumn("org_members", nc + no + nu)
    s = s.withColumn("user_score", sum((_zero(ratio(f"n_{k}", f"total_{k}")) * w for k, w in weights.items()), F.lit(0.0)))
    s = s.withColumn("dominance", F.when(ratio("org_members", "total_members") > 0.5, 1).otherwise(0))
    s = s.withColumn("similarity", (both(nc, nu) + both(nc, no) + both(no, nu)).cast("double") / 3)
    s = s.withColumn("combined_score", (F.col("user_score") + F.col("dominance") + F.col("similarity")) / 3 * 100)
    s = s.withColumn("orgs", F.count(F.lit(1)).over(window("g")))
    for name, c in (("user", nu), ("owner", no)):
        by_size = window("g", [c.desc(), "o"], wn.FULL)
        s = s.withColumns({f"top_{name}": F.first(c).over(by_size), f"second_{name}": F.coalesce(F.nth_value(c, 2).over(by_size), F.lit(0))})
    best = topk.latest_per_key(s, ["g"], [F.desc("combined_score"), F.asc("o")])
    creator, owner, has_user = nc > 0, no > 0, nu > 0
    top_user, top_owner = nu == F.col("top_user"), no == F.col("top_owner")
    clear_user, clear_owner = F.col("top_user") > F.col("second_user"), F.col("top_owner") > F.col("second_owner")
    only = F.col("orgs") == 1
    most_users = F.round(_zero(ratio("org_members", "total_members")), 2) >= 0.5
    most_owners = F.round(_zero(ratio("n_owner", "total_owner")), 2) >= 0.5
    ladder = [
        ((creator | owner) & top_user & only & most_users, 7),
        (creator & top_user & only, 6),
        ((creator | owner) & top_user & clear_user & most_users, 6),
        (owner & top_owner & clear_owner & most_owners, 5),
        ((owner & creator & clear_owner) | (creator & has_user & clear_user), 4),
        (creator & (has_user | owner), 3),
        (owner, 2),
        (has_user, 1),
    ]
    best = best.withColumn("match_type", cls.case(ladder, 0))
    return best.select(F.col("g").alias("group_id"), F.col("o").alias("org_id"), "org_members", "total_members", "user_score", "similarity", "dominance", "combined_score", "match_type")


# Weights of first touch, lead-creation touch, conversion touch and of all others together.
MODELS = {"first": (1.0, 0.0, 0.0, 0.0), "lead": (0.0, 1.0, 0.0, 0.0), "u": (0.5, 0.5, 0.0, 0.0), "w": (0.3, 0.3, 0.3, 0.1)}


def attribute(touches, conversions, key, ts, touch, lead_at, converted_at, value, model="w") -> DataFrame:
    """Multi-touch attribution of one conversion per key.

    The lead touch and the conversion touch are the last ones up to those times. The
    rest weight goes to the other touches in equal parts, or back to the anchors when
    there are none. Anchors come from one aggregate per key, so no key's touches are
    collected or ordered.
    """
    weights = MODELS[model] if isinstance(model, str) else model
    t = touches.join(conversions, key).filter(as_col(ts) <= as_col(converted_at))
    order = F.struct(as_col(ts), as_col(touch))
    lead = as_col(ts) <= as_col(lead_at)
    anchors = t.groupBy(key).agg(F.min(order).alias("__first"), F.max(F.when(lead, order)).alias("__lead"), F.max(order).alias("__conv"), F.count(F.lit(1)).alias("__n"))
    t = join_back(t, anchors.withColumn("__lead", F.coalesce("__lead", "__first")), [key])
    flags = [F.col(c) == order for c in ("__first", "__lead", "__conv")]
    used = F.size(F.array_distinct(F.array("__first", "__lead", "__conv"))) if weights[2] else F.size(F.array_distinct(F.array("__first", "__lead")))
    others = F.col("__n") - used
    anchor_sum = sum(weights[:3])
    scale = F.when(others > 0, F.lit(1.0)).otherwise(F.lit((anchor_sum + weights[3]) / anchor_sum))
    anchored = sum((F.when(f, w).otherwise(0.0) for f, w in zip(flags, weights)), F.lit(0.0)) * scale
    is_anchor = flags[0] | flags[1] | (flags[2] if weights[2] else F.lit(False))
    weight = F.when(is_anchor, anchored).when(others > 0, F.lit(weights[3]) / others).otherwise(0.0)
    return t.withColumn("weight", weight).withColumn("attributed", F.col("weight") * as_col(value)).drop("__first", "__lead", "__conv", "__n")


def linear_attribution(touches, key, touch, campaign, value) -> DataFrame:
    """Deal value split evenly over its touches and over its campaigns."""
    out = wn.partition_agg(touches, key, touch_count=F.count_distinct(touch), campaign_count=F.count_distinct(campaign))
    return out.withColumn("value_per_touch", ratio(value, "touch_count")).withColumn("value_per_campaign", ratio(value, "campaign_count"))


def pre_conversion_weights(df, person, touch, ts, converted_at) -> DataFrame:
    """1/n for each touch up to the first conversion, 0 afterwards."""
    before = as_col(ts) <= as_col(converted_at)
    base = df.filter(as_col(converted_at).isNotNull()).select(person, touch, ts, converted_at).distinct()
    out = wn.partition_agg(base, [person], __n=F.count_distinct(F.when(before, as_col(touch))))
    return out.withColumn("weight", F.when(before, 1 / F.col("__n")).otherwise(0.0)).drop("__n")
