"""Labels of the classifiers, written out at the edges of their rules."""

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import classify as C

CASES = {
    "arr": (C.arr_bucket, "double", [(-1.0, "[00] < 0"), (0.0, "[01] 0-250"), (250.0, "[01] 0-250"), (250.01, "[02] 250-500"), (500.0, "[02] 250-500"), (1000.0, "[03] 500-1K"), (10000.0, "[06] 5K-10K"), (100000.0, "[09] 50K-100K"), (1000000.0, "[11] 500K-1M"), (1000001.0, "[12] 1M+"), (None, None)]),
    "days": (C.day_bucket, "int", [(0, "[01] 0-6 Days"), (6, "[01] 0-6 Days"), (7, "[02] 7-14 Days"), (15, "[03] 15-21 Days"), (30, "[04] 22-30 Days"), (31, "[05] 31-60 Days"), (90, "[06] 61-90 Days")]),
    "source category": (C.lead_source_category, "string", [("Free Registration", "Core"), ("OSS", "Marketing/Community"), ("Webcast", "Marketing/Inbound"), ("Conference", "Marketing/Outbound"), ("LinkedIn", "Prospecting"), ("Word of mouth", "Referral"), ("AE Generated", "Sales"), ("DiscoverOrg", "DiscoverOrg"), ("x", "Other")]),
    "source bucket": (C.lead_source_bucket, "string", [("CE Usage Ping", "core"), ("White Paper", "inbound"), ("Gemnasium", "outbound"), ("Gitorious", "outbound"), ("gmail", "outbound"), ("seamless.ai", "outbound"), ("Promotion", "paid demand gen"), ("Purchased List", "purchased list"), ("Event Partner", "referral"), ("Trial - Enterprise", "trial"), ("Webinar", "virtual event"), ("Web Direct", "web direct"), (None, "Other")]),
    "channel": (C.marketing_channel, "string", [("Direct", "Inbound Free Channels"), ("Display.Google", "Inbound Paid"), ("Unheard Of", "Other")]),
    "product": (C.product_category, "string", [("Gold plan", "SaaS - Ultimate"), ("silver", "SaaS - Premium"), ("Ultimate", "Self-Managed - Ultimate"), ("Bronze", "SaaS - Bronze"), ("Starter", "Self-Managed - Starter"), ("Plus 1", "Plus"), ("Basic", "Basic"), ("  GitHost Large", "GitHost"), (" Trueup ", "Trueup"), ("Admin Training", "Support"), ("CI Runner x", "SaaS - Other"), ("Discount", "Other"), ("x", "Not Applicable")]),
}


@pytest.mark.parametrize("name", CASES)
def test_labels(spark, name):
    fn, kind, rows = CASES[name]
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(rows)], f"i int, v {kind}").withColumn("label", fn(F.col("v")))
    assert [r["label"] for r in df.orderBy("i").collect()] == [want for _, want in rows]
