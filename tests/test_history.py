"""SCD, snapshots and hierarchies on hand-made rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import hierarchy as H, scd as S, windows as wn

T0 = 1_577_836_800  # 2020-01-01


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_scd_type_2(spark):
    day = 86400
    raw = spark.createDataFrame(
        [(1, "a", T0, "t1"), (1, "a", T0 + day, "t2"), (1, "b", T0 + 2 * day, "t3"), (2, "x", T0, "t1"), (2, "x", T0 + day, "t2"), (3, "z", T0 + 2 * day, "t3")],
        "id int, v string, _uploaded_at long, _task_instance string")
    got = rows(S.scd_type_2(S.distinct_source(raw), "id"), "id", "v", "valid_to", "is_currently_valid")
    assert got == sorted([
        (1, "a", datetime(2020, 1, 2, 23, 59, 59, 999000), False), (1, "b", None, True),
        (2, "x", datetime(2020, 1, 2), False), (3, "z", None, True)], key=str)
    assert rows(S.scd_type_2(S.distinct_source(raw), "id", chunk=wn.HotKeys(F.to_date("valid_from"), 1)), "id", "v", "valid_to", "is_currently_valid") == got


def test_snapshots(spark):
    at = lambda d: datetime(2020, 1, d)
    schema = "id int, v string, updated_at timestamp_ntz"
    first = spark.createDataFrame([(1, "a", at(1)), (2, "b", at(1)), (3, None, at(1))], schema)
    second = spark.createDataFrame([(1, "a2", at(2)), (3, "c", at(1)), (4, "n", at(2))], schema)
    for hard in (False, True):
        prev = S.snapshot_ts(S.empty_snapshot(first), first, "id", "updated_at", at(1), hard)
        nxt = S.snapshot_ts(prev, second, "id", "updated_at", at(3), hard)
        got = rows(nxt, "id", "v", "valid_from", "valid_to")
        # 3 kept its updated_at, so the timestamp strategy sees no change.
        assert got == sorted([(1, "a", at(1), at(2)), (1, "a2", at(2), None), (2, "b", at(1), at(3) if hard else None), (3, None, at(1), None), (4, "n", at(2), None)], key=str)
        assert nxt.select("scd_id").distinct().count() == nxt.count()
    prev = S.snapshot_check(S.empty_snapshot(first), first, "id", ["v"], at(1))
    nxt = S.snapshot_check(prev, second, "id", ["v"], at(3))
    assert rows(nxt, "id", "v", "valid_from", "valid_to") == sorted(
        [(1, "a", at(1), at(3)), (1, "a2", at(3), None), (2, "b", at(1), None), (3, None, at(1), at(3)), (3, "c", at(3), None), (4, "n", at(3), None)], key=str)
    again = S.snapshot_check(nxt, second, "id", ["v"], at(4))
    assert rows(again, "id", "v", "valid_from", "valid_to") == rows(nxt, "id", "v", "valid_from", "valid_to")


def test_overlap_audits(spark):
    at = lambda m, d=1: datetime(2020, m, d)
    df = spark.createDataFrame([(1, 1, at(1), at(3)), (1, 2, at(2), at(4)), (2, 3, at(1), at(2)), (2, 4, at(3), None), (3, 5, at(1), None), (3, 6, at(6), None)],
                               "id int, n int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    assert rows(S.overlaps(df, "id", "n"), "n") == [(2,), (6,)]
    assert rows(S.overlaps_on(df, "id", ["2020-02-15", "2020-07-01"]), "id", "valid_rows") == [(1, 2), (3, 2)]
    assert rows(S.multi_current(df.withColumn("is_currently_valid", F.col("valid_to").isNull()), "id"), "id") == [(3,)]


def test_lineage_with_lost_parents_and_cycles(spark):
    deep = [(i, i - 1 if i > 100 else None) for i in range(100, 140)]
    df = spark.createDataFrame([(1, None), (2, 1), (3, 2), (5, 99), (6, 5), (0, None), (10, 11), (11, 12), (12, 10), (13, 10)] + deep, "id long, parent_id long")
    got = {r["id"]: (r["lineage"], r["ultimate_parent_id"], r["is_currently_valid"]) for r in H.lineage(df, "id", "parent_id").collect()}
    assert got[3] == ([1, 2, 3], 1, True) and got[6] == ([99, 5, 6], 99, True) and got[99] == ([99], 99, False)
    assert got[139][0] == list(range(100, 140))
    assert not {0, 10, 11, 12, 13} & set(got)


def test_temporal_lineage(spark):
    at = lambda d: datetime(2020, 1, d)
    df = spark.createDataFrame([(1, None, at(1), at(10)), (2, 1, at(5), at(20)), (3, 2, at(8), at(9)), (3, 2, at(12), at(15)), (4, 5, at(1), at(9)), (5, 4, at(1), at(9))],
                               "id long, parent_id long, f timestamp_ntz, t timestamp_ntz")
    got = rows(H.lineage_scd(df, "id", "parent_id", "f", "t"), "id", "lineage", "lineage_valid_from", "lineage_valid_to")
    assert got == sorted([(1, [1], at(1), at(10)), (2, [1, 2], at(5), at(10)), (3, [1, 2, 3], at(8), at(9))], key=str)


def test_chains_and_renewals(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (3, None), (4, 77), (5, 6), (6, 5)], "id long, nxt long")
    got = {r["id"]: (r["chain"], r["last_id"], r["is_moved"]) for r in H.resolve_chain(df, "id", "nxt").collect()}
    assert got == {1: ([1, 2, 3], 3, True), 2: ([2, 3], 3, True), 3: ([3], 3, False)}
    subs = spark.createDataFrame([("a", ["b", "c"]), ("b", None), ("c", ["d"]), ("d", None)], "id string, nxt array<string>")
    lin = {r["id"]: r["lineage"] for r in H.renewal_lineage(subs, "id", "nxt").collect()}
    assert lin == {"a": "a,b,c,d", "b": "b", "c": "c,d", "d": "d"}


def test_checkpoint_dir_needs_a_shared_folder(spark, monkeypatch):
    from sparkmart import session

    class Fake:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class FakeSpark:
        sparkContext = Fake()

        class conf:  # noqa: N801
            @staticmethod
            def get(*_):
                return None

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(FakeSpark())


def test_longest_renewals_without_all_paths(spark):
    def chosen(out):
        return {r["id"]: r["lineage"] for r in out.collect()}

    # Ten levels of six nodes, all linked: 6 ** 9 paths from each node of the first.
    levels = [[10 * (k + 1) + i for i in range(6)] for k in range(10)]
    full = [(n, levels[k + 1] if k < 9 else None) for k, held in enumerate(levels) for n in held]
    lin = chosen(H.renewal_lineage(spark.createDataFrame(full, "id int, nxt array<int>"), "id", "nxt"))
    assert lin["10"] == ",".join(map(str, [10, *levels[1], *[x[0] for x in levels[2:]]])) and lin["105"] == "105" and len(lin) == 60
    # A cycle, a missing node, a dead end and a NULL among the renewals.
    odd = [(1, [2, 5]), (2, [3]), (3, [1, 4]), (4, None), (5, [99]), (6, [5, 4]), (7, [None, 4])]
    best = {r["id"]: r["path"] for r in H._longest(spark.createDataFrame([(str(i), n and [None if x is None else str(x) for x in n]) for i, n in odd], "id string, renewals array<string>")).collect()}
    assert best == {"1": ["1", "2", "3", "4"], "2": ["2", "3", "4"], "3": ["3", "4"], "4": ["4"], "6": ["6", "4"], "7": ["7", "4"]}
