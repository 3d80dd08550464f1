"""Hierarchies, resolved by path doubling.

A recursive query walks one level per step. Here every node holds a partial path
and the node its path continues at; joining the paths to themselves doubles their
length, so a chain of length d needs log2(d) joins. State is checkpointed to the
shared checkpoint folder between steps, which cuts the lineage and survives a lost
executor. Paths that meet themselves are dropped, so cycles end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from sparkmart.functions import as_col
from sparkmart.operators import topk, windows as wn
from sparkmart.session import ensure_checkpoint_dir


def _double(start: DataFrame, extra: dict[str, Callable] | None = None, keep: Callable[[], Column] | None = None) -> DataFrame:
    """Complete paths from rows (id, path, next[, extras]).

    extra: {column: merge(lower, upper)} folded along the path; `keep` is a
    test on the merged row. Paths whose next node does not exist are dropped.
    """
    extra = extra or {}
    ensure_checkpoint_dir(start.sparkSession)
    state = start.checkpoint()
    done, hop, going = state.filter("next IS NULL"), state, state.filter("next IS NOT NULL")
    while not going.isEmpty():
        up = hop.select(F.col("id").alias("__id"), F.col("path").alias("__path"), F.col("next").alias("__next"), *[F.col(c).alias(f"__{c}") for c in extra])
        step = going.join(up, F.col("next") == F.col("__id")).filter(~F.arrays_overlap("path", "__path"))
        merged = step.select("id", F.concat("path", "__path").alias("path"), F.col("__next").alias("next"),
                             *[merge(F.col(c), F.col(f"__{c}")).alias(c) for c, merge in extra.items()])
        if keep is not None:
            merged = merged.filter(keep())
        merged = merged.checkpoint()
        # A path of 2^k hops goes on at a node whose own paths have 2^k hops or have ended.
        hop = merged.unionByName(done)
        done = done.unionByName(merged.filter("next IS NULL"))
        going = merged.filter("next IS NOT NULL")
    return done


def lineage(df, id_col, parent_col) -> DataFrame:
    """Root-first lineage of every node, its ultimate parent and whether it still exists.

    Parents missing from the table become roots so that their children are kept;
    id 0 is no node.
    """
    nodes = df.select(as_col(id_col).alias("id"), as_col(parent_col).alias("next"))
    present = nodes.select("id")
    lost = (nodes.filter("next IS NOT NULL").select(F.col("next").alias("id")).distinct().join(present, "id", "left_anti")
            .withColumn("next", F.lit(None).cast(nodes.schema["next"].dataType)).withColumn("valid", F.lit(False)))
    start = nodes.withColumn("valid", F.lit(True)).unionByName(lost).withColumn("path", F.array("id"))
    paths = _double(start.select("id", "path", "next", "valid"), {"valid": lambda low, high: low})
    out = paths.select("id", F.reverse("path").alias("lineage"), "valid").filter("id <> 0")
    return out.select(
        F.col("id").alias(id_col), F.when(F.size("lineage") > 1, F.element_at("lineage", -2)).alias(parent_col), "lineage",
        F.col("lineage")[0].alias("ultimate_parent_id"), F.size("lineage").alias("depth"), F.col("valid").alias("is_currently_valid"))


def lineage_scd(df, id_col, parent_col, start, end) -> DataFrame:
    """Lineages through versioned parents, valid while every hop is: latest start to
    earliest end. Paths without a common time are dropped as soon as they appear."""
    state = df.select(as_col(id_col).alias("id"), F.array(as_col(id_col)).alias("path"), as_col(parent_col).alias("next"),
                      as_col(start).alias("lo"), as_col(end).alias("hi")).filter("hi > lo")
    paths = _double(state, {"lo": F.greatest, "hi": F.least}, keep=lambda: F.col("hi") > F.col("lo"))
    up = F.reverse("path")
    return paths.select(F.col("id").alias(id_col), up.alias("lineage"), up[0].alias("ultimate_parent_id"), F.size("path").alias("depth"),
                        F.col("lo").alias("lineage_valid_from"), F.col("hi").alias("lineage_valid_to"))


def resolve_chain(df, id_col, next_col) -> DataFrame:
    """Follow 'moved to' pointers to the last record."""
    state = df.select(as_col(id_col).alias("id"), F.array(as_col(id_col)).alias("path"), as_col(next_col).alias("next"))
    last = F.element_at("path", -1)
    return _double(state).select(F.col("id").alias(id_col), F.col("path").alias("chain"), last.alias("last_id"), (last != F.col("id")).alias("is_moved"))


def _longest(nodes: DataFrame) -> DataFrame:
    """(id, path): the longest path from each node to a leaf, ties to the smallest text.

    Level by level from the leaves: a node is settled once all its successors are, so there is one row
    per node and one checkpointed join per level. What leads into a cycle is never settled; only there
    are paths enumerated, without those that meet themselves. Paths to missing nodes are dropped.
    """
    ensure_checkpoint_dir(nodes.sparkSession)
    linked = nodes.select("id", F.explode_outer("renewals").alias("next")).distinct().checkpoint()
    edges = linked.join(linked.select(F.col("id").alias("next")).distinct(), "next", "left_semi").select("id", "next").checkpoint()
    order = F.when(F.col("path").isNotNull(), F.struct(-F.size("path"), F.array_join("path", ",")))
    # Per node: successors still open, and the best path so far.
    ends = linked.select("id", F.lit(0).cast("long").alias("open"), F.when(F.col("next").isNull(), F.array("id")).alias("path"))
    state = ends.unionByName(edges.select("id", F.lit(1).cast("long").alias("open"), F.lit(None).cast(ends.schema["path"].dataType).alias("path")))
    settled = None
    while True:
        state = state.groupBy("id").agg(F.sum("open").alias("open"), F.min_by("path", order).alias("path")).checkpoint()
        level = state.filter("open = 0").select("id", "path")
        if level.isEmpty():
            break
        settled = level if settled is None else settled.unionByName(level)
        heard = edges.join(level.withColumnsRenamed({"id": "next"}), "next").select("id", F.lit(-1).cast("long").alias("open"), F.concat(F.array("id"), "path").alias("path"))
        state = state.filter("open > 0").unionByName(heard)
    if not state.isEmpty():
        known = state.filter("path IS NOT NULL").select("id", "path", F.lit(None).cast(nodes.schema["id"].dataType).alias("next"))
        inner = edges.join(state.select("id"), "id", "left_semi").join(state.select(F.col("id").alias("next")), "next", "left_semi")
        cyclic = _double(known.unionByName(inner.select("id", F.array("id").alias("path"), "next")))
        cyclic = cyclic.groupBy("id").agg(F.min_by("path", order).alias("path"))
        settled = cyclic if settled is None else settled.unionByName(cyclic)
    return (state.select("id", "path") if settled is None else settled).filter("path IS NOT NULL")


def renewal_lineage(df, id_col, next_ids) -> DataFrame:
    """Longest renewal chain per record as text: the record, all its direct renewals,
    then the longest continuation of one of them. Ties take the smallest text."""
    nodes = df.select(as_col(id_col).cast("string").alias("id"), F.transform(as_col(next_ids), lambda x: x.cast("string")).alias("renewals"))
    best = _longest(nodes)
    tails = best.select(F.col("id").alias("renewal"), F.slice("path", F.lit(2), F.size("path")).alias("tail"))
    options = nodes.select("id", "renewals", F.explode_outer("renewals").alias("renewal")).join(tails, "renewal", "left")
    parts = F.concat(F.array("id"), F.coalesce("renewals", F.array().cast("array<string>")), F.coalesce("tail", F.array().cast("array<string>")))
    options = options.withColumn("lineage", F.array_join(parts, ",")).withColumn("n", F.coalesce(F.size("tail"), F.lit(0)))
    return options.groupBy("id").agg(F.min_by("lineage", F.struct(-F.col("n"), F.col("lineage"))).alias("lineage")).withColumnRenamed("id", id_col)


def lineage_parentage(lineages, id_col, cohorts, cohort) -> DataFrame:
    """(ultimate parent, child, cohort) rows from lineage texts.

    A child belongs to the lineages in which it sits deepest. Where these are
    several, the parent with the earliest cohort wins (then the smaller id) and the
    other parents become its children. Lineages are dealt by child once: ranks find the deepest rows and
    the winner among them, and each row then says which of its rows it adds.
    """
    named = lineages.select(as_col(id_col).alias("parent"), "lineage").join(cohorts.select(F.col(id_col).cast("string").alias("parent"), as_col(cohort).alias("cohort")), "parent", "left")
    flat = named.select("parent", "cohort", F.posexplode(F.split("lineage", ",")).alias("depth", "child"))
    base = topk.top_k(flat, ["child"], F.desc("depth"), 1, ties=True)
    order = [F.col("cohort").isNull(), F.col("cohort"), F.col("parent")]
    ahead = wn.window("child", order, wn.RUNNING)
    base = base.select("parent", "child", F.row_number().over(wn.window("child", order)).alias("__n"), F.first("parent").over(ahead).alias("__w"), F.first("cohort").over(ahead).alias("__c"))
    row = lambda c: F.struct(F.col("__w").alias("parent"), F.col(c).alias("child"), F.col("__c").alias("cohort"))
    both = base.select(F.inline(F.array_compact(F.array(F.when(F.col("__n") == 1, row("child")), F.when(F.col("parent") != F.col("__w"), row("parent"))))))
    return both.groupBy("child").agg(F.min_by("parent", F.struct(*order)).alias("ultimate_parent"), F.min("cohort").alias("cohort"))


def rollup_to_root(facts, lineages, id_col, by, **aggs: Column) -> DataFrame:
    """Aggregate a node metric to its ultimate parent."""
    roots = lineages.select(id_col, "ultimate_parent_id")
    return facts.join(roots, id_col).groupBy("ultimate_parent_id", *by).agg(*[c.alias(n) for n, c in aggs.items()])
