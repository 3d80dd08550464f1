"""Data-quality tests. Each returns the violations; an empty result passes.

A `Suite` asks many tests at once: their numbers of violations come from one scan a table, and only
tests that fail are asked for their rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sparkmart.functions import as_col, surrogate_key
from sparkmart.operators import metrics as M, sets
from sparkmart.operators.windows import join_back


def _where(df, where):
    return df.filter(where) if where is not None else df


def not_null(df, col, where=None) -> DataFrame:
    return _where(df, where).filter(as_col(col).isNull())


def unique(df, cols, where=None) -> DataFrame:
    """Non-NULL keys that occur more than once."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return _where(df, where).filter(present).groupBy(*cols).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def unique_combination(df, cols, where=None) -> DataFrame:
    """Column combinations, NULLs included, that occur more than once."""
    return _where(df, where).groupBy(*cols).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def at_least_one(df, col, where=None) -> DataFrame:
    """One row when the column is NULL throughout."""
    return _where(df, where).agg(F.count(as_col(col)).alias("filled")).filter("filled = 0")


def accepted_values(df, col, values, where=None) -> DataFrame:
    c = as_col(col)
    return _where(df, where).filter(c.isNotNull() & ~c.isin(*values)).groupBy(c.alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def relationships(df, col, other, other_col, where=None) -> DataFrame:
    """Rows whose key has no partner."""
    keys = other.select(as_col(other_col).alias("__k"))
    return _where(df, where).filter(as_col(col).isNotNull()).join(keys, as_col(col) == F.col("__k"), "left_anti")


def expression_is_true(df, expr: Column | str, where=None) -> DataFrame:
    """Rows for which the expression is false or NULL."""
    cond = F.expr(expr) if isinstance(expr, str) else expr
    return _where(df, where).filter(~F.coalesce(cond, F.lit(False)))


def row_count(df, minimum, where=None) -> DataFrame:
    return _where(df, where).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") < minimum)


def column_sum(df, col, minimum, where=None) -> DataFrame:
    return _where(df, where).agg(F.sum(as_col(col)).alias("column_sum")).filter(F.coalesce(F.col("column_sum"), F.lit(0)) < minimum)


def new_rows_per_day(df, created, as_of, low, high=None, lag_days=1, holidays=((1, 1), (12, 25), (12, 26)), where=None) -> DataFrame:
    """Rows created on the checked day, when it is a business day, outside [low, high].
    The day is a pushed-down range filter."""
    day = F.date_sub(F.lit(as_of).cast("date"), lag_days)
    holiday = reduce(lambda a, b: a | b, [(F.month(day) == m) & (F.dayofmonth(day) == d) for m, d in holidays])
    lo = day.cast("timestamp_ntz")
    rows = _where(df, where).filter((as_col(created) >= lo) & (as_col(created) < F.date_add(day, 1).cast("timestamp_ntz")) & F.dayofweek(day).between(2, 6) & ~holiday)
    out = rows.groupBy(F.to_date(as_col(created)).alias("day")).agg(F.count(F.lit(1)).alias("row_count"))
    bad = F.col("row_count") < low
    return out.filter(bad if high is None else bad | (F.col("row_count") > high))


def monthly_rows_within(df, created, stdevs=1.0, where=None) -> DataFrame:
    """Months with more new rows than mean + n standard deviations of all months."""
    counts = _where(df, where).groupBy(F.trunc(as_col(created), "month").alias("month")).agg(F.count(F.lit(1)).alias("new_records"))
    limit = counts.agg((F.avg("new_records") + stdevs * F.stddev_samp("new_records")).alias("threshold"))
    return join_back(counts, limit, []).filter("new_records > threshold")


def golden_records(golden, model, cols=None) -> DataFrame:
    """Golden rows the model does not hold in exactly that form; NULL equals NULL."""
    cols = cols or golden.columns
    text = lambda df: df.select(*[as_col(c).cast("string").alias(c) for c in cols])
    g, m = text(golden).alias("g"), text(model).alias("m")
    return g.join(m, reduce(lambda a, b: a & b, [F.col(f"g.{c}").eqNullSafe(F.col(f"m.{c}")) for c in cols]), "left_anti")


def missing_columns(df, expected) -> list[str]:
    """Expected columns the relation lacks."""
    have = {c.lower() for c in df.columns}
    return [c for c in expected if c.lower() not in have]


def missing_tables(spark, expected, database=None) -> list[str]:
    """Expected catalog tables that do not exist."""
    return [t for t in expected if not spark.catalog.tableExists(f"{database}.{t}" if database else t)]


def freshness(sources: dict, as_of, warn_hours, error_hours) -> DataFrame:
    """Newest load time per source and its state: pass, warn or error."""
    parts = [df.agg(F.max(as_col(c)).alias("last_loaded_at")).withColumn("source", F.lit(name)) for name, (df, c) in sources.items()]
    hours = F.timestamp_diff("SECOND", "last_loaded_at", F.lit(as_of).cast("timestamp_ntz")) / 3600
    state = F.when(F.col("last_loaded_at").isNull() | (hours > error_hours), "error").when(hours > warn_hours, "warn").otherwise("pass")
    return sets.union_all(*parts).withColumn("age_hours", hours).withColumn("state", state)


def count_by_date(df, ts, where=None) -> DataFrame:
    return _where(df, where).groupBy(F.to_date(as_col(ts)).alias("date")).agg(F.count(F.lit(1)).alias("row_count"))


def count_deviation(source, target, by) -> DataFrame:
    """Counts per day on both sides and their difference; days on one side count 0 on the other."""
    a = source.groupBy(*by).agg(F.count(F.lit(1)).alias("source_count"))
    b = target.groupBy(*by).agg(F.count(F.lit(1)).alias("target_count"))
    out = a.join(b, by, "full").fillna(0, ["source_count", "target_count"])
    return out.withColumn("deviation", F.col("source_count") - F.col("target_count"))


def detection_rules(rules: dict, run_dates, date_col="run_date") -> DataFrame:
    """Processed, passed and failed records per rule and run date.

    rules: {id: (df, key, passed condition, date)}. Each rule is one conditional
    aggregate; run dates without any result keep a row.
    """
    parts = []
    for rule, (df, key, passed, date) in rules.items():
        good = df.select(as_col(key).alias("__k"), F.to_date(as_col(date)).alias(date_col), F.coalesce(passed, F.lit(False)).alias("__ok"))
        per = good.groupBy(date_col).agg(F.count_distinct("__k").alias("processed"), F.count_distinct(F.when(F.col("__ok"), F.col("__k"))).alias("passed"))
        parts.append(per.withColumn("rule_id", F.lit(rule)))
    counts = sets.union_all(*parts).withColumn("failed", F.col("processed") - F.col("passed"))
    out = counts.join(run_dates, date_col, "right")
    return out.withColumn("primary_key", surrogate_key(date_col, "rule_id"))


def allow_list(df, col, allowed, allowed_col) -> DataFrame:
    """Values observed but not allowed, and allowed but never observed."""
    seen, known = df.select(as_col(col).alias("value")).distinct(), allowed.select(as_col(allowed_col).alias("value")).distinct()
    extra = seen.join(known, "value", "left_anti").withColumn("problem", F.lit("not allowed"))
    return extra.unionByName(known.join(seen, "value", "left_anti").withColumn("problem", F.lit("not used")))


@dataclass
class Suite:
    """Tests over named tables. Methods add one test each, under a name, and return the suite.

    The tests of a table share one scan with one aggregation: distinct keys of every unique test are
    grouped in it, related tables hang on it by left joins of their distinct keys.
    """

    tables: dict[str, DataFrame]
    metrics: dict[str, M.Metric] = field(default_factory=dict)
    verdicts: dict[str, tuple[tuple[str, ...], Callable[..., Column]]] = field(default_factory=dict)
    rows: dict[str, Callable[[], DataFrame]] = field(default_factory=dict)

    def _add(self, name: str, rows: Callable[[], DataFrame], verdict: Callable[..., Column] | None = None, **metrics: M.Metric) -> Suite:
        if name in self.verdicts:
            raise ValueError(f"two tests named {name}")
        parts = {f"{name}\0{k}": m for k, m in metrics.items()}
        self.metrics |= parts
        self.verdicts[name] = tuple(parts), verdict or (lambda n: n)
        self.rows[name] = rows
        return self

    def not_null(self, name, table, col, where=None) -> Suite:
        return self._add(name, lambda: not_null(self.tables[table], col, where), n=M.count(table, where=_all(as_col(col).isNull(), where)))

    def unique(self, name, table, cols, where=None) -> Suite:
        cols = [cols] if isinstance(cols, str) else list(cols)
        present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
        key = F.col(cols[0]) if len(cols) == 1 else F.struct(*cols)
        return self._add(name, lambda: unique(self.tables[table], cols, where), n=M.groups(table, key, lambda n: n > 1, _all(present, where)))

    def unique_combination(self, name, table, cols, where=None) -> Suite:
        return self._add(name, lambda: unique_combination(self.tables[table], cols, where), n=M.groups(table, F.struct(*cols), lambda n: n > 1, _all(None, where)))

    def at_least_one(self, name, table, col, where=None) -> Suite:
        return self._add(name, lambda: at_least_one(self.tables[table], col, where), lambda n: (n == 0).cast("double"), n=M.count(table, as_col(col), _all(None, where)))

    def accepted_values(self, name, table, col, values, where=None) -> Suite:
        c = as_col(col)
        return self._add(name, lambda: accepted_values(self.tables[table], col, values, where), n=M.distinct(table, c, _all(~c.isin(*values), where)))

    def relationships(self, name, table, col, other, other_col, where=None) -> Suite:
        """`col` is a column name; rows whose key has no partner in `other` are violations."""
        keys = f"{other}_{other_col}_keys"
        self.tables = {**self.tables, keys: self.tables[other].select(as_col(other_col).alias("k")).filter("k IS NOT NULL").distinct()}
        join = M.Join(keys, ((col, "k"),), unique=True)
        known = _all(F.col(col).isNotNull(), where)
        return self._add(name, lambda: relationships(self.tables[table], col, self.tables[other], other_col, where), lambda n, hit: n - hit, n=M.count(table, where=known), hit=M.count(table, where=known, joins=[join]))

    def expression_is_true(self, name, table, expr: Column | str, where=None) -> Suite:
        cond = F.expr(expr) if isinstance(expr, str) else expr
        return self._add(name, lambda: expression_is_true(self.tables[table], expr, where), n=M.count(table, where=_all(~F.coalesce(cond, F.lit(False)), where)))

    def row_count(self, name, table, minimum, where=None) -> Suite:
        return self._add(name, lambda: row_count(self.tables[table], minimum, where), lambda n: (n < minimum).cast("double"), n=M.count(table, where=_all(None, where)))

    def column_sum(self, name, table, col, minimum, where=None) -> Suite:
        short = lambda s: (F.coalesce(s, F.lit(0.0)) < minimum).cast("double")
        return self._add(name, lambda: column_sum(self.tables[table], col, minimum, where), short, n=M.total(table, as_col(col), _all(None, where)))

    def report(self) -> DataFrame:
        """(test, violations, passed): what each test's own function would return, counted."""
        names = {name: M.combined(verdict, *parts) for name, (parts, verdict) in self.verdicts.items()}
        out = M.run_metrics(self.tables, self.metrics | names, "")
        out = out.filter(F.col("metric").isin(*names)).select(F.col("metric").alias("test"), F.col("value").cast("long").alias("violations"))
        return out.withColumn("passed", F.col("violations") == 0)

    def failures(self) -> dict[str, DataFrame]:
        """Violating rows of the tests that fail; no other test is asked."""
        failed = [r.test for r in self.report().filter(~F.col("passed")).collect()]
        return {name: self.rows[name]() for name in failed}


def _all(cond: Column | None, where) -> Column | None:
    """Both conditions, NULL counting as false."""
    where = F.expr(where) if isinstance(where, str) else where
    given = [c for c in (cond, where) if c is not None]
    return reduce(lambda a, b: a & b, given) if given else None
