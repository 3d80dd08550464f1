"""Query registry: key -> (Spark callable, oracle SQL)."""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sparkmart.operators.windows import HotKeys
from sparkmart.session import tune


class Tables:
    """Lazy access to the Parquet tables of one folder: `t.orders`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return comparable(self.build(Tables(tune(spark), folder)))


_QUERIES: dict[str, Query] = {}


def query(key: str, sql: str | None = None):
    """Register `fn(tables) -> DataFrame` under an operator key."""

    def register(fn):
        if key in _QUERIES:
            raise ValueError(f"duplicate query {key}")
        _QUERIES[key] = Query(key, fn, sql.strip() if sql else None)
        return fn

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Plain output types: dates as text, decimals as doubles, timestamps without zone."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string").alias(f.name)
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double").alias(f.name)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz").alias(f.name)
        cols.append(c)
    return df.select(*cols)


def all_queries() -> dict[str, Query]:
    """Every registered query, importing the plan modules on first use."""
    import sparkmart.plans as plans

    for module in pkgutil.iter_modules(plans.__path__):
        if module.name != "registry":
            importlib.import_module(f"sparkmart.plans.{module.name}")
    return dict(_QUERIES)


def by_minute(c="ts") -> HotKeys:
    """Hot keys of an event table are cut by the minute."""
    return HotKeys(F.date_trunc("minute", c))


def by_day(c) -> HotKeys:
    """Hot keys of a table with dates are cut by the day."""
    return HotKeys(F.to_date(c))


def dec(expr: str) -> str:
    """Oracle text of an exact two-place decimal."""
    return f"CAST({expr} AS DECIMAL(18,2))"


def dsum(expr: str) -> str:
    """Oracle text of an exact sum as double."""
    return f"CAST(SUM(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE)"
