"""Tables of versions: immutable data files, and manifests that say which of them a version has.

A version becomes visible by one small append to the manifest, after all its files are written;
nothing is renamed or moved, so readers see the old or the new version at any moment, on an object
store as well. Files that a change does not touch are listed again, not written again.

    root/data/<write>/...      Parquet files, never changed
    root/manifest/             (version, writer, part, file, rows, hash): one row per file of a version
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkmart.functions import as_col

MANIFEST = "version long, writer string, part string, file string, rows long, hash string"


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """Files of the newest version; no rows for a table that has none. Of two writers of one version the later name wins."""
    try:
        every = spark.read.schema(MANIFEST).parquet(f"{root.rstrip('/')}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)
    newest = every.agg(F.max(F.struct("version", "writer")).alias("m")).select("m").scalar()
    return every.filter(F.struct("version", "writer") == newest)


def read(spark: SparkSession, root: str, parts: list[str] | None = None) -> DataFrame:
    """The newest version, or some parts of it."""
    files = manifest(spark, root).filter("file IS NOT NULL")
    if parts is not None:
        files = files.filter(F.col("part").isin(*parts))
    paths = [r.file for r in files.select("file").distinct().collect()]
    if not paths:
        raise FileNotFoundError(f"{root} has no such version")
    return spark.read.parquet(*paths)


def contents(df: DataFrame, part: Column | None) -> dict[str, tuple[int, str]]:
    """Per part its row count and an order-free hash of its rows; columns count by name."""
    cols = [F.struct(F.lit(c), F.col(f"`{c}`")) for c in sorted(df.columns)]
    own = (part if part is not None else F.lit("")).cast("string")
    parts = df.groupBy(F.coalesce(own, F.lit("\0")).alias("part")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).cast("string").alias("h"))
    return {r.part: (r.n, r.h) for r in parts.collect()}


def _written(df: DataFrame, root: str, part: Column | None) -> DataFrame:
    """Files of a fresh write, with their part."""
    folder = f"{root.rstrip('/')}/data/{uuid.uuid4().hex}"
    own = F.coalesce((part if part is not None else F.lit("")).cast("string"), F.lit("\0"))
    # The part is a column of its own in the path, so the files keep all columns of the table.
    df.withColumn("__part", F.concat(F.lit("x"), F.hex(F.encode(own, "utf-8")))).write.partitionBy("__part").parquet(folder)
    said = df.sparkSession.read.parquet(folder).select(F.col("_metadata.file_path").alias("file"), F.col("__part").cast("string").alias("p")).distinct()
    return said.select(F.coalesce(F.decode(F.unhex(F.substring("p", 2, 1 << 20)), "utf-8"), F.lit("")).alias("part"), "file")


def _publish(spark: SparkSession, root: str, version: int, files: list[tuple[str, str | None]], held: dict[str, tuple[int, str]]) -> None:
    writer = uuid.uuid4().hex
    rows = [(version, writer, part, file, *held.get(part, (0, "0"))) for part, file in files] or [(version, writer, "", None, 0, "0")]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/manifest")


def publish(df: DataFrame, root: str, by=None) -> list[str]:
    """Make `df` the newest version; says which parts it wrote or dropped, none when nothing had changed.

    `by` cuts the table into parts (a day, a region): parts with the content they had keep their
    files. Parts are counted on the driver, so choose `by` with thousands of values, not millions.
    """
    spark = df.sparkSession
    part = None if by is None else as_col(by)
    now = contents(df, part)
    old = manifest(spark, root).collect()
    had = {r.part: (r.rows, r.hash) for r in old if r.file}
    changed = sorted(p for p in now if had.get(p) != now[p])
    gone = sorted(set(had) - set(now))
    if old and not changed and not gone:
        return []
    files = [(r.part, r.file) for r in old if r.file and r.part in now and r.part not in changed]
    if changed:
        own = F.coalesce((part if part is not None else F.lit("")).cast("string"), F.lit("\0"))
        mine = df if len(changed) == len(now) else df.filter(own.isin(*changed))
        files += [(r.part, r.file) for r in _written(mine, root, part).collect()]
    _publish(spark, root, max((r.version for r in old), default=0) + 1, files, now)
    return sorted({*changed, *gone})


def erase(spark: SparkSession, root: str, subjects: DataFrame, email_cols: list[str], by=None) -> list[str]:
    """Remove the rows of the subjects (column `email_sha`) and say which files they were in.

    Only files that hold a subject are read in full and written again, in a new version; all others
    keep their names and times. The old files stay until they are removed by the store's retention.
    """
    from sparkmart.operators.privacy import erase_subjects

    table = read(spark, root)
    hit = None
    for c in email_cols:
        sha = F.sha2(F.trim(F.lower(as_col(c))), 256)
        some = table.select(F.col("_metadata.file_path").alias("file"), sha.alias("email_sha")).join(subjects.select("email_sha"), "email_sha", "left_semi").select("file")
        hit = some if hit is None else hit.unionByName(some)
    touched = sorted(r.file for r in hit.distinct().collect())
    if not touched:
        return []
    old = manifest(spark, root).collect()
    parts = {r.part for r in old if r.file in touched}
    part = None if by is None else as_col(by)
    rest = erase_subjects(spark.read.parquet(*touched), subjects, email_cols)
    files = [(r.part, r.file) for r in old if r.file and r.file not in touched]
    files += [(r.part, r.file) for r in _written(rest, root, part).collect()]
    held = {r.part: (r.rows, r.hash) for r in old if r.part not in parts}
    again = [f for p, f in files if p in parts]
    if again:
        held |= contents(spark.read.parquet(*again), part)
    _publish(spark, root, max(r.version for r in old) + 1, files, held)
    return touched
