"""Results kept by snapshot: tables that a job derives from the lake and replaces date by date.

Layout: ``root/<table>/build=<b>/date=<d>/`` holds what one build wrote, ``root/builds/`` the
log: a row a build and date, with the ``stamp`` of what the date was built from and the
tables that have rows on it. The log file of a build becomes visible in one step, after all
its tables are written, so a build that dies leaves folders that nobody reads and a date's
tables always come from the same build: the greatest one logged for it (builds sort by time).
Lists of dates reach the driver, rows never do.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitparade import schemas
from hitparade.sinks import files, versions
from hitparade.sinks import lake as lake_sink

BUILD = T.StructField("build", T.StringType())
LOG = T.StructType(
    [BUILD, schemas.PARTITION, T.StructField("stamp", T.StringType()), T.StructField("tables", T.ArrayType(T.StringType()))]
)


def _table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def write(spark: SparkSession, root: str, tables: dict[str, DataFrame], stamps: dict[str, str]) -> str:
    """Write ``tables`` (each with a ``date``) as one build and log it for the dates of
    ``stamps`` (date → what it was built from); the build. A date without rows is
    logged too: it was built and is empty. Rows of other dates are an error."""
    build = versions.new_version()

    def job(table: str, df: DataFrame):
        def run() -> int:
            lake_sink.write_table(df, f"{_table_path(root, table)}/build={build}", mode="full")
            return 0

        return run

    lake_sink.run_concurrently(spark, {t: job(t, df) for t, df in tables.items()})
    found: dict[str, list[str]] = {}
    for t in sorted(tables):
        for folder in files.matching(spark, f"{_table_path(root, t)}/build={build}/date=*"):
            found.setdefault(folder.rsplit("date=", 1)[1], []).append(t)
    if odd := sorted(set(found) - set(stamps)):
        raise ValueError(f"build {build} holds rows of dates it was not asked for: {odd}")
    rows = [(build, d, stamps[d], found.get(d, [])) for d in sorted(stamps)]
    if rows:
        # one partition: one file, seen whole or not at all
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(_table_path(root, "builds"))
    return build


def live(spark: SparkSession, root: str, dates: Iterable[str] | None = None) -> list:
    """The log's row of each date's greatest build, by date (of ``dates`` only, if given)."""
    path = _table_path(root, "builds")
    if not files.exists(spark, path):
        return []
    log = spark.read.schema(LOG).parquet(path)
    if dates is not None:
        log = log.where(F.col("date").isin(list(dates)))
    latest = log.groupBy("date").agg(F.max_by(F.struct("stamp", "tables", "build"), "build").alias("_l"))
    return latest.select("date", "_l.*").orderBy("date").collect()


def read(spark: SparkSession, root: str, table: str, schema: T.StructType, rows: list) -> DataFrame:
    """``table`` (``schema`` and ``date``) from the folders of some :func:`live` rows, and no other."""
    out = schemas.with_partition(schema)
    paths = [f"{_table_path(root, table)}/build={r.build}/date={r.date}" for r in rows if table in r.tables]
    if not paths:
        return spark.createDataFrame([], out)
    on_disk = T.StructType([*schema.fields, BUILD, schemas.PARTITION])
    df = spark.read.schema(on_disk).option("basePath", _table_path(root, table)).parquet(*paths)
    return df.select(*out.names)
