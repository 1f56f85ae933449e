"""Lake readers: declared schemas, partition pruning on ``date``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitparade import schemas
from hitparade.operators.star import Star


class MissingPartitionError(LookupError):
    """A requested ``date=`` partition holds no rows (or does not exist)."""


def read_table(
    spark: SparkSession, root: str, table: str, snapshot_date: str | None = None, schema=None
) -> DataFrame:
    """A lake table with its declared schema (+ ``date`` STRING). With
    ``snapshot_date`` the read is pruned to that partition."""
    sch = schemas.with_partition(schema or schemas.CURATED.get(table) or schemas.STAGING[table])
    df = spark.read.schema(sch).parquet(f"{root.rstrip('/')}/{table}")
    return df if snapshot_date is None else df.where(F.col("date") == F.lit(snapshot_date))


def read_partition(spark: SparkSession, root: str, table: str, snapshot_date: str, schema=None) -> DataFrame:
    """All files of one ``date=`` partition as one DataFrame; fail when empty.

    The emptiness probe stops at the first row (``isEmpty``), so it costs one
    small task, not a count.
    """
    df = read_table(spark, root, table, snapshot_date, schema)
    if df.isEmpty():
        raise MissingPartitionError(f"no rows under {root}/{table}/date={snapshot_date}")
    return df


def read_star(spark: SparkSession, root: str, snapshot_date: str | None = None) -> Star:
    tables = {t: read_table(spark, root, t, snapshot_date) for t in schemas.CURATED}
    return Star(**tables)


def catalog_star(spark: SparkSession, database: str) -> Star:
    """The star from registered catalog tables (``spark.table``)."""
    return Star(**{t: spark.table(f"{database}.{t}") for t in schemas.CURATED})
