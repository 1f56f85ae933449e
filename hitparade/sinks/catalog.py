"""Catalog registration and partition maintenance, in Spark SQL.

* register the curated tables as external, date-partitioned Parquet tables
  with declared columns (no crawler, no inference);
* add the partitions of the dates just written (``ALTER TABLE ADD PARTITION``), or
  recover all of them (``MSCK REPAIR TABLE``);
* list partitions older than a retention window and expire them: the catalog
  entry is dropped and the folder deleted through the table's file system.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitparade import schemas
from hitparade.constants import RAW_RETENTION_DAYS
from hitparade.sinks import files


def _quote(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    loc = f" LOCATION '{_quote(location)}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{loc}")


def register_table(
    spark: SparkSession,
    database: str,
    table: str,
    location: str,
    schema,
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = ("date",),
) -> None:
    """External table over ``location``, partitioned by STRING columns
    (``date``, or ``date, kind`` for the raw zone)."""
    parts = ", ".join(f"`{c}` STRING" for c in partition_by)
    names = ", ".join(f"`{c}`" for c in partition_by)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` ({schemas.ddl(schema)}, {parts}) "
        f"USING {fmt} PARTITIONED BY ({names}) LOCATION '{_quote(location)}'"
    )


def register_curated(spark: SparkSession, database: str, root: str, db_location: str | None = None) -> list[str]:
    """Database + the four curated tables under ``root/<table>``."""
    create_database(spark, database, db_location)
    names = []
    for table, schema in schemas.CURATED.items():
        register_table(spark, database, table, f"{root.rstrip('/')}/{table}", schema)
        names.append(f"{database}.{table}")
    return names


def recover_partitions(spark: SparkSession, tables: Iterable[str]) -> None:
    """Register ``date=`` folders written since the last call."""
    for t in tables:
        spark.sql(f"MSCK REPAIR TABLE {t}")


def add_partitions(spark: SparkSession, tables: Iterable[str], dates: Iterable[str]) -> None:
    """Register the ``date=`` folders of the dates just written, without listing
    the others (:func:`recover_partitions` lists them all)."""
    specs = " ".join(_dated(d) for d in dates)
    if specs:
        for t in tables:
            spark.sql(f"ALTER TABLE {t} ADD IF NOT EXISTS {specs}")


def _dated(d: str) -> str:
    return f"PARTITION (`date` = '{_quote(d)}')"


def place_partitions(spark: SparkSession, table: str, places: dict[str, str]) -> None:
    """Register dates with the folders that hold them."""
    specs = " ".join(f"{_dated(d)} LOCATION '{_quote(p)}'" for d, p in sorted(places.items()))
    if specs:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")


def move_partition(spark: SparkSession, table: str, date: str, place: str) -> None:
    """Let a registered date read from another folder."""
    spark.sql(f"ALTER TABLE {table} {_dated(date)} SET LOCATION '{_quote(place)}'")


def forget_partitions(spark: SparkSession, table: str, dates: Iterable[str]) -> None:
    """Drop dates from the catalog of an external table; their files stay."""
    specs = ", ".join(_dated(d) for d in dates)
    if specs:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")


def partitions(spark: SparkSession, table: str) -> DataFrame:
    """Distinct ``date`` values registered for a table (catalog metadata only;
    a table also partitioned below ``date`` lists each date once)."""
    return (
        spark.sql(f"SHOW PARTITIONS {table}")
        .select(F.regexp_extract("partition", r"date=([^/]*)", 1).alias("date"))
        .distinct()
    )


def expired_partitions(parts: DataFrame, as_of: str, retention_days: int = RAW_RETENTION_DAYS) -> DataFrame:
    """Partitions whose snapshot is more than ``retention_days`` before
    ``as_of``, with their age in days."""
    d = F.to_date("date")
    as_of_d = F.to_date(F.lit(as_of))
    return parts.where(d < F.date_sub(as_of_d, retention_days)).select(
        "date", F.datediff(as_of_d, d).cast("long").alias("age_days")
    )


def drop_partitions(spark: SparkSession, table: str, dates: Iterable[str]) -> int:
    """Drop every partition of the given dates from an external table and delete
    their files; returns how many dates were dropped.

    A date can have partitions below it (``kind``): their full specs are listed and
    dropped one by one, and nothing is deleted before the catalog is seen to be
    rid of them. The date list is one value per expired day. Curated tables
    never expire and are refused.
    """
    if table.rsplit(".", 1)[-1] in schemas.CURATED:
        raise ValueError(f"{table} is a curated table: it never expires")
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]

    def listed(d: str) -> list[str]:
        return [r[0] for r in spark.sql(f"SHOW PARTITIONS {table} {_dated(d)}").collect()]

    n = 0
    for d in dates:
        for spec in listed(d):
            pairs = (part.split("=", 1) for part in spec.split("/"))
            spark.sql(f"ALTER TABLE {table} DROP PARTITION ({', '.join(f"`{k}` = '{_quote(v)}'" for k, v in pairs)})")
        if left := listed(d):
            raise RuntimeError(f"{table}: partitions still listed after the drop: {left}")
        n += files.delete_folder(spark, f"{location.rstrip('/')}/date={d}")
    return n


def partition_freshness(spark: SparkSession, table: str, expected: Iterable[str]) -> DataFrame:
    """One report row per expected date: the partition exists *and* has rows.

    (A marker file alone does not count.) The count is pruned to the expected
    partitions.
    """
    exp = list(expected)
    counts = (
        spark.table(table)
        .where(F.col("date").isin(exp))
        .groupBy("date")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    wanted = spark.createDataFrame([(d,) for d in exp], "date string")
    n = F.coalesce(F.col("_n"), F.lit(0))
    return wanted.join(counts, "date", "left").select(
        F.lit("fraicheur_partition").alias("rule"),
        "date",
        F.when(n > 0, 0).otherwise(1).cast("long").alias("violations"),
        n.cast("double").alias("observed"),
        (n > 0).alias("passed"),
    )


# Bucketed layout: the fact and the title dimension clustered on the title id,
# so the (id_titre, date) join of the history reports reads co-partitioned
# buckets instead of shuffling both tables. The planner uses the buckets for a
# join whose keys extend the bucket key when
# ``spark.sql.requireAllClusterKeysForCoPartition`` is false (a cluster
# setting; the partition column ``date`` cannot itself be a bucket column).
CO_PARTITION_CONF = "spark.sql.requireAllClusterKeysForCoPartition"
BUCKET_KEYS = {"fait_popularite": "id_titre", "dim_titre": "id_titre"}


def register_bucketed_curated(
    spark: SparkSession, database: str, root: str, buckets: int, db_location: str | None = None
) -> list[str]:
    """Database + the four curated tables, ``fait_popularite`` and
    ``dim_titre`` bucketed (and sorted) on ``id_titre`` into ``buckets``.
    The tables declare dynamic partition overwrite, so an ``INSERT OVERWRITE``
    replaces only the snapshots it writes."""
    create_database(spark, database, db_location)
    names = []
    for table, schema in schemas.CURATED.items():
        key = BUCKET_KEYS.get(table)
        clustered = f" CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS" if key else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` ({schemas.ddl(schema)}, `date` STRING) "
            f"USING parquet OPTIONS ('partitionOverwriteMode' = 'dynamic') PARTITIONED BY (`date`){clustered} "
            f"LOCATION '{_quote(root.rstrip('/') + '/' + table)}'"
        )
        names.append(f"{database}.{table}")
    return names


def insert_star(star, database: str) -> None:
    """Write a star into registered tables, replacing only the snapshots it
    holds (dynamic partition overwrite); the table's bucketing is applied by
    the writer. Columns go by position: data columns, then ``date``."""
    for table, df in star.tables().items():
        cols = [f.name for f in schemas.CURATED[table].fields] + ["date"]
        df.select(*cols).write.insertInto(f"{database}.{table}", overwrite=True)
