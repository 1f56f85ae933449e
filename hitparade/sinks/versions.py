"""Versioned star: four tables that change together.

Layout: ``root/<table>/version=<v>/date=<d>/`` holds what one run wrote, and
``root/publications/`` the log of what was published: a row for each version and
snapshot, with the rows of each table. A run writes its version beside the others and
changes nothing that a reader sees; one log file, which the file system makes visible in
one step, then publishes all four tables of all its snapshots at once. A run that dies
before that leaves folders that nobody reads, for :func:`vacuum` to delete.

A snapshot is read from the greatest version published for it, all four tables from the
same one. Versions sort by the time their runs began, so of two runs over one snapshot
the later-begun one stays, whichever commits first.

Readers list the folders of live versions only; the log has a row a version and snapshot,
the live list one row a snapshot (as a catalog's partition list has).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitparade import schemas
from hitparade.operators.star import Star
from hitparade.sinks import catalog, files
from hitparade.sinks import lake as lake_sink

VERSION = T.StructField("version", T.StringType())
LOG = T.StructType([VERSION, schemas.PARTITION, *[T.StructField(t, T.LongType()) for t in schemas.CURATED]])
_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")
_VERSION = re.compile(r"[A-Za-z0-9_-]+")


class TornVersionError(RuntimeError):
    """A written version does not hold the rows that its writers counted."""


def new_version() -> str:
    """A version of its own that sorts by time."""
    return f"{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def _log_path(root: str) -> str:
    return f"{root.rstrip('/')}/publications"


def _table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def write_version(star: Star, root: str, version: str, laid_out: Iterable[str] = ()) -> dict[str, int]:
    """Write the four tables as ``version``, unseen by readers; rows by table. A version
    that was published is never written again. ``laid_out``: see :func:`lake_sink.publish_star`."""
    spark = star.fait_popularite.sparkSession
    if not _VERSION.fullmatch(version):
        raise ValueError(f"not a version: {version!r}")
    if not publications(spark, root).where(F.col("version") == version).isEmpty():
        raise ValueError(f"version {version} is published already")

    laid_out = set(laid_out)

    def job(table: str, df: DataFrame):
        path = f"{_table_path(root, table)}/version={version}"
        return lambda: lake_sink.counted_write(df, path, table, mode="full", rebalance=table not in laid_out)

    return lake_sink.run_concurrently(spark, {t: job(t, df) for t, df in star.tables().items()})


def read_version(spark: SparkSession, root: str, version: str) -> Star:
    """One version's tables, published or not."""
    def table(t: str) -> DataFrame:
        sch = schemas.with_partition(schemas.CURATED[t])
        return spark.read.schema(sch).parquet(f"{_table_path(root, t)}/version={version}")

    return Star(**{t: table(t) for t in schemas.CURATED})


def rows_by_date(star: Star) -> DataFrame:
    """``date`` and the rows of each table: one partial aggregate over the four."""
    tables = star.tables()
    ones = [
        df.select("date", *[F.lit(int(t == name)).cast("long").alias(t) for t in tables]) for name, df in tables.items()
    ]
    rows = reduce(DataFrame.unionByName, ones)
    return rows.groupBy("date").agg(*[F.sum(t).alias(t) for t in tables])


def commit(spark: SparkSession, root: str, version: str, written: dict[str, int], dates: Iterable[str] | None = None) -> list[str]:
    """Publish ``version`` for ``dates`` (null: all it holds), in one step; the dates published.

    The rows on disk are counted (from file footers) and must be those ``written``.
    """
    counts = rows_by_date(read_version(spark, root, version)).collect()  # a row a snapshot
    found = {t: sum(r[t] for r in counts) for t in schemas.CURATED}
    if found != written:
        raise TornVersionError(f"version {version} holds {found}, its writers counted {written}")
    if odd := [r.date for r in counts if not _DATE.fullmatch(r.date or "")]:
        raise ValueError(f"version {version}: not a snapshot date: {odd}")
    wanted = None if dates is None else set(dates)
    rows = sorted((version, *r) for r in counts if wanted is None or r.date in wanted)
    if rows:
        # one partition: one file, seen whole or not at all
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(_log_path(root))
    return [r[1] for r in rows]


def publications(spark: SparkSession, root: str) -> DataFrame:
    """The log; empty where nothing was published."""
    if not files.exists(spark, _log_path(root)):
        return spark.createDataFrame([], LOG)
    return spark.read.schema(LOG).parquet(_log_path(root))


def live(spark: SparkSession, root: str) -> DataFrame:
    """The log's row of each snapshot's greatest version."""
    rest = [f.name for f in LOG.fields if f.name != "date"]
    latest = publications(spark, root).groupBy("date").agg(F.max_by(F.struct(*rest), "version").alias("_l"))
    return latest.select("_l.version", "date", *[f"_l.{t}" for t in schemas.CURATED])


def _folder(root: str, table: str, row) -> str:
    return f"{_table_path(root, table)}/version={row.version}/date={row.date}"


def read_rows(spark: SparkSession, root: str, rows: list) -> Star:
    """The star of some (collected) rows of the log: of each, its version's folders of its date."""

    def table(t: str) -> DataFrame:
        sch = schemas.with_partition(schemas.CURATED[t])
        paths = [_folder(root, t, r) for r in rows if r[t]]
        if not paths:
            return spark.createDataFrame([], sch)
        on_disk = T.StructType([*schemas.CURATED[t].fields, VERSION, schemas.PARTITION])
        df = spark.read.schema(on_disk).option("basePath", _table_path(root, t)).parquet(*paths)
        return df.select(*sch.names)

    return Star(**{t: table(t) for t in schemas.CURATED})


def read_live(spark: SparkSession, root: str, snapshot_date: str | None = None) -> Star:
    """The published star, or one snapshot of it. The versions are fixed when this is
    called: publications after that are not seen, so the four tables agree."""
    rows = live(spark, root)
    rows = (rows if snapshot_date is None else rows.where(F.col("date") == snapshot_date)).collect()
    return read_rows(spark, root, rows)


def sync_catalog(spark: SparkSession, database: str, root: str, dates: Iterable[str] | None = None) -> list[str]:
    """Point the database's curated tables (made where missing) at the live versions of
    ``dates`` (null: all), partition by partition; the names of the tables.

    Done after a commit and repeatable: a run that fails between two tables is mended by the
    next. A table without rows on a date has no partition of it. Locations are set here
    alone; ``MSCK REPAIR`` does not know versions.
    """
    names = catalog.register_curated(spark, database, root)
    rows = live(spark, root)
    rows = (rows if dates is None else rows.where(F.col("date").isin(list(dates)))).orderBy("date").collect()
    for t, name in zip(schemas.CURATED, names, strict=True):
        known = {r.date for r in catalog.partitions(spark, name).collect()}
        place = {r.date: _folder(root, t, r) for r in rows if r[t]}
        catalog.place_partitions(spark, name, {d: p for d, p in place.items() if d not in known})
        for d in sorted(known & set(place)):
            catalog.move_partition(spark, name, d, place[d])
        catalog.forget_partitions(spark, name, [r.date for r in rows if not r[t] and r.date in known])
    return names


def vacuum(spark: SparkSession, root: str, before: str) -> int:
    """Delete the folders of versions less than ``before`` that no snapshot is read from: replaced
    ones and those of runs that died. Returns how many snapshot folders went.

    ``before`` has to leave time to runs and readers at work: a version sorts by the time its
    run began.
    """
    keep = {(r.version, r.date) for r in live(spark, root).collect()}
    gone = 0
    for t in schemas.CURATED:
        for folder in files.matching(spark, f"{_table_path(root, t)}/version=*"):
            version = folder.rsplit("version=", 1)[1]
            if version >= before:
                continue
            dated = files.matching(spark, f"{folder}/date=*")
            dead = [p for p in dated if (version, p.rsplit("date=", 1)[1]) not in keep]
            gone += len(dead)
            if len(dead) == len(dated):
                files.delete_folder(spark, folder)
            else:
                for p in dead:
                    files.delete_folder(spark, p)
    return gone
