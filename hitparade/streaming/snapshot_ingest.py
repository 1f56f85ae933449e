"""Incremental snapshot ingest with Structured Streaming.

The raw zone is watched as a stream of *file paths*: no body is read to learn which
snapshots changed. An update-mode aggregation keeps, per snapshot date, how many
files and bytes the stream has seen (state keyed by date), so a micro-batch hands on one
row per changed date.

Those dates are then rebuilt from the whole raw zone (a batch read pruned to their
``date=`` folders) into staging, and the curated star is built from staging — the same
two stages as the daily job, each written with dynamic partition overwrite. A
ledger (:class:`Ledger`) says which landed files each date was last built from: a date whose
folder still holds just those is not built again. So a date is rebuilt once a run however many
micro-batches its files are spread over, a replayed batch does nothing, and
when a date fails, its entry says so, the others are done and are not retried.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hitparade import schemas
from hitparade.functions import path_snapshot_date, validated_date
from hitparade.operators import ingest, quality, staging
from hitparade.operators import star as star_ops
from hitparade.plans import daily
from hitparade.sinks import lake as lake_sink
from hitparade.sources import lake as lake_src
from hitparade.sources import raw as raw_src

#: What a stream of files gives; ``content`` is never asked for, so never read.
_FILES = "path string, modificationTime timestamp, length long, content binary"
#: Partitions of the stream's state: a row a date.
STATE_PARTITIONS = 4

LEDGER = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("n_files", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("newest", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("at", T.LongType()),
    ]
)


def files_by_date(files: DataFrame) -> DataFrame:
    """Per snapshot date (from the path): how many files there are, their bytes, and when the newest
    was written (milliseconds). For a stream of files as well as for a listing."""
    return (
        files.select(
            validated_date(path_snapshot_date("path"), "snapshot date from raw path").alias("date"),
            "length",
            F.unix_millis("modificationTime").alias("written"),
        )
        .groupBy("date")
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"), F.max("written").alias("newest"))
    )


def landed_files(spark: SparkSession, raw_root: str, dates: list[str]) -> DataFrame:
    """:func:`files_by_date` of what has landed for ``dates``; lists their folders only."""
    root = raw_root.rstrip("/")
    reader = spark.read.format("binaryFile").option("basePath", root)
    return files_by_date(reader.load([f"{root}/date={d}" for d in dates]))


class Ledger:
    """Which landed files each date was last built from: an append-only JSON-lines table, a row a rebuild."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        """Every rebuild recorded so far."""
        return self.spark.read.schema(LEDGER).json(self.path)

    def record(self, entries: list[dict]) -> None:
        rows = [tuple(e.get(f.name) for f in LEDGER.fields) for e in entries]
        self.spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").json(self.path)

    def built_from(self, dates: list[str]) -> dict[str, tuple]:
        """The files of each date's latest rebuild, where that went well."""
        self.record([])  # so that there is a table
        last = self.rows().where(F.col("date").isin(dates)).groupBy("date").agg(
            F.max_by(F.struct("n_files", "bytes", "newest", "error"), F.struct("at", "batch_id")).alias("e")
        )
        return {r["date"]: tuple(r["e"])[:3] for r in last.collect() if r["e"]["error"] is None}


def rebuild_snapshots(
    spark: SparkSession,
    raw_root: str,
    dates: list[str],
    staging_root: str,
    curated_root: str,
    enforce_quality: bool = True,
) -> dict[str, int]:
    """Rebuild staging and the curated star for the snapshots ``dates`` from
    the whole raw zone.

    ``dates`` are partition values (one per changed day), used as static
    partition filters on the raw and staging reads. Staging is the lineage
    cut: the raw JSON is parsed once per staging table, and the four curated
    tables and the quality report read columnar staging instead of re-running
    the dedup each.
    """
    if not dates:
        return {}

    def raw(kind: str) -> DataFrame:
        return raw_src.read_raw(spark, raw_root, snapshot_dates=dates, kind=kind)

    parts = ingest.parts_per_date(spark, len(dates))
    titres = staging.build_titres(raw("tracks"), parts=parts).withColumn("date", F.col("date_snapshot"))
    artistes = staging.build_artistes(raw("artists"))
    lake_sink.run_concurrently(
        spark,
        {
            "titres": lambda: lake_sink.counted_write(titres, f"{staging_root}/titres", "titres", rebalance=False),
            "artistes": lambda: lake_sink.counted_write(artistes, f"{staging_root}/artistes", "artistes"),
        }
    )

    def staged(table: str, schema) -> DataFrame:
        return lake_src.read_table(spark, staging_root, table, schema=schema).where(F.col("date").isin(dates))

    star = star_ops.build_star(staged("titres", schemas.TITRES).drop("date"), staged("artistes", schemas.ARTISTES))
    if enforce_quality:
        # each snapshot alone: the good ones are published before the others fail the batch
        return daily.publish_gated(star, curated_root, laid_out=daily.FROM_STAGING)[0]
    return lake_sink.publish_star(star, curated_root, mode="dates", laid_out=daily.FROM_STAGING)


def rebuild_changed(
    spark: SparkSession,
    raw_root: str,
    dates: list[str],
    staging_root: str,
    curated_root: str,
    ledger: Ledger,
    batch_id: int = -1,
    enforce_quality: bool = True,
) -> list[str]:
    """Rebuild those of ``dates`` whose landed files differ from what they were last built from; returns
    the dates rebuilt. Every outcome is recorded before the first failure is raised."""
    built = ledger.built_from(dates)
    landed = {r["date"]: (r["n_files"], r["bytes"], r["newest"]) for r in landed_files(spark, raw_root, dates).collect()}
    changed = sorted(d for d, files in landed.items() if built.get(d) != files)
    if not changed:
        return []
    failures: dict[str, Exception] = {}
    try:
        rebuild_snapshots(spark, raw_root, changed, staging_root, curated_root, enforce_quality)
    except quality.QualityGateError as e:
        # each date was judged alone, and the good ones are published
        failures = {d: e for d in (e.dates or changed)}
    except Exception as e:  # noqa: BLE001 - whatever a date's files do to a job, the other dates are built
        failures = {changed[0]: e} if len(changed) == 1 else {}
        for d in changed if len(changed) > 1 else ():
            try:
                rebuild_snapshots(spark, raw_root, [d], staging_root, curated_root, enforce_quality)
            except Exception as alone:  # noqa: BLE001
                failures[d] = alone
    now = time.time_ns()
    ledger.record(
        [
            {
                **dict(zip(("n_files", "bytes", "newest"), landed[d], strict=True)),
                "date": d,
                "error": str(failures[d])[:500] if d in failures else None,
                "batch_id": batch_id,
                "at": now,
            }
            for d in changed
        ]
    )
    for e in failures.values():
        raise e
    return changed


def start_snapshot_ingest(
    spark: SparkSession,
    raw_root: str,
    staging_root: str,
    curated_root: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
    enforce_quality: bool = True,
    max_files_per_trigger: int | None = None,
    ledger: str | None = None,
) -> StreamingQuery:
    """Start the stream. ``available_now`` processes what has landed and stops
    (a scheduled daily run); otherwise it keeps polling every
    ``processing_time``. ``max_files_per_trigger`` bounds each micro-batch.
    The ledger is at ``ledger``, or beside the checkpoint.

    A micro-batch contributes only its changed dates (one row each). A date that fails stops the
    stream after the batch's other dates are built; the batch is replayed on restart, and then only
    that date is tried again.
    """
    book = Ledger(spark, ledger or f"{checkpoint.rstrip('/')}-ledger")
    # the state is a row a date, whatever the session's partitioning of shuffles is
    streaming = spark.newSession()
    streaming.conf.set("spark.sql.shuffle.partitions", str(STATE_PARTITIONS))
    reader = streaming.readStream.format("binaryFile").schema(_FILES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        dates = sorted(r["date"] for r in batch.select("date").collect())
        if dates:
            rebuild_changed(spark, raw_root, dates, staging_root, curated_root, book, batch_id, enforce_quality)

    writer = files_by_date(reader.load(raw_root)).writeStream.outputMode("update").foreachBatch(on_batch)
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
