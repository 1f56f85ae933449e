"""One snapshot run, end to end: raw → staging → gated curated star.

``run_staging`` reads the raw documents (the snapshot date comes from the
path), builds deduplicated ``titres`` / ``artistes`` and writes them
partitioned by date. ``run_curated`` reads staging, builds the star, blocks on
the quality gate *before* any write, then replaces only the run's ``date=``
partitions so earlier snapshots are kept. Each stage reads its input from the
lake, so stages can run as separate applications and a rerun of one date is
isolated and idempotent.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from hitparade import schemas
from hitparade.operators import ingest, quality, staging
from hitparade.operators import star as star_ops
from hitparade.sinks import files, versions
from hitparade.sinks import lake as lake_sink
from hitparade.sources import lake as lake_src
from hitparade.sources import raw as raw_src


log = logging.getLogger(__name__)


@dataclass
class RunResult:
    snapshot_dates: list[str] | None
    rows: dict[str, int]
    quality: list[dict] = field(default_factory=list)


def run_staging(
    spark: SparkSession,
    raw_path: str,
    staging_root: str,
    multi_line: bool = False,
    strict: bool = True,
    snapshot_dates: list[str] | None = None,
) -> RunResult:
    """Raw documents at ``raw_path`` → ``staging_root/{titres,artistes}``.

    Each table reads only its own kind of raw document (the two writes run as
    concurrent jobs); both use dynamic partition overwrite, so only the snapshots present
    in the raw input are replaced. ``snapshot_dates`` names the days to stage: only
    their ``date=`` folders are listed and read.
    """
    def raw(kind: str):
        return raw_src.read_raw(spark, raw_path, multi_line=multi_line, strict=strict, snapshot_dates=snapshot_dates, kind=kind)

    n_dates = len(snapshot_dates or files.matching(spark, f"{raw_path.rstrip('/')}/date=*"))
    parts = ingest.parts_per_date(spark, n_dates)
    titres = staging.build_titres(raw("tracks"), parts=parts).withColumn("date", F.col("date_snapshot"))
    artistes = staging.build_artistes(raw("artists"))
    root = staging_root.rstrip("/")
    rows = lake_sink.run_concurrently(
        spark,
        {
            "titres": lambda: lake_sink.counted_write(titres, f"{root}/titres", "titres", rebalance=False),
            "artistes": lambda: lake_sink.counted_write(artistes, f"{root}/artistes", "artistes"),
        }
    )
    log.info("staging written from %s: %s", raw_path, rows)
    return RunResult(snapshot_dates, rows)


#: Curated tables that are staged rows, column by column: staging laid them out by date.
FROM_STAGING = ("fait_popularite", "dim_titre", "dim_artiste")


def publish_gated(
    star: star_ops.Star,
    curated_root: str,
    seuil: float = quality.COMPLETENESS_THRESHOLD,
    laid_out: Iterable[str] = (),
) -> tuple[dict[str, int], list[dict]]:
    """Judge every snapshot of ``star`` alone and publish those that pass; then
    raise naming the others, if any. Returns (rows per table, report rows).
    ``laid_out``: see :func:`lake_sink.publish_star`."""
    report = quality.quality_report_by_date(star.fait_popularite, star.dim_titre, star.dim_artiste, seuil=seuil)
    checks, good, error = quality.judge_by_date(report)
    rows = {}
    if good:
        rows = lake_sink.publish_star(star if error is None else star.on(good), curated_root, mode="dates", laid_out=laid_out)
        log.info("curated written to %s for %d snapshot(s): %s", curated_root, len(good), rows)
    if error:
        raise error
    return rows, checks


def publish_audited(
    star: star_ops.Star,
    curated_root: str,
    seuil: float = quality.COMPLETENESS_THRESHOLD,
    version: str | None = None,
    laid_out: Iterable[str] = (),
) -> tuple[dict[str, int], list[dict]]:
    """Write, audit, publish: the star becomes a version of its own (:mod:`hitparade.sinks.versions`),
    the *written* tables are judged snapshot by snapshot, and those that pass are published
    together in one step; then raise naming the others, if any, which keep what they had.

    The star is computed once, for the write; the rules read the files. Returns
    (rows per table of the snapshots published, report rows).
    """
    spark = star.fait_popularite.sparkSession
    version = version or versions.new_version()
    written = versions.write_version(star, curated_root, version, laid_out)
    audited = versions.read_version(spark, curated_root, version)
    report = quality.quality_report_by_date(audited.fait_popularite, audited.dim_titre, audited.dim_artiste, seuil=seuil)
    checks, good, error = quality.judge_by_date(report)
    rows: dict[str, int] = {}
    if good:
        dates = versions.commit(spark, curated_root, version, written, good)
        mine = versions.publications(spark, curated_root).where(F.col("version") == version)
        rows = mine.agg(*[F.sum(t).alias(t) for t in schemas.CURATED]).first().asDict()
        log.info("version %s published in %s for %d snapshot(s): %s", version, curated_root, len(dates), rows)
    if error:
        raise error
    return rows, checks


def run_curated(
    spark: SparkSession,
    staging_root: str,
    curated_root: str,
    snapshot_date: str | None = None,
    backfill: bool = False,
    seuil: float = quality.COMPLETENESS_THRESHOLD,
    versioned: bool = False,
) -> RunResult:
    """Staging → curated star for one snapshot (or every staged one when
    ``backfill``).

    Order: build (lazy) → single-snapshot gate → quality gate → write the four
    tables; nothing is written when a gate fails. A backfill judges each
    snapshot alone (:func:`publish_gated`). ``versioned`` keeps the star in versions whose
    four tables are published together (:func:`publish_audited`).
    """
    titres = lake_src.read_table(spark, staging_root, "titres", snapshot_date, schemas.TITRES).drop("date")
    artistes = lake_src.read_table(spark, staging_root, "artistes", snapshot_date, schemas.ARTISTES)
    star = star_ops.build_star(titres, artistes)
    if backfill:
        rows, checks = (publish_audited if versioned else publish_gated)(star, curated_root, seuil, laid_out=FROM_STAGING)
        return RunResult(None, rows, checks)
    dates = [star_ops.assert_single_snapshot(star.fait_popularite)]
    if versioned:
        rows, checks = publish_audited(star, curated_root, seuil, laid_out=FROM_STAGING)
        return RunResult(dates, rows, checks)
    report = quality.quality_report(
        star.fait_popularite, star.dim_titre, star.dim_artiste, date_attendue=dates[0], seuil=seuil
    )
    checks = quality.enforce(report)
    ratio = next((c["observed"] for c in checks if c["rule"] == "completude"), None)
    log.info("quality gate passed for %s: completeness of score_popularite %s", dates, ratio)
    rows = lake_sink.publish_star(star, curated_root, mode="dates", laid_out=FROM_STAGING)
    log.info("curated written to %s: %s", curated_root, rows)
    return RunResult(dates, rows, checks)


def check_freshness(spark: SparkSession, curated_root: str, ds: str) -> None:
    """Fail unless the fact partition of ``ds`` exists and holds rows."""
    lake_src.read_partition(spark, curated_root, "fait_popularite", ds)
