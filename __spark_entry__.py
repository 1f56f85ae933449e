"""

Every query reads the given tables (``sf_dir``) through the landing mapping of
:mod:`hitparade.sources.landing` and runs a library operator over all of it.
``oracle_sql`` holds the same computation as plain DuckDB SQL over the
seen titles, artists and the star tables) as CTEs.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitparade import schemas
from hitparade.operators import field_types, ingest, quality, staging
from hitparade.operators import star as star_ops
from hitparade.plans import daily, reports
from hitparade.plans import extract as extract_plan
from hitparade.plans import first_seen as first_seen_plan
from hitparade.plans import history as history_plan
from hitparade.session import scratch_dir
from hitparade.sinks import catalog
from hitparade.sinks import lake as lake_sink
from hitparade.sinks import raw as raw_sink
from hitparade.sinks import versions
from hitparade.sources import lake as lake_src
from hitparade.sources import landing
from hitparade.sources import raw as raw_src
from hitparade.streaming import snapshot_ingest

try:  # the training-data operators can be left out of an installation
    from hitparade.llm import queries as llm_queries
except ImportError:
    llm_queries = None
try:
    import corpus_pipeline
except ImportError:
    corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"
# The snapshot used by the single-date reports (a ship month present at every
# scale factor).
REPORT_SNAPSHOT = "1998-03-01"
# A snapshot no scale factor has, for the failing freshness case.
ABSENT_SNAPSHOT = "2030-01-01"


def _star(spark: SparkSession, sf_dir: str, snapshot: str | None = None) -> star_ops.Star:
    """The star from the landing tables — every snapshot, or only ``snapshot``
    (read with a pushed-down ship-date range)."""
    kept = landing.kept_entries(spark, sf_dir, snapshot)
    titres, artistes = landing.titles_of(spark, sf_dir, kept), landing.staged_artists(spark, sf_dir, kept)
    return star_ops.build_star(titres, artistes, kept)


def _star_to_write(spark: SparkSession, sf_dir: str) -> star_ops.Star:
    """The star of every snapshot for a write of its four tables: they are jobs of their
    own, so the kept entries are written once and read by each; no table has the flag."""
    kept = landing.landed(landing.kept_up_to(spark, sf_dir, "rank"))
    titres, artistes = landing.with_titles(kept, landing.title_records(spark, sf_dir)), landing.staged_artists(spark, sf_dir, kept)
    return star_ops.build_star(titres, artistes, kept)


def _report(name: str, snapshot: str | None) -> Callable[[SparkSession, str], DataFrame]:
    fn = reports.REPORTS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_star(spark, sf_dir, snapshot), snapshot)

    run.__name__ = f"{name}_{'history' if snapshot is None else 'snapshot'}"
    return run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: emerging artists (R5) on one snapshot of sf0.001."""
    return reports.emerging_artists(_star(spark, SMOKE_DIR, REPORT_SNAPSHOT), REPORT_SNAPSHOT)


# ----------------------------------------------------------------- queries
def q_first_seen_dedup(spark, sf_dir):
    return landing.first_seen_titles(spark, sf_dir)


def q_dim_titre(spark, sf_dir):
    return _star(spark, sf_dir).dim_titre


def q_dim_artiste(spark, sf_dir):
    return _star(spark, sf_dir).dim_artiste


def q_fait_popularite(spark, sf_dir):
    return _star(spark, sf_dir).fait_popularite


def q_dim_date(spark, sf_dir):
    return star_ops.build_dim_date(_star(spark, sf_dir).fait_popularite)


def q_star_view(spark, sf_dir):
    return star_ops.star_view(_star(spark, sf_dir))


def q_single_snapshot_gate(spark, sf_dir):
    return star_ops.snapshot_span(_star(spark, sf_dir).fait_popularite)


# quality rules; each query injects the fault FIXTURES.md lists for it, so the
# rule has something to find on the generated data
def q_dq_unicite(spark, sf_dir):
    # uniqueness of the fact built from chart rows *before* dedup
    return quality.check_unicite(star_ops.build_fait_popularite(landing.chart_entries(spark, sf_dir)))


def q_dq_completude(spark, sf_dir):
    s = _star(spark, sf_dir)
    return quality.check_completude(s.fait_popularite).unionByName(
        quality.check_completude(s.dim_titre, column="bpm")
    )


def q_dq_validite(spark, sf_dir):
    s = _star(spark, sf_dir)
    return quality.check_validite(s.fait_popularite, s.dim_titre, bpm_range=(0.0, 150.0))


def _valid_artists(spark, sf_dir, kept: DataFrame) -> DataFrame:
    """dim_artiste built from artist lookups that pass validity (fans >= 0)."""
    enriched = ingest.enrich_artists(kept, landing.valid_artist_records(spark, sf_dir))
    artistes = enriched.where("resolved").select("id", "name", "nb_fan", "nb_album", enriched.date_snapshot.alias("date"))
    return star_ops.build_dim_artiste(artistes)


def q_dq_coherence(spark, sf_dir):
    kept = landing.kept_entries(spark, sf_dir)
    return quality.check_coherence(star_ops.build_fait_popularite(kept), _valid_artists(spark, sf_dir, kept))


def q_dq_report_by_date(spark, sf_dir):
    # the faults of dq_unicite, dq_validite and dq_coherence together
    kept = landing.kept_entries(spark, sf_dir)
    return quality.quality_report_by_date(
        star_ops.build_fait_popularite(landing.chart_entries(spark, sf_dir)),
        star_ops.build_dim_titre(landing.titles_of(spark, sf_dir, kept)),
        _valid_artists(spark, sf_dir, kept),
        bpm_range=(0.0, 150.0),
    )


def q_dq_fraicheur(spark, sf_dir):
    fait = _star(spark, sf_dir).fait_popularite
    return quality.check_fraicheur(fait, REPORT_SNAPSHOT).unionByName(quality.check_fraicheur(fait, ABSENT_SNAPSHOT))


def q_dq_report(spark, sf_dir):
    s = _star(spark, sf_dir)
    return quality.quality_report(s.fait_popularite, s.dim_titre, s.dim_artiste, date_attendue=REPORT_SNAPSHOT)


# ingest
def q_genre_exclude_all(spark, sf_dir):
    return ingest.chart_sizes_by_genre(landing.genre_records(spark, sf_dir), landing.chart_entries(spark, sf_dir))


def q_envelope_reject(spark, sf_dir):
    _, rejected = ingest.split_envelopes(landing.response_bodies(spark, sf_dir))
    return rejected


def q_chart_pages_read(spark, sf_dir):
    pages = ingest.stop_after_last_page(ingest.parse_chart_pages(landing.chart_pages(spark, sf_dir)))
    return pages.select("date_snapshot", "genre_id", "page_no", F.size("doc.data").cast("long").alias("n_tracks"))


def q_track_flatten(spark, sf_dir):
    return ingest.read_chart_pages(landing.chart_pages(spark, sf_dir))


def q_required_fields(spark, sf_dir):
    return ingest.required_field_report(landing.chart_tracks(spark, sf_dir))


def q_typed_fields(spark, sf_dir):
    # some genres' bodies land with a fault each: no gain, numbers in quotes, a null title, a word for a flag
    pages = landing.chart_pages(spark, sf_dir)
    faults = [
        (2, r'"gain":', '"loudness":'),
        (3, r'"rank":(\d+)', '"rank":"$1"'),
        (4, r'"title":"[^"]*"', '"title":null'),
        (5, r'"explicit_lyrics":true', '"explicit_lyrics":"yes"'),
        (6, r'"artist":', '"performer":'),
    ]
    body = F.col("body")
    for genre, pattern, instead in faults:
        body = F.when(F.col("genre_id") == genre, F.regexp_replace("body", pattern, instead)).otherwise(body)
    report = field_types.field_report(pages.withColumn("body", body))
    return report.drop("kinds")


def q_artist_enrich(spark, sf_dir):
    return ingest.enrich_artists(landing.first_seen_titles(spark, sf_dir), landing.artist_records(spark, sf_dir))


def q_distinct_artists(spark, sf_dir):
    return ingest.distinct_artists(landing.first_seen_titles(spark, sf_dir))


def q_genre_yield(spark, sf_dir):
    entries = landing.chart_entries(spark, sf_dir)
    walk = ingest.genre_walk(landing.genre_records(spark, sf_dir), entries)
    return ingest.genre_yield(entries, ingest.first_seen(entries), walk)


def _landed_pages(spark, sf_dir) -> DataFrame:
    """A page or more of every walked chart."""
    return landing.landed(landing.chart_pages(spark, sf_dir).unionByName(landing.empty_chart_pages(spark, sf_dir)))


def q_page_gaps(spark, sf_dir):
    pages = ingest.parse_chart_pages(landing.broken_chart_pages(spark, sf_dir))
    walk = ingest.genre_walk(landing.genre_records(spark, sf_dir), landing.chart_entries(spark, sf_dir))
    return ingest.page_gaps(pages, walk)


def _extraction(spark, sf_dir) -> extract_plan.Extraction:
    """The extraction job over landed bodies: genre list, chart pages, artist
    lookups."""
    return extract_plan.extract(
        landing.genre_list_body(spark, sf_dir),
        _landed_pages(spark, sf_dir),
        landing.artist_lookup_bodies(spark, sf_dir),
    )


def q_extract_titles(spark, sf_dir):
    return _extraction(spark, sf_dir).titres


def q_extract_artists(spark, sf_dir):
    return _extraction(spark, sf_dir).artistes


def q_extract_rejects(spark, sf_dir):
    # the event bodies land among the artist lookups: error bodies are set aside, the
    # rest resolve nobody, and every lookup that is needed has landed
    lookups = landing.artist_lookup_bodies(spark, sf_dir)
    return extract_plan.extract(
        landing.genre_list_body(spark, sf_dir),
        _landed_pages(spark, sf_dir),
        lookups.unionByName(landing.response_bodies(spark, sf_dir).select("body")),
    ).rejected_responses


def q_extract_summary(spark, sf_dir):
    kept = landing.kept_entries(spark, sf_dir)
    walk = ingest.genre_walk(landing.genre_records(spark, sf_dir), landing.chart_entries(spark, sf_dir))
    return ingest.extract_summary(walk, kept, ingest.distinct_artists(kept).withColumnRenamed("date_snapshot", "date"))


# lake: every query writes to a fresh folder under the session's checkpoint
# dir, then returns what it reads back
def _landed_raw(spark, sf_dir, deduplicated: bool = True) -> str:
    raw_root = scratch_dir(spark, "raw")
    if deduplicated:
        titres, artistes = landing.staging(spark, sf_dir)
    else:
        titres, artistes = landing.walked_tracks(spark, sf_dir), landing.looked_up_artists(spark, sf_dir)
    raw_sink.land_raw(titres, artistes, raw_root)
    return raw_root


def _published(spark, sf_dir) -> tuple[str, dict[str, int]]:
    """The production path: staging tables written once, then the curated job
    (gates + four tables) reading staging."""
    staging_root, root = scratch_dir(spark, "staging"), scratch_dir(spark, "curated")
    titres, artistes = landing.staging(spark, sf_dir)
    lake_sink.run_concurrently(
        spark,
        {
            "titres": lambda: lake_sink.counted_write(
                titres.withColumn("date", F.col("date_snapshot")), f"{staging_root}/titres", "titres"
            ),
            "artistes": lambda: lake_sink.counted_write(artistes, f"{staging_root}/artistes", "artistes"),
        }
    )
    return root, daily.run_curated(spark, staging_root, root, backfill=True).rows


def q_raw_roundtrip(spark, sf_dir):
    raw = raw_src.read_raw(spark, _landed_raw(spark, sf_dir), kind="tracks")
    return staging.explode_tracks(raw).select(*schemas.TRACK_COLUMNS, "date_snapshot")


def _staged(spark, sf_dir) -> str:
    # titles and artists land as often as they were seen: staging deduplicates them
    staging_root = scratch_dir(spark, "staging")
    daily.run_staging(spark, _landed_raw(spark, sf_dir, deduplicated=False), staging_root)
    return staging_root


def q_staging_titres(spark, sf_dir):
    return lake_src.read_table(spark, _staged(spark, sf_dir), "titres", schema=schemas.TITRES).drop("date")


def q_staging_artistes(spark, sf_dir):
    return lake_src.read_table(spark, _staged(spark, sf_dir), "artistes", schema=schemas.ARTISTES)


def q_snapshot_date_from_path(spark, sf_dir):
    raw = raw_src.read_raw(spark, _landed_raw(spark, sf_dir))
    n = lambda c: F.sum(F.when(F.col(c).isNotNull(), F.size(c)).otherwise(0)).cast("long")
    return raw.groupBy("date_snapshot").agg(n("tracks").alias("n_tracks"), n("artists").alias("n_artists"))


def q_snapshot_overwrite(spark, sf_dir):
    # a first run wrote un-deduplicated facts for every snapshot; the rerun of
    # one snapshot replaces that date only
    root = scratch_dir(spark, "overwrite")
    stale = star_ops.build_fait_popularite(landing.chart_entries(spark, sf_dir))
    lake_sink.write_table(stale, root, mode="dates")
    rerun = _star(spark, sf_dir, REPORT_SNAPSHOT).fait_popularite
    lake_sink.write_table(rerun, root, mode="dates")
    return spark.read.schema(schemas.with_partition(schemas.FAIT_POPULARITE)).parquet(root)


def q_write_modes(spark, sf_dir):
    # full refresh, then append (every date twice), then a per-date overwrite
    # of one snapshot (back to once)
    path = scratch_dir(spark, "modes")
    fait = _star(spark, sf_dir).fait_popularite
    lake_sink.write_table(fait, path, mode="full")
    lake_sink.write_table(fait, path, mode="append")
    lake_sink.write_table(fait.where(F.col("date") == REPORT_SNAPSHOT), path, mode="dates")
    back = spark.read.schema(schemas.with_partition(schemas.FAIT_POPULARITE)).parquet(path)
    return back.groupBy("date").agg(F.count(F.lit(1)).alias("n_rows"))


def q_published_versions(spark, sf_dir):
    # a clean star is published; a second run brings repeated entries everywhere but
    # on one snapshot, so that only what passes the audit is switched; a third run
    # writes its facts and dies. Each snapshot is read from what was published last.
    root = scratch_dir(spark, "versions")
    lake_sink.publish_star(_star_to_write(spark, sf_dir), f"{root}-staged")
    star = lake_src.read_star(spark, f"{root}-staged")
    daily.publish_audited(star, root, version="run-1", laid_out=schemas.CURATED)
    entries = star_ops.build_fait_popularite(landing.chart_entries(spark, sf_dir)).where(F.col("date") != REPORT_SNAPSHOT)
    second = dataclasses.replace(
        star, fait_popularite=entries.unionByName(star.fait_popularite.where(F.col("date") == REPORT_SNAPSHOT))
    )
    try:
        daily.publish_audited(second, root, version="run-2", laid_out=set(schemas.CURATED) - {"fait_popularite"})
    except quality.QualityGateError:
        pass  # the snapshots that failed keep their first version
    lake_sink.write_table(star.fait_popularite, f"{root}/fait_popularite/version=run-3", mode="full", rebalance=False)
    versions.sync_catalog(spark, db := "charts_" + root.rsplit("-", 1)[-1], root)
    read = versions.rows_by_date(lake_src.catalog_star(spark, db))
    return read.join(versions.live(spark, root).select("date", "version"), "date")


def _kept_history(spark, star: star_ops.Star) -> history_plan.History:
    """Kept results of a published star. One snapshot is published after the rest, when
    the others' results are kept already: only its own are built then."""
    curated, root = scratch_dir(spark, "versions"), scratch_dir(spark, "history")
    lake_sink.publish_star(star, f"{curated}-staged")
    staged = lake_src.read_star(spark, f"{curated}-staged")
    for late in (False, True):
        mine = (F.col("date") == REPORT_SNAPSHOT) == F.lit(late)
        part = star_ops.Star(*(t.where(mine) for t in staged.tables().values()))
        version = versions.new_version()
        versions.commit(spark, curated, version, versions.write_version(part, curated, version, schemas.CURATED))
        history_plan.refresh(spark, curated, root)
    return history_plan.read(spark, curated, root)


def _history(report: Callable[[history_plan.History], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: report(_kept_history(spark, _star_to_write(spark, sf_dir)))


def q_history_quality(spark, sf_dir):
    # the faults of dq_unicite and dq_coherence together, published without an audit
    kept = landing.landed(landing.kept_up_to(spark, sf_dir, "artist_id"))
    fait = star_ops.build_fait_popularite(landing.chart_entries(spark, sf_dir))
    star = star_ops.Star(
        fait_popularite=fait,
        dim_titre=star_ops.build_dim_titre(landing.with_titles(kept, landing.title_records(spark, sf_dir))),
        dim_artiste=_valid_artists(spark, sf_dir, kept),
        dim_date=star_ops.dim_date_table(star_ops.build_dim_date(kept)),
    )
    return history_plan.quality_report(_kept_history(spark, star))


def q_first_seen_merged(spark, sf_dir):
    # explicit titles land first, the others after them, among them entries that
    # come before a kept one in the walk; some entries land twice
    entries = landing.chart_entries(spark, sf_dir)
    root = scratch_dir(spark, "first-seen")
    first_seen_plan.merge(entries.where("explicit_lyrics"), root)
    first_seen_plan.merge(entries.where("NOT explicit_lyrics"), root)
    first_seen_plan.merge(entries.where(F.col("date_snapshot") == REPORT_SNAPSHOT), root)
    return first_seen_plan.read(spark, root, entries.schema)


def _registered(spark, sf_dir, before_write: bool = False) -> str:
    root = scratch_dir(spark, "curated")
    db = "charts_" + root.rsplit("-", 1)[-1]
    if before_write:
        catalog.register_curated(spark, db, root, db_location=f"{root}_db")
        lake_sink.publish_star(_star(spark, sf_dir), root)
        # one value a snapshot
        written = lake_src.read_table(spark, root, "dim_date").select("date").distinct().collect()
        catalog.add_partitions(spark, [f"{db}.{t}" for t in schemas.CURATED], [r.date for r in written])
        return db
    root, _ = _published(spark, sf_dir)
    catalog.register_curated(spark, db, root, db_location=f"{root}_db")
    catalog.recover_partitions(spark, [f"{db}.{t}" for t in schemas.CURATED])
    return db


def q_catalog_tables(spark, sf_dir):
    return reports.genre_popularity(lake_src.catalog_star(spark, _registered(spark, sf_dir)))


def q_catalog_partitions(spark, sf_dir):
    db = _registered(spark, sf_dir, before_write=True)
    return catalog.partitions(spark, f"{db}.fait_popularite")


def q_retention_expired(spark, sf_dir):
    raw_root = _landed_raw(spark, sf_dir)
    db = "raw_" + raw_root.rsplit("-", 1)[-1]
    catalog.create_database(spark, db, f"{raw_root}_db")
    catalog.register_table(
        spark, db, "documents", raw_root, schemas.RAW_DOCUMENT, fmt="json", partition_by=("date", "kind")
    )
    catalog.recover_partitions(spark, [f"{db}.documents"])
    expired = catalog.expired_partitions(catalog.partitions(spark, f"{db}.documents"), as_of=REPORT_SNAPSHOT)
    catalog.drop_partitions(spark, f"{db}.documents", [r.date for r in expired.select("date").collect()])
    left = spark.table(f"{db}.documents").where(F.col("kind") == "tracks")
    return left.groupBy("date").agg(F.sum(F.size("tracks")).alias("n_tracks"))


def q_report_sink(spark, sf_dir):
    out = lake_sink.write_report(
        reports.genre_popularity(_star(spark, sf_dir)), scratch_dir(spark, "reports"), "genre_popularity"
    )
    return spark.read.parquet(out)


def q_load_metrics(spark, sf_dir):
    _, metrics = _published(spark, sf_dir)
    return spark.createDataFrame(sorted(metrics.items()), "table_name string, n_rows long")


def q_snapshot_read(spark, sf_dir):
    root, _ = _published(spark, sf_dir)
    return lake_src.read_partition(spark, root, "fait_popularite", REPORT_SNAPSHOT)


def q_freshness_partition(spark, sf_dir):
    db = _registered(spark, sf_dir)
    return catalog.partition_freshness(spark, f"{db}.fait_popularite", [REPORT_SNAPSHOT, ABSENT_SNAPSHOT])


def q_stream_snapshot_ingest(spark, sf_dir):
    raw_root = _landed_raw(spark, sf_dir)
    staging_root, curated_root = scratch_dir(spark, "staging"), scratch_dir(spark, "curated")
    query = snapshot_ingest.start_snapshot_ingest(
        spark, raw_root, staging_root, curated_root, scratch_dir(spark, "stream-ckpt")
    )
    query.awaitTermination()
    return lake_src.read_table(spark, curated_root, "fait_popularite")


def library_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries of the chart operators."""
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "raw_roundtrip": q_raw_roundtrip,
        "staging_titres": q_staging_titres,
        "staging_artistes": q_staging_artistes,
        "snapshot_date_from_path": q_snapshot_date_from_path,
        "snapshot_overwrite": q_snapshot_overwrite,
        "write_modes": q_write_modes,
        "catalog_tables": q_catalog_tables,
        "catalog_partitions": q_catalog_partitions,
        "retention_expired": q_retention_expired,
        "report_sink": q_report_sink,
        "load_metrics": q_load_metrics,
        "snapshot_read": q_snapshot_read,
        "freshness_partition": q_freshness_partition,
        "published_versions": q_published_versions,
        "history_genre_popularity": _history(history_plan.genre_popularity),
        "history_bpm_by_genre": _history(history_plan.bpm_by_genre),
        "history_catalog_overview": _history(history_plan.catalog_overview),
        "history_emerging_artists": _history(history_plan.emerging_artists),
        "history_quality": q_history_quality,
        "stream_snapshot_ingest": q_stream_snapshot_ingest,
        "single_snapshot_gate": q_single_snapshot_gate,
        "dq_unicite": q_dq_unicite,
        "dq_completude": q_dq_completude,
        "dq_validite": q_dq_validite,
        "dq_coherence": q_dq_coherence,
        "dq_fraicheur": q_dq_fraicheur,
        "dq_report": q_dq_report,
        "dq_report_by_date": q_dq_report_by_date,
        "genre_exclude_all": q_genre_exclude_all,
        "envelope_reject": q_envelope_reject,
        "chart_pages_read": q_chart_pages_read,
        "page_gaps": q_page_gaps,
        "track_flatten": q_track_flatten,
        "required_fields": q_required_fields,
        "typed_fields": q_typed_fields,
        "artist_enrich": q_artist_enrich,
        "distinct_artists": q_distinct_artists,
        "genre_yield": q_genre_yield,
        "extract_summary": q_extract_summary,
        "extract_titles": q_extract_titles,
        "extract_artists": q_extract_artists,
        "extract_rejects": q_extract_rejects,
        "first_seen_dedup": q_first_seen_dedup,
        "first_seen_merged": q_first_seen_merged,
        "dim_titre": q_dim_titre,
        "dim_artiste": q_dim_artiste,
        "fait_popularite": q_fait_popularite,
        "dim_date": q_dim_date,
        "star_view": q_star_view,
    }
    for key, name in _REPORT_KEYS.items():
        q[key] = _report(name, REPORT_SNAPSHOT)
        q[f"{key}_history"] = _report(name, None)
    return q


_REPORT_KEYS = {
    "rpt_genre_popularity": "genre_popularity",
    "rpt_top_artists": "top_artists",
    "rpt_bpm_by_genre": "bpm_by_genre",
    "rpt_catalog_overview": "catalog_overview",
    "rpt_emerging_artists": "emerging_artists",
}

# -------------------------------------------------------------- oracle SQL
_BASE = """
WITH entries AS (
    SELECT CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS VARCHAR) AS date_snapshot,
           l_partkey AS id,
           CAST(l_linenumber AS BIGINT) AS genre_id,
           l_orderkey AS position,
           l_suppkey AS artist_id,
           CAST(floor(l_extendedprice) AS BIGINT) AS rank,
           l_returnflag = 'R' AS explicit_lyrics
    FROM lineitem
), chart AS (
    SELECT e.id, t.title, t.duration, e.rank, t.bpm, t.gain, e.explicit_lyrics,
           e.artist_id, e.genre_id, e.date_snapshot, e.position
    FROM entries e LEFT JOIN (
        SELECT p_partkey AS id, p_name AS title, p_size AS duration,
               CASE WHEN p_size % 5 = 0 THEN CAST(p_size * 6 AS DOUBLE) END AS bpm,
               p_retailprice AS gain
        FROM part) t ON t.id = e.id
), titles AS (
    SELECT p_partkey AS id, p_name AS title, p_size AS duration,
           CASE WHEN p_size % 5 = 0 THEN CAST(p_size * 6 AS DOUBLE) END AS bpm,
           p_retailprice AS gain
    FROM part
), kept AS (
    SELECT * FROM entries
    QUALIFY row_number() OVER (PARTITION BY date_snapshot, id
                               ORDER BY genre_id NULLS FIRST, position NULLS FIRST,
                                        artist_id NULLS FIRST, rank NULLS FIRST,
                                        explicit_lyrics NULLS FIRST) = 1
), titres AS (
    SELECT k.id, t.title, t.duration, k.rank, t.bpm, t.gain, k.explicit_lyrics,
           k.artist_id, k.genre_id, k.date_snapshot
    FROM kept k LEFT JOIN titles t ON t.id = k.id
), artistes AS (
    SELECT d.artist_id AS id, s.s_name AS name,
           CAST(floor(s.s_acctbal * 100) AS BIGINT) AS nb_fan,
           CAST(s.s_nationkey AS BIGINT) AS nb_album,
           d.date_snapshot AS "date"
    FROM (SELECT DISTINCT date_snapshot, artist_id FROM titres) d
    LEFT JOIN supplier s ON s.s_suppkey = d.artist_id
), fait_popularite AS (
    SELECT date_snapshot, id AS id_titre, artist_id AS id_artiste,
           rank AS score_popularite, date_snapshot AS "date"
    FROM titres
), dim_titre AS (
    SELECT id AS id_titre, title AS nom, duration AS duree, bpm, gain,
           genre_id AS genre, date_snapshot AS "date"
    FROM titres
), dim_artiste AS (
    SELECT id AS id_artiste, name AS nom, nb_fan, nb_album, "date" FROM artistes
), artists AS (
    SELECT s_suppkey AS id, s_name AS name, CAST(floor(s_acctbal * 100) AS BIGINT) AS nb_fan,
           CAST(s_nationkey AS BIGINT) AS nb_album
    FROM supplier
), paged AS (
    SELECT * EXCLUDE (rn, chart_len),
           CAST((rn - 1) // 100 AS INTEGER) AS page_no,
           CAST((rn - 1) % 100 AS INTEGER) AS page_pos,
           chart_len > ((rn - 1) // 100 + 1) * 100 AS has_next
    FROM (SELECT *,
                 row_number() OVER (PARTITION BY date_snapshot, genre_id
                                    ORDER BY position NULLS FIRST, id NULLS FIRST, artist_id NULLS FIRST,
                                             rank NULLS FIRST, explicit_lyrics NULLS FIRST) AS rn,
                 count(*) OVER (PARTITION BY date_snapshot, genre_id) AS chart_len
          FROM chart)
), dim_date AS (
    SELECT CAST(d AS DATE) AS "date",
           CAST(dayofmonth(CAST(d AS DATE)) AS INTEGER) AS jour,
           CAST(weekofyear(CAST(d AS DATE)) AS INTEGER) AS semaine,
           CAST(month(CAST(d AS DATE)) AS INTEGER) AS mois,
           CAST(quarter(CAST(d AS DATE)) AS INTEGER) AS trimestre
    FROM (SELECT DISTINCT date_snapshot AS d FROM fait_popularite)
)
"""


def _filter(alias: str, snapshot: str | None) -> str:
    return "" if snapshot is None else f"AND {alias}.\"date\" = '{snapshot}'"


def _report_sql(snapshot: str | None) -> dict[str, str]:
    on = "TRUE" if snapshot is None else f"\"date\" = '{snapshot}'"
    tie = "" if snapshot else ', "date"'
    # the fact with its title's genre, and with its artist, at the wanted dates
    charted = f"(SELECT * FROM fait_popularite JOIN dim_titre USING (id_titre, \"date\") WHERE {on})"
    played = f"(SELECT * FROM fait_popularite JOIN dim_artiste USING (id_artiste, \"date\") WHERE {on})"
    return {
        "rpt_genre_popularity": f"""
            SELECT genre, AVG(score_popularite) AS score_popularite_moyen, COUNT(*) AS nb_titres
            FROM {charted} GROUP BY ALL""",
        "rpt_top_artists": f"""
            SELECT id_artiste, nom, nb_fan, nb_album FROM dim_artiste WHERE {on}
            QUALIFY row_number() OVER (ORDER BY nb_fan DESC NULLS LAST, id_artiste{tie}) <= 20""",
        "rpt_bpm_by_genre": f"""
            SELECT genre, MAX(bpm) AS bpm_max, MIN(bpm) AS bpm_min, AVG(bpm) AS bpm_moyen,
                   COUNT(bpm) AS nb_titres_avec_bpm
            FROM dim_titre WHERE {on} GROUP BY ALL""",
        "rpt_catalog_overview": f"""
            SELECT genre, COUNT(DISTINCT id_artiste) AS nb_artistes, COUNT(DISTINCT id_titre) AS nb_titres
            FROM {charted} GROUP BY ALL""",
        "rpt_emerging_artists": f"""
            SELECT * FROM (
                SELECT id_artiste, nom, nb_fan, COUNT(*) AS nb_titres_classes,
                       AVG(score_popularite) AS score_popularite_moyen
                FROM {played} WHERE nb_fan < 500000 GROUP BY ALL)
            QUALIFY row_number() OVER (
                ORDER BY score_popularite_moyen DESC NULLS LAST, id_artiste, nom, nb_fan) <= 20""",
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query; those of the training-data operators where they are installed."""
    return library_queries() | (llm_queries.QUERIES if llm_queries else {}) | (
        {"pipeline": corpus_pipeline.run} if corpus_pipeline else {}
    )


def oracle_sql() -> dict[str, str]:
    sql = library_oracle_sql() | (llm_queries.ORACLE_SQL if llm_queries else {})
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql


def library_oracle_sql() -> dict[str, str]:
    body = {
        "first_seen_dedup": "SELECT * FROM titres",
        "first_seen_merged": "SELECT * FROM kept",
        "dim_titre": "SELECT * FROM dim_titre",
        "dim_artiste": "SELECT * FROM dim_artiste",
        "fait_popularite": "SELECT * FROM fait_popularite",
        "dim_date": "SELECT * FROM dim_date",
        "star_view": """
            SELECT fp."date", fp.id_artiste, fp.id_titre, fp.date_snapshot, fp.score_popularite,
                   dt.nom AS titre, dt.duree, dt.bpm, dt.gain, dt.genre,
                   da.nom AS artiste, da.nb_fan, da.nb_album,
                   dd.jour, dd.semaine, dd.mois, dd.trimestre
            FROM fait_popularite fp
            LEFT JOIN dim_titre dt ON dt.id_titre = fp.id_titre AND dt."date" = fp."date"
            LEFT JOIN dim_artiste da ON da.id_artiste = fp.id_artiste AND da."date" = fp."date"
            LEFT JOIN dim_date dd ON CAST(dd."date" AS VARCHAR) = fp."date"
        """,
    }
    body.update(_lake_sql())
    body.update(_ingest_sql())
    body.update(_quality_sql())
    for key, sql in _report_sql(REPORT_SNAPSHOT).items():
        body[key] = sql
    for key, sql in _report_sql(None).items():
        body[f"{key}_history"] = sql
    return {k: _BASE + v for k, v in body.items()}


def _rule(name: str, violations: str, observed: str, threshold: str, passed: str) -> str:
    return (
        f"SELECT '{name}' AS rule, CAST({violations} AS BIGINT) AS violations, "
        f"CAST({observed} AS DOUBLE) AS observed, CAST({threshold} AS DOUBLE) AS threshold, "
        f"({passed}) AS passed"
    )


def _zero(name: str, v: str, threshold: str = "0.0") -> str:
    return _rule(name, v, v, threshold, f"{v} = 0")


def _completude(name: str, table: str, column: str) -> str:
    present = f"{column} IS NOT NULL AND NOT isnan(CAST({column} AS DOUBLE))"
    return _rule(
        name, "n - ok", "CASE WHEN n > 0 THEN ok / n END", "0.98", "n > 0 AND COALESCE(ok / n > 0.98, FALSE)"
    ) + f" FROM (SELECT COUNT(*) AS n, COUNT_IF({present}) AS ok FROM {table})"


def _validite(bpm_high: float) -> str:
    bad_bpm = f"bpm IS NOT NULL AND NOT isnan(bpm) AND (bpm < 0 OR bpm > {bpm_high})"
    return f"""
        {_zero("validite_score", "s")}
        FROM (SELECT COUNT_IF(score_popularite IS NOT NULL AND score_popularite < 0) AS s FROM fait_popularite)
        UNION ALL {_zero("validite_duree", "d")}
        FROM (SELECT COUNT_IF(duree <= 0) AS d FROM dim_titre)
        UNION ALL {_zero("validite_bpm", "b", str(bpm_high))}
        FROM (SELECT COUNT_IF({bad_bpm}) AS b FROM dim_titre)"""


def _unicite(table: str) -> str:
    return f"""{_zero("unicite", "d")}
        FROM (SELECT COALESCE(SUM(n - 1), 0) AS d
              FROM (SELECT COUNT(*) AS n FROM {table} GROUP BY id_titre, date_snapshot))"""


def _coherence(dim: str) -> str:
    return f"""{_zero("coherence", "o")}
        FROM (SELECT COALESCE(COUNT(*), 0) AS o FROM fait_popularite fp
              WHERE NOT EXISTS (SELECT 1 FROM {dim} da
                                WHERE da.id_artiste IS NOT DISTINCT FROM fp.id_artiste
                                  AND da."date" = fp."date"))"""


def _fraicheur(d: str) -> str:
    return _rule("fraicheur", "CASE WHEN f > 0 THEN 0 ELSE 1 END", "f", "NULL", "f > 0") + (
        f" FROM (SELECT COUNT_IF(date_snapshot = '{d}') AS f FROM fait_popularite)"
    )


_VALID_DIM = """, valid_dim AS (
    SELECT d.artist_id AS id_artiste, d.date_snapshot AS "date"
    FROM (SELECT DISTINCT date_snapshot, artist_id FROM titres) d
    JOIN artists a ON a.id = d.artist_id
    WHERE a.nb_fan IS NULL OR a.nb_fan >= 0)
"""


def _by_date_sql(bpm_high: float) -> str:
    """Every rule for each snapshot, over the chart rows before dedup."""
    rules = [
        _zero("unicite", "dup"),
        _rule("completude", "n - ok", "ok / n", "0.98", "ok / n > 0.98"),
        _zero("validite_score", "s"),
        _rule("fraicheur", "0", "n", "NULL", "n > 0"),
        _zero("validite_duree", "d"),
        _zero("validite_bpm", "b", str(bpm_high)),
        _zero("coherence", "o"),
    ]
    return f"""{_VALID_DIM}, facts AS (
        SELECT date_snapshot AS "date", COUNT(*) AS n, COUNT(rank) AS ok, COUNT_IF(rank < 0) AS s,
               COUNT(*) - COUNT(DISTINCT id) AS dup
        FROM chart GROUP BY ALL
    ), profiles AS (
        SELECT "date", COUNT_IF(duree <= 0) AS d, COUNT_IF(bpm < 0 OR bpm > {bpm_high}) AS b
        FROM dim_titre GROUP BY ALL
    ), orphans AS (
        SELECT c.date_snapshot AS "date", COUNT_IF(v.id_artiste IS NULL) AS o
        FROM chart c LEFT JOIN valid_dim v ON v.id_artiste = c.artist_id AND v."date" = c.date_snapshot
        GROUP BY ALL
    ), days AS (SELECT * FROM facts JOIN profiles USING ("date") JOIN orphans USING ("date"))
    """ + " UNION ALL ".join(r.replace("SELECT ", 'SELECT "date", ', 1) + " FROM days" for r in rules)


def _quality_sql() -> dict[str, str]:
    return {
        "single_snapshot_gate": """
            SELECT COUNT(DISTINCT date_snapshot) AS n_snapshots, MIN(date_snapshot) AS first_snapshot,
                   MAX(date_snapshot) AS last_snapshot
            FROM fait_popularite""",
        "dq_unicite": ", chart_fait AS (SELECT id AS id_titre, date_snapshot FROM chart) " + _unicite("chart_fait"),
        "dq_completude": _completude("completude", "fait_popularite", "score_popularite")
        + " UNION ALL "
        + _completude("completude_bpm", "dim_titre", "bpm"),
        "dq_validite": _validite(150.0),
        "dq_coherence": _VALID_DIM + _coherence("valid_dim"),
        "dq_fraicheur": _fraicheur(REPORT_SNAPSHOT) + " UNION ALL " + _fraicheur(ABSENT_SNAPSHOT),
        "dq_report_by_date": _by_date_sql(150.0),
        "history_quality": _by_date_sql(300.0),
        "dq_report": " UNION ALL ".join(
            [
                _unicite("fait_popularite"),
                _completude("completude", "fait_popularite", "score_popularite"),
                _validite(300.0),
                _coherence("dim_artiste"),
                _fraicheur(REPORT_SNAPSHOT),
            ]
        ),
    }


_EXTRACTED = """, extracted AS (
    SELECT id, title, duration, rank, bpm, gain, explicit_lyrics, artist_id, genre_id, date_snapshot
    FROM (
        SELECT * FROM paged
        WHERE genre_id IN (SELECT n_nationkey FROM nation WHERE n_nationkey IS DISTINCT FROM 0) AND id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY date_snapshot, id ORDER BY genre_id, page_no, page_pos) = 1
    )
    WHERE title IS NOT NULL AND duration IS NOT NULL AND rank IS NOT NULL
      AND artist_id IS NOT NULL
)"""


_WALK = """, walk AS (
    SELECT date_snapshot, CAST(n_nationkey AS BIGINT) AS genre_id
    FROM (SELECT DISTINCT date_snapshot FROM entries), nation
    WHERE n_nationkey IS NOT NULL AND n_nationkey <> 0
)"""


def _typed_fields_sql() -> str:
    none = "FALSE"
    # field, declared type, absent, null, of a wrong type
    fields = [
        ("id", "bigint", "id IS NULL", none, none),
        ("title", "string", "title IS NULL", "genre_id = 4 AND title IS NOT NULL", none),
        ("duration", "int", "duration IS NULL", none, none),
        ("rank", "bigint", "rank IS NULL", none, "genre_id = 3 AND rank IS NOT NULL"),
        ("bpm", "double", "bpm IS NULL", none, none),
        ("gain", "double", "gain IS NULL OR genre_id = 2", none, none),
        ("explicit_lyrics", "boolean", "explicit_lyrics IS NULL", none, "genre_id = 5 AND explicit_lyrics"),
        ("artist", "struct<id:bigint>", "genre_id = 6", none, none),
        ("artist.id", "bigint", "artist_id IS NULL OR genre_id = 6", none, none),
    ]
    return " UNION ALL ".join(
        f"""SELECT date_snapshot, '{name}' AS field, '{declared}' AS declared, COUNT(*) AS n_tracks,
            CAST(COUNT_IF({absent}) AS BIGINT) AS n_absent, CAST(COUNT_IF({null}) AS BIGINT) AS n_null,
            CAST(COUNT_IF({wrong}) AS BIGINT) AS n_wrong_type FROM chart GROUP BY date_snapshot"""
        for name, declared, absent, null, wrong in fields
    )


def _ingest_sql() -> dict[str, str]:
    track_cols = "id, title, duration, rank, bpm, gain, explicit_lyrics, artist_id, genre_id"
    return {
        "genre_exclude_all": """
            SELECT g.id, g.name, CAST(COALESCE(c.n, 0) AS BIGINT) AS n_entries
            FROM (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation
                  WHERE n_nationkey IS DISTINCT FROM 0) g
            LEFT JOIN (SELECT genre_id, COUNT(*) AS n FROM entries GROUP BY genre_id) c
                   ON c.genre_id = g.id""",
        "envelope_reject": """
            , bodies AS (
                SELECT event_id, event_type,
                       CASE WHEN event_type = 'error' THEN '{"error": ' || props || '}' ELSE props END AS body
                FROM events)
            SELECT event_id, event_type, body, CAST(json_extract(body, '$.error') AS VARCHAR) AS error
            FROM bodies
            WHERE CASE WHEN json_valid(body) AND json_type(body) = 'OBJECT'
                       THEN list_contains(json_keys(body), 'error') ELSE FALSE END""",
        "extract_rejects": """
            , bodies AS (
                SELECT CASE WHEN event_type = 'error' THEN '{"error": ' || props || '}' ELSE props END AS body
                FROM events)
            SELECT 'artist' AS endpoint, body,
                   CASE WHEN json_valid(body) THEN CAST(json_extract(body, '$.error') AS VARCHAR)
                        ELSE 'unparsable body' END AS error
            FROM bodies
            WHERE body IS NULL OR NOT json_valid(body) OR list_contains(json_keys(body), 'error')""",
        "chart_pages_read": """
            SELECT date_snapshot, genre_id, page_no, COUNT(*) AS n_tracks FROM paged GROUP BY ALL""",
        "page_gaps": f"""{_WALK}, short AS (
                SELECT date_snapshot, genre_id, page_no, chart_len > (page_no + 1) * 10 AS has_next
                FROM (SELECT date_snapshot, genre_id, unnest(range((n + 9) // 10)) AS page_no, n AS chart_len
                      FROM (SELECT date_snapshot, genre_id, count(*) AS n FROM chart GROUP BY ALL))
            ), landed AS (
                SELECT * REPLACE (has_next AND NOT (genre_id % 2 = 0 AND page_no = 3) AS has_next) FROM short
                WHERE (page_no * 7 + genre_id * 3 + CAST(substr(date_snapshot, 6, 2) AS INTEGER)) % 5 <> 0
            ), charts AS (
                SELECT w.date_snapshot, w.genre_id, min(page_no) FILTER (NOT has_next) AS ends, max(page_no) AS last
                FROM walk w LEFT JOIN landed l USING (date_snapshot, genre_id) GROUP BY ALL
            ), missing AS (
                SELECT date_snapshot, genre_id, page_no,
                       page_no - row_number() OVER (PARTITION BY date_snapshot, genre_id ORDER BY page_no) AS island
                FROM (SELECT date_snapshot, genre_id, unnest(range(COALESCE(ends, last))) AS page_no FROM charts)
                ANTI JOIN landed USING (date_snapshot, genre_id, page_no)
            )
            SELECT date_snapshot, genre_id, 'gap' AS kind, CAST(min(page_no) AS INTEGER) AS first_page,
                   CAST(max(page_no) AS INTEGER) AS last_page
            FROM missing GROUP BY date_snapshot, genre_id, island
            UNION ALL
            SELECT date_snapshot, genre_id, CASE WHEN last IS NULL THEN 'unlanded' ELSE 'open' END,
                   CAST(COALESCE(last + 1, 0) AS INTEGER), NULL
            FROM charts WHERE ends IS NULL""",
        "track_flatten": f"SELECT date_snapshot, {track_cols}, page_no, page_pos FROM paged",
        "required_fields": """
            SELECT COUNT(*) AS n_tracks,
                   CAST(COUNT_IF(id IS NULL) AS BIGINT) AS missing_id,
                   CAST(COUNT_IF(title IS NULL) AS BIGINT) AS missing_title,
                   CAST(COUNT_IF(duration IS NULL) AS BIGINT) AS missing_duration,
                   CAST(COUNT_IF(rank IS NULL) AS BIGINT) AS missing_rank,
                   CAST(COUNT_IF(artist_id IS NULL) AS BIGINT) AS missing_artist_id,
                   CAST(COUNT_IF(id IS NULL OR title IS NULL OR duration IS NULL OR rank IS NULL
                                 OR artist_id IS NULL) AS BIGINT) AS n_rejected
            FROM chart""",
        "typed_fields": _typed_fields_sql(),
        "artist_enrich": """
            SELECT d.date_snapshot, d.artist_id AS id, a.name, a.nb_fan, a.nb_album,
                   a.id IS NOT NULL AS resolved
            FROM (SELECT DISTINCT date_snapshot, artist_id FROM titres) d
            LEFT JOIN artists a ON a.id = d.artist_id""",
        "distinct_artists": "SELECT DISTINCT date_snapshot, artist_id FROM titres",
        "extract_titles": f"{_EXTRACTED} SELECT * FROM extracted",
        "extract_artists": f"""{_EXTRACTED}
            SELECT d.artist_id AS id, a.name, a.nb_fan, a.nb_album, d.date_snapshot AS "date"
            FROM (SELECT DISTINCT date_snapshot, artist_id FROM extracted) d
            JOIN artists a ON a.id = d.artist_id""",
        "genre_yield": f"""{_WALK}
            SELECT date_snapshot, genre_id, CAST(SUM(received) AS BIGINT) AS n_received,
                   CAST(SUM(new) AS BIGINT) AS n_new
            FROM (SELECT date_snapshot, genre_id, 1 AS received, 0 AS new FROM entries
                  UNION ALL SELECT date_snapshot, genre_id, 0, 1 FROM kept
                  UNION ALL SELECT date_snapshot, genre_id, 0, 0 FROM walk)
            GROUP BY ALL""",
        "extract_summary": f"""{_WALK}
            SELECT w.date_snapshot, w.n AS n_genres, t.n AS n_tracks, a.n AS n_artists
            FROM (SELECT date_snapshot, COUNT(*) AS n FROM walk GROUP BY ALL) w
            JOIN (SELECT date_snapshot, COUNT(*) AS n FROM titres GROUP BY ALL) t USING (date_snapshot)
            JOIN (SELECT "date" AS date_snapshot, COUNT(*) AS n FROM artistes GROUP BY ALL) a USING (date_snapshot)""",
    }


def _lake_sql() -> dict[str, str]:
    history = _report_sql(None)
    r1_history = history["rpt_genre_popularity"]
    d, absent = REPORT_SNAPSHOT, ABSENT_SNAPSHOT
    fresh = lambda x: f"""SELECT 'fraicheur_partition' AS rule, '{x}' AS "date",
            CAST(CASE WHEN n > 0 THEN 0 ELSE 1 END AS BIGINT) AS violations,
            CAST(n AS DOUBLE) AS observed, n > 0 AS passed
        FROM (SELECT COUNT(*) AS n FROM fait_popularite WHERE "date" = '{x}')"""  # noqa: E731
    return {
        "raw_roundtrip": "SELECT * FROM titres",
        "staging_titres": "SELECT * FROM titres",
        "staging_artistes": "SELECT * FROM artistes",
        "snapshot_date_from_path": """
            SELECT COALESCE(t.d, a.d) AS date_snapshot, CAST(COALESCE(t.n, 0) AS BIGINT) AS n_tracks,
                   CAST(COALESCE(a.n, 0) AS BIGINT) AS n_artists
            FROM (SELECT date_snapshot AS d, COUNT(*) AS n FROM titres GROUP BY ALL) t
            FULL JOIN (SELECT "date" AS d, COUNT(*) AS n FROM artistes GROUP BY ALL) a ON a.d = t.d""",
        "snapshot_overwrite": f"""
            SELECT date_snapshot, id AS id_titre, artist_id AS id_artiste, rank AS score_popularite,
                   date_snapshot AS "date"
            FROM chart WHERE date_snapshot <> '{d}'
            UNION ALL
            SELECT * FROM fait_popularite WHERE "date" = '{d}'""",
        "write_modes": f"""
            SELECT "date", CAST(CASE WHEN "date" = '{d}' THEN n ELSE 2 * n END AS BIGINT) AS n_rows
            FROM (SELECT "date", COUNT(*) AS n FROM fait_popularite GROUP BY ALL)""",
        "catalog_tables": r1_history,
        "catalog_partitions": 'SELECT DISTINCT "date" FROM fait_popularite',
        "retention_expired": f"""
            SELECT date_snapshot AS "date", COUNT(*) AS n_tracks
            FROM titres
            WHERE CAST(date_snapshot AS DATE) >= DATE '{d}' - INTERVAL 100 DAY
            GROUP BY ALL""",
        "report_sink": r1_history,
        "load_metrics": """
            SELECT 'dim_artiste' AS table_name, COUNT(*) AS n_rows FROM dim_artiste
            UNION ALL SELECT 'dim_date', COUNT(*) FROM dim_date
            UNION ALL SELECT 'dim_titre', COUNT(*) FROM dim_titre
            UNION ALL SELECT 'fait_popularite', COUNT(*) FROM fait_popularite""",
        "snapshot_read": f"""SELECT * FROM fait_popularite WHERE "date" = '{d}'""",
        "freshness_partition": fresh(d) + " UNION ALL " + fresh(absent),
        "published_versions": f"""
            SELECT f."date", f.n AS fait_popularite, t.n AS dim_titre, a.n AS dim_artiste,
                   CAST(1 AS BIGINT) AS dim_date,
                   CASE WHEN f."date" = '{d}' OR c.n = c.ids THEN 'run-2' ELSE 'run-1' END AS version
            FROM (SELECT "date", COUNT(*) AS n FROM fait_popularite GROUP BY ALL) f
            JOIN (SELECT "date", COUNT(*) AS n FROM dim_titre GROUP BY ALL) t USING ("date")
            JOIN (SELECT "date", COUNT(*) AS n FROM dim_artiste GROUP BY ALL) a USING ("date")
            JOIN (SELECT date_snapshot AS "date", COUNT(*) AS n, COUNT(DISTINCT id) AS ids
                  FROM chart GROUP BY ALL) c USING ("date")""",
        "stream_snapshot_ingest": "SELECT * FROM fait_popularite",
        "history_genre_popularity": r1_history,
        "history_bpm_by_genre": history["rpt_bpm_by_genre"],
        "history_catalog_overview": history["rpt_catalog_overview"],
        "history_emerging_artists": history["rpt_emerging_artists"],
    }
