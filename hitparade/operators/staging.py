"""Raw documents → staging ``titres`` and ``artistes``.

Explode the arrays, project the typed columns, deduplicate per (snapshot, id)
deterministically (the legacy ``dropDuplicates`` kept an arbitrary row), and
stamp the snapshot date taken from the path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitparade import schemas
from hitparade.operators.ingest import PARTS_PER_DATE, first_seen, first_seen_by_date

# Order among duplicates of one id in a snapshot: the walk (genre's place in the
# list, place in the chart), then place in the document (the walk of a legacy
# document), then every other column so the choice is total.
TITRE_ORDER = (
    "_walk.genre_ordinal", "_walk.position", "_doc_pos",
    "genre_id", "artist_id", "rank", "explicit_lyrics", "title", "duration", "bpm", "gain",
)
ARTISTE_ORDER = ("_doc_pos", "name", "nb_fan", "nb_album")


def explode_tracks(raw: DataFrame) -> DataFrame:
    """One row per track element (null/empty array → no row; a null element →
    an all-null row), with ``_doc_pos`` = its index in the document and ``_walk``
    = where the line stood in the walk (null without one)."""
    walk = F.col("walk") if "walk" in raw.columns else F.lit(None).cast(schemas.WALK)
    return raw.select(
        "date_snapshot", walk.alias("_walk"), F.posexplode("tracks").alias("_doc_pos", "t")
    ).select("t.*", "date_snapshot", "_doc_pos", "_walk")


def explode_artists(raw: DataFrame) -> DataFrame:
    return raw.select(
        "date_snapshot", F.posexplode("artists").alias("_doc_pos", "a")
    ).select("a.*", "date_snapshot", "_doc_pos")


def build_titres(raw: DataFrame, snapshot_date: str | None = None, parts: int = PARTS_PER_DATE) -> DataFrame:
    """Staging titles: the nine track columns + ``date_snapshot``, one row per
    (snapshot, id), laid out by snapshot, each in ``parts`` (to be written without a further shuffle).
    ``snapshot_date`` overrides the path date (single run)."""
    tracks = explode_tracks(raw)
    if snapshot_date is not None:
        tracks = tracks.withColumn("date_snapshot", F.lit(snapshot_date))
    kept = first_seen_by_date(tracks, TITRE_ORDER, parts)
    return kept.select(*schemas.TRACK_COLUMNS, "date_snapshot")


def build_artistes(raw: DataFrame) -> DataFrame:
    """Staging artists: the four artist columns + ``date``, one row per
    (snapshot, id)."""
    kept = first_seen(explode_artists(raw), ("date_snapshot", "id"), ARTISTE_ORDER)
    return kept.select(*schemas.ARTIST_COLUMNS, F.col("date_snapshot").alias("date"))
