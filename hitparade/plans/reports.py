"""Dashboard reports over the star.

``snapshot_date`` selects one snapshot (a partition filter on every side of a
join, so both scans are pruned); ``None`` is history mode: all snapshots,
still joining on ``date``. Every ordering has an id tie-break so top-k results
are deterministic. No join hints: AQE picks broadcast vs sort-merge from
runtime sizes.

History-mode caveats (same as running the SQL without its date filter):
``nb_titres`` counts title-days, the top-artist list may repeat an artist once
per snapshot, and an artist whose ``nb_fan`` changed is split because
``nb_fan`` is a grouping key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitparade.constants import EMERGING_MAX_FANS, TOP_K
from hitparade.operators.star import Star


def genre_popularity(star: Star, snapshot_date: str | None = None) -> DataFrame:
    """R1 — titles and average popularity by genre, most popular first."""
    s = star.at(snapshot_date)
    joined = s.fait_popularite.join(s.dim_titre, ["id_titre", "date"])
    return (
        joined.groupBy("genre")
        .agg(
            F.count(F.lit(1)).alias("nb_titres"),
            F.avg("score_popularite").alias("score_popularite_moyen"),
        )
        .orderBy(F.desc("score_popularite_moyen"), "genre")
    )


def top_artists(star: Star, snapshot_date: str | None = None, k: int = TOP_K) -> DataFrame:
    """R2 — the ``k`` artists with most fans (dimension only, no join).

    ``TakeOrderedAndProject``: each task keeps its own top-k, the driver merges
    k rows per task — bounded whatever the table size.
    """
    s = star.at(snapshot_date)
    return (
        s.dim_artiste.orderBy(F.desc("nb_fan"), "id_artiste", "date")
        .limit(k)
        .select("id_artiste", "nom", "nb_fan", "nb_album")
    )


def bpm_by_genre(star: Star, snapshot_date: str | None = None) -> DataFrame:
    """R3 — tempo coverage and range by genre. A genre whose titles have no
    bpm still yields a row (count 0, null average/min/max)."""
    s = star.at(snapshot_date)
    return (
        s.dim_titre.groupBy("genre")
        .agg(
            F.count("bpm").alias("nb_titres_avec_bpm"),
            F.avg("bpm").alias("bpm_moyen"),
            F.min("bpm").alias("bpm_min"),
            F.max("bpm").alias("bpm_max"),
        )
        .orderBy(F.desc_nulls_last("bpm_moyen"), "genre")
    )


def catalog_overview(star: Star, snapshot_date: str | None = None, approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    """R4 — distinct titles and distinct artists by genre.

    Two distinct counts over one join: Catalyst expands each row once per
    distinct column and aggregates partially before the shuffle. With
    ``approximate`` the counts are HyperLogLog++ sketches (relative standard
    deviation ``rsd``) merged map-side — one fixed-size buffer per genre per
    task, no per-value shuffle.
    """
    s = star.at(snapshot_date)
    joined = s.dim_titre.join(s.fait_popularite, ["id_titre", "date"])
    if approximate:
        titles = F.approx_count_distinct("id_titre", rsd)
        artists = F.approx_count_distinct("id_artiste", rsd)
    else:
        titles, artists = F.count_distinct("id_titre"), F.count_distinct("id_artiste")
    return (
        joined.groupBy("genre")
        .agg(titles.alias("nb_titres"), artists.alias("nb_artistes"))
        .orderBy(F.desc("nb_titres"), "genre")
    )


def emerging_artists(
    star: Star,
    snapshot_date: str | None = None,
    max_fans: int = EMERGING_MAX_FANS,
    k: int = TOP_K,
) -> DataFrame:
    """R5 — artists with a high average score but fewer than ``max_fans`` fans.

    The fact is pre-aggregated to one row per (artist, snapshot) *before* the
    join — score sum, scored rows, rows — so the join moves one row per artist
    and day instead of one per title, and a hot artist is a single row. The
    average is recombined exactly (integer sums) as sum / count, null when no
    row is scored, like AVG.
    """
    s = star.at(snapshot_date)
    per_day = s.fait_popularite.groupBy("id_artiste", "date").agg(
        F.sum("score_popularite").alias("_sum"),
        F.count("score_popularite").alias("_scored"),
        F.count(F.lit(1)).alias("_rows"),
    )
    artists = s.dim_artiste.where(F.col("nb_fan") < F.lit(max_fans))
    joined = per_day.join(artists, ["id_artiste", "date"])
    return (
        joined.groupBy("id_artiste", "nom", "nb_fan")
        .agg(
            F.try_divide(F.sum("_sum"), F.sum("_scored")).alias("score_popularite_moyen"),
            F.sum("_rows").alias("nb_titres_classes"),
        )
        .orderBy(F.desc_nulls_last("score_popularite_moyen"), "id_artiste", "nom", "nb_fan")
        .limit(k)
    )


REPORTS = {
    "genre_popularity": genre_popularity,
    "top_artists": top_artists,
    "bpm_by_genre": bpm_by_genre,
    "catalog_overview": catalog_overview,
    "emerging_artists": emerging_artists,
}
