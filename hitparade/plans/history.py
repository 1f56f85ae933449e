"""Reports over all of history from results kept by snapshot.

:func:`refresh` builds, for each snapshot whose published version changed and no other,
four small tables that merge: tempi by genre, the ids of each genre's titles and
artists with the titles' scores, scores by artist, and the quality measures. A report over history then adds up
those rows and reads no row of the fact.

* Sums, counts, minima and maxima merge as they are.
* Distinct counts merge as sets. A set is cut into buckets of 32,768 consecutive ids; a bucket holds
  the places of its ids, or, from ``DENSE`` ids on, a bitmap of 4 KB. Buckets of the same ids
  are united by OR and counted: exact, and never more rows than buckets. While it is built a
  bucket travels as the places alone, so a task that has few of its ids ships few.
* The quality rules read their measures, so a gate or a report over a backfill scans
  only what changed; thresholds apply when the report is made.

Results equal the reports of :mod:`hitparade.plans.reports` in history mode (averages of
non-integer tempi up to the order of additions). Top artists need no kept result: that report
reads the artist dimension alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitparade.constants import COMPLETENESS_THRESHOLD, EMERGING_MAX_FANS, TOP_K
from hitparade.operators import quality
from hitparade.operators.star import Star
from hitparade.sinks import kept, versions

#: From how many ids on a bucket is a bitmap: as many places take as many bytes.
DENSE = 1024
#: Part of a build's stamp: results kept in another layout are stale.
LAYOUT = "scores-by-bucket"


def _long(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in names]


def _double(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


TABLES = {
    # a row a genre: its titles' tempi
    "genres": T.StructType([*_long("genre", "bpm_count"), *_double("bpm_sum", "bpm_min", "bpm_max")]),
    # a row a bucket; one of titles has the charted rows of its ids with their scores
    "members": T.StructType(
        [
            *_long("genre"),
            T.StructField("kind", T.StringType()),
            *_long("bucket"),
            T.StructField("places", T.ArrayType(T.IntegerType())),
            T.StructField("bits", T.BinaryType()),
            *_long("charted", "score_sum", "scored"),
        ]
    ),
    "artists": T.StructType(
        [
            *_long("id_artiste"),
            T.StructField("nom", T.StringType()),
            *_long("nb_fan", "score_sum", "scored", "charted"),
        ]
    ),
    "quality": T.StructType(_long(*quality.MEASURES)),
}


class StaleHistoryError(LookupError):
    """Kept results are missing, or older than what is published; ``dates`` are theirs."""

    def __init__(self, dates: list[str]):
        super().__init__(f"no kept results of the published version of {dates}: refresh first")
        self.dates = dates


@dataclass(frozen=True)
class History:
    """The kept tables, as fixed when they were read."""

    genres: DataFrame
    members: DataFrame
    artists: DataFrame
    quality: DataFrame


def _typed(rows: DataFrame, table: str) -> DataFrame:
    fields = [*TABLES[table].fields, T.StructField("date", T.StringType())]
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def _genres(star: Star) -> DataFrame:
    tempi = star.dim_titre.groupBy("date", "genre").agg(
        F.count("bpm").alias("bpm_count"),
        F.sum("bpm").alias("bpm_sum"),
        F.min("bpm").alias("bpm_min"),
        F.max("bpm").alias("bpm_max"),
    )
    return _typed(tempi, "genres")


def _members(star: Star, dense: int) -> DataFrame:
    charted = star.fait_popularite.join(star.dim_titre.select("id_titre", "genre", "date"), ["id_titre", "date"])
    ids = charted.select(
        "date",
        "genre",
        F.explode(
            F.array(
                F.struct(
                    F.lit("titre").alias("kind"),
                    F.col("id_titre").alias("id"),
                    F.lit(1).alias("row"),
                    F.col("score_popularite").alias("score"),
                ),
                F.struct(
                    F.lit("artiste").alias("kind"),
                    F.col("id_artiste").alias("id"),
                    F.lit(None).cast("int").alias("row"),
                    F.lit(None).cast("long").alias("score"),
                ),
            )
        ).alias("_m"),
    ).select("date", "genre", "_m.*")
    bucket = ["date", "genre", "kind", "bucket"]
    # a bucket has at most 32,768 places, so no group grows with the data
    sets = (
        ids.where(F.col("id").isNotNull())
        .withColumns({"bucket": F.bitmap_bucket_number("id"), "place": F.bitmap_bit_position("id").cast("int")})
        .groupBy(*bucket)
        .agg(
            F.sort_array(F.collect_set("place")).alias("places"),
            F.count("row").alias("charted"),
            F.sum("score").alias("score_sum"),
            F.count("score").alias("scored"),
        )
    )
    few = sets.where(F.size("places") < dense)
    # dealt by bucket already: the bitmap is made where the places are
    many = (
        sets.where(F.size("places") >= dense)
        .select(*bucket, "charted", "score_sum", "scored", F.explode("places").alias("place"))
        .groupBy(*bucket)
        .agg(
            F.bitmap_construct_agg("place").alias("bits"),
            *[F.first(c).alias(c) for c in ("charted", "score_sum", "scored")],
        )
    )
    return _typed(few.unionByName(many, allowMissingColumns=True), "members")


def _artists(star: Star) -> DataFrame:
    scores = star.fait_popularite.groupBy("id_artiste", "date").agg(
        F.sum("score_popularite").alias("score_sum"),
        F.count("score_popularite").alias("scored"),
        F.count(F.lit(1)).alias("charted"),
    )
    return _typed(scores.join(star.dim_artiste.select("id_artiste", "nom", "nb_fan", "date"), ["id_artiste", "date"]), "artists")


def _quality(star: Star) -> DataFrame:
    return _typed(quality.measures_by_date(star.fait_popularite, star.dim_titre, star.dim_artiste), "quality")


def _stamp(published) -> str:
    return f"{published.version} {LAYOUT}"


def _stale(spark: SparkSession, curated_root: str, history_root: str) -> tuple[list, list]:
    """(published rows without kept results of their version, kept rows of the others)."""
    published = versions.live(spark, curated_root).orderBy("date").collect()
    have = {r.date: r for r in kept.live(spark, history_root)}
    stale = [r for r in published if r.date not in have or have[r.date].stamp != _stamp(r)]
    gone = {r.date for r in stale}
    return stale, [have[r.date] for r in published if r.date not in gone]


def refresh(spark: SparkSession, curated_root: str, history_root: str, dense: int = DENSE) -> list[str]:
    """Build the kept results of the snapshots whose published version has none; their
    dates. Reads the folders of those snapshots only, and nothing where all are built."""
    stale, _ = _stale(spark, curated_root, history_root)
    if not stale:
        return []
    star = versions.read_rows(spark, curated_root, stale)
    tables = {"genres": _genres(star), "members": _members(star, dense), "artists": _artists(star), "quality": _quality(star)}
    kept.write(spark, history_root, tables, {r.date: _stamp(r) for r in stale})
    return [r.date for r in stale]


def read(spark: SparkSession, curated_root: str, history_root: str) -> History:
    """The kept results of every published snapshot; raises where some are stale."""
    stale, rows = _stale(spark, curated_root, history_root)
    if stale:
        raise StaleHistoryError([r.date for r in stale])
    return History(**{t: kept.read(spark, history_root, t, s, rows) for t, s in TABLES.items()})


def _ratio(total: str, count: str) -> Column:
    return F.try_divide(F.sum(total), F.sum(count))


def genre_popularity(history: History) -> DataFrame:
    """R1 over all snapshots."""
    charted = history.members.where(F.col("kind") == "titre").groupBy("genre")
    return charted.agg(
        F.sum("charted").alias("nb_titres"), _ratio("score_sum", "scored").alias("score_popularite_moyen")
    ).orderBy(F.desc("score_popularite_moyen"), "genre")


def bpm_by_genre(history: History) -> DataFrame:
    """R3 over all snapshots."""
    titles = history.genres.groupBy("genre")
    return titles.agg(
        F.sum("bpm_count").alias("nb_titres_avec_bpm"),
        _ratio("bpm_sum", "bpm_count").alias("bpm_moyen"),
        F.min("bpm_min").alias("bpm_min"),
        F.max("bpm_max").alias("bpm_max"),
    ).orderBy(F.desc_nulls_last("bpm_moyen"), "genre")


def catalog_overview(history: History) -> DataFrame:
    """R4 over all snapshots: the united sets counted. A genre whose charted titles have
    no artist counts none."""
    bucket = ["genre", "kind", "bucket"]
    places = history.members.where(F.col("places").isNotNull()).select(*bucket, F.explode("places").alias("place"))
    listed = places.groupBy(*bucket).agg(F.bitmap_construct_agg("place").alias("bits"))
    mapped = history.members.where(F.col("bits").isNotNull()).select(*bucket, "bits")
    united = listed.unionByName(mapped).groupBy(*bucket).agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))

    def of(kind: str, name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).cast("long").alias(name)

    by_genre = united.groupBy("genre").agg(of("titre", "nb_titres"), of("artiste", "nb_artistes"))
    return by_genre.orderBy(F.desc("nb_titres"), "genre")


def emerging_artists(history: History, max_fans: int = EMERGING_MAX_FANS, k: int = TOP_K) -> DataFrame:
    """R5 over all snapshots."""
    small = history.artists.where(F.col("nb_fan") < F.lit(max_fans)).groupBy("id_artiste", "nom", "nb_fan")
    return (
        small.agg(
            _ratio("score_sum", "scored").alias("score_popularite_moyen"),
            F.sum("charted").alias("nb_titres_classes"),
        )
        .orderBy(F.desc_nulls_last("score_popularite_moyen"), "id_artiste", "nom", "nb_fan")
        .limit(k)
    )


def quality_report(history: History, seuil: float = COMPLETENESS_THRESHOLD) -> DataFrame:
    """The quality rules of every snapshot, from kept measures."""
    return quality.report_of_measures(history.quality, seuil)
