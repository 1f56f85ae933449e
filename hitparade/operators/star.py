"""Staging titles/artists → the curated star (one fact, three dimensions).

Every table carries the STRING partition column ``date`` (the snapshot), so a
single run writes one partition and a backfill writes many. The dimensions are
snapshotted, not merged: a title or artist appears once per date it was seen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitparade import schemas
from hitparade.functions import calendar_parts


@dataclass(frozen=True)
class Star:
    """The four curated tables, lake-shaped (data columns + ``date`` STRING)."""

    fait_popularite: DataFrame
    dim_titre: DataFrame
    dim_artiste: DataFrame
    dim_date: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "fait_popularite": self.fait_popularite,
            "dim_titre": self.dim_titre,
            "dim_artiste": self.dim_artiste,
            "dim_date": self.dim_date,
        }

    def at(self, snapshot_date: str | None) -> Star:
        """The star restricted to one snapshot (partition pruning), or as is."""
        if snapshot_date is None:
            return self
        return Star(*(t.where(F.col("date") == F.lit(snapshot_date)) for t in self.tables().values()))

    def on(self, snapshot_dates: list[str]) -> Star:
        """The star restricted to some snapshots."""
        return Star(*(t.where(F.col("date").isin(snapshot_dates)) for t in self.tables().values()))


def _projected(rows: DataFrame, table: str) -> DataFrame:
    """A curated table's columns taken from its sources, cast to the declared types."""
    sources = schemas.CURATED_SOURCES[table]
    fields = schemas.with_partition(schemas.CURATED[table]).fields
    return rows.select(*[F.col(sources[f.name]).cast(f.dataType).alias(f.name) for f in fields])


def build_dim_titre(titres: DataFrame) -> DataFrame:
    return _projected(titres, "dim_titre")


def build_dim_artiste(artistes: DataFrame) -> DataFrame:
    return _projected(artistes, "dim_artiste")


def build_fait_popularite(entries: DataFrame) -> DataFrame:
    """Grain (title, snapshot); no title attribute is needed, so the entries
    that the dedup kept will do. The score is the raw rank, not normalised."""
    return _projected(entries, "fait_popularite")


def build_dim_date(fait: DataFrame) -> DataFrame:
    """One calendar row per distinct snapshot of the fact (not a gap-free
    calendar): ``date`` DATE, day of month, ISO week, month, quarter.

    The distinct runs on the string first (partial aggregate, a handful of
    rows per task), so the date functions see one row per snapshot.
    """
    dates = fait.select(F.col("date_snapshot")).distinct().select(F.to_date("date_snapshot").alias("date"))
    return dates.select(F.col("date"), *calendar_parts("date"))


def dim_date_table(dim_date: DataFrame) -> DataFrame:
    """Lake shape of dim_date: the DATE becomes the STRING partition value."""
    return dim_date.select("jour", "semaine", "mois", "trimestre", F.col("date").cast("string").alias("date"))


def build_star(titres: DataFrame, artistes: DataFrame, kept: DataFrame | None = None) -> Star:
    """Staging titres (with ``date_snapshot``) and artistes (with ``date``). Where
    the titles are joined on the fly, ``kept`` are the entries before that join:
    the fact is built from them."""
    fait = build_fait_popularite(titres if kept is None else kept)
    return Star(
        fait_popularite=fait,
        dim_titre=build_dim_titre(titres),
        dim_artiste=build_dim_artiste(artistes),
        dim_date=dim_date_table(build_dim_date(fait)),
    )


def snapshot_span(fait: DataFrame) -> DataFrame:
    """One row: number of distinct snapshots, first and last one."""
    return fait.agg(
        F.count_distinct("date_snapshot").alias("n_snapshots"),
        F.min("date_snapshot").alias("first_snapshot"),
        F.max("date_snapshot").alias("last_snapshot"),
    )


class SnapshotGateError(RuntimeError):
    """A single-snapshot run found zero or several snapshot dates."""


def assert_single_snapshot(fait: DataFrame) -> str:
    """The one snapshot date of ``fait``; raise when empty or several.

    Only the one-row :func:`snapshot_span` reaches the driver.
    """
    row = snapshot_span(fait).first()
    if row is None or row["n_snapshots"] != 1:
        n = 0 if row is None else row["n_snapshots"]
        span = "" if not n else f" ({row['first_snapshot']} .. {row['last_snapshot']})"
        raise SnapshotGateError(f"exactly one date_snapshot expected per run, found {n}{span}")
    return row["first_snapshot"]


def star_view(star: Star) -> DataFrame:
    """The fact related to its three dimensions on id_titre, id_artiste, date.

    Left joins from the fact, so every fact row is kept even if a dimension
    row is missing; both sides are planned from their measured size. The
    calendar's columns are functions of the date, so they are computed.
    """
    fp = star.fait_popularite
    dt = star.dim_titre.select(
        "id_titre", F.col("nom").alias("titre"), "duree", "bpm", "gain", "genre", "date"
    )
    da = star.dim_artiste.select("id_artiste", F.col("nom").alias("artiste"), "nb_fan", "nb_album", "date")
    return (
        fp.join(dt, ["id_titre", "date"], "left")
        .join(da, ["id_artiste", "date"], "left")
        .select("*", *calendar_parts(F.to_date("date")))
    )
