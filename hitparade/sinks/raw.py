"""Writer of the raw zone: JSON lines, one bounded document per line.

A title becomes ``{"tracks": [track]}`` under ``date=<snapshot>/kind=tracks/``
and an artist ``{"artists": [artist]}`` under ``date=<snapshot>/kind=artists/``;
the reader explodes both arrays, so the legacy one-document-per-day files and
these lines read the same way, and each staging table lists and parses only
its own kind of document. Rerunning a snapshot replaces only its own
``date=`` folders (dynamic overwrite). Lines repeat their keys, so files are
gzipped; such a file is read by one task, so none holds more than ``FILE_ROWS`` lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitparade import schemas

#: Lines of one raw file.
FILE_ROWS = 500_000


def raw_documents(titres: DataFrame, artistes: DataFrame) -> DataFrame:
    """(tracks, artists, walk, date, kind) rows: one document per title and per artist.

    ``titres`` carry ``date_snapshot``; ``artistes`` carry ``date``. Titles that carry
    ``genre_ordinal`` and ``position`` take them along as ``walk``, so chart rows can be
    landed before any dedup.
    """
    places = schemas.WALK.fieldNames()
    walked = set(places) <= set(titres.columns)
    walk = F.struct(*[F.col(c).cast("long").alias(c) for c in places]) if walked else F.lit(None).cast(schemas.WALK)
    track = F.struct(*[F.col(c) for c in schemas.TRACK_COLUMNS])
    artist = F.struct(*[F.col(c) for c in schemas.ARTIST_COLUMNS])
    # repeats of an artist side by side compress on their way
    artistes = artistes.sortWithinPartitions("date", "id")
    track_docs = titres.select(
        F.array(track).alias("tracks"),
        F.lit(None).cast(schemas.RAW_DOCUMENT["artists"].dataType).alias("artists"),
        walk.alias("walk"),
        F.col("date_snapshot").alias("date"),
        F.lit("tracks").alias("kind"),
    )
    artist_docs = artistes.select(
        F.lit(None).cast(schemas.RAW_DOCUMENT["tracks"].dataType).alias("tracks"),
        F.array(artist).alias("artists"),
        F.lit(None).cast(schemas.WALK).alias("walk"),
        F.col("date"),
        F.lit("artists").alias("kind"),
    )
    return track_docs.unionByName(artist_docs)


def land_raw(titres: DataFrame, artistes: DataFrame, raw_root: str) -> None:
    """Write the snapshots present in the inputs; other dates are untouched."""
    (
        raw_documents(titres, artistes)
        .hint("rebalance", "date", "kind")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", FILE_ROWS)
        .partitionBy("date", "kind")
        .json(raw_root)
    )
