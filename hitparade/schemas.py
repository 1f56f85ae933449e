"""Declared schemas: nothing in the library infers a schema from a sample.

Every field is nullable, as in the landed documents. The partition column is
called ``date`` and is a STRING on every lake table, whatever the data column
is called; readers declare it so partition inference never retypes it.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The names and types of the raw documents, the API bodies and
# the curated tables below are the data contract.
# ---------------------------------------------------------------- raw zone
TRACK = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("duration", T.IntegerType()),
        T.StructField("rank", T.LongType()),
        T.StructField("bpm", T.DoubleType()),
        T.StructField("gain", T.DoubleType()),
        T.StructField("explicit_lyrics", T.BooleanType()),
        T.StructField("artist_id", T.LongType()),
        T.StructField("genre_id", T.LongType()),
    ]
)
TRACK_COLUMNS = [f.name for f in TRACK.fields]

ARTIST = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("nb_fan", T.LongType()),
        T.StructField("nb_album", T.LongType()),
    ]
)
ARTIST_COLUMNS = [f.name for f in ARTIST.fields]

# One raw document: {tracks: [...], artists: [...]}. The legacy layout is one
# multi-line document per day; ours is the same schema, one bounded document
# per line, so a day is split across as many tasks as it has files.
RAW_DOCUMENT = T.StructType(
    [
        T.StructField("tracks", T.ArrayType(TRACK)),
        T.StructField("artists", T.ArrayType(ARTIST)),
    ]
)

# Our lines carry one more field beside the document: where in the day's walk the
# track stood (place of its genre in the list, place in the chart). Legacy
# documents have none; their tracks stand in list order.
WALK = T.StructType([T.StructField("genre_ordinal", T.LongType()), T.StructField("position", T.LongType())])

# ------------------------------------------------- landed API response bodies
# A chart page: {data: [track...], next: url?}; a track nests its artist.
API_TRACK = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("duration", T.IntegerType()),
        T.StructField("rank", T.LongType()),
        T.StructField("bpm", T.DoubleType()),
        T.StructField("gain", T.DoubleType()),
        T.StructField("explicit_lyrics", T.BooleanType()),
        T.StructField("artist", T.StructType([T.StructField("id", T.LongType())])),
    ]
)
CHART_PAGE = T.StructType(
    [
        T.StructField("data", T.ArrayType(API_TRACK)),
        T.StructField("next", T.StringType()),
    ]
)
GENRE = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
GENRE_LIST = T.StructType([T.StructField("data", T.ArrayType(GENRE))])

# ------------------------------------------------------------ curated star
FAIT_POPULARITE = T.StructType(
    [
        T.StructField("date_snapshot", T.StringType()),
        T.StructField("id_titre", T.LongType()),
        T.StructField("id_artiste", T.LongType()),
        T.StructField("score_popularite", T.LongType()),
    ]
)
DIM_TITRE = T.StructType(
    [
        T.StructField("id_titre", T.LongType()),
        T.StructField("nom", T.StringType()),
        T.StructField("duree", T.IntegerType()),
        T.StructField("bpm", T.DoubleType()),
        T.StructField("gain", T.DoubleType()),
        T.StructField("genre", T.LongType()),
    ]
)
DIM_ARTISTE = T.StructType(
    [
        T.StructField("id_artiste", T.LongType()),
        T.StructField("nom", T.StringType()),
        T.StructField("nb_fan", T.LongType()),
        T.StructField("nb_album", T.LongType()),
    ]
)
DIM_DATE = T.StructType(
    [
        T.StructField("jour", T.IntegerType()),
        T.StructField("semaine", T.IntegerType()),
        T.StructField("mois", T.IntegerType()),
        T.StructField("trimestre", T.IntegerType()),
    ]
)

PARTITION = T.StructField("date", T.StringType())

# Where each curated column comes from in staging.
CURATED_SOURCES = {
    "fait_popularite": {
        "date_snapshot": "date_snapshot",
        "id_titre": "id",
        "id_artiste": "artist_id",
        "score_popularite": "rank",
        "date": "date_snapshot",
    },
    "dim_titre": {
        "id_titre": "id",
        "nom": "title",
        "duree": "duration",
        "bpm": "bpm",
        "gain": "gain",
        "genre": "genre_id",
        "date": "date_snapshot",
    },
    "dim_artiste": {"id_artiste": "id", "nom": "name", "nb_fan": "nb_fan", "nb_album": "nb_album", "date": "date"},
}

CURATED = {
    "fait_popularite": FAIT_POPULARITE,
    "dim_titre": DIM_TITRE,
    "dim_artiste": DIM_ARTISTE,
    "dim_date": DIM_DATE,
}

# Staging tables are partitioned by date as well (the legacy layout kept only
# the latest run); titres carry date_snapshot as a data column too.
TITRES = T.StructType(TRACK.fields + [T.StructField("date_snapshot", T.StringType())])
ARTISTES = ARTIST
STAGING = {"titres": TITRES, "artistes": ARTISTES}


def with_partition(schema: T.StructType) -> T.StructType:
    """The on-disk schema of a lake table: data columns + ``date`` STRING."""
    return T.StructType(list(schema.fields) + [PARTITION])


def ddl(schema: T.StructType) -> str:
    """Column list for CREATE TABLE, e.g. ``id_titre bigint, nom string``.
    Nested field names keep their case (``array<struct<id:bigint,...>>``)."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
