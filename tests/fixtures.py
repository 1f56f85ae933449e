"""Hand-built inputs of a few rows."""

from hitparade import schemas

D = "2026-09-05"

FAIT_COLS = "date_snapshot string, id_titre bigint, id_artiste bigint, score_popularite bigint"
TITRE_COLS = "id_titre bigint, nom string, duree int, bpm double, gain double, genre bigint"
ARTISTE_COLS = "id_artiste bigint, nom string, nb_fan bigint, nb_album bigint"


def fait_rows():
    return [(D, 1, 10, 41), (D, 2, 20, 977), (D, 3, 10, 388)]


def titre_rows():
    return [(1, "Nocturne", 251, 96.5, -7.25, 7), (2, "Quay", 143, None, -3.0, 9), (3, "Ember", 309, 171.0, -11.5, 7)]


def artiste_rows():
    return [(10, "Vesper", 52310, 3), (20, "Lowtide", 77, 1)]


def fait(spark, rows=None):
    return spark.createDataFrame(fait_rows() if rows is None else rows, FAIT_COLS)


def dim_titre(spark, rows=None):
    return spark.createDataFrame(titre_rows() if rows is None else rows, TITRE_COLS)


def dim_artiste(spark, rows=None):
    return spark.createDataFrame(artiste_rows() if rows is None else rows, ARTISTE_COLS)


def tracks(spark, rows):
    """Raw track rows (nine track columns) + date_snapshot + position."""
    from pyspark.sql import types as T

    schema = T.StructType(
        list(schemas.TRACK.fields)
        + [T.StructField("date_snapshot", T.StringType()), T.StructField("position", T.LongType())]
    )
    return spark.createDataFrame(rows, schema)
