"""Reader of the raw zone: ``{tracks: [...], artists: [...]}`` JSON documents.

Two layouts share one schema:

* legacy — one multi-line document per day at ``.../date=YYYY-MM-DD/x.json``
  (``multi_line=True``; one file cannot be split, so a day is one task);
* ours — gzipped JSON lines, one bounded document per line, partitioned by ``date``
  (see :mod:`hitparade.sinks.raw`), in files of a bounded number of lines, a task each.

The snapshot date always comes from the path (``date=YYYY-MM-DD``), never from
the clock, and is validated as a real date. ``strict=True`` (FAILFAST) fails
the read on a malformed document or a wrong-typed field instead of silently
yielding zero rows / nulls; ``strict=False`` keeps bad lines in
``_corrupt_record`` for quarantine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitparade import schemas
from hitparade.functions import path_snapshot_date, validated_date

CORRUPT = "_corrupt_record"


def read_raw(
    spark: SparkSession,
    path: str,
    multi_line: bool = False,
    strict: bool = True,
    snapshot_dates: list[str] | None = None,
    kind: str | None = None,
) -> DataFrame:
    """Raw documents with ``date_snapshot`` taken from each file's path.

    Columns: tracks, artists, walk, date_snapshot (+ ``_corrupt_record`` when not
    strict). The partition column, when the layout has one, is declared STRING
    so inference cannot retype it. ``snapshot_dates`` restricts a partitioned
    raw root to those ``date=`` folders (partition pruning: other days are
    not listed or read); ``kind`` (``"tracks"`` / ``"artists"``) to the
    ``kind=`` folders of that document type — a layout without ``kind=``
    folders is read whole.
    """
    fields = list(schemas.RAW_DOCUMENT.fields) + [T.StructField("walk", schemas.WALK)]
    fields += [schemas.PARTITION, T.StructField("kind", T.StringType())]
    if not strict:
        fields.append(T.StructField(CORRUPT, T.StringType()))
    reader = (
        spark.read.schema(T.StructType(fields))
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
    )
    if not strict:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    df = reader.json(path)
    if snapshot_dates is not None:
        df = df.where(F.col("date").isin(list(snapshot_dates)))
    if kind is not None:
        df = df.where(F.col("kind").isNull() | (F.col("kind") == F.lit(kind)))
    from_path = F.nullif(path_snapshot_date(F.col("_metadata.file_path")), F.lit(""))
    date = F.coalesce(F.nullif(F.col("date"), F.lit("")), from_path)
    keep = ["tracks", "artists", "walk"] + ([] if strict else [CORRUPT])
    return df.select(*keep, validated_date(date, "snapshot date from raw path").alias("date_snapshot"))
