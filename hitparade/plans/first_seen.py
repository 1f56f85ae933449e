"""First-seen dedup kept up to date as entries land.

What :func:`hitparade.operators.ingest.first_seen` keeps of a date is all that is needed
to go on: the first of (kept so far, newly landed) is the first of everything landed. So the
state is the kept entries, a row per (snapshot, id), and a late page costs its own
rows and the state of the dates it belongs to; nothing else is read again.

Landing the same entries twice changes nothing. One job at a time merges a date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitparade.operators import ingest
from hitparade.sinks import kept

ENTRIES = "entries"


def _schema(entries: DataFrame) -> T.StructType:
    return T.StructType([f for f in entries.schema.fields if f.name != "date"])


def merge(entries: DataFrame, root: str) -> list[str]:
    """Merge newly landed chart ``entries`` (any dates, with ``date_snapshot``) into the
    state at ``root``; the dates that were rebuilt.

    Rows without a snapshot date are an error: they belong to no state."""
    spark = entries.sparkSession
    dates = [r[0] for r in entries.select("date_snapshot").distinct().orderBy("date_snapshot").collect()]
    if None in dates:
        raise ValueError("entries without a date_snapshot")
    if not dates:
        return []
    before = read(spark, root, _schema(entries), dates)
    merged = ingest.first_seen(before.unionByName(entries)).withColumn("date", F.col("date_snapshot"))
    kept.write(spark, root, {ENTRIES: merged}, dict.fromkeys(dates, ""))
    return dates


def read(spark: SparkSession, root: str, schema: T.StructType, dates: list[str] | None = None) -> DataFrame:
    """The kept entries of all dates, or of ``dates``."""
    return kept.read(spark, root, ENTRIES, schema, kept.live(spark, root, dates)).drop("date")
