"""The landing zone, read from the TPC-H-like tables the checks are run on.

A snapshot is a ship *month* of ``lineitem``; each line item is one chart
entry; ``part`` is the title catalogue, ``supplier`` the artist lookups,
``nation`` the genre list (with the pseudo-genre 0) and ``events`` the raw
response bodies (error events carry an ``error`` envelope).

Fixed mapping (must match the oracle SQL in ``__spark_entry__``):

=====================  ====================================================
date_snapshot          first day of the ship month, ``yyyy-MM-dd``
id                     l_partkey
genre_id               l_linenumber (BIGINT)
position               l_orderkey (chart position)
artist_id              l_suppkey
rank                   floor(l_extendedprice)
explicit_lyrics        l_returnflag = 'R'
title / duration       p_name / p_size
bpm                    p_size * 6 when p_size % 5 = 0, else null (DOUBLE)
gain                   p_retailprice
artist name            s_name
nb_fan / nb_album      floor(s_acctbal * 100) / s_nationkey (BIGINT)
genre id / name        n_nationkey (BIGINT) / n_name
response body          error event → {"error": props}, otherwise props
=====================  ====================================================

Every function but :func:`landed`, and :func:`staging`, which lands the kept entries, is a
lazy scan + projection; nothing is cached or collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitparade import schemas
from hitparade.functions import month_snapshot
from hitparade.operators import ingest
from hitparade.session import scratch_dir


# Entries of a landed chart page.
PAGE_SIZE = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def chart_entries(spark: SparkSession, sf_dir: str, snapshot_date: str | None = None) -> DataFrame:
    """One row per chart appearance, without title attributes.

    With ``snapshot_date`` only that month is read: the month is also stated
    as a range on the raw ship date, which Parquet can evaluate
    (``PushedFilters``), so row groups of other months are skipped.
    """
    li = table(spark, sf_dir, "lineitem")
    if snapshot_date is not None:
        if not snapshot_date.endswith("-01"):
            raise ValueError(f"a snapshot is the first day of a month, not {snapshot_date}")
        start = F.to_date(F.lit(snapshot_date))
        li = li.where(
            (F.col("l_shipdate") >= start.cast("timestamp_ntz"))
            & (F.col("l_shipdate") < F.add_months(start, 1).cast("timestamp_ntz"))
        )
    return li.select(
        month_snapshot("l_shipdate").alias("date_snapshot"),
        F.col("l_partkey").alias("id"),
        F.col("l_linenumber").cast("long").alias("genre_id"),
        F.col("l_orderkey").alias("position"),
        F.col("l_suppkey").alias("artist_id"),
        F.floor("l_extendedprice").alias("rank"),
        (F.col("l_returnflag") == F.lit("R")).alias("explicit_lyrics"),
    )


def title_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue attributes of a title, one row per id."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_size").alias("duration"),
        F.when(F.col("p_size") % 5 == 0, (F.col("p_size") * 6).cast("double")).alias("bpm"),
        F.col("p_retailprice").alias("gain"),
    )


def with_titles(entries: DataFrame, titles: DataFrame) -> DataFrame:
    """Attach title attributes to chart entries (left: an entry is never
    dropped; an unknown title gets null attributes for the required-field
    check to reject)."""
    return entries.join(titles, "id", "left")


def chart_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full chart rows before dedup: track columns + date_snapshot + position."""
    tracks = with_titles(chart_entries(spark, sf_dir), title_records(spark, sf_dir))
    return tracks.select(*schemas.TRACK_COLUMNS, "date_snapshot", "position")


def walked_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chart rows before dedup with their place in the walk; the genre list is in id order."""
    return chart_tracks(spark, sf_dir).withColumn("genre_ordinal", F.col("genre_id"))


def looked_up_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The artist of every kept title, as often as it has titles: (artist columns, date)."""
    kept = kept_up_to(spark, sf_dir, "artist_id")
    of_titles = kept.select(F.col("artist_id").alias("id"), F.col("date_snapshot").alias("date"))
    return of_titles.join(artist_records(spark, sf_dir), "id", "left").select(*schemas.ARTIST_COLUMNS, "date")


def artist_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed artist lookups, one per artist id."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.floor(F.col("s_acctbal") * 100).alias("nb_fan"),
        F.col("s_nationkey").cast("long").alias("nb_album"),
    )


def genre_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed genre list, pseudo-genre 0 included."""
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))


def response_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw response bodies: an error event's body is an ``error`` envelope."""
    ev = table(spark, sf_dir, "events")
    body = F.when(
        F.col("event_type") == F.lit("error"), F.concat(F.lit('{"error": '), F.col("props"), F.lit("}"))
    ).otherwise(F.col("props"))
    return ev.select("event_id", "event_type", body.alias("body"))


def kept_entries(spark: SparkSession, sf_dir: str, snapshot_date: str | None = None) -> DataFrame:
    """First-seen chart entry per (snapshot, id), without title attributes."""
    return ingest.first_seen(chart_entries(spark, sf_dir, snapshot_date))


def kept_up_to(spark: SparkSession, sf_dir: str, last: str) -> DataFrame:
    """:func:`kept_entries` with the key and the order's columns up to ``last`` only, which
    is all that is shuffled: entries that tie on those agree in them, whichever is kept."""
    order = ingest.FIRST_SEEN_ORDER[: ingest.FIRST_SEEN_ORDER.index(last) + 1]
    return ingest.first_seen(chart_entries(spark, sf_dir).select(*ingest.SNAPSHOT_KEY, *order), order=order)


def titles_of(spark: SparkSession, sf_dir: str, kept: DataFrame) -> DataFrame:
    """Staging titres of kept entries: the catalogue is joined after the dedup,
    so the join sees one row per title-day instead of one per appearance."""
    return with_titles(kept, title_records(spark, sf_dir)).select(*schemas.TRACK_COLUMNS, "date_snapshot")


def first_seen_titles(spark: SparkSession, sf_dir: str, snapshot_date: str | None = None) -> DataFrame:
    """Staging titres: first-seen title per (snapshot, id), with attributes."""
    return titles_of(spark, sf_dir, kept_entries(spark, sf_dir, snapshot_date))


def staged_artists(spark: SparkSession, sf_dir: str, titres: DataFrame) -> DataFrame:
    """Staging artistes: the artists used by each snapshot's kept titles."""
    enriched = ingest.enrich_artists(titres, artist_records(spark, sf_dir))
    return enriched.select(*schemas.ARTIST_COLUMNS, F.col("date_snapshot").alias("date"))


def staging(spark: SparkSession, sf_dir: str, snapshot_date: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(titres, artistes) for every snapshot of the landing tables, or for one.
    Artists come from the kept entries: they need no title attribute. The kept entries are
    written once and read by both."""
    kept = landed(kept_entries(spark, sf_dir, snapshot_date))
    return titles_of(spark, sf_dir, kept), staged_artists(spark, sf_dir, kept)


def paginate_chart(
    entries: DataFrame,
    page_size: int = PAGE_SIZE,
    keys: tuple[str, ...] = ("date_snapshot", "genre_id"),
    order: tuple[str, ...] = ("position", "id", "artist_id", "rank", "explicit_lyrics"),
    range_width: int = 50_000,
) -> DataFrame:
    """Chart entries numbered in pages: ``page_no``, ``page_pos`` (both from 0) and
    ``has_next`` (entries follow the page). Plays the remote API, so that the
    check tables give pages to read.

    A chart is numbered range by range of its position: counts per (chart,
    range) are summed up to each range's offset, and rows are numbered within
    their range, so no task sorts a whole chart. A range's offset travels as a
    row ahead of its entries, so that they are shuffled once.
    """
    ranged = entries.withColumn("_range", F.floor(F.col(order[0]) / range_width))
    parts = [*keys, "_range"]
    counts = ranged.groupBy(*parts).agg(F.count(F.lit(1)).alias("_n"))
    chart = Window.partitionBy(*keys)
    offsets = counts.withColumn("_before", F.sum("_n").over(chart.orderBy("_range")) - F.col("_n"))
    offsets = offsets.withColumn("_chart_len", F.sum("_n").over(chart)).drop("_n")
    both = ranged.unionByName(offsets, allowMissingColumns=True)
    in_range = Window.partitionBy(*parts).orderBy(F.col("_before").isNull(), *order)
    so_far = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = both.withColumns(
        {
            "_at": F.first("_before").over(so_far) + F.row_number().over(in_range) - 2,
            "_len": F.first("_chart_len").over(so_far),
        }
    ).where(F.col("_before").isNull())
    paged = numbered.withColumns(
        {"page_no": F.floor(F.col("_at") / page_size).cast("int"), "page_pos": (F.col("_at") % page_size).cast("int")}
    )
    paged = paged.withColumn("has_next", F.col("_len") > (F.col("page_no") + 1) * page_size)
    return paged.drop("_at", "_len", "_before", "_chart_len", "_range")


def page_bodies(paged: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Paged chart rows (from :func:`paginate_chart`) → one landed JSON body per
    page, ``{data: [track...], next: url}``, tracks in page order with the
    artist nested as in the API. A page holds at most ``page_size`` rows, so
    the collect per group is bounded.
    """
    track = F.struct(
        "id", "title", "duration", "rank", "bpm", "gain", "explicit_lyrics", F.struct(F.col("artist_id").alias("id")).alias("artist")
    )
    grouped = paged.groupBy("date_snapshot", "genre_id", "page_no").agg(
        F.sort_array(F.collect_list(F.struct(F.col("page_pos"), track.alias("t")))).alias("_rows"),
        F.max("has_next").alias("_has_next"),
    )
    next_url = F.when(
        F.col("_has_next"),
        F.format_string("chart/%d/tracks?index=%d", F.col("genre_id"), (F.col("page_no") + 1) * page_size),
    )
    body = F.to_json(F.struct(F.transform("_rows", lambda r: r["t"]).alias("data"), next_url.alias("next")))
    return grouped.select("date_snapshot", "genre_id", "page_no", body.alias("body"))


def chart_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed chart pages: (date_snapshot, genre_id, page_no, body), every page
    of every chart."""
    return page_bodies(paginate_chart(chart_tracks(spark, sf_dir)))


def landed(bodies: DataFrame) -> DataFrame:
    """``bodies`` written to a scratch folder and read from there, as landed responses are:
    a job that reads them several times has them made once."""
    folder = scratch_dir(bodies.sparkSession, "landed")
    bodies.write.option("compression", "zstd").parquet(folder)
    return bodies.sparkSession.read.schema(bodies.schema).parquet(folder)


def empty_chart_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed pages of walked charts that have no entry: one each, without tracks."""
    entries = chart_entries(spark, sf_dir)
    walk = ingest.genre_walk(genre_records(spark, sf_dir), entries)
    none = walk.join(entries.select("date_snapshot", "genre_id").distinct(), ["date_snapshot", "genre_id"], "left_anti")
    return none.select("date_snapshot", "genre_id", F.lit(0).alias("page_no"), F.lit('{"data": []}').alias("body"))


def broken_chart_pages(spark: SparkSession, sf_dir: str, page_size: int = 10) -> DataFrame:
    """Short landed pages of which one in five never landed, and some announce no next page."""
    pages = page_bodies(paginate_chart(chart_tracks(spark, sf_dir), page_size), page_size)
    month = F.substring("date_snapshot", 6, 2).cast("int")
    lost = (F.col("page_no") * 7 + F.col("genre_id") * 3 + month) % 5 == 0
    early = (F.col("genre_id") % 2 == 0) & (F.col("page_no") == 3)
    body = F.when(early, F.lit('{"data": [], "next": ""}')).otherwise(F.col("body"))
    return pages.where(~lost).withColumn("body", body)


def valid_artist_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artist lookups that pass validity: a fan count, when given, is >= 0.
    A rejected lookup leaves its artist out of the dimension."""
    from hitparade.functions import out_of_range

    return artist_records(spark, sf_dir).where(~out_of_range("nb_fan", 0, None))


def genre_list_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed genre-list body: ``{data: [{id, name}...]}`` in genre-id
    order, pseudo-genre included. The list is the 25-row ``nation`` table at
    every scale, so gathering it into one body is bounded."""
    genres = genre_records(spark, sf_dir)
    listed = F.to_json(F.struct(F.sort_array(F.collect_list(F.struct("id", "name"))).alias("data")))
    return genres.agg(listed.alias("body"))


def artist_lookup_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed lookup body per artist."""
    a = artist_records(spark, sf_dir)
    return a.select(F.to_json(F.struct(*schemas.ARTIST_COLUMNS)).alias("body"))
