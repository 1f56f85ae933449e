"""Landed responses → track and artist records.

The reference fetched charts genre by genre and kept a title the first time it
saw it. Here the same rules are DataFrame operators over *all* landed
responses at once, so the work is spread by Spark instead of a Python loop:

* genres: drop the "all genres" pseudo-genre (id 0), null-safe;
* envelopes: a body that is a JSON object with an ``error`` key is a failure
  even if the transport said OK — quarantined, never parsed as data;
* chart pages: every landed page is read, up to the first one whose ``next`` is
  absent or empty; pages that the walk needed and that never landed are reported;
* first-seen dedup: per (snapshot, id) keep the occurrence that comes first in
  (genre order, page, position) — ``row_number() == 1``, which Spark limits
  map-side (``WindowGroupLimit``) so a hot id never reaches one task whole;
* artist enrichment: one lookup per distinct (snapshot, artist), left join so
  unresolved lookups are visible and can be gated on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitparade import schemas
from hitparade.constants import ALL_GENRES_ID, REQUIRED_TRACK_FIELDS
from hitparade.functions import has_json_key

# Total order deciding which occurrence of a title is "first seen" on a day:
# genre order, chart position, then the remaining entry columns, so entries
# that still tie are identical and a recomputed task keeps the same row.
FIRST_SEEN_ORDER = ("genre_id", "position", "artist_id", "rank", "explicit_lyrics")
SNAPSHOT_KEY = ("date_snapshot", "id")
#: The fewest parts of a snapshot's ids that :func:`parts_per_date` asks for.
PARTS_PER_DATE = 4


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def first_seen(
    df: DataFrame,
    keys: Sequence[str] = SNAPSHOT_KEY,
    order: Sequence[str | Column] = FIRST_SEEN_ORDER,
) -> DataFrame:
    """Keep, for each ``keys`` group, the row that sorts first by ``order``.

    Deterministic as long as ``order`` is total within a group. Null keys form
    one group (as ``dropDuplicates`` does). The ``rn = 1`` filter lets Catalyst
    insert a partial ``WindowGroupLimit`` before the shuffle, so each map task
    ships at most one row per key.
    """
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def parts_per_date(spark: SparkSession, n_dates: int) -> int:
    """Parts to deal each of ``n_dates`` snapshots in: over all of them, twice what the session
    shuffles into. A snapshot has at most so many tasks, and files."""
    wanted = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(PARTS_PER_DATE, -(-wanted // max(1, n_dates)))


def first_seen_by_date(
    df: DataFrame, order: Sequence[str | Column] = FIRST_SEEN_ORDER, parts: int = PARTS_PER_DATE
) -> DataFrame:
    """:func:`first_seen` per (snapshot, id) for rows that are written by date: they are dealt
    once, by snapshot and a share of its ids, and the write needs no shuffle of its own.
    Every row is shipped, so this is for ids that repeat a few times a snapshot."""
    part = F.pmod(F.xxhash64("id"), F.lit(parts))
    dealt = df.withColumn("_part", part).repartition("date_snapshot", "_part")
    return first_seen(dealt, ("date_snapshot", "_part", "id"), order).drop("_part")


def exclude_all_genres(genres: DataFrame, id_col: str = "id") -> DataFrame:
    """Drop the pseudo-genre 0. A null id is kept (it is not 0)."""
    return genres.where(~F.col(id_col).eqNullSafe(F.lit(ALL_GENRES_ID)))


def parse_genre_list(bodies: DataFrame, body_col: str = "body") -> DataFrame:
    """``{data: [{id, name}...]}`` bodies → one row per genre, in list order.

    A missing ``data`` key is an empty list. ``genre_ordinal`` is the position
    in the list, the order in which charts were walked.
    """
    parsed = bodies.withColumn("_doc", F.from_json(F.col(body_col), schemas.GENRE_LIST))
    return parsed.select(
        *[c for c in bodies.columns if c != body_col],
        F.posexplode(F.coalesce(F.col("_doc.data"), F.array())).alias("genre_ordinal", "_g"),
    ).select("*", "_g.*").drop("_g")


def flag_envelope_errors(responses: DataFrame, body_col: str = "body") -> DataFrame:
    """Add ``is_error``: the body is a JSON object carrying an ``error`` key."""
    return responses.withColumn("is_error", has_json_key(body_col, "error"))


def split_unparsable(responses: DataFrame, body_col: str = "body") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) responses: a missing body or one that is not JSON is rejected."""
    bad = F.try_parse_json(F.col(body_col)).isNull()
    return responses.where(~bad), responses.where(bad).withColumn("error", F.lit("unparsable body"))


def split_envelopes(responses: DataFrame, body_col: str = "body") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) responses. Rejected rows keep the error payload."""
    flagged = flag_envelope_errors(responses, body_col)
    accepted = flagged.where(~F.col("is_error")).drop("is_error")
    rejected = (
        flagged.where(F.col("is_error"))
        .drop("is_error")
        .withColumn("error", F.get_json_object(F.col(body_col), "$.error"))
    )
    return accepted, rejected


def parse_chart_pages(pages: DataFrame, body_col: str = "body") -> DataFrame:
    """Add ``doc`` = the parsed ``{data, next}`` body of each landed page."""
    return pages.withColumn("doc", F.from_json(F.col(body_col), schemas.CHART_PAGE))


def chart_ends(parsed: DataFrame) -> DataFrame:
    """Per chart, its last page: the first whose ``next`` is absent or empty
    (null when every landed page has one). A partial aggregate."""
    no_next = F.coalesce(F.col("doc.next"), F.lit("")) == ""
    return parsed.groupBy(F.col("date_snapshot").alias("_date"), F.col("genre_id").alias("_genre")).agg(
        F.min(F.when(no_next, F.col("page_no"))).alias("_last_page")
    )


def same_chart() -> Column:
    """Null-safe match of a row with its chart in :func:`chart_ends`."""
    return F.col("date_snapshot").eqNullSafe(F.col("_date")) & F.col("genre_id").eqNullSafe(F.col("_genre"))


def stop_after_last_page(parsed: DataFrame) -> DataFrame:
    """Parsed pages → the pages the chart walk reads: every landed page up to
    the chart's end. The ends are an aggregate joined back, so no chart is
    sorted as a whole; they are a row a chart (dozens of genres a snapshot), so they
    go to the pages, and no body is shuffled."""
    read = F.col("_last_page").isNull() | (F.col("page_no") <= F.col("_last_page"))
    return parsed.join(F.broadcast(chart_ends(parsed)), same_chart()).where(read).drop("_date", "_genre", "_last_page")


def page_gaps(parsed: DataFrame, walk: DataFrame) -> DataFrame:
    """What the walk needed and no accepted page answers: gaps and islands of page numbers.

    ``parsed`` are the accepted pages (:func:`parse_chart_pages`), ``walk`` the charts walked
    (date_snapshot, genre_id). Returns ``date_snapshot, genre_id, kind, first_page, last_page``:

    * ``unlanded`` — a chart without any page (``last_page`` null: nobody knows how many);
    * ``gap`` — pages missing before a landed page that is not after the chart's end;
    * ``open`` — the last landed page has a ``next`` that did not land (``last_page`` null).

    Each page marks its own number and the next one; grouped by number, an island
    starts where a page has no page before it and ends before a number that has no page.
    That aggregate deals pages evenly however long a chart is; only the few
    ends of islands meet by chart. Pages of equal number count once; a page number
    or id that is null answers nothing.
    """
    key = ["date_snapshot", "genre_id"]
    charts = walk.select(*key).where(F.col("date_snapshot").isNotNull() & F.col("genre_id").isNotNull()).distinct()
    pages = parsed.where(F.col("page_no") >= 0).select(
        *key, F.col("page_no").cast("int").alias("page_no"), (F.coalesce(F.col("doc.next"), F.lit("")) != "").alias("more")
    )
    pages = pages.join(charts, key, "left_semi")
    marks = F.array(
        F.struct(F.col("page_no").alias("no"), F.lit(True).alias("landed"), (~F.col("more")).alias("ends")),
        F.struct((F.col("page_no") + 1).alias("no"), F.lit(False).alias("landed"), F.lit(False).alias("ends")),
    )
    at = pages.select(*key, F.explode(marks).alias("m")).groupBy(*key, F.col("m.no").alias("no")).agg(
        F.max("m.landed").alias("landed"),
        F.min("m.landed").alias("_first_only"),
        F.max("m.ends").alias("ends"),
    )
    # landed without a page before it: an island starts; a number after a page without one: it ended
    edges = at.withColumn("starts", F.col("landed") & F.col("_first_only")).where(
        F.col("starts") | ~F.col("landed") | F.col("ends")
    )
    by_no, chart = Window.partitionBy(*key).orderBy("no"), Window.partitionBy(*key)
    after = F.when(~F.col("landed"), F.col("no"))
    edges = edges.withColumns(
        {
            "from": F.coalesce(F.last(after, ignorenulls=True).over(by_no.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "end": F.min(F.when(F.col("ends"), F.col("no"))).over(chart),
            "tail": F.max(after).over(chart),
        }
    )
    missing = F.col("starts") & (F.col("from") < F.col("no")) & (F.col("end").isNull() | (F.col("no") <= F.col("end")))
    onward = ~F.col("landed") & F.col("end").isNull() & (F.col("no") == F.col("tail"))
    found = edges.where(missing | onward).select(
        *key,
        F.when(missing, F.lit("gap")).otherwise(F.lit("open")).alias("kind"),
        F.when(missing, F.col("from")).otherwise(F.col("no")).cast("int").alias("first_page"),
        F.when(missing, F.col("no") - 1).cast("int").alias("last_page"),
    )
    unlanded = charts.join(pages.select(*key).distinct(), key, "left_anti")
    never = unlanded.select(
        *key, F.lit("unlanded").alias("kind"), F.lit(0).alias("first_page"), F.lit(None).cast("int").alias("last_page")
    )
    return found.unionByName(never)


def flatten_chart_pages(parsed: DataFrame) -> DataFrame:
    """Parsed chart pages → one track record per chart entry.

    Flattens ``artist.id`` to ``artist_id``, stamps the page's ``genre_id``,
    keeps ``page_no`` and the index in the page (``page_pos``). Optional
    fields absent from the body are null; a missing ``data`` key is an empty
    page.
    """
    exploded = parsed.select(
        "date_snapshot",
        "genre_id",
        "page_no",
        F.posexplode(F.coalesce(F.col("doc.data"), F.array())).alias("page_pos", "t"),
    )
    return exploded.select(
        "date_snapshot",
        F.col("t.id").alias("id"),
        F.col("t.title").alias("title"),
        F.col("t.duration").alias("duration"),
        F.col("t.rank").alias("rank"),
        F.col("t.bpm").alias("bpm"),
        F.col("t.gain").alias("gain"),
        F.col("t.explicit_lyrics").alias("explicit_lyrics"),
        F.col("t.artist.id").alias("artist_id"),
        F.col("genre_id").cast("long").alias("genre_id"),
        F.col("page_no").cast("int").alias("page_no"),
        F.col("page_pos").cast("int").alias("page_pos"),
    )


def read_chart_pages(pages: DataFrame) -> DataFrame:
    """Landed chart pages (date_snapshot, genre_id, page_no, body) → tracks,
    up to each chart's end."""
    return flatten_chart_pages(stop_after_last_page(parse_chart_pages(pages)))


def chart_sizes_by_genre(genres: DataFrame, entries: DataFrame) -> DataFrame:
    """The genre walk: every genre of the list except the pseudo-genre, with
    the number of chart entries it contributed (0 when none). The genre list
    is the small side of the join; entries are counted per genre first."""
    sizes = entries.groupBy("genre_id").agg(F.count(F.lit(1)).alias("n_entries"))
    return (
        exclude_all_genres(genres)
        .join(sizes, F.col("id") == F.col("genre_id"), "left")
        .select("id", "name", F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"))
    )


def required_field_report(tracks: DataFrame, fields: Sequence[str] = REQUIRED_TRACK_FIELDS) -> DataFrame:
    """One row: total tracks, then the number missing each required field and
    the number of tracks missing any (the rows a strict run would reject)."""
    missing_any = F.lit(False)
    aggs = [F.count(F.lit(1)).alias("n_tracks")]
    for f in fields:
        aggs.append(F.count_if(F.col(f).isNull()).alias(f"missing_{f}"))
        missing_any = missing_any | F.col(f).isNull()
    aggs.append(F.count_if(missing_any).alias("n_rejected"))
    return tracks.agg(*aggs)


def split_required(tracks: DataFrame, fields: Sequence[str] = REQUIRED_TRACK_FIELDS) -> tuple[DataFrame, DataFrame]:
    """(complete, rejected) tracks on the required fields."""
    missing_any = F.lit(False)
    for f in fields:
        missing_any = missing_any | F.col(f).isNull()
    return tracks.where(~missing_any), tracks.where(missing_any)


def distinct_artists(titres: DataFrame) -> DataFrame:
    """Distinct (snapshot, artist id) of the kept titles: one lookup each."""
    return titres.select("date_snapshot", "artist_id").distinct()


def enrich_artists(titres: DataFrame, artist_records: DataFrame) -> DataFrame:
    """Artist record per distinct (snapshot, artist) of the kept titles.

    ``artist_records`` are the landed lookups (id, name, nb_fan, nb_album). A
    lookup landed twice (a retried request) counts once: the lookups are
    reduced to one per id, deterministically, before the join. Left join: an
    unresolved id gives a row with ``resolved = false`` and null attributes,
    for :func:`assert_resolved` to gate on. Only artists used by a title are
    looked up (the distinct prunes the rest).
    """
    ids = distinct_artists(titres)
    one_per_id = first_seen(artist_records, ("id",), ("name", "nb_fan", "nb_album"))
    lookups = one_per_id.select(
        F.col("id").alias("artist_id"), "name", "nb_fan", "nb_album", F.lit(True).alias("_found")
    )
    return ids.join(lookups, "artist_id", "left").select(
        "date_snapshot",
        F.col("artist_id").alias("id"),
        "name",
        "nb_fan",
        "nb_album",
        F.coalesce(F.col("_found"), F.lit(False)).alias("resolved"),
    )


def genre_walk(genres: DataFrame, snapshots: DataFrame) -> DataFrame:
    """(date_snapshot, genre_id): each snapshot walks the whole genre list but
    the pseudo-genre. The list is one response body (dozens of genres), so it
    reaches every snapshot as an array."""
    listed = exclude_all_genres(genres).agg(F.collect_list("id")).scalar()
    days = snapshots.select("date_snapshot").distinct().withColumn("_listed", listed)
    return days.select("date_snapshot", F.explode("_listed").alias("genre_id"))


def _tallied(key: Sequence[str], names: Sequence[str], *parts: DataFrame) -> DataFrame:
    """Per ``key`` (null-safe), how many rows each part has; a part beyond the
    names only adds its keys. One partial aggregate over the parts' union."""
    rows = None
    for i, part in enumerate(parts):
        ones = [F.lit(int(i == j)).alias(n) for j, n in enumerate(names)]
        some = part.select(*key, *ones)
        rows = some if rows is None else rows.unionByName(some)
    return rows.groupBy(*key).agg(*[F.sum(n).alias(n) for n in names])


def genre_yield(entries: DataFrame, kept: DataFrame, walk: DataFrame | None = None) -> DataFrame:
    """Per (snapshot, genre): chart entries received and titles new in it.

    ``kept`` is the first-seen result of ``entries``; a title is "new" in the
    genre where it was kept. With the genre ``walk``, a genre that was walked
    but received nothing has a line of zeros.
    """
    parts = [entries, kept] if walk is None else [entries, kept, walk]
    return _tallied(("date_snapshot", "genre_id"), ("n_received", "n_new"), *parts)


def extract_summary(walk: DataFrame, titres: DataFrame, artistes: DataFrame) -> DataFrame:
    """Per snapshot: genres walked, unique titles, unique artists."""
    walked = walk.select("date_snapshot", "genre_id").distinct()
    looked_up = artistes.select(F.col("date").alias("date_snapshot"))
    return _tallied(("date_snapshot",), ("n_genres", "n_tracks", "n_artists"), walked, titres, looked_up)


class UnresolvedArtistError(RuntimeError):
    """An artist id of a kept title has no landed lookup."""


def assert_resolved(enriched: DataFrame, sample: int = 10) -> None:
    """Raise when any artist lookup is unresolved, with their exact count; only
    a sample of ids reaches the driver."""
    bad = enriched.where(~F.col("resolved")).select("date_snapshot", "id")
    n = bad.count()
    if n:
        some = bad.limit(sample).collect()
        ids = ", ".join(f"{r['date_snapshot']}/{r['id']}" for r in some)
        raise UnresolvedArtistError(f"{n} unresolved artist lookup(s), among them: {ids}")
