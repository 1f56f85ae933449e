"""The extraction's data decisions as one Spark job over landed responses.

Input is what the HTTP layer landed, per snapshot: the genre-list body, the
chart-page bodies (genre, page number, body) and the artist-lookup bodies.
Output is the raw documents' content — first-seen titles and their artists —
plus what was set aside:

1. genres: parse the list, drop the pseudo-genre 0, keep list order;
2. bodies with an ``error`` key, and bodies that are not JSON, are quarantined,
   never read as data; ``strict`` aborts when a needed page or a genre list has
   no accepted body (a later retry that landed will do), when a snapshot with
   pages has no genre list, or no genre is listed;
3. charts: only pages of walked genres, every landed page up to the first one
   whose ``next`` is absent or empty; ``strict`` aborts when a walked chart has no
   page or a page before another one is missing (a last page that announces
   another is reported only: the walk may stop there);
4. titles: first-seen per (snapshot, id) in walk order (genre ordinal, page,
   position in page) — a partial top-1, so a title charting everywhere is one
   row per task before the shuffle;
5. required fields: a track without an id, or a kept track missing another, is
   rejected (``strict`` aborts);
6. artists: one lookup per distinct (snapshot, artist) of the kept titles;
   an unresolved lookup aborts when ``strict``.

The driver only sees the gates' verdicts (a count, a few sample ids).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitparade import schemas
from hitparade.operators import ingest
from hitparade.session import scratch_dir


@dataclass
class Extraction:
    titres: DataFrame  # track columns + date_snapshot
    artistes: DataFrame  # artist columns + date
    rejected_tracks: DataFrame
    rejected_responses: DataFrame  # error envelopes (pages and lookups)
    page_gaps: DataFrame  # pages the walk needed that never landed


class ExtractionError(RuntimeError):
    """A strict extraction met a rejected track or an unresolved artist."""


def parse_artist_lookups(bodies: DataFrame, body_col: str = "body") -> DataFrame:
    """Artist-lookup bodies → (id, name, nb_fan, nb_album); optional fields
    absent from the body are null. A lookup without id or name resolves nothing."""
    doc = F.from_json(F.col(body_col), schemas.ARTIST)
    return bodies.select(doc.alias("_a")).select("_a.*").where(F.col("id").isNotNull() & F.col("name").isNotNull())


def _accepted(bodies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with their ``error``) of landed bodies."""
    ok, failed = ingest.split_envelopes(bodies)
    ok, bad = ingest.split_unparsable(ok)
    return ok, failed.unionByName(bad)


def _needed_failures(failed: DataFrame, accepted: DataFrame, walk: DataFrame, keys: list[str]) -> DataFrame:
    """Failed pages of walked charts, not after their end, of which no body was accepted."""
    page = ["date_snapshot", "genre_id", "page_no"]
    lost = failed.select(*page).distinct().join(accepted.select(*page), page, "left_anti").join(walk, keys, "left_semi")
    ends = ingest.chart_ends(ingest.parse_chart_pages(accepted))
    needed = F.col("_last_page").isNull() | (F.col("page_no") <= F.col("_last_page"))
    return lost.join(ends, ingest.same_chart(), "left").where(needed)


def extract(
    genre_bodies: DataFrame,
    page_bodies: DataFrame,
    artist_bodies: DataFrame,
    strict: bool = True,
) -> Extraction:
    """``genre_bodies``: (body) — or (date_snapshot, body) when the list is
    fetched per snapshot (then a snapshot's list is needed, and a failed one
    is made good by an accepted one of the same date); ``page_bodies``: (date_snapshot, genre_id, page_no,
    body); ``artist_bodies``: (body). The genre walk is a few dozen rows (a snapshot, when
    lists are dated) and goes to the pages, so that no body is shuffled.
    ``strict`` keeps the first-seen titles in a scratch folder: the gates need them
    all, and what is returned reads them from there."""
    pages_ok, pages_err = _accepted(page_bodies)
    artists_ok, artists_err = _accepted(artist_bodies)
    genres_ok, genres_err = _accepted(genre_bodies)
    genres = ingest.exclude_all_genres(ingest.parse_genre_list(genres_ok))
    keys = ["date_snapshot", "genre_id"] if "date_snapshot" in genre_bodies.columns else ["genre_id"]
    walk = genres.select(*keys[:-1], F.col("id").alias("genre_id"), "genre_ordinal")

    dated = "date_snapshot" in keys
    snapshots = page_bodies.select("date_snapshot").distinct()
    # an undated list is walked by every snapshot of which anything landed
    charts = walk if dated else snapshots.join(walk)
    gaps = ingest.page_gaps(ingest.parse_chart_pages(pages_ok), charts)

    walked_pages = pages_ok.join(F.broadcast(walk.drop("genre_ordinal")), keys, "left_semi")
    tracks = ingest.read_chart_pages(walked_pages).join(F.broadcast(walk), keys)
    # only a title's first occurrence is asked for its fields
    first = ingest.first_seen(
        tracks.where(F.col("id").isNotNull()), ("date_snapshot", "id"), ("genre_ordinal", "page_no", "page_pos")
    )
    if strict:
        folder = scratch_dir(first.sparkSession, "first-seen-titles")
        first.write.option("compression", "zstd").parquet(folder)
        first = first.sparkSession.read.schema(first.schema).parquet(folder)
    complete, incomplete = ingest.split_required(first)
    rejected = incomplete.unionByName(tracks.where(F.col("id").isNull()))
    titres = complete.select(*schemas.TRACK_COLUMNS, "date_snapshot")
    enriched = ingest.enrich_artists(titres, parse_artist_lookups(artists_ok))

    if strict:
        # one job, a count a gate
        def count(what: str, rows: DataFrame) -> DataFrame:
            return rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("what"), "n")

        found = count("track(s) missing required fields", rejected)
        found = found.unionByName(count("unresolved artist lookup(s)", enriched.where(~F.col("resolved"))))
        found = found.unionByName(count("needed page(s) failed", _needed_failures(pages_err, pages_ok, walk, keys)))
        lost = gaps.where("kind <> 'open'")
        found = found.unionByName(count("walked chart(s) without a page", lost.where("kind = 'unlanded'")))
        found = found.unionByName(count("gap(s) of pages", lost.where("kind = 'gap'")))
        if dated:
            # a retried genre list that landed stands for the failed one
            listed = genres_ok.select("date_snapshot").distinct()
            unlisted = genres_err.select("date_snapshot").union(snapshots).distinct().join(listed, "date_snapshot", "left_anti")
            found = found.unionByName(count("snapshot(s) without a genre list", unlisted))
        found = found.unionByName(count("genre(s) walked", walk))
        counts = {r["what"]: r["n"] for r in found.collect()}
        walked = counts.pop("genre(s) walked")
        if not walked or any(counts.values()):
            said = [f"{n} {what}" for what, n in counts.items() if n] + ["no genre to walk"] * (not walked)
            raise ExtractionError("strict extraction: " + ", ".join(said))

    artistes = enriched.where(F.col("resolved")).select(*schemas.ARTIST_COLUMNS, F.col("date_snapshot").alias("date"))
    errors = pages_err.select(F.lit("chart").alias("endpoint"), "body", "error")
    for endpoint, rows in (("artist", artists_err), ("genre", genres_err)):
        errors = errors.unionByName(rows.select(F.lit(endpoint).alias("endpoint"), "body", "error"))
    return Extraction(titres, artistes, rejected, errors, gaps)
