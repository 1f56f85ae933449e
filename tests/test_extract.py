"""The extraction job over hand-written landed bodies."""

import json

import pytest

from hitparade.operators import ingest
from hitparade.plans import extract
from hitparade.sources import landing

D = "2026-09-05"


def _page(tracks, nxt=None):
    body = {"data": [dict(t, artist={"id": t.pop("artist_id")}) for t in tracks]}
    if nxt:
        body["next"] = nxt
    return json.dumps(body)


def _t(id_, artist=1, title="t"):
    return {"id": id_, "title": title, "duration": 100, "rank": 5, "artist_id": artist}


def _frames(spark, pages, artists, genres=None):
    if not genres:  # the genres that the pages are of, Pop first
        ids = sorted({132, *(g for _, g, _, _ in pages if g)}, reverse=True)
        genres = [{"id": 0, "name": "All"}, *({"id": g, "name": f"g{g}"} for g in ids)]
    g = spark.createDataFrame([(json.dumps({"data": genres}),)], "body string")
    p = spark.createDataFrame(pages, "date_snapshot string, genre_id bigint, page_no int, body string")
    a = spark.createDataFrame([(json.dumps(x),) for x in artists], "body string")
    return g, p, a


def test_walk_order_and_envelopes(spark):
    pages = [
        (D, 0, 0, _page([_t(9)])),  # pseudo-genre: never walked
        (D, 132, 0, _page([_t(1), _t(2)], nxt="p1")),
        (D, 132, 1, _page([_t(3)], nxt="p2")),
        (D, 132, 2, _page([_t(4)])),  # every landed page counts
        (D, 116, 0, _page([_t(2, artist=2), _t(5, artist=2)])),  # 2 already seen under Pop
        (D, 116, 1, '{"error": {"code": 4, "message": "quota"}}'),  # quarantined
    ]
    artists = [{"id": 1, "name": "A"}, {"id": 2, "name": "B", "nb_fan": 7}]
    ex = extract.extract(*_frames(spark, pages, artists))
    got = {r.id: r.genre_id for r in ex.titres.collect()}
    assert got == {1: 132, 2: 132, 3: 132, 4: 132, 5: 116}
    assert {(r.id, r.nb_fan) for r in ex.artistes.collect()} == {(1, None), (2, 7)}
    assert [r.endpoint for r in ex.rejected_responses.collect()] == ["chart"]


def test_strict_extraction_aborts(spark):
    pages = [(D, 132, 0, _page([_t(1, artist=3)]))]
    with pytest.raises(extract.ExtractionError, match="unresolved"):
        extract.extract(*_frames(spark, pages, [{"id": 1, "name": "A"}]))
    pages = [(D, 132, 0, json.dumps({"data": [{"id": 1, "duration": 1, "rank": 1, "artist": {"id": 1}}]}))]
    with pytest.raises(extract.ExtractionError, match="required"):
        extract.extract(*_frames(spark, pages, [{"id": 1, "name": "A"}]))
    lenient = extract.extract(*_frames(spark, pages, [{"id": 1, "name": "A"}]), strict=False)
    assert lenient.titres.count() == 0 and lenient.rejected_tracks.count() == 1


ERROR = '{"error": {"code": 4, "message": "quota"}}'
ONE = [{"id": 1, "name": "A"}]


@pytest.mark.parametrize("bad", [ERROR, '{"data": [{"id"', None])
def test_strict_extraction_aborts_on_a_needed_page(spark, bad):
    for pages in (
        [(D, 132, 0, bad)],
        [(D, 132, 0, bad), (D, 132, 1, _page([_t(3)]))],
        [(D, 132, 0, _page([_t(1)], nxt="p1")), (D, 132, 1, bad)],
    ):
        with pytest.raises(extract.ExtractionError, match="needed page"):
            extract.extract(*_frames(spark, pages, ONE))
    # a retry that landed stands for the failed page; pages after a chart's end aren't needed
    pages = [(D, 132, 0, bad), (D, 132, 0, _page([_t(1)], nxt="")), (D, 132, 1, bad), (D, 132, 2, _page([_t(8)]))]
    ex = extract.extract(*_frames(spark, pages, ONE))
    assert [r.id for r in ex.titres.collect()] == [1]
    assert ex.rejected_responses.count() == 2


def test_strict_extraction_aborts_on_the_genre_list_and_nameless_artists(spark):
    _, p, a = _frames(spark, [(D, 132, 0, _page([_t(1)]))], ONE)
    for body in (ERROR, "{", '{"data": []}'):
        with pytest.raises(extract.ExtractionError, match="no genre"):
            extract.extract(spark.createDataFrame([(body,)], "body string"), p, a)
    with pytest.raises(extract.ExtractionError, match="unresolved"):
        extract.extract(*_frames(spark, [(D, 132, 0, _page([_t(1)]))], [{"id": 1}]))


def test_only_the_first_occurrence_needs_its_fields(spark):
    pages = [(D, 132, 0, _page([_t(1)])), (D, 116, 0, _page([_t(1, title=None)]))]
    ex = extract.extract(*_frames(spark, pages, ONE))
    assert [(r.id, r.title) for r in ex.titres.collect()] == [(1, "t")]
    assert ex.rejected_tracks.count() == 0


def _dated(spark, lists, pages):
    g = spark.createDataFrame(lists, "date_snapshot string, body string")
    _, p, a = _frames(spark, pages, ONE)
    return g, p, a


LIST = json.dumps({"data": [{"id": 0, "name": "All"}, {"id": 132, "name": "Pop"}]})
NEXT_DAY = "2026-09-06"


def test_strict_extraction_aborts_on_pages_that_never_landed(spark):
    first, third = (D, 132, 0, _page([_t(1)], nxt="p1")), (D, 132, 2, _page([_t(3)]))
    with pytest.raises(extract.ExtractionError, match=r"1 gap\(s\) of pages"):
        extract.extract(*_frames(spark, [first, third], ONE))
    with pytest.raises(extract.ExtractionError, match=r"1 gap\(s\) of pages"):
        extract.extract(*_frames(spark, [third], ONE))
    genres = [{"id": 132, "name": "Pop"}, {"id": 116, "name": "Rap"}]
    with pytest.raises(extract.ExtractionError, match=r"1 walked chart\(s\) without a page"):
        extract.extract(*_frames(spark, [(D, 132, 0, _page([_t(1)]))], ONE, genres))
    lenient = extract.extract(*_frames(spark, [first, third], ONE, genres), strict=False)
    assert sorted(map(tuple, lenient.page_gaps.collect()), key=str) == [
        (D, 116, "unlanded", 0, None),
        (D, 132, "gap", 1, 1),
    ]
    # the walk may stop before the chart does: reported, no reason to abort
    ex = extract.extract(*_frames(spark, [first], ONE))
    assert list(map(tuple, ex.page_gaps.collect())) == [(D, 132, "open", 1, None)]


def test_dated_genre_lists(spark):
    pages = [(D, 132, 0, _page([_t(1)])), (NEXT_DAY, 132, 0, _page([_t(2)]))]
    with pytest.raises(extract.ExtractionError, match=r"1 snapshot\(s\) without a genre list"):
        extract.extract(*_dated(spark, [(D, LIST)], pages))
    with pytest.raises(extract.ExtractionError, match=r"1 snapshot\(s\) without a genre list"):
        extract.extract(*_dated(spark, [(D, LIST), (NEXT_DAY, ERROR)], pages))
    # a retry that landed stands for the failed list
    ex = extract.extract(*_dated(spark, [(D, LIST), (NEXT_DAY, ERROR), (NEXT_DAY, LIST)], pages))
    assert sorted(r.id for r in ex.titres.collect()) == [1, 2]
    assert [r.endpoint for r in ex.rejected_responses.collect()] == ["genre"]
    # a list whose snapshot has no page at all
    with pytest.raises(extract.ExtractionError, match=r"1 walked chart\(s\) without a page"):
        extract.extract(*_dated(spark, [(D, LIST), (NEXT_DAY, LIST)], pages[:1]))


def test_page_gaps_match_counting(spark):
    import random

    from hitparade.operators import ingest

    rnd = random.Random(3)
    walk, pages, want = [], [], []
    for g in range(1, 60):
        n = rnd.randint(0, 12)
        landed = sorted(p for p in range(n) if rnd.random() < 0.7)
        ends = {p for p in landed if rnd.random() < 0.15}
        walk.append((D, g))
        for p in landed:
            pages += [(D, g, p, _page([], nxt="" if p in ends else "n"))] * rnd.choice([1, 1, 2])
        if not landed:
            want.append((D, g, "unlanded", 0, None))
            continue
        stop = min(ends, default=max(landed))
        p = 0
        while p < stop:
            q = p
            while q not in landed and q < stop:
                q += 1
            if q > p:
                want.append((D, g, "gap", p, q - 1))
            p = q + 1
        if not ends:
            want.append((D, g, "open", max(landed) + 1, None))
    pages += [(D, 99, 1, _page([])), (D, 1, None, _page([])), (None, 1, 0, _page([]))]
    df = spark.createDataFrame(pages, "date_snapshot string, genre_id bigint, page_no int, body string")
    made = ingest.page_gaps(
        ingest.parse_chart_pages(df), spark.createDataFrame([*walk, (None, 5)], "date_snapshot string, genre_id bigint")
    )
    assert sorted(map(tuple, made.collect()), key=str) == sorted(want, key=str)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_strict_run_reads_its_pages_and_its_dedup_once(spark):
    pages = [(D, 132, 0, _page([_t(1), _t(2)], nxt="p1")), (D, 132, 1, _page([_t(2), _t(3)]))]
    frames = _frames(spark, pages, [{"id": 1, "name": "A"}])
    ex = extract.extract(*frames)
    # the gates needed every first-seen title: what is returned reads them, and no page
    for df in (ex.titres, ex.artistes):
        assert "from_json(body" not in _plan(df).split("artist_id")[0] and "next" not in _plan(df)
    assert "Window" not in _plan(ex.titres)
    assert sorted(r.id for r in ex.titres.collect()) == [1, 2, 3]
    # bodies stay where they are: the walk and the charts' ends go to them
    tracks = ingest.stop_after_last_page(ingest.parse_chart_pages(frames[1]))
    assert "BroadcastHashJoin" in _plan(tracks) and "SortMergeJoin" not in _plan(tracks)
    assert sorted(r.page_no for r in tracks.collect()) == [0, 1]


def test_chart_entries_are_shuffled_once_to_be_paged(spark):
    rows = [(D, g, p, i, i % 3, 5, None) for g in (1, 2, None) for i, p in enumerate([7, 7, None, 1, 25, 31, 31, 99])]
    rows.append(rows[0])  # a repeated entry is an entry
    entries = spark.createDataFrame(
        rows, "date_snapshot string, genre_id long, position long, id long, artist_id long, rank long, explicit_lyrics boolean"
    )
    paged = landing.paginate_chart(entries, page_size=3, range_width=10)
    assert "Join" not in _plan(paged)
    assert paged.columns == [*entries.columns, "page_no", "page_pos", "has_next"]
    for g in (1, 2, None):
        got = sorted(
            ((r.page_no, r.page_pos, r.has_next, r.position, r.id) for r in paged.collect() if r.genre_id == g),
        )
        chart = sorted(((r[2] is not None, r[2] or 0, r[3], r[2]) for r in rows if r[1] == g))
        n = len(chart)
        assert got == [(k // 3, k % 3, n > (k // 3 + 1) * 3, c[3], c[2]) for k, c in enumerate(chart)]


def test_landed_bodies_are_made_once(spark):
    pages = spark.createDataFrame([(D, 1, 0, "{}")], "date_snapshot string, genre_id bigint, page_no int, body string")
    landed = landing.landed(pages.groupBy(*pages.columns).count().drop("count"))
    assert "Aggregate" not in _plan(landed) and landed.collect() == pages.collect()
