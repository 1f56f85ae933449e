"""What landed in each declared field: absent, null, or of a wrong type."""

import json

from hitparade.operators import field_types

D = "2026-09-05"


def _report(spark, *bodies):
    rows = [(D, b if b is None or isinstance(b, str) else json.dumps(b)) for b in bodies]
    report = field_types.field_report(spark.createDataFrame(rows, "date_snapshot string, body string"))
    return {r.field: (r.n_tracks, r.n_absent, r.n_null, r.n_wrong_type, r.kinds) for r in report.collect()}


def _track(**changes):
    good = {"id": 1, "title": "t", "duration": 200, "rank": 5, "bpm": 90.5, "gain": -1, "explicit_lyrics": True, "artist": {"id": 7}}
    return {k: v for k, v in {**good, **changes}.items() if v != "drop"}


def test_each_fault_is_named(spark):
    tracks = [
        _track(),
        _track(id="1", title=3, rank=5.5),
        _track(id=None, duration=3_000_000_000, bpm="fast", explicit_lyrics=1),
        _track(title="drop", gain=2.25, artist="someone"),
        _track(artist={}, rank=True, bpm="drop"),
        _track(artist={"id": [7]}, bpm=1e300),
    ]
    got = _report(spark, {"data": tracks[:4], "next": "x"}, {"data": tracks[4:]})
    assert got["id"] == (6, 0, 1, 1, "BIGINT,STRING,VOID")
    assert got["title"] == (6, 1, 0, 1, "BIGINT,STRING")
    assert got["duration"] == (6, 0, 0, 1, "BIGINT")
    assert got["rank"] == (6, 0, 0, 2, "BIGINT,BOOLEAN,DECIMAL")
    assert got["bpm"][:4] == (6, 1, 0, 1)
    assert got["gain"][:4] == (6, 0, 0, 0)
    assert got["explicit_lyrics"] == (6, 0, 0, 1, "BIGINT,BOOLEAN")
    assert got["artist"] == (6, 0, 0, 1, "OBJECT,STRING")
    assert got["artist.id"] == (6, 2, 0, 1, "ARRAY,BIGINT")


def test_bodies_without_entries(spark):
    assert _report(spark, None, "", "{broken", "[1]", {"next": "x"}, {"data": []}, {"data": "none"}, {"data": None}) == {}
    got = _report(spark, {"data": [None, 3, {}]})
    assert all(counts[:4] == (3, 3, 0, 0) for counts in got.values())
