"""The streaming ingest learns dates from paths, rebuilds each once a run, and keeps a ledger."""

import json
import os

import pytest
from pyspark.sql import functions as F

from hitparade.operators import quality
from hitparade.sources import lake as lake_src
from hitparade.streaming import snapshot_ingest


def _track(i, score=10):
    return {"id": i, "title": f"t{i}", "duration": 200, "rank": score, "bpm": 100.0, "gain": -1.0,
            "explicit_lyrics": False, "artist_id": 1, "genre_id": 132}


def _land(root, date, name, tracks, artists=({"id": 1, "name": "A", "nb_fan": 5, "nb_album": 1},)):
    for kind, doc in (("tracks", {"tracks": tracks}), ("artists", {"artists": list(artists)})):
        folder = os.path.join(root, f"date={date}", f"kind={kind}")
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, f"{name}.json"), "w") as f:
            f.write(json.dumps(doc) + "\n")


def _run(spark, tmp_path, **options):
    roots = [str(tmp_path / x) for x in ("raw", "staging", "curated", "ckpt")]
    query = snapshot_ingest.start_snapshot_ingest(spark, *roots, **options)
    query.awaitTermination()
    return query


def _ledger(spark, tmp_path):
    rows = snapshot_ingest.Ledger(spark, str(tmp_path / "ckpt") + "-ledger").rows().orderBy("at", "date").collect()
    return [(r.date, r.n_files, r.error is None) for r in rows]


def _ids(spark, tmp_path):
    fact = lake_src.read_table(spark, str(tmp_path / "curated"), "fait_popularite")
    return sorted((r.date, r.id_titre) for r in fact.select("date", "id_titre").collect())


def test_a_date_is_rebuilt_once_a_run(spark, tmp_path):
    raw = str(tmp_path / "raw")
    for d in ("2026-01-01", "2026-01-02"):
        for k in range(4):
            _land(raw, d, f"part{k}", [_track(k)])
    query = _run(spark, tmp_path, max_files_per_trigger=3)
    assert len(query.recentProgress) > 2  # each date's files are spread over several batches
    assert sorted(
        _ledger(spark, tmp_path)
    ) == [("2026-01-01", 8, True), ("2026-01-02", 8, True)]
    assert _ids(spark, tmp_path) == [(d, k) for d in ("2026-01-01", "2026-01-02") for k in range(4)]
    # a late file changes its own date only
    _land(raw, "2026-01-02", "late", [_track(9)])
    _run(spark, tmp_path)
    assert [x[0] for x in _ledger(spark, tmp_path)[2:]] == ["2026-01-02"]
    assert ("2026-01-02", 9) in _ids(spark, tmp_path)


def test_a_replayed_batch_does_nothing(spark, tmp_path):
    raw, stg, cur = (str(tmp_path / x) for x in ("raw", "staging", "curated"))
    _land(raw, "2026-01-01", "a", [_track(1)])
    book = snapshot_ingest.Ledger(spark, str(tmp_path / "book"))
    assert snapshot_ingest.rebuild_changed(spark, raw, ["2026-01-01"], stg, cur, book, 0) == ["2026-01-01"]
    written = sorted(os.listdir(f"{cur}/fait_popularite/date=2026-01-01"))
    assert snapshot_ingest.rebuild_changed(spark, raw, ["2026-01-01"], stg, cur, book, 0) == []
    assert sorted(os.listdir(f"{cur}/fait_popularite/date=2026-01-01")) == written
    # a lost checkpoint replays every file: still nothing to build
    _run(spark, tmp_path, ledger=str(tmp_path / "book"))
    assert sorted(os.listdir(f"{cur}/fait_popularite/date=2026-01-01")) == written


def test_a_failing_date_does_not_retry_the_good_ones(spark, tmp_path):
    raw = str(tmp_path / "raw")
    _land(raw, "2026-01-01", "a", [_track(1)])
    _land(raw, "2026-01-02", "a", [_track(1, score=-5)])  # invalid score
    with open(os.path.join(raw, "date=2026-01-02", "kind=tracks", "b.json"), "w") as f:
        f.write("")
    for _ in range(2):
        with pytest.raises(Exception, match="quality gate failed"):
            _run(spark, tmp_path)
    assert [x for x in _ledger(spark, tmp_path) if x[0] == "2026-01-01"] == [("2026-01-01", 2, True)]
    assert [x[2] for x in _ledger(spark, tmp_path) if x[0] == "2026-01-02"] == [False, False]
    assert _ids(spark, tmp_path) == [("2026-01-01", 1)]
    _land(raw, "2026-01-02", "a", [_track(1)])  # mended
    _run(spark, tmp_path)
    assert _ids(spark, tmp_path) == [("2026-01-01", 1), ("2026-01-02", 1)]


def test_an_unreadable_date_does_not_stop_the_others(spark, tmp_path):
    raw, stg, cur = (str(tmp_path / x) for x in ("raw", "staging", "curated"))
    _land(raw, "2026-01-01", "a", [_track(1)])
    _land(raw, "2026-01-02", "a", [_track(2)])
    with open(os.path.join(raw, "date=2026-01-02", "kind=tracks", "a.json"), "w") as f:
        f.write('{"tracks": [{"id": 1,')
    book = snapshot_ingest.Ledger(spark, str(tmp_path / "book"))
    dates = ["2026-01-01", "2026-01-02"]
    with pytest.raises(Exception):  # noqa: B017
        snapshot_ingest.rebuild_changed(spark, raw, dates, stg, cur, book)
    assert {d: book.built_from(dates).get(d) is not None for d in dates} == {"2026-01-01": True, "2026-01-02": False}
    assert _ids(spark, tmp_path) == [("2026-01-01", 1)]


def test_no_body_is_read_to_learn_a_date(spark, tmp_path):
    raw = str(tmp_path / "raw")
    _land(raw, "2026-01-01", "a", [_track(1)])
    listed = snapshot_ingest.landed_files(spark, raw, ["2026-01-01"])
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()
    assert [(r.date, r.n_files) for r in listed.collect()] == [("2026-01-01", 2)]
    bad = spark.createDataFrame([("x/date=2026-99-99/a.json", 1)], "path string, length long")
    with pytest.raises(Exception, match="invalid snapshot date"):
        snapshot_ingest.files_by_date(bad.withColumn("modificationTime", F.current_timestamp())).collect()


def test_gate_error_names_its_dates():
    assert quality.QualityGateError("x").dates == []
