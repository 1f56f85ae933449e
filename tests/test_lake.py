"""Raw reader strictness, end-to-end runs with reruns, catalog maintenance and
the streaming ingest — each in its own fresh folder."""

import json
import os

import pytest
from pyspark.sql import functions as F

from hitparade import schemas
from hitparade.operators import quality
from hitparade.operators import star as star_ops
from hitparade.plans import daily, reports
from hitparade.sinks import catalog
from hitparade.sinks import lake as lake_sink
from hitparade.sinks import raw as raw_sink
from hitparade.sources import lake as lake_src
from hitparade.sources import landing
from hitparade.sources import raw as raw_src
from hitparade.streaming import snapshot_ingest

SF = "/root/testdata/sf0.001"


def _doc(tracks, artists):
    return {"tracks": tracks, "artists": artists}


def _t(id_, genre, rank=10, bpm=None, artist=1):
    return {"id": id_, "title": f"t{id_}", "duration": 200, "rank": rank, "bpm": bpm, "gain": -1.0,
            "explicit_lyrics": False, "artist_id": artist, "genre_id": genre}


def _write_doc(root, date, doc, name="snapshot.json", raw_text=None):
    d = os.path.join(root, f"date={date}")
    os.makedirs(d, exist_ok=True)
    path = os.path.join(d, name)
    with open(path, "w") as fh:
        fh.write(raw_text if raw_text is not None else json.dumps(doc, indent=2))
    return path


def test_legacy_document_reader(spark, tmp_path):
    doc = _doc([_t(1, 132), _t(1, 116), _t(2, 116, bpm=float("nan"))], [{"id": 1, "name": "A", "nb_fan": 5}])
    path = _write_doc(str(tmp_path), "2026-09-05", doc)
    raw = raw_src.read_raw(spark, path, multi_line=True)
    from hitparade.operators import staging

    titres = {r.id: r for r in staging.build_titres(raw).collect()}
    assert set(titres) == {1, 2} and titres[1].genre_id == 132  # first in the document's list order
    assert titres[1].date_snapshot == "2026-09-05"
    import math

    assert math.isnan(titres[2].bpm)
    art = staging.build_artistes(raw).first()
    assert art.nb_album is None and art.date == "2026-09-05"


def test_strict_reader_fails_on_malformed_and_wrong_type(spark, tmp_path):
    bad = _write_doc(str(tmp_path / "a"), "2026-09-05", None, raw_text='{"tracks": [ {"id": 1,')
    with pytest.raises(Exception):
        raw_src.read_raw(spark, bad, multi_line=True).collect()
    wrong = _write_doc(str(tmp_path / "b"), "2026-09-05", None, raw_text='{"tracks": [{"id": "abc"}]}')
    with pytest.raises(Exception):
        raw_src.read_raw(spark, wrong, multi_line=True).collect()
    lenient = raw_src.read_raw(spark, wrong, multi_line=True, strict=False).first()
    assert lenient[raw_src.CORRUPT] is not None


def test_reader_rejects_missing_or_impossible_dates(spark, tmp_path):
    nodate = tmp_path / "nodate.json"
    nodate.write_text(json.dumps(_doc([_t(1, 1)], [])))
    with pytest.raises(Exception, match="snapshot date"):
        raw_src.read_raw(spark, str(nodate), multi_line=True).collect()
    bad = _write_doc(str(tmp_path), "2026-99-99", _doc([_t(1, 1)], []))
    with pytest.raises(Exception, match="2026-99-99"):
        raw_src.read_raw(spark, bad, multi_line=True).collect()


def _landed(spark, root, dates=None):
    titres, artistes = landing.staging(spark, SF)
    if dates:
        titres = titres.where(F.col("date_snapshot").isin(dates))
        artistes = artistes.where(F.col("date").isin(dates))
    raw_sink.land_raw(titres, artistes, root)
    return titres, artistes


def test_end_to_end_two_dates_and_rerun(spark, tmp_path):
    raw, stg, cur = (str(tmp_path / x) for x in ("raw", "staging", "curated"))
    d1, d2 = "1998-03-01", "1998-04-01"
    _landed(spark, raw, [d1, d2])
    daily.run_staging(spark, raw, stg)
    r1 = daily.run_curated(spark, stg, cur, snapshot_date=d1)
    r2 = daily.run_curated(spark, stg, cur, snapshot_date=d2)
    assert r1.snapshot_dates == [d1] and r2.rows["fait_popularite"] > 0
    before = {d: sorted(map(tuple, lake_src.read_table(spark, cur, "fait_popularite", d).collect())) for d in (d1, d2)}
    daily.run_curated(spark, stg, cur, snapshot_date=d1)  # rerun one date
    after = {d: sorted(map(tuple, lake_src.read_table(spark, cur, "fait_popularite", d).collect())) for d in (d1, d2)}
    assert before == after
    daily.check_freshness(spark, cur, d2)
    with pytest.raises(lake_src.MissingPartitionError):
        daily.check_freshness(spark, cur, "2030-01-01")
    # reports from the lake equal reports from the in-memory star
    titres, artistes = landing.staging(spark, SF)
    mem = star_ops.build_star(titres, artistes)
    lake = lake_src.read_star(spark, cur)
    for fn in reports.REPORTS.values():
        assert sorted(map(tuple, fn(lake, d1).collect())) == sorted(map(tuple, fn(mem, d1).collect()))


def test_curated_blocks_on_gates_before_writing(spark, tmp_path):
    raw, stg, cur = (str(tmp_path / x) for x in ("raw", "staging", "curated"))
    _landed(spark, raw, ["1998-03-01", "1998-04-01"])
    daily.run_staging(spark, raw, stg)
    with pytest.raises(star_ops.SnapshotGateError):
        daily.run_curated(spark, stg, cur)  # two dates, no backfill
    with pytest.raises(quality.QualityGateError):
        daily.run_curated(spark, stg, cur, snapshot_date="1998-03-01", seuil=1.0)
    assert not os.path.exists(os.path.join(cur, "fait_popularite"))
    res = daily.run_curated(spark, stg, cur, backfill=True)
    assert res.snapshot_dates is None and res.rows["dim_date"] == 2


def test_catalog_registration_and_retention(spark, tmp_path):
    cur = str(tmp_path / "curated")
    titres, artistes = landing.staging(spark, SF)
    lake_sink.publish_star(star_ops.build_star(titres, artistes), cur)
    names = catalog.register_curated(spark, "charts_test", cur, db_location=str(tmp_path / "db"))
    assert spark.table(names[0]).count() == 0  # partitions not yet registered
    catalog.recover_partitions(spark, names)
    assert spark.table("charts_test.fait_popularite").count() == titres.count()
    parts = catalog.partitions(spark, "charts_test.dim_date")
    expired = [r.date for r in catalog.expired_partitions(parts, as_of="1995-06-01").collect()]
    assert expired == ["1995-01-01", "1995-02-01"]
    with pytest.raises(ValueError):
        catalog.drop_partitions(spark, "charts_test.dim_date", expired)
    raw_root = str(tmp_path / "raw")
    raw_sink.land_raw(titres, artistes, raw_root)
    catalog.register_table(
        spark, "charts_test", "documents", raw_root, schemas.RAW_DOCUMENT, fmt="json", partition_by=("date", "kind")
    )
    catalog.recover_partitions(spark, ["charts_test.documents"])
    assert catalog.drop_partitions(spark, "charts_test.documents", expired) == 2
    assert not os.path.exists(os.path.join(raw_root, "date=1995-01-01"))
    left = [r[0] for r in spark.sql("SHOW PARTITIONS charts_test.documents").collect()]
    assert len(left) == 2 * 81 and not any("1995-01" in x or "1995-02" in x for x in left)
    fresh = {r.date: r.passed for r in catalog.partition_freshness(spark, names[0], ["1998-03-01", "2030-01-01"]).collect()}
    assert fresh == {"1998-03-01": True, "2030-01-01": False}


def test_staging_keeps_the_first_seen_in_walk_order(spark, tmp_path):
    cols = schemas.ddl(schemas.TITRES) + ", genre_ordinal bigint, position bigint"
    track = lambda id_, genre, ordinal, pos, rank: (id_, "t", 200, rank, None, -1.0, False, 1, genre, D, ordinal, pos)
    D = "2026-09-05"
    rows = [track(1, 116, 2, 0, 5), track(1, 132, 1, 9, 6), track(1, 132, 1, 3, 7), track(2, 116, 2, 1, 8)]
    artistes = spark.createDataFrame([(1, "A", 5, 1, D)] * 3, "id bigint, name string, nb_fan bigint, nb_album bigint, date string")
    raw, stg = str(tmp_path / "raw"), str(tmp_path / "stg")
    raw_sink.land_raw(spark.createDataFrame(rows, cols), artistes, raw)
    assert daily.run_staging(spark, raw, stg).rows == {"titres": 2, "artistes": 1}
    got = {(r.id, r.genre_id, r["rank"]) for r in lake_src.read_table(spark, stg, "titres").collect()}
    assert got == {(1, 132, 7), (2, 116, 8)}


def test_add_partitions_registers_only_the_dates_given(spark, tmp_path):
    titres, artistes = landing.staging(spark, SF)
    star = star_ops.build_star(titres, artistes).on(["1998-03-01", "1998-04-01"])
    cur = str(tmp_path / "curated")
    lake_sink.publish_star(star, cur)
    names = catalog.register_curated(spark, "charts_added", cur, db_location=str(tmp_path / "db"))
    catalog.add_partitions(spark, names, [])
    assert catalog.partitions(spark, names[0]).count() == 0
    for _ in range(2):
        catalog.add_partitions(spark, names, ["1998-04-01"])
    assert [r.date for r in catalog.partitions(spark, names[0]).collect()] == ["1998-04-01"]
    assert spark.table(names[0]).count() == star.at("1998-04-01").fait_popularite.count()


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, date string")
    lake_sink.write_table(df, path, mode="full")
    lake_sink.write_table(df, path, mode="append")
    lake_sink.write_table(df.where("date = 'a'"), path, mode="dates")
    got = {r.date: r["count"] for r in spark.read.parquet(path).groupBy("date").count().collect()}
    assert got == {"a": 1, "b": 2}
    lake_sink.write_table(df.where("date = 'a'"), path, mode="full")
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError):
        lake_sink.write_table(df, path, mode="merge")


def test_stream_ingest_is_incremental_and_idempotent(spark, tmp_path):
    raw, stg, cur, ck = (str(tmp_path / x) for x in ("raw", "staging", "curated", "ckpt"))
    _landed(spark, raw, ["1998-03-01"])
    snapshot_ingest.start_snapshot_ingest(spark, raw, stg, cur, ck).awaitTermination()
    first = lake_src.read_table(spark, cur, "fait_popularite").count()
    _landed(spark, raw, ["1998-04-01"])
    snapshot_ingest.start_snapshot_ingest(spark, raw, stg, cur, ck).awaitTermination()
    fact = lake_src.read_table(spark, cur, "fait_popularite")
    assert {r.date for r in fact.select("date").distinct().collect()} == {"1998-03-01", "1998-04-01"}
    total = fact.count()
    snapshot_ingest.start_snapshot_ingest(spark, raw, stg, cur, ck).awaitTermination()  # nothing new
    assert lake_src.read_table(spark, cur, "fait_popularite").count() == total > first


def test_bucketed_layout_removes_join_shuffle(spark, tmp_path):
    titres, artistes = landing.staging(spark, SF)
    mem = star_ops.build_star(titres, artistes)
    names = catalog.register_bucketed_curated(spark, "charts_bucketed", str(tmp_path / "cur"), 8, str(tmp_path / "db"))
    catalog.insert_star(mem, "charts_bucketed")
    catalog.insert_star(mem.at("1998-03-01"), "charts_bucketed")  # rerun one date: replaced, not appended
    lake = lake_src.catalog_star(spark, "charts_bucketed")
    assert lake.fait_popularite.count() == mem.fait_popularite.count()
    prev = spark.conf.get(catalog.CO_PARTITION_CONF)
    spark.conf.set(catalog.CO_PARTITION_CONF, "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = reports.genre_popularity(lake)
        got = sorted(map(tuple, df.collect()))
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set(catalog.CO_PARTITION_CONF, prev)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted(map(tuple, reports.genre_popularity(mem).collect()))
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1  # only the group-by
    assert len(names) == 4


def test_stream_bounded_batches_and_rebuild(spark, tmp_path):
    raw, stg, cur, ck = (str(tmp_path / x) for x in ("raw", "staging", "curated", "ckpt"))
    _landed(spark, raw, ["1998-03-01", "1998-04-01", "1998-05-01"])
    q = snapshot_ingest.start_snapshot_ingest(spark, raw, stg, cur, ck, max_files_per_trigger=2)
    q.awaitTermination()
    assert len(q.recentProgress) > 1  # several bounded micro-batches
    fact = lake_src.read_table(spark, cur, "fait_popularite")
    titres, _ = landing.staging(spark, SF)
    exp = titres.where(F.col("date_snapshot").isin("1998-03-01", "1998-04-01", "1998-05-01"))
    assert sorted(map(tuple, fact.select("id_titre", "date").collect())) == sorted(
        map(tuple, exp.select("id", "date_snapshot").collect())
    )
    assert snapshot_ingest.rebuild_snapshots(spark, raw, [], stg, cur) == {}


def test_registered_raw_table_keeps_nested_schema(spark, tmp_path):
    from hitparade import schemas

    raw = str(tmp_path / "raw")
    _landed(spark, raw, ["1998-03-01"])
    catalog.create_database(spark, "raw_schema_test", str(tmp_path / "db"))
    catalog.register_table(
        spark, "raw_schema_test", "documents", raw, schemas.RAW_DOCUMENT, fmt="json", partition_by=("date", "kind")
    )
    catalog.recover_partitions(spark, ["raw_schema_test.documents"])
    t = spark.table("raw_schema_test.documents")
    assert t.schema["tracks"].dataType == schemas.RAW_DOCUMENT["tracks"].dataType
    n = t.select(F.explode("tracks").alias("x")).where(F.col("x.id").isNotNull()).count()
    assert n == landing.first_seen_titles(spark, SF).where("date_snapshot = '1998-03-01'").count()


def test_spread_by_date_bounds_files_per_date(spark, tmp_path):
    titres, artistes = landing.staging(spark, SF)
    s = star_ops.build_star(titres, artistes)
    root = str(tmp_path / "cur")
    rows = lake_sink.publish_star(s, root, files_per_date=2)
    assert rows["fait_popularite"] == titres.count()
    for d in ("1998-03-01", "1995-01-01"):
        files = [f for f in os.listdir(os.path.join(root, "fait_popularite", f"date={d}")) if f.endswith(".parquet")]
        assert 1 <= len(files) <= 2


def test_report_sink_per_date_rerun(spark, tmp_path):
    titres, artistes = landing.staging(spark, SF)
    s = star_ops.build_star(titres, artistes)
    root = str(tmp_path / "reports")
    r1 = reports.genre_popularity(s, "1998-03-01")
    path = lake_sink.write_report(r1, root, "genre_popularity", "1998-03-01")
    lake_sink.write_report(r1, root, "genre_popularity", "1998-03-01")  # rerun replaces
    lake_sink.write_report(reports.genre_popularity(s, "1998-04-01"), root, "genre_popularity", "1998-04-01")
    assert path.endswith("report=genre_popularity/date=1998-03-01")
    back = spark.read.parquet(f"{root}/report=genre_popularity")
    assert back.where("date = '1998-03-01'").count() == r1.count() == 7
    # an untyped read infers the date= partition as DATE
    assert {str(r.date) for r in back.select("date").distinct().collect()} == {"1998-03-01", "1998-04-01"}


def test_spark_written_nan_reads_back(spark, tmp_path):
    import math

    from hitparade import schemas

    titres = spark.createDataFrame(
        [(1, "a", 100, 5, float("nan"), -1.0, False, 1, 1, "2026-09-05")], schemas.TITRES
    )
    artistes = spark.createDataFrame([(1, "A", None, None, "2026-09-05")], "id bigint, name string, nb_fan bigint, nb_album bigint, date string")
    raw = str(tmp_path / "raw")
    raw_sink.land_raw(titres, artistes, raw)
    from hitparade.operators import staging

    back = staging.build_titres(raw_src.read_raw(spark, raw, kind="tracks")).first()
    assert raw_src.read_raw(spark, raw, kind="artists").where("tracks IS NOT NULL").count() == 0
    assert math.isnan(back.bpm) and back.date_snapshot == "2026-09-05"
    art = staging.build_artistes(raw_src.read_raw(spark, raw)).first()
    assert art.nb_fan is None and art.name == "A"


def test_cluster_conf_keys_are_known_sql_settings(spark):
    from hitparade.session import cluster_conf

    conf = cluster_conf()
    for key in conf:
        spark.conf.get(key)  # a registered setting has a default; an unknown key raises
        assert spark.conf.isModifiable(key), key


def test_rows_that_lie_by_date_are_written_without_a_shuffle(spark, tmp_path):
    from hitparade.sinks import versions

    titres = [(i, f"t{i}", 200, 5, None, -1.0, False, i % 2, 7, d) for d in ("2026-09-05", "2026-09-06") for i in range(9)]
    artistes = [(i, f"a{i}", 3, 1, d) for d in ("2026-09-05", "2026-09-06") for i in range(2)]
    star = star_ops.build_star(
        spark.createDataFrame(titres, schemas.ddl(schemas.TITRES)),
        spark.createDataFrame(artistes, schemas.ddl(schemas.ARTISTES) + ", date string"),
    )
    lake_sink.publish_star(star, str(tmp_path / "staged"))
    staged = lake_src.read_star(spark, str(tmp_path / "staged"))
    n = versions.write_version(staged, str(tmp_path / "cur"), "v1", laid_out=schemas.CURATED)
    assert n == {"fait_popularite": 18, "dim_titre": 18, "dim_artiste": 4, "dim_date": 2}
    written = versions.read_version(spark, str(tmp_path / "cur"), "v1")
    for t, df in staged.tables().items():
        assert sorted(map(repr, written.tables()[t].select(*df.columns).collect())) == sorted(map(repr, df.collect()))


def test_raw_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(raw_sink, "FILE_ROWS", 10)
    titres = [(i, f"t{i}", 200, 5, None, -1.0, False, 1, 7, "2026-09-05") for i in range(25)]
    artistes = [(i, f"a{i}", 3, 1, "2026-09-05") for i in range(2)]
    raw_sink.land_raw(
        spark.createDataFrame(titres, schemas.ddl(schemas.TITRES)),
        spark.createDataFrame(artistes, schemas.ddl(schemas.ARTISTES) + ", date string"),
        str(tmp_path / "raw"),
    )
    files = [f for f in os.listdir(tmp_path / "raw" / "date=2026-09-05" / "kind=tracks") if f.startswith("part-")]
    assert len(files) >= 3 and all(f.endswith(".json.gz") for f in files)
    back = raw_src.read_raw(spark, str(tmp_path / "raw"), kind="tracks")
    assert back.count() == 25


def test_a_star_to_write_has_its_dedup_once(spark):
    import __spark_entry__ as entry

    star = entry._star_to_write(spark, entry.SMOKE_DIR)
    for t in ("fait_popularite", "dim_titre", "dim_date"):
        assert "Window" not in star.tables()[t]._jdf.queryExecution().executedPlan().toString()


def test_staging_titles_are_shuffled_once(spark, tmp_path):
    from hitparade.operators import ingest, staging

    raw, stg = str(tmp_path / "raw"), str(tmp_path / "staging")
    tracks = [(i % 7, f"t{i % 7}", 100, i, None, 1.0, False, i % 3, g, d, g, p) for d in ("2026-09-05", "2026-09-06")
              for i in range(20) for g in (1, 2) for p in (i,)] + [(None, "n", 1, 1, None, None, True, 1, 1, "2026-09-05", 1, 5)] * 2
    titres = spark.createDataFrame(
        tracks,
        "id long, title string, duration int, rank long, bpm double, gain double, explicit_lyrics boolean, "
        "artist_id long, genre_id long, date_snapshot string, genre_ordinal long, position long",
    )
    artistes = spark.createDataFrame([(1, "a", 5, 1, "2026-09-05")] * 3, "id long, name string, nb_fan long, nb_album long, date string")
    raw_sink.land_raw(titres, artistes, raw)
    made = staging.build_titres(raw_src.read_raw(spark, raw, kind="tracks"))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(date_snapshot" in plan and "_part" in plan
    rows = daily.run_staging(spark, raw, stg).rows
    assert rows == {"titres": 15, "artistes": 1}
    want = ingest.first_seen(titres, order=("genre_ordinal", "position")).select(*schemas.TRACK_COLUMNS, "date_snapshot")
    got = lake_src.read_table(spark, stg, "titres", schema=schemas.TITRES).select(*want.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert ingest.parts_per_date(spark, 1) >= ingest.parts_per_date(spark, 1000) == ingest.PARTS_PER_DATE


def test_kept_entries_with_fewer_columns_are_the_same_entries(spark):
    whole = landing.kept_entries(spark, SF)
    for last in ("artist_id", "rank"):
        some = landing.kept_up_to(spark, SF, last)
        assert "explicit_lyrics" not in some.columns
        assert sorted(map(repr, some.collect())) == sorted(map(repr, whole.select(*some.columns).collect()))
