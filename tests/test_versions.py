"""Versioned publishing: four tables that change together, or not at all."""

import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from hitparade import schemas
from hitparade.operators import quality
from hitparade.operators import star as star_ops
from hitparade.plans import daily
from hitparade.sinks import lake as lake_sink
from hitparade.sinks import versions
from hitparade.sources import lake as lake_src

D1, D2, D3 = "2026-09-05", "2026-09-06", "2026-09-07"
TITRES = schemas.ddl(schemas.TITRES)
ARTISTES = schemas.ddl(schemas.ARTISTES) + ", date string"


def _star(spark, dates, rank, n=3):
    titres = [(i, f"t{i}", 200, rank, None, -1.0, False, i % 2, 7, d) for d in dates for i in range(n)]
    artistes = [(i, f"a{i}", rank, 1, d) for d in dates for i in range(2)]
    return star_ops.build_star(spark.createDataFrame(titres, TITRES), spark.createDataFrame(artistes, ARTISTES))


def _content(star):
    return {t: sorted(map(repr, df.select(*sorted(df.columns)).collect())) for t, df in star.tables().items()}


@pytest.mark.parametrize("table", list(schemas.CURATED))
def test_a_run_that_dies_in_one_write_leaves_the_old_star_whole(spark, tmp_path, monkeypatch, table):
    root = str(tmp_path / "cur")
    old = _star(spark, [D1, D2], 10)
    daily.publish_audited(old, root)
    real = lake_sink.counted_write

    def dying(df, path, name, **kwargs):
        if name == table:
            raise OSError("disk gone")
        return real(df, path, name, **kwargs)

    monkeypatch.setattr(lake_sink, "counted_write", dying)
    new = _star(spark, [D1, D3], 20)
    with pytest.raises(OSError, match="disk gone"):
        daily.publish_audited(new, root)
    assert _content(versions.read_live(spark, root)) == _content(old)
    monkeypatch.undo()
    daily.publish_audited(new, root)  # the rerun
    expected = {t: sorted(_content(old.on([D2]))[t] + _content(new)[t]) for t in schemas.CURATED}
    assert _content(versions.read_live(spark, root)) == expected


def test_a_run_that_dies_before_its_commit_is_not_seen(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "cur")
    old = _star(spark, [D1], 10)
    daily.publish_audited(old, root)

    def dying(*args):
        raise OSError("driver gone")

    monkeypatch.setattr(versions, "commit", dying)
    with pytest.raises(OSError):
        daily.publish_audited(_star(spark, [D1], 20), root)
    assert _content(versions.read_live(spark, root)) == _content(old)


def test_the_audit_publishes_only_snapshots_that_pass(spark, tmp_path):
    root = str(tmp_path / "cur")
    old = _star(spark, [D1, D2], 10)
    daily.publish_audited(old, root, version="a")
    new = _star(spark, [D1, D2], 20)
    bad = new.fait_popularite.unionByName(new.fait_popularite.where(F.col("date") == D2))
    with pytest.raises(quality.QualityGateError, match=D2) as failed:
        daily.publish_audited(dataclasses.replace(new, fait_popularite=bad), root, version="b")
    assert failed.value.dates == [D2]
    expected = {t: sorted(_content(new.at(D1))[t] + _content(old.at(D2))[t]) for t in schemas.CURATED}
    assert _content(versions.read_live(spark, root)) == expected
    assert {r.date: r.version for r in versions.live(spark, root).collect()} == {D1: "b", D2: "a"}
    assert _content(versions.read_live(spark, root, D2)) == _content(old.at(D2))


def test_rows_on_disk_must_be_those_counted(spark, tmp_path):
    root = str(tmp_path / "cur")
    written = versions.write_version(_star(spark, [D1], 10), root, "a")
    with pytest.raises(versions.TornVersionError):
        versions.commit(spark, root, "a", {**written, "dim_titre": written["dim_titre"] + 1})
    assert versions.publications(spark, root).isEmpty()
    assert versions.commit(spark, root, "a", written) == [D1]
    with pytest.raises(ValueError, match="published already"):
        versions.write_version(_star(spark, [D1], 20), root, "a")
    with pytest.raises(ValueError, match="not a version"):
        versions.write_version(_star(spark, [D1], 20), root, "../a")


def test_a_version_begun_later_stays_whichever_commits_first(spark, tmp_path):
    root = str(tmp_path / "cur")
    early, late = _star(spark, [D1], 10), _star(spark, [D1], 20)
    first, second = versions.new_version(), versions.new_version()
    assert first < second
    counted = [versions.write_version(s, root, v) for s, v in ((early, first), (late, second))]
    versions.commit(spark, root, second, counted[1])
    versions.commit(spark, root, first, counted[0])
    assert _content(versions.read_live(spark, root)) == _content(late)


def test_empty_and_absent(spark, tmp_path):
    root = str(tmp_path / "cur")
    assert versions.live(spark, root).isEmpty()
    nothing = versions.read_live(spark, root)
    assert all(df.isEmpty() and df.schema.names[-1] == "date" for df in nothing.tables().values())
    with pytest.raises(quality.QualityGateError, match="no snapshot"):
        daily.publish_audited(_star(spark, [D1], 10).on([]), root)
    assert versions.live(spark, root).isEmpty()


def test_vacuum_deletes_what_nobody_reads(spark, tmp_path):
    root = str(tmp_path / "cur")
    daily.publish_audited(_star(spark, [D1, D2], 10), root, version="a")
    daily.publish_audited(_star(spark, [D1], 20), root, version="b")
    versions.write_version(_star(spark, [D1], 30), root, "c")  # a dead run
    versions.write_version(_star(spark, [D1], 40), root, "e")  # one at work
    before = _content(versions.read_live(spark, root))
    assert versions.vacuum(spark, root, before="d") == 2 * len(schemas.CURATED)
    assert _content(versions.read_live(spark, root)) == before
    assert sorted(os.listdir(f"{root}/dim_date")) == ["version=a", "version=b", "version=e"]
    assert versions.vacuum(spark, root, before="d") == 0


def test_the_catalog_follows_the_live_versions(spark, tmp_path):
    root, db = str(tmp_path / "cur"), "charts_versions"
    old = _star(spark, [D1, D2], 10)
    daily.publish_audited(old, root)
    names = versions.sync_catalog(spark, db, root)
    assert _content(lake_src.catalog_star(spark, db)) == _content(old)
    new = _star(spark, [D2, D3], 20, n=5)
    daily.publish_audited(new, root)
    assert _content(lake_src.catalog_star(spark, db)) == _content(old)  # until the next sync
    for _ in range(2):
        versions.sync_catalog(spark, db, root, [D2, D3])
    assert _content(lake_src.catalog_star(spark, db)) == _content(versions.read_live(spark, root))
    assert [r.date for r in spark.table(names[0]).select("date").distinct().orderBy("date").collect()] == [D1, D2, D3]
    # one snapshot reads one folder
    plan = versions.read_live(spark, root, D1).fait_popularite
    assert len(plan.inputFiles()) >= 1 and all(f"date={D1}" in f for f in plan.inputFiles())


def test_run_curated_versioned(spark, tmp_path):
    stg, root = str(tmp_path / "stg"), str(tmp_path / "cur")
    titres = [(i, f"t{i}", 200, 5, None, -1.0, False, 1, 7, d) for d in (D1, D2) for i in range(3)]
    df = spark.createDataFrame(titres, TITRES)
    lake_sink.write_table(df.withColumn("date", F.col("date_snapshot")), f"{stg}/titres")
    lake_sink.write_table(spark.createDataFrame([(1, "a", 5, 1, d) for d in (D1, D2)], ARTISTES), f"{stg}/artistes")
    one = daily.run_curated(spark, stg, root, snapshot_date=D1, versioned=True)
    assert one.snapshot_dates == [D1] and one.rows == {"fait_popularite": 3, "dim_titre": 3, "dim_artiste": 1, "dim_date": 1}
    both = daily.run_curated(spark, stg, root, backfill=True, versioned=True)
    assert both.rows["fait_popularite"] == 6 and len(both.quality) == 14
    with pytest.raises(star_ops.SnapshotGateError):
        daily.run_curated(spark, stg, root, versioned=True)
    assert versions.read_live(spark, root).fait_popularite.count() == 6
