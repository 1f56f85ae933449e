"""Results kept by snapshot: merged, refreshed and equal to the reports over all rows."""

import random

import pytest
from pyspark.sql import functions as F

from hitparade import schemas
from hitparade.operators import ingest, quality
from hitparade.operators import star as star_ops
from hitparade.plans import first_seen, history, reports
from hitparade.sinks import kept, versions

D1, D2, D3 = "2026-09-05", "2026-09-06", "2026-09-07"
ENTRY = "date_snapshot string, id long, genre_id long, position long, artist_id long, rank long, explicit_lyrics boolean"


def _star(spark, dates, seed):
    """Titles with null genres, scores, tempi and artists, ids beyond a bucket, zero and negative, repeated facts."""
    rnd = random.Random(seed)
    ids = [0, -1, -32768, -40000, 32768, 32769, 70000, 2**40, *range(1, 30)]
    fait, titres, artistes = [], [], []
    for d in dates:
        for i in rnd.sample(ids, 25):
            genre, artist = rnd.choice([1, 2, None]), rnd.choice([7, 8, 2**35, None])
            titres.append((i, f"t{i}", 100, rnd.choice([None, 60.0, 120.0]), 1.0, genre, d))
            fait += [(d, i, artist, rnd.choice([None, 5, 900]), d)] * rnd.choice([1, 1, 2])
        artistes += [(a, f"a{a}", rnd.choice([10, 600_000]), 1, d) for a in (7, 2**35)]
    ddl = {t: schemas.ddl(schemas.with_partition(s)) for t, s in schemas.CURATED.items()}
    facts = spark.createDataFrame(fait, ddl["fait_popularite"])
    return star_ops.Star(
        fait_popularite=facts,
        dim_titre=spark.createDataFrame(titres, ddl["dim_titre"]),
        dim_artiste=spark.createDataFrame(artistes, ddl["dim_artiste"]),
        dim_date=star_ops.dim_date_table(star_ops.build_dim_date(facts)),
    )


def _publish(spark, star, root):
    version = versions.new_version()
    versions.commit(spark, root, version, versions.write_version(star, root, version))
    return version


def _rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def _agree(spark, curated, root):
    star, h = versions.read_live(spark, curated), history.read(spark, curated, root)
    assert _rows(history.genre_popularity(h)) == _rows(reports.genre_popularity(star))
    assert _rows(history.bpm_by_genre(h)) == _rows(reports.bpm_by_genre(star))
    assert _rows(history.catalog_overview(h)) == _rows(reports.catalog_overview(star))
    assert _rows(history.emerging_artists(h)) == _rows(reports.emerging_artists(star))
    assert _rows(history.emerging_artists(h, 10**9, 100)) == _rows(reports.emerging_artists(star, None, 10**9, 100))
    by_date = quality.quality_report_by_date(star.fait_popularite, star.dim_titre, star.dim_artiste, seuil=0.5)
    assert _rows(history.quality_report(h, 0.5)) == _rows(by_date)


@pytest.mark.parametrize("dense", [1, 2, history.DENSE])
def test_kept_results_equal_the_reports_and_follow_what_is_published(spark, tmp_path, dense):
    curated, root = str(tmp_path / "cur"), str(tmp_path / "kept")
    _publish(spark, _star(spark, [D1, D2], 1), curated)
    assert history.refresh(spark, curated, root, dense) == [D1, D2]
    _agree(spark, curated, root)
    assert history.refresh(spark, curated, root, dense) == []
    # one date replaced, one new: those two are built, the third keeps its build
    before = {r.date: r.build for r in kept.live(spark, root)}
    _publish(spark, _star(spark, [D2, D3], 2), curated)
    with pytest.raises(history.StaleHistoryError) as e:
        history.read(spark, curated, root)
    assert e.value.dates == [D2, D3]
    assert history.refresh(spark, curated, root, dense) == [D2, D3]
    after = {r.date: r.build for r in kept.live(spark, root)}
    assert after[D1] == before[D1] and after[D2] != before[D2]
    _agree(spark, curated, root)


def test_reports_read_no_row_of_the_fact(spark, tmp_path):
    curated, root = str(tmp_path / "cur"), str(tmp_path / "kept")
    _publish(spark, _star(spark, [D1, D2], 3), curated)
    history.refresh(spark, curated, root)
    h = history.read(spark, curated, root)
    for made in (history.genre_popularity(h), history.catalog_overview(h), history.emerging_artists(h), history.quality_report(h)):
        assert made.inputFiles() and all("/kept/" in f for f in made.inputFiles())


def test_a_refresh_reads_changed_snapshots_only(spark, tmp_path, monkeypatch):
    curated, root = str(tmp_path / "cur"), str(tmp_path / "kept")
    _publish(spark, _star(spark, [D1, D2], 4), curated)
    history.refresh(spark, curated, root)
    late = _publish(spark, _star(spark, [D3], 5), curated)
    seen = []
    real = kept.write

    def watched(spark, root, tables, stamps):
        seen.extend(f for t in tables.values() for f in t.inputFiles())
        return real(spark, root, tables, stamps)

    monkeypatch.setattr(kept, "write", watched)
    assert history.refresh(spark, curated, root) == [D3]
    assert seen and all(f"version={late}/date={D3}" in f for f in seen)


def test_a_refresh_that_dies_is_not_seen(spark, tmp_path, monkeypatch):
    curated, root = str(tmp_path / "cur"), str(tmp_path / "kept")
    _publish(spark, _star(spark, [D1], 6), curated)
    history.refresh(spark, curated, root)
    _publish(spark, _star(spark, [D1, D2], 7), curated)
    real = kept.lake_sink.write_table

    def dying(df, path, **kwargs):
        if "/artists/" in path:
            raise OSError("disk gone")
        return real(df, path, **kwargs)

    monkeypatch.setattr(kept.lake_sink, "write_table", dying)
    with pytest.raises(OSError, match="disk gone"):
        history.refresh(spark, curated, root)
    monkeypatch.undo()
    with pytest.raises(history.StaleHistoryError):
        history.read(spark, curated, root)
    assert history.refresh(spark, curated, root) == [D1, D2]
    _agree(spark, curated, root)


def test_nothing_published_keeps_nothing(spark, tmp_path):
    curated, root = str(tmp_path / "cur"), str(tmp_path / "kept")
    assert history.refresh(spark, curated, root) == []
    h = history.read(spark, curated, root)
    assert history.catalog_overview(h).collect() == [] and history.quality_report(h).collect() == []


def test_first_seen_merged_equals_a_rebuild(spark, tmp_path):
    rnd = random.Random(8)
    rows = [
        (rnd.choice([D1, D2, D3]), rnd.choice([None, *range(12)]), rnd.choice([None, 1, 2]), rnd.randrange(5),
         rnd.randrange(3), rnd.choice([None, 4]), rnd.random() < 0.5)
        for _ in range(300)
    ]
    root = str(tmp_path / "state")
    entries = spark.createDataFrame(rows, ENTRY)
    for some in (rows[:120], rows[100:250], [r for r in rows[250:] if r[0] == D2], rows[250:]):
        first_seen.merge(spark.createDataFrame(some, ENTRY), root)
    assert _rows(first_seen.read(spark, root, entries.schema)) == _rows(ingest.first_seen(entries))
    # a late page touches its own date: the others keep their build
    before = {r.date: r.build for r in kept.live(spark, root)}
    late = (D1, 99, 1, 0, 1, 4, True)
    assert first_seen.merge(spark.createDataFrame([late], ENTRY), root) == [D1]
    after = {r.date: r.build for r in kept.live(spark, root)}
    assert after[D1] > before[D1] and (after[D2], after[D3]) == (before[D2], before[D3])
    assert late in {tuple(r) for r in first_seen.read(spark, root, entries.schema, [D1]).collect()}
    assert first_seen.merge(entries.limit(0), root) == []
    with pytest.raises(ValueError, match="date_snapshot"):
        first_seen.merge(entries.limit(1).withColumn("date_snapshot", F.lit(None).cast("string")), root)


def test_a_refresh_joins_the_fact_with_its_titles_once(spark, tmp_path, monkeypatch):
    curated, root = str(tmp_path / "cur"), str(tmp_path / "kept")
    _publish(spark, _star(spark, [D1, D2], 9), curated)
    real, seen = kept.write, {}

    def watched(spark, root, tables, stamps):
        seen.update({t: df.inputFiles() for t, df in tables.items()})
        seen["plan"] = tables["members"]._jdf.queryExecution().optimizedPlan().toString()
        return real(spark, root, tables, stamps)

    monkeypatch.setattr(kept, "write", watched)
    history.refresh(spark, curated, root)
    assert seen["genres"] and not any("/fait_popularite/" in f for f in seen["genres"])
    # a bucket is gathered as places: neither are its rows made distinct first, nor bitmaps shipped
    assert "collect_set" in seen["plan"] and "collect_list" not in seen["plan"]


def test_results_kept_in_another_layout_are_stale(spark, tmp_path, monkeypatch):
    curated, root = str(tmp_path / "cur"), str(tmp_path / "kept")
    _publish(spark, _star(spark, [D1, D2], 10), curated)
    monkeypatch.setattr(history, "LAYOUT", "before")
    history.refresh(spark, curated, root)
    monkeypatch.undo()
    with pytest.raises(history.StaleHistoryError):
        history.read(spark, curated, root)
    assert history.refresh(spark, curated, root) == [D1, D2]
    _agree(spark, curated, root)
