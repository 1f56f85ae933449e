"""The reference's twelve rule cases on Spark DataFrames, plus the edge cases
it leaves untested (empty fact, ratio exactly at the threshold, NaN bpm, bpm
bounds, null duration, null artist ids)."""

import math

import pytest

from hitparade.operators import quality as q
from tests import fixtures as fx


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def by_rule(df):
    return {r["rule"]: r for r in df.collect()}


# --- uniqueness
def test_unicite_nominal(spark):
    r = one(q.check_unicite(fx.fait(spark)))
    assert r.passed and r.violations == 0


def test_unicite_doublon(spark):
    rows = fx.fait_rows() + [fx.fait_rows()[0]]
    r = one(q.check_unicite(fx.fait(spark, rows)))
    assert not r.passed and r.violations == 1


def test_unicite_empty_passes(spark):
    assert one(q.check_unicite(fx.fait(spark, []))).passed


def test_unicite_null_keys_are_equal(spark):
    rows = [(fx.D, None, 10, 1), (fx.D, None, 10, 2)]
    assert one(q.check_unicite(fx.fait(spark, rows))).violations == 1


# --- completeness
def test_completude_nominal(spark):
    r = one(q.check_completude(fx.fait(spark)))
    assert r.passed and r.observed == 1.0


def test_completude_sous_seuil(spark):
    rows = fx.fait_rows()
    rows[0] = (fx.D, 1, 10, None)
    r = one(q.check_completude(fx.fait(spark, rows), seuil=0.98))
    assert not r.passed and r.violations == 1 and math.isclose(r.observed, 2 / 3)


def test_completude_empty_fails(spark):
    r = one(q.check_completude(fx.fait(spark, [])))
    assert not r.passed and r.observed is None


def test_completude_exactly_threshold_fails(spark):
    # 49 of 50 present = 0.98 exactly: the rule is strictly greater
    rows = [(fx.D, i, 10, None if i == 0 else 1) for i in range(50)]
    r = one(q.check_completude(fx.fait(spark, rows)))
    assert r.observed == 0.98 and not r.passed


def test_completude_nan_is_missing(spark):
    rows = [(1, "A", 1, float("nan"), 0.0, 1), (2, "B", 1, 1.0, 0.0, 1)]
    r = one(q.check_completude(fx.dim_titre(spark, rows), column="bpm", seuil=0.4))
    assert r.observed == 0.5 and r.passed


# --- validity
def test_validite_nominal(spark):
    assert all(r.passed for r in q.check_validite(fx.fait(spark), fx.dim_titre(spark)).collect())


def test_validite_score_negatif(spark):
    rows = fx.fait_rows()
    rows[0] = (fx.D, 1, 10, -1)
    rules = by_rule(q.check_validite(fx.fait(spark, rows), fx.dim_titre(spark)))
    assert not rules["validite_score"].passed and rules["validite_score"].violations == 1


def test_validite_duree_invalide(spark):
    rows = fx.titre_rows()
    rows[0] = (1, "A", 0, 120.0, -5.0, 132)
    rules = by_rule(q.check_validite(fx.fait(spark), fx.dim_titre(spark, rows)))
    assert not rules["validite_duree"].passed


def test_validite_bpm_hors_plage(spark):
    rows = fx.titre_rows()
    rows[0] = (1, "A", 180, 350.0, -5.0, 132)
    rules = by_rule(q.check_validite(fx.fait(spark), fx.dim_titre(spark, rows)))
    assert not rules["validite_bpm"].passed


def test_validite_edges_pass(spark):
    # NaN bpm, bpm exactly 0 and 300, null duration: all allowed
    rows = [
        (1, "A", None, float("nan"), 0.0, 1),
        (2, "B", 10, 0.0, 0.0, 1),
        (3, "C", 10, 300.0, 0.0, 1),
    ]
    assert all(r.passed for r in q.check_validite(fx.fait(spark), fx.dim_titre(spark, rows)).collect())


# --- referential integrity
def test_coherence_nominal(spark):
    assert one(q.check_coherence(fx.fait(spark), fx.dim_artiste(spark))).passed


def test_coherence_artiste_orphelin(spark):
    rows = fx.fait_rows()
    rows[0] = (fx.D, 1, 999, 500)
    r = one(q.check_coherence(fx.fait(spark, rows), fx.dim_artiste(spark)))
    assert not r.passed and r.violations == 1


def test_coherence_counts_rows_not_ids(spark):
    rows = [(fx.D, 1, 999, 1), (fx.D, 2, 999, 1), (fx.D, 3, 10, 1)]
    assert one(q.check_coherence(fx.fait(spark, rows), fx.dim_artiste(spark))).violations == 2


def test_coherence_null_artist_is_null_safe(spark):
    rows = [(fx.D, 1, None, 1)]
    assert not one(q.check_coherence(fx.fait(spark, rows), fx.dim_artiste(spark))).passed
    dim = fx.artiste_rows() + [(None, "?", 0, 0)]
    assert one(q.check_coherence(fx.fait(spark, rows), fx.dim_artiste(spark, dim))).passed


def test_coherence_per_snapshot(spark):
    f = spark.createDataFrame([(fx.D, 1, 10, 1, fx.D)], fx.FAIT_COLS + ", date string")
    d = spark.createDataFrame([(10, "x", 1, 1, "2026-09-04")], fx.ARTISTE_COLS + ", date string")
    assert not one(q.check_coherence(f, d)).passed


# --- freshness
def test_fraicheur_nominal(spark):
    assert one(q.check_fraicheur(fx.fait(spark), fx.D)).passed


def test_fraicheur_absente(spark):
    r = one(q.check_fraicheur(fx.fait(spark), "2026-09-06"))
    assert not r.passed and r.observed == 0


# --- report and gate
def test_report_all_pass(spark):
    report = q.quality_report(fx.fait(spark), fx.dim_titre(spark), fx.dim_artiste(spark), date_attendue=fx.D)
    rows = q.enforce(report)
    assert {r["rule"] for r in rows} == {
        "unicite", "completude", "validite_score", "validite_duree", "validite_bpm", "coherence", "fraicheur"
    }


def _three_days(spark):
    """Ninety-nine whole facts on one day, one without a score on another, artists only on a third."""
    rows = [("2026-09-05", i, 10, 5, "2026-09-05") for i in range(99)] + [("2026-09-06", 1, 10, None, "2026-09-06")]
    titres = [(1, "A", 100, None, 0.0, 7, d) for d in ("2026-09-05", "2026-09-06")]
    artistes = [(10, "x", 1, 1, d) for d in ("2026-09-05", "2026-09-06", "2026-09-07")]
    return (
        spark.createDataFrame(rows, fx.FAIT_COLS + ", date string"),
        spark.createDataFrame(titres, fx.TITRE_COLS + ", date string"),
        spark.createDataFrame(artistes, fx.ARTISTE_COLS + ", date string"),
    )


def test_each_snapshot_is_judged_alone(spark):
    f, t, a = _three_days(spark)
    assert q.enforce(q.quality_report(f, t, a))  # as one pool the empty score passes
    rows, good, error = q.judge_by_date(q.quality_report_by_date(f, t, a))
    assert good == ["2026-09-05"] and len(rows) == 3 * 7
    failed = {(r["date"], r["rule"]) for r in rows if not r["passed"]}
    assert failed == {("2026-09-06", "completude"), ("2026-09-07", "completude"), ("2026-09-07", "fraicheur")}
    assert "2026-09-06: completude" in str(error) and "2026-09-05" not in str(error)
    _, good, error = q.judge_by_date(q.quality_report_by_date(f.limit(0), t.limit(0), a.limit(0)))
    assert good == [] and "no snapshot" in str(error)


def test_backfill_publishes_the_good_snapshots(spark, tmp_path):
    from hitparade.operators.star import Star, build_dim_date, dim_date_table
    from hitparade.plans import daily

    f, t, a = _three_days(spark)
    star = Star(f, t, a, dim_date_table(build_dim_date(f)))
    with pytest.raises(q.QualityGateError, match="2026-09-06"):
        daily.publish_gated(star, str(tmp_path))
    for table in star.tables():
        assert [x.name for x in sorted((tmp_path / table).glob("date=*"))] == ["date=2026-09-05"]


def test_gate_lists_every_failure(spark):
    rows = fx.fait_rows() + [fx.fait_rows()[0]]
    rows[1] = (fx.D, 2, 999, -5)
    report = q.quality_report(fx.fait(spark, rows), fx.dim_titre(spark), fx.dim_artiste(spark))
    with pytest.raises(q.QualityGateError) as err:
        q.enforce(report)
    msg = str(err.value)
    assert "unicite" in msg and "validite_score" in msg and "coherence" in msg
