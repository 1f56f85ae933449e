"""Data-quality rules over the star, computed as distributed aggregates.

Each rule returns a small report DataFrame with the columns of
:data:`REPORT_COLUMNS`; :func:`quality_report` unions them and :func:`enforce`
is the blocking gate. Only report rows (a handful) ever reach the driver —
the rules themselves never collect table data.

Rules (same semantics as the reference's checks):

* ``unicite``: no duplicate (id_titre, date_snapshot); nulls are equal; an
  empty fact passes. Violations = rows beyond the first of each key.
* ``completude``: share of present ``score_popularite`` strictly above the
  threshold (0.98); an empty fact fails. NaN counts as missing.
* ``validite_score`` / ``validite_duree`` / ``validite_bpm``: score >= 0 when
  present; duree > 0 (null passes); bpm within [0, 300] when present (null and
  NaN pass).
* ``coherence``: every fact id_artiste exists in dim_artiste (per snapshot
  when both sides carry ``date``); null-safe, so a null id matches a null id;
  violations count fact *rows*.
* ``fraicheur``: some fact row has ``date_snapshot`` equal to the expected date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitparade.constants import BPM_RANGE, COMPLETENESS_THRESHOLD, UNIQUENESS_KEY
from hitparade.functions import out_of_range, present

REPORT_COLUMNS = ("rule", "violations", "observed", "threshold", "passed")


def _row(rule: str, violations: Column, observed: Column, threshold: float | None, passed: Column) -> list[Column]:
    return [
        F.lit(rule).alias("rule"),
        violations.cast("long").alias("violations"),
        observed.cast("double").alias("observed"),
        F.lit(threshold).cast("double").alias("threshold"),
        passed.alias("passed"),
    ]


def _report_rows(agg: DataFrame, rows: list[list[Column]]) -> DataFrame:
    """Turn one aggregated row into several report rows without re-scanning:
    the rows are built as an array of structs and exploded."""
    return agg.select(F.explode(F.array(*[F.struct(*r) for r in rows])).alias("_r")).select("_r.*")


def check_unicite(fait: DataFrame, key: Sequence[str] = UNIQUENESS_KEY) -> DataFrame:
    """Rows beyond the first of each key. Partial aggregation first, so a hot
    key collapses to one count per map task before the shuffle."""
    counts = fait.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    dups = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))
    return counts.agg(dups.alias("_d")).select(*_row("unicite", F.col("_d"), F.col("_d"), 0.0, F.col("_d") == 0))


def _completude_row(name: str, n: Column, ok: Column, seuil: float) -> list[Column]:
    ratio = F.when(n > 0, ok / n)
    passed = (n > 0) & F.coalesce(ratio > F.lit(seuil), F.lit(False))
    return _row(name, n - ok, ratio, seuil, passed)


def _zero_row(name: str, v: Column, threshold: float | None = 0.0) -> list[Column]:
    return _row(name, v, v, threshold, v == 0)


def _fraicheur_row(fresh: Column) -> list[Column]:
    return _row("fraicheur", F.when(fresh > 0, 0).otherwise(1), fresh, None, fresh > 0)


def check_completude(
    fait: DataFrame, column: str = "score_popularite", seuil: float = COMPLETENESS_THRESHOLD
) -> DataFrame:
    """Share of present values; passes only if the table is non-empty and the
    share is strictly above ``seuil``. ``observed`` is the share (null if
    empty)."""
    agg = fait.agg(F.count(F.lit(1)).alias("_n"), F.count_if(present(column)).alias("_ok"))
    name = "completude" if column == "score_popularite" else f"completude_{column}"
    return agg.select(*_completude_row(name, F.col("_n"), F.col("_ok"), seuil))


def _titre_profile(dim_titre: DataFrame, bpm_range: tuple[float, float]) -> DataFrame:
    return dim_titre.agg(
        F.count_if(F.col("duree") <= 0).alias("_d"),
        F.count_if(out_of_range("bpm", *bpm_range)).alias("_b"),
    )


def _titre_rows(bpm_range: tuple[float, float]) -> list[list[Column]]:
    return [_zero_row("validite_duree", F.col("_d")), _zero_row("validite_bpm", F.col("_b"), bpm_range[1])]


def check_validite(
    fait: DataFrame, dim_titre: DataFrame, bpm_range: tuple[float, float] = BPM_RANGE
) -> DataFrame:
    """Three rows: negative scores, non-positive durations, bpm out of range.

    One aggregate over the fact, one over the title dimension.
    """
    f = fait.agg(F.count_if(out_of_range("score_popularite", 0, None)).alias("_s"))
    score = f.select(*_zero_row("validite_score", F.col("_s")))
    return score.unionByName(_report_rows(_titre_profile(dim_titre, bpm_range), _titre_rows(bpm_range)))


def orphan_artist_rows(fait: DataFrame, dim_artiste: DataFrame) -> DataFrame:
    """Fact rows per (id_artiste[, date]) whose artist is not in the dimension.

    The fact is first reduced to one count per (artist, date) — a partial
    aggregate, so a hot artist never ships its rows — then anti-joined,
    null-safe on the id, to the distinct dimension keys.
    """
    by_date = "date" in fait.columns and "date" in dim_artiste.columns
    keys = ["id_artiste", "date"] if by_date else ["id_artiste"]
    fact_keys = fait.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    dim_keys = dim_artiste.select(*[F.col(k).alias(f"_d_{k}") for k in keys]).distinct()
    cond = F.col("id_artiste").eqNullSafe(F.col("_d_id_artiste"))
    if by_date:
        cond = cond & (F.col("date") == F.col("_d_date"))
    return fact_keys.join(dim_keys, cond, "left_anti")


def check_coherence(fait: DataFrame, dim_artiste: DataFrame) -> DataFrame:
    orphans = orphan_artist_rows(fait, dim_artiste)
    v = F.coalesce(F.sum("n_rows"), F.lit(0))
    return orphans.agg(v.alias("_o")).select(*_zero_row("coherence", F.col("_o")))


def check_fraicheur(fait: DataFrame, date_attendue: str) -> DataFrame:
    """Passes when at least one fact row is stamped ``date_attendue``.
    ``observed`` is the number of such rows."""
    agg = fait.agg(F.count_if(F.col("date_snapshot") == F.lit(date_attendue)).alias("_f"))
    return agg.select(*_fraicheur_row(F.col("_f")))


def quality_report(
    fait: DataFrame,
    dim_titre: DataFrame,
    dim_artiste: DataFrame,
    date_attendue: str | None = None,
    seuil: float = COMPLETENESS_THRESHOLD,
    bpm_range: tuple[float, float] = BPM_RANGE,
) -> DataFrame:
    """All rules: unicite, completude, validite (3), coherence, and fraicheur
    when an expected date is given.

    Four jobs' worth of work in one plan: the fact-level rules (completude,
    validite_score, fraicheur) share a single aggregate over the fact, the
    title rules share one over dim_titre; uniqueness and coherence each need
    their own keyed aggregate.
    """
    fact_aggs = [
        F.count(F.lit(1)).alias("_n"),
        F.count_if(present("score_popularite")).alias("_ok"),
        F.count_if(out_of_range("score_popularite", 0, None)).alias("_s"),
    ]
    fact_rows = [
        _completude_row("completude", F.col("_n"), F.col("_ok"), seuil),
        _zero_row("validite_score", F.col("_s")),
    ]
    if date_attendue is not None:
        fact_aggs.append(F.count_if(F.col("date_snapshot") == F.lit(date_attendue)).alias("_f"))
        fact_rows.append(_fraicheur_row(F.col("_f")))
    return (
        check_unicite(fait)
        .unionByName(_report_rows(fait.agg(*fact_aggs), fact_rows))
        .unionByName(_report_rows(_titre_profile(dim_titre, bpm_range), _titre_rows(bpm_range)))
        .unionByName(check_coherence(fait, dim_artiste))
    )


#: What the rules measure of a snapshot; sums of each merge.
MEASURES = ("n", "present", "negative", "fresh", "short", "tempo", "repeated", "orphans")


def measures_by_date(
    fait: DataFrame, dim_titre: DataFrame, dim_artiste: DataFrame, bpm_range: tuple[float, float] = BPM_RANGE
) -> DataFrame:
    """``date`` and :data:`MEASURES` of each snapshot: a ``date`` of any of the three tables.

    Every measure is a partial aggregate by date; the few rows they leave are
    added up in one more.
    """

    def measured(rows: DataFrame, **measures: Column) -> DataFrame:
        by = rows.groupBy("date").agg(*[c.alias(m) for m, c in measures.items()]) if measures else rows
        return by.select("date", *[(F.col(m) if m in measures else F.lit(0)).cast("long").alias(m) for m in MEASURES])

    keyed = fait.groupBy("date", *UNIQUENESS_KEY).agg(F.count(F.lit(1)).alias("_c"))
    parts = [
        measured(
            fait,
            n=F.count(F.lit(1)),
            present=F.count_if(present("score_popularite")),
            negative=F.count_if(out_of_range("score_popularite", 0, None)),
            fresh=F.count_if(F.col("date_snapshot") == F.col("date")),
        ),
        measured(
            dim_titre, short=F.count_if(F.col("duree") <= 0), tempo=F.count_if(out_of_range("bpm", *bpm_range))
        ),
        measured(keyed, repeated=F.sum(F.col("_c") - 1)),
        measured(orphan_artist_rows(fait, dim_artiste), orphans=F.sum("n_rows")),
        measured(dim_artiste.select("date").distinct()),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("date").agg(*[F.sum(m).alias(m) for m in MEASURES])


def report_of_measures(
    days: DataFrame, seuil: float = COMPLETENESS_THRESHOLD, bpm_range: tuple[float, float] = BPM_RANGE
) -> DataFrame:
    """The report rows of each snapshot from its measures; ``bpm_range`` is the one they
    were measured with."""
    rules = [
        _zero_row("unicite", F.col("repeated")),
        _completude_row("completude", F.col("n"), F.col("present"), seuil),
        _zero_row("validite_score", F.col("negative")),
        _fraicheur_row(F.col("fresh")),
        _zero_row("validite_duree", F.col("short")),
        _zero_row("validite_bpm", F.col("tempo"), bpm_range[1]),
        _zero_row("coherence", F.col("orphans")),
    ]
    return days.select("date", F.explode(F.array(*[F.struct(*r) for r in rules])).alias("_r")).select("date", "_r.*")


def quality_report_by_date(
    fait: DataFrame,
    dim_titre: DataFrame,
    dim_artiste: DataFrame,
    seuil: float = COMPLETENESS_THRESHOLD,
    bpm_range: tuple[float, float] = BPM_RANGE,
) -> DataFrame:
    """The rules of :func:`quality_report` for each snapshot alone: ``date`` and
    the report columns. A snapshot's expected date is itself, and one without
    fact rows fails as an empty fact."""
    return report_of_measures(measures_by_date(fait, dim_titre, dim_artiste, bpm_range), seuil, bpm_range)


class QualityGateError(AssertionError):
    """One or more blocking quality rules failed; ``dates`` are the snapshots they failed on,
    where snapshots were judged alone."""

    def __init__(self, message: str, dates: list[str] | None = None):
        super().__init__(message)
        self.dates = dates or []


def _said(failed: list[dict]) -> str:
    return "; ".join(
        (f"{r['date']}: " if "date" in r else "")
        + f"{r['rule']}: {r['violations']} violation(s), observed {r['observed']}"
        for r in failed
    )


def judge_by_date(report: DataFrame) -> tuple[list[dict], list[str], QualityGateError | None]:
    """(report rows, dates on which every rule passed, the error naming the
    others or None) of :func:`quality_report_by_date`: seven rows a snapshot day
    reach the driver."""
    rows = [r.asDict() for r in report.orderBy("date", "rule").collect()]
    failed = [r for r in rows if not r["passed"]]
    bad = {r["date"] for r in failed}
    good = sorted({r["date"] for r in rows} - bad)
    if not rows:
        return rows, good, QualityGateError("quality gate failed — no snapshot to judge")
    return rows, good, QualityGateError(f"quality gate failed — {_said(failed)}", sorted(bad)) if failed else None


def enforce(report: DataFrame) -> list[dict]:
    """Blocking gate: collect the (few) report rows, raise listing *all*
    failed rules, else return the rows for logging."""
    rows = [r.asDict() for r in report.collect()]
    failed = [r for r in rows if not r["passed"]]
    if failed:
        raise QualityGateError(f"quality gate failed — {_said(failed)}")
    return rows
