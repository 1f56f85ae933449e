"""Small column builders. Each returns a ``Column``; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hitparade.constants import DATE_PARTITION_PATTERN


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def month_snapshot(ts: Column | str) -> Column:
    """First day of the month of a timestamp/date, as ``yyyy-MM-dd`` STRING."""
    return F.trunc(F.to_date(_c(ts)), "month").cast("string")


def present(col: Column | str) -> Column:
    """Non-null and, for floating columns, not NaN (pandas ``notna``)."""
    c = _c(col)
    return c.isNotNull() & ~F.isnan(c)


def out_of_range(col: Column | str, low: float | None, high: float | None) -> Column:
    """True when a *present* value lies outside ``[low, high]``.

    Null and NaN are not violations (the rule only judges present values).
    """
    c = _c(col)
    cond = F.lit(False)
    if low is not None:
        cond = cond | (c < F.lit(low))
    if high is not None:
        cond = cond | (c > F.lit(high))
    return present(c) & cond


def has_json_key(body: Column | str, key: str) -> Column:
    """True when a JSON text is an object that *has* ``key`` (even if null).

    ``json_object_keys`` is null for arrays, scalars and malformed text, which
    count as "no such key".
    """
    return F.coalesce(F.array_contains(F.json_object_keys(_c(body)), F.lit(key)), F.lit(False))


def path_snapshot_date(path: Column | str) -> Column:
    """Snapshot date taken from the first ``date=YYYY-MM-DD`` segment of a path.

    Empty string when the path has no such segment.
    """
    return F.regexp_extract(_c(path), DATE_PARTITION_PATTERN, 1)


def validated_date(date_str: Column | str, what: str = "snapshot date") -> Column:
    """The string unchanged when it is a real calendar date, else a task error.

    ``date=2026-99-99`` matches the path pattern but is no date; failing here
    gives a clear message instead of an ANSI cast error later.
    """
    s = _c(date_str)
    return F.when(F.try_to_date(s).isNotNull(), s).otherwise(
        F.raise_error(F.concat(F.lit(f"invalid {what}: '"), F.coalesce(s, F.lit("null")), F.lit("'")))
    )


def calendar_parts(date: Column | str) -> list[Column]:
    """Day of month, ISO week, month and quarter of a DATE column."""
    d = _c(date)
    return [
        F.dayofmonth(d).alias("jour"),
        F.weekofyear(d).alias("semaine"),
        F.month(d).alias("mois"),
        F.quarter(d).alias("trimestre"),
    ]
