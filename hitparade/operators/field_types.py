"""Typed parse report: which fields of landed tracks are missing, null or of a wrong type.

Parsing with a declared schema turns a wrong-typed value into null, so that it looks
missing. Here bodies are parsed as VARIANT, which keeps what landed, and each
declared field's type is looked at before any cast.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitparade import schemas

NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE")


def accepted_kinds(declared: T.DataType) -> tuple[str, ...]:
    """The kinds of JSON value that a declared type takes without a change of meaning."""
    if isinstance(declared, T.StructType):
        return ("OBJECT",)
    if isinstance(declared, T.ArrayType):
        return ("ARRAY",)
    if isinstance(declared, T.IntegerType | T.LongType):
        return ("BIGINT",)
    if isinstance(declared, T.DoubleType):
        return NUMBERS
    return (declared.simpleString().upper(),)


def fields_of(schema: T.StructType, prefix: str = "") -> Iterator[tuple[str, T.DataType]]:
    """(dotted name, declared type) of every field, nested ones after their parent."""
    for f in schema.fields:
        yield f"{prefix}{f.name}", f.dataType
        if isinstance(f.dataType, T.StructType):
            yield from fields_of(f.dataType, f"{prefix}{f.name}.")


def landed_tracks(pages: DataFrame, body_col: str = "body") -> DataFrame:
    """``date_snapshot, track``: each entry of each page's ``data`` as VARIANT. A body that is
    no JSON, or whose ``data`` is no array, has no entries (envelope and parse rejects name it)."""
    entries = F.try_variant_get(F.try_parse_json(F.col(body_col)), "$.data", "array<variant>")
    return pages.select("date_snapshot", F.explode(entries).alias("track"))


def found_kind(track: Column, field: str) -> Column:
    """The kind of value that landed in a field: ``BIGINT``, ``STRING``, ``OBJECT`` …; ``VOID`` for
    a JSON null; null where the field is absent."""
    value = F.try_variant_get(track, f"$.{field}", "variant")
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _tests(track: Column, field: str, declared: T.DataType) -> dict[str, Column]:
    kind = found_kind(track, field)
    wrong = ~kind.isin("VOID", *accepted_kinds(declared))
    if isinstance(declared, T.IntegerType):
        # a whole number too large for the declared type
        wrong = wrong | F.try_variant_get(track, f"$.{field}", "int").isNull()
    landed = kind.isNotNull() & (kind != "VOID")
    return {"n_absent": kind.isNull(), "n_null": kind == "VOID", "n_wrong_type": landed & wrong}


def field_report(pages: DataFrame, body_col: str = "body", schema: T.StructType = schemas.API_TRACK) -> DataFrame:
    """Per snapshot and declared field: ``n_tracks``, and how many tracks lack the field
    (``n_absent``), hold a JSON null (``n_null``) or a value that the declared type does not take
    (``n_wrong_type``); ``kinds`` are the kinds found, sorted.

    One partial aggregate a snapshot; the fields are laid out as rows only after it. A
    nested field is absent where its parent is; a parent of a wrong type is counted as such.
    """
    track = F.col("track")
    aggs = [F.count(F.lit(1)).alias("n_tracks")]
    lines = []
    for i, (name, declared) in enumerate(fields_of(schema)):
        tests = _tests(track, name, declared)
        aggs += [F.count_if(t).alias(f"{n}_{i}") for n, t in tests.items()]
        aggs.append(F.collect_set(found_kind(track, name)).alias(f"kinds_{i}"))
        counts = [F.col(f"{n}_{i}").alias(n) for n in tests]
        kinds = F.array_join(F.array_sort(f"kinds_{i}"), ",").alias("kinds")
        lines.append(F.struct(F.lit(name).alias("field"), F.lit(declared.simpleString()).alias("declared"), *counts, kinds))
    days = landed_tracks(pages, body_col).groupBy("date_snapshot").agg(*aggs)
    return days.select("date_snapshot", "n_tracks", F.explode(F.array(*lines)).alias("_f")).select(
        "date_snapshot", "_f.field", "_f.declared", "n_tracks", "_f.n_absent", "_f.n_null", "_f.n_wrong_type", "_f.kinds"
    )
