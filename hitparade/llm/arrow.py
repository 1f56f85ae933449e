"""Arrow plumbing shared by the operators that run numpy inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Text bytes one call of an operator's kernel sees at most (a single longer text is still whole).
SLICE_BYTES = 1 << 20


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row slices of ``batch`` holding about ``max_bytes`` of ``column`` each."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype("int64")
    part = (size.cumsum() - size) // max_bytes
    start = 0
    for i in range(1, batch.num_rows + 1):
        if i == batch.num_rows or part[i] != part[start]:
            yield batch.slice(start, i - start)
            start = i


def release_memory() -> None:
    """Hands memory that a finished task left unused back to the system: workers are reused, and
    what one stage once needed would stay with the next ones."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def append_columns(
    docs: DataFrame,
    text_col: str,
    make_kernel: Callable[[], Callable[[list], list]],
    fields: list[T.StructField],
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with ``fields`` computed from the text column, one Arrow pass, no shuffle.

    ``make_kernel()`` runs once a task and returns ``kernel(texts) -> [arrow array per field]``;
    a kernel call sees one slice of bounded size. An input column with the name
    of a new field (the text column too) is replaced by it.
    """
    new = [f.name for f in fields]
    base = docs.drop(*[c for c in docs.columns if c in new and c != text_col])
    kept = [f for f in base.schema.fields if (keep_text or f.name != text_col) and f.name not in new]
    names = [f.name for f in kept]
    out = T.StructType([*kept, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = make_kernel()
        try:
            for batch in batches:
                for part in slices(batch, text_col):
                    made = kernel(part.column(text_col).to_pylist())
                    yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *made], names=[*names, *new])
        finally:
            del kernel
            release_memory()

    return base.mapInArrow(run, out)
