"""Lake writers: date-partitioned Parquet with explicit overwrite semantics.

Modes:

* ``"dates"`` — replace only the ``date=`` partitions present in the output
  (dynamic partition overwrite): rerunning one snapshot keeps the history;
* ``"full"`` — full refresh: the destination is replaced as a whole;
* ``"append"`` — add files, keep everything.

Partitioned writes go through an AQE ``REBALANCE`` on the partition column:
rows of one date are gathered, a date larger than the advisory partition size
is split, small ones are coalesced — so a backfill writes a few right-sized
files per date instead of one file per (task, date), and a date holding a
third of the rows is still written by many tasks.

Spark's commit protocol replaces the old files itself, so no leftover part
files from an earlier run are ever merged into a later read. Row counts are
taken with an ``Observation`` during the write — no second pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hitparade.operators.star import Star

MODES = ("dates", "full", "append")


def spread_by_date(df: DataFrame, files_per_date: int, key: Sequence[str] | None = None) -> DataFrame:
    """Repartition a multi-date output so each date lands in at most
    ``files_per_date`` files and a date holding a third of the rows is still
    split over ``files_per_date`` tasks (salted by a hash of ``key``)."""
    cols = [F.col(c) for c in (key or [c for c in df.columns if c != "date"])]
    salt: Column = F.pmod(F.xxhash64(*cols), F.lit(files_per_date))
    return df.repartition(F.col("date"), salt)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "dates",
    partition_by: Sequence[str] = ("date",),
    fmt: str = "parquet",
    max_records_per_file: int | None = None,
    rebalance: bool = True,
) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    w = df.write.format(fmt)
    if mode == "dates":
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == "full":
        w = w.mode("overwrite").option("partitionOverwriteMode", "static")
    else:
        w = w.mode("append")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def counted_write(df: DataFrame, path: str, name: str, **kwargs) -> int:
    """Write and return the number of rows written (observed in the write).

    The observation sits after the rebalance shuffle, in the write's result
    stage, where Spark applies each task's metric update exactly once even
    when tasks or map stages are retried.
    """
    partition_by = kwargs.get("partition_by", ("date",))
    if kwargs.pop("rebalance", True) and partition_by:
        df = df.hint("rebalance", *partition_by)
    obs = Observation(f"rows_{name}")
    write_table(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, rebalance=False, **kwargs)
    return int(obs.get["rows"])


def run_concurrently(spark: SparkSession, jobs: dict[str, Callable[[], int]], max_workers: int = 4) -> dict[str, int]:
    """Run independent Spark actions as concurrent jobs (one driver thread
    each, with the caller's job group, pool and tags) so they share the
    executors instead of queueing; results by name. The first failure is
    re-raised after all jobs have finished."""
    if len(jobs) <= 1:
        return {k: f() for k, f in jobs.items()}
    with ThreadPoolExecutor(max_workers=min(max_workers, len(jobs))) as pool:
        futures = {k: pool.submit(inheritable_thread_target(spark)(f)) for k, f in jobs.items()}
        return {k: fut.result() for k, fut in futures.items()}


def publish_star(
    star: Star,
    root: str,
    mode: str = "dates",
    files_per_date: int | None = None,
    concurrent: bool = True,
    laid_out: Iterable[str] = (),
) -> dict[str, int]:
    """Write the four curated tables under ``root/<table>/date=...`` (four
    independent jobs, submitted together); return the rows written per table.
    ``laid_out`` names tables read row by row from well-sized ``date=`` folders:
    a task has few dates of them, so they are written without a shuffle."""
    laid_out = set(laid_out)

    def job(name: str, df: DataFrame) -> Callable[[], int]:
        out = spread_by_date(df, files_per_date) if files_per_date else df
        return lambda: counted_write(out, f"{root.rstrip('/')}/{name}", name, mode=mode, rebalance=name not in laid_out)

    jobs = {name: job(name, df) for name, df in star.tables().items()}
    return run_concurrently(star.fait_popularite.sparkSession, jobs) if concurrent else {k: f() for k, f in jobs.items()}


def write_report(report: DataFrame, root: str, name: str, snapshot_date: str | None = None) -> str:
    """Persist a report result at ``root/report=<name>/[date=<d>/]`` (replaced
    on rerun) and return the folder. Adaptive execution gathers a small report's
    partitions into one file, in their order; a large one keeps several."""
    path = f"{root.rstrip('/')}/report={name}"
    if snapshot_date is not None:
        path += f"/date={snapshot_date}"
    report.write.mode("overwrite").parquet(path)
    return path
