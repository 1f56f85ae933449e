"""Sharding by k-d tree: weighted medians along the widest metadata dimension.

A node holding ``k`` shards is split at the weighted quantile that gives its
left side ``k // 2`` of them, along the dimension with the widest range, until
every leaf is one shard; weights are the documents' bytes. Dimensions are
quantised to ``LEVELS`` levels (numbers by logarithm, categories by hash). Spark
sums the bytes of (node, dimension, level) for all nodes of a depth at once, so
the driver gets at most nodes x dimensions x LEVELS sums. Where the quantile falls
inside a level, that level is split by the hash of the text, so equal texts stay
together; a hash bin that outweighs ``TOLERANCE`` of a shard (a large group of
copies) is split by the hash of the id.

The tree is a SQL expression over the metadata. Slots number a shard's documents:
rows are dealt into buckets of about ``BUCKET_ROWS``, bucket counts are summed
up, and rows are numbered within their bucket.

Rows: a null text has 16 bytes of size like an empty one; null metadata is a
category of its own; repeated rows are documents of their own. An empty table
gives no rows; fewer documents than shards leave shards empty.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitparade.session import scratch_dir

LEVELS = 1024
BINS = 4096
TOLERANCE = 0.01
BUCKET_ROWS = 4096
#: Bytes that a document counts besides its text.
OVERHEAD = 16


def number_level(c: Column) -> Column:
    """Level of a number, by its logarithm (a 64-bit range fits)."""
    return F.least(F.lit(LEVELS - 1), F.floor(16 * F.log2(1 + F.greatest(F.coalesce(c, F.lit(0)), F.lit(0))))).cast("int")


def category_level(c: Column) -> Column:
    """Level of a category, by its hash."""
    return F.pmod(F.xxhash64(c, F.lit(1)), F.lit(LEVELS)).cast("int")


@dataclass
class Split:
    """Where a node is cut: below ``level`` goes left; on it, hash bins below ``cut``; in that
    bin, id bins below ``id_cut``."""

    dim: str
    level: int
    cut: int
    id_cut: int

    def left(self) -> Column:
        q = F.col(self.dim)
        in_bin = (F.col("_bin") == self.cut) & (F.col("_id_bin") < self.id_cut)
        return (q < self.level) | ((q == self.level) & ((F.col("_bin") < self.cut) | in_bin))


@dataclass
class Node:
    first: int
    shards: int
    split: Split | None = None
    left: Node | None = None
    right: Node | None = None

    def shard(self) -> Column:
        """The first shard of the node that a row is in."""
        if self.split is None:
            return F.lit(self.first)
        return F.when(self.split.left(), self.left.shard()).otherwise(self.right.shard())

    def leaves(self) -> list[Node]:
        return [self] if self.split is None else [*self.left.leaves(), *self.right.leaves()]


def crossing(sums: dict[int, int], target: float) -> tuple[int, int]:
    """The key at which the ordered sums reach ``target``, and the sum before it."""
    before = 0
    for k in sorted(sums):
        if before + sums[k] >= target:
            return k, before
        before += sums[k]
    return max(sums), before - sums[max(sums)]


def fit(rows: DataFrame, dims: list[str], shards: int) -> Node:
    """The tree over ``rows`` with ``size``, the dimensions' level columns, ``_bin`` and ``_id_bin``."""
    root = Node(0, shards)
    total = rows.agg(F.sum("size")).first()[0] or 0
    while total and (open_nodes := [x for x in root.leaves() if x.shards > 1]):
        at = rows.withColumn("_node", root.shard())
        at = at.where(F.col("_node").isin([x.first for x in open_nodes]))
        levels = F.explode(F.array(*[F.struct(F.lit(i).alias("dim"), F.col(d).alias("level")) for i, d in enumerate(dims)]))
        got = at.select("_node", "size", levels.alias("x")).groupBy("_node", "x.dim", "x.level").agg(F.sum("size").alias("n"))
        sums: dict[int, dict[int, dict[int, int]]] = {}
        for r in got.collect():
            sums.setdefault(r["_node"], {}).setdefault(r.dim, {})[r.level] = r.n
        cuts, wanted = {}, {}
        for x in open_nodes:
            by_dim = sums.get(x.first)
            if not by_dim:  # an empty node: its shards stay empty
                x.shards = 1
                continue
            d = max(by_dim, key=lambda i: (max(by_dim[i]) - min(by_dim[i]), -i))
            want = sum(by_dim[d].values()) * (x.shards // 2) / x.shards
            level, before = crossing(by_dim[d], want)
            cuts[x.first], wanted[x.first] = Split(dims[d], level, 0, 0), want - before
        on_level = F.lit(False)
        for first, s in cuts.items():
            on_level = on_level | ((F.col("_node") == first) & (F.col(s.dim) == s.level))
        sums2: dict[int, dict[int, int]] = {}
        for r in at.where(on_level).groupBy("_node", "_bin").agg(F.sum("size").alias("n")).collect():
            sums2.setdefault(r["_node"], {})[r["_bin"]] = r.n
        heavy = F.lit(False)
        again = {}
        for first, s in cuts.items():
            s.cut, before = crossing(sums2[first], wanted[first])
            weight, rest = sums2[first][s.cut], wanted[first] - before
            if weight > TOLERANCE * total / shards:
                again[first] = rest
                heavy = heavy | ((F.col("_node") == first) & (F.col(s.dim) == s.level) & (F.col("_bin") == s.cut))
            elif 2 * rest >= weight:
                s.cut += 1
        if again:
            sums3: dict[int, dict[int, int]] = {}
            for r in at.where(heavy).groupBy("_node", "_id_bin").agg(F.sum("size").alias("n")).collect():
                sums3.setdefault(r["_node"], {})[r["_id_bin"]] = r.n
            for first, rest in again.items():
                cut, before = crossing(sums3[first], rest)
                cuts[first].id_cut = cut + (2 * (rest - before) >= sums3[first][cut])
        for x in open_nodes:
            if x.first in cuts:
                half = x.shards // 2
                x.split = cuts[x.first]
                x.left, x.right = Node(x.first, half), Node(x.first + half, x.shards - half)
    return root


def assign(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    categories: tuple[str, ...] = ("source", "lang"),
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every document, in ``shards`` shards or as
    many as leaves of ``target_bytes`` need. Categories that the table lacks are left out."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    present = [c for c in categories if c in docs.columns]
    size = (F.octet_length(text) + OVERHEAD).cast("long")
    dims = {"_d_size": number_level(size)} | {f"_d_{i}": category_level(F.col(c)) for i, c in enumerate(present)}
    folder = scratch_dir(spark, "kd-shards")
    # the only pass over texts; everything else reads these few columns
    docs.select(
        F.col(id_col).alias("doc_id"),
        size.alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *[c.alias(n) for n, c in dims.items()],
        F.pmod(F.xxhash64(text), F.lit(BINS)).cast("int").alias("_bin"),
        F.pmod(F.xxhash64(F.col(id_col).cast("string"), text), F.lit(BINS)).cast("int").alias("_id_bin"),
        F.monotonically_increasing_id().alias("_row"),
    ).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    if shards is None:
        shards = max(1, math.ceil(total / target_bytes))
    tree = fit(rows, list(dims), shards)
    buckets = max(1, math.ceil(n / (shards * BUCKET_ROWS)))
    placed = rows.select(
        "doc_id",
        "size",
        "text_crc32",
        tree.shard().cast("int").alias("shard"),
        F.pmod(F.xxhash64("_row"), F.lit(buckets)).cast("int").alias("_bucket"),
        "_row",
    )
    counts = placed.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("shard").orderBy("_bucket")) - F.col("_n")
    placed = placed.join(counts.select("shard", "_bucket", before.alias("_before")), ["shard", "_bucket"])
    slot = F.col("_before") + F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy("_row")) - 1
    return placed.select("doc_id", "size", "text_crc32", "shard", slot.alias("slot"))
