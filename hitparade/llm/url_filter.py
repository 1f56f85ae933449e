"""URL filters: a blocked Bloom filter before an exact hash join.

A list holds canonical prefixes ``host + path`` with a verdict. A prefix fits a
url whose host is the listed host or a subdomain and whose path starts with the
listed path; the longest fitting prefix decides. A url's candidates are its host
suffixes and path prefixes of the label counts and lengths that the list has, so
their number doesn't grow with the url. Candidates are tested in a blocked Bloom
filter (one 512-bit block a key, ``PROBES`` bits in it); the possible hits go
to a hash join with the list, which removes false positives.

The filter is built by Spark (bits of a word are or-ed in a group by) and holds
``bits_per_key`` bits a listed key, never more than ``max_bytes``: a larger list
gets fewer bits a key, so more candidates reach the join, with the same result.

Rows: a null url or one without ``://`` has an empty host and path and no rule.
Repeated rows stay as often as they occur. A prefix listed with both verdicts
is blocked. An empty list leaves the default verdict everywhere.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBES = 8
BLOCK_BITS = 512
_WORDS = BLOCK_BITS // 64


def host_of(url: str) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str) -> Column:
    """From the host's end up to ``? #`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


class BlockedBloom:
    """A filter of 64-bit key hashes as an array of words, eight a block."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @classmethod
    def build(cls, keys: DataFrame, hash_col: str, n_keys: int, bits_per_key: int = 16, max_bytes: int = 64 << 20):
        """From a table of key hashes; at most ``max_bytes`` reach the driver."""
        blocks = max(1, min(-(-n_keys * bits_per_key // BLOCK_BITS), max_bytes * 8 // BLOCK_BITS))
        h = F.col(hash_col)
        block = F.pmod(F.shiftrightunsigned(h, 32), F.lit(blocks))
        bit = F.explode(F.array(*[cls._bit(h, i) for i in range(PROBES)]))
        bits = keys.select(block.alias("block"), bit.alias("bit"))
        word = (F.col("block") * _WORDS + F.shiftright("bit", 6)).alias("word")
        # shiftleft takes a plain number of places: the 64 masks are a lookup
        masks = F.array(*[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
        mask = F.get(masks, F.col("bit").bitwiseAND(63))
        got = bits.select(word, mask.alias("m")).groupBy("word").agg(F.bit_or("m").alias("m")).toPandas()
        words = np.zeros(blocks * _WORDS, np.int64)
        words[got["word"].to_numpy(np.int64)] = got["m"].to_numpy(np.int64)
        return cls(words.view(np.uint64))

    @staticmethod
    def _bit(h: Column, i: int) -> Column:
        # double hashing in the low 32 bits, odd step
        low, step = h.bitwiseAND(0xFFFF), F.shiftright(h.bitwiseAND(0xFFFFFFFF), 16).bitwiseOR(F.lit(1).cast("long"))
        return (low + step * i).bitwiseAND(BLOCK_BITS - 1).cast("int")

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        h = hashes.view(np.uint64)
        block = ((h >> np.uint64(32)) % np.uint64(len(self.words) // _WORDS)).astype(np.int64) * _WORDS
        low = (h & np.uint64(0xFFFF)).astype(np.int64)
        step = ((h & np.uint64(0xFFFFFFFF)) >> np.uint64(16)).astype(np.int64) | 1
        held = np.ones(len(h), bool)
        for i in range(PROBES):
            bit = (low + step * i) & (BLOCK_BITS - 1)
            held &= (self.words[block + (bit >> 6)] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1
        return held


def judge(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    bits_per_key: int = 16,
    max_bytes: int = 64 << 20,
) -> DataFrame:
    """``id, url, host, path, rule, verdict`` of every page.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block). Equal
    (id, url) rows are counted before anything is exploded and given back at the
    end, so a hot url costs one row.
    """
    spark = pages.sparkSession
    listed = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block sorts after allow
    listed = listed.withColumn("key", F.concat("host", "path"))
    shape = listed.agg(
        F.count("*").alias("n"),
        F.collect_set(F.size(F.split("host", r"\."))).alias("labels"),
        F.collect_set(F.char_length("path")).alias("lengths"),
    ).first()
    pages = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    base = pages.groupBy("id", "url").agg(F.count("*").alias("copies"))
    base = base.withColumns({"host": host_of("url"), "path": path_of("url")})
    if shape.n:
        bloom = BlockedBloom.build(
            listed.select(F.xxhash64("host", "path").alias("h")), "h", shape.n, bits_per_key, max_bytes
        )
        held = spark.sparkContext.broadcast(bloom)

        @F.pandas_udf("boolean")
        def may_hold(h: pd.Series) -> pd.Series:
            return pd.Series(held.value.may_hold(h.to_numpy(np.int64)))

        parts, n = F.split("host", r"\."), F.size(F.split("host", r"\."))
        hosts = F.array(
            *[
                F.when(n >= k, F.array_join(F.slice(parts, F.greatest(n - k + 1, F.lit(1)), F.lit(k)), "."))
                for k in sorted(shape.labels)
            ]
        )
        starts = F.array(
            *[F.when(F.char_length("path") >= k, F.substring("path", 1, k)) for k in sorted(shape.lengths)]
        )
        cand = base.where(F.col("host") != "").select("id", "url", F.explode(hosts).alias("host"), "path")
        cand = cand.where(F.col("host").isNotNull()).select("id", "url", "host", F.explode(starts).alias("path"))
        cand = cand.where(F.col("path").isNotNull()).where(may_hold(F.xxhash64("host", "path")))
        hits = cand.join(listed, ["host", "path"]).select(
            "id", "url", F.struct(F.char_length("key").alias("n"), F.col("key"), F.col("verdict")).alias("best")
        )
    else:
        hits = base.limit(0).select(
            "id", "url", F.lit(None).cast("struct<n:int,key:string,verdict:string>").alias("best")
        )
    none = F.lit(None).cast("struct<n:int,key:string,verdict:string>").alias("best")
    rows = base.select("id", "url", "copies", none).unionByName(
        hits.withColumn("copies", F.lit(None).cast("long"))
    )
    out = rows.groupBy("id", "url").agg(F.max("copies").alias("copies"), F.max("best").alias("best"))
    out = out.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.select(
        F.col("id").alias(id_col),
        F.col("url").alias(url_col),
        host_of("url").alias("host"),
        path_of("url").alias("path"),
        F.col("best.key").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
