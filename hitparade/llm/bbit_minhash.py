"""Near-duplicate detection with b-bit MinHash.

A text is the set of its 5-word shingles (A-Z lower-cased, words separated by ASCII white
space; fewer words, but not none, are one shingle). Texts whose sets have a Jaccard similarity of
``NUMERATOR / DENOMINATOR`` (0.85) or more are linked; components of links are the result.

1. Texts of equal words are one class. A class has ``BANDS`` x ``ROWS`` minima; each band's minima
   hash to a band key, and of each minimum only the low ``BITS`` bits are kept, packed
   into 64-bit words.
2. Classes that share a band key meet. In each such bucket every class is compared with
   the bucket's least class, so that a bucket costs rows in proportion: the packed
   signatures are XORed, agreeing values counted by bit counts, and the estimate corrected
   for the ``2 ** -BITS`` of chance agreement. Pairs not under the threshold by more than five
   deviations are compared exactly, by their full shingle sets.
3. What the least classes did not connect: buckets whose classes are still in several components
   have their classes of different components compared by signatures, in pairs of blocks of ``BLOCK``
   classes; classes of the largest component only meet the others. A task emits a chain of
   the similar ones, never all pairs.
4. The classes so chained meet by their full sets, in pairs of blocks of about ``BLOCK_BYTES``;
   here too, only pairs of different components are compared.

A pair at the threshold shares some band with probability 1 - (1 - 0.85^ROWS)^BANDS, which is
over 0.9999997, and is then kept by the estimate as surely; every link is confirmed on the full
sets. Nothing is capped: all pairs of a bucket that could still join components are looked at.

Rows: a text without words (null, empty, white space) has an empty set, links with
nothing and is its own component. Null ids take part; a component of null ids only has a
null id. Rows of equal id are documents of their own; repeated rows are copies. Ties go to
the least id. Texts are whole whatever their length. Other columns are ignored, whatever
their names. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitparade.llm.arrow import append_columns
from hitparade.llm.components import components
from hitparade.llm.hashing import mix, shingles
from hitparade.session import scratch_dir

WIDTH = 5
# the threshold as a fraction, so that comparing is exact
NUMERATOR, DENOMINATOR = 85, 100
BANDS, ROWS = 32, 6
VALUES = BANDS * ROWS
#: Bits kept of each minimum (a divisor of 64).
BITS = 4
#: Classes of one side of a signature comparison, and bytes of one side of an exact one.
BLOCK = 512
BLOCK_BYTES = 8 << 20

_CHANCE = 2.0**-BITS
_WORDS = VALUES * BITS // 64
# the lowest bit of each packed value
_LOWEST = sum(1 << i for i in range(0, 64, BITS))
_SEEDS = mix(np.arange(1, 2 * VALUES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_MULTIPLY = (_SEEDS[:VALUES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_ADD = (_SEEDS[VALUES:] >> np.uint64(32)).astype(np.uint32)


def estimate(agreeing: float) -> float:
    """The similarity that so many agreeing values tell, corrected for chance agreement."""
    return (agreeing / VALUES - _CHANCE) / (1 - _CHANCE)


def least_agreeing(deviations: float = 5.0) -> int:
    """The fewest agreeing values with which a pair may still reach the threshold."""
    t = NUMERATOR / DENOMINATOR
    p = t + (1 - t) * _CHANCE
    return int(np.floor(VALUES * p - deviations * np.sqrt(VALUES * p * (1 - p))))


AGREE = least_agreeing()


def normal(text: str | None) -> bytes:
    """The words of a text, space-joined (``bytes`` methods know ASCII letters and white space only)."""
    return b" ".join(text.encode().lower().split()) if text else b""


def minima(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(MinHash values by text, distinct shingles of each)``; no shingles give zeros."""
    out = np.zeros((len(texts), VALUES), np.uint32)
    count = np.zeros(len(texts), np.int64)
    g, at = shingles(texts, WIDTH)
    full = np.flatnonzero(np.diff(at))
    first = 0
    while first < len(full):
        # some texts at a time, so that their hashes stay in the processor's cache
        last = int(np.searchsorted(at[full], at[full[first]] + (1 << 15), side="left"))
        mine = full[first : max(last, first + 1)]
        part = g[at[mine[0]] : at[mine[-1] + 1]]
        cuts = at[mine] - at[mine[0]]
        text = np.repeat(np.arange(len(mine)), np.diff(np.append(cuts, len(part))))
        order = np.lexsort((part, text))
        part, text = part[order], text[order]
        fresh = np.ones(len(part), bool)
        fresh[1:] = (part[1:] != part[:-1]) | (text[1:] != text[:-1])
        count[mine] = np.add.reduceat(fresh, cuts)
        h = (part[fresh] >> np.uint64(32)).astype(np.uint32)
        cuts = np.concatenate([[0], np.cumsum(count[mine])[:-1]])
        for i in range(VALUES):
            out[mine, i] = np.minimum.reduceat(h * _MULTIPLY[i] + _ADD[i], cuts)
        first += len(mine)
    return out, count


def pack(values: np.ndarray) -> np.ndarray:
    """The low ``BITS`` bits of the minima, packed into signed 64-bit words."""
    low = (values & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(len(values), _WORDS, 64 // BITS)
    shift = np.arange(0, 64, BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(low << shift, axis=2).view(np.int64)


def band_keys(values: np.ndarray) -> np.ndarray:
    """A signed 64-bit hash of each band's minima and its number."""
    bands = values.astype(np.uint64).reshape(len(values), BANDS, ROWS)
    h = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), bands.shape[:2]).copy()
    for r in range(ROWS):
        h = mix(h ^ (bands[:, :, r] + np.uint64(0x9E3779B97F4A7C15)))
    return h.view(np.int64)


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many values agree, of packed signatures row by row."""
    x = (a ^ b).view(np.uint64)
    step = 1
    while step < BITS:
        x = x | (x >> np.uint64(step))
        step *= 2
    return VALUES - np.bitwise_count(x & np.uint64(_LOWEST)).sum(axis=1, dtype=np.int64)


def agreeing_column(a: str, b: str) -> Column:
    """``agreeing`` of two signature columns, as an SQL expression."""

    def differ(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        step = 1
        while step < BITS:
            z = z.bitwiseOR(F.shiftrightunsigned(z, step))
            step *= 2
        return F.bit_count(z.bitwiseAND(F.lit(_LOWEST)))

    return F.lit(VALUES) - F.aggregate(F.zip_with(a, b, differ), F.lit(0), lambda total, n: total + n)


def _key(norm: bytes) -> bytes:
    return hashlib.blake2b(norm, digest_size=16).digest()


def _lists(rows: np.ndarray) -> pa.Array:
    flat = pa.array(rows.reshape(-1), pa.int64())
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1]), pa.int32()), flat)


def _sign_kernel():
    def run(texts):
        norm = [normal(t) for t in texts]
        values, n = minima(norm)
        keys = pa.array([_key(x) for x in norm], pa.binary())
        return [keys, pa.array(n, pa.int64()), _lists(pack(values)), _lists(band_keys(values))]

    return run


_LONGS = T.ArrayType(T.LongType())
_SIGNED = [
    T.StructField("key", T.BinaryType()),
    T.StructField("n_shingles", T.LongType()),
    T.StructField("sig", _LONGS),
    T.StructField("bands", _LONGS),
]


def _set_kernel():
    """The class key and the sorted distinct shingle hashes of each text."""

    def run(texts):
        norm = [normal(t) for t in texts]
        g, at = shingles(norm, WIDTH)
        sets = [np.unique(g[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
        return [pa.array([_key(x) for x in norm], pa.binary()), pa.array(sets, pa.binary())]

    return run


_SETS = [T.StructField("made", T.BinaryType()), T.StructField("shingles", T.BinaryType())]


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are similar enough, exactly."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if DENOMINATOR * len(small) < NUMERATOR * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    common = int((large[at] == small).sum()) if len(large) else 0
    return DENOMINATOR * common >= NUMERATOR * (len(a) + len(b) - common) > 0


_LINKS = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])


def _link_batch(a: list[bytes], b: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose sets are similar enough."""
    for batch in batches:
        a, b, x, y = (batch.column(c) for c in ("a", "b", "x", "y"))
        good = []
        for i in range(batch.num_rows):
            sets = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (x, y))
            if similar(*sets):
                good.append(i)
        take = pa.array(good, pa.int64())
        yield pa.RecordBatch.from_arrays([a.take(take), b.take(take)], names=["a", "b"])


class _Groups:
    """Union-find over a few items."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def _chains(t: pa.Table) -> pa.RecordBatch:
    """Chains of similar classes of different components in buckets laid out one after the other."""
    gid = t.column("gid").to_numpy()
    keys = t.column("key").to_pylist()
    names: dict[bytes, int] = {}
    label = np.array([names.setdefault(x, len(names)) for x in t.column("label").to_pylist()])
    block = t.column("block").to_numpy()
    inside = (t.column("i").to_numpy() == t.column("j").to_numpy())
    pivot = t.column("pivot").to_numpy(zero_copy_only=False)
    sig = t.column("sig").combine_chunks()
    sig = sig.values.to_numpy().reshape(-1, _WORDS)
    sets = _Groups(len(keys))
    here, shift = np.flatnonzero(~pivot), 1
    while True:
        here = here[here + shift < len(gid)]
        here = here[gid[here] == gid[here + shift]]
        if not len(here):
            break
        other = here + shift
        want = here[(label[here] != label[other]) & ~pivot[other] & (inside[here] | (block[here] != block[other]))]
        for k in range(0, len(want), 1 << 14):
            some = want[k : k + (1 << 14)]
            for x in some[agreeing(sig[some], sig[some + shift]) >= AGREE].tolist():
                sets.join(x, x + shift)
        shift += 1
    # to the least class of each chain, which is often the same one in other buckets
    made = [(i, r) for i in range(len(keys)) if (r := sets.root(i)) != i]
    return _link_batch([keys[i] for i, _ in made], [keys[r] for _, r in made])


def _chain_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_chains`` over rows that come sorted by bucket; a bucket cut by a batch is held over."""
    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = t if held is None else pa.concat_tables([held, t])
        if not t.num_rows:
            continue
        gid = t.column("gid").to_numpy()
        cut = int(np.flatnonzero(np.concatenate([[True], gid[1:] != gid[:-1]]))[-1])
        if cut:
            yield _chains(t.slice(0, cut))
        held = t.slice(cut)
    if held is not None and held.num_rows:
        yield _chains(held)


def _in_block_pairs(rows: DataFrame, group: str, weight: Column, size: int) -> DataFrame:
    """``rows`` of groups of several components (column ``label``), once for each pair of blocks
    (``i`` <= ``j``) in which classes of different components meet; ``block`` is a row's own.

    A block has about ``size`` of ``weight``. A group's heaviest component has blocks of
    its own, which meet the others' blocks only.
    """
    parts = rows.groupBy(group, "label").agg(F.sum(weight).alias("w"))
    whole = parts.groupBy(group).agg(
        F.max(F.struct("w", "label")).alias("main"), F.sum("w").alias("total"), F.count("*").alias("labels")
    )
    blocks = lambda w: F.ceil(w / size).cast("int")
    whole = whole.where("labels > 1").select(
        F.col(group).alias("_group"),
        F.col("main.label").alias("_main"),
        blocks(F.col("total") - F.col("main.w")).alias("_others"),
        blocks(F.col("main.w")).alias("_mains"),
    )
    met = rows.join(whole.hint("shuffle_hash"), F.col(group) == F.col("_group"))
    is_main = F.col("label") == F.col("_main")
    hashed = F.xxhash64("key")
    block = F.when(is_main, F.col("_others") + F.pmod(hashed, F.col("_mains"))).otherwise(F.pmod(hashed, F.col("_others")))
    last = F.when(is_main, F.col("_others")).otherwise(F.col("_others") + F.col("_mains")) - 1
    met = met.withColumn("block", block.cast("int")).withColumn("_o", F.explode(F.sequence(F.lit(0), last)))
    return met.withColumns({"i": F.least("block", "_o"), "j": F.greatest("block", "_o")}).drop("_group", "_main", "_others", "_mains", "_o")


def _compare(part: pd.DataFrame) -> pd.DataFrame:
    """Links that join components, between the classes of one block, or of one block and another."""
    part = part.drop_duplicates("key").sort_values("key", ignore_index=True)
    keys, block = part["key"].tolist(), part["block"].to_numpy()
    inside = part["i"].iloc[0] == part["j"].iloc[0]
    names: dict[bytes, int] = {}
    label = np.array([names.setdefault(x, len(names)) for x in part["label"]])
    sets = [np.frombuffer(x, np.uint64) for x in part["shingles"]]
    sig = np.stack(part["sig"].to_numpy()).astype(np.int64)
    n = np.array([len(s) for s in sets])
    groups = _Groups(len(names))
    a, b = [], []
    for x in range(len(keys) - 1):
        later = np.arange(x + 1, len(keys))
        ok = (label[later] != label[x]) & (inside | (block[later] != block[x]))
        ok &= DENOMINATOR * np.minimum(n[later], n[x]) >= NUMERATOR * np.maximum(n[later], n[x])
        later = later[ok]
        later = later[agreeing(sig[later], np.broadcast_to(sig[x], (len(later), _WORDS))) >= AGREE]
        for y in later.tolist():
            if groups.root(label[x]) != groups.root(label[y]) and similar(sets[x], sets[y]):
                groups.join(label[x], label[y])
                a.append(keys[x])
                b.append(keys[y])
    return pd.DataFrame({"a": a, "b": b})


def _labelled(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with the component ``label`` of their ``key`` (the key itself where it has no link)."""
    known = groups.select(F.col("node").alias("_node"), "label").hint("shuffle_hash")
    out = rows.join(known, F.col("key") == F.col("_node"), "left")
    return out.withColumn("label", F.coalesce("label", "key")).drop("_node")


def _fewer(chains: DataFrame) -> DataFrame:
    """Links with the same components as ``chains`` (``b`` the least class of a bucket's chain): each class to
    the least of its ``b``, which the others of them, shared by many classes, are linked to. A
    class has one ``b`` a bucket and pair of blocks, so none of the gathered sets is large."""
    by_class = chains.groupBy("a").agg(F.array_sort(F.collect_set("b")).alias("bs"))
    least = F.get("bs", 0)
    link = lambda x: F.struct(x.alias("a"), least.alias("b"))
    made = F.concat(F.array(link(F.col("a"))), F.transform(F.slice("bs", 2, F.size("bs")), link))
    return by_class.select(F.explode(made).alias("x")).select("x.a", "x.b").distinct()


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "bbit-minhash")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    signed = written(append_columns(plain, "text", _sign_kernel, _SIGNED, keep_text=False), "signed")
    # the key comes from the text, so any row of a class has its signature
    classes = signed.where("n_shingles > 0").groupBy("key").agg(
        F.min("doc_id").alias("rep"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("sig").alias("sig"),
        F.first("bands").alias("bands"),
    )
    classes = written(classes, "classes")
    signature = classes.select(F.col("key").alias("_key"), "sig", "n_shingles")

    def shingle_sets(keys: DataFrame) -> DataFrame:
        """``key, shingles`` of the classes ``keys``."""
        wanted = keys.join(classes.select("key", "rep").hint("shuffle_hash"), "key").hint("shuffle_hash")
        texts = plain.join(wanted, F.col("doc_id").eqNullSafe(F.col("rep"))).select("key", "text")
        made = append_columns(texts, "text", _set_kernel, _SETS, keep_text=False)
        # ids can occur with several texts: only the text of the class counts
        return made.where("key = made").select("key", "shingles")

    # every class and the least class of each of its buckets
    rows = classes.select("key", F.explode("bands").alias("band"))
    buckets = rows.groupBy("band").agg(F.min("key").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    buckets = written(buckets, "buckets").hint("shuffle_hash")
    met = written(rows.join(buckets, "band"), "met")
    star = met.where("key <> least").select(F.col("key").alias("a"), F.col("least").alias("b")).distinct()
    for side, sig in (("a", "sig_a"), ("b", "sig_b")):
        mine = signature.withColumnsRenamed({"_key": side, "sig": sig, "n_shingles": f"n_{side}"}).hint("shuffle_hash")
        star = star.join(mine, side)
    near = DENOMINATOR * F.least("n_a", "n_b") >= NUMERATOR * F.greatest("n_a", "n_b")
    star = written(star.where(near & (agreeing_column("sig_a", "sig_b") >= AGREE)).select("a", "b"), "star")
    sets = written(shingle_sets(star.select(F.explode(F.array("a", "b")).alias("key")).distinct()), "star-sets")
    sides = [sets.select(F.col("key").alias(k), F.col("shingles").alias(v)).hint("shuffle_hash") for k, v in ("ax", "by")]
    verified = star.join(sides[0], "a").join(sides[1], "b").select("a", "b", "x", "y").mapInArrow(_verified, _LINKS)
    links = written(verified, "star-links")
    first = components(links, f"{folder}/star-groups")

    # classes of one bucket in several components
    split = _in_block_pairs(_labelled(met, first), "band", F.lit(1), block)
    split = split.withColumn("pivot", F.col("key") == F.col("least"))
    split = split.join(signature.hint("shuffle_hash"), F.col("key") == F.col("_key"))
    split = split.select(F.xxhash64("band", "i", "j").alias("gid"), "key", "label", "block", "i", "j", "pivot", "sig")
    dealt = split.repartition("gid").sortWithinPartitions("gid", "key")
    chains = written(_fewer(dealt.mapInArrow(_chain_batches, _LINKS)), "chains")
    chained = components(chains, f"{folder}/chain-groups")

    members = _labelled(chained.select(F.col("node").alias("key"), F.col("label").alias("chain")), first)
    members = written(members.join(signature.hint("shuffle_hash"), F.col("key") == F.col("_key")).drop("_key"), "members")
    pairs = _in_block_pairs(members, "chain", 8 * F.col("n_shingles"), block_bytes)
    chain_sets = written(shingle_sets(members.select("key")), "chain-sets")
    pairs = pairs.join(chain_sets.hint("shuffle_hash"), "key")
    pairs = pairs.select("chain", "key", "label", "sig", "shingles", "block", "i", "j")
    more = written(pairs.groupBy("chain", "i", "j").applyInPandas(_compare, _LINKS), "chain-links")

    groups = components(links.unionByName(more), f"{folder}/groups")
    placed = written(_labelled(classes.select("key", "rep"), groups), "placed")
    least = placed.groupBy("label").agg(F.min("rep").alias("component_id")).hint("shuffle_hash")
    placed = placed.join(least, "label").select("key", "component_id").hint("shuffle_hash")
    out = signed.select("doc_id", "key", "n_shingles").join(placed, "key", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
