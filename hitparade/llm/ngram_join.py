"""N-gram Jaccard join: MinHash LSH forest, then exact verification.

Texts are sets of word 5-grams (a text of fewer words, but not none, is one
shingle); two texts are linked where the sets' Jaccard similarity is 0.8 or more.

1. Texts of equal words make one class (copies are never compared). A class has
   a MinHash signature of ``TREES`` x ``DEPTH`` values: in each tree of the forest
   its path is ``DEPTH`` values long.
2. Classes that share a path prefix meet. The prefix is shortened from the whole
   path until the forest's recall at the threshold, 1 - (1 - t^d)^TREES, reaches
   ``RECALL``. A prefix held by more than ``BUCKET`` classes is taken one value
   longer, and one class of each longer prefix stays in the shorter one, so a
   large group of near copies costs rows in proportion; classes that share a
   whole path and are still too many meet in ``BUCKET`` at a time and through
   one class of each part. That joins most of a large group cheaply; classes of
   such a prefix that it left in different components meet in a second pass, every
   block of them with every other one, so no two classes of a prefix are passed over.
3. In a bucket, classes whose signatures agree like similar texts are joined; the
   components of these joins (Spark joins, no collection) are the candidates.
4. Every two classes of a candidate component are compared exactly, by their
   shingle sets, in blocks of ``BLOCK`` classes: a task gets two blocks, never more.
   Shingles are 64-bit hashes; counts of common ones are exact.

Result per document: ``class_id``, the least id in its group of links (connected
by links and copies); ``copy_id``, the least id of its copies; ``n_links``, how many
other documents it is linked with, copies included. Links between different texts
are counted, not listed, so no row count grows with the square of a group.

Rows: a text without words (null, empty, only separators) has no links; its
class is itself. Null ids take part; a group of null ids only has a null class.
Rows of equal id are documents of their own. Ties go to the least id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitparade.llm.arrow import append_columns
from hitparade.llm.components import components
from hitparade.llm.hashing import mix, shingles, words_of
from hitparade.session import scratch_dir

WIDTH = 5
# the threshold as a fraction, so that comparing is exact
NUMERATOR, DENOMINATOR = 4, 5
TREES, DEPTH = 16, 8
RECALL = 0.995
#: Classes that one bucket, and one block of the exact comparison, hold.
BUCKET = 512
BLOCK = 256
#: Signature agreement (of TREES x DEPTH values) from which classes are candidates: 3.5 deviations under the threshold.
AGREE = 86

_VALUES = TREES * DEPTH
_SEEDS = mix(np.arange(1, 2 * _VALUES + 1, dtype=np.uint64))
_MULTIPLY = (_SEEDS[:_VALUES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_ADD = (_SEEDS[_VALUES:] >> np.uint64(32)).astype(np.uint32)


def prefix_depth(recall: float = RECALL) -> int:
    """The longest prefix at which the forest still has the recall at the threshold."""
    t = NUMERATOR / DENOMINATOR
    return max(d for d in range(1, DEPTH + 1) if d == 1 or 1 - (1 - t**d) ** TREES >= recall)


def normal(text: str | None) -> bytes:
    """The words of a text, space-joined."""
    return b" ".join(words_of(text))


def signatures(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(MinHash values by text, shingle count)``; no shingles give zeros."""
    out = np.zeros((len(texts), _VALUES), np.uint32)
    g, at = shingles(texts, WIDTH)
    n = np.diff(at)
    full = np.flatnonzero(n)
    if len(full):
        h = (g >> np.uint64(32)).astype(np.uint32)
        # some texts at a time, so that their hashes stay in the processor's cache
        first = 0
        while first < len(full):
            last = int(np.searchsorted(at[full], at[full[first]] + (1 << 15), side="left"))
            mine = full[first : max(last, first + 1)]
            begin = at[mine[0]]
            part = h[begin : at[mine[-1] + 1]]
            cuts = at[mine] - begin
            for i in range(_VALUES):
                out[mine, i] = np.minimum.reduceat(part * _MULTIPLY[i] + _ADD[i], cuts)
            first += len(mine)
    return out, n


def _sign_kernel():
    def run(texts):
        norm = [normal(t) for t in texts]
        values, n = signatures(norm)
        keys = [hashlib.blake2b(x, digest_size=16).digest() for x in norm]
        paths = np.ascontiguousarray((values >> np.uint32(8)).astype("<u2"))
        low = np.ascontiguousarray(values.astype(np.uint8))
        return [
            pa.array(keys, pa.binary()),
            pa.array(n, pa.int64()),
            pa.array([x.tobytes() for x in paths], pa.binary()),
            pa.array([x.tobytes() for x in low], pa.binary()),
        ]

    return run


_SIGNED = [
    T.StructField("key", T.BinaryType()),
    T.StructField("n_shingles", T.LongType()),
    T.StructField("paths", T.BinaryType()),
    T.StructField("sig", T.BinaryType()),
]


class _Sets:
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


def _bucket_links(gid: np.ndarray, keys: list[bytes], sig: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Links (to the first class of its part) of similar classes in buckets laid out one after the other.
    Rows of one key are not compared."""
    names: dict[bytes, int] = {}
    code = np.array([names.setdefault(k, len(names)) for k in keys], np.int64)
    sets = _Sets(len(names))
    shift = 1
    here = np.arange(len(gid))
    while True:
        here = here[here + shift < len(gid)]
        here = here[gid[here] == gid[here + shift]]
        if not len(here):
            break
        for i in range(0, len(here), 1 << 14):
            some = here[i : i + (1 << 14)]
            some = some[code[some] != code[some + shift]]
            agree = (sig[some] == sig[some + shift]).sum(axis=1)
            alike = some[agree >= AGREE]
            for x in np.unique(code[alike] * len(names) + code[alike + shift]).tolist():
                sets.join(x // len(names), x % len(names))
        shift += 1
    a, b = [], []
    listed = list(names)
    for i, key in enumerate(listed):
        r = sets.root(i)
        if r != i:
            a.append(key)
            b.append(listed[r])
    return a, b


_LINKS = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of buckets; rows come sorted by bucket, a bucket cut by a batch is held over."""

    def links(t: pa.Table) -> pa.RecordBatch:
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint8).reshape(-1, _VALUES)
        a, b = _bucket_links(t.column("gid").to_numpy(), t.column("key").to_pylist(), sig)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = t if held is None else pa.concat_tables([held, t])
        if not t.num_rows:
            continue
        gid = t.column("gid").to_numpy()
        cut = int(np.flatnonzero(np.concatenate([[True], gid[1:] != gid[:-1]]))[-1])
        if cut:
            yield links(t.slice(0, cut))
        held = t.slice(cut)
    if held is not None and held.num_rows:
        yield links(held)


def _buckets(classes: DataFrame, folder: str, bucket: int) -> DataFrame:
    """``(gid, key)``: which classes meet; no bucket holds more than ``bucket`` of them.
    What a larger prefix leaves apart is met in :func:`_rest`."""
    spark = classes.sparkSession
    base = prefix_depth()
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    rows = classes.select("key", "paths", tree).select(
        "key", "tree", F.substring("paths", F.col("tree") * 2 * DEPTH + 1, F.lit(2 * DEPTH)).alias("path")
    )
    made = []
    for depth in range(base, DEPTH + 1):
        here = rows.withColumn("gid", F.xxhash64("tree", F.substring("path", 1, 2 * depth), F.lit(depth)))
        here.groupBy("gid").agg(F.count("*").alias("n")).where("n > 1").write.parquet(f"{folder}/sizes-{depth}")
        size = spark.read.parquet(f"{folder}/sizes-{depth}")
        # the sizes grow with the classes: both sides are shuffled, whatever their size (and a
        # table on either side lets a prefix held by very many be split)
        here.join(size.hint("shuffle_hash"), "gid").write.parquet(f"{folder}/depth-{depth}")
        here = spark.read.parquet(f"{folder}/depth-{depth}")
        made.append(here.where(F.col("n") <= bucket).select("gid", "key"))
        large = here.where(F.col("n") > bucket)
        if large.isEmpty():
            break
        # parts of a prefix: the prefixes one longer, or hashed shares of a whole path
        if depth < DEPTH:
            part = F.substring("path", 1, 2 * depth + 2)
        else:
            part = F.pmod(F.xxhash64("key"), F.ceil(F.col("n") / bucket) * 2).cast("string").cast("binary")
        parts = large.withColumn("part", part)
        first = parts.groupBy("gid", "part").agg(F.min("key").alias("key"))
        if depth == DEPTH:
            made.append(parts.select(F.xxhash64("gid", "part").alias("gid"), "key"))
        # one class of each part, in shares of a bucket that overlap in their first class
        count = first.groupBy("gid").agg(F.count("*").alias("parts"), F.min("key").alias("head"))
        share = F.pmod(F.xxhash64("key", F.lit(7)), F.ceil(F.col("parts") * 2 / bucket))
        shared = first.join(count, "gid").select(F.xxhash64("gid", share).alias("gid"), "key", "head")
        made.append(shared.select("gid", "key"))
        made.append(shared.select("gid", F.col("head").alias("key")).distinct())
        rows = large.select("key", "tree", "path")
    out = made[0]
    for more in made[1:]:
        out = out.unionByName(more)
    return out.distinct() if len(made) > 1 else out


def _linked(met: DataFrame, classes: DataFrame, folder: str) -> DataFrame:
    """Links of the classes that meet (``gid, key``), written to ``folder``; with a ``label``, links
    of the labels, found between rows of different ones."""
    met = met.join(classes.select("key", "sig").hint("shuffle_hash"), "key")
    if "label" in met.columns:
        met = met.select("gid", F.col("label").alias("key"), "sig")
    met = met.repartition("gid").sortWithinPartitions("gid", "key")
    met.mapInArrow(_link_batches, _LINKS).write.parquet(folder)
    return met.sparkSession.read.parquet(folder)


def _rest(large: DataFrame, grouped: DataFrame, bucket: int) -> DataFrame:
    """``(gid, key, label)``: the classes of each prefix of ``large`` that lie in different components,
    dealt into blocks of half a bucket; every two blocks meet. Rows grow with the square of
    such a prefix's classes, a task's rows do not."""
    placed = large.select("gid", "n", "key").join(grouped.withColumnRenamed("node", "key").hint("shuffle_hash"), "key", "left")
    # a class that was linked with none is a component
    placed = placed.select("gid", "n", "key", F.coalesce("label", "key").alias("label"))
    # components are compared whole, so a prefix of one component has nothing left
    torn = placed.groupBy("gid").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("gid")
    blocks = F.ceil(F.col("n") * 2 / bucket).cast("int")
    dealt = placed.join(torn.hint("shuffle_hash"), "gid", "left_semi").select(
        "gid", "key", "label", blocks.alias("blocks"), F.pmod(F.xxhash64("key", F.lit(11)), blocks).cast("int").alias("block")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return dealt.select("gid", "key", "label", "block", other.alias("o")).where("block <> o").select(
        F.xxhash64("gid", F.least("block", "o"), F.greatest("block", "o")).alias("gid"), "key", "label"
    )


def _candidates(classes: DataFrame, folder: str, bucket: int) -> DataFrame:
    """``(node, label)``: the components of classes that are similar by their signatures."""
    spark = classes.sparkSession
    met = _buckets(classes, f"{folder}/buckets", bucket)
    links = _linked(met, classes, f"{folder}/candidates")
    grouped = components(links, f"{folder}/candidate-groups")
    large = spark.read.parquet(f"{folder}/buckets/depth-{prefix_depth()}").where(F.col("n") > bucket)
    if large.isEmpty():
        return grouped
    more = _linked(_rest(large, grouped, bucket), classes, f"{folder}/rest")
    if more.isEmpty():
        return grouped
    # components become nodes, so that links within one are not followed again
    joined = components(more, f"{folder}/joined-groups").withColumnRenamed("label", "least")
    nodes = grouped.unionByName(joined.select("node", F.col("node").alias("label")).join(grouped, "node", "left_anti"))
    return nodes.join(joined.withColumnRenamed("node", "label"), "label", "left").select(
        "node", F.coalesce("least", "label").alias("label")
    )


def _compare(part: pd.DataFrame) -> pd.DataFrame:
    """Exact links between the classes of one block, or of one block and another."""
    texts = [normal(t) for t in part["text"]]
    keys = part["key"].tolist()
    # ids can occur with several texts: a row whose text is another class's is left out
    good = [i for i, x in enumerate(texts) if hashlib.blake2b(x, digest_size=16).digest() == keys[i]]
    good = list({keys[i]: i for i in reversed(good)}.values())
    good.sort(key=lambda i: keys[i])
    g, at = shingles([texts[i] for i in good], WIDTH)
    m = len(good)
    text = np.repeat(np.arange(m), np.diff(at))
    order = np.lexsort((g, text))
    g, text = g[order], text[order]
    fresh = np.ones(len(g), bool)
    fresh[1:] = (g[1:] != g[:-1]) | (text[1:] != text[:-1])
    g, text = g[fresh], text[fresh]
    n = np.bincount(text, minlength=m)
    _, col, count = np.unique(g, return_inverse=True, return_counts=True)
    shared = count[col] > 1
    text = text[shared]
    _, col = np.unique(col[shared], return_inverse=True)
    common = np.zeros((m, m), np.float64)
    width = 1 << 14
    for c in range(0, int(col.max()) + 1 if len(col) else 0, width):
        here = (col >= c) & (col < c + width)
        dense = np.zeros((m, min(width, int(col.max()) + 1 - c)), np.float32)
        dense[text[here], col[here] - c] = 1
        common += dense @ dense.T
    linked = DENOMINATOR * common >= NUMERATOR * (n[:, None] + n[None, :] - common)
    block = part["block"].to_numpy()[good]
    linked &= (block[:, None] != block[None, :]) | (part["i"].iloc[0] == part["j"].iloc[0])
    np.fill_diagonal(linked, False)
    copies = part["n"].to_numpy()[good]
    sets = _Sets(m)
    for i, j in zip(*np.nonzero(np.triu(linked)), strict=True):
        sets.join(int(i), int(j))
    return pd.DataFrame(
        {
            "key": [keys[i] for i in good],
            "links": linked @ copies if m else [],
            "root": [keys[good[sets.root(k)]] for k in range(m)],
        }
    )


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """``doc_id, class_id, copy_id, n_links`` of every document, and its class ``key``."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "ngram-join")
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    append_columns(plain, "text", _sign_kernel, _SIGNED, keep_text=False).write.parquet(f"{folder}/signed")
    signed = spark.read.parquet(f"{folder}/signed")
    signed.where("n_shingles > 0").groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("n"), F.first("paths").alias("paths"), F.first("sig").alias("sig")
    ).write.parquet(f"{folder}/classes")
    classes = spark.read.parquet(f"{folder}/classes")

    grouped = _candidates(classes, folder, bucket)

    sizes = grouped.groupBy("label").agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") / block).cast("int")
    members = (
        grouped.join(sizes, "label")
        .select(F.col("node").alias("key"), "label", blocks.alias("blocks"))
        .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        .join(classes.select("key", "rep", "n"), "key")
    )
    members.write.parquet(f"{folder}/members")
    members = spark.read.parquet(f"{folder}/members")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    texts = plain.join(members.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("rep")))
    pairs = texts.select("key", "n", "text", "label", "block", other.alias("o")).select(
        "key", "n", "text", "label", "block", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j")
    )
    pairs.groupBy("label", "i", "j").applyInPandas(_compare, "key binary, links long, root binary").write.parquet(
        f"{folder}/compared"
    )
    compared = spark.read.parquet(f"{folder}/compared")
    linked = components(compared.select(F.col("key").alias("a"), F.col("root").alias("b")), f"{folder}/groups")
    links = compared.groupBy("key").agg(F.sum("links").alias("links"))
    placed = classes.select("key", "rep", "n").join(linked.withColumnRenamed("node", "key"), "key", "left")
    placed = placed.join(links, "key", "left").select(
        "key",
        F.col("rep").alias("copy_id"),
        F.coalesce("label", "key").alias("label"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
    )
    placed.write.parquet(f"{folder}/placed")
    placed = spark.read.parquet(f"{folder}/placed")
    least = placed.groupBy("label").agg(F.min("copy_id").alias("class_id"))
    placed.join(least, "label").select("key", "class_id", "copy_id", "n_links").write.parquet(f"{folder}/result")
    result = spark.read.parquet(f"{folder}/result")
    out = signed.select("doc_id", "key", "n_shingles").join(result, "key", "left")
    own = F.col("n_shingles") == 0
    return out.select(
        "doc_id",
        F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(own, F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        "key",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one whose id is the group's ``class_id``.

    Documents without words all stay. Groups of null ids only keep one row of each text.
    """
    found = join(docs, id_col, text_col)
    stays = found.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    ids = stays.select(F.col("doc_id").alias("_stays")).distinct().hint("shuffle_hash")
    kept = docs.join(ids, F.col(id_col).eqNullSafe(F.col("_stays")), "left_semi")
    # rows of equal id: the semi join can't tell them apart, so their classes are needed once more
    if stays.groupBy("doc_id").count().where("count > 1").isEmpty() and found.groupBy("doc_id").count().where(
        "count > 1"
    ).isEmpty():
        return kept
    signed = append_columns(kept, text_col, _sign_kernel, _SIGNED).drop("n_shingles", "paths", "sig")
    wanted = stays.select(F.col("doc_id").alias("_stays"), F.col("key").alias("_key")).distinct().hint("shuffle_hash")
    same = F.col(id_col).eqNullSafe(F.col("_stays")) & (F.col("key") == F.col("_key"))
    own = signed.join(wanted, same, "left_semi")
    empty = hashlib.blake2b(b"", digest_size=16).digest()
    wordless = own.where(F.col("key") == F.lit(bytearray(empty)))
    return own.where(F.col("key") != F.lit(bytearray(empty))).dropDuplicates([id_col, "key"]).unionByName(wordless).drop("key")
