"""Token-id files: Simple-8b blocks written in id order and read back.

A file holds a range of documents: a magic, blocks of ``BLOCK`` ids (packed
words, then escaped values), a footer with the block directory (offset, words,
escapes, ids) and the document directory (id, null flag, id count), the
footer's length and the magic again. Any block decodes on its own, so a reader
seeks to the blocks it needs.

Writing range-partitions the documents by id (a sampled sort; ties by text) and
each task streams its partition into one file under a name of its own attempt;
the manifest, a Parquet table written by Spark's commit protocol, names only the
files of attempts that succeeded, so lost executors and repeated tasks leave no
wrong file in it. What reaches the driver is one count a file.

Rows: null texts have no ids of their own (only the end id); null document ids
come first; repeated ids are ordered by text; an empty table gives no files.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitparade.llm import simple8b
from hitparade.llm.arrow import slices

MAGIC = b"S8BTOK01"
BLOCK = 1 << 16
#: Blocks that a reader decodes at a time.
READ_BLOCKS = 16

MANIFEST = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("path", T.StringType()),
        T.StructField("n_docs", T.LongType()),
        T.StructField("n_ids", T.LongType()),
    ]
)
ROWS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


class FileWriter:
    """Streams documents' ids into one file."""

    def __init__(self, out):
        self.out, self.at = out, len(MAGIC)
        self.blocks: list[tuple[int, int, int, int]] = []
        self.docs: list[np.ndarray] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = self.n_docs = 0
        out.write(MAGIC)

    def add(self, doc_ids: list[int | None], ids: list[np.ndarray]) -> None:
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        known = np.array([d is not None for d in doc_ids], np.int64)
        self.docs.append(np.stack([np.array([d or 0 for d in doc_ids], np.int64), known, lens], axis=1))
        self.n_docs += len(ids)
        self.n_ids += int(lens.sum())
        self.waiting += ids
        self.n_waiting += int(lens.sum())
        if self.n_waiting >= BLOCK:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        v = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        whole = len(v) if last else len(v) // BLOCK * BLOCK
        for i in range(0, whole, BLOCK):
            part = v[i : min(i + BLOCK, whole)]
            words, escaped = simple8b.pack(part)
            self.out.write(words.astype("<u8").tobytes() + escaped.astype("<u8").tobytes())
            self.blocks.append((self.at, len(words), len(escaped), len(part)))
            self.at += 8 * (len(words) + len(escaped))
        self.waiting, self.n_waiting = [v[whole:]], len(v) - whole

    def close(self) -> None:
        self._flush(last=True)
        docs = np.concatenate(self.docs) if self.docs else np.zeros((0, 3), np.int64)
        foot = struct.pack("<qq", len(self.blocks), len(docs))
        foot += np.array(self.blocks, "<i8").tobytes() + docs.astype("<i8").tobytes()
        self.out.write(foot + struct.pack("<q", len(foot)) + MAGIC)


class FileReader:
    """Random access to a token file (any seekable binary file object)."""

    def __init__(self, src, size: int):
        self.src = src
        tail = self._read(size - 8 - len(MAGIC), 8 + len(MAGIC))
        if tail[8:] != MAGIC or self._read(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a token file, or a cut one")
        length = struct.unpack("<q", tail[:8])[0]
        foot = self._read(size - 8 - len(MAGIC) - length, length)
        nb, nd = struct.unpack("<qq", foot[:16])
        self.blocks = np.frombuffer(foot, "<i8", nb * 4, 16).reshape(nb, 4)
        self.docs = np.frombuffer(foot, "<i8", nd * 3, 16 + nb * 32).reshape(nd, 3)

    def _read(self, at: int, n: int) -> bytes:
        self.src.seek(at)
        return self.src.read(n)

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids of blocks ``first`` to ``last`` (exclusive), in one read."""
        part = self.blocks[first:last]
        if not len(part):
            return np.zeros(0, np.uint64)
        base = int(part[0, 0])
        data = self._read(base, int(part[-1, 0] + 8 * (part[-1, 1] + part[-1, 2])) - base)
        out = []
        for at, nw, ne, n in part.tolist():
            words = np.frombuffer(data, "<u8", nw, at - base)
            out.append(simple8b.unpack(words, np.frombuffer(data, "<u8", ne, at - base + 8 * nw), n))
        return np.concatenate(out)

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """``(doc id, ids of the file's documents before it, its ids)``."""
        buf, block, start = np.zeros(0, np.uint64), 0, 0
        for doc, known, n in self.docs.tolist():
            if len(buf) < n:
                more, have = [buf], len(buf)
                while have < n:
                    more.append(self.ids(block, block + READ_BLOCKS))
                    block += READ_BLOCKS
                    have += len(more[-1])
                buf = np.concatenate(more)
            yield (doc if known else None), start, buf[:n]
            buf, start = buf[n:], start + n


def write(
    docs: DataFrame,
    root: str,
    make_encoder: Callable[[], Callable[[list], list[np.ndarray]]],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the ids of every document in ascending id order; returns the manifest.

    ``make_encoder()`` runs once a task; ``encoder(texts)`` gives an array of ids
    a text. ``root`` must be a folder that every executor sees.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, ctx = make_encoder(), TaskContext.get()
        fs, folder = pafs.FileSystem.from_uri(root)
        writer = path = out = None
        for batch in batches:
            for part in slices(batch, "text"):
                if writer is None:
                    fs.create_dir(folder, recursive=True)
                    path = f"{folder}/part-{ctx.partitionId():06d}-{ctx.taskAttemptId()}.s8b"
                    out = fs.open_output_stream(path)
                    writer = FileWriter(out)
                writer.add(part.column("doc_id").to_pylist(), encoder(part.column("text").to_pylist()))
        if writer is not None:
            writer.close()
            out.close()
            made = [[ctx.partitionId()], [path], [writer.n_docs], [writer.n_ids]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(made, (pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                names=MANIFEST.names,
            )

    spark = docs.sparkSession
    rows.mapInArrow(run, MANIFEST).write.parquet(f"{root}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


def read(spark: SparkSession, root: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it) and ``ids`` (little-endian
    unsigned 32-bit) of every document, decoded from the files; a task a file."""
    files = spark.read.schema(MANIFEST).parquet(f"{root}/manifest").orderBy("part").collect()
    starts = np.cumsum([0, *(f.n_ids for f in files)]).tolist()
    todo = [(f.path, s) for f, s in zip(files, starts, strict=False)]
    todo_df = spark.createDataFrame(todo, "path string, base long").repartition(max(1, len(todo)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(root)
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                with fs.open_input_file(path) as src:
                    rows: list[tuple] = []
                    held = 0
                    for doc, start, ids in FileReader(src, src.size()).documents():
                        rows.append((doc, base + start, ids.astype("<u4").tobytes()))
                        held += 4 * len(ids)
                        if held > 4 << 20:
                            yield _row_batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _row_batch(rows)

    return todo_df.mapInArrow(run, ROWS)


def _row_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())],
        names=ROWS.names,
    )


def to_bytes(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """One file's bytes (for small data and tests)."""
    out = io.BytesIO()
    w = FileWriter(out)
    w.add(doc_ids, ids)
    w.close()
    return out.getvalue()
