"""Language identification: multinomial naive Bayes over hashed character n-grams.

Text is lower-cased, every run of characters that are not letters becomes one
space, and each text is framed by spaces; its n-grams of the orders in
``orders`` are hashed into ``buckets`` buckets. Training counts every n-gram of
every labelled text: tasks count into arrays, Spark adds them up by (language,
bucket). The driver gets at most languages x buckets numbers, turns them into a
log-probability matrix and broadcasts it; scoring looks up a batch's n-grams
and sums them by text in numpy. The score is the posterior of the predicted
language under the training share of the languages' texts.

Rows: a null text or one without a letter is ``und`` with score 0; so is every
text when nothing was learned. Null labels teach nothing. Ties go to the
language that sorts first. Repeated rows count as often as they occur. Texts are
never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitparade.llm.arrow import append_columns, slices

UNDETERMINED = "und"
#: Characters in one numpy pass (a longer text is still one pass).
PASS_CHARS = 1 << 18

_LETTERS: list[np.ndarray] = []


def _is_letter(codes: np.ndarray) -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0][codes]


def _passes(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about PASS_CHARS characters, with the first one's index."""
    first, held, n = 0, [], 0
    for i, t in enumerate(texts):
        held.append(t or "")
        n += len(held[-1])
        if n >= PASS_CHARS:
            yield first, held
            first, held, n = i + 1, [], 0
    if held:
        yield first, held


def letters_only(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(codes, starts, has_letter)``: all texts' normalised characters in one array,
    where each text begins, and whether it has a letter. A text is framed by spaces."""
    low = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), "<u4")
    lens = np.fromiter(map(len, low), np.int64, len(low))
    begin = np.cumsum(lens) - lens
    letter = _is_letter(codes)
    codes = np.where(letter, codes, 32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of a run of others
    keep[begin] = True
    starts = (np.cumsum(keep) - keep)[begin]
    has = np.add.reduceat(letter, begin) > 0
    return codes[keep].astype(np.uint64), starts, has


def gram_buckets(codes: np.ndarray, starts: np.ndarray, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """``(bucket, text)`` of every n-gram of ``n`` characters inside a text."""
    m = len(codes) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.zeros(len(codes), np.int64)
    text[starts[1:]] = 1
    text = np.cumsum(text)
    h = np.full(m, n, np.uint64)
    for k in range(n):
        h = (h + codes[k : k + m]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h = (h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)
    inside = text[:m] == text[n - 1 :]
    return (h[inside] % np.uint64(buckets)).astype(np.int64), text[:m][inside]


class LanguageID:
    """A fitted model: languages, log-probabilities and the hashing they belong to."""

    def __init__(self, langs: list[str], log_prior: np.ndarray, log_prob: np.ndarray, orders: tuple[int, ...]):
        self.langs, self.log_prior, self.log_prob, self.orders = langs, log_prior, log_prob, orders

    @classmethod
    def fit(
        cls,
        labelled: DataFrame,
        text_col: str = "text",
        lang_col: str = "lang",
        orders: tuple[int, ...] = (1, 2, 3),
        buckets: int = 1 << 15,
        alpha: float = 0.5,
        max_cells: int = 1 << 23,
    ) -> LanguageID:
        """Learn from every row with a non-null label. ``buckets`` is halved while all languages' rows
        would be more than ``max_cells`` numbers, which bounds the matrix that is broadcast; beyond
        ``max_cells / 256`` languages there is no such matrix, and that is an error."""
        rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
        languages = rows.agg(F.count_distinct("lang")).first()[0]
        while buckets > 256 and languages * buckets > max_cells:
            buckets //= 2
        if languages * buckets > max_cells:
            raise ValueError(f"{languages} languages: raise max_cells if the matrix may be that large")
        out = T.StructType(
            [T.StructField("lang", T.StringType()), T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())]
        )

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts: dict[str, np.ndarray] = {}
            for batch in batches:
                for part in slices(batch, "text"):
                    langs = part.column("lang").to_pylist()
                    for first, texts in _passes(part.column("text").to_pylist()):
                        here = langs[first : first + len(texts)]
                        names = sorted(set(here))
                        of = np.array([names.index(x) for x in here], np.int64)
                        codes, starts, _ = letters_only(texts)
                        total = np.zeros((len(names), buckets + 1), np.int64)
                        total[:, buckets] = np.bincount(of, minlength=len(names))
                        for n in orders:
                            b, t = gram_buckets(codes, starts, n, buckets)
                            at = of[t] * (buckets + 1) + b
                            total += np.bincount(at, minlength=total.size).reshape(total.shape)
                        for name, row in zip(names, total, strict=True):
                            counts[name] = counts[name] + row if name in counts else row
            for name, row in counts.items():
                at = np.flatnonzero(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(row[at], pa.int64())],
                    names=out.names,
                )

        made = rows.where(F.col("lang").isNotNull()).mapInArrow(count, out)
        # languages x (buckets + 1) rows at most
        got = made.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
        langs = sorted(got["lang"].unique())
        n = np.zeros((len(langs), buckets + 1))
        n[[langs.index(x) for x in got["lang"]], got["bucket"]] = got["n"]
        texts, grams = n[:, buckets], n[:, :buckets] + alpha
        log_prob = np.log(grams / grams.sum(axis=1, keepdims=True)) if langs else grams
        log_prior = np.log(texts / texts.sum()) if langs else texts
        return cls(langs, log_prior, log_prob.astype(np.float32), tuple(orders))

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Predicted languages and their posteriors."""
        names, scores = [], []
        buckets = self.log_prob.shape[1]
        by_bucket = np.ascontiguousarray(self.log_prob.T)
        for _, part in _passes(texts):
            codes, starts, has = letters_only(part)
            if not self.langs:
                has[:] = False
            total = np.tile(self.log_prior, (len(part), 1))
            for n in self.orders if self.langs else ():
                b, t = gram_buckets(codes, starts, n, buckets)
                if len(t):
                    first = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
                    total[t[first]] += np.add.reduceat(by_bucket[b], first, axis=0, dtype=np.float64)
            if self.langs:
                best = total.argmax(axis=1)
                post = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            else:
                best, post = np.zeros(len(part), int), np.zeros(len(part))
            names += [self.langs[i] if ok else UNDETERMINED for i, ok in zip(best, has, strict=True)]
            scores.append(np.where(has, post, 0.0))
        return names, np.concatenate(scores) if scores else np.zeros(0)

    def predict(self, docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
        """``docs`` with ``lang_pred`` and ``score``; the matrix is broadcast."""
        model = docs.sparkSession.sparkContext.broadcast(self)

        def kernel():
            def run(texts):
                names, scores = model.value.score(texts)
                return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

            return run

        fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
        return append_columns(docs, text_col, kernel, fields, keep_text)
