"""Quality classifier: a linear-chain conditional random field over a text's lines.

Every line gets a label, good or bad, from its own and its neighbours' features
(length, case, symbols, digits, punctuation, repeated words, repeated lines) and
the label before it. Labels of documents teach the lines: each line of a labelled
text has its document's label. A text's quality is the average of its lines'
forward-backward marginals of ``good``, weighted by their length, passed through
a logistic calibration fitted on the same documents.

Training takes at most ``TRAIN_DOCS`` labelled documents (those with the smallest
id hashes), at most ``TRAIN_LINES`` consecutive lines of each: the documented
bound of what reaches the driver. Scoring reads whole texts.

Rows: a null or empty text is one empty line and gets a score. An id labelled
repeatedly has its labels' majority (a tie is 1); null ids and labels teach
nothing. Without labels of both kinds every score is 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitparade.llm.arrow import append_columns
from hitparade.llm.hashing import run_hashes

TRAIN_DOCS = 4000
TRAIN_LINES = 256
#: Lines of one training chain; longer documents are several chains.
CHAIN = 64
STEPS = 150

_KIND = np.zeros(256, np.uint8)  # 0: others, 1: lower, 2: upper, 3: digit, 4: space, 5: symbol, 6: mark, 7: inside a character
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[192:] = 1, 2, 3, 1
_KIND[[9, 11, 12, 13, 32]] = 4
_KIND[list(b"#*$%&|<>~^_=+@")] = 5
_KIND[list(b"!\"'(),-./:;?[]")] = 6
_KIND[128:192] = 7
_KIND[10] = 8

N_LINE = 15


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(features, characters, lines before each text)`` of every line of the texts."""
    joined = "\n".join(t or "" for t in texts).encode() + b"\n"
    data = np.frombuffer(joined, np.uint8)
    counts = np.fromiter(((t or "").count("\n") + 1 for t in texts), np.int64, len(texts))
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    kind = _KIND[data]

    def per_line(flag: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flag, starts, dtype=np.float64)

    lower, upper, digit, symbol, mark = (per_line(kind == k) for k in (1, 2, 3, 5, 6))
    chars = per_line((kind != 7) & (kind != 8))
    inside = np.concatenate([[False], (kind != 4) & (kind != 8), [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edge[::2], edge[1::2]
    h = run_hashes(data, begin, end)
    line_of = np.searchsorted(starts, begin, side="right") - 1
    words = np.bincount(line_of, minlength=len(starts)).astype(float)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (line_of[1:] == line_of[:-1])
    repeats = np.bincount(line_of, weights=again, minlength=len(starts))
    text_of = np.repeat(np.arange(len(texts)), counts)
    line_hash = run_hashes(data, starts, ends) ^ (text_of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(line_hash, return_index=True)
    seen = np.ones(len(starts), bool)
    seen[first] = False
    seen &= words > 0
    bang, pipe = per_line(data == 33), per_line(data == 124)
    w, c, letters = np.maximum(words, 1), np.maximum(chars, 1), np.maximum(lower + upper, 1)
    f = np.stack(
        [
            np.ones(len(starts)),
            np.log1p(words) / 5,
            upper / letters,
            np.minimum(symbol / w, 3),
            np.minimum(bang / w, 3),
            digit / c,
            mark / c,
            repeats / w,
            seen,
            np.minimum(lower + upper + digit, 40 * w) / w / 10,
            words < 4,
            np.minimum(pipe / w, 3),
            symbol > 0.3 * words,
            upper > 0.5 * letters,
            repeats > 0.2 * w,
        ],
        axis=1,
    )
    return f.astype(np.float32), chars, np.concatenate([[0], np.cumsum(counts)])


def with_neighbours(f: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each line's features, then those of the lines before and after (zeros at a text's ends)."""
    before, after = np.zeros_like(f), np.zeros_like(f)
    before[1:], after[:-1] = f[:-1], f[1:]
    first, last = at[:-1], at[1:] - 1
    before[first] = 0
    after[last] = 0
    return np.concatenate([f, before, after], axis=1)  # a neighbour's constant tells whether there is one


def marginals(e: np.ndarray, trans: np.ndarray, lens: np.ndarray):
    """Log-odds of ``good`` from what is before and at each line, and from what is after it.

    ``e`` are the lines' log-odds of good by their features, ``trans[i, j]`` the score of label
    ``j`` after ``i``. Two labels make forward and backward sums log-odds, so a step is one
    vector operation over all chains that are long enough.
    """
    fwd, bwd = np.zeros(len(e)), np.zeros(len(e))
    order = np.argsort(-lens, kind="stable")
    first, n = (np.cumsum(lens) - lens)[order], lens[order]
    for t in range(int(n[0]) if len(n) else 0):
        live = first[: int(np.searchsorted(-n, -t, side="left"))] + t
        fwd[live] = e[live]
        if t:
            a = fwd[live - 1]
            fwd[live] += np.logaddexp(trans[1, 1] + a, trans[0, 1]) - np.logaddexp(trans[1, 0] + a, trans[0, 0])
    last = first + n - 1
    for t in range(1, int(n[0]) if len(n) else 0):
        live = last[: int(np.searchsorted(-n, -t, side="left"))] - t
        b = e[live + 1] + bwd[live + 1]
        bwd[live] = np.logaddexp(trans[1, 1] + b, trans[1, 0]) - np.logaddexp(trans[0, 1] + b, trans[0, 0])
    return fwd, bwd


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class LineCRF:
    """Weights of lines, transitions between labels, and the calibration."""

    def __init__(self):
        self.w = np.zeros(3 * N_LINE)
        self.trans = np.zeros((2, 2))
        self.calibration = (0.0, 0.0)

    def train(self, f: np.ndarray, y: np.ndarray, lens: np.ndarray, l2: float = 1e-3, rate: float = 0.1) -> None:
        """Maximises the chains' conditional log-likelihood (Adam over exact gradients)."""
        n = len(y)
        inner = np.ones(n, bool)
        inner[np.cumsum(lens) - lens] = False
        to = np.flatnonzero(inner)
        observed = np.zeros((2, 2))
        np.add.at(observed, (y[to - 1], y[to]), 1)
        theta = np.zeros(len(self.w) + 4)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, STEPS + 1):
            w, trans = theta[:-4], theta[-4:].reshape(2, 2)
            e = f @ w
            fwd, bwd = marginals(e, trans, lens)
            g_w = f.T @ (y - _sigmoid(fwd + bwd)) / n - l2 * w
            # expected transitions: the four label pairs of each inner line
            a, b = fwd[to - 1], e[to] + bwd[to]
            four = np.stack([trans[0, 0] + 0 * a, trans[0, 1] + b, trans[1, 0] + a, trans[1, 1] + a + b])
            four = np.exp(four - four.max(axis=0))
            expected = (four / four.sum(axis=0)).sum(axis=1).reshape(2, 2)
            g = np.concatenate([g_w, ((observed - expected) / n - l2 * trans).ravel()])
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            theta += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        self.w, self.trans = theta[:-4], theta[-4:].reshape(2, 2)

    def document(self, f: np.ndarray, chars: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Length-weighted average of the lines' marginals, by text."""
        fwd, bwd = marginals(f @ self.w, self.trans, np.diff(at))
        weight = chars + 1
        good = np.add.reduceat(weight * _sigmoid(fwd + bwd), at[:-1])
        return good / np.add.reduceat(weight, at[:-1])

    def calibrate(self, quality: np.ndarray, y: np.ndarray) -> None:
        """Logistic regression of the label on the log-odds of the quality (Newton steps)."""
        x = np.stack([np.ones(len(y)), _logit(quality)], axis=1)
        b = np.zeros(2)
        for _ in range(25):
            p = _sigmoid(x @ b)
            h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
            b += np.linalg.solve(h, x.T @ (y - p) - 1e-3 * b)
        self.calibration = (float(b[0]), float(b[1]))

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Quality of whole texts, 0 to 1."""
        if not texts:
            return np.zeros(0)
        f, chars, at = line_features(texts)
        x = with_neighbours(f, at)
        a, b = self.calibration
        return _sigmoid(a + b * _logit(self.document(x, chars, at)))

    @classmethod
    def fit(
        cls,
        docs: DataFrame,
        labels: DataFrame,
        id_col: str = "doc_id",
        text_col: str = "text",
        label_col: str = "quality",
        train_docs: int = TRAIN_DOCS,
        train_lines: int = TRAIN_LINES,
    ) -> LineCRF:
        known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        known = known.groupBy(F.col(id_col).alias("_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("y"))
        # at most train_docs rows, so the broadcast is bounded
        chosen = F.broadcast(known.orderBy(F.xxhash64("_id"), "_id").limit(train_docs))
        rows = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text"))
        rows = rows.join(chosen, F.col("_doc") == F.col("_id")).select("_doc", "text", "y")

        def kernel():
            def run(texts):
                out, sizes = [], []
                for t in texts:
                    f, chars, at = line_features([t])
                    x = with_neighbours(f, at)
                    # a long text gives a run of lines from a place that its length decides
                    begin = (len(x) * 7919) % (len(x) - train_lines + 1) if len(x) > train_lines else 0
                    part = slice(begin, begin + train_lines)
                    out.append(x[part].astype("<f4").tobytes())
                    sizes.append(chars[part].astype("<f8").tobytes())
                return [pa.array(out, pa.binary()), pa.array(sizes, pa.binary())]

            return run

        fields = [T.StructField("f", T.BinaryType()), T.StructField("chars", T.BinaryType())]
        got = append_columns(rows, "text", kernel, fields, keep_text=False).orderBy("_doc", "f").collect()
        model = cls()
        y = np.array([r.y for r in got])
        if len(set(y.tolist())) < 2:
            return model
        parts = [np.frombuffer(r.f, "<f4").reshape(-1, 3 * N_LINE) for r in got]
        f = np.concatenate(parts).astype(np.float64)
        chars = np.concatenate([np.frombuffer(r.chars, "<f8") for r in got])
        n = np.array([len(p) for p in parts])
        lens = np.concatenate([[CHAIN] * (k // CHAIN) + [k % CHAIN] * int(k % CHAIN > 0) for k in n]).astype(np.int64)
        model.train(f, np.repeat(y, n), lens)
        at = np.concatenate([[0], np.cumsum(n)])
        model.calibrate(model.document(f, chars, at), y)
        return model

    def predict(self, docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
        """``docs`` with ``score``; the model (a few hundred numbers) goes with the task."""
        model = self

        def kernel():
            return lambda texts: [pa.array(model.score(texts), pa.float64())]

        return append_columns(docs, text_col, kernel, [T.StructField("score", T.DoubleType())], keep_text)


def _logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))
