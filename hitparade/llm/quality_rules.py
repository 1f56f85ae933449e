"""Quality rules: hashed n-gram log-likelihood ratio of trusted against raw text.

Features of a text are its pairs of neighbouring words and the last three
characters of each word, hashed into ``buckets`` buckets. Two multinomials
are counted over the whole corpus: one over every text (raw), one over the
trusted texts. A text's score is the sum over its features of
log p(trusted) - log p(raw), divided by the number of features; texts at or
above the threshold are kept. Scores are integers of thousandths of a nat, so
sums don't depend on their order. Everything is SQL functions; what reaches the
driver is two counts a bucket.

Besides, the base measures of a text: words, their characters, symbols, repeated
lines, and words in 8-word windows that occur twice or more.

Rows: a null or empty text has no words (base measures 0, score null, never
kept). Rows whose id is null or unlabelled count as raw only; an id labelled
repeatedly is trusted if any label is 1. Repeated rows count as often as they
occur. Without trusted texts there is no score and the base rules decide alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitparade.llm.sqltools import bind, int_table

BUCKETS = 1 << 14
WINDOW = 8
#: Thousandths of a nat a feature; texts below are dropped.
THRESHOLD = -200
SPACES = " \t\n\x0b\f\r"
# The symbols counted.
SYMBOLS = "#*$%&|<>"


def words(text: str) -> Column:
    """Runs of characters other than white space (U+0020, U+0009 to U+000D)."""
    bare = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def symbols(text: str) -> Column:
    """How many characters of SYMBOLS a text has."""
    bytes_of = F.octet_length(F.col(text))
    return sum(
        (bytes_of - F.octet_length(F.replace(F.col(text), F.lit(s), F.lit(""))) for s in SYMBOLS), F.lit(0)
    ).cast("long")


def repeated_lines(text: str) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return bind(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def pairs(words_col: str) -> Column:
    """The hash of every pair of neighbouring words."""
    at = F.when(F.size(words_col) > 1, F.sequence(F.lit(0), F.size(words_col) - 2))
    some = F.transform(at, lambda i: F.xxhash64(F.get(words_col, i), F.get(words_col, i + 1)))
    return F.coalesce(some, F.array().cast("array<bigint>"))


def ending(word: Column) -> Column:
    """The hash of a word's last three characters."""
    return F.xxhash64(F.right(word, F.lit(3)))


def repeated_words(words_col: str, pairs_col: str) -> Column:
    """Words in windows of WINDOW words that occur twice or more in the text.

    Windows are hashed from the pairs by doubling. A text whose window hashes all
    differ repeats no window; in the others equal hashes are brought together by
    sorting, and the words of neighbours are compared.
    """
    n = F.size(words_col)

    def doubled(hashes, step: int, last: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + step))
        )

    def same(x: Column, y: Column) -> Column:
        equal = x.h == y.h
        for k in range(WINDOW):
            equal = equal & (F.get(words_col, x["at"] + k) == F.get(words_col, y["at"] + k))
        return F.coalesce(equal, F.lit(False))

    def covered(ordered: Column) -> Column:
        again = F.filter(ordered, lambda x, i: same(x, F.get(ordered, i - 1)) | same(x, F.get(ordered, i + 1)))
        begin = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            F.array_sort(F.transform(again, lambda x: x["at"])),
            begin,
            lambda a, p: F.struct(p.alias("last"), (a.n + F.least(F.lit(WINDOW), p - a.last)).alias("n")),
        ).n

    def count(windows: Column) -> Column:
        placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), bind(F.array_sort(placed), covered))

    eights = bind(doubled(pairs_col, 2, n - 4), lambda f: doubled(f, 4, n - WINDOW))
    return F.coalesce(F.when(n > WINDOW, bind(eights, count)), F.lit(0)).cast("long")


def _measured(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumn("_words", words(text)).withColumn("_pairs", pairs("_words"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    buckets: int = BUCKETS,
    alpha: float = 1.0,
) -> list[int] | None:
    """Thousandths of log p(trusted) - log p(raw) by bucket; None without trusted texts."""
    # labels grow with the corpus: both sides are shuffled, at any size
    trusted = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("_id")).distinct().hint("shuffle_hash")
    rows = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    rows = rows.join(trusted, F.col("_doc") == F.col("_id"), "left")
    rows = _measured(rows, "_text").select(
        F.col("_id").isNotNull().alias("trusted"),
        F.explode(F.concat("_pairs", F.transform("_words", ending))).alias("hash"),
    )
    bucket = F.pmod("hash", F.lit(buckets)).cast("int").alias("bucket")
    got = rows.groupBy(bucket).agg(F.count("*").alias("raw"), F.count_if("trusted").alias("good")).collect()
    raw, good = [alpha] * buckets, [alpha] * buckets
    for r in got:
        raw[r.bucket] += r.raw
        good[r.bucket] += r.good
    if sum(good) <= alpha * buckets:
        return None
    shift = math.log(sum(raw)) - math.log(sum(good))
    return [round(1000 * (math.log(g) - math.log(r) + shift)) for g, r in zip(good, raw, strict=True)]


def score(docs: DataFrame, table: list[int] | None, text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with the base measures, ``base_failed``, ``llr`` (thousandths of a nat a
    feature) and ``kept``; input columns of these names are replaced."""
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr", "base_failed", "kept"]
    rows = docs.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    rows = _measured(rows, "_text").drop(*[c for c in made if c != text_col])
    if table is None:
        llr = F.lit(None).cast("double")
    else:
        def value(h: Column) -> Column:
            return F.get(int_table(table), F.pmod(h, F.lit(len(table))).cast("int"))

        none = F.lit(0).cast("long")
        total = F.aggregate("_pairs", none, lambda a, h: a + value(h)) + F.aggregate(
            "_words", none, lambda a, w: a + value(ending(w))
        )
        llr = F.when(F.size("_words") > 0, total / (2 * F.size("_words") - 1))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = rows.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
            "n_symbols": symbols("_text"),
            "n_dup_lines": repeated_lines("_text"),
            "n_repeat_words": repeated_words("_words", "_pairs"),
            "llr": llr,
        }
    ).drop("_text", "_words", "_pairs")
    return rows.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & F.coalesce(F.col("llr") >= threshold, F.lit(table is None))
    )

