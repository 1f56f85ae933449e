"""Secret scans: patterns, and character Markov models of random strings and identifiers.

Patterns find assignments, access keys and long hex runs. The method adds runs
of ``[A-Za-z0-9+/_=-]`` of ``MIN_LENGTH`` characters and more whose log-likelihood
under one of two first-order Markov models of random strings exceeds that under
one of ordinary identifiers by ``MIN_TOTAL`` in all and ``MIN_MEAN`` a transition
(thousandths of a nat), where no pattern match overlaps them.

Labelled samples: random are the values that the patterns match in the corpus
(one model), and strings of known randomness, hex and base64 of SHA-256 digests
of ``GENERATED`` counters (the other); ordinary are the corpus's runs of
``TRAIN_LENGTH`` characters and more once pattern matches are taken out.
Transitions of all of them are counted by Spark, at most 128 x 128 counts a class
reach the driver. Everything is SQL functions.

Positions are code points, ends exclusive. Rows: a null text has no spans; texts are
scanned whole whatever their length, and the work on a text's matches grows little faster than
their number. Repeated rows are scanned each for itself. Of kinds that start together, the
order is that of KINDS. Columns named ``base`` and ``secrets`` are replaced by the
scan's own; other columns pass, whatever their names but ``_text``. A corpus without
ordinary runs (an empty table) gets a uniform model of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitparade.llm.sqltools import bind, int_table

# The base patterns, in the order of their kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
KINDS = ["assign", "access", "hex", "markov"]

RUN = "[A-Za-z0-9+/_=-]"
MIN_LENGTH = 20
TRAIN_LENGTH = 12
GENERATED = 4096
MIN_TOTAL = 4_000
MIN_MEAN = 150
#: Weight, in transitions, of a character's own share in its conditional probabilities.
BACK_OFF = 200.0
#: Items that are folded together before what they give is added to the rest.
BLOCK = 256
#: What is put in place of a span.
MASK = "[SECRET]"

_SPAN = "array<struct<start:int,rank:int,end:int>>"


def _none() -> Column:
    return F.array().cast(_SPAN)


def _in_blocks(items: Column) -> Column:
    """An array cut into arrays of ``BLOCK`` items."""
    last = F.ceil(F.size(items) / BLOCK).cast("int") - 1
    return F.when(F.size(items) > 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * BLOCK + 1, BLOCK)))


def _folded(items: Column, carry: Column, step) -> Column:
    """Spans that ``step(carry, item)`` tells: (next carry, whether to add one, the span), item by item.

    Spans are gathered a block at a time, so that adding one copies a block's at most.
    """

    def add(a: Column, x: Column) -> Column:
        after, wanted, span = step(a.carry, x)
        out = F.when(wanted, F.concat(a.out, F.array(span))).otherwise(a.out)
        return F.struct(after.alias("carry"), out.alias("out"))

    def add_block(a: Column, block: Column) -> Column:
        got = F.aggregate(block, F.struct(a.carry.alias("carry"), _none().alias("out")), add)
        return bind(got, lambda g: F.struct(g.carry.alias("carry"), F.concat(a.out, g.out).alias("out")))

    begin = F.struct(carry.alias("carry"), _none().alias("out"))
    whole = lambda x: F.aggregate(_in_blocks(x), begin, add_block, lambda a: a.out)
    return bind(items, lambda x: F.when(F.size(x) > 0, whole(x)).otherwise(_none()))


def _span(start: Column, rank: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), rank.alias("rank"), end.alias("end"))


def _spans(text: Column, pattern: str, rank: int, kept, group: int = 0) -> Column:
    """Spans of the pattern's matches whose ``group`` passes ``kept(matched group)``."""
    lit = F.lit(pattern)
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    lens = F.transform(F.regexp_extract_all(text, lit, F.lit(0)), F.char_length)
    verdicts = F.transform(F.regexp_extract_all(text, lit, F.lit(group)), kept)
    matches = F.zip_with(lens, verdicts, lambda n, k: F.struct(n.alias("n"), k.alias("kept")))
    # the last gap, after the last match, meets no match
    rows = F.zip_with(matches, gaps, lambda m, g: F.struct(g.alias("gap"), m["n"].alias("n"), m["kept"].alias("kept")))

    def step(at: Column, m: Column):
        start = at + m.gap
        end = start + F.coalesce(m["n"], F.lit(0))
        return end, F.coalesce(m.kept, F.lit(False)), _span(start, F.lit(rank), end)

    return _folded(rows, F.lit(0), step)


def base_spans(text_col: str) -> Column:
    """Matches of the patterns, ordered by start, then kind."""
    text = F.col(text_col)
    assign = F.when(text.rlike(ASSIGN), _spans(text, ASSIGN, 0, lambda m: F.char_length(m) >= 8, group=2))
    access = F.when(text.contains("AKIA"), _spans(text, ACCESS, 1, lambda m: F.char_length(m) >= 16))
    hexes = F.when(text.rlike("[0-9a-f]{32}"), _spans(text, HEX, 2, lambda m: F.char_length(m) >= 32))
    return F.array_sort(F.concat(*[F.coalesce(c, _none()) for c in (assign, access, hexes)]))


def _transitions(strings: DataFrame, col: str) -> DataFrame:
    """How often each pair of neighbouring characters occurs, as ``pair`` = 128 x first + second."""
    chars = strings.select(F.split(col, "").alias("c")).where(F.size("c") > 1)
    pairs = F.transform(
        F.sequence(F.lit(0), F.size("c") - 2), lambda i: F.ascii(F.get("c", i)) * 128 + F.ascii(F.get("c", i + 1))
    )
    return chars.select(F.explode(pairs).alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))


def _conditional(counts: dict[int, int], alphabet: list[int], alpha: float) -> dict[int, float]:
    """p(second | first) by pair: counts smoothed towards the second character's own share."""
    second = dict.fromkeys(alphabet, alpha)
    for p, n in counts.items():
        second[p % 128] += n
    total = sum(second.values())
    out = {}
    for a in alphabet:
        seen = sum(counts.get(128 * a + b, 0) for b in alphabet)
        for b in alphabet:
            out[128 * a + b] = (counts.get(128 * a + b, 0) + BACK_OFF * second[b] / total) / (seen + BACK_OFF)
    return out


def fit(spark: SparkSession, docs: DataFrame, text_col: str = "text", alpha: float = 0.5) -> list[list[int]]:
    """For each model of random strings, thousandths of log p(random) - log p(ordinary) by
    transition, 128 x first + second. Without pattern matches there is one model."""
    text = F.coalesce(F.col(text_col), F.lit("")).alias("t")
    rows = docs.select(text)
    value = F.when(F.col("t").rlike(ASSIGN), F.regexp_extract_all("t", F.lit(ASSIGN), F.lit(2)))
    key = F.when(F.col("t").contains("AKIA"), F.regexp_extract_all("t", F.lit(ACCESS), F.lit(0)))
    hexes = F.when(F.col("t").rlike("[0-9a-f]{32}"), F.regexp_extract_all("t", F.lit(HEX), F.lit(0)))
    empty = F.array().cast("array<string>")
    # what a pattern matches is no part of an ordinary run
    rest = F.col("t")
    for found, pattern in (
        (F.col("t").rlike(ASSIGN), ASSIGN),
        (F.col("t").contains("AKIA"), ACCESS),
        (F.col("t").rlike("[0-9a-f]{32}"), HEX),
    ):
        rest = F.when(found, F.regexp_replace(rest, pattern, " ")).otherwise(rest)
    runs = F.regexp_extract_all(rest, F.lit(f"{RUN}{{{TRAIN_LENGTH},}}"), F.lit(0))
    both = rows.select(F.concat(*[F.coalesce(c, empty) for c in (value, key, hexes)]).alias("hits"), runs.alias("runs"))
    labelled = both.select(
        F.explode(
            F.concat(
                F.transform("hits", lambda s: F.struct(F.lit(1).alias("random"), s.alias("s"))),
                F.transform(
                    F.filter("runs", lambda s: ~F.array_contains("hits", s)),
                    lambda s: F.struct(F.lit(0).alias("random"), s.alias("s")),
                ),
            )
        ).alias("x")
    ).select("x.*")
    labelled = labelled.where(F.col("s").rlike(rf"^[\x21-\x7e]{{{8},}}$"))
    chars = labelled.select("random", F.split("s", "").alias("c"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.size("c") - 2), lambda i: F.ascii(F.get("c", i)) * 128 + F.ascii(F.get("c", i + 1))
    )
    got = chars.select("random", F.explode(pairs).alias("pair")).groupBy("random", "pair").count().collect()
    digest = F.sha2(F.col("id").cast("string").cast("binary"), 256)
    known = spark.range(GENERATED).select(F.explode(F.array(digest, F.base64(F.unhex(digest)))).alias("s"))
    made = {r.pair: r.n for r in _transitions(known, "s").collect()}
    hit = {r.pair: r["count"] for r in got if r.random}
    plain = {r.pair: r["count"] for r in got if not r.random}
    alphabet = sorted({x for p in (*made, *hit, *plain) for x in divmod(p, 128)})
    p_plain = _conditional(plain, alphabet, alpha)
    tables = []
    for counts in filter(None, (made, hit)):
        table = [0] * (128 * 128)
        for pair, p in _conditional(counts, alphabet, alpha).items():
            table[pair] = round(1000 * math.log(p / p_plain[pair]))
        tables.append(table)
    return tables


def markov_spans(text_col: str, base_col: str, tables: list[list[int]], min_total: int, min_mean: int) -> Column:
    """Runs that are likelier random than ordinary, away from the base spans."""
    text = F.col(text_col)

    def llr(chars: Column, table: list[int]) -> Column:
        # 64 bits: an inlined image's run passes 2^31 thousandths
        def gain(i: Column) -> Column:
            return F.get(int_table(table), F.ascii(F.get(chars, i)) * 128 + F.ascii(F.get(chars, i + 1))).cast("long")

        return F.aggregate(F.sequence(F.lit(0), F.size(chars) - 2), F.lit(0).cast("long"), lambda a, i: a + gain(i))

    def random(run: Column) -> Column:
        best = bind(F.split(run, ""), lambda chars: F.array_max(F.array(*[llr(chars, t) for t in tables])))
        return bind(best, lambda x: (x >= min_total) & (x >= F.lit(min_mean).cast("long") * (F.char_length(run) - 1)))

    pattern = f"{RUN}{{{MIN_LENGTH},}}"
    some = F.exists(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), random)
    spans = F.when(some, _spans(text, pattern, 3, random)).otherwise(_none())
    return bind(spans, lambda x: F.when((F.size(x) > 0) & (F.size(base_col) > 0), _apart(x, F.col(base_col))).otherwise(x))


def _apart(spans: Column, base: Column) -> Column:
    """Method spans that overlap no base span: once forwards against the base spans that
    start before, once backwards against those that start after."""
    method = len(KINDS) - 1

    def after_base(reach: Column, s: Column):
        own = s["rank"] < method
        return F.when(own, F.greatest(reach, s.end)).otherwise(reach), own | (reach <= s.start), s

    def before_base(begin: Column, s: Column):
        own = s["rank"] < method
        return F.when(own, s.start).otherwise(begin), ~own & (s.end <= begin), s

    ahead = _folded(F.array_sort(F.concat(base, spans)), F.lit(0), after_base)
    return F.reverse(_folded(F.reverse(ahead), F.lit(2**31 - 1), before_base))


def scan(
    docs: DataFrame, tables: list[list[int]], text_col: str = "text", min_total: int = MIN_TOTAL, min_mean: int = MIN_MEAN
) -> DataFrame:
    """``docs`` with ``base`` and ``secrets`` (base and method): arrays of (start, rank, end),
    the rank an index into KINDS, ordered by start, then kind. A null text counts as empty."""
    rows = docs.drop(*[c for c in ("base", "secrets") if c != text_col])
    rows = rows.withColumn("_text", F.coalesce(F.col(text_col), F.lit(""))).withColumn("base", base_spans("_text"))
    more = markov_spans("_text", "base", tables, min_total, min_mean)
    return rows.withColumn("secrets", F.array_sort(F.concat("base", more))).drop("_text")


def described(spans: str) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s.start, s.end)
    return F.array_join(F.transform(spans, one), ",")


def redact(scanned: DataFrame, text_col: str = "text") -> DataFrame:
    """Scanned documents with every secret (and what overlaps it) replaced by MASK."""
    text = F.col(text_col)

    def before(at: Column, s: Column):
        # what stays before a span; an overlapping span only moves the end on
        return F.greatest(at, s.end), s.start >= at, _span(at, s["rank"], s.start)

    def block(gaps: Column) -> Column:
        first, last = F.get(gaps, 0), F.element_at(gaps, -1)
        # positions are found by counting from the start: cut out the block's part first
        part = F.struct(F.substring(text, first.start + 1, last.end - first.start).alias("t"), first.start.alias("at"))
        cut = lambda p: F.transform(gaps, lambda g: F.substring(p.t, g.start - p.at + 1, g.end - g.start))
        return bind(part, lambda p: F.array_join(cut(p), MASK))

    end = F.array_max(F.transform("secrets", lambda s: s.end))
    rest = F.substring(text, end + 1, F.char_length(text))
    gaps = _folded(F.col("secrets"), F.lit(0), before)
    masked = bind(gaps, lambda g: F.array_join(F.concat(F.transform(_in_blocks(g), block), F.array(rest)), MASK))
    return scanned.withColumn(text_col, F.when(F.size("secrets") > 0, masked).otherwise(text)).drop("base", "secrets")
