"""Benchmark decontamination with a generalised suffix automaton.

Items and documents are normalised to words: A-Z lower-cased, every other ASCII
character but digits and letters a separator (other characters belong to words).
The automaton holds all word runs of the items. A document's words stream
through it; at each word it knows the longest run ending there that some item
holds. A run of ``window`` words is a hit; an item of fewer words is a hit where
it occurs whole. Hit words make up spans; a document whose hit share reaches the
coverage limit is contaminated, and spans can be cut out of the text.

Items are dealt by hash into groups of about ``max_group_words`` words, the
bound on what one automaton, its broadcast and the driver hold. There is one
automaton at a time: each group is a pass over the documents, written with the
spans found so far under the scratch folder before the next group's automaton is
built, and the spans of a row are merged.

Rows: null texts have no words (never contaminated, returned as they are). Items
without words match nothing; items with a null id mark words but are not listed;
equal texts under several ids list every id; repeated ids are listed once. Texts are
whole whatever their length, repeated rows give repeated results, and input columns
named like an output column (``n_words``, ``spans``, ``items``) are replaced by it.
"""

from __future__ import annotations

import re
from itertools import repeat

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitparade.llm.arrow import append_columns
from hitparade.llm.hashing import TO_WORDS, words_of
from hitparade.session import scratch_dir

WINDOW = 13
#: Item words that one automaton may hold (about 600 bytes each).
MAX_GROUP_WORDS = 200_000

_WORD = rb"[0-9a-z\x80-\xff]+"
#: SQL pattern of what separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class Automaton:
    """Generalised suffix automaton over word ids, with the items that hold each window.

    Words that no item has are id 0 and reset the match. ``short[s]`` is the
    nearest state, from ``s`` up its suffix links, that is a whole item of fewer
    than ``window`` words; ``wide[s]`` is the state of the last ``window`` words
    of a longer match.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        coded = []
        for item, words in items:
            if words:
                coded.append((item, [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words]))
        for _, ids in coded:
            last = 0
            for c in ids:
                last = self._extend(last, c)
        self.items: dict[int, set[str]] = {}
        self.shortest = min([window, *(len(ids) for _, ids in coded)])
        ends = set()
        for item, ids in coded:
            if len(ids) < window:
                s = 0
                for c in ids:
                    s = self.next[s][c]
                ends.add(s)
                self.items.setdefault(s, set()).update([item] if item is not None else [])
        order = sorted(range(len(self.len)), key=self.len.__getitem__)
        self.short, self.wide = [0] * len(order), [0] * len(order)
        for s in order[1:]:
            up = self.link[s]
            self.short[s] = s if s in ends else self.short[up]
            if self.len[s] >= window:
                self.wide[s] = s if self.len[up] < window else self.wide[up]
        for item, ids in coded:
            if len(ids) >= window and item is not None:
                for _, length, s in self._walk(ids):
                    if length >= window:
                        self.items.setdefault(self.wide[s], set()).add(item)

    def _new(self, length: int, link: int, nxt: dict[int, int]) -> int:
        self.len.append(length)
        self.link.append(link)
        self.next.append(nxt)
        return len(self.len) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        clone = self._new(self.len[p] + 1, self.link[q], dict(self.next[q]))
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:  # an earlier item holds this run
            return q if self.len[q] == self.len[last] + 1 else self._split(last, q, c)
        cur = self._new(self.len[last] + 1, 0, {})
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._split(p, q, c)
        return cur

    def _walk(self, ids: list[int]):
        """``(position, longest matching length, state)`` at each word."""
        s = length = 0
        nxt, link, lens = self.next, self.link, self.len
        for i, c in enumerate(ids):
            if not c:
                s = length = 0
            else:
                while s and c not in nxt[s]:
                    s = link[s]
                    length = lens[s]
                if c in nxt[s]:
                    s = nxt[s][c]
                    length += 1
            yield i, length, s

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """The spans of hit words (start, end) of a document and the items hit."""
        ids = list(map(self.vocab.get, words, repeat(0)))
        known = bytes(map(bool, ids))
        run = b"\x01" * self.shortest
        spans: list[list[int]] = []
        found: set[str] = set()
        at = known.find(run)
        while at >= 0:
            end = known.find(b"\x00", at)
            end = len(ids) if end < 0 else end
            for i, length, s in self._walk(ids[at:end]):
                i += at
                begin = i + 1
                if length >= self.window:
                    begin = i + 1 - length
                    found |= self.items.get(self.wide[s], _NONE)
                e = s if self.short[s] != s or self.len[s] <= length else self.link[s]
                e = self.short[e]
                while e:
                    begin = min(begin, i + 1 - self.len[e])
                    found |= self.items.get(e, _NONE)
                    e = self.short[self.link[e]]
                if begin <= i:
                    while spans and spans[-1][1] >= begin:
                        begin = min(begin, spans.pop()[0])
                    spans.append([begin, i + 1])
            at = known.find(run, end)
        return [(a, b) for a, b in spans], found


_NONE: set[str] = set()


SCAN = [
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def _scan_columns(docs: DataFrame, model: Broadcast, text_col: str, keep_text: bool, remove: bool = False) -> DataFrame:
    """The scan's columns; with ``remove``, the text without the found spans."""

    def kernel():
        scan = model.value.scan

        def run(texts):
            n, spans, items, left = [], [], [], []
            for t in texts:
                words = words_of(t)
                s, f = scan(words)
                n.append(len(words))
                spans.append([x for span in s for x in span])
                items.append(sorted(f))
                if remove:
                    left.append(cut(t, spans[-1]))
            made = [pa.array(n, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
            return [*made, pa.array(left, pa.string())] if remove else made

        return run

    fields = [*SCAN, T.StructField(text_col, T.StringType())] if remove else SCAN
    return append_columns(docs, text_col, kernel, fields, keep_text)


def _automata(items: DataFrame, id_col: str, text_col: str, window: int, max_group_words: int):
    """``(group, groups, automaton)`` of the items' groups, each built when it is asked for."""
    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    n_words = F.size(F.split("text", SEPARATORS)).cast("long")
    total = rows.agg(F.sum(F.when(F.col("text").isNotNull(), n_words))).first()[0] or 0
    groups = max(1, -(-total // max_group_words))
    for g in range(groups):
        mine = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(groups)) == g).collect()
        yield g, groups, Automaton([(r.item, words_of(r.text)) for r in mine], window)


def scan(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    max_group_words: int = MAX_GROUP_WORDS,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (start, end, start, end ... of hit words, ends
    exclusive, in order, apart from each other) and ``items`` (ids hit, sorted as strings)."""
    return _scan(docs, items, text_col, item_id_col, item_text_col, window, max_group_words, keep_text, False)[0]


def _scan(
    docs: DataFrame,
    items: DataFrame,
    text_col: str,
    item_id_col: str,
    item_text_col: str,
    window: int,
    max_group_words: int,
    keep_text: bool,
    remove: bool,
) -> tuple[DataFrame, bool]:
    """The scanned documents, and whether their spans are already removed (asked for by ``remove``
    and done where one automaton holds all items)."""
    spark = docs.sparkSession
    out, folder = docs, None
    for g, groups, automaton in _automata(items, item_id_col, item_text_col, window, max_group_words):
        model = spark.sparkContext.broadcast(automaton)
        del automaton
        if groups == 1:
            return _scan_columns(docs, model, text_col, keep_text, remove), remove
        # the text is scanned again for every further group; what it finds is merged into the row's spans
        out = _scan_columns(out, model, text_col, keep_text=True)
        if g:
            out = _merge_columns(out, text_col)
        if g < groups - 1:
            out = out.withColumnsRenamed({"n_words": "_n", "spans": "_spans", "items": "_items"})
        folder = folder or scratch_dir(spark, "decontaminate")
        out.write.parquet(f"{folder}/group-{g}")
        model.destroy()
        out = spark.read.parquet(f"{folder}/group-{g}")
    return (out if keep_text else out.drop(text_col)), False


def _merge_columns(df: DataFrame, text_col: str) -> DataFrame:
    """Spans and items of a pass joined with those of the passes before."""

    def pairs(c: str):
        at = F.sequence(F.lit(0), (F.size(c) / 2).cast("int") - 1)
        made = F.transform(at, lambda i: F.struct(F.get(c, 2 * i).alias("a"), F.get(c, 2 * i + 1).alias("b")))
        return F.when(F.size(c) > 0, made).otherwise(F.array().cast("array<struct<a:int,b:int>>"))

    def step(acc, x):
        last = F.element_at(acc, -1)
        joined = F.concat(
            F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last.a.alias("a"), F.greatest(last.b, x.b).alias("b")))
        )
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1)).b >= x.a), joined).otherwise(
            F.concat(acc, F.array(x))
        )

    both = F.array_sort(F.concat(pairs("_spans"), pairs("spans")))
    merged = F.aggregate(both, F.array().cast("array<struct<a:int,b:int>>"), step)
    return df.withColumns(
        {
            "spans": F.flatten(F.transform(merged, lambda x: F.array(x.a, x.b))),
            "items": F.array_sort(F.array_union("_items", "items")),
        }
    ).drop("_n", "_spans", "_items")


def hit_words(spans: str = "spans"):
    """Words in the spans."""
    c = F.col(spans)
    return F.aggregate(
        F.transform(c, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x
    )


def cut(text: str | None, spans: list[int]) -> str | None:
    """The text without its hit spans (from a span's first word to the end of its last)."""
    if not spans:
        return text
    data = text.encode()
    at = [m.span() for m in re.finditer(_WORD, data.translate(TO_WORDS))]
    out, done = [], 0
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        out.append(data[done : at[a][0]])
        done = at[b - 1][1]
    return b"".join([*out, data[done:]]).decode()


def _under_limit(scanned: DataFrame, coverage: float) -> DataFrame:
    hit = hit_words()
    return scanned.where((hit == 0) | (hit / F.col("n_words") < coverage))


def remove_spans(scanned: DataFrame, text_col: str = "text", coverage: float = 0.05) -> DataFrame:
    """What is left of scanned documents: those under the coverage limit, their hit
    spans cut out of the text. The scan's columns are dropped."""

    @F.pandas_udf("string")
    def without(text, spans):
        return text.combine(spans, lambda t, s: t if t is None or not len(s) else cut(t, list(s)))

    text = F.when(F.size("spans") > 0, without(text_col, "spans")).otherwise(F.col(text_col))
    return _under_limit(scanned, coverage).withColumn(text_col, text).drop(*(f.name for f in SCAN))


def clean(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    max_group_words: int = MAX_GROUP_WORDS,
    coverage: float = 0.05,
) -> DataFrame:
    """``remove_spans`` of ``scan``, in the scan's own pass where one automaton holds all items."""
    scanned, removed = _scan(docs, items, text_col, item_id_col, item_text_col, window, max_group_words, True, True)
    if not removed:
        return remove_spans(scanned, text_col, coverage)
    return _under_limit(scanned, coverage).drop(*(f.name for f in SCAN))
