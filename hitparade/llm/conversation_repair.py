"""Conversation structure repair by Wagner-Fischer alignment to target role strings.

A sound conversation's role initials read ``(s?(ua)+)?``: an optional system turn, then
user and assistant turns in alternation, or nothing at all. A conversation's turns are
aligned to each feasible length of that string. Edits and their costs: Keep 0,
Rerole (to user or assistant) 3, Delete 4, Insert (an empty user or assistant turn) 3;
a truncated turn that stays costs 3 more; blank and duplicate turns must go. Lengths
are tried outward from the number of turns, each alignment inside the Ukkonen band
that the cheapest one so far leaves, until no other length can be as cheap. The
backtraced audits (initials of the edits in order) of equally cheap alignments are
compared, the ASCII-least wins.

Rows are range-partitioned by (conversation, turn), so that a conversation holding a third
of all rows is spread over many tasks. A task repairs the conversations that lie
wholly inside its partition. The rows of the others - the first and the last of a
partition, and those of more than ``LONG`` rows - go a second way: duplicates are found
by an aggregate and a join, blocks of ``BLOCK`` turns are aligned on their own from
every state of the target string to every other, and one streaming pass a
conversation joins the blocks' tables: cheapest cost and least audit to each state,
writing out what the audits of all states have in common. It holds some blocks, never a
whole conversation. What stays in one task is that streaming pass: a hash of a
conversation's text is sequential.

Turns go by turn number, nulls first; rows of equal turn by the MD5 of their role and text.
Each row's first fault counts: blank (nothing but ASCII white space), duplicate (role
and text occur earlier in the conversation), truncated (the last character that isn't
white space is none of ``.!?``).

Rows: null role or text is one space (so such a text is blank); null ids make one
conversation; repeated rows are duplicates; texts are whole whatever their length; an
empty table gives an empty one. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import os.path
import pickle
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitparade.session import scratch_dir

# The costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Turns aligned at a time in a longer conversation.
BLOCK = 32
#: Rows of one conversation that a task holds; longer ones go block by block.
LONG = 4096

_SPACE = " \t\n\r\x0b\x0c"
_NEVER = 1 << 40
# States of the target string: nothing written, system written, assistant due, whole.
START, SYSTEM, DUE, WHOLE = range(4)
_STATE = {"s": SYSTEM, "u": DUE, "a": WHOLE}
_ROLE = {"u": "user", "a": "assistant"}


def _step_costs() -> dict[tuple[str, str], int]:
    """What putting a turn (by its code) in a target's place costs."""
    out = {}
    for code in "suaoSUAOx":
        for want in "sua":
            if code == "x" or (want == "s" and code not in "sS"):
                out[code, want] = _NEVER
            else:
                out[code, want] = (0 if code.lower() == want else REROLE) + (TRUNCATED if code.isupper() else 0)
    return out


_STEP = _step_costs()


def _shift(d: int) -> int:
    """The least cost of ``d`` more deletions than insertions."""
    return DELETE * d if d > 0 else -INSERT * d


def align(code: str, target: str, bound: int = _NEVER) -> tuple[int, str] | None:
    """The cheapest cost and its least audit of turns ``code`` against ``target``; None beyond ``bound``.

    A code's letters: ``s u a o`` a turn by its role's initial (``o`` any other), in capitals
    where it is truncated, ``x`` a turn that must go.
    """
    n, m = len(code), len(target)
    if _shift(n - m) > bound:
        return None
    band = [d for d in range(-m, n + 1) if _shift(d) + _shift(n - m - d) <= bound]
    low, high = band[0], band[-1]
    rest = [[_NEVER] * (m + 2) for _ in range(n + 2)]
    for i in range(n, -1, -1):
        here, below = rest[i], rest[i + 1]
        c = code[i] if i < n else ""
        for j in range(min(m, i - low), max(0, i - high) - 1, -1):
            if i == n and j == m:
                here[j] = 0
                continue
            best = min(below[j] + DELETE if i < n else _NEVER, here[j + 1] + INSERT if j < m and target[j] != "s" else _NEVER)
            if i < n and j < m:
                best = min(best, below[j + 1] + _STEP[c, target[j]])
            here[j] = best
    if rest[0][0] > bound or rest[0][0] >= _NEVER:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:
        left = rest[i][j]
        if i < n and rest[i + 1][j] + DELETE == left:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and rest[i][j + 1] + INSERT == left:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if code[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return rest[0][0], "".join(audit)


def _targets(start: int) -> list[tuple[str, str]]:
    """``(lead, first letter of the alternation)`` of the strings that can follow a state."""
    if start == START:
        return [("", "ua"), ("s", "ua")]
    return [("", "au" if start == DUE else "ua")]


@lru_cache(maxsize=1 << 15)
def alignments(code: str, start: int = START) -> dict[int, tuple[int, str]]:
    """The cheapest (cost, audit) from ``start`` to every state that the turns can end in."""
    n = len(code)
    best: dict[int, tuple[int, str]] = {}

    def attempt(target: str, state: int) -> None:
        known = best.get(state, (_NEVER, ""))
        made = align(code, target, known[0])
        if made is not None and (state not in best or made < known):
            best[state] = made

    attempt("", start)
    for lead, letters in _targets(start):
        if lead:
            attempt(lead, SYSTEM)
        least = len(lead) + 1
        for away in count():
            lengths = [x for x in sorted({n - away, n + away}) if x >= least]
            worst = max(best.get(DUE, (_NEVER,))[0], best.get(WHOLE, (_NEVER,))[0])
            if away and min(DELETE, INSERT) * away > worst:
                break
            for m in lengths:
                body = (letters * (m // 2 + 1))[: m - len(lead)]
                attempt(lead + body, _STATE[body[-1]])
    return best


@lru_cache(maxsize=1 << 16)
def repair_code(code: str) -> tuple[int, str]:
    """The cheapest (cost, audit) of a whole conversation."""
    if len(code) <= BLOCK:
        made = alignments(code)
        return min(made[s] for s in (START, WHOLE) if s in made)
    paths = {START: (0, "")}
    for i in range(0, len(code), BLOCK):
        paths = _extended(paths, {s: alignments(code[i : i + BLOCK], s) for s in range(4)})
    return min(paths[s] for s in (START, WHOLE) if s in paths)


def _extended(paths: dict[int, tuple[int, str]], table: dict[int, dict[int, tuple[int, str]]]) -> dict[int, tuple[int, str]]:
    """The cheapest paths to every state after one more block."""
    out: dict[int, tuple[int, str]] = {}
    for mid, (cost, audit) in paths.items():
        for end, (more, edits) in table[mid].items():
            made = (cost + more, audit + edits)
            if end not in out or made < out[end]:
                out[end] = made
    return out


class Writer:
    """Applies an audit to the turns it is about and hashes what is written."""

    def __init__(self, keep_text: bool):
        self.turns: deque[tuple[str, str]] = deque()
        self.sha = hashlib.sha256()
        self.kept: list[str] | None = [] if keep_text else None
        self.due, self.empty = "u", True

    def write(self, audit: str) -> None:
        out = []
        for edit in audit:
            if edit == "D":
                self.turns.popleft()
                continue
            role, text = self.turns.popleft() if edit != "I" else ("", "")
            if edit != "K":
                role = _ROLE[self.due]
            if role[:1] != "s":
                self.due = "a" if self.due == "u" else "u"
            out.append(f"{role}:{text}")
        if out:
            made = "\n".join(out)
            if not self.empty:
                made = "\n" + made
            self.empty = False
            self.sha.update(made.encode())
            if self.kept is not None:
                self.kept.append(made)

    def columns(self) -> dict:
        return {"repaired_sha256": self.sha.hexdigest(), "repaired": "".join(self.kept) if self.kept is not None else None}


class Tally:
    """Counts over consecutive turns that can be joined with those after them."""

    def __init__(self):
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = None
        self.low = self.high = None

    def add(self, initial: str, turn: int | None, code: str) -> None:
        fresh = Tally()
        fresh.n, fresh.first, fresh.last = 1, initial, initial
        if turn is not None:
            fresh.low = fresh.high = turn
            fresh.turns = 1
        fresh.blank, fresh.duplicate, fresh.truncated = code == "b", code == "d", code.isupper()
        self.join(fresh)

    def join(self, after: Tally) -> None:
        if not after.n:
            return
        if self.n and self.last + after.first not in ("su", "ua", "au"):
            self.illegal += 1
        if not self.n:
            self.first = after.first
        self.last = after.last
        for name in ("n", "blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + getattr(after, name))
        if after.low is not None:
            if self.high == after.low:
                self.turns -= 1
            self.low = after.low if self.low is None else self.low
            self.high = after.high

    def columns(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {
            "n_rows": self.n,
            "gaps": gaps,
            "blank": int(self.blank),
            "duplicate": int(self.duplicate),
            "truncated": int(self.truncated),
            "illegal": self.illegal,
        }


def _fault(role: str, text: str, seen: bool) -> str:
    """``b`` blank, ``d`` duplicate, else the turn's code."""
    end = text.rstrip(_SPACE)
    if not end:
        return "b"
    if seen:
        return "d"
    code = role[:1] if role[:1] and role[:1] in "sua" else "o"
    return code if end[-1] in ".!?" else code.upper()


def _as_code(faults: list[str]) -> str:
    return "".join(["x" if c in "bd" else c for c in faults])


def repair_turns(turns: list[tuple[int | None, str, str]], keep_text: bool = True) -> dict:
    """The result columns of one whole conversation, its ``(turn, role, text)`` in order."""
    tally, writer, faults, seen = Tally(), Writer(keep_text), [], set()
    for turn, role, text in turns:
        code = _fault(role, text, (role, text) in seen)
        seen.add((role, text))
        tally.add(role[:1], turn, code)
        faults.append(code)
        writer.turns.append((role, text))
    cost, audit = repair_code(_as_code(faults))
    writer.write(audit)
    return {**tally.columns(), "cost": cost, "audit": audit, **writer.columns()}


class Stream:
    """Joins the blocks of one conversation, holding only what is still undecided."""

    def __init__(self, keep_text: bool):
        self.paths = {START: (0, "")}
        self.writer, self.tally, self.audit = Writer(keep_text), Tally(), []

    def add(self, turns: list[tuple[str, str]], tally: Tally, table: dict) -> None:
        self.writer.turns.extend(turns)
        self.tally.join(tally)
        self.paths = _extended(self.paths, table)
        sure = os.path.commonprefix([a for _, a in self.paths.values()])
        if sure:
            self._write(sure)
            self.paths = {s: (c, a[len(sure) :]) for s, (c, a) in self.paths.items()}

    def _write(self, audit: str) -> None:
        self.writer.write(audit)
        self.audit.append(audit)

    def columns(self) -> dict:
        cost, audit = min(self.paths[s] for s in (START, WHOLE) if s in self.paths)
        self._write(audit)
        return {**self.tally.columns(), "cost": cost, "audit": "".join(self.audit), **self.writer.columns()}


_COUNTS = ["n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_RESULT = [T.StructField(c, T.LongType()) for c in _COUNTS] + [
    T.StructField("audit", T.StringType()),
    T.StructField("repaired_sha256", T.StringType()),
    T.StructField("repaired", T.StringType()),
]
_TURN = [
    T.StructField("turn", T.LongType()),
    T.StructField("tie", T.StringType()),
    T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
]
_ARROW = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.BinaryType(): pa.binary(), T.BooleanType(): pa.bool_()}


def _batch(rows: list[dict], id_type: pa.DataType, fields: list[T.StructField]) -> pa.RecordBatch:
    cols = [pa.array([r["conv_id"] for r in rows], id_type)]
    cols += [pa.array([r.get(f.name) for r in rows], _ARROW[f.dataType]) for f in fields]
    return pa.RecordBatch.from_arrays(cols, names=["conv_id", *(f.name for f in fields)])


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def _emitted(rows: Iterator[dict], id_type: pa.DataType, fields: list[T.StructField], size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for r in rows:
        held.append(r)
        weight += 100 + sum(len(v) for v in r.values() if isinstance(v, (str, bytes)))
        if weight > size:
            yield _batch(held, id_type, fields)
            held, weight = [], 0
    if held:
        yield _batch(held, id_type, fields)


def _whole_conversations(rows: Iterator[tuple], long: int, keep_text: bool) -> Iterator[dict]:
    """Results of conversations inside a partition; the rows of all others, as they are."""
    first, now, held, passing = True, None, [], True

    def pending(some):
        return ({"conv_id": now, "turn": t, "tie": h, "role": r, "text": x} for t, h, r, x in some)

    for conv, *turn in rows:
        if first or conv != now:
            if held:
                yield {"conv_id": now, **repair_turns([(t, r, x) for t, _, r, x in held], keep_text)}
            passing, held, now = first, [], conv
            first = False
        held.append(turn)
        if passing or len(held) > long:
            passing = True
            yield from pending(held)
            held = []
    yield from pending(held)


_BLOCKS = [
    T.StructField("part", T.LongType()),
    T.StructField("at", T.LongType()),
    T.StructField("block", T.BinaryType()),
]


def _blocks(rows: Iterator[tuple], part: int) -> Iterator[dict]:
    """Blocks of consecutive turns with their counts and alignment tables."""
    now, before, turns, faults, tally, at = object(), None, [], [], Tally(), 0

    def made():
        table = {s: alignments(_as_code(faults), s) for s in range(4)}
        return {"conv_id": now, "part": part, "at": at, "block": pickle.dumps((turns, tally, table))}

    for conv, turn, tie, role, text, later in rows:
        if turns and (conv != now or len(turns) == BLOCK):
            yield made()
            at += 1
            turns, faults, tally = [], [], Tally()
        code = _fault(role, text, later or before == (conv, turn, tie))
        now, before = conv, (conv, turn, tie)
        turns.append((role, text))
        faults.append(code)
        tally.add(role[:1], turn, code)
    if turns:
        yield made()


def _joined(rows: Iterator[tuple], keep_text: bool) -> Iterator[dict]:
    """Conversations from their blocks, which come in order."""
    now, stream = None, None
    for conv, block in rows:
        if stream is None or conv != now:
            if stream is not None:
                yield {"conv_id": now, **stream.columns()}
            now, stream = conv, Stream(keep_text)
        stream.add(*pickle.loads(block))
    if stream is not None:
        yield {"conv_id": now, **stream.columns()}


def repair(
    rows: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    keep_text: bool = True,
    long: int = LONG,
) -> DataFrame:
    """A row a conversation: ``conv_id``, ``n_rows``, ``gaps`` (turn numbers missing between the least
    and the greatest), ``blank``, ``duplicate``, ``truncated``, ``illegal`` (adjacent roles that no sound
    conversation has), ``cost``, ``audit``, ``repaired_sha256`` and, with ``keep_text``, ``repaired``: the
    repaired turns as ``role:text``, newline-joined."""
    spark = rows.sparkSession
    folder = scratch_dir(spark, "conversation-repair")
    plain = rows.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
    )
    id_field = plain.schema["conv_id"]
    key = ["conv_id", "turn", "tie"]
    tied = plain.withColumn("tie", F.md5(F.concat_ws(":", "role", "text"))).select(*key, "role", "text")
    placed = tied.repartitionByRange(*key).sortWithinPartitions(*key, "role", "text")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        for first in batches:
            found = _whole_conversations(
                _rows(_chained(first, batches), ["conv_id", "turn", "tie", "role", "text"]), long, keep_text
            )
            yield from _emitted(found, first.column("conv_id").type, [*_TURN, *_RESULT])

    placed.mapInArrow(whole, T.StructType([id_field, *_TURN, *_RESULT])).write.parquet(f"{folder}/whole")
    seen = spark.read.parquet(f"{folder}/whole")
    done = seen.where(F.col("n_rows").isNotNull()).select("conv_id", *(f.name for f in _RESULT))
    waiting = seen.where(F.col("n_rows").isNull()).select(*key, "role", "text")

    # min ignores null turns, but not a struct that holds one
    firsts = waiting.groupBy("conv_id", "tie").agg(F.min(F.struct("turn")).alias("first"))
    firsts = firsts.withColumnsRenamed({"conv_id": "_conv", "tie": "_tie"}).hint("shuffle_hash")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("tie") == F.col("_tie"))
    judged = waiting.join(firsts, same).select(*key, "role", "text", (~F.col("turn").eqNullSafe(F.col("first.turn"))).alias("later"))
    ordered = judged.repartitionByRange(*key).sortWithinPartitions(*key, "role", "text")

    def in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        for first in batches:
            part = TaskContext.get().partitionId()
            found = _blocks(_rows(_chained(first, batches), [*key, "role", "text", "later"]), part)
            yield from _emitted(found, first.column("conv_id").type, _BLOCKS)

    blocks = ordered.mapInArrow(in_blocks, T.StructType([id_field, *_BLOCKS]))
    dealt = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "at")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        for first in batches:
            found = _joined(_rows(_chained(first, batches), ["conv_id", "block"]), keep_text)
            yield from _emitted(found, first.column("conv_id").type, _RESULT)

    out = done.unionByName(dealt.mapInArrow(joined, T.StructType([id_field, *_RESULT])))
    return out if keep_text else out.drop("repaired")


def _chained(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest
