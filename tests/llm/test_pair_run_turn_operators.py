"""Near duplicates, periodic runs and conversation repair against brute force."""

import hashlib
import random
import re
import zlib
from itertools import combinations

import numpy as np
import pyarrow.parquet as pq
import pytest

from hitparade.llm import bbit_minhash, conversation_repair, periodic_runs, queries

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "word " * 20_000 + "x" * 5_000
ODD = [None, "", " \n\t ", "a", "Zażółć gęślą 日本語 🙂\x1c\x1d tail", LONG, "That it. I'll we'd", "That it. I'll we'd", "A\x0bB", "a b"]


def sha(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


# --- 11 ---------------------------------------------------------------------------------------


def shingle_set(text):
    w = WORDS.findall(lower(text or ""))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def near_duplicates(docs):
    """``(id, shingles, component, kept)`` of every ``(id, text)`` by comparing all pairs."""
    sets = [shingle_set(t) for _, t in docs]
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(range(len(docs)), 2):
        a, b = sets[i], sets[j]
        if a and b and 85 * max(len(a), len(b)) <= 100 * min(len(a), len(b)):
            common = len(a & b)
            if 100 * common >= 85 * (len(a) + len(b) - common):
                up[root(j)] = root(i)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            r = root(i)
            least[r] = min(least.get(r, doc), doc)
    out = []
    for i, (doc, _) in enumerate(docs):
        component = least.get(root(i)) if sets[i] else doc
        out.append((doc, len(sets[i]), component, doc == component))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_near_duplicates_match_all_pairs(spark):
    t = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    assert rows_of(queries.op11_bbit_minhash(spark, SF)) == near_duplicates([(r["doc_id"], r["text"]) for r in t])


def boilerplate_groups():
    """Near copies of templates, chains, and many texts that share half of their words."""
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(10**6)}"
    docs = []
    shared = [word() for _ in range(60)]
    for _ in range(150):  # same half, similarity about 0.4 and more
        docs.append(shared + [word() for _ in range(rnd.choice([6, 10, 40]))])
    for _ in range(6):  # chains: each text a small change of the one before
        now = [word() for _ in range(120)]
        for _ in range(20):
            now = list(now)
            now[rnd.randrange(len(now))] = word()
            docs.append(now)
    template = [word() for _ in range(100)]
    for _ in range(100):  # a star: each near to the template, most not near each other
        one = list(template)
        for _ in range(2):
            one[rnd.randrange(100)] = word()
        docs.append(one)
    docs += docs[::7]
    rnd.shuffle(docs)
    return [(i * 3, " ".join(d)) for i, d in enumerate(docs)]


@pytest.mark.parametrize("block,block_bytes", [(512, 8 << 20), (7, 4000)])
def test_near_duplicates_in_shared_buckets(spark, block, block_bytes):
    rows = boilerplate_groups()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    made = bbit_minhash.link(df, block=block, block_bytes=block_bytes)
    assert rows_of(made) == near_duplicates(rows)


def test_near_duplicates_of_odd_rows(spark):
    rows = [(i if i else None, t) for i, t in enumerate(ODD)] + [(None, "a"), (3, "That it. I'll we'd"), (3, "a")]
    df = spark.createDataFrame([(i, t, "x", 1, b"k") for i, t in rows], "doc_id long, text string, rep string, label int, key binary")
    assert rows_of(bbit_minhash.link(df)) == near_duplicates(rows)
    assert bbit_minhash.link(df.limit(0)).collect() == []


def test_signatures_estimate_similarity():
    rnd = random.Random(1)
    base = [f"a{i}" for i in range(400)]
    texts = [base]
    for n in (1, 4, 10, 40):
        one = list(base)
        for i in rnd.sample(range(400), n):
            one[i] = f"b{rnd.random()}"
        texts.append(one)
    texts = [" ".join(t) for t in texts]
    values, n = bbit_minhash.minima([bbit_minhash.normal(t) for t in texts])
    sets = [shingle_set(t) for t in texts]
    assert n.tolist() == [len(s) for s in sets]
    packed = bbit_minhash.pack(values)
    got = bbit_minhash.agreeing(packed, np.broadcast_to(packed[0], packed.shape))
    low = values & 15
    assert got.tolist() == (low == low[0]).sum(axis=1).tolist()
    for s, g in zip(sets, got, strict=True):
        exact = len(s & sets[0]) / len(s | sets[0])
        assert abs(bbit_minhash.estimate(g) - exact) < 0.15


def test_bit_counts_in_sql_equal_numpy(spark):
    rnd = np.random.default_rng(0)
    sig = rnd.integers(-(2**63), 2**63 - 1, (40, bbit_minhash._WORDS), dtype=np.int64)
    sig[1::2, ::2] = sig[::2, ::2]
    df = spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in zip(sig[::2], sig[1::2], strict=True)], "a array<long>, b array<long>")
    got = [r[0] for r in df.select(bbit_minhash.agreeing_column("a", "b")).collect()]
    assert got == bbit_minhash.agreeing(sig[::2].copy(), sig[1::2].copy()).tolist()


# --- 12 ---------------------------------------------------------------------------------------


def all_runs(w):
    out = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def run_row(doc, text):
    w = WORDS.findall(text or "")
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and w:
        g, n, o = h // 10, len(w), list(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        for i in range(a, n):
            w[i] = o[a + (i - a) % p]
    runs = all_runs(w)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in drop)
    return (doc, len(runs), *best, milli, sha(listed), sha(kept))


def test_periodic_runs_match_all_periods(spark):
    t = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    want = [run_row(r["doc_id"], r["text"]) for r in t if len(r["text"] or "") < 8000]
    got = {r.doc_id: tuple(r) for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(t)
    assert sum(w[1] for w in want) > 10
    assert [got[w[0]] for w in want] == want


def test_random_runs_match_all_periods():
    rnd = random.Random(4)
    for _ in range(150):
        texts = []
        for _ in range(rnd.randint(1, 5)):
            k = rnd.choice([1, 2, 3, 5, 50])
            w = [b"%d" % rnd.randrange(k) for _ in range(rnd.randint(0, 200))]
            for _ in range(rnd.randint(0, 4) if w else 0):
                a, p = rnd.randrange(len(w)), rnd.randint(1, 30)
                pattern = [b"%d" % rnd.randrange(k) for _ in range(p)]
                m = rnd.randint(1, 120)
                w[a : a + m] = [pattern[i % p] for i in range(m)]
            texts.append(w)
        assert periodic_runs.find_runs(texts) == [all_runs(w) for w in texts]


def test_long_periodic_texts():
    fib, last = b"ab", b"a"
    while len(fib) < 30_000:
        fib, last = fib + last, fib
    assert periodic_runs.find_runs([[b"a"] * 30_000]) == [[(0, 30_000, 1)]]
    assert periodic_runs.find_runs([[b"x%d" % (i % 7001) for i in range(21_003)]]) == [[(0, 21_003, 7001)]]
    letters = [fib[i : i + 1] for i in range(3000)]
    assert periodic_runs.find_runs([letters, letters[:100]]) == [all_runs(letters), all_runs(letters[:100])]


def test_wavelet_matrix():
    rnd = np.random.default_rng(2)
    for n in (1, 2, 63, 64, 65, 1000):
        v = rnd.permutation(n)
        tree = periodic_runs.WaveletMatrix(v)
        lo = rnd.integers(0, n, 50)
        hi = lo + rnd.integers(1, n + 1, 50).clip(max=n - lo)
        x = rnd.integers(0, n + 1, 50)
        assert tree.below(lo, hi, x).tolist() == [int((v[a:b] < c).sum()) for a, b, c in zip(lo, hi, x, strict=True)]
        k = (rnd.random(50) * (hi - lo)).astype(np.int64)
        assert tree.smallest(lo, hi, k).tolist() == [int(np.sort(v[a:b])[c]) for a, b, c in zip(lo, hi, k, strict=True)]


def test_periodic_runs_of_odd_rows(spark):
    rows = [(i if i else None, t, [1], 5) for i, t in enumerate(ODD)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, runs array<int>, other int")
    want = []
    for i, t, _, other in rows:
        w = WORDS.findall(t or "")
        r = [(0, 20_000, 1)] if t == LONG else []
        kept = ["word", w[-1]] if t == LONG else w
        want.append((i, other, len(w), r, " ".join(kept)))
    made = periodic_runs.find(df).collect()
    got = [(r.doc_id, r.other, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in made]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert periodic_runs.find(df.limit(0)).collect() == []


# --- 13 ---------------------------------------------------------------------------------------

SPACE = " \t\n\r\x0b\x0c"


def repaired(turns):
    """The result of ``(turn, role, text)`` in order, by a path search over the grammar's states."""
    kinds, seen = [], set()
    for _, role, text in turns:
        end = text.rstrip(SPACE)
        kinds.append("b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else "")
        seen.add((role, text))

    def with_insertions(states):
        for _ in range(3):
            for a, b in (("0", "u"), ("s", "u"), ("u", "a"), ("a", "u")):
                if a in states:
                    made = (states[a][0] + 3, states[a][1] + "I")
                    states[b] = min(states.get(b, made), made)
        return states

    states = with_insertions({"0": (0, "")})
    for (_, role, _), kind in zip(turns, kinds, strict=True):
        after = {}

        def put(state, cost, audit):
            after[state] = min(after.get(state, (cost, audit)), (cost, audit))  # noqa: B023

        for state, (cost, audit) in states.items():
            put(state, cost + 4, audit + "D")
            if kind in ("b", "d"):
                continue
            cost += 3 if kind == "t" else 0
            if role[:1] == "s" and state == "0":
                put("s", cost, audit + "K")
            to = "a" if state == "u" else "u"
            put(to, cost + (0 if role[:1] == to else 3), audit + ("K" if role[:1] == to else "R"))
        states = with_insertions(after)
    cost, audit = min(states[s] for s in ("0", "a") if s in states)
    out, left, due = [], list(turns), "u"
    for edit in audit:
        role, text = left.pop(0)[1:] if edit != "I" else ("", "")
        if edit == "D":
            continue
        role = role if edit == "K" else {"u": "user", "a": "assistant"}[due]
        if role[:1] != "s":
            due = "a" if due == "u" else "u"
        out.append(f"{role}:{text}")
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
    return (gaps, kinds.count("b"), kinds.count("d"), kinds.count("t"), illegal, cost, audit, sha("\n".join(out)))


def ordered(turns):
    tie = lambda role, text: hashlib.md5(f"{role}:{text}".encode()).hexdigest()
    return sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, tie(t[1], t[2]), t[1], t[2]))


def random_turns(rnd, n):
    out, turn = [], rnd.randint(-3, 3)
    for _ in range(n):
        role = rnd.choice(["user", "assistant", "system", "tool", " ", "user", "assistant"])
        text = rnd.choice(["", " ", "a.", "b", "c!", "d.", "e?", "f.", "g. ", f"h{rnd.randrange(1000)}."])
        out.append((turn if rnd.random() < 0.9 else None, role, text))
        turn += rnd.choice([0, 1, 1, 1, 2])
    return ordered(out)


def columns(made):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return tuple(made[c] for c in names)


def test_repair_matches_path_search():
    rnd = random.Random(9)
    for k in range(1500):
        turns = random_turns(rnd, rnd.randint(1, 9) if k % 100 else rnd.randint(30, 90))
        made = conversation_repair.repair_turns(turns)
        assert columns(made) == repaired(turns), turns
        assert sha(made["repaired"]) == made["repaired_sha256"]


def test_alignment_prefers_the_least_audit():
    assert conversation_repair.repair_code("ua") == (0, "KK")
    assert conversation_repair.repair_code("") == (0, "")
    assert conversation_repair.repair_code("uu") == (3, "KR")
    assert conversation_repair.repair_code("s") == (4, "D")
    assert conversation_repair.repair_code("x") == (4, "D")
    assert conversation_repair.repair_code("u") == (3, "KI")
    assert conversation_repair.align("uuuu", "", 15) is None


def test_long_and_cut_conversations_match_path_search(spark):
    rnd = random.Random(2)
    groups = {i: random_turns(rnd, rnd.randint(1, 8)) for i in range(60)}
    groups[7] = random_turns(rnd, 900)
    groups[None] = random_turns(rnd, 50)
    rows = [(c, *t, "x") for c, turns in groups.items() for t in turns]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tie string").repartition(5)
    want = sorted((str(c), *repaired(t)) for c, t in groups.items())
    for long in (4096, 5):
        made = conversation_repair.repair(df, long=long).collect()
        assert sorted((str(r.conv_id), *columns(r.asDict())) for r in made) == want
        assert all(sha(r.repaired) == r.repaired_sha256 for r in made)


def contract_rows(rows):
    text = lambda v: " " if v is None else str(v)
    out = {r[0]: [] for r in rows}
    for conv, turn, role, said in rows:
        kind = zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        role, said = text(role), text(said)
        if kind == 0:
            continue
        said = "" if kind == 1 else re.sub("[.!?]", "", said) if kind == 2 else said
        role = "user" if kind == 4 else role
        out[conv] += [(turn, role, said)] * (2 if kind == 3 else 1)
    return sorted(((c, *repaired(ordered(t))) for c, t in out.items()), key=str)


def test_repair_query_matches_path_search(spark):
    t = pq.read_table(f"{SF}/conversations.parquet").to_pylist()
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in t]
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    made = queries.op13_conversation_repair(spark, SF)
    assert made.columns == names
    assert rows_of(made) == contract_rows(rows)


def test_repair_query_of_odd_rows(spark, tmp_path):
    rows = [(c, t, r, x) for c in (None, 1, 2) for t in (None, 0, 3) for r in (None, "user", "") for x in (None, "", "a.", LONG)]
    rows += rows[::3] + [(9, None, None, None), (10, 4, "assistant", "ok")]
    schema = "conv_id long, turn long, role string, text string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "conversations.parquet"))
    assert rows_of(queries.op13_conversation_repair(spark, str(tmp_path))) == contract_rows(rows)
    empty = tmp_path / "empty"
    spark.createDataFrame([], schema).write.parquet(str(empty / "conversations.parquet"))
    assert queries.op13_conversation_repair(spark, str(empty)).collect() == []


def test_a_prefix_held_by_many_classes_passes_over_no_pair(spark, tmp_path):
    from hitparade.llm import ngram_join as nj

    rng = np.random.default_rng(5)
    n, base = 40, nj.prefix_depth()
    # one prefix of the first tree is held by all; nothing else is alike but the signatures of pairs
    paths = rng.integers(0, 1 << 16, (n, nj.TREES * nj.DEPTH)).astype("<u2")
    paths[:, :base] = 3
    sig = rng.integers(0, 256, (n, nj.TREES * nj.DEPTH)).astype(np.uint8)
    sig[n // 2 :] = sig[: n // 2]
    keys = [hashlib.blake2b(bytes([i]), digest_size=16).digest() for i in range(n)]
    rows = [(bytearray(k), bytearray(p.tobytes()), bytearray(s.tobytes())) for k, p, s in zip(keys, paths, sig, strict=True)]
    classes = spark.createDataFrame(rows, "key binary, paths binary, sig binary")
    found = {bytes(r.node): bytes(r.label) for r in nj._candidates(classes, str(tmp_path), 8).collect()}
    for i in range(n // 2):
        a, b = keys[i], keys[i + n // 2]
        assert found[a] == found[b] == min(a, b)
