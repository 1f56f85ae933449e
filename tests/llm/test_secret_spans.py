"""Secret scan: base spans, the method's spans and the masked text against brute force."""

import base64
import hashlib
import random
import re

from hitparade.llm import secrets

FORMS = [(secrets.ASSIGN, 2, 8), (secrets.ACCESS, 0, 16), (r"[0-9a-f]+", 0, 32)]


def _hex(i):
    return hashlib.sha256(str(i).encode()).hexdigest()


def _b64(i):
    return base64.b64encode(hashlib.sha256(str(i).encode()).digest()).decode()


def _text(rnd, n):
    forms = [
        lambda i: _hex(i)[: rnd.randint(20, 64)],
        _b64,
        lambda i: f'password = "{_b64(i)[: rnd.randint(4, 30)]}"',
        lambda i: "AKIA" + _hex(i)[:20].upper(),
        lambda i: "plain words é",
        lambda i: "some_identifier_name_here_long",
    ]
    return " ".join(rnd.choice(forms)(i) + rnd.choice(["", "/", "=", " "]) for i in range(n))


def _brute(text, tables):
    base = sorted(
        (m.start(), k, m.end())
        for k, (pattern, group, least) in enumerate(FORMS)
        for m in re.finditer(pattern, text)
        if len(m.group(group)) >= least
    )
    more = []
    for m in re.finditer(f"{secrets.RUN}{{{secrets.MIN_LENGTH},}}", text):
        run = m.group()
        best = max(sum(t[128 * ord(a) + ord(b)] for a, b in zip(run, run[1:])) for t in tables)  # noqa: B905
        random_run = best >= secrets.MIN_TOTAL and best >= secrets.MIN_MEAN * (len(run) - 1)
        if random_run and not any(b < m.end() and m.start() < e for b, _, e in base):
            more.append((m.start(), 3, m.end()))
    spans = sorted(base + more)
    out, at = "", 0
    for begin, _, end in spans:
        if begin >= at:
            out += text[at:begin] + secrets.MASK
        at = max(at, end)
    return base, spans, out + text[at:]


def test_spans_and_masked_text_equal_brute_force(spark):
    rnd = random.Random(3)
    # more matches than one block holds, in the last ones
    texts = [_text(rnd, n) for n in (0, 1, 2, 5, 30, secrets.BLOCK, 700)] + [None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tables = secrets.fit(spark, docs)
    scanned = secrets.scan(docs, tables)
    masked = {r.doc_id: r.text for r in secrets.redact(scanned).collect()}
    for r in scanned.collect():
        base, spans, text = _brute(r.text or "", tables)
        assert [tuple(s) for s in r.base] == base
        assert [tuple(s) for s in r.secrets] == spans
        assert (masked[r.doc_id] or "") == text
    assert masked[7] is None


def test_a_text_of_very_many_matches(spark):
    text = " ".join(_hex(i) for i in range(20_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    tables = secrets.fit(spark, docs.limit(0))
    assert secrets.redact(secrets.scan(docs, tables)).first().text == " ".join([secrets.MASK] * 20_000)
