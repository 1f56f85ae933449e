"""The corpus pipeline against a brute-force version of its stages, and odd rows."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import tiktoken

import corpus_pipeline
from hitparade.llm import byte_bpe, decontaminate, queries
from tests.llm.test_operators import ODD, SF, brute_contamination, brute_join, brute_secrets


def test_stages_match_brute_force(spark):
    d = pq.read_table(f"{SF}/documents.parquet").to_pandas()
    b = pq.read_table(f"{SF}/benchmark.parquet").to_pandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = dict(zip(d.doc_id, d.text))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "ngram_join", "decontaminate", "secret_scan", "byte_bpe"]
    # language: the model's own predictions, the rule applied by hand
    model = queries.fit_language_id(docs)
    langs, scores = model.score(d.text.tolist())
    kept = [i for i, x, s in zip(d.doc_id, langs, scores) if x != "und" and s >= corpus_pipeline.MIN_LANGUAGE_SCORE]
    assert len(kept) > 0.97 * len(d)
    # near duplicates
    kept = [doc for doc, group, _, _ in brute_join([(i, text[i]) for i in kept]) if doc == group]
    # contamination: contaminated documents go, spans of the others are cut
    left = {}
    items = [(str(i), decontaminate.words_of(t)) for i, t in zip(b.item_id, b.text)]
    automaton = decontaminate.Automaton(items)
    for doc, n, hit, _ in brute_contamination([(i, text[i]) for i in kept], zip(b.item_id, b.text)):
        if hit == 0 or 20 * hit < n:
            spans, _ = automaton.scan(decontaminate.words_of(text[doc]))
            assert sum(e - a for a, e in spans) == hit
            left[doc] = decontaminate.cut(text[doc], [x for s in spans for x in s])
    # secrets are masked
    for doc, t in left.items():
        out, at = "", 0
        for _, a, e in brute_secrets(t):
            if a >= at:
                out += t[at:a] + "[SECRET]"
            at = max(at, e)
        left[doc] = out + t[at:]
    enc = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")),
        special_tokens={},
    )
    want = set()
    for doc, t in left.items():
        ids = np.array(enc.encode_ordinary(t), "<u4").tobytes()
        digest = [hashlib.sha256(x).hexdigest() for x in (ids, t.encode())]
        want.add((doc, len(ids) // 4, *digest, ids))
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {(*tuple(r)[:4], bytes(r.ids)) for r in rows} == want
    assert len(rows) == len(want)


def test_stages_on_odd_and_empty_tables(spark, tmp_path):
    rows = [(i if i else None, t, None if i % 2 else "en", "s", None, 7.0) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame([*rows, rows[-1]], "doc_id long, text string, lang string, source string, n_chars long, score double")
    for name, n in (("odd", 100), ("empty", 0)):
        sf = str(tmp_path / name)
        spark.createDataFrame([(1, None), (None, "that it")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
        for at, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs.limit(n), sf)
            assert at == "byte_bpe" or out.columns == docs.columns
            got = out.collect()
            assert n or not got
            if n and at == "ngram_join":
                assert sorted(str(r.doc_id) for r in got) == ["1", "2", "3", "4", "5", "6", "None"]
            if n and at == "language_id":
                assert {r.doc_id for r in got} <= {3, 4, 5, 6, 7}
            if n and at == "secret_scan":
                assert len(got) == len(rows) + 1


def test_language_stage_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, docs, SF).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    gone = [t for i, t in texts.items() if i not in kept]
    assert all(len(t) < 40 for t in gone), gone


def test_language_stage_of_unlabelled_documents(spark):
    rows = [(i, t, None, "s", 1) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id for r in corpus_pipeline.language_stage(spark, docs, SF).collect()}
    assert got == {i for i, t in enumerate(ODD) if t and any(c.isalpha() for c in t)}


def test_clean_in_one_pass_equals_span_removal(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    one = decontaminate.clean(docs, bench).collect()
    assert "ArrowEvalPython" not in decontaminate.clean(docs, bench)._jdf.queryExecution().toString()
    apart = decontaminate.remove_spans(decontaminate.scan(docs, bench)).select(*one[0].asDict()).collect()
    grouped = decontaminate.clean(docs, bench, max_group_words=300).select(*one[0].asDict()).collect()
    assert sorted(one, key=str) == sorted(apart, key=str) == sorted(grouped, key=str)
    assert len(one) < docs.count()
