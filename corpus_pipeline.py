"""The corpus pipeline: five stages over ``documents``, each the next one's input.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, written as Parquet and read again as the next stage's
``docs``. All but the last return the columns of ``documents``; ``n_chars`` follows
the text where a stage changes it. ``run`` applies them to the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitparade.llm import decontaminate, ngram_join, queries, secrets
from hitparade.session import scratch_dir

#: Posterior under which a document's language counts as unknown.
MIN_LANGUAGE_SCORE = 0.4


def _apart(docs: DataFrame) -> DataFrame:
    """``docs`` with every column but the text under a name that no operator uses."""
    return docs.select(*[F.col(c) if c == "text" else F.col(c).alias(f"_doc_{c}") for c in docs.columns])


def _back(docs: DataFrame, names: list[str]) -> DataFrame:
    """The columns of ``names`` after ``_apart``; ``n_chars`` counted anew."""
    out = docs.select(*[F.col("text") if c == "text" else F.col(f"_doc_{c}").alias(c) for c in names])
    return _with_length(out).select(*names)


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no language that the model can tell, go. Where no document
    has a label there is nothing to tell languages by, and all documents with letters stay.

    Null and empty texts have no letters; repeated rows are judged alike; extra columns stay."""
    model = queries.fit_language_id(docs.select("doc_id", "text", "lang"))
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    judged = model.predict(_apart(docs))
    kept = judged.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return kept.select(*[F.col(c if c == "text" else f"_doc_{c}").alias(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies stays: the one of the least id. Documents
    without words (null and empty texts) all stay; of repeated rows one stays."""
    return ngram_join.keep_one(docs).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; shorter benchmark spans are cut out of the others. Null and empty
    texts, and all texts where the benchmark is empty, stay as they are."""
    return _back(decontaminate.clean(_apart(docs), queries.table(spark, sf_dir, "benchmark")), docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; every document stays, null texts as null."""
    tables = secrets.fit(spark, docs.select("text"))
    return _back(secrets.redact(secrets.scan(_apart(docs), tables)), docs.columns)


def tokenize_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of the ids and of what they decode to; null and
    empty texts have no ids."""
    made = queries.byte_bpe_operator(spark).round_trip(docs.select("doc_id", "text"))
    return made.select("doc_id", *queries.bpe_digests(made), "ids")


STAGES = [
    ("language_id", language_stage),
    ("ngram_join", near_duplicate_stage),
    ("decontaminate", decontamination_stage),
    ("secret_scan", secret_stage),
    ("byte_bpe", tokenize_stage),
]

#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written under the scratch folder and read again."""
    folder = scratch_dir(spark, "corpus-pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
