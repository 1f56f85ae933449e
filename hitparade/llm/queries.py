"""The queries of the training-data operators, and their SQL where SQL can say the same.

Each query applies its operator with production parameters to its whole table
and derives the contract's digest columns from what the operator returns.
"""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitparade.llm import (
    bbit_minhash,
    byte_bpe,
    conversation_repair,
    decontaminate,
    kd_shards,
    language_id,
    line_crf,
    ngram_join,
    periodic_runs,
    quality_rules,
    secrets,
    token_files,
    url_filter,
    word_bpe,
)
from hitparade.session import scratch_dir

#: Id appended to each document's ids in token files.
END_ID = 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(n: int):
    """crc32 of the document id as text, modulo ``n`` (null for a null id)."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


# --- 1: n-gram Jaccard join -----------------------------------------------------------------


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents")).drop("key")


# --- 2: benchmark decontamination -----------------------------------------------------------


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"), keep_text=False)
    hit = decontaminate.hit_words()
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"),
    )


# --- 3: byte-level BPE ----------------------------------------------------------------------


def byte_bpe_operator(spark: SparkSession) -> byte_bpe.ByteBPE:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.ByteBPE(spark, path, public_tokenizers.PATTERN)


def bpe_digests(df: DataFrame) -> list:
    return [
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = byte_bpe_operator(spark).round_trip(docs)
    return made.select("doc_id", *bpe_digests(made))


# --- 4: URL filter --------------------------------------------------------------------------

# The contract's list (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = url_filter.judge(table(spark, sf_dir, "pages"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
OP4_SQL = rf"""
WITH listed(rule_host, rule_path, verdict) AS (VALUES {_RULE_ROWS}),
parts AS (
    SELECT row_number() OVER () AS rid, page_id,
           translate(regexp_extract(COALESCE(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(COALESCE(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
    FROM pages
), fits AS (
    SELECT rid, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
           arg_max(verdict, length(rule_host || rule_path)) AS verdict
    FROM parts JOIN listed
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY rid
)
SELECT page_id, host, path, rule, COALESCE(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (rid)
"""


# --- 5: language identification -------------------------------------------------------------


def fit_language_id(docs: DataFrame) -> language_id.LanguageID:
    """Learned from the documents whose id hash isn't held out."""
    return language_id.LanguageID.fit(docs.where(F.coalesce(crc_mod(4) != 2, F.lit(True))))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    made = fit_language_id(docs).predict(docs.select("doc_id", "text"), keep_text=False)
    return made.select("doc_id", F.coalesce(crc_mod(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


# --- 6: quality classifier ------------------------------------------------------------------


def op6_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(crc_mod(5) != 0)
    made = line_crf.LineCRF.fit(docs, labels).predict(docs, keep_text=False)
    held_out = F.coalesce(crc_mod(5) == 0, F.lit(False)).alias("held_out")
    return made.select("doc_id", held_out, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


# --- 7: quality rules -----------------------------------------------------------------------


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    made = quality_rules.score(docs, model)
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return made.select("doc_id", *base, "llr")


# --- 8: secret scan -------------------------------------------------------------------------


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.fit(spark, docs))
    count = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(secrets.KINDS[:3])],
        F.sha2(secrets.described("base").cast("binary"), 256).alias("base_sha256"),
        secrets.described("secrets").alias("spans"),
    )


# --- 9: token files -------------------------------------------------------------------------


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    root = scratch_dir(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), root, lambda: word_bpe.encoder(spec.value, END_ID))
    return token_files.read(spark, root).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


# --- 10: sharding ---------------------------------------------------------------------------

SHARDS = 40


def op10_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = kd_shards.assign(table(spark, sf_dir, "documents"), shards=SHARDS)
    return made.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


# --- 11: near duplicates --------------------------------------------------------------------


def op11_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bbit_minhash.link(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP11_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(COALESCE(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), shingled AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [list_aggregate(w, 'string_agg', ' ')]
           ELSE list_distinct(list_transform(generate_series(1, len(w) - 4),
                lambda i: list_aggregate(list_slice(w, i, i + 4), 'string_agg', ' '))) END AS s
    FROM words
), sizes AS (
    SELECT doc_id, len(s) AS n FROM shingled
), items AS (
    SELECT doc_id, unnest(s) AS x FROM shingled
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * c >= 85 * (p.n + q.n - c)
), reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM sizes
    UNION
    SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other
)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
"""


# --- 12: periodic runs ----------------------------------------------------------------------


def with_planted_run(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's damage: in one document of ten, a stretch to the end repeats its first words."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.find(docs, edit=with_planted_run)
    # greatest length / period as an exact comparison of products; ties: least start, then period
    steeper = lambda r, s: (
        F.when(r["length"] * s["period"] != s["length"] * r["period"], F.when(r["length"] * s["period"] > s["length"] * r["period"], -1).otherwise(1))
        .when(r["start"] != s["start"], F.when(r["start"] < s["start"], -1).otherwise(1))
        .otherwise(F.when(r["period"] < s["period"], -1).when(r["period"] > s["period"], 1).otherwise(0))
    )
    top = F.get(F.array_sort("runs", steeper), 0)
    line = lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))
    return found.withColumn("top", top).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.floor(F.expr("1000 * top.length div top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


# --- 13: conversation structure repair ------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage to conversations, by a hash of each row's id and turn."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    kind = F.col("kind")
    made = rows.withColumn("kind", h).where(kind != 0)
    return made.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(text("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text")).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = conversation_repair.repair(damaged(rows), keep_text=False).drop("n_rows")
    ids = rows.select(F.col("conv_id").alias("_id")).distinct()
    out = ids.join(made.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        F.col("_id").alias("conv_id"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_decontaminate": op2_decontaminate,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_url_filter": op4_url_filter,
    "op5_language_id": op5_language_id,
    "op6_quality_crf": op6_quality_crf,
    "op7_quality_rules": op7_quality_rules,
    "op8_secret_scan": op8_secret_scan,
    "op9_token_files": op9_token_files,
    "op10_kd_shards": op10_kd_shards,
    "op11_bbit_minhash": op11_bbit_minhash,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL = {"op4_url_filter": OP4_SQL, "op11_bbit_minhash": OP11_SQL}
