"""Registered queries of the text operators: thin, whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.llm.bin_completion import pack_documents
from ontime.llm.cgk_decontam import contaminated
from ontime.llm.common import read
from ontime.llm.exact_runs import exact_dedup
from ontime.llm.fill_middle import ORACLE_SQL as FILL_SQL
from ontime.llm.fill_middle import fill_in_middle, restore
from ontime.llm.fuzzy_lines import dedup_lines
from ontime.llm.html_blocks import extract
from ontime.llm.robust_outliers import quality
from ontime.llm.secret_scan import KINDS, scan, spans_text
from ontime.llm.secret_scan import ORACLE_SQL as SECRETS_SQL
from ontime.llm.simhash_trie import near_duplicates
from ontime.llm.suffix_tree_lm import score as lm_score
from ontime.llm.token_trie import token_counts
from ontime.llm.toxic_segments import THRESHOLD, fit, score
from ontime.llm.turn_repair import ORACLE_SQL as TURNS_SQL
from ontime.llm.turn_repair import digests, repair

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query("op1_html_blocks")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))


@query("op2_simhash_trie")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


@query("op3_exact_runs", """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"), keep_largest=True)


@query("op4_fuzzy_lines")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "text")


@query("op5_token_trie")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op6_secret_scan", SECRETS_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"].isin(KINDS[:3]))
    return scan(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"))


# op7, op8: rows without an id fall in no fold; they are not learnt from and their held_out is null.
@query("op7_toxic_segments")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = read(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 3
    model = fit(docs, read(spark, sf_dir, "labels"), training=fold != 1)
    return score(docs, model).select(
        "doc_id", (fold == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("n_passages"))


@query("op8_suffix_tree_lm")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string")) % 7
    found = lm_score(read(spark, sf_dir, "documents"), training=fold != 2)
    return found.select("doc_id", (fold == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
                        "score")


def word_tokenizer() -> str:
    """Path of the public word-level BPE vocabulary the packing contract names."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op9_bin_completion")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), word_tokenizer())


@query("op10_cgk_decontam")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def damage(turns: DataFrame) -> DataFrame:
    """The damage the repair is measured on: by a checksum of ``conv_id:turn``, a row in 20 goes, and so on."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    deal = F.crc32(F.concat_ws(":", part("conv_id"), part("turn"))) % 20
    text = F.coalesce("text", F.lit(" "))
    rows = turns.withColumn("deal", deal).filter("deal <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("deal") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("deal") == 1, "").when(F.col("deal") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("deal") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


@query("op11_turn_repair", TURNS_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations")
    report, turns = repair(damage(given))
    hashes = digests(turns).select(F.col("conv_id").alias("h"), "sha256")
    ids = given.select(F.col("conv_id").alias("id")).distinct()
    out = ids.join(report, F.col("id").eqNullSafe(F.col("conv_id")), "left") \
        .join(hashes, F.col("id").eqNullSafe(F.col("h")), "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(F.col("id").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@query("op12_fill_middle", FILL_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                        F.sha2(restore("output", "form"), 256).alias("restored_sha256"))


@query("op13_robust_outliers")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
