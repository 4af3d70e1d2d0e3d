"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltweave.llm.common import table
from voltweave.sources.staging import staging_root

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/voltweave/{name}-{uuid.uuid4().hex}"


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


from voltweave.llm import centroids, decontamination, filter_audit, jaccard, language_model, neighbours, packing, quality  # noqa: E402
from voltweave.llm import repeats, secret_scan, simhash, token_counts, token_files  # noqa: E402


@query("op1_jaccard_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.linked_components(table(spark, sf_dir, "documents"), k=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


@query("op2_tree_neighbours")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


@query("op3_token_files")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), 1, folder)
    return token_files.read_documents(spark, folder)


@query("op4_decontamination", decontamination.REPORT_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_secret_scan", secret_scan.REPORT_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


@query("op6_quality_voting")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_pitman_yor")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(table(spark, sf_dir, "documents"))


@query("op8_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The size is taken before the join on digests, so that no text goes through it.
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", size.alias("n_bytes"))
    counted = token_counts.token_counts(docs, tokenizer("byte_bpe_50k.json"), fresh_folder(spark, "token-cache"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


@query("op9_repeat_removal")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(table(spark, sf_dir, "documents"), 100)


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), 2, 1024)


@query("op11_filter_audit", filter_audit.REPORT_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_simhash_dedup")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"), k=3, radius=2)


@query("op13_sharded_lloyd", centroids.CLUSTER_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3)
