"""From raw documents to packed training sequences: five stages, each written as Parquet and read again.

1. quality: documents scored below the threshold go (a null text is scored as empty).
2. near_duplicates: of each component of documents that share 80 % of their five-word shingles, the
   smallest doc_id stays; documents without words all stay.
3. decontamination: documents that hold a ten-word phrase of the benchmark go.
4. secrets: values that look live are overwritten; copied examples stay, no document goes.
5. packing: what is left is tokenised and packed into sequences of at most 1024 tokens.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from voltweave.llm import catalog, decontamination, jaccard, packing, quality, secret_scan
from voltweave.llm.common import table
from voltweave.sources.staging import stage

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
SEQUENCE_TOKENS = 1024
# All stages share the executors: whole texts travel in smaller Arrow batches, and the encoder keeps fewer pieces
# and takes less text at once.
BATCH_ROWS = 1000
CACHE_PIECES = 60_000
SLICE_BYTES = 1 << 20

ORACLE_SQL = None  # tokenizers and votes are beyond SQL; tests compare every stage with a plain version


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score well; learns from those of its input that have labels. Null texts score as empty,
    repeated rows each for themselves; an empty table stays empty."""
    _small_batches(spark)
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component; repeated rows become one, documents without words all stay."""
    _small_batches(spark)
    return jaccard.one_per_component(docs, k=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark phrase; null texts have none and stay."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking secrets overwritten; null texts stay as they are."""
    return secret_scan.redacted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece; a null or empty text is a piece of the end id alone, repeated rows are packed one by one."""
    _small_batches(spark)
    return packing.pack(docs, catalog.tokenizer(TOKENIZER), END_ID, SEQUENCE_TOKENS, CACHE_PIECES, SLICE_BYTES)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return reduce(lambda docs, named: stage(named[1](spark, docs, sf_dir), named[0]), STAGES, table(spark, sf_dir, "documents"))
