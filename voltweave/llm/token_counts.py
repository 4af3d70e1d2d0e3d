"""Token counts from a digest cache.

The cache is a Parquet folder of (digest, version, n_tokens): the digest of a text and of the tokenizer
file. Texts are joined to it by both digests; each distinct missing text is encoded once and appended.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from voltweave.llm.common import bounded_slices, free_name
from voltweave.llm.encoding import encoder

CACHE_SCHEMA = StructType([
    StructField("digest", StringType()), StructField("version", StringType()), StructField("n_tokens", LongType()),
])
SLICE_BYTES = 2 << 20
CACHE_PIECES = 150_000  # of the encoder in a worker, beside a sort of whole texts in the same executor


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file; another file or another edit of it never hits the same entries."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """The stored counts; a cache that does not exist yet is made as an empty table."""
    empty = spark.createDataFrame([], CACHE_SCHEMA)
    empty.write.mode("append").parquet(cache)
    return spark.read.schema(CACHE_SCHEMA).parquet(cache)


def _counter(path: str, version: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path, CACHE_PIECES)
        for batch in batches:
            for part in bounded_slices(batch, "text", SLICE_BYTES):
                _, offsets = tool.encode(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("digest"), pa.array([version] * part.num_rows, pa.string()), pa.array(np.diff(offsets))],
                    names=["digest", "version", "n_tokens"],
                )

    return count


def token_counts(docs: DataFrame, tokenizer_path: str, cache: str, text: str = "text", count: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of every whole text, no special tokens added.

    A null text counts as empty (0 tokens). Repeated rows and equal texts share one cache entry and are
    encoded once. An empty table gives an empty result. A column of ``docs`` called like ``count`` is
    replaced. Runs twice on the same ``cache`` encode nothing the second time.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer_path)
    content = F.coalesce(F.col(text), F.lit(""))
    # The normal form of a content is its UTF-8 bytes, null as none: byte-exact, as tokenizers see spaces and case.
    own, n = free_name(docs, "__digest"), free_name(docs, "__n")
    digested = docs.drop(count).withColumn(own, F.sha2(content.cast("binary"), 256))
    stored = read_cache(spark, cache).where(F.col("version") == version)
    missing = (
        docs.select(F.sha2(content.cast("binary"), 256).alias("digest"), content.alias("text"))
        .join(stored.select("digest"), "digest", "left_anti")
        .groupBy("digest").agg(F.first("text").alias("text"))  # copies combine before the shuffle
    )
    missing.mapInArrow(_counter(tokenizer_path, version), CACHE_SCHEMA).write.mode("append").parquet(cache)
    # After a crash between two appends an entry may be stored twice; equal entries are one.
    known = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("version") == version)
    known = known.groupBy("digest").agg(F.max("n_tokens").alias(n))
    joined = digested.alias("d").join(known.alias("k"), F.col(f"d.{own}") == F.col("k.digest"), "left")
    keep = [F.col(f"d.`{name}`") for name in docs.columns if name != count]
    return joined.select(*keep, F.col(f"k.{n}").alias(count))
