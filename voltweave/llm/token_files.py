"""Token ids on disk, each in the fewest bits that hold the vocabulary.

A file set is a Parquet folder of blocks. A block holds whole documents in order: their ids packed at a
fixed width (``payload``), where each begins (``doc_starts``, in ids), how many ids come before the block
in its shard (``first``). Shards follow each other in document order. Id number k of a block lies at bit
k * width, so any range of ids is unpacked with numpy without touching the rest.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltweave.llm.common import bounded_slices, partitions
from voltweave.llm.encoding import encoder

BLOCK_IDS = 1 << 18
SLICE_BYTES = 8 << 20
BLOCK = ("shard long, block long, first long, n_ids long, width int, doc_ids array<bigint>, "
         "doc_starts array<bigint>, payload binary")


def id_width(path: str) -> int:
    """Bits that hold every id of a tokenizer file."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    ids = list(made["model"]["vocab"].values()) + [t["id"] for t in made["added_tokens"]]
    return max(1, int(max(ids)).bit_length())


def pack_ids(ids: np.ndarray, width: int) -> bytes:
    """Ids one after the other at ``width`` bits, lowest bit first."""
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id does not fit into {width} bits")
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype("<u4")[:, None] >> np.arange(width, dtype="<u4")) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_ids(payload: bytes, width: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a payload; only the bytes that hold them are read."""
    if stop <= start:
        return np.empty(0, dtype="<u4")
    if width in (8, 16, 32):
        return np.frombuffer(payload, dtype=f"<u{width // 8}", count=stop - start, offset=start * width // 8).astype("<u4")
    low, high = start * width, stop * width
    raw = np.frombuffer(payload, dtype=np.uint8)[low // 8:-(-high // 8)]
    bits = np.unpackbits(raw, bitorder="little")[low % 8:low % 8 + (stop - start) * width].reshape(-1, width)
    return (bits.astype("<u4") << np.arange(width, dtype="<u4")).sum(axis=1, dtype="<u4")


def _writer(path: str, end_id: int, width: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, shard = encoder(path), TaskContext.get().partitionId()
        block, first = 0, 0
        docs: list[int | None] = []
        sizes: list[int] = []
        parts: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            nonlocal block, first, docs, sizes, parts
            ids = np.concatenate(parts)
            starts = np.cumsum(sizes) - sizes
            row = [[shard], [block], [first], [len(ids)], [width], [docs], [starts.tolist()], [pack_ids(ids, width)]]
            types = [pa.int64()] * 4 + [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            names = ["shard", "block", "first", "n_ids", "width", "doc_ids", "doc_starts", "payload"]
            block, first, docs, sizes, parts = block + 1, first + len(ids), [], [], []
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=names)

        end, held = np.array([end_id], dtype="<u4"), 0
        for batch in batches:
            for part in bounded_slices(batch, "text", SLICE_BYTES):
                ids, offsets = tool.encode(part.column("text"))
                for doc, a, b in zip(part.column("doc_id").to_pylist(), offsets, offsets[1:]):
                    docs.append(doc)
                    sizes.append(int(b - a) + 1)
                    parts += [ids[a:b], end]
                    held += sizes[-1]
                    if held >= BLOCK_IDS:
                        held = 0
                        yield close()
        if docs:
            yield close()

    return write


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, path: str) -> None:
    """Encode every whole text, append ``end_id`` and write the ids in ascending doc_id order under ``path``.

    Null ids come first, a null text is empty; rows with equal ids are ordered by their text. An empty
    table writes an empty file set. Other columns are not read.
    """
    spark = docs.sparkSession
    width = max(id_width(tokenizer_path), int(end_id).bit_length())
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = narrow.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_writer(tokenizer_path, end_id, width), BLOCK).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``start``: how many ids of the whole set come before the block."""
    blocks = spark.read.schema(BLOCK).parquet(path)
    # One row per shard, that is per sort partition, whatever the size of the data.
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("__n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    return blocks.join(F.broadcast(offsets), "shard").select("*", (F.col("first") + F.col("__before")).alias("start")).drop("__before")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        for r in batch.to_pylist():
            bounds = [*r["doc_starts"], r["n_ids"]]
            for doc, a, b in zip(r["doc_ids"], bounds, bounds[1:]):
                ids = unpack_ids(r["payload"], r["width"], a, b)
                rows.append((doc, r["start"] + a, b - a, zlib.crc32(ids.tobytes())))
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens and the crc32 of its ids as 32-bit integers."""
    return read_blocks(spark, path).select("start", "n_ids", "width", "doc_ids", "doc_starts", "payload").mapInArrow(
        _digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def random_ids(spark: SparkSession, path: str, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of the whole set; reads the blocks that hold them, and of those only the range."""
    hit = read_blocks(spark, path).where((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start))
    got = [unpack_ids(r["payload"], r["width"], max(0, start - r["start"]), min(r["n_ids"], stop - r["start"]))
           for r in hit.orderBy("start").collect()]
    return np.concatenate(got) if got else np.empty(0, dtype="<u4")
