"""Token ids in binary shards: frequency-ranked ids in byte-aligned variable-length code with separate control bytes.

Ids are replaced by their rank in the corpus (the most frequent is 0) and written in as few whole bytes as the rank
needs, 1 to 4. Two bits for each id (bytes less one) go to control bytes, four ids in each, apart from the data bytes.
A decoder looks up each control byte in a table of 256 rows that holds the four lengths, so that it works on arrays.

A shard is a Parquet file of blocks, in ascending doc_id order; a block is one row: shard, block, doc_ids, counts (ids of
each document), n_tokens, control, data. The rank table lies beside them. Blocks stand alone, so a reader needs no
other block; files are read and written by Spark alone and so may be in any store it knows.

Edge cases: a null or empty text holds the end id alone; rows with one doc_id follow each other, shorter ones first;
a null doc_id comes first; an empty table gives an empty store; other columns are never looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_type

from loamstack.llm.pretokenize import encoder
from loamstack.llm.store import materialise, new_path

END_ID = 2
BLOCK_TOKENS = 1 << 20
#: Ids of a shard, which one task writes.
SHARD_TOKENS = 4 << 20
BATCH_ROWS = 1000

#: For each control byte the lengths of its four ids.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned ranks below 2**32."""
    ranks = ranks.astype("<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    code = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    code[: len(ranks)] = size - 1
    control = code[0::4] | code[1::4] << 2 | code[2::4] << 4 | code[3::4] << 6
    raw = ranks.view(np.uint8).reshape(-1, 4)
    return control.tobytes(), raw[np.arange(4) < size[:, None]].tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    ends = np.cumsum(size)
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)])
    at, out = ends - size, np.zeros(n, np.uint32)
    for k in range(4):
        inside = np.flatnonzero(size > k) if k else slice(None)
        if k and not len(inside):
            break
        out[inside] |= raw[at[inside] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _tokens(path: str, end_id: int, words: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, words)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                b = whole.slice(at, BATCH_ROWS)
                flat, counts = e.encode([x or "" for x in b.column(1).to_pylist()])
                ends = np.cumsum(counts)
                flat = np.insert(flat, ends, end_id).astype("<u2")
                ends = 2 * np.cumsum(counts + 1)
                ids = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(flat.tobytes())])
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts + 1, pa.int64()), ids], names=["doc_id", "n_tokens", "ids"])

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 16, np.int64)
    for b in batches:
        ids = b.column(0)
        if not len(ids):
            continue
        # All documents of the batch lie one after the other.
        bounds = np.frombuffer(ids.buffers()[1], np.int32, len(ids) + 1, 4 * ids.offset)
        total += np.bincount(np.frombuffer(ids.buffers()[2], "<u2", int(bounds[-1] - bounds[0]) // 2, int(bounds[0])), minlength=1 << 16)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["id", "n"])


_BLOCKS = "shard int, block int, doc_ids array<{}>, counts array<long>, n_tokens long, control binary, data binary"


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, words: bool = False) -> None:
    """Tokenise ``docs`` and write the store to ``path`` (folders ``ranks`` and ``blocks``)."""
    own = docs.select("doc_id", "text")
    kind = own.schema["doc_id"].dataType.simpleString()
    tokens = materialise(own.mapInArrow(_tokens(tokenizer, end_id, words), f"doc_id {kind}, n_tokens long, ids binary"), "token-ids")
    # One row for each id of the vocabulary at most; ties go to the smaller id.
    counted = tokens.select("ids").mapInArrow(_count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    ranks = counted.withColumn("rank", F.row_number().over(W.orderBy(F.desc("n"), "id")) - 1).select("id", "rank", "n")
    ranks.coalesce(1).write.parquet(f"{path}/ranks")
    rank = _rank_array(docs.sparkSession, path)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, block = TaskContext.get().partitionId(), 0
        doc_ids: list = []
        counts: list[int] = []
        parts: list[np.ndarray] = []
        size = 0

        def row() -> pa.RecordBatch:
            control, data = encode_ranks(np.concatenate(parts))
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((shard, block, doc_ids, counts, size, control, data), types, strict=True)], names=names)

        for b in batches:
            if not b.num_rows:
                continue
            for d, n, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                doc_ids.append(d)
                counts.append(n)
                parts.append(rank[np.frombuffer(x.as_buffer(), "<u2")])
                size += n
                if size >= BLOCK_TOKENS:
                    yield row()
                    block, doc_ids, counts, parts, size = block + 1, [], [], [], 0
        if doc_ids:
            yield row()

    arrow = to_arrow_type(own.schema["doc_id"].dataType)
    types = [pa.int32(), pa.int32(), pa.list_(arrow), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary()]
    names = ["shard", "block", "doc_ids", "counts", "n_tokens", "control", "data"]
    total = tokens.agg(F.sum("n_tokens")).first()[0] or 0
    ordered = tokens.repartitionByRange(math.ceil(total / SHARD_TOKENS) or 1, "doc_id", "n_tokens").sortWithinPartitions("doc_id", "n_tokens")
    ordered.mapInArrow(blocks, _BLOCKS.format(kind)).write.parquet(f"{path}/blocks")


def _rank_array(spark: SparkSession, path: str) -> np.ndarray:
    rank = np.zeros(1 << 16, np.uint32)
    for r in spark.read.parquet(f"{path}/ranks").select("id", "rank").collect():
        rank[r["id"]] = r["rank"]
    return rank


def read_store(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids (little-endian unsigned 32 bits)."""
    stored = spark.read.parquet(f"{path}/blocks")
    # A row for each shard, then for each block inside its shard: the running totals never gather documents.
    index = stored.groupBy("shard", "block").agg(F.sum("n_tokens").alias("n"))
    shards = index.groupBy("shard").agg(F.sum("n").alias("n"))
    before = shards.select("shard", F.coalesce(F.sum("n").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inner = F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    first = index.withColumn("inner", inner).join(before, "shard").select("shard", "block", (F.col("inner") + F.col("before")).alias("first"))
    back = np.zeros(1 << 16, np.uint32)
    for i, r in enumerate(_rank_array(spark, path)):
        back[r] = i if r or not back[0] else back[0]
    zero = spark.read.parquet(f"{path}/ranks").filter("rank = 0").select("id").collect()
    back[0] = zero[0]["id"] if zero else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                docs, counts, n, control, data, first = (b.column(k)[i] for k in range(6))
                flat = back[decode_ranks(control.as_py(), data.as_py(), n.as_py())]
                size = np.asarray(counts.values)
                ends = np.cumsum(size)
                raw = memoryview(flat.tobytes())
                parts = [raw[4 * (e - s) : 4 * e] for s, e in zip(size.tolist(), ends.tolist(), strict=True)]
                columns = [docs.values, pa.array(ends - size + first.as_py()), pa.array(size), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(list(map(bytes, parts)), pa.binary())] * ids, names=names + ["ids"] * ids)

    kind = stored.schema["doc_ids"].dataType.elementType.simpleString()
    return stored.join(first, ["shard", "block"]).select("doc_ids", "counts", "n_tokens", "control", "data", "first").mapInArrow(
        run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long" + ", ids binary" * ids)


def stored(docs: DataFrame, tokenizer: str, end_id: int = END_ID, words: bool = False, ids: bool = False) -> DataFrame:
    """Write a store into the shared folder and read it back."""
    path = new_path(docs.sparkSession, "token-store")
    write_store(docs, path, tokenizer, end_id, words)
    return read_store(docs.sparkSession, path, ids)
