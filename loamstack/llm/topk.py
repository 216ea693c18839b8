"""Exact top-k search by inner product: tiled matrix products, partial selection in each tile, tree merge.

Queries and candidates are dealt into blocks of bounded size; a tile is one query block against the candidates of one
slot. A tile multiplies two matrices, keeps the k best of each query, and the short lists are merged sixteen at a
time. Nothing is broadcast: each query block is copied to the slots and each candidate once for every query block.

Components become floor(scale * x) and scores are exact integers (float64 products while they are below 2**53,
otherwise Python integers, held to the range of a long). Edge cases: vectors that are null, empty, or hold null or
non-finite components take no part; vectors of different lengths are not compared; a candidate with the query's own
id is not compared; ties go to the smaller id; repeated rows are separate candidates and one query; a null id takes no part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUERY_BLOCK = 1024
SLOT_ROWS = 32_768
SHARD = 8192
FAN_IN = 16

_OUT = "query_id long, query_key long, slot int, top array<struct<score:long,order:long>>"


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    v = F.col("embedding")
    usable = F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).filter(usable).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x * F.lit(float(scale))).cast("double")).alias("v"))


def _matrix(column: pa.ChunkedArray, rows: np.ndarray, dim: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().take(pa.array(rows)).flatten()).reshape(len(rows), dim)


def _best(q: np.ndarray, c: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best scores and columns of each row of q @ c.T, ties to the column that comes first; -1 pads."""
    exact = float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1] < 2**53 / max(len(c), 2)
    if exact:
        scores = (q @ c.T).astype(np.int64)
        key = scores * len(c) + np.arange(len(c) - 1, -1, -1)
        low = np.iinfo(np.int64).min + 1  # the least number whose negative is a long too
    else:
        big = lambda m: np.array([[int(x) for x in r] for r in m], dtype=object)
        scores = np.clip(big(q) @ big(c).T, -(2**63), 2**63 - 1)
        key = scores * len(c) + np.arange(len(c) - 1, -1, -1)
        low = -(2**200)
    key[own[:, None] == ids[None, :]] = low
    k = min(k, len(c))
    top = np.argpartition(-key, k - 1, axis=1)[:, :k] if exact else np.argsort(-key, axis=1)[:, :k]
    kept = np.take_along_axis(key, top, 1)
    at = np.argsort(-kept, axis=1, kind="stable")
    top = np.take_along_axis(top, at, 1)
    return np.take_along_axis(scores, top, 1), np.where(np.take_along_axis(key, top, 1) == low, -1, top)


def _tile(k: int):
    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            sides = []
            for t, name in ((left, "vec_id"), (right, "cand_id")):
                t = t.sort_by(name).combine_chunks()
                sides.append((t, np.asarray(t[name]), pc.list_value_length(t["v"].combine_chunks()).to_numpy(zero_copy_only=False)))
            (lt, lid, ld), (rt, rid, rd) = sides
            slot = right["c_slot"][0].as_py()
            keys = np.asarray(lt["query_key"])
            for dim in np.intersect1d(ld, rd):
                lrows = np.flatnonzero(ld == dim)
                q, found = _matrix(lt["v"], lrows, dim), [[] for _ in lrows]
                rrows = np.flatnonzero(rd == dim)
                for at in range(0, len(rrows), SHARD):
                    part = rrows[at : at + SHARD]
                    scores, cols = _best(q, _matrix(rt["v"], part, dim), lid[lrows], rid[part], k)
                    for i, (s, c) in enumerate(zip(scores, cols, strict=True)):
                        found[i] = sorted(found[i] + [(int(x), -int(rid[part[y]])) for x, y in zip(s, c, strict=True) if y >= 0], reverse=True)[:k]
                out += [(int(lid[r]), int(keys[r]), slot, [{"score": s, "order": o} for s, o in f]) for r, f in zip(lrows, found, strict=True) if f]
        kind = pa.struct([("score", pa.int64()), ("order", pa.int64())])
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.list_(kind))],
                        names=["query_id", "query_key", "slot", "top"])

    return tile


def search(queries: DataFrame, vectors: DataFrame, k: int = 10, scale: int = 1024) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows of ``vectors`` for each row of ``queries``."""
    q = quantised(queries, scale).withColumn("query_key", F.xxhash64("vec_id", "v")).dropDuplicates(["vec_id", "query_key"])
    c = quantised(vectors, scale)
    blocks = max(1, math.ceil(q.count() / QUERY_BLOCK))
    slots = max(1, math.ceil(c.count() / SLOT_ROWS), min(64, 2 * q.sparkSession.sparkContext.defaultParallelism // blocks))
    left = q.withColumn("block", F.pmod(F.xxhash64("query_key", "vec_id"), F.lit(blocks)).cast("int")).withColumn(
        "slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    # The row's own content and number spread repeated ids over the slots.
    right = c.select(F.col("vec_id").alias("cand_id"), F.col("v").alias("v"), F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(slots)).cast("int").alias("c_slot")).withColumn(
        "c_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    tops = left.groupBy("block", "slot").cogroup(right.groupBy("c_block", "c_slot")).applyInArrow(_tile(k), _OUT)
    while True:
        slots = math.ceil(slots / FAN_IN)
        tops = (tops.groupBy("query_id", "query_key", F.floor(F.col("slot") / FAN_IN).cast("int").alias("slot"))
                .agg(F.slice(F.sort_array(F.flatten(F.collect_list("top")), asc=False), 1, k).alias("top")))
        if slots <= 1:
            break
    return tops.select("query_id", F.posexplode("top").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), (-F.col("hit.order")).alias("vec_id"), F.col("hit.score").alias("score"))
