"""Packing of tokenised documents into sequences of at most ``CAPACITY`` tokens by a linear grouping scheme.

Pieces of one length are interchangeable, so the packing is solved on the histogram of lengths (at most CAPACITY
counts, however large the corpus) and then carried out by joins:

1. Large lengths (over ``capacity // small``) are put, longest first, into groups of equal cardinality and rounded up
   to the longest of their group, which leaves ``groups`` sizes.
2. Configurations of those few sizes are chosen by a knapsack that fills a sequence as far as it can, each used as
   often as its sizes last.
3. The actual lengths take the places of their group, longest first; sequences that receive the same lengths stay one
   run (first number, count).
4. Small lengths go, longest first, to the open run with the least room that still holds them (best fit), many
   sequences at a time; what is left opens new sequences.

The numbers of groups and the bound of small lengths in ``SCHEMES`` are tried in turn; the plan with fewest sequences is used.

The result is a table of slots (length, first rank, count, first sequence, offset). Pieces are ranked within their
length in two steps, by hash bucket and then inside the bucket, so that a length that a third of all pieces share is
spread over many tasks, and each takes the place of its rank.

Edge cases: a null or empty text is one piece that holds only the end id; an empty table gives an empty result;
repeated rows are packed each; other columns are never looked at. Ids are below 2**16 in the vocabularies used.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_type

from loamstack.llm.pretokenize import encoder
from loamstack.llm.store import materialise

CAPACITY = 4096
END_ID = 1
#: (groups, small): lengths up to capacity // small are small.
SCHEMES = ((16, 4), (48, 4), (128, 4), (400, 4), (48, 2))
BUCKET_ROWS = 50_000
BATCH_ROWS = 1000


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = True, words: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids (binary, little-endian unsigned 32 bits)."""
    own = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, words)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                b = whole.slice(at, BATCH_ROWS)
                flat, counts = e.encode([x or "" for x in b.column(1).to_pylist()])
                doc_ids, ends, rows = b.column(0).to_pylist(), np.cumsum(counts), []
                for d, n, end in zip(doc_ids, counts.tolist(), ends.tolist(), strict=True):
                    data = np.append(flat[end - n : end], end_id).astype("<u4").tobytes()
                    for i, s in enumerate(range(0, n + 1, capacity)):
                        part = data[4 * s : 4 * (s + capacity)]
                        rows.append((d, i, s, len(part) // 4, zlib.crc32(part), part if ids else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)

    id_type = own.schema["doc_id"].dataType
    _ARROW = pa.schema([("doc_id", to_arrow_type(id_type)),
                        ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])
    out = own.mapInArrow(run, f"doc_id {id_type.simpleString()}, piece int, start long, length long, ids_crc32 long, ids binary")
    return out if ids else out.drop("ids")


class _Runs:
    """Sequences in runs: for each room the runs (first sequence, count, offset) that have it."""

    def __init__(self) -> None:
        self.open: dict[int, list[tuple[int, int]]] = {}
        self.slots: list[tuple[int, int, int, int, int]] = []
        self.next = 0

    def new(self, count: int) -> int:
        self.next += count
        return self.next - count

    def close(self, room: int, first: int, count: int) -> None:
        if room:
            self.open.setdefault(room, []).append((first, count))


def _configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """(how many of each size, how often), longest first; every size is used up."""
    left, out = list(counts), []
    for i, size in enumerate(sizes):
        while left[i]:
            # The fullest sequence with at least one of this size: bounded knapsack over the sizes that are left.
            room = capacity - size
            best: dict[int, dict[int, int]] = {0: {}}
            for j in range(i, len(sizes)):
                avail = left[j] - (j == i)
                if not avail:
                    continue
                for fill in list(best):
                    used, n = best[fill], 1
                    while n <= avail and fill + n * sizes[j] <= room:
                        best.setdefault(fill + n * sizes[j], used | {j: n})
                        n += 1
                if room in best:
                    break
            pick = dict(best[max(best)])
            pick[i] = pick.get(i, 0) + 1
            times = min(left[j] // n for j, n in pick.items())
            for j, n in pick.items():
                left[j] -= n * times
            out.append(([j for j, n in sorted(pick.items()) for _ in range(n)], times))
    return out


def best_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    return min((plan(histogram, capacity, *x) for x in SCHEMES), key=lambda p: p[1])


def plan(histogram: dict[int, int], capacity: int, groups: int, small: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Slots (length, first rank, count, first sequence, offset) for all pieces, and the number of sequences."""
    runs, rank = _Runs(), dict.fromkeys(histogram, 0)

    def put(length: int, first: int, count: int, offset: int) -> None:
        runs.slots.append((length, rank[length], count, first, offset))
        rank[length] += count

    large = sorted((x for x in histogram if x > capacity // small), reverse=True)
    whole = histogram.get(capacity, 0)
    if whole:
        put(capacity, runs.new(whole), whole, 0)
    large = [x for x in large if x < capacity]
    total = sum(histogram[x] for x in large)
    each = max(1, math.ceil(total / groups))
    stock: list[list[list[int]]] = []  # for each group [length, count], longest first
    room_in = 0
    for x in large:
        n = histogram[x]
        while n:
            if not room_in:
                stock.append([])
                room_in = each
            take = min(n, room_in)
            stock[-1].append([x, take])
            n, room_in = n - take, room_in - take
    sizes, counts = [g[0][0] for g in stock], [sum(c for _, c in g) for g in stock]
    for config, times in _configurations(sizes, counts, capacity):
        while times:
            # As many sequences as can take the same actual lengths.
            need: dict[int, list[int]] = {}
            for g in config:
                need.setdefault(g, []).append(0)
            step, chosen = times, []
            for g, places in need.items():
                head = stock[g][0]
                if head[1] >= len(places):
                    step = min(step, head[1] // len(places))
                    chosen += [(g, 0)] * len(places)
                else:
                    step, at, used = 1, 0, 0
                    for _ in places:
                        while stock[g][at][1] <= used:
                            at, used = at + 1, 0
                        chosen.append((g, at))
                        used += 1
            first, offset = runs.new(step), 0
            for length in sorted((stock[g][at][0] for g, at in chosen), reverse=True):
                put(length, first, step, offset)
                offset += length
            for g, at in chosen:
                stock[g][at][1] -= step
            for g in need:
                stock[g] = [x for x in stock[g] if x[1]]
            runs.close(capacity - offset, first, step)
            times -= step
    for x in sorted((x for x in histogram if x <= capacity // small), reverse=True):
        n = histogram[x]
        while n:
            room = min((r for r in runs.open if r >= x), default=0)
            if not room:
                count = math.ceil(n / (capacity // x))
                runs.close(capacity, runs.new(count), count)
                continue
            first, count = runs.open[room].pop()
            if not runs.open[room]:
                del runs.open[room]
            take = min(n, count)
            put(x, first, take, capacity - room)
            runs.close(room - x, first, take)
            if take < count:
                runs.close(room, first + take, count - take)
            n -= take
    return runs.slots, runs.next


_SLOTS = "length long, first_rank long, n long, first_sequence long, offset long"


def ranked(items: DataFrame, per_bucket: int = BUCKET_ROWS) -> DataFrame:
    """``items`` with ``rank`` from 0 within each length, dealt over hash buckets of about ``per_bucket`` rows."""
    buckets = max(1, math.ceil(items.count() / per_bucket))
    dealt = items.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(buckets)).cast("int"))
    before = F.sum("n").over(W.partitionBy("length").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1))
    first = dealt.groupBy("length", "_bucket").agg(F.count("*").alias("n")).select("length", "_bucket", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32"))
    return dealt.withColumn("_inside", inside).join(first, ["length", "_bucket"]).withColumn("rank", F.col("_before") + F.col("_inside") - 1).drop("_bucket", "_before", "_inside")


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``items`` (doc_id, piece, start, length, ids_crc32, ...) with sequence_id and offset. Reads ``items`` three times."""
    spark = items.sparkSession
    histogram = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, _ = best_plan(histogram, capacity)
    # A slot's ranks are cut into stretches of a fixed width, so that a piece finds its slot by an equality.
    width = 256
    table = spark.createDataFrame(slots, _SLOTS) if slots else spark.createDataFrame([], _SLOTS)
    stretches = table.withColumn("_stretch", F.explode(F.sequence(F.floor(F.col("first_rank") / width), F.floor((F.col("first_rank") + F.col("n") - 1) / width))))
    found = ranked(items).withColumn("_stretch", F.floor(F.col("rank") / width)).join(stretches, ["length", "_stretch"]).filter(
        (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("n")))
    return found.select(*[c for c in items.columns], (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = True, words: bool = True) -> DataFrame:
    """Tokenise, cut and pack: doc_id, piece, start, length, ids_crc32, [ids], sequence_id, offset."""
    return pack(materialise(pieces(docs, path, capacity, end_id, ids, words), "pieces"), capacity)
