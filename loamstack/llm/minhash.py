"""Near duplicates by ProbMinHash: shingles, banding, exact verification, connected components.

A text's shingles are its runs of five words (white space apart; a shorter text is one shingle), with the weight
1 + ln(count). Every shingle starts a Poisson process with its weight as rate; each arrival falls into one of
``REGISTERS`` registers, which keeps the shingle of its earliest arrival. A shingle stops when its next arrival comes after
the latest of all registers. Two texts agree in a register with their probability Jaccard similarity: of the weights x and
y the sum over common shingles i of 1 / sum over j of max(x_j / x_i, y_j / y_i). Links are decided by this similarity,
worked out exactly (at least ``THRESHOLD``). Of texts that repeat nothing it is the Jaccard similarity of the sets.

Texts with the same words form one node, so that copies never meet in pairs. Nodes that agree in a band of ``ROWS``
registers meet in its bucket. Three rounds find all links:

1. every node of a bucket against the least node of the bucket;
2. nodes outside the largest component of their bucket against the bucket, block by block; each goes on with the
   node of another component whose signature is most like its own;
3. all pairs of different components that are left, each in the first band that its nodes share. The blocks carry the
   shingles (32 bits of each) and their counts, and only pairs that come within ``SLACK`` of the threshold leave their task.

Signatures that agree in less than ``least_agreement`` of their registers are not compared further: a pair at the
threshold does so with a probability below ``MISS`` (the bands miss it with 5e-8).

Result: one row for each row of the input: doc_id, class_id (the least doc_id of its class), class_size, kept (one row
for each class). Edge cases: a null text counts as empty; texts without words form one class; rows with one doc_id
count one by one, also if their texts differ; a null doc_id ranks last; an empty table gives an empty result; columns other than
doc_id and text are never looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamstack.llm.components import connected_components
from loamstack.llm.store import materialise, small_batches

WORDS = 5
THRESHOLD = 0.8
REGISTERS, ROWS = 128, 4
BANDS = REGISTERS // ROWS
MISS = 1e-12
SLACK = 0.01
CHUNK_ROWS, CHUNK_CHARS = 256, 500_000
#: Rows of a bucket that meet at a time in rounds 2 and 3.
BLOCK = 1024
ONE_WAY = np.uint64(0x9E3779B97F4A7C15)


@cache
def least_agreement(threshold: float, registers: int = REGISTERS) -> float:
    """The largest share of registers below which a pair at the threshold falls with a probability under ``MISS`` (binomial)."""
    below = 0.0
    for n in range(registers):
        below += math.comb(registers, n) * threshold**n * (1 - threshold) ** (registers - n)
        if below >= MISS:
            return n / registers
    return 1.0


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _factors() -> np.ndarray:
    """An odd factor for each of the first places in a word."""
    return mixed(np.arange(1, 4097, dtype=np.uint64)) | np.uint64(1)


def _word_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Of the words between ``start`` and ``stop``; every word is followed by one separator."""
    place = np.arange(len(data)) - np.repeat(start, stop + 1 - start)
    factor = _factors()[np.minimum(place, 4095)]
    far = np.flatnonzero(place > 4095)
    factor[far] = mixed(place[far].astype(np.uint64) + np.uint64(1)) | np.uint64(1)
    factor *= data.astype(np.uint64) + np.uint64(1)
    factor[stop] = 0
    return mixed(np.add.reduceat(factor, start) + (stop - start).astype(np.uint64) * ONE_WAY)


def shingle_keys(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of at most 1024 texts with single spaces (place of the text in 10 bits, hash in 54), and counts."""
    data = np.frombuffer(("\n".join(texts) + "\n").encode("utf-8", "surrogatepass"), np.uint8)
    stop = np.flatnonzero((data == 32) | (data == 10))
    start = np.append(0, stop[:-1] + 1)
    text = np.append(0, np.cumsum(data[stop[:-1]] == 10))
    word, real = _word_hashes(data, start, stop), stop > start
    word, text = word[real], text[real]
    if not len(word):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = np.bincount(text, minlength=len(texts))
    first = np.cumsum(count) - count
    # A text of fewer words is one shingle of what it has.
    place = np.arange(len(word)) - first[text]
    begins = np.flatnonzero((place == 0) | (place + words <= count[text]))
    s = np.zeros(len(begins), np.uint64)
    for k in range(words):
        at = begins + k
        inside = place[begins] + k < count[text[begins]]
        s = s * np.uint64(0xD6E8FEB86659FD93) + np.where(inside, word[np.minimum(at, len(word) - 1)], np.uint64(k))
    keys = (text[begins].astype(np.uint64) << np.uint64(54)) | (mixed(s) >> np.uint64(10))
    return np.unique(keys, return_counts=True)


def prob_min_hash(keys: np.ndarray, counts: np.ndarray, texts: int, registers: int = REGISTERS) -> np.ndarray:
    """For each text the shingles (32 bits of their hashes) of the earliest arrivals at rates 1 + ln(count), 0 where there is none."""
    owner = (keys >> np.uint64(54)).astype(np.int64)
    shingle = keys & np.uint64((1 << 54) - 1)
    rate = 1 + np.log(counts)
    earliest, winner = np.full(texts * registers, np.inf), np.zeros(texts * registers, np.uint32)
    time, low, n = np.zeros(len(keys)), (mixed(shingle) >> np.uint64(32)).astype(np.uint32) | np.uint32(1), 0
    shift = np.uint64(64 - registers.bit_length() + 1)
    while len(shingle):
        x = mixed(shingle + np.uint64(int(ONE_WAY) * (2 * n + 1) % (1 << 64)))
        time = time - np.log(((x >> np.uint64(11)) + 0.5) * 2.0**-53) / rate
        at = owner * registers + (mixed(x + ONE_WAY) >> shift).astype(np.int64)
        np.minimum.at(earliest, at, time)
        won = earliest[at] == time
        winner[at[won]] = low[won]
        here = np.flatnonzero(np.bincount(owner, minlength=texts))
        latest = np.zeros(texts)
        latest[here] = earliest.reshape(texts, registers)[here].max(1)
        go = time < latest[owner]
        owner, shingle, rate, time, low, n = owner[go], shingle[go], rate[go], time[go], low[go], n + 1
    return winner.reshape(texts, registers)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches, with the last column as texts with single spaces."""
    for b in batches:
        at, texts, size = 0, [], 0
        for t in b.column(b.num_columns - 1):
            texts.append(" ".join((t.as_py() or "").split()))
            size += len(texts[-1])
            if len(texts) >= CHUNK_ROWS or size >= CHUNK_CHARS:
                yield b.slice(at, len(texts)), texts
                at, texts, size = at + len(texts), [], 0
        if texts:
            yield b.slice(at), texts


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b, texts in _chunks(batches):
        keys, counts = shingle_keys(texts)
        sig = prob_min_hash(keys, counts, len(texts))
        columns = [pa.array(list(map(_digest, texts)), pa.binary()), pa.array([t != "" for t in texts]), pa.array([x.tobytes() for x in sig], pa.binary())]
        yield pa.RecordBatch.from_arrays(b.columns[:3] + columns, names=["row", "doc_id", "key", "digest", "has_words", "signature"])


def _bands(signature: Column) -> Column:
    """The bucket of each band: a hash of its ``ROWS`` registers, which stand together (32 bits each)."""
    size = 4 * ROWS
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(F.substring(signature, k * size + 1, F.lit(size))))


def _counts(n: np.ndarray) -> bytes:
    """Counts in 32 bits each; nothing if all are 1, as in most texts."""
    return n.astype("<u4").tobytes() if (n != 1).any() else b""


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted shingles of each text and their counts, once with 54 bits and once with 32."""
    for b, texts in _chunks(batches):
        keys, counts = shingle_keys(texts)
        bounds = np.searchsorted(keys, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(54))
        rows = []
        for x, y in pairwise(bounds):
            own, n = keys[x:y] & np.uint64((1 << 54) - 1), counts[x:y]
            thin, place = np.unique(own.astype(np.uint32), return_inverse=True)
            rows.append((own.tobytes(), _counts(n), thin.tobytes(), _counts(np.bincount(place, n, len(thin)))))
        columns = [pa.array(c, pa.binary()) for c in zip(*rows, strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["node", "shingles", "counts", "thin", "thin_counts"])


def probability_jaccard(a: bytes, n: bytes, b: bytes, m: bytes, kind: type = np.uint64) -> float:
    """Of two sorted sets of numbers with counts (see ``_counts``) at the weights 1 + ln(count)."""
    x, y = np.frombuffer(a, kind), np.frombuffer(b, kind)
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    common = y[at] == x
    if not len(n) and not len(m):
        both = int(common.sum())
        return both / (len(x) + len(y) - both)
    wx, wy = (1 + np.log(np.frombuffer(c, "<u4")) if len(c) else np.ones(len(z)) for c, z in ((n, x), (m, y)))
    own, other = wx[common], wy[at[common]]
    # In the order of y / x the larger quotient is x's up to i and y's beyond; shingles of one side stand at the ends.
    order = np.argsort(other / own, kind="stable")
    own, other = own[order], other[order]
    ratio = other / own
    upto = np.searchsorted(ratio, ratio, "right")
    below = wx[~common].sum() + np.append(0, np.cumsum(own))[upto]
    above = wy.sum() - np.append(0, np.cumsum(other))[upto]
    return float((1 / (below / own + above / other)).sum())


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [probability_jaccard(*(c.as_buffer() for c in row)) >= threshold for row in zip(*b.columns[2:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _agree(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint32).reshape(b.num_rows, -1) for k in (2, 3))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array((x == y).mean(1) >= least_agreement(threshold)))

    return run


def _cross(best_only: bool, threshold: float):
    """Of two blocks of a bucket the pairs of different components with agreeing signatures, in their first common band."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        a: list[int] = []
        b: list[int] = []
        agree: list[float] = []
        if left.num_rows and right.num_rows:
            sig = [np.frombuffer(b"".join(t["signature"].to_pylist()), np.uint32).reshape(t.num_rows, -1) for t in (left, right)]
            nodes, theirs, band = left["node"].to_pylist(), right["o_node"].to_pylist(), left["band"][0].as_py()
            thin, counts = ([], []) if best_only else ([t[c].to_pylist() for t in (left, right)] for c in ("thin", "thin_counts"))
            own, other = np.asarray(left["label"]), np.asarray(right["o_label"])
            for i, node in enumerate(nodes):
                same = sig[1] == sig[0][i]
                share = np.where(other != own[i], same.mean(1), 0)
                at = np.flatnonzero(share >= least_agreement(threshold))
                if best_only:
                    at = at[[share[at].argmax()]] if len(at) else at
                else:
                    at = at[same[at].reshape(len(at), BANDS, ROWS).all(2).argmax(1) == band]
                    at = at[[probability_jaccard(thin[0][i], counts[0][i], thin[1][j], counts[1][j], np.uint32) >= threshold - SLACK for j in at]] if len(at) else at
                a += [node] * len(at)
                b += [theirs[j] for j in at]
                agree += share[at].tolist()
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(agree, pa.float64())], names=["a", "b", "agree"])

    return run


def _links(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"), F.col("counts").alias("n"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"), F.col("counts").alias("m"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "n", "y", "m").mapInArrow(_verify(threshold), "a long, b long")


def _signed(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    one = nodes.select(F.col("node").alias("a"), F.col("signature").alias("x"))
    two = nodes.select(F.col("node").alias("b"), F.col("signature").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(_agree(threshold), "a long, b long")


def _key(text: Column) -> Column:
    """Tells texts apart: rows with one doc_id and one key are interchangeable."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _classes(docs: DataFrame, threshold: float) -> DataFrame:
    """row, doc_id, key, class_id, class_size, kept: a row for each row of ``docs``."""
    small_batches(docs.sparkSession)
    own = docs.select("doc_id", _key(F.col("text")).alias("key"), "text")
    kind = own.schema["doc_id"].dataType.simpleString()
    # Written at once, so that the numbers of rows stay what they are.
    rows = materialise(own.select(F.monotonically_increasing_id().alias("row"), "doc_id", "key", "text").mapInArrow(
        _sketch, f"row long, doc_id {kind}, key binary, digest binary, has_words boolean, signature binary"), "signatures")
    # A node is the least row of those with the same words. Few digests have several rows; the join with those can be split.
    copied = materialise(rows.groupBy("digest").agg(F.min("row").alias("node"), F.count("*").alias("n")).filter("n > 1").select("digest", "node"), "copied")
    placed = lambda *columns: rows.select("row", "digest", *columns).join(copied.hint("merge"), "digest", "left").withColumn("node", F.coalesce("node", "row"))
    nodes = materialise(placed("doc_id", "key", "has_words", "signature").filter("has_words and row = node").select("node", "doc_id", "key", "signature"), "nodes")
    members = nodes.select("node", F.posexplode(_bands(F.col("signature"))).alias("band", "bucket"))
    buckets = members.groupBy("band", "bucket").agg(F.min("node").alias("leader"), F.count("*").alias("n")).filter("n > 1")
    # Only nodes that share a bucket go on.
    shared = materialise(members.join(buckets, ["band", "bucket"]), "buckets")
    signed = nodes.select("node", "signature")
    pairs = _signed(shared.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), signed, threshold)
    wanted = nodes.join(shared.select("node").distinct(), "node", "left_semi").select("node", F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
    texts = own.join(wanted, own["doc_id"].eqNullSafe(wanted["_id"]) & (own["key"] == wanted["_key"])).select("node", "text")
    sets = materialise(texts.mapInArrow(_sets, "node long, shingles binary, counts binary, thin binary, thin_counts binary").dropDuplicates(["node"]), "shingles")
    links = materialise(_links(pairs, sets, threshold), "links")
    labels = connected_components(links)
    for best_only in (True, False):
        more = _cross_pairs(shared, signed if best_only else signed.join(sets.select("node", "thin", "thin_counts"), "node"), labels, best_only, threshold)
        if more is None:
            break
        links = materialise(links.union(_links(more, sets, threshold)), "links")
        labels = connected_components(links)
    grouped = materialise(placed("doc_id", "key").join(labels, "node", "left").select("row", "doc_id", "key", F.coalesce("label", "node").alias("label")), "classes")
    one = F.coalesce(F.min_by("row", "doc_id"), F.min("row"))
    sizes = materialise(grouped.groupBy("label").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"), one.alias("first")).filter("n > 1"), "sizes")
    joined = grouped.join(sizes.hint("merge"), "label", "left")
    alone = F.col("n").isNull()
    return joined.select("row", "doc_id", "key", F.when(alone, F.col("doc_id")).otherwise(F.col("least")).alias("class_id"), F.coalesce("n", F.lit(1)).cast("long").alias("class_size"),
                         (alone | (F.col("row") == F.col("first"))).alias("kept"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs``: doc_id, class_id, class_size, kept."""
    return _classes(docs, threshold).select("doc_id", "class_id", "class_size", "kept")


def _cross_pairs(shared: DataFrame, nodes: DataFrame, labels: DataFrame, best_only: bool, threshold: float) -> DataFrame | None:
    """Pairs of different components in one bucket, from nodes outside the bucket's largest component."""
    placed = shared.select("band", "bucket", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    by_label = placed.groupBy("band", "bucket", "label").agg(F.count("*").alias("n"))
    mixed_buckets = by_label.groupBy("band", "bucket").agg(F.max_by("label", "n").alias("main"), F.count("*").alias("labels"), F.sum("n").alias("size")).filter("labels > 1")
    there = materialise(placed.join(mixed_buckets, ["band", "bucket"]).select("band", "bucket", "node", "label", "main", "size"), "mixed")
    if there.limit(1).count() == 0:
        return None
    carried = ["signature"] if best_only else ["signature", "thin", "thin_counts"]
    full = there.join(nodes.select("node", *carried), "node").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    block = lambda seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col("blocks")).cast("int")
    left = full.filter("label <> main").select("band", "bucket", block(1).alias("row"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("col"), "node", "label", *carried)
    outside = left.select("band", "bucket", "row").distinct()
    right = full.withColumn("col", block(1)).select("band", "bucket", "col", F.col("node").alias("o_node"), F.col("label").alias("o_label"), *carried).join(outside, ["band", "bucket"])
    right = right.select(F.col("band").alias("o_band"), F.col("bucket").alias("o_bucket"), F.col("row").alias("o_row"), F.col("col").alias("o_col"), "o_node", "o_label", *[F.col(c).alias(c) for c in carried])
    pairs = left.groupBy("band", "bucket", "row", "col").cogroup(right.groupBy("o_band", "o_bucket", "o_row", "o_col")).applyInArrow(_cross(best_only, threshold), "a long, b long, agree double")
    if best_only:
        pairs = pairs.groupBy("a").agg(F.max_by("b", "agree").alias("b"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class, one with the least doc_id. Rows of different texts that share a doc_id count one by one."""
    kept = materialise(_classes(docs, threshold).filter("kept").select(F.col("doc_id").alias("_kept_id"), F.col("key").alias("_kept_key")), "kept")
    keyed = docs.withColumn("_near_key", _key(F.col("text")))
    some = keyed.join(kept, keyed["doc_id"].eqNullSafe(kept["_kept_id"]) & (keyed["_near_key"] == kept["_kept_key"]), "left_semi")
    # Equal rows fall into one class, so at most one of them was kept; the join brings back all of them.
    repeated = docs.groupBy("doc_id").count().filter("count > 1").limit(1).count() > 0
    return (some.dropDuplicates(["doc_id", "_near_key"]) if repeated else some).drop("_near_key")
