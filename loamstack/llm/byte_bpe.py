"""Byte-level BPE: Spark's higher-order functions fold ranked merges over the byte arrays of distinct words.

1. Texts are cut by the pattern in chunks. A chunk is written as the places of its words in its own dictionary, and the
   dictionary beside it, dealt into parts by the hash of the word.
2. Each part makes its words distinct, so that a word of the corpus is folded once, however many chunks hold it. The fold
   runs in the JVM: in each step the adjacent pair of least rank, the leftmost of equals, becomes one token, looked up in
   a literal map of ranks that is dealt over buckets.
3. The ids go back to the chunks that asked for the words, and each chunk gathers those of its texts. Texts themselves are
   never shuffled; a chunk sends a word once.

In words over ``LONG`` bytes all occurrences of the least pair merge in one step if that gives what single merges
give: no pair of the result, and no pair of the new token with the pair's first token, ranks below it.

Rank files have to be such that every token is reached by merges of its bytes (checked on loading); an id is its rank.
Edge cases: a null or empty text has no ids; repeated rows each get theirs; a doc_id may be null or of any type; an empty
table gives an empty result; other columns are never looked at. A long word takes time in proportion to its length times
its distinct merges.
"""

from __future__ import annotations

import base64
import json
import math
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from loamstack.llm.pretokenize import BYTE_LEVEL_PATTERN, Words, byte_level, plain
from loamstack.llm.store import MOST_BUCKETS, bucketed, small_batches

BUCKETS = 1 << 15
LONG = 48
#: Characters of a chunk, which has one dictionary, and of the slices in which it is cut.
CHUNK_CHARS, SLICE_CHARS = 16_000_000, 1_000_000
#: Bytes of text for each part of the words.
PART_BYTES = 12_000_000
#: What is taken from ranks, so that they lie below all ids.
OFFSET = 1 << 20
#: Sequences of ids are written as strings, an id as one character from here, where replace() has to work on them.
FIRST_SIGN = 0x100
BATCH_ROWS = 1000


@cache
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    if sorted(ranks.values()) != list(range(len(ranks))) or len(ranks) > 0xD800 - FIRST_SIGN:
        raise ValueError(f"{path}: ranks have to be 0, 1, 2 ...")
    for word in ranks:
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, i = min((ranks.get(a + b, len(ranks)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == len(ranks):
                raise ValueError(f"{path}: merges don't reach {word!r}")
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return ranks


def _let(value: Column, f) -> Column:
    """f(value), with value computed once."""
    return F.get(F.transform(F.array(value), f), 0)


class MergeFold:
    """The merge table of a rank file as literals, and the fold over arrays of ids.

    A word under way is an array of ids and, between neighbours, the rank of their pair less OFFSET: negative, so that
    the least number is the next merge and no id can be. Where a pair has no rank, and at both ends, stands null.
    """

    def __init__(self, ranks: dict[bytes, int]):
        buckets: list[dict[int, int]] = [{} for _ in range(BUCKETS - 1)]
        for word, rank in ranks.items():
            for i in range(1, len(word)):
                a, b = ranks.get(word[:i]), ranks.get(word[i:])
                if a is not None and b is not None:
                    key = (a << 16 | b) - (a >> 15 << 32)  # as a signed number of 32 bits
                    buckets[key % (BUCKETS - 1)][key] = rank - OFFSET
        # Most words begin with pairs of bytes: these have a table of their own, if the ids of bytes are the first 256.
        self.by_byte = all(ranks[bytes([a])] < 256 for a in range(256))
        pairs: list[int | None] = [None] * 65536
        for word, rank in ranks.items():
            if self.by_byte and len(word) == 2:
                pairs[ranks[word[:1]] << 8 | ranks[word[1:]]] = rank - OFFSET
        # Foldable expressions, so the optimiser turns each into one literal; lambda variables stand for them below.
        self._literals = (F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>").cast("array<map<int,int>>"), F.from_json(F.lit(json.dumps(pairs)), "array<int>"),
                          F.split(F.lit("".join(chr(FIRST_SIGN + i) for i in range(len(ranks)))), ""))

    def rank(self, a: Column, b: Column) -> Column:
        key = F.shiftleft(a, 16).bitwiseOR(b)
        return F.try_element_at(F.get(self.buckets, F.pmod(key, F.lit(BUCKETS - 1))), key)

    def _laid(self, ids: Column) -> Column:
        pairs = F.flatten(F.transform(ids, lambda x, i: F.array(self.rank(F.get(ids, i - 1), x), x)))
        return F.concat(pairs, F.array(F.lit(None).cast("int")))

    def _laid_bytes(self, word: Column) -> Column:
        """The same for a word of single bytes."""
        if not self.by_byte:
            return self._laid(word)
        pairs = F.flatten(F.transform(word, lambda x, i: F.array(F.get(self.pairs, F.shiftleft(F.get(word, i - 1), 8).bitwiseOR(x)), x)))
        return F.concat(pairs, F.array(F.lit(None).cast("int")))

    @staticmethod
    def _ids(laid: Column) -> Column:
        return F.filter(laid, lambda x, i: i % 2 == 1)

    def _merge(self, laid: Column, q: Column) -> Column:
        """Merge the pair at place ``q`` (from 1); only the ranks on either side are looked up anew."""
        m = F.get(laid, q - 1) + OFFSET
        new = F.array(self.rank(F.get(laid, q - 4), m), m, self.rank(m, F.get(laid, q + 2)))
        return F.concat(F.slice(laid, F.lit(1), q - 3), new, F.slice(laid, q + 3, F.size(laid)))

    def _short(self, word: Column) -> Column:
        def step(laid: Column, _: Column) -> Column:
            return _let(F.array_position(laid, F.array_min(laid)).cast("int"), lambda q: F.when(F.get(laid, q - 1) < 0, self._merge(laid, q)).otherwise(laid))

        return self._ids(F.aggregate(F.sequence(F.lit(1), F.size(word) - 1), self._laid_bytes(word), step))

    def _long(self, word: Column) -> Column:
        """Merge wherever the least pair occurs, if single merges would too."""
        state = lambda laid, go: F.struct(laid.alias("laid"), F.lit(go).alias("go"))

        def merge_all(laid: Column, q: Column) -> Column:
            sign = lambda x: F.get(self.signs, x)
            a, b, m = F.get(laid, q - 2), F.get(laid, q), F.get(laid, q - 1)
            text = F.replace(F.array_join(F.transform(self._ids(laid), sign), ""), F.concat(sign(a), sign(b)), sign(m + OFFSET))
            whole = F.transform(F.split(text, ""), lambda c: F.ascii(c) - FIRST_SIGN)
            above = lambda x: F.coalesce(x > m, F.lit(True))
            return _let(whole, lambda x: _let(self._laid(x), lambda after: F.when(above(F.array_min(after)) & above(self.rank(m + OFFSET, a)), after).otherwise(self._merge(laid, q))))

        def step(acc: Column, _: Column) -> Column:
            laid = acc["laid"]
            more = _let(F.array_position(laid, F.array_min(laid)).cast("int"), lambda q: F.when(F.get(laid, q - 1) < 0, state(merge_all(laid, q), True)).otherwise(state(laid, False)))
            return F.when(acc["go"], more).otherwise(acc)

        return self._ids(F.aggregate(F.sequence(F.lit(1), F.size(word) - 1), state(self._laid_bytes(word), True), step)["laid"])

    def encode(self, words: Column) -> Column:
        """``words``: array of words, each an array of the ids of its bytes."""

        def with_literals(buckets: Column, pairs: Column, signs: Column) -> Column:
            self.buckets, self.pairs, self.signs = buckets, pairs, signs
            return F.transform(words, lambda w: F.when(F.size(w) < 2, w).when(F.size(w) <= LONG, self._short(w)).otherwise(self._long(w)))

        a, b, c = self._literals
        return _let(a, lambda buckets: _let(b, lambda pairs: _let(c, lambda signs: with_literals(buckets, pairs, signs))))


def _found(texts: list[str], simple: bool, pattern: str) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the place of each word, words of each text."""
    if simple:
        w = Words(texts, byte_level, False)
        return w.values.to_pylist(), w.codes, w.counts
    import regex

    cut = [regex.findall(pattern, t) for t in texts]
    d = pa.array([w.encode() for words in cut for w in words], pa.binary()).dictionary_encode()
    return d.dictionary.to_pylist(), np.asarray(d.indices), np.array([len(words) for words in cut], np.int64)


def _planes(codes: np.ndarray) -> bytes:
    """Numbers below 2**24 as three planes of bytes, which compress far better than whole numbers."""
    return codes.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].T.tobytes()


def _from_planes(data: pa.Buffer) -> np.ndarray:
    low, mid, high = np.frombuffer(data, np.uint8).reshape(3, -1).astype(np.int32)
    return low | mid << 8 | high << 16


def _squeezed(data: bytes) -> bytes:
    """Zstandard behind the plain size: what crosses a shuffle in blobs is not compressed well by the shuffle itself."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _plain(blob: pa.Scalar) -> bytes:
    data = blob.as_py()
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _steps(codes: np.ndarray) -> bytes:
    return _squeezed(np.diff(codes, prepend=0).astype("<i4").tobytes())


def _slices(batches: Iterator[pa.RecordBatch], fast: bool) -> Iterator[tuple[list, list[str], bool]]:
    """Ids and texts in slices of one kind: all of Latin script or all not."""
    for b in (whole.slice(at, BATCH_ROWS) for whole in batches for at in range(0, whole.num_rows, BATCH_ROWS)):
        ids: list = []
        texts: list[str] = []
        size, simple = 0, True
        for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            t = t or ""
            same = (fast and plain(t)) == simple
            if ids and (not same or size >= SLICE_CHARS):
                yield ids, texts, simple
                ids, texts, size = [], [], 0
            simple = simple if same else not simple
            ids.append(d)
            texts.append(t)
            size += len(t)
        if ids:
            yield ids, texts, simple


def _cut(pattern: str, parts: int, kind: pa.DataType):
    """Rows of slices (part -1) and, for each chunk of slices, rows of its distinct words by part."""
    schema = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("doc_ids", pa.list_(kind)), ("counts", pa.binary()), ("places", pa.binary()), ("words", pa.binary()), ("sizes", pa.binary()), ("codes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, size = TaskContext.get().partitionId() << 24, 0
        known: dict[bytes, int] = {}

        def words() -> pa.RecordBatch:
            """The chunk's words by part, each part's in the order of their codes."""
            names = list(known)
            part = np.fromiter(map(zlib.crc32, names), np.int64, len(names)) % parts
            order = np.argsort(part, kind="stable")
            cuts = _cuts(part[order])
            length = np.fromiter(map(len, names), np.int32, len(names))
            rows = [(chunk, int(part[order[a]]), None, None, None, _squeezed(b"".join([names[i] for i in order[a:b]])), _squeezed(length[order[a:b]].tobytes()), _steps(order[a:b])) for a, b in pairwise(cuts)]
            return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for ids, texts, simple in _slices(batches, pattern == BYTE_LEVEL_PATTERN):
            values, codes, counts = _found(texts, simple, pattern)
            for w in values:
                known.setdefault(w, len(known))
            places = np.fromiter(map(known.__getitem__, values), np.int32, len(values))[codes] if values else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip((chunk, -1, ids, counts.astype("<i8").tobytes(), _planes(places), None, None, None), schema, strict=True)], schema=schema)
            size += sum(map(len, texts))
            if size >= CHUNK_CHARS:
                if known:
                    yield words()
                chunk, size, known = chunk + 1, 0, {}
        if known:
            yield words()

    return run


def _cuts(ordered: np.ndarray) -> list[int]:
    """Where runs of equal numbers begin, and the end."""
    return [*np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])).tolist(), len(ordered)] if len(ordered) else [0]


def _numbers(column: pa.ChunkedArray, kind: str, steps: bool = False) -> list[np.ndarray]:
    """The numbers of each row."""
    parts = [np.frombuffer(_plain(x), kind) for x in column]
    return [np.cumsum(p, dtype=p.dtype) for p in parts] if steps else parts


def _joined(parts: list[np.ndarray], kind: str) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _distinct(byte_ids: np.ndarray):
    """One row for a part: its distinct words as arrays of byte ids, and where each chunk's words stand among them."""

    def run(table: pa.Table) -> pa.Table:
        sizes, codes = _joined(_numbers(table["sizes"], "<i4"), "<i4"), _numbers(table["codes"], "<i4", True)
        data = b"".join(map(_plain, table["words"]))
        found = _binary(data, np.append(0, np.cumsum(sizes, dtype=np.int64))).dictionary_encode()
        letters = byte_ids[np.frombuffer(b"".join(found.dictionary.to_pylist()), np.uint8)]
        ends = np.append(0, np.cumsum(np.asarray(pc.binary_length(found.dictionary)), dtype=np.int64)).astype(np.int32)
        words = pa.ListArray.from_arrays(pa.array([0, len(found.dictionary)], pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(letters)))
        counts = list(map(len, codes))
        return pa.table([pa.array([table["chunk"].to_pylist()], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int32())), words, pa.array([np.asarray(found.indices).astype("<i4").tobytes()]), pa.array([_joined(codes, "<i4").tobytes()])],
                        names=["chunks", "counts", "words", "at", "codes"])

    return run


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of a part's words, back to the chunks that asked for them."""
    for b in batches:
        for i in range(b.num_rows):
            chunks, counts, words, at, codes = (b.column(k)[i] for k in range(5))
            new = words.values
            flat, ends = np.asarray(new.flatten(), np.uint16), np.asarray(new.offsets).astype(np.int64)
            at, codes = np.frombuffer(at.as_buffer(), "<i4"), np.frombuffer(codes.as_buffer(), "<i4")
            start, size, last, rows = ends[:-1] - ends[0], np.diff(ends), 0, []
            for c, n in zip(chunks.as_py(), counts.as_py(), strict=True):
                own = at[last : last + n]
                ids, _ = _gather(flat, start[own], size[own])
                rows.append((c, _steps(codes[last : last + n]), _squeezed(size[own].astype("<u4").tobytes()), _squeezed(ids.astype("<u2").tobytes())))
                last += n
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["w_chunk", "codes", "sizes", "ids"])


def _gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``flat`` one after the other, and where each ends."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(start - ends + size, size) + np.arange(total)], ends


def _binary(data: bytes, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)])


class Pieces:
    """The bytes of every id."""

    def __init__(self, ranks: dict[bytes, int]):
        words = sorted(ranks, key=ranks.__getitem__)
        self.flat, self.size = np.frombuffer(b"".join(words), np.uint8), np.array(list(map(len, words)))
        self.start = np.cumsum(self.size) - self.size

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of ids, concatenated, and where each ends."""
        return _gather(self.flat, self.start[ids], self.size[ids])


def _assemble(pieces: Pieces | None, kind: pa.DataType):
    """The ids of a chunk's texts from those of its words."""
    schema = pa.schema([("doc_id", kind), ("n_tokens", pa.int64()), ("ids", pa.binary())] + [("decoded", pa.binary())] * bool(pieces))

    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        codes = _joined(_numbers(words["codes"], "<i4", True), "<i4")
        sizes, flat = (_joined(_numbers(words[k], t), t) for k, t in (("sizes", "<u4"), ("ids", "<u2")))
        start, size = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        size[codes] = sizes
        start[codes] = np.cumsum(sizes, dtype=np.int64) - sizes
        out = []
        for i in range(texts.num_rows):
            docs, counts, places = (texts[k][i] for k in ("doc_ids", "counts", "places"))
            at = _from_planes(places.as_buffer())
            ids, ends = _gather(flat, start[at], size[at])
            last = np.append(0, ends)[np.append(0, np.cumsum(np.frombuffer(counts.as_buffer(), "<i8")))]
            columns = [docs.values, pa.array(np.diff(last), pa.int64()), _binary(ids.astype("<u4").tobytes(), 4 * last)]
            if pieces:
                letters, ends = pieces.decode(ids)
                columns.append(_binary(letters.tobytes(), np.append(0, ends)[last]))
            out.append(pa.RecordBatch.from_arrays([c.cast(t.type) for c, t in zip(columns, schema, strict=True)], schema=schema))
        return pa.Table.from_batches(out, schema)

    return run


def encode(docs: DataFrame, path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian unsigned 32 bits), without special tokens; if asked for, ``decoded`` from the ids."""
    ranks, spark = load_ranks(path), docs.sparkSession
    byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
    small_batches(spark)
    own = docs.select("doc_id", "text")
    kind = own.schema["doc_id"].dataType
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, buckets = math.ceil(total / PART_BYTES) or 1, min(MOST_BUCKETS, 4 * math.ceil(total / CHUNK_CHARS) or 1)
    cut = own.mapInArrow(_cut(pattern, parts, to_arrow_type(kind)), f"chunk long, part int, doc_ids array<{kind.simpleString()}>, counts binary, places binary, words binary, sizes binary, codes binary")
    table = bucketed(cut, "chunk", buckets, "bpe_chunks")
    asked = table.filter("part >= 0").select("part", "chunk", "words", "sizes", "codes")
    new = asked.groupBy("part").applyInArrow(_distinct(byte_ids), "chunks array<long>, counts array<int>, words array<array<int>>, at binary, codes binary")
    folded = new.select("chunks", "counts", MergeFold(ranks).encode(F.col("words")).alias("words"), "at", "codes").mapInArrow(_deal, "w_chunk long, codes binary, sizes binary, ids binary")
    texts = table.filter("part = -1").select("chunk", "doc_ids", "counts", "places")
    return texts.groupBy("chunk").cogroup(folded.groupBy("w_chunk")).applyInArrow(_assemble(Pieces(ranks) if decoded else None, to_arrow_type(kind)), f"doc_id {kind.simpleString()}, n_tokens long, ids binary" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded`` (binary): the pieces of its ids, concatenated; null ids count as none."""
    pieces = Pieces(load_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(at, BATCH_ROWS) for whole in batches for at in range(0, whole.num_rows, BATCH_ROWS)):
            ids = [np.frombuffer(x.as_buffer(), "<u4") if x.is_valid else np.zeros(0, np.uint32) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([pieces.decode(x)[0].tobytes() for x in ids], pa.binary())], names=[*b.schema.names, "decoded"])

    return encoded.mapInArrow(run, ", ".join([*[f"`{n}` {t}" for n, t in encoded.dtypes], "decoded binary"]))
