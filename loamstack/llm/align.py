"""Cross-tokenizer alignment of a byte-level BPE vocabulary (A) and a sentencepiece BPE vocabulary (B).

Both read a space and the text. Segments end before runs of white space where neither vocabulary can merge across:

* A's pattern begins a new piece wherever white space follows another sign.
* B has no piece in which a space follows another sign (``check_vocabularies`` looks at every piece; it also wants no
  normalisation, a space in front of the text, and bytes for unknown signs).

A cut is made before a space that follows a sign other than white space and that is followed by more than spaces, so
that every segment begins with one space, as B's own prefix does.

1. Texts are cut in chunks. A chunk is written as the places of its segments in its own dictionary, and the dictionary
   as plain rows (chunk, code, segment).
2. The rows are dealt and sorted by segment; each distinct one is tokenised and aligned once. Its path lists the
   overlapping pairs of tokens in order; each says whether its A token and its B token are new. The paths join the rows
   of all chunks that hold the segment in the same sorted pass, and go back to the chunks packed by chunk (never more
   packs than rows, so their number follows the input).
3. Each chunk counts the documents that hold a pair; the counts are added up. The pairs of each chunk get their total
   and whether it is the highest of their A id.
4. Each chunk composes its documents from the paths and those totals.

Rows of steps 1 to 4 follow the distinct segments and pairs of a chunk, one row each, dealt by Spark; no row holds what
several chunks share.

Edge cases: texts that are null, empty or whose bytes either side changes (U+2581 becomes a space in B) have no tokens, all
counts 0, groups null, and their pairs don't count; rows with one doc_id count one by one; doc_id may be null and of any type; an empty table
gives an empty result; columns other than doc_id and text are never looked at; a text without spaces is one segment.
"""

from __future__ import annotations

import json
import math
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from loamstack.llm.byte_bpe import _from_planes, _plain, _planes, _squeezed, _steps
from loamstack.llm.pretokenize import byte_signs
from loamstack.llm.store import MOST_BUCKETS, bucketed, materialise, small_batches

#: Characters of a chunk and of the slices in which it is cut and composed; segments that are aligned at a time.
CHUNK_CHARS, SLICE_CHARS, ALIGN_ROWS = 16_000_000, 500_000, 20_000
#: Sorted rows of segments that are packed by chunk at a time, and bytes of segments for each task of them.
PACK_ROWS, TASK_BYTES = 200_000, 4_000_000
#: Segments whose groups are written at a time.
TEXT_CODES = 50_000
#: A pair of a path: A id in the upper 16 bits, B id in the lower ones; its new sides.
LINK = np.dtype([("pair", "<u4"), ("new", "u1")])
NEW_A, NEW_B = 1, 2
SPACE = "▁"


def check_vocabularies(byte_level: str, pieces: str) -> None:
    """Raises ValueError where a cut could change the tokens."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    with open(byte_level) as f:
        a = json.load(f)
    kind = a["pre_tokenizer"]
    if a["normalizer"] or kind["type"] != "ByteLevel" or kind["add_prefix_space"] or not kind["use_regex"] or len(a["model"]["vocab"]) > 1 << 16:
        raise ValueError(f"{byte_level}: needs the byte-level pattern without normalisation, and at most 65536 ids")
    model = sentencepiece_model_pb2.ModelProto()
    with open(pieces, "rb") as f:
        model.ParseFromString(f.read())
    spec = model.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or not model.trainer_spec.byte_fallback or len(model.pieces) > 1 << 16:
        raise ValueError(f"{pieces}: needs byte fallback and a space in front, no normalisation, and at most 65536 ids")
    if SentencePieceProcessor(model_file=pieces).encode("a b", out_type=str) != [SPACE + "a", SPACE + "b"]:
        raise ValueError(f"{pieces}: does not write spaces as {SPACE}")
    across = [p.piece for p in model.pieces if SPACE in p.piece.lstrip(SPACE) or p.type == 4]
    if across:
        raise ValueError(f"{pieces}: pieces that reach over a cut: {across[:3]}")


def _cuts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where segments begin in the bytes of texts that begin with a space each and lie one after the other."""
    space = data == 32
    blank = space | (data >= 9) & (data <= 13) | (data >= 28) & (data <= 31)
    at = np.flatnonzero(space[1:] & ~blank[:-1]) + 1
    # Signs of two and three bytes that are white space, or were in older tables.
    one, two, three = data[at - 1], data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    wide = (two == 0xC2) & ((one == 0x85) | (one == 0xA0)) | (three == 0xE1) & ((two == 0x9A) | (two == 0xA0)) | (three == 0xE2) & ((two == 0x80) | (two == 0x81)) | (three == 0xE3) & (two == 0x80)
    at = at[~wide]
    text = np.searchsorted(starts, at, "right") - 1
    last = np.maximum.reduceat(np.where(space, -1, np.arange(len(data))), starts)
    at = at[(at < last[text]) & (at > starts[text])]
    return np.sort(np.concatenate([starts, at]))


def segments(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct segments of texts that aren't empty, the number of each segment's among them, segments of each text."""
    parts = [(" " + t).encode() for t in texts]
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    data = b"".join(parts)
    ends = np.cumsum(size)
    starts = ends - size
    cuts = _cuts(np.frombuffer(data, np.uint8), starts, ends) if parts else np.zeros(0, np.int64)
    bounds = np.append(cuts, len(data)).astype(np.int32)
    found = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
    return found.dictionary.to_pylist(), np.asarray(found.indices), np.diff(np.append(np.searchsorted(cuts, starts), len(cuts)))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    for b in batches:
        ids: list = []
        texts: list[str] = []
        size = 0
        for d, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            ids.append(d)
            texts.append(t.as_py() or "")
            size += len(texts[-1])
            if size >= SLICE_CHARS:
                yield ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts


def _rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """The given columns, null in the others."""
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _cut(schema: pa.Schema):
    """Rows of slices (doc_ids, counts, places) and of the distinct segments of each chunk of slices (code, segment)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, size = TaskContext.get().partitionId() << 24, 0
        known: dict[bytes, int] = {}

        def dictionary() -> Iterator[pa.RecordBatch]:
            names = list(known)
            for at in range(0, len(names), ALIGN_ROWS):
                some = names[at : at + ALIGN_ROWS]
                yield _rows(schema, chunk=[chunk] * len(some), code=np.arange(at, at + len(some), dtype=np.int32), segment=some)

        for ids, texts in _slices(batches):
            # What B reads as a space would be one in the text too.
            values, codes, counts = segments([t for t in texts if t and SPACE not in t])
            full = np.zeros(len(texts), np.int64)
            full[[i for i, t in enumerate(texts) if t and SPACE not in t]] = counts
            for v in values:
                known.setdefault(v, len(known))
            places = np.fromiter(map(known.__getitem__, values), np.int32, len(values))[codes] if values else np.zeros(0, np.int32)
            yield _rows(schema, chunk=[chunk], doc_ids=[ids], counts=[full.astype("<i8").tobytes()], places=[_planes(places)])
            size += sum(map(len, texts))
            if size >= CHUNK_CHARS:
                yield from dictionary()
                chunk, size, known = chunk + 1, 0, {}
        yield from dictionary()

    return run


class Sides:
    """Both tokenizers, and the bytes of their entries."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(byte_level), SentencePieceProcessor(model_file=pieces)
        self.a.encode_special_tokens = True
        byte = {chr(s): i for i, s in enumerate(byte_signs())}
        words = self.a.get_vocab(with_added_tokens=False)
        left = {i: bytes(map(byte.__getitem__, w)) for w, i in words.items()}
        n = self.b.get_piece_size()
        right = {i: bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace(SPACE, " ").encode() for i in range(n)}
        self.bytes = [[x.get(i, b"") for i in range(max(x) + 1)] for x in (left, right)]
        self.sizes = [np.fromiter(map(len, x), np.int64, len(x)) for x in self.bytes]

    def tokens(self, parts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and B the ids of all segments one after the other, and how many each has."""
        texts = [p.decode() for p in parts]
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        b = self.b.encode([t[1:] for t in texts], num_threads=1)
        return [(np.fromiter((i for x in ids for i in x), np.int64), np.fromiter(map(len, ids), np.int64, len(ids))) for ids in (a, b)]

    def paths(self, parts: list[bytes]) -> list[bytes]:
        """The path of each segment; empty if either side's bytes aren't the segment's."""
        found = self.tokens(parts)
        ok = np.ones(len(parts), bool)
        length = np.fromiter(map(len, parts), np.int64, len(parts))
        for (ids, counts), words, sizes in zip(found, self.bytes, self.sizes, strict=True):
            same = np.diff(np.append(0, np.cumsum(sizes[ids]))[np.append(0, np.cumsum(counts))]) == length
            if same.all() and b"".join([words[i] for i in ids.tolist()]) == b"".join(parts):
                continue
            at = 0
            for k, (p, n) in enumerate(zip(parts, counts.tolist(), strict=True)):
                ok[k] &= b"".join([words[i] for i in ids[at : at + n].tolist()]) == p
                at += n
        if not ok.all():
            some = iter(self.paths([p for p, good in zip(parts, ok, strict=True) if good]))
            return [next(some) if good else b"" for good in ok]
        if not parts:
            return []
        (a, n_a), (b, n_b) = found
        end_a, end_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        start_a, start_b = end_a - self.sizes[0][a], end_b - self.sizes[1][b]
        # The B tokens that overlap each A token stand together.
        first, stop = np.searchsorted(end_b, start_a, "right"), np.searchsorted(start_b, end_a, "left")
        n = stop - first
        of = np.repeat(np.arange(len(a)), n)
        other = np.arange(len(of)) + np.repeat(first - np.cumsum(n) + n, n)
        links = np.empty(len(of), LINK)
        links["pair"] = a[of] << 16 | b[other]
        fresh = lambda x: np.append(True, x[1:] != x[:-1])
        links["new"] = NEW_A * fresh(of) + NEW_B * fresh(other)
        per = np.add.reduceat(n, np.cumsum(n_a) - n_a)
        bounds = np.append(0, np.cumsum(per)) * LINK.itemsize
        raw = links.tobytes()
        return [raw[x:y] for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


@cache
def sides(byte_level: str, pieces: str) -> Sides:
    """One for each process."""
    return Sides(byte_level, pieces)


def _spread(pairs: np.ndarray) -> bytes:
    """The first bytes of all pairs, then the second ones, and so on, compressed."""
    return _squeezed(pairs.view(np.uint8).reshape(-1, 4).T.tobytes())


def _gathered(blob: pa.Scalar) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(_plain(blob), np.uint8).reshape(4, -1).T).view("<u4").ravel()


_PACK = pa.schema([("chunk", pa.int64()), ("codes", pa.binary()), ("sizes", pa.binary()), ("pairs", pa.binary()), ("news", pa.binary())])


def _align(byte_level: str, pieces: str):
    """Of rows (segment, chunk, code) sorted by segment the paths, packed by chunk: ascending codes, links of each, pairs and new sides of the links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = sides(byte_level, pieces)
        held: list[pa.RecordBatch] = []
        last: tuple[bytes, bytes] = (b"", b"")

        def packed() -> pa.RecordBatch:
            nonlocal last
            table = pa.Table.from_batches(held).combine_chunks()
            found = table["segment"].chunk(0).dictionary_encode()
            parts = found.dictionary.to_pylist()
            # The first may have been aligned as the last of the rows before.
            known = parts[0] == last[0]
            paths = [last[1]] * known
            for at in range(known, len(parts), ALIGN_ROWS):
                paths += both.paths(parts[at : at + ALIGN_ROWS])
            last = parts[-1], paths[-1]
            links = np.frombuffer(b"".join(paths), LINK)
            size = np.fromiter((len(p) // LINK.itemsize for p in paths), np.int64, len(paths))
            start = np.cumsum(size) - size
            chunk, code, of = np.asarray(table["chunk"]), np.asarray(table["code"]), np.asarray(found.indices)
            order = np.lexsort((code, chunk))
            chunk, code, of = chunk[order], code[order], of[order]
            cuts = np.append(np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1])), len(chunk))
            rows = []
            for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                own = of[x:y]
                some = links[_runs(start[own], size[own])]
                rows.append((int(chunk[x]), _steps(code[x:y]), _squeezed(size[own].astype("<u4").tobytes()), _spread(np.ascontiguousarray(some["pair"])), _squeezed(some["new"].tobytes())))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PACK, strict=True)], schema=_PACK)

        n = 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if n >= PACK_ROWS:
                yield packed()
                held, n = [], 0
        if held:
            yield packed()

    return run


class Chunk:
    """A chunk's paths, by the codes of its segments, and its slices."""

    def __init__(self, slices: pa.Table, packs: pa.Table):
        own = packs
        read = lambda name, kind: np.concatenate([np.zeros(0, kind), *(np.frombuffer(_plain(x), kind) for x in own[name])])
        code = np.concatenate([np.zeros(0, np.int64), *(np.cumsum(np.frombuffer(_plain(x), "<i4")) for x in own["codes"])])
        n = read("sizes", "<u4").astype(np.int64)
        self.pair = np.concatenate([np.zeros(0, "<u4"), *map(_gathered, own["pairs"])])
        self.new = read("news", np.uint8)
        self.size, self.start = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        self.size[code] = n
        self.start[code] = np.cumsum(n) - n
        self.slices = slices
        self.pairs, self.local = np.unique(self.pair, return_inverse=True)

    def documents(self) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        """For each slice: doc_ids, first place of each document's segments and one more, codes of the segments. Documents with a segment without path have none."""
        for i in range(self.slices.num_rows):
            docs, counts, places = (self.slices[k][i] for k in ("doc_ids", "counts", "places"))
            counts, codes = np.frombuffer(counts.as_buffer(), "<i8"), _from_planes(places.as_buffer())
            owner = np.repeat(np.arange(len(counts)), counts)
            odd = np.zeros(len(counts), bool)
            odd[owner[self.size[codes] == 0]] = True
            if odd.any():
                codes, counts = codes[~odd[owner]], np.where(odd, 0, counts)
            yield docs.values, np.append(0, np.cumsum(counts)), codes

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Of numbers of the links, for each code."""
        total = np.append(0, np.cumsum(values, dtype=np.int64))
        return total[self.start + self.size] - total[self.start]


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all elements of stretches, one after the other."""
    return np.arange(int(size.sum())) + np.repeat(start - np.cumsum(size) + size, size)


_PAIRS = pa.schema([("chunk", pa.int64()), ("pair", pa.int64()), ("n", pa.int64())])


def _count(slices: pa.Table, packs: pa.Table) -> pa.Table:
    """How many documents of a chunk hold each pair."""
    chunk = Chunk(slices, packs)
    total = np.zeros(len(chunk.pairs), np.int64)
    for _, bounds, codes in chunk.documents():
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        once = np.unique(owner * max(1, len(chunk.size)) + codes)
        owner, codes = once // max(1, len(chunk.size)), once % max(1, len(chunk.size))
        held = np.repeat(owner, chunk.size[codes]) * max(1, len(total)) + chunk.local[_runs(chunk.start[codes], chunk.size[codes])]
        total += np.bincount(np.unique(held) % max(1, len(total)), minlength=len(total))
    some = np.flatnonzero(total)
    return pa.table([pa.array(np.full(len(some), slices["chunk"][0].as_py())), pa.array(chunk.pairs[some].astype(np.int64)), pa.array(total[some])], schema=_PAIRS)


@cache
def _shown() -> pa.Array:
    """Every id and a comma."""
    return pa.array([f"{i},".encode() for i in range(1 << 16)], pa.binary())


def _written(pair: np.ndarray, new: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The groups of paths that follow each other (``size`` links each), and the letters of each path."""
    group = np.cumsum(new == NEW_A + NEW_B)
    places = [np.flatnonzero(new & side) for side in (NEW_A, NEW_B)]
    ids = np.concatenate([pair[places[0]] >> 16, pair[places[1]] & 0xFFFF]).astype(np.int32)
    key = np.concatenate([2 * group[places[0]], 2 * group[places[1]] + 1])
    order = np.argsort(key, kind="stable")
    key = key[order]
    text = _shown().take(pa.array(ids[order]))
    ends = np.frombuffer(text.buffers()[1], np.int32, len(ids) + 1)[1:]
    out = np.frombuffer(text.buffers()[2], np.uint8)[: ends[-1]].copy()
    last = np.flatnonzero(np.append(key[1:] != key[:-1], True))
    out[ends[last] - 1] = np.where(key[last] % 2, ord(";"), ord("|"))
    # A path holds whole groups: its letters end with those of its last group.
    stop = np.append(0, ends[np.searchsorted(key, 2 * np.arange(1, int(group[-1]) + 1) + 1, "right") - 1])
    return out, np.diff(stop[np.append(0, group)[np.append(0, np.cumsum(size))]])


def _texts(chunk: Chunk) -> pa.Array:
    """The groups of each code's path: A ids, a bar, B ids, a semicolon."""
    by_place = np.lexsort((chunk.size, chunk.start))
    parts, sizes = [], []
    for at in range(0, len(by_place), TEXT_CODES):
        own = by_place[at : at + TEXT_CODES]
        size, first = chunk.size[own], int(chunk.start[own[0]])
        if size.any():
            stop = first + int(size.sum())
            out, n = _written(chunk.pair[first:stop], chunk.new[first:stop], size)
            parts.append(out.tobytes())
            sizes.append(n)
        else:
            sizes.append(size)
    bounds = np.append(0, np.cumsum(np.concatenate([np.zeros(0, np.int64), *sizes])))
    flat = pa.Array.from_buffers(pa.binary(), len(by_place), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(b"".join(parts))])
    back = np.empty(len(by_place), np.int64)
    back[by_place] = np.arange(len(by_place))
    return flat.take(pa.array(back))


def _compose(kind: pa.DataType):
    counts = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = pa.schema([("doc_id", kind), *[(c, pa.int64()) for c in counts], ("groups", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        totals = table.filter(table["pair"].is_valid()).select(["pair", "n", "best"])
        chunk = Chunk(table.filter(table["doc_ids"].is_valid()), table.filter(table["codes"].is_valid()))
        del table
        order = np.argsort(np.asarray(totals["pair"]))
        place = np.searchsorted(np.asarray(totals["pair"])[order], chunk.pairs)
        # Pairs that only documents without tokens hold have no total.
        place = np.minimum(place, max(0, len(order) - 1))
        n, best = (np.asarray(totals[c])[order][place] if len(order) else np.zeros(len(chunk.pairs), np.int64) for c in ("n", "best"))
        new = chunk.new
        per = [chunk.sums(x) for x in ((new & NEW_A) > 0, (new & NEW_B) > 0, new == NEW_A + NEW_B, np.ones(len(new), np.int64), best.astype(np.int64)[chunk.local], n[chunk.local])]
        texts = _texts(chunk)
        for docs, bounds, codes in chunk.documents():
            columns = [np.append(0, np.cumsum(x[codes]))[bounds] for x in per]
            shown = texts.take(pa.array(codes))
            ends = np.frombuffer(shown.buffers()[1], np.int32, len(codes) + 1)[bounds] if len(codes) else bounds
            raw = shown.buffers()[2].to_pybytes() if len(codes) else b""
            groups = [raw[x : y - 1].decode() if y > x else None for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([docs.cast(kind), *(pa.array(np.diff(c)) for c in columns), pa.array(groups, pa.string())], schema=schema)

    return run


def align(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (``a1,a2|b1;a3|b2,b3``; null without tokens): a row for each row of ``docs``."""
    check_vocabularies(byte_level, pieces)
    small_batches(docs.sparkSession)
    own = docs.select("doc_id", "text")
    kind = own.schema["doc_id"].dataType
    arrow = to_arrow_type(kind)
    schema = pa.schema([("chunk", pa.int64()), ("code", pa.int32()), ("segment", pa.binary()), ("doc_ids", pa.list_(arrow)), ("counts", pa.binary()), ("places", pa.binary())])
    total = own.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = min(MOST_BUCKETS, 4 * math.ceil(total / CHUNK_CHARS) or 1)
    # Each task writes its own chunks, so a bucket's file holds whole chunks and no row moves.
    cut = bucketed(own.mapInArrow(_cut(schema), f"chunk long, code int, segment binary, doc_ids array<{kind.simpleString()}>, counts binary, places binary"), "chunk", buckets, "segments")
    slices = cut.filter("segment IS NULL").select("chunk", "doc_ids", "counts", "places")
    asked = cut.filter("segment IS NOT NULL").select("segment", "chunk", "code")
    size = asked.agg(F.sum(F.length("segment"))).first()[0] or 0
    dealt = asked.repartition(math.ceil(size / TASK_BYTES) or 1, "segment").sortWithinPartitions("segment")
    packs = materialise(dealt.mapInArrow(_align(byte_level, pieces), "chunk long, codes binary, sizes binary, pairs binary, news binary"), "paths")
    pairs = materialise(slices.groupBy("chunk").cogroup(packs.groupBy("chunk")).applyInArrow(_count, "chunk long, pair long, n long"), "pairs")
    summed = pairs.groupBy("pair").agg(F.sum("n").alias("n"))
    highest = summed.groupBy(F.shiftright("pair", 16).alias("a")).agg(F.max("n").alias("most"))
    judged = summed.withColumn("a", F.shiftright("pair", 16)).join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    totals = pairs.select("chunk", "pair").join(judged, "pair").select("chunk", "pair", "n", "best")
    whole = slices.unionByName(packs, allowMissingColumns=True).unionByName(totals, allowMissingColumns=True)
    # As many tasks as the corpus needs, not as the session has by default.
    return whole.repartition(buckets, "chunk").groupBy("chunk").applyInArrow(_compose(arrow), f"doc_id {kind.simpleString()}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
