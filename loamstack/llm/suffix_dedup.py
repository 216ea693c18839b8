"""Removal of repeated byte strings with merged Burrows-Wheeler transforms.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller doc_id.
Sorting all suffixes of a corpus byte by byte is out of reach, so only places that can hold a repeat are sorted:

Texts that are equal to one with a smaller doc_id are marked first: all their strings are repeats, so they take no further
part. Of the others:

1. Every window of LENGTH bytes has one anchor, the least-hashed GRAM-gram in it. Equal windows have equal anchors, so a
   window whose anchor occurs in one document alone is not repeated. Anchors are counted over all documents, once for
   each chunk of documents before they are dealt by hash.
2. Around the anchors that several documents have, the contexts (the bytes of all windows of the anchor, at most
   2 * LENGTH - GRAM) are gathered by anchor. Of equal contexts of a chunk one goes, with the least and largest doc_id;
   where they stand stays with the chunk, so a line of a third of all documents sends a row for each chunk only.
3. Contexts of one anchor that are all equal need no sorting, nor do the ends of a context whose windows have hashes of their
   own. What is left, some anchors at a time, is put into shards; each shard gets its Burrows-Wheeler transform, and the
   transforms are merged by iterative interleave refinement: round h turns the order of
   the shards' suffixes by h bytes into that by h + 2 bytes from the transforms (of letter pairs) alone, and a boundary
   that first appears in a round is a common prefix of as many bytes. After LENGTH bytes the intervals between boundaries are
   the repeated strings; the least doc_id of each tells which occurrences go.
4. Each document gets the spans that its anchors found, and keeps the rest.

Edge cases: a null text counts as empty; rows with one doc_id don't remove each other's bytes; a null doc_id counts as
larger than all others; matches never cross documents; an empty table gives an empty result; columns other than doc_id
and text are never looked at.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamstack.llm.store import MOST_BUCKETS, bucketed, materialise, small_batches

LENGTH = 50
#: So long that grams rarely meet by chance: at 16 bytes the contexts of chance meetings grew faster than the corpus.
GRAM = 24
CHUNK_BYTES = 4_000_000
BLOCK = 1 << 15
BUCKET_ANCHORS = 1_000_000
SHARDS = 8
#: Bytes of whole anchors' contexts whose transforms are merged at a time, so that a merge stays in a processor's cache.
MERGE_BYTES = 1 << 17
LAST = (1 << 63) - 1
_GAP = 0xFF  # in no UTF-8 text


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every string of ``gram`` bytes: those of 1, 2, 4... bytes by doubling, put together by the gram's binary digits."""
    part, h, done, step = data.astype(np.uint64) + np.uint64(1), None, 0, 1
    while True:
        power = np.uint64(pow(0x9E3779B97F4A7C15, step, 1 << 64))
        if gram & step:
            h = part if h is None else h[: len(part) - done] * power + part[done:]
            done += step
        if done == gram:
            return h
        part = part[:-step] * power + part[step:]
        step *= 2


class Chunk:
    """The texts of a chunk one after the other, with the anchor of every window. Copies are left out."""

    def __init__(self, table: pa.Table, copies: set[tuple[int, int]], length: int = LENGTH, gram: int = GRAM):
        ids, rows = np.asarray(table["_id"]).astype(np.int64), np.asarray(table["_row"]).astype(np.int64)
        texts = table["text"].cast(pa.binary())
        own = [i for i, k in enumerate(zip(ids.tolist(), rows.tolist(), strict=True)) if k not in copies] if copies else range(len(ids))
        self.ids, self.rows = ids[own] if copies else ids, rows[own] if copies else rows
        raw = [x or b"" for x in (texts.take(pa.array(own, pa.int64())) if copies else texts).to_pylist()]
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        self.ends = np.cumsum(size)
        self.begins = self.ends - size
        n = len(self.data)
        self.at = self.low = self.high = self.owner = np.zeros(0, np.int64)
        self.hash = np.zeros(0, np.uint64)
        if n < length:
            return
        place, hashes = self._anchors(length, gram)
        edge = np.zeros(n + 1, np.int8)
        long = size >= length
        np.add.at(edge, self.begins[long], 1)
        np.add.at(edge, self.ends[long] - length + 1, -1)
        inside = np.cumsum(edge[:n], dtype=np.int8) > 0
        place[~inside] = -1
        # Runs of windows with one anchor: between texts there are places without a window.
        turn = np.flatnonzero(place[1:] != place[:-1])
        first, last = np.append(0, turn + 1), np.append(turn, n - 1)
        own_runs = place[first] >= 0
        self.low, self.high = first[own_runs], last[own_runs]
        self.at = place[self.low].astype(np.int64)
        self.hash = hashes[self.at]
        self.owner = np.searchsorted(self.ends, self.low, "right")

    def _anchors(self, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
        """For each window the place of its anchor (-1: none), and the hash of each gram, in blocks that fit a processor's cache.

        Grams are compared by the upper bits of their hashes, then by place (the leftmost of equals), both in one number.
        """
        n, width = len(self.data), length - gram + 1
        place, hashes = np.full(n, -1, np.int32), np.zeros(n, np.uint64)
        low_bits = np.uint64((1 << (BLOCK + length).bit_length()) - 1)
        for s in range(0, n - length + 1, BLOCK):
            h = gram_hashes(self.data[s : s + BLOCK + length - 1], gram)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(32)
            h *= np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(29)
            key, have = (h & ~low_bits) | np.arange(len(h), dtype=np.uint64), 1
            while have < width:
                d = min(have, width - have)
                key = np.minimum(key[:-d], key[d:])
                have += d
            at = (key & low_bits).astype(np.int64)
            place[s : s + len(at)], hashes[s : s + len(h)] = at + s, h
        return place, hashes


def _packed(columns: dict[str, list], kinds: dict[str, pa.DataType]) -> pa.Table:
    return pa.table({k: pa.array(columns[k], kinds[k]) for k in kinds})


#: What goes to a chunk beside its texts, as columns of numbers: its copies (ids, rows), its anchors that lie in several
#: documents (hashes), its contexts' places (how many, ids, rows, places) and what was found (contexts, windows from, to, least id).
COPIES, WANTED, PLACES, FOUND = range(4)
_SIDE = {"s_chunk": pa.int32(), "kind": pa.int32(), **dict.fromkeys(("a", "b", "c", "d"), pa.binary())}
_SIDE_DDL = "s_chunk int, kind int, a binary, b binary, c binary, d binary"


def _add(out: dict[str, list], chunk: int, kind: int, *columns: np.ndarray) -> None:
    for k, v in zip(_SIDE, (chunk, kind, *(x.astype("<i8").tobytes() for x in columns), *[None] * (4 - len(columns))), strict=True):
        out[k].append(v)


def _side(side: pa.Table, kind: int, *types: str) -> list[np.ndarray]:
    """The columns of a chunk's rows of one kind."""
    own = side.filter(pc.equal(side["kind"], kind)) if side.num_rows else side
    return [_numbers(own[c], t)[0] if own.num_rows else np.zeros(0, t) for c, t in zip("abcd", types, strict=False)]


def _copies(side: pa.Table) -> set[tuple[int, int]]:
    return set(zip(*(x.tolist() for x in _side(side, COPIES, "<i8", "<i8")), strict=True))


def _pack_copies(table: pa.Table) -> pa.Table:
    out: dict[str, list] = {k: [] for k in _SIDE}
    _add(out, table["c_chunk"][0].as_py(), COPIES, np.asarray(table["c_id"]).astype("<i8"), np.asarray(table["c_row"]).astype("<i8"))
    return _packed(out, _SIDE)


def _anchors(buckets: int):
    kinds = {"bucket": pa.int32(), "chunk": pa.int32(), "hashes": pa.binary(), "least": pa.binary(), "several": pa.binary()}

    def run(table: pa.Table, side: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _packed({k: [] for k in kinds}, kinds)
        c = Chunk(table, _copies(side))
        order = np.lexsort((c.ids[c.owner], c.hash))
        h, d = c.hash[order], c.ids[c.owner][order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(h))[: len(first)] - 1
        h, least, several = h[first], d[first], d[first] < d[last]
        bucket = (h % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        # A row for each bucket that the chunk has an anchor of: never more rows than anchors, however many buckets there are.
        present, cuts = np.unique(bucket[order], return_index=True)
        out: dict[str, list] = {k: [] for k in kinds}
        for b, part in zip(present.tolist(), np.split(order, cuts[1:]) if len(order) else [], strict=True):
            for k, v in zip(kinds, (b, table["chunk"][0].as_py(), h[part].tobytes(), least[part].tobytes(), np.flatnonzero(several[part]).astype("<u4").tobytes()), strict=True):
                out[k].append(v)
        return _packed(out, kinds)

    return run


def _numbers(column: pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows, and the row of each."""
    parts = [np.frombuffer(x.as_buffer(), kind) for x in column]
    return np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def _repeated(table: pa.Table) -> pa.Table:
    """For each chunk its anchors that lie in two documents or more."""
    h, row = _numbers(table["hashes"], "<u8")
    least, (marked, of) = _numbers(table["least"], "<i8")[0], _numbers(table["several"], "<u4")
    cuts = np.searchsorted(row, np.arange(table.num_rows + 1))
    in_chunk = np.zeros(len(h), bool)  # those that several documents of the chunk have
    in_chunk[cuts[of] + marked] = True
    order = np.argsort(h, kind="stable")
    s = h[order]
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    several = (np.minimum.reduceat(least[order], first) < np.maximum.reduceat(least[order], first)) | np.logical_or.reduceat(in_chunk[order], first)
    keep = np.zeros(len(h), bool)
    keep[order] = np.repeat(several, np.diff(np.append(first, len(s))))
    chunks, out = table["chunk"].to_pylist(), {k: [] for k in _SIDE}
    for i, c in enumerate(chunks):
        mine = h[cuts[i] : cuts[i + 1]][keep[cuts[i] : cuts[i + 1]]]
        if len(mine):
            _add(out, c, WANTED, mine)
    return _packed(out, _SIDE)


#: A chunk's contexts of a bucket (entry numbers, hashes, least and largest ids, sizes, texts), or all its places (bucket -1).
_ENTRY = {"bucket": pa.int32(), "chunk": pa.int32(), **dict.fromkeys(("a", "b", "c", "d", "sizes", "texts"), pa.binary())}
_ENTRY_DDL = "bucket int, chunk int, a binary, b binary, c binary, d binary, sizes binary, texts binary"


def _starts(code: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers begin."""
    return np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)


def _contexts(buckets: int, length: int = LENGTH):
    """The chunk's distinct contexts with their least and largest ids; where each stands stays with the chunk (bucket -1)."""

    def run(table: pa.Table, side: pa.Table) -> pa.Table:
        wanted = np.sort(_side(side, WANTED, "<u8")[0])
        if not table.num_rows or not len(wanted):
            return _packed({k: [] for k in _ENTRY}, _ENTRY)
        c, chunk = Chunk(table, _copies(side)), table["chunk"][0].as_py()
        hit = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, c.hash), len(wanted) - 1)] == c.hash)
        owner, start, size = c.owner[hit], c.low[hit], c.high[hit] + length - c.low[hit]
        ends = np.cumsum(size)
        data = c.data[np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        texts = pa.Array.from_buffers(pa.binary(), len(hit), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(data.tobytes())]).dictionary_encode()
        code, ids = np.asarray(texts.indices), c.ids[owner]
        order = np.lexsort((ids, code))
        first, ids = _starts(code[order]), ids[order]
        stop, h = np.append(first[1:], len(order)), c.hash[hit][order][first]
        out: dict[str, list] = {k: [] for k in _ENTRY}
        bucket = (h % np.uint64(buckets)).astype(np.int64)
        dealt = np.argsort(bucket, kind="stable")
        own = texts.dictionary.take(pa.array(code[order][first][dealt]))
        at, raw = np.frombuffer(own.buffers()[1], np.int32)[: len(own) + 1], memoryview(own.buffers()[2] or b"")
        # A row for each bucket that the chunk has a context of, as with its anchors.
        present, cuts = np.unique(bucket[dealt], return_index=True)
        columns = [x.astype(t) for x, t in ((dealt, "<i8"), (h[dealt], "<u8"), (ids[first][dealt], "<i8"), (ids[stop - 1][dealt], "<i8"), (np.diff(at), "<u4"))]
        for b, i, j in zip(present.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(own)], strict=True):
            for k, v in zip(_ENTRY, (b, chunk, *(x[i:j].tobytes() for x in columns), raw[at[i] : at[j]].tobytes()), strict=True):
                out[k].append(v)
        places = (stop - first, ids, c.rows[owner][order], (start - c.begins[owner])[order])
        for k, v in zip(_ENTRY, (-1, chunk, *(x.astype("<i8").tobytes() for x in places), None, None), strict=True):
            out[k].append(v)
        return _packed(out, _ENTRY)

    return run


def shard_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Rotations of ``text`` in the order of their first ``depth`` bytes at least, by doubling ranks of eight bytes."""
    n, have = len(text), 8
    eight = np.zeros(n, np.uint64)
    for k in range(8):
        eight = (eight << np.uint64(8)) | np.roll(text, -k).astype(np.uint64)
    key = eight
    while True:
        order = np.argsort(key)
        ranked = key[order]
        new = np.append(False, ranked[1:] != ranked[:-1])
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(new).astype(np.uint64)
        if have >= depth or new.sum() == n - 1:
            return order
        key = rank * np.uint64(n) + np.roll(rank, -have % n)
        have *= 2


def letter_pairs(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The transform: the two bytes before each rotation."""
    return text[order - 2].astype(np.uint16) << np.uint16(8) | text[order - 1]


def merge_transforms(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave the rotations of several transforms of letter pairs.

    Returns the shard of each rotation in the order of ``depth`` bytes and its common prefix with the one before: exact
    whether it reaches ``depth``, else rounded down to the depth of the last round. A boundary never moves once it is found,
    because each round refines the order of the round before.
    """
    shard = np.repeat(np.arange(len(transforms), dtype=np.uint8), [len(t) for t in transforms])
    letters = np.concatenate(transforms)
    n, h = len(shard), 0
    common, block = np.full(n, depth, np.int16), np.zeros(n, np.int32)
    while h < depth:
        # The next letters of each shard, in the present order of the shards; an odd depth begins with single letters.
        step = 2 - (depth - h) % 2
        turn = np.empty(n, np.uint16)
        turn[np.argsort(shard, kind="stable")] = letters if step == 2 else letters & np.uint16(0xFF)
        order = np.argsort(turn, kind="stable")
        shard, turn, block = shard[order], turn[order], block[order]
        new = np.append(True, (turn[1:] != turn[:-1]) | (block[1:] != block[:-1]))
        np.minimum(common, h, out=common, where=new)
        block = np.cumsum(new, dtype=np.int32)
        h += step
    return shard, common


def least_of_windows(contexts: list[bytes], least: np.ndarray, length: int = LENGTH, shards: int = SHARDS) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the contexts (each followed by one gap) the least number of any context with the window that starts there, and where each begins."""
    parts = [np.arange(s, len(contexts), shards) for s in range(min(shards, len(contexts)))]
    size = np.fromiter(map(len, contexts), np.int64, len(contexts)) + 1
    begin = np.cumsum(size) - size
    places, transforms = [], []
    for part in parts:
        text = np.frombuffer(b"\xff".join([contexts[i] for i in part]) + b"\xff", np.uint8)
        order = shard_order(text, length + 2)
        own = size[part]
        place = np.repeat(begin[part] - np.cumsum(own) + own, own) + np.arange(len(text))
        places.append(place[order])
        transforms.append(letter_pairs(text, order))
    shard, common = merge_transforms(transforms, length)
    # The place of the rotation that stands at each position of the merged order.
    place = np.empty(len(shard), np.int64)
    place[np.argsort(shard, kind="stable")] = np.concatenate(places)
    interval = np.flatnonzero(common < length)
    owner = np.repeat(np.arange(len(contexts)), size)
    best = np.minimum.reduceat(least[owner[place]], interval)
    flat = np.empty(len(place), np.int64)
    flat[place] = np.repeat(best, np.diff(np.append(interval, len(place))))
    return flat, begin


def _expand(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row, ``count`` numbers from ``first``; and the row of each."""
    row = np.repeat(np.arange(len(count)), count)
    return first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count), row


def _meeting(contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last window of each context that may stand elsewhere as well, by its hash; last < first if there is none. The others need no sorting."""
    first, last = np.full(len(contexts), LAST), np.full(len(contexts), -1)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    if len(data) < length:
        return first, last
    size = np.fromiter(map(len, contexts), np.int64, len(contexts))
    begin = np.cumsum(size) - size
    at, row = _expand(begin, np.maximum(size - length + 1, 0))
    found = gram_hashes(data, length)[at]
    order = np.argsort(found)
    again = np.flatnonzero(found[order[1:]] == found[order[:-1]])
    met = np.zeros(len(at), bool)
    met[order[again]] = met[order[again + 1]] = True
    at, row = at[met], row[met]
    np.minimum.at(first, row, at - begin[row])
    np.maximum.at(last, row, at - begin[row])
    return first, last


def _parts(size: np.ndarray, anchor: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of whole anchors with about ``MERGE_BYTES`` each."""
    first, begin = _starts(anchor), np.cumsum(size) - size
    return list(pairwise(np.append(first[_starts(begin[first] // MERGE_BYTES)], len(size)).tolist()))


def least_by_anchor(contexts: list[bytes], least: np.ndarray, anchor: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """``least_of_windows`` of contexts in the order of their anchors, some anchors at a time: a window has one anchor, so those of different anchors never meet."""
    size = np.fromiter(map(len, contexts), np.int64, len(contexts)) + 1
    begin, flat = np.cumsum(size) - size, np.repeat(least, size)
    met = [_meeting(contexts[a:b], length) for a, b in _parts(size, anchor)]
    first, last = (np.concatenate(x) for x in zip(*met, strict=True))
    some = np.flatnonzero(last >= first)
    if not len(some):
        return flat, begin
    # What lies between those windows; the edges of a common passage come down to one text, whatever stands around it.
    first, count = first[some], (last - first)[some] + 1
    texts = pa.array([contexts[i][f : f + n + length - 1] for i, f, n in zip(some.tolist(), first.tolist(), count.tolist(), strict=True)], pa.binary()).dictionary_encode()
    code, own = np.asarray(texts.indices), texts.dictionary.to_pylist()
    lowest = np.full(len(own), LAST)
    np.minimum.at(lowest, code, least[some])
    size, of = np.fromiter(map(len, own), np.int64, len(own)) + 1, np.empty(len(own), anchor.dtype)
    of[code] = anchor[some]
    found = np.concatenate([least_of_windows(own[a:b], lowest[a:b], length)[0] for a, b in _parts(size, of)])
    flat[_expand(begin[some] + first, count)[0]] = found[_expand((np.cumsum(size) - size)[code], count)[0]]
    return flat, begin


def _resolve(length: int = LENGTH):
    """For each chunk the windows of its contexts that start in a smaller document than the context's largest, as runs of one least id."""

    def run(table: pa.Table) -> pa.Table:
        (entries, row), hashes = _numbers(table["a"], "<i8"), _numbers(table["b"], "<u8")[0]
        least, most = _numbers(table["c"], "<i8")[0], _numbers(table["d"], "<i8")[0]
        ends, chunks = np.cumsum(_numbers(table["sizes"], "<u4")[0], dtype=np.int64), np.asarray(table["chunk"])[row]
        texts = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(b"".join(table["texts"].to_pylist()))]).dictionary_encode()
        code, values = np.asarray(texts.indices), texts.dictionary
        size = np.asarray(pc.binary_length(values)).astype(np.int64)
        # Contexts of each anchor: a group with one text is clear.
        _, group = np.unique(hashes, return_inverse=True)
        lowest, highest = np.full(group.max() + 1, len(values)), np.full(group.max() + 1, -1)
        np.minimum.at(lowest, group, code)
        np.maximum.at(highest, group, code)
        by_text = np.full(len(values), LAST)
        np.minimum.at(by_text, code, least)
        unclear = np.zeros(len(values), bool)
        unclear[code[(lowest < highest)[group]]] = True
        # Runs of windows of each text that have one least document: (first window, last window, document).
        first_run, runs = np.arange(len(values)), np.ones(len(values), np.int64)
        low, high, than = np.zeros(len(values), np.int64), size - length, by_text.copy()
        anchor = np.empty(len(values), np.int64)
        anchor[code] = group
        which = np.flatnonzero(unclear)
        if len(which):
            which = which[np.argsort(anchor[which], kind="stable")]
            flat, begin = least_by_anchor(values.take(pa.array(which)).to_pylist(), by_text[which], anchor[which], length)
            at, row = _expand(begin, (size[which] - length + 1).astype(np.int64))
            new = np.append(True, (row[1:] != row[:-1]) | (flat[at[1:]] != flat[at[:-1]]))
            cut = np.flatnonzero(new)
            last = np.append(cut[1:], len(at)) - 1
            first_run[which] = len(values) + np.searchsorted(row[cut], np.arange(len(which)))
            runs[which] = np.bincount(row[cut], minlength=len(which))
            low, high, than = np.append(low, at[cut] - begin[row[cut]]), np.append(high, at[last] - begin[row[cut]]), np.append(than, flat[at[cut]])
        run_of, entry = _expand(first_run[code], runs[code])
        useful = most[entry] > than[run_of]
        run_of, entry = run_of[useful], entry[useful]
        chunk = chunks[entry]
        order = np.argsort(chunk, kind="stable")
        run_of, entry, chunk = run_of[order], entries[entry[order]], chunk[order]
        cut = _starts(chunk)
        out: dict[str, list] = {k: [] for k in _SIDE}
        for a, b in pairwise([*cut.tolist(), len(chunk)]):
            _add(out, int(chunk[a]), FOUND, entry[a:b], low[run_of[a:b]], high[run_of[a:b]], than[run_of[a:b]])
        return _packed(out, _SIDE)

    return run


def _spans(side: pa.Table, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """ids, rows, starts and stops of what goes, from the chunk's places and what was found for its contexts."""
    count, ids, rows, places = _side(side, PLACES, *["<i8"] * 4)
    entry, low, high, than = _side(side, FOUND, *["<i8"] * 4)
    first = np.cumsum(count) - count
    at, run = _expand(first[entry], count[entry])
    later = ids[at] > than[run]
    at, run = at[later], run[later]
    return ids[at], rows[at], places[at] + low[run], places[at] + high[run] + length


def _remove(table: pa.Table, side: pa.Table) -> pa.Table:
    by_row: dict[tuple[int, int], list[int]] = defaultdict(list)
    ids, rows, starts, stops = _spans(side)
    for i, key in enumerate(zip(ids.tolist(), rows.tolist(), strict=True)):
        by_row[key].append(i)
    copies, out = _copies(side), {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept")}
    for key, text in zip(zip(table["_id"].to_pylist(), table["_row"].to_pylist(), strict=True), table["text"].cast(pa.binary()).to_pylist(), strict=True):
        text = text or b""
        own = by_row.get(key)
        kept, runs = text, 0
        if key in copies and len(text) >= LENGTH:
            kept, runs = b"", 1
        elif own:
            edge = np.zeros(len(text) + 1, np.int64)
            np.add.at(edge, starts[own], 1)
            np.add.at(edge, stops[own], -1)
            gone = np.cumsum(edge[:-1]) > 0
            runs = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        for k, v in zip(out, (len(text), len(text) - len(kept), runs, kept), strict=True):
            out[k].append(v)
    return pa.table({"doc_id": table["doc_id"], **{k: pa.array(v, pa.binary() if k == "kept" else pa.int64()) for k, v in out.items()}})


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary; a cut may fall inside a character)."""
    spark = docs.sparkSession
    small_batches(spark)
    own = docs.select("doc_id", "text")
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, math.ceil(total / CHUNK_BYTES))
    buckets = max(1, math.ceil(total / ((LENGTH - GRAM + 2) / 2) / BUCKET_ANCHORS))
    kind = own.schema["doc_id"].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"doc_id has to be a whole number, not {kind}: number the documents first")
    keyed = (own.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))).withColumn("_row", F.xxhash64("text"))
             .withColumn("chunk", F.pmod(F.xxhash64("doc_id", "_row"), F.lit(chunks)).cast("int")))
    # Written once, bucketed by chunk: the three passes over the texts need no further shuffle.
    files = min(chunks, MOST_BUCKETS)
    texts = bucketed(keyed.repartition(files, "chunk"), "chunk", files, "suffix_chunks")
    digests = materialise(keyed.select("_id", "_row", "chunk", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest")), "digests")
    first = materialise(digests.groupBy("digest").agg(F.min("_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first"), "copied")
    # Both sides are exchanged for this join alone, so adaptive execution may split a digest that many rows share.
    found = digests.join(first.hint("merge"), "digest").filter("_id > first").select(F.col("chunk").alias("c_chunk"), F.col("_id").alias("c_id"), F.col("_row").alias("c_row")).distinct()
    copies = materialise(found.groupBy("c_chunk").applyInArrow(_pack_copies, _SIDE_DDL), "copies")
    beside = lambda side, run, ddl: texts.groupBy("chunk").cogroup(side.groupBy("s_chunk")).applyInArrow(run, ddl)
    anchors = beside(copies, _anchors(buckets), "bucket int, chunk int, hashes binary, least binary, several binary")
    wanted = materialise(anchors.groupBy("bucket").applyInArrow(_repeated, _SIDE_DDL), "anchors")
    entries = materialise(beside(copies.union(wanted), _contexts(buckets), _ENTRY_DDL), "contexts")
    # By their bytes the planner makes fewer tasks than there are cores; the sorting costs far more than they tell.
    results = materialise(entries.filter("bucket >= 0").repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_resolve(), _SIDE_DDL), "found")
    places = entries.filter("bucket = -1").select(F.col("chunk").alias("s_chunk"), F.lit(PLACES).alias("kind"), "a", "b", "c", "d")
    return beside(copies.union(places).union(results), _remove, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
