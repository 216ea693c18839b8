"""Elements of the arrays of one large JSON document, read by byte ranges in many tasks.

A range can't know whether it begins inside a string or how deep, but it can say what it does in either case: a first pass
gives for each range the parity of its quotes and the change of depth if it begins outside or inside a string. Added up in
order (one row for each range), these give the true state at each range's start. A second pass finds the keys of the
outermost object, a third one the elements: each range gives those that begin in it, and reads on to the end of its last.

Files are opened by pyarrow's file systems (local, HDFS, S3 and others), also those whose names begin with "_" or ".",
which Spark's readers pass over. A document has to be one object in UTF-8; only elements that are objects or arrays are
given; a document that ends early gives its whole elements.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

RANGE_BYTES, AHEAD_BYTES = 8 << 20, 1 << 16
#: Keys of the outermost object that are looked at; a document with more is no such document.
MOST_KEYS = 10_000
_RANGES = "path string, lo long, hi long, size long, inside boolean, depth int"


def _opened(path: str):
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path) if re.match("[a-z][a-z0-9+.-]*:", path) else (fs.LocalFileSystem(), path)
    return system, place


def size_of(path: str) -> int | None:
    """Bytes of a file, None if there is none."""
    system, place = _opened(path)
    found = system.get_file_info(place)
    return found.size if found.is_file else None


class _Part:
    """The bytes of a file from ``lo`` to ``hi``, and which of them stand outside strings."""

    def __init__(self, file, lo: int, hi: int, inside: bool):
        self.lo, self.file = lo, file
        file.seek(lo)
        self.data = np.frombuffer(file.read(hi - lo), np.uint8)
        back = self._backslashes_before(lo)
        slash = self.data == 92
        at = np.arange(len(self.data))
        last = np.maximum.accumulate(np.where(slash, -1, at))
        before = np.append(-1, last[:-1]) if len(at) else last
        # Backslashes right before each byte; a run may begin before the range.
        run = np.where(before < 0, at + back, at - 1 - before)
        quote = (self.data == 34) & (run % 2 == 0)
        self.quotes = int(quote.sum())
        closed = np.cumsum(quote, dtype=np.int64) % 2 == inside
        # A closing quote stands outside by this count, an opening one inside: neither is a bracket.
        self.outside = closed
        step = ((self.data == 123) | (self.data == 91)).astype(np.int8) - ((self.data == 125) | (self.data == 93))
        self.step, self.quote = step, quote

    def _backslashes_before(self, lo: int) -> int:
        n = 0
        while lo - n > 0:
            size = min(4096, lo - n)
            self.file.seek(lo - n - size)
            part = self.file.read(size)
            kept = len(part.rstrip(b"\\"))
            n += size - kept
            if kept:
                break
        return n

    def depth(self, start: int) -> np.ndarray:
        """After each byte."""
        return start + np.cumsum(np.where(self.outside, self.step, 0), dtype=np.int64)


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for r in b.to_pylist():
            system, place = _opened(r["path"])
            with system.open_input_file(place) as f:
                p = _Part(f, r["lo"], r["hi"], False)
            rows.append((r["path"], r["lo"], p.quotes % 2 == 1, int(p.step[p.outside].sum()), int(p.step[~p.outside].sum())))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.bool_(), pa.int32(), pa.int32()), strict=True)], names=["path", "lo", "odd", "outside", "inside"]) if rows else pa.RecordBatch.from_pylist([], pa.schema([("path", pa.string()), ("lo", pa.int64()), ("odd", pa.bool_()), ("outside", pa.int32()), ("inside", pa.int32())]))


_KEY = re.compile(rb'\s*"((?:[^"\\]|\\.)*)"\s*:\s*(.)', re.S)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys at depth 1 that begin in a range: where, the name, the first sign of the value."""
    schema = pa.schema([("path", pa.string()), ("at", pa.int64()), ("key", pa.string()), ("first", pa.string())])
    for b in batches:
        rows = []
        for r in b.to_pylist():
            system, place = _opened(r["path"])
            with system.open_input_file(place) as f:
                p = _Part(f, r["lo"], r["hi"], r["inside"])
                # An opening quote stands at depth 1, and a colon follows its string.
                opening = np.flatnonzero(p.quote & ~p.outside & (p.depth(r["depth"]) == 1))
                for at in opening.tolist():
                    ahead = AHEAD_BYTES
                    while True:
                        f.seek(r["lo"] + at)
                        text = f.read(ahead)
                        m = _KEY.match(text)
                        if m or len(text) < ahead or re.match(rb'"(?:[^"\\]|\\.)*"\s*[^\s:]', text, re.S):
                            break
                        ahead *= 4
                    if m:
                        rows.append({"path": r["path"], "at": r["lo"] + at, "key": m[1].decode(), "first": m[2].decode("latin-1")})
        yield pa.RecordBatch.from_pylist(rows, schema)


def _elements(keys: list[tuple[str, int, str]], wanted: set[str], only: tuple[str, str, frozenset] | None):
    """``keys``: path, place and (if it is an array) name of every key at depth 1."""
    schema = pa.schema([("path", pa.string()), ("key", pa.string()), ("at", pa.int64()), ("text", pa.string())])
    number = re.compile(rb'"' + re.escape(only[1].encode()) + rb'"\s*:\s*(-?\d+)') if only else None

    def rest(f, at: int) -> bytes | None:
        """The element that begins at ``at``, None if it doesn't end."""
        size = 1 << 20
        while True:
            p = _Part(f, at, at + size, False)
            closed = np.flatnonzero(p.depth(0) == 0)
            if len(closed):
                return p.data[: closed[0] + 1].tobytes()
            if len(p.data) < size:
                return None
            size *= 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                mine = [(at, k) for path, at, k in keys if path == r["path"]]
                places, names = np.array([at for at, _ in mine]), [k for _, k in mine]
                system, place = _opened(r["path"])
                rows = []
                with system.open_input_file(place) as f:
                    p = _Part(f, r["lo"], r["hi"], r["inside"])
                    depth = p.depth(r["depth"])
                    step = np.where(p.outside, p.step, 0)
                    starts, ends = np.flatnonzero((step == 1) & (depth == 3)), np.flatnonzero((step == -1) & (depth == 2))
                    stop = np.searchsorted(ends, starts)
                    of = np.searchsorted(places, starts + r["lo"], "right") - 1
                    data = p.data
                    for s, e, k in zip(starts.tolist(), stop.tolist(), of.tolist(), strict=True):
                        if k < 0 or names[k] not in wanted:
                            continue
                        text = data[s : ends[e] + 1].tobytes() if e < len(ends) else rest(f, r["lo"] + s)
                        if text is None or (only and names[k] == only[0] and not ((m := number.search(text)) and int(m[1]) in only[2])):
                            continue
                        rows.append({"path": r["path"], "key": names[k], "at": r["lo"] + s, "text": text.decode()})
                for at in range(0, len(rows), 10_000):
                    yield pa.RecordBatch.from_pylist(rows[at : at + 10_000], schema)

    return run


def elements(spark: SparkSession, paths: list[str], keys: tuple[str, ...], only: tuple[str, str, list[int]] | None = None) -> DataFrame:
    """path, key, at (the byte where it begins), text of each element of the arrays ``keys`` of the documents' outermost objects.

    ``only`` (key, field, values) drops elements of an array by a field of whole numbers before they leave the reader.
    Files that don't exist are passed over.
    """
    ranges = [(p, lo, min(n, lo + RANGE_BYTES), n, False, 0) for p in paths if (n := size_of(p)) for lo in range(0, n, RANGE_BYTES)]
    result = "path string, key string, at long, text string"
    if not ranges:
        return spark.createDataFrame([], result)
    spread = lambda rows: spark.createDataFrame(rows, _RANGES).repartition(len(rows), "path", "lo")
    found = {(r["path"], r["lo"]): r for r in spread(ranges).mapInArrow(_states, "path string, lo long, odd boolean, outside int, inside int").collect()}
    known, before = [], None
    for path, lo, hi, size, _, _ in ranges:
        if path != before:
            before, inside, depth = path, False, 0
        known.append((path, lo, hi, size, inside, depth))
        r = found[path, lo]
        depth, inside = depth + (r["inside"] if inside else r["outside"]), inside != r["odd"]
    outer = spread(known).mapInArrow(_keys, "path string, at long, key string, first string").limit(MOST_KEYS + 1).collect()
    if len(outer) > MOST_KEYS:
        raise ValueError(f"more than {MOST_KEYS} keys in the outermost objects of {paths}")
    arrays = sorted((r["path"], r["at"], r["key"] if r["first"] == "[" else "") for r in outer)
    chosen = (only[0], only[1], frozenset(only[2])) if only else None
    return spread(known).mapInArrow(_elements(arrays, set(keys), chosen), result)
