"""Vectorised pre-tokenisation and a bounded word cache in front of a public tokenizer.

Byte-pair encoders treat every pre-token on its own, so a batch is cut into pre-tokens with array operations, each
distinct one is encoded once by the tokenizers library and the ids are gathered. This holds for texts whose code
points all lie below ``LIMIT`` (Latin scripts) and that hold no added token's string; the library encodes any other text
as a whole, added tokens included, as it does with ``add_special_tokens=False``.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import cache
from itertools import accumulate, chain, pairwise, repeat

import numpy as np
import pyarrow as pa

#: Below this every code point is stable under NFC; U+0130 alone has a lower case of two code points.
LIMIT = 0x300
_ODD = re.compile("[^\x00-įı-˿]")
#: Fixed value: the byte-level pattern, which byte_level() carries out.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
L, N, O, S = range(4)
#: Words that a worker remembers, those that it learns at a time, and characters that it cuts at a time.
CACHE_WORDS, LEARN_WORDS, CHUNK_CHARS = 200_000, 10_000, 1_000_000


@cache
def kinds() -> np.ndarray:
    """Letter, number, other or white space for code points below LIMIT, as the \\p{L}, \\p{N} and \\s of the patterns."""
    import regex

    out = np.full(LIMIT, O, np.uint8)
    for kind, pattern in ((L, r"\p{L}"), (N, r"\p{N}"), (S, r"\s")):
        for m in regex.finditer(pattern, "".join(map(chr, range(LIMIT)))):
            if chr(m.start()) not in "\x1c\x1d\x1e\x1f":
                out[m.start()] = kind
    return out


@cache
def lowered() -> np.ndarray:
    return np.array([ord(chr(c).lower()[0]) for c in range(LIMIT)], np.uint32)


@cache
def byte_signs() -> np.ndarray:
    """The printable sign by which byte-level vocabularies write each byte: itself, or the next free one from U+0100."""
    shown = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c <= 255]
    rest = [c for c in range(256) if c not in shown]
    return np.array([c if c in shown else 256 + rest.index(c) for c in range(256)], np.uint32)


def plain(text: str) -> bool:
    return text.isascii() or _ODD.search(text) is None


def _runs(kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    new = first.copy()
    new[1:] |= kind[1:] != kind[:-1]
    return new


def _contractions(cp: np.ndarray, first: np.ndarray, start: np.ndarray) -> None:
    """At the start of a pre-token 's 't 'm 'd 're 've 'll stand alone; ``start`` has a place more than ``cp``."""
    q = np.flatnonzero((cp == 39) & start[:-1])
    if not len(q):
        return
    pad = np.concatenate([cp, np.zeros(2, cp.dtype)])
    end = np.concatenate([first, [True, True]])
    a, b = pad[q + 1], pad[q + 2]
    one = np.isin(a, [ord(c) for c in "stmd"]) & ~end[q + 1]
    two = (((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))) & ~end[q + 1] & ~end[q + 2]
    start[q[one | two] + 1] = False
    start[q[one] + 2] = True
    start[q[two] + 3] = True


def byte_level(cp: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of pre-tokens of the byte-level pattern, ends; ``first`` marks the first code point of each text."""
    kind = kinds()[cp]
    space = kind == S
    start = np.append(_runs(kind, first), True)
    after = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:]) + 1
    start[after - 1] = True
    start[after[cp[after - 1] == 32]] = False
    _contractions(cp, first, start)
    at = np.flatnonzero(start)
    return at[:-1], at[1:]


def word_level(cp: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for the word pattern: letters, single numbers, other signs; white space falls out."""
    kind = kinds()[cp]
    start = np.append(_runs(kind, first) | (kind == N), True)
    _contractions(cp, first, start)
    at = np.flatnonzero(start)
    inside = kind[at[:-1]] != S
    return at[:-1][inside], at[1:][inside]


class Words:
    """Distinct pre-tokens of a batch: ``values`` (binary), ``codes`` for each pre-token, ``counts`` for each text."""

    def __init__(self, texts: list[str], level: Callable, lower: bool):
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths)
        cp = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        if lower:
            cp = lowered()[cp]
        first = np.zeros(len(cp), bool)
        first[(ends - lengths)[lengths > 0]] = True
        if len(cp):
            starts, stops = level(cp, first)
        else:
            starts = stops = np.zeros(0, np.int64)
        data = cp.tobytes().decode("utf-32-le").encode()
        size = np.concatenate([[0], np.cumsum(1 + (cp >= 0x80))])
        # Pre-tokens and what lies between them alternate, so one array of offsets serves both.
        cuts = np.empty(2 * len(starts) + 1, np.int32)
        cuts[0:-1:2], cuts[1::2], cuts[-1] = size[starts], size[stops], len(data)
        whole = pa.Array.from_buffers(pa.binary(), 2 * len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(data)])
        found = whole.take(pa.array(np.arange(0, 2 * len(starts), 2))).dictionary_encode() if lower else \
            pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(np.append(size[starts], len(data)).astype(np.int32)), pa.py_buffer(data)]).dictionary_encode()
        self.values, self.codes = found.dictionary, np.asarray(found.indices)
        self.counts = np.diff(np.searchsorted(starts, ends), prepend=0)


class CachedEncoder:
    """Ids of texts as the tokenizers library gives them, without special tokens."""

    def __init__(self, path: str, level: Callable, lower: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.level, self.lower = level, lower
        # The library matches those of the normalized kind in the lowered text.
        self.added = [t.content.lower() if lower else t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._clear()

    def _alone(self, text: str) -> bool:
        """Whether the text's pre-tokens are all there is to it."""
        if not plain(text):
            return False
        low = text.lower() if self.lower else text
        return not any(t in low for t in self.added)

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.uint16), 0
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.hits = np.zeros(1 << 14, np.int32)

    def _shrink(self) -> None:
        """Forget all words but those that came in several chunks, the commonest half of the cache at most."""
        n = len(self.known)
        hits = self.hits[:n]
        least = max(2, int(np.partition(hits, n - CACHE_WORDS // 2)[n - CACHE_WORDS // 2]) + 1 if n > CACHE_WORDS // 2 else 2)
        keep = np.flatnonzero(hits >= least)
        words, start, size, ids = list(self.known), self.start[keep], self.size[keep], self.ids
        self._clear()
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        self._room(len(keep), total)
        self.ids[:total] = ids[np.repeat(start - ends + size, size) + np.arange(total)]
        self.start[: len(keep)], self.size[: len(keep)], self.hits[: len(keep)] = ends - size, size, 1
        self.known = {words[k]: i for i, k in enumerate(keep.tolist())}
        self.used = total

    def _room(self, words: int, ids: int) -> None:
        while ids > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while words > len(self.start):
            self.start, self.size, self.hits = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size, self.hits))

    def _learn(self, all_words: list[bytes]) -> None:
        for at in range(0, len(all_words), LEARN_WORDS):
            self._learn_some(all_words[at : at + LEARN_WORDS])

    def _learn_some(self, words: list[bytes]) -> None:
        encode, n = self.tokenizer.model.tokenize, len(self.known)
        signs = byte_signs()[np.frombuffer(b"".join(words), np.uint8)].tobytes().decode("utf-32-le")
        ends = list(accumulate(map(len, words), initial=0))
        found = [[t.id for t in encode(signs[a:b])] for a, b in pairwise(ends)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        total = int(sizes.sum())
        self._room(n + len(words), self.used + total)
        self.ids[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.uint16, total)
        self.size[n : n + len(words)] = sizes
        self.start[n : n + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.known.update(zip(words, range(n, n + len(words)), strict=True))
        self.used += total

    def _places(self, values: list[bytes]) -> np.ndarray:
        """Where each of the distinct words stands in the cache, which learns those that it lacks."""
        at = np.fromiter(map(self.known.get, values, repeat(-1)), np.int64, len(values))
        new = np.flatnonzero(at < 0)
        if len(new):
            if len(self.known) + len(new) > CACHE_WORDS and self.known:
                self._shrink()
                at = np.fromiter(map(self.known.get, values, repeat(-1)), np.int64, len(values))
                new = np.flatnonzero(at < 0)
            # Learnt words take the next places in turn.
            at[new] = len(self.known) + np.arange(len(new))
            self._learn([values[i] for i in new.tolist()])
        self.hits[at] += 1
        return at

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words = Words(texts, self.level, self.lower)
        at = self._places(words.values.to_pylist())
        start, size = self.start[at], self.size[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        # The ids of each distinct word once, as strings of bytes, which are then dealt out as such.
        own = self.ids[np.repeat(start - ends + size, size) + np.arange(total)]
        if len(words.codes) == 0:
            return own[:0], words.counts
        dealt = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer((2 * np.append(0, ends)).astype(np.int32)), pa.py_buffer(own.tobytes())]).take(pa.array(words.codes))
        bounds = np.frombuffer(dealt.buffers()[1], np.int32, len(words.codes) + 1) // 2
        ids = np.frombuffer(dealt.buffers()[2], np.uint16, int(bounds[-1]))
        return ids, np.diff(bounds[np.concatenate([[0], np.cumsum(words.counts)])]).astype(np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint16) one text after the other, and how many each text has."""
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        part: list[str] = []
        size = 0

        def flush() -> None:
            nonlocal part, size
            if part:
                i, c = self._plain(part)
                ids.append(i)
                counts.append(c)
                part, size = [], 0

        for t in texts:
            if self._alone(t):
                part.append(t)
                size += len(t)
                if size >= CHUNK_CHARS:
                    flush()
            else:
                flush()
                own = np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint16)
                ids.append(own)
                counts.append(np.array([len(own)]))
        flush()
        return (np.concatenate(ids) if ids else np.zeros(0, np.uint16)), (np.concatenate(counts) if counts else np.zeros(0, np.int64))


@cache
def encoder(path: str, words: bool) -> CachedEncoder:
    """One for each process. ``words``: the file's pattern is the word pattern, over lowered text."""
    return CachedEncoder(path, word_level if words else byte_level, words)
