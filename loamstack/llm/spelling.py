"""Spelling variants: each word's distance-one automaton runs depth-first through shards of a compact trie.

1. Words are counted in the map tasks and added up. Those that are frequent enough form the vocabulary.
2. The vocabulary, dealt by ranges, becomes shards of at most ``SHARD_LETTERS`` letters (one longer word is a shard of its
   own): a trie as three arrays, nodes in level order, so that the children of a node stand together. Some shards at a
   time, at most ``PASS_BYTES`` (or one shard), are broadcast; the vocabulary streams past them.
3. A task walks blocks of words down a shard: states without an edit step to the matching child and leave states with one
   edit for every other child (replaced, inserted) and for the skipped letter (deleted); states with an edit follow
   exact letters to their end before the walk goes on. An edit inside a run of equal letters is made at the run's last
   place only, so every neighbour is accepted once. What a shard gives for a word is reduced to a count and a best form.
4. Counts and best forms of all shards are reduced by word, and roots are found by pointer doubling: a form is at least
   ``ratio`` times as frequent, so a chain is short.

Nothing is left out: every word meets every shard, though a shard whose words all start elsewhere ends in its first nodes.

Edge cases: null and empty texts have no words; repeated rows count again; a null doc_id is written as an empty text in the
letter drop; ties of forms go to the smaller word in code-point order; a word without near words is its own root; an
empty table gives an empty result; other columns are never looked at. Words hold no line break.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamstack.llm.store import materialise, new_path, small_batches

#: Letters of a run, the share of runs that lose a letter, limits of the vocabulary and of a form.
LETTERS, DROP, LEAST_LETTERS, LEAST_COUNT, RATIO = "a-zÀ-ÿ", 31, 7, 2, 10
#: Distinct words that a map task holds before it writes their counts.
HELD_WORDS = 150_000
SHARD_LETTERS, PASS_BYTES = 1_000_000, 16 << 20
#: Words of a task and of a block of states, rows of a batch.
TASK_WORDS, BLOCK_WORDS = 60_000, 4000
#: Bits of a code point.
POINT = 21


def dropped_letter(prefix: int, word: str) -> str:
    """``word`` without one letter, if DROP divides the checksum of the document's prefix and the word."""
    h = zlib.crc32(word.encode(), prefix)
    if h % DROP:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _count(least: int, change: Callable[[int, str], str] | None):
    run = re.compile(f"[{LETTERS}]{{{least},}}")

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(known), pa.string()), pa.array(list(known.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if not t.is_valid:
                    continue
                # bytes.lower() changes A-Z alone. Shorter runs can't become words.
                found = Counter(run.findall(t.as_py().encode().lower().decode()))
                prefix = zlib.crc32(f"{'' if d is None else d}:".encode())
                for w, n in found.items():
                    if change and len(w := change(prefix, w)) < least:
                        continue
                    known[w] = known.get(w, 0) + n
                if len(known) >= HELD_WORDS:
                    yield rows()
                    known = {}
        if known:
            yield rows()

    return go


def count_words(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, change: Callable[[int, str], str] | None = None) -> DataFrame:
    """word, n: runs of letters in lower case (A-Z only), each through ``change`` (checksum of ``doc_id:``, run) if given."""
    small_batches(docs.sparkSession)
    counted = docs.select("doc_id", "text").mapInArrow(_count(least_letters, change), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words, where each starts, its length."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), np.cumsum(size) - size, size


def build_trie(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted distinct words: the label of each node (0: root), the first child of each node and one more, the word that ends there or -1."""
    flat, start, size = _points(words)
    node, active, count, depth = np.zeros(len(words), np.int64), np.arange(len(words)), 1, 0
    labels, parents = [np.zeros(1, np.uint32)], []
    while True:
        active = active[size[active] > depth]
        if not len(active):
            break
        letter, parent = flat[start[active] + depth], node[active]
        new = np.ones(len(active), bool)
        new[1:] = (parent[1:] != parent[:-1]) | (letter[1:] != letter[:-1])
        node[active] = np.cumsum(new) - 1 + count
        labels.append(letter[new])
        parents.append(parent[new])
        count, depth = count + int(new.sum()), depth + 1
    above = np.concatenate(parents) if parents else np.zeros(0, np.int64)
    first = np.searchsorted(above, np.arange(count + 1)) + 1
    ends = np.full(count, -1, np.int32)
    ends[node] = np.arange(len(words))
    return np.concatenate(labels), first.astype(np.int32), ends


_SHARD = "labels binary, first binary, ends binary, words binary, counts binary, size long"


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: list[str] = []
    counts: list[int] = []
    letters = 0

    def row() -> pa.RecordBatch:
        parts = [x.tobytes() for x in build_trie(words)] + ["\n".join(words).encode(), np.array(counts, np.int64).tobytes()]
        return pa.RecordBatch.from_arrays([*(pa.array([x], pa.binary()) for x in parts), pa.array([sum(map(len, parts))], pa.int64())], names=["labels", "first", "ends", "words", "counts", "size"])

    for b in batches:
        for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if words and letters + len(w) > SHARD_LETTERS:
                yield row()
                words, counts, letters = [], [], 0
            words.append(w)
            counts.append(n)
            letters += len(w)
    if words:
        yield row()


class Shard:
    """A trie with the counts of its words."""

    def __init__(self, labels: bytes, first: bytes, ends: bytes, words: bytes, counts: bytes):
        self.labels, self.first, self.ends = np.frombuffer(labels, np.uint32), np.frombuffer(first, np.int32), np.frombuffer(ends, np.int32)
        self.counts, self.words = np.frombuffer(counts, np.int64), words
        self.breaks = np.concatenate([[-1], np.flatnonzero(np.frombuffer(words, np.uint8) == 10), [len(words)]])
        # Parent and label of each node but the root, in ascending order.
        self.steps = np.repeat(np.arange(len(self.labels)), np.diff(self.first)) << POINT | self.labels[1:]

    def word(self, i: int) -> str:
        return self.words[self.breaks[i] + 1 : self.breaks[i + 1]].decode()

    def near(self, flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number of a given word, number of a word of the shard) at distance one, each once."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        letters = np.append(flat, np.uint32(0))

        def finish(w: np.ndarray, node: np.ndarray, at: np.ndarray) -> None:
            """States with an edit: exact letters only."""
            while len(w):
                over = at == size[w]
                if over.any():
                    word = self.ends[node[over]]
                    ok = word >= 0
                    found.append((w[over][ok], word[ok]))
                    go = ~over
                    w, node, at = w[go], node[go], at[go]
                step = node << POINT | letters[start[w] + at]
                place = np.searchsorted(self.steps, step)
                hit = np.flatnonzero(self.steps[np.minimum(place, len(self.steps) - 1)] == step)
                w, node, at = w[hit], place[hit] + 1, at[hit] + 1

        # States without an edit: one for each word, all at one depth.
        w, node, depth = np.arange(len(size)), np.zeros(len(size), np.int64), 0
        while len(w):
            inside = size[w] > depth
            letter = letters[start[w] + np.minimum(depth, size[w])].astype(np.int64)
            letter[~inside] = -1
            after = letters[start[w] + np.minimum(depth + 1, size[w])]
            last = inside & ((size[w] == depth + 1) | (after != letter))
            finish(w[last], node[last], np.full(int(last.sum()), depth + 1))
            n = self.first[node + 1] - self.first[node]
            rep = np.repeat(np.arange(len(w)), n)
            child = np.arange(len(rep)) + np.repeat(self.first[node] - np.cumsum(n, dtype=np.int64) + n, n)
            same = self.labels[child] == letter[rep]
            other = np.flatnonzero(~same)
            of, to = rep[other], child[other]
            finish(w[of], to, np.full(len(of), depth))
            replaced = inside[of]
            finish(w[of[replaced]], to[replaced], np.full(int(replaced.sum()), depth + 1))
            w, node, depth = w[rep[same]], child[same], depth + 1
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found]).astype(np.int64)

    def reduced(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the words that have near ones here, how many, and the most frequent of these (ties: the smallest)."""
        a, b = self.near(*_points(words))
        order = np.lexsort((b, -self.counts[b], a))
        a, b = a[order], b[order]
        head = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, np.int64)
        return a[head], np.diff(np.append(head, len(a))), b[head]


def _match(shards):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = [Shard(*x) for x in shards.value]
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_WORDS):
                words = whole.column(0).slice(at, BLOCK_WORDS).to_pylist()
                for t in tries:
                    own, n, best = t.reduced(words)
                    columns = [[words[i] for i in own], n, [t.word(i) for i in best], t.counts[best]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], names=["word", "n_near", "form", "form_n"])

    return go


def near_forms(words: DataFrame) -> DataFrame:
    """word, n_near, form, form_n for the words (word, n; distinct) that have near ones."""
    spark, path = words.sparkSession, new_path(words.sparkSession, "near-words")
    n, letters = words.agg(F.count("*"), F.sum(F.length("word"))).first()
    ranges, tasks = math.ceil((letters or 0) / SHARD_LETTERS) or 1, math.ceil(n / TASK_WORDS) or 1
    built = words.select("word", "n").repartitionByRange(ranges, "word").sortWithinPartitions("word").mapInArrow(_shards, _SHARD)
    shards = materialise(built.select(F.monotonically_increasing_id().alias("shard"), "*"), "trie-shards")
    passes: list[list[int]] = []
    held = 0
    for shard, size in shards.select("shard", "size").orderBy("shard").collect():
        if not passes or held + size > PASS_BYTES:
            passes.append([])
            held = 0
        passes[-1].append(shard)
        held += size
    kind = "word string, n_near long, form string, form_n long"
    for k, some in enumerate(passes):
        rows = shards.filter(F.col("shard").isin(some)).select("labels", "first", "ends", "words", "counts").collect()
        sent = spark.sparkContext.broadcast([tuple(map(bytes, r)) for r in rows])
        words.select("word").repartition(tasks, "word").mapInArrow(_match(sent), kind).write.parquet(f"{path}/pass={k}")
        sent.unpersist()
    found = spark.read.schema(kind).parquet(path) if passes else spark.createDataFrame([], kind)
    best = F.min(F.struct((-F.col("form_n")).alias("order"), F.col("form").alias("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", "best.form", (-F.col("best.order")).alias("form_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """word, root for word, form (distinct words; chains without circles)."""
    roots = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = materialise(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = new.select("word", "root")
        if new.filter("moved").limit(1).count() == 0:
            return roots


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for distinct words (word, n)."""
    kept = materialise(words.select("word", F.col("n").cast("long").alias("n")), "words")
    joined = kept.join(near_forms(kept), "word", "left")
    is_form = F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False))
    judged = materialise(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n")), "forms")
    rooted = judged.join(_roots(judged.filter("form IS NOT NULL")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
