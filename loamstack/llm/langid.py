"""Language identification by nearest centroid over normalised TF-IDF vectors of character n-grams.

Texts are lowered, everything but letters becomes one boundary sign, and the 2- and 3-grams with at least one letter
are hashed into ``DIM`` places. Document frequencies are counted over every training text. The centroids (a few for
each language, by spherical k-means with farthest-point starts) are fitted on at most ``sample_per_language`` training
texts of each language, those with the least hashes of doc_id. A text goes to the language of the centroid with the
largest cosine. Cosines grow with length, of noise too, so the largest distance that is accepted is fitted for each
doubling of the number of n-grams, on every training text: a text is rejected if its cosine is below ``slack`` times the
lowest percentile of training texts of its length.

Edge cases: a null text or one without letters is ``und`` with score 0, and rejected; ties go to the language that
sorts first; a model without training texts answers ``und`` for all; an empty table gives an empty result; repeated
rows each get their result. Only doc_id, text and (to train) lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loamstack.llm.store import small_batches

BITS = 13
DIM = 1 << BITS
SAMPLE_PER_LANGUAGE = 400
CENTROIDS = 4
BUCKETS = 256
#: Rejection: the share of the percentile that a cosine has to reach, the percentile, texts that it takes at least, steps of a cosine.
SLACK, LOWEST, LEAST_TEXTS, STEPS = 0.5, 0.01, 100, 400
#: What a cosine has to reach at any length; the only limit for lengths below which there are fewer than LEAST_TEXTS.
LEAST_COSINE = 0.03
#: Lengths are told apart by doublings of the number of n-grams, up to this one.
DOUBLINGS = 32
#: Texts and characters that are counted at a time.
CHUNK_ROWS, CHUNK_CHARS = 64, 500_000


@cache
def _lowered() -> np.ndarray:
    """For each code point of the first plane the code of its lower-case letter, 0 if it is none."""
    table = np.zeros(0x10000, np.uint32)
    for c in range(0x10000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low[0])
    return table


def chunks(texts: list[str | None]) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t or "")
        size += len(part[-1])
        if len(part) >= CHUNK_ROWS or size >= CHUNK_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def term_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed n-grams, a row for each text, and whether it has a letter."""
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    table = _lowered()
    x = table[np.minimum(codes, 0xFFFF)]
    far = np.flatnonzero(codes > 0xFFFF)
    if len(far):  # few signs, so each is looked up once
        found, at = np.unique(codes[far], return_inverse=True)
        x[far] = np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else 0 for c in found], np.uint32)[at]
    keep = x > 0
    keep[1:] |= keep[:-1].copy() if len(x) else False  # one boundary after each word
    row = np.repeat(np.arange(len(texts), dtype=np.int64), lengths)[keep]
    letters = np.bincount(row, minlength=len(texts)) > 0
    x = x[keep]
    n = len(texts) * DIM
    out = np.zeros(n, np.int64)
    if len(x) >= 2:
        same = row[1:] == row[:-1]
        two = x[:-1] * np.uint32(0x01000193) + x[1:]
        at = (two * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        base = row[:-1] * DIM
        out += np.bincount((base + at)[same], minlength=n)
        if len(x) >= 3:
            three = (two[:-1] ^ np.uint32(0x5BD1E995)) * np.uint32(0x01000193) + x[2:]
            at = (three * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)
            out += np.bincount((base[:-1] + at)[same[:-1] & same[1:]], minlength=n)
    return out.reshape(len(texts), DIM), letters


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.sqrt(counts, dtype=np.float32) * idf
    norm = np.sqrt(np.einsum("ij,ij->i", v, v))
    return v / np.maximum(norm, 1e-12)[:, None]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, seen = 0, np.zeros(DIM, np.int64)
    for b in batches:
        for part in chunks(b.column(0).to_pylist()):
            counts, _ = term_counts(part)
            seen += (counts > 0).sum(0)
            n += len(part)
    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([seen.tolist()], pa.list_(pa.int64()))], names=["n", "df"])


def _centroids(idf: np.ndarray, k: int, rounds: int = 12):
    def fit(table: pa.Table) -> pa.Table:
        v = np.concatenate([weighted(term_counts(part)[0], idf) for part in chunks(table["text"].to_pylist())])
        start = [0]
        for _ in range(min(k, len(v)) - 1):
            start.append(int((v @ v[start].T).max(1).argmin()))
        c = v[start]
        for _ in range(rounds):
            own = (v @ c.T).argmax(1)
            c = np.stack([v[own == i].mean(0) if (own == i).any() else c[i] for i in range(len(c))])
            c /= np.maximum(np.linalg.norm(c, axis=1), 1e-12)[:, None]
        return pa.table({"lang": [table["lang"][0].as_py()] * len(c), "centroid": pa.array(c.astype(np.float32).tolist(), pa.list_(pa.float32()))})

    return fit


def _doubling(counts: np.ndarray) -> np.ndarray:
    """The length of each text as a number of doublings."""
    return np.log2(np.maximum(counts.sum(1), 1)).astype(np.int64).clip(0, DOUBLINGS - 1)


def _cosines(texts: list[str | None], idf: np.ndarray, centroids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of texts the cosines with all centroids, whether there are letters, and the lengths."""
    for part in chunks(texts):
        counts, letters = term_counts(part)
        yield np.clip(weighted(counts, idf) @ centroids.T, 0, 1), letters, _doubling(counts)


def limits(histogram: np.ndarray, slack: float) -> np.ndarray:
    """The least cosine that is accepted for each length, from counts of training texts by length and cosine."""
    out = np.full(len(histogram), LEAST_COSINE)
    for i in range(len(histogram)):
        # Where texts of a length are few, shorter ones (whose cosines are lower) are judged with them.
        first = next((k for k in range(i, -1, -1) if histogram[k : i + 1].sum() >= LEAST_TEXTS), None)
        if first is not None:
            below = np.cumsum(histogram[first : i + 1].sum(0))
            out[i] = max(LEAST_COSINE, slack * int(np.searchsorted(below, LOWEST * below[-1], "right")) / STEPS)
    return out


def _histogram(idf: np.ndarray, centroids: np.ndarray):
    """Counts of texts by length and step of their best cosine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((DOUBLINGS, STEPS + 1), np.int64)
        for b in batches:
            for sims, letters, length in _cosines(b.column(0).to_pylist(), idf, centroids):
                np.add.at(out, (length[letters], (sims.max(1)[letters] * STEPS).astype(np.int64)), 1)
        length, step = np.nonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(length, pa.int32()), pa.array(step, pa.int32()), pa.array(out[length, step])], names=["length", "step", "n"])

    return run


class LanguageModel:
    """idf of shape (DIM,), centroids of shape (n, DIM), the language of each centroid, and the least cosine for each length."""

    def __init__(self, idf: np.ndarray, centroids: np.ndarray, langs: list[str], least: np.ndarray | None = None):
        self.idf, self.centroids, self.langs = idf, centroids, langs
        self.least = np.full(DOUBLINGS, LEAST_COSINE) if least is None else least

    @classmethod
    def fit(cls, train: DataFrame, k: int = CENTROIDS, sample_per_language: int = SAMPLE_PER_LANGUAGE, slack: float = SLACK) -> LanguageModel:
        """``train``: doc_id, text, lang, all of which are training rows."""
        small_batches(train.sparkSession)
        train = train.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
        parts = train.select("text").mapInArrow(_frequencies, "n long, df array<long>")
        total = parts.select("n", F.posexplode("df").alias("at", "df")).groupBy("at").agg(F.sum("df").alias("df"), F.sum("n").alias("n")).collect()
        df, n = np.zeros(DIM), 0
        for r in total:
            df[r["at"]], n = r["df"], r["n"]
        idf = (np.log((1 + n) / (1 + df)) + 0.1).astype(np.float32)
        # Ranked within hash buckets first, so that the last step sees a bounded number of ids of each language, however many tasks there are.
        ids = train.select("doc_id", "lang").withColumn("_b", F.pmod(F.hash("doc_id"), F.lit(BUCKETS)))
        for by in (["lang", "_b"], ["lang"]):
            rank = F.row_number().over(W.partitionBy(*by).orderBy(F.xxhash64("doc_id"), "doc_id"))
            ids = ids.withColumn("r", rank).filter(F.col("r") <= sample_per_language).drop("r")
        picked = ids.select("doc_id").distinct()
        # At most sample_per_language ids of each language.
        sample = train.join(F.broadcast(picked), "doc_id", "left_semi").groupBy("lang").applyInArrow(_centroids(idf, k), "lang string, centroid array<float>")
        rows = sorted(sample.collect(), key=lambda r: r["lang"])
        centroids = np.array([r["centroid"] for r in rows], np.float32).reshape(len(rows), DIM)
        histogram = np.zeros((DOUBLINGS, STEPS + 1), np.int64)
        if rows:
            for r in train.select("text").mapInArrow(_histogram(idf, centroids), "length int, step int, n long").groupBy("length", "step").agg(F.sum("n").alias("n")).collect():
                histogram[r["length"], r["step"]] = r["n"]
        return cls(idf, centroids, [r["lang"] for r in rows], limits(histogram, slack))

    def predict(self, docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
        """The columns ``carry`` (doc_id) with lang_pred, score (cosine, 0 to 1) and rejected."""
        carry = ["doc_id"] if carry is None else carry
        idf, centroids, langs, least = self.idf, self.centroids, self.langs, self.least

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                pred, score, rejected = [], [], []
                texts = b.column(b.num_columns - 1).to_pylist()
                for sims, letters, length in _cosines(texts, idf, centroids) if langs else ():
                    best = sims.argmax(1)
                    top = np.where(letters, sims[np.arange(len(best)), best], 0)
                    pred += [langs[i] if ok else "und" for i, ok in zip(best, letters, strict=True)]
                    score += top.tolist()
                    rejected += (~letters | (top < least[length])).tolist()
                if not langs:
                    pred, score, rejected = ["und"] * len(texts), [0.0] * len(texts), [True] * len(texts)
                yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(b.num_columns - 1)], pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                                                 names=[*b.schema.names[:-1], "lang_pred", "score", "rejected"])

        given = docs.select(*[F.col(f"`{c}`") for c in carry], F.col("text").alias("_text"))
        kinds = [f"`{n}` {t}" for n, t in given.dtypes[:-1]]
        return given.mapInArrow(run, ", ".join([*kinds, "lang_pred string, score double, rejected boolean"]))


def drop_rejected(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` without the rows that the model rejects. Whole rows pass beside the text, so no column name can clash."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text")
    return model.predict(rows, ["_row"]).filter("not rejected").select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4
