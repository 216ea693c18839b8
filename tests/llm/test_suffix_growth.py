"""What the sorting of suffix_dedup gets must not grow with chance meetings, nor with what stands around a common passage."""

import numpy as np

from loamstack.llm import suffix_dedup


def test_common_passage_is_sorted_once(monkeypatch):
    sorted_, plain = [], suffix_dedup.least_of_windows
    monkeypatch.setattr(suffix_dedup, "least_of_windows", lambda texts, *a: sorted_.extend(texts) or plain(texts, *a))
    rng = np.random.default_rng(0)
    letters = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8))
    passage = letters(55)
    texts = [passage + letters(20) for _ in range(300)] + [letters(10) + passage[:30] + letters(35) for _ in range(100)]
    least = rng.permutation(len(texts)) + 5
    flat, begin = suffix_dedup.least_by_anchor(texts, least, np.zeros(len(texts), np.int64))
    want = {}
    for t, n in zip(texts, least):
        for p in range(len(t) - 49):
            want[t[p : p + 50]] = min(want.get(t[p : p + 50], 10**6), n)
    assert all(flat[b + p] == want[t[p : p + 50]] for t, b in zip(texts, begin) for p in range(len(t) - 49))
    assert sum(map(len, sorted_)) <= len(flat) / 5  # letters after the passage agree by chance


def test_short_common_strings_give_no_context(spark, monkeypatch):
    found, plain = [], suffix_dedup.materialise
    monkeypatch.setattr(suffix_dedup, "materialise", lambda df, name: found.append((name, plain(df, name))) or found[-1][1])
    rng = np.random.default_rng(1)
    letters = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    words = [letters(16) for _ in range(5)]
    docs = spark.createDataFrame([(i, " ".join(words[i % 5] + letters(25) for _ in range(20))) for i in range(40)], "doc_id long, text string")
    assert [r["n_removed"] for r in suffix_dedup.remove_repeats(docs).collect()] == [0] * 40
    assert dict(found)["contexts"].count() == 0
