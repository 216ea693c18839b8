"""The pipeline's stages on a small table, each with its decision in effect."""

import random

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, tmp_path):
    rng = random.Random(0)
    parts = {"aa": ["ba", "ko", "mi", "tu"], "bb": ["sch", "ung", "keit", "ver"]}
    text = lambda lang, n: " ".join("".join(rng.choices(parts[lang], k=3)) for _ in range(n))
    rows = [(i, text(sorted(parts)[i % 2], 60), sorted(parts)[i % 2], "s") for i in range(80)]
    near = rows[5][1].split()
    near[30] = "xx"
    rows += [(100, rows[3][1], "aa", "s"), (101, " ".join(near), "bb", "s"), (102, "12345 !!", "aa", "s"), (103, None, "aa", "s"), (104, text("aa", 40) + ' token = "0123456789abcdef0123456789abcdef01234567"', "aa", "s")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == COLUMNS
        left[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {102, 103} & set(left["language ID"]) == set() and len(left["language ID"]) == len(rows) - 2
    assert set(left["language ID"]) - set(left["exact dedup"]) == {100}
    assert set(left["exact dedup"]) - set(left["MinHash near-dedup"]) == {101}
    assert "[SECRET]" in left["secret scans"][104] and "0123456789abcdef" not in left["secret scans"][104]
    assert all(left["secret scans"][i] == t for i, t in left["MinHash near-dedup"].items() if i != 104)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in packed.collect()} == set(left["secret scans"])
    path = tmp_path / "documents.parquet"
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(path))
    assert corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().count() == len(left["secret scans"])
