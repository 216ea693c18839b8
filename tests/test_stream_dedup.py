"""Duplicates across micro-batches far apart, batches that run twice, and keys that a batch table brought."""

import json

from pyspark.sql import functions as F

from loamstack.streaming.dedup import SeenIndex

SCHEMA = "image string, question string, at timestamp"


def drop(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(dict(zip(("image", "question", "at"), r, strict=True))) + "\n" for r in rows))


def test_duplicates_a_day_apart(spark, tmp_path):
    index = SeenIndex(spark, str(tmp_path / "index"), ["image", "question"])
    index.add(spark.createDataFrame([("old", "q", None)], SCHEMA), "table")
    source = tmp_path / "in"
    run = lambda: index.stream(spark.readStream.schema(SCHEMA).json(str(source)), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    drop(source, "1.json", [("a", "q", "2024-01-01T00:00:00"), ("a", "q", "2024-01-01T00:00:05"), ("b", None, "2024-01-01T00:00:00"), ("old", "q", "2024-01-01T00:00:00"), ("ab", "", "2024-01-01T00:00:00"), ("a", "b", "2024-01-01T00:00:00")])
    run()
    drop(source, "2.json", [("a", "q", "2024-01-02T00:00:00"), ("b", None, "2024-01-02T00:00:00"), ("c", "q", "2024-01-02T00:00:00"), ("", "ab", "2024-01-02T00:00:00")])
    run()
    out = spark.read.parquet(str(tmp_path / "out"))
    got = sorted((r["image"], r["question"] or "-", str(r["at"])[:10]) for r in out.collect())
    assert got == sorted([("a", "q", "2024-01-01"), ("b", "-", "2024-01-01"), ("ab", "-", "2024-01-01"), ("a", "b", "2024-01-01"), ("c", "q", "2024-01-02"), ("", "ab", "2024-01-02")])
    assert out.filter("image = 'a' and question = 'q'").select(F.second("at").alias("s")).first()["s"] == 0
    # A batch that runs again gives the same rows, once.
    again = spark.read.schema(SCHEMA).json(str(source / "2.json"))
    index.add(again, "s1", str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6 and index.keys().count() == 7
    small = index.compact(str(tmp_path / "small"))
    small.add(again, "later", str(tmp_path / "more"))
    assert small.keys().count() == 7 and spark.read.parquet(str(tmp_path / "more")).count() == 0
