"""The cache of rewrites: stopped and resumed runs, refusals, torn lines, changed seeds."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from loamstack.functions import text as X
from loamstack.operators.rewrite_cache import RewriteCache


def asked(spark, n, prefix="q"):
    rows = [(f"id{i}", "description", "text", f"{prefix}{i}", f"plain answer {i}") for i in range(n)]
    return spark.createDataFrame(rows, "qa_id string, task string, output_format string, question string, answer string")


def counting(folder, fails=None):
    """A model that notes each call as a file, and fails at one question."""

    def model(question, answer):
        if question == fails:
            raise RuntimeError("stopped")
        os.close(os.open(f"{folder}/{os.getpid()}-{question}-{len(os.listdir(folder))}", os.O_CREAT))
        return "politely: " + answer

    return model


def test_a_stopped_run_goes_on_where_it_was(spark, tmp_path):
    calls = [tmp_path / "one", tmp_path / "two"]
    for c in calls:
        c.mkdir()
    r = asked(spark, 60)
    cache = RewriteCache(spark, str(tmp_path / "cache"))
    steps = {x["question"]: x["s"] for x in r.select("question", F.pmod(F.conv(F.substring(X.cache_key(F.col("task"), F.col("question"), F.col("answer")), 1, 8), 16, 10).cast("long"), F.lit(6)).alias("s")).collect()}
    victim = next(q for q, s in steps.items() if s == 4)
    with pytest.raises(Exception, match="stopped"):
        cache.fill(r, counting(calls[0], victim), steps=6, workers=2)
    done = {q for q, s in steps.items() if s < 4}
    # Steps before the failure are there, though the job ended with an error.
    assert {x["k"] for x in cache.rows().collect()} == {x["k"] for x in r.filter(F.col("question").isin(*done)).select(X.cache_key(F.col("task"), F.col("question"), F.col("answer")).alias("k")).collect()}
    cache.fill(r, counting(calls[1]), "m", workers=2)
    again = {f.name.split("-")[1] for f in calls[1].iterdir()}
    assert again == set(steps) - done and len(list(calls[1].iterdir())) == len(again)
    out = cache.apply(r).collect()
    assert len(out) == 60 and all(x["answer"] == "politely: " + x["answer_template"] and x["rewritten"] for x in out)
    # What was rewritten keeps its key, and other ids don't change it.
    assert cache.missing(asked(spark, 60).withColumn("qa_id", F.lit("other"))).count() == 0
    assert cache.compact(str(tmp_path / "small")).rows().count() == 60


def test_refusals_are_kept_and_torn_lines_are_not(spark, tmp_path):
    r = asked(spark, 20)
    cache = RewriteCache(spark, str(tmp_path / "cache"))
    assert cache.rows().count() == 0 and cache.missing(r).count() == 20
    cache.fill(r, lambda q, a: a + " 99", workers=2)
    assert cache.missing(r).count() == 0 and cache.missing(r, ("facts_changed",)).count() == 20
    assert {x["rewrite_rejected"] for x in cache.apply(r).collect()} == {"facts_changed"}
    cache.fill(r, lambda q, a: "so: " + a, workers=2, again=("facts_changed",))
    assert cache.apply(r).filter("rewritten").count() == 20 and cache.report(r).first()["accepted"] == 20
    file = next(f for f in glob.glob(str(tmp_path / "cache/attempt=2/step=0/*.json")) if os.path.getsize(f))
    with open(file) as f:
        whole = f.read()
    with open(file, "w") as f:
        f.write(whole.rstrip("\n")[:-9])
    for crc in glob.glob(str(tmp_path / "cache/attempt=2/step=0/.*.crc")):
        os.unlink(crc)
    assert cache.rows().count() == 39 and cache.missing(r, ("facts_changed",)).count() == 1


def test_nothing_to_ask(spark, tmp_path):
    cache = RewriteCache(spark, str(tmp_path / "cache"))
    assert cache.fill(asked(spark, 0), lambda q, a: a) == 1 and cache.rows().count() == 0
