"""Chained sampling against brute force over sorted draws, with closer looks forced by small limits."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from loamstack.operators import balance, chain


def draw(seed, i):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i


def made(n=900):
    rng = random.Random(4)
    return [(i, rng.choice(["a", "a", "a", "b", "c", None]), rng.choice(["normal", "normal", "anomalous"])) for i in range(n)]


def brute(rows, share, ratio, weights, seed=0):
    sizes = {}
    for _, d, label in rows:
        sizes[d, label] = sizes.get((d, label), 0) + 1
    takes = balance.share_takes(sizes, share)
    rows = sorted(rows, key=lambda r: draw(seed, r[0]))
    left, seen = [], {}
    for r in rows:
        seen[r[1:]] = seen.get(r[1:], 0) + 1
        if seen[r[1:]] <= takes.get(r[1:], 0):
            left.append(r)
    n, out, normal = sum(r[2] == "anomalous" for r in left), [], 0
    for r in left:
        normal += r[2] == "normal"
        if r[2] != "normal" or normal <= int(n * ratio):
            out.append(r)
    if weights is None:
        return sorted((r[0], None) for r in out)
    copies = []
    for d in {r[1] for r in out}:
        mine = [r for r in out if r[1] == d]
        want = round(len(mine) * weights.get(d, 1.0))
        copies += [(mine[k % len(mine)][0], k // len(mine)) for k in range(want)]
    return sorted(copies)


@pytest.mark.parametrize(("few", "counts"), [(5000, 2_000_000), (2, 200)])
@pytest.mark.parametrize("weights", [None, {"a": 0.5, "b": 2.4, "c": 0.0}])
def test_steps_against_brute_force(spark, monkeypatch, few, counts, weights):
    monkeypatch.setattr(chain, "FEW", few)
    monkeypatch.setattr(chain, "MOST_COUNTS", counts)
    monkeypatch.setattr(chain, "MORE", 1 if few == 2 else 4)
    rows = made()
    df = spark.createDataFrame(rows, "sample_id long, dataset string, label string").withColumn("_take", F.lit("own"))
    s = balance.Sampling(df).cap_source_share(0.4).balance_labels(0.7)
    if weights:
        s = s.weigh_sources(weights)
    got = s.apply()
    assert sorted((r["sample_id"], r["_copy"] if weights else None) for r in got.collect()) == brute(rows, 0.4, 0.7, weights)
    assert set(df.columns) <= set(got.columns)


def test_steps_read_the_rows_once(spark, tmp_path):
    spark.createDataFrame(made(50), "sample_id long, dataset string, label string").write.parquet(str(tmp_path / "t"))
    s = balance.Sampling(spark.read.parquet(str(tmp_path / "t"))).cap_source_share(0.4).balance_labels(0.7).apply()
    plan = s._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") + plan.count("LogicalRelation") == 1


def test_repeated_ids_empty_tables_and_too_many_strata(spark, monkeypatch):
    rows = [(1, "a", "normal")] * 4 + [(2, "a", "anomalous")] * 2
    df = spark.createDataFrame(rows, "sample_id long, dataset string, label string")
    # Rows of one id stand or fall together.
    assert {r["sample_id"] for r in balance.balance_labels(df, 1.0).collect()} <= {1, 2}
    assert balance.balance_labels(df.limit(0), 1.0).count() == 0 and balance.cap_source_share(df.limit(0), 0.4).count() == 0
    monkeypatch.setattr(chain, "MOST_CELLS", 1)
    with pytest.raises(ValueError, match="combinations"):
        balance.Sampling(df)
