"""Arrangement of photos and masks, model pools, question pools, actions and roots."""

import pytest
from pyspark.sql import functions as F

from loamstack.operators import arrange, generate, pool, quality, questions, taxonomy
from loamstack.plans import config


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize("name, stem", [("a_mask.png", "a"), ("a.b_GT.png", "a.b"), ("a-label.tif", "a"), ("a_annotation.png", "a"), ("a_masked.png", "a_masked"), ("a", "a"), (".hidden", ".hidden"), ("", ""), (None, "")])
def test_stem_key(spark, name, stem):
    assert one(spark, arrange.stem_key(F.lit(name).cast("string"))) == stem


@pytest.mark.parametrize("path, part", [("x/Train/y", "train"), ("VALID/train", "test"), ("a/b", "all"), (None, "all")])
def test_split_of(spark, path, part):
    assert one(spark, arrange.split_of(F.lit(path).cast("string"))) == part


def test_kinds_and_pairs(spark):
    files = spark.createDataFrame([("m", "a", 3), ("m", "b", 4), ("p", "a", 99), ("p", "b", None), ("tie", "a", 2), ("tie", "b", 200)], "directory string, name string, levels int")
    assert dict(map(tuple, arrange.kinds(files).collect())) == {"m": "mask", "p": "photo", "tie": "mask"}
    kind = "directory string, name string, more int"
    photos = spark.createDataFrame([("train/i", "a.jpg", 1), ("train/i", "b.jpg", 1), ("misc", "c.jpg", 1), ("test", None, 1)], kind)
    masks = spark.createDataFrame([("train/m", "a_mask.png", 2), ("train/l", "a_gt.png", 2), ("valid", "c.png", 2), ("valid", "b.png", 2)], kind)
    assert {r["name"]: r["mask"] for r in arrange.paired(photos, masks).collect()} == {"a.jpg": "train/l/a_gt.png", "b.jpg": None, "c.jpg": "valid/c.png", "": None}
    assert arrange.paired(photos, masks.limit(0)).filter("mask is null").count() == 4
    assert arrange.paired(photos.limit(0), masks).count() == 0


def test_available_and_parameters():
    models = [{"name": "a", "tags": ["zh"]}, {"name": "b", "enabled": False}, {"name": "c"}]
    assert [m["name"] for m in pool.available(models)] == ["a", "c"]
    assert [m["name"] for m in pool.available(models, {"models": ["c", "b"]})] == ["c"]
    assert [m["name"] for m in pool.available(models, {"tags": ["zh", "x"]})] == ["a"]
    assert pool.parameters({"t": 1, "n": 5, "_note": 0}, None, {"t": 0.2}, {"n": 6}) == {"t": 0.2, "n": 6}
    assert pool.base_url(" http://x/v1/chat/completions/ ") == "http://x/v1" and pool.base_url(None) == ""


def test_routes(spark):
    models = [{"name": n, "weight": w} for n, w in (("a", 3.0), ("b", 1.0), ("c", 0.0))]
    rows = spark.range(4000)
    first = {r[0]: r[1] for r in rows.select(F.get(pool.route(models, "weighted", F.col("id")), 0).alias("m")).groupBy("m").count().collect()}
    assert set(first) == {"a", "b"} and 0.7 < first["a"] / 4000 < 0.8
    assert all(sorted(r[0]) == ["a", "b", "c"] for r in rows.select(pool.route(models, "weighted", F.col("id"))).collect())
    assert [r[0] for r in spark.range(3).select(pool.route(models, "round_robin", F.col("id"))).orderBy("id").collect()] == [["a", "b", "c"], ["b", "c", "a"], ["c", "a", "b"]]
    assert one(spark, pool.route(models, "failover", F.lit(5))) == ["a", "b", "c"] and one(spark, pool.route([], "weighted", F.lit(5))) == []


def test_call_retries_and_fails_over(spark):
    def broken(prompt):
        raise TimeoutError

    clients = {"bad": broken, "dumb": lambda p: "<think>" + p + "</think> ", "good": lambda p: p + "!"}
    asked = spark.createDataFrame([(1, "x", ["bad", "dumb", "good"]), (2, None, ["good", "bad"]), (3, "z", None), (4, "w", ["absent"])], "request int, prompt string, route array<string>")
    log = pool.call(asked, clients, workers=2).orderBy("request", "n")
    assert [(r["request"], r["model"], r["err"], r["text"] if r["ok"] else None) for r in log.collect()] == [
        ("1", "bad", "TimeoutError", None), ("1", "bad", "TimeoutError", None), ("1", "dumb", "empty", None), ("1", "dumb", "empty", None), ("1", "good", None, "x!"), ("2", "good", None, "!"), ("4", "absent", "KeyError", None), ("4", "absent", "KeyError", None)]
    found = {r["model"]: (r["calls"], r["ok"], r["fail"], r["success_rate"]) for r in pool.summary(log).collect()}
    assert found == {"*": (8, 2, 6, 0.25), "bad": (2, 0, 2, 0.0), "dumb": (2, 0, 2, 0.0), "good": (2, 2, 0, 1.0), "absent": (2, 0, 2, 0.0)}
    assert [tuple(r) for r in pool.top_errors(log).collect()] == [("KeyError", 2), ("TimeoutError", 2), ("empty", 2)]
    assert pool.summary(log.limit(0)).count() == 0


def test_question_pools(spark):
    bank = spark.createDataFrame([("a", "Please mark the whole defect."), ("a", "请标出缺陷。"), ("b", "Only an English question here."), ("a", "标出{defect}。"), ("a", None)], "task string, question string")
    assert {r["question"] for r in questions.in_language(bank).collect()} == {"请标出缺陷。", "标出{defect}。", "Only an English question here.", None}
    asked = spark.createDataFrame([(1, "a", True), (2, "b", True), (3, "b", False)], "sample_id int, task string, named boolean")
    assert {r["sample_id"]: r["question"] for r in questions.pick(asked, bank.dropna()).collect()} == {1: "标出{defect}。", 2: None, 3: "Only an English question here."}


@pytest.mark.parametrize("answer, types", [('共 [{"label": "裂纹"}, {"label": "x"}, {"label": "裂纹"}, 3, {"bbox": []}] 处', ["crack", "x"]), ("[1", []), ("没有", []), ("[]", []), (None, [])])
def test_types_in_answer(spark, answer, types):
    assert one(spark, questions.types_in_answer(F.lit(answer).cast("string"))) == types


def test_actions(spark):
    pick = lambda t, g: one(spark, taxonomy.action(F.lit(t).cast("string"), F.lit(g).cast("string")))
    assert pick("corrosion", "good") == taxonomy.GRADE_ACTIONS["good"] and pick("corrosion", None) == taxonomy.ACTIONS["corrosion"]
    assert pick("crack", "good") == taxonomy.ACTIONS["crack"] and pick(None, None) == taxonomy.ACTIONS["other_anomaly"]
    assert set(taxonomy.ACTIONS) == {d[0] for d in taxonomy.DEFECTS}


def test_images_missing(spark):
    records = spark.createDataFrame([("1", "a", None), ("2", "b", ["a", "c"]), ("3", None, [])], "qa_id string, image string, images array<string>")
    files = spark.createDataFrame([("a",), ("a",), ("b",)], "path string")
    assert {r[0] for r in quality.images_missing(records, files).collect()} == {"2", "3"}
    assert {r[0] for r in quality.images_missing(records.drop("images"), files).collect()} == {"3"}


def test_resolve():
    spec = {"root": "{data_root}/a", "root_alternatives": ["{data_root}/b"], "name": "n"}
    assert config.resolve(spec, "/d", exists=lambda p: p == "/d/b") == {"root": "/d/b", "name": "n", "tried_roots": ["/d/a", "/d/b"]}
    assert config.resolve(spec, "/d", exists=lambda p: False)["root"] == "/d/a"


def test_no_task_switched_on(spark):
    with pytest.raises(ValueError, match="no task"):
        generate.records(spark.range(1), tasks=[])
