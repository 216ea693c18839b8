"""The interim store, summaries, hints and small helpers of configuration."""

from pyspark.sql import functions as F

from loamstack.operators import taxonomy
from loamstack.plans import config
from loamstack.sources import interim

SCHEMA = "sample_id string, category string, commercial_ok boolean"


def test_choices_reach_the_folders(spark, tmp_path):
    df = spark.createDataFrame([("1", "a", True, "x"), ("2", "b", None, "x"), ("3", "a", True, "y")], SCHEMA + ", dataset string")
    interim.write(df, str(tmp_path / "s"))
    (tmp_path / "s" / "_notes.jsonl").write_text('{"sample_id": "no"}\n')
    with open(next((tmp_path / "s" / "dataset=y").glob("part-*")), "a") as f:
        f.write('{"sample_id": "4", "cat')
    for crc in (tmp_path / "s" / "dataset=y").glob(".*.crc"):
        crc.unlink()
    ids = lambda **k: sorted(r["sample_id"] for r in interim.read(spark, str(tmp_path / "s"), SCHEMA, **k).collect())
    assert ids() == ["1", "2", "3"] and ids(only=["x"]) == ["1", "2"] and ids(commercial=True) == ["1", "3"] and ids(categories=["b"]) == ["2"] and ids(categories=[]) == []
    plan = interim.read(spark, str(tmp_path / "s"), SCHEMA, only=["x"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "dataset" in plan.split("PartitionFilters: [")[1].split("]")[0]
    both = interim.union(df, spark.createDataFrame([("9", "z")], "sample_id string, more string"))
    assert both.count() == 4 and both.columns == [*df.columns, "more"]


def test_summary_counts_types_once_a_sample(spark):
    rows = [("x", "anomalous", [("dent",), ("dent",), ("crack",)]), ("x", "anomalous", [("dent",)]), ("x", "normal", []), ("y", "normal", [])]
    df = spark.createDataFrame(rows, "dataset string, label string, defects array<struct<type:string>>")
    assert sorted(map(tuple, interim.summary(df).collect())) == [("x", 3, 1, 2, "crack=1,dent=2"), ("y", 1, 1, 0, "")]


def test_hints_come_before_names(spark):
    df = spark.createDataFrame([("screw",), ("wing 7",), ("wing 7",), (None,)], "category string")
    got = sorted((r["category"] or "", r["object"]) for r in taxonomy.with_objects(df, hints={"screw": "bolt"}).collect())
    assert got == [("", "unknown"), ("screw", "bolt"), ("wing 7", "wing"), ("wing 7", "wing")]


def test_configuration_helpers():
    assert config.local_path_for("a/b.yaml") == "a/b.local.yaml"
    layer = [{"name": "a", "enabled": True}]
    new, changed = config.set_enabled(layer, ["a", "b"])
    assert changed == ["b"] and new == [{"name": "a", "enabled": True}, {"name": "b", "enabled": True}] and layer == [{"name": "a", "enabled": True}]
    assert config.set_enabled(new, ["a", "b"])[1] == [] and config.set_enabled(new, ["a"], False)[1] == ["a"]
    assert config.safe_name("  Bolt & Nut--v2 ") == "bolt_nut_v2"
    assert config.parse_list("# x\na/b\nc/d:3 # y\nbad\n/e\n") == ([{"ws": "a", "proj": "b", "ver": "latest"}, {"ws": "c", "proj": "d", "ver": "3"}], [4, 5])


def test_rows_of_a_null_category_stay(spark):
    df = spark.createDataFrame([(None, 1)], "category string, n int")
    assert taxonomy.with_objects(df).select(F.col("n")).count() == 1
