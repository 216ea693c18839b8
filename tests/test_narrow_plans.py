"""Generated records and options work out what is selected, and give what their SQL gives."""

import os

import duckdb
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamstack.functions import constants, geometry
from loamstack.operators import generate, quality, split
from loamstack.plans import registry

DATA = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@needs_tables
def test_options_do_not_describe_boxes(spark):
    assert "侧中部" not in plan(registry.QUERIES["mc_options"](spark, DATA))


@needs_tables
def test_records_without_their_texts_do_not_make_them(spark):
    assert "请定位图中的" not in plan(registry.QUERIES["generate_records"](spark, DATA))


@needs_tables
@pytest.mark.parametrize("name", ["mc_options", "generate_records"])
def test_generated_rows_are_those_of_the_sql(spark, name):
    db = duckdb.connect()
    for t in ("orders", "lineitem", "part"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = db.sql(registry.ORACLE_SQL[name])
    names = want.columns
    got = registry.QUERIES[name](spark, DATA).select(*names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr)


def test_boxes_meet_where_their_iou_is_above_nothing(spark):
    boxes = [[0, 0, 10, 10], [9, 9, 12, 12], [10, 0, 20, 10], [3, 3, 4, 4], [5, 5, 5, 9], [8, 8, 2, 2], None]
    df = spark.createDataFrame([(a, b) for a in boxes for b in boxes if a and (a[2] > a[0])], "a array<int>, b array<int>")
    assert df.filter(geometry.meets(F.col("a"), F.col("b")) != (geometry.iou(F.col("a"), F.col("b")) > 0)).count() == 0


def test_constants_keep_quotes_and_backslashes(spark):
    odd = ["it's", "a\\b", "\\'", '"', "{x}", "裂纹"]
    got = spark.range(1).select(constants.array(odd).alias("a"), constants.look({v: i for i, v in enumerate(odd)}, F.lit("\\'")).alias("i"), constants.array([]).alias("e")).first()
    assert (got["a"], got["i"], got["e"]) == (odd, 2, [])


def test_tries_for_a_clean_box_are_all_sixty():
    assert [i for a, b in generate.TRIES for i in range(a, b + 1)] == list(range(60))


def test_passing_rows_are_those_without_codes_and_each_answer_is_parsed_once(spark):
    answers = ['[]', '[{"bbox_2d": [1, 2, 3, 4], "label": "x"}]', '[{"bbox_2d": [3, 2, 1, 4]}]', '[{"bbox_2d": [1, 2, 3]}]', '[{}]', '[1', "共 1 处。\n[]", "共 0 处。\n[]", "存在缺陷。", "没有发现异常。", "无法确认，建议补拍。", "位于位于左侧", "{obj} 未见异常。", "A. 裂纹", "", None]
    tasks = {"grounding_single": "json_only", "grounding_negative": "json_only", "counting": "text_then_json", "discrimination": "text", "uncertainty": "text", "classification_mc": "text", "multi_turn": "dialog", None: None}
    rows = [(t, f, a, q, n, yes, None if n is None else [(q, a), ("q", answers[n])][:n % 3]) for t, f in tasks.items() for a in answers for q in ("q", "位于位于", None) for n, yes in ((1, "yes"), (2, "no"), (5, None), (None, "yes"))]
    kind = "task string, output_format string, answer string, question string, n int, yes_no string, turns array<struct<question:string,answer:string>>"
    df = spark.createDataFrame(rows, kind).selectExpr("*", "if(n = 1, 'A', 'G') AS answer_letter", "if(n = 2, array('a', 'a'), array('a')) AS options", "if(n = 5, 'blur', null) AS degradation", "'S' AS system", "'anomalous' AS image_status")
    for systems in (None, {"text": "S", "dialog": "T"}):
        want = quality.with_errors(df, systems).filter(F.size("errors") == 0).drop("errors")
        got = quality.passing(df, systems)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and 0 < got.count() < len(rows)
    assert plan(quality.passing(df)).count("regexp_extract(") <= 4


def test_rare_copies_are_dropped_as_all_copies_are(spark):
    rows = [(i % 5 or None, f"q{i % 7}", f"{i:03}", i) for i in range(60)] + [(9, "alone", "x", 1), (None, None, "y", 2), (None, None, "b", 3)]
    df = spark.createDataFrame(rows, "a int, q string, id string, n int")
    got, want = (f(df, ["a", "q"], ["id"]) for f in (split.dedup_rare, split.dedup_first))
    assert got.columns == df.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_what_a_degraded_picture_is_asked_about_is_drawn_once(spark):
    boxes = "array<struct<type:string,zh:string,bbox:array<int>,area_ratio:double,severity:string,region:string,grade:string>>"
    kind = f"sample_id long, image string, width int, height int, dataset string, category string, degradation string, object string, object_zh string, role string, ctx string, defects {boxes}, label string"
    row = (1, "i", 640, 480, "d", "c", "blur", "bolt", "螺栓", "fastener", "x", [], "normal")
    made = generate.records(spark.createDataFrame([row], kind), references=False)
    assert plan(made).count("doubt,") == 1 and made.count() == generate.ASKED_IF_DEGRADED


def test_records_are_made_in_more_tasks_than_cores(spark):
    rows = [(i, "d", "c", f"i{i}", "normal") for i in range(9)]
    found = generate.with_references(spark.createDataFrame(rows, "sample_id long, dataset string, category string, image string, label string"))
    assert found.filter("reference <> image").count() == 9
    assert "RepartitionByExpression [sample_id#" in plan(found) and generate._tasks(found) >= 4 * spark.sparkContext.defaultParallelism


def test_references_carry_no_list_of_buckets(spark):
    rows = [(i, f"d{i % 2}", "c", f"/{i}", "normal" if i % 3 else "anomalous") for i in range(30)]
    plan = generate.with_references(spark.createDataFrame(rows, "sample_id long, dataset string, category string, image string, label string"))._jdf.queryExecution().optimizedPlan().toString()
    assert "_buckets" in plan and not any("sample_id" in line and "_buckets" in line for line in plan.splitlines())


@needs_tables
def test_defects_are_described_before_they_are_put_together(spark):
    from loamstack.plans.generation_queries import image_samples, pictures

    folder = "/root/testdata/sf0.001"
    made = image_samples(spark, folder)
    assert "lambdafunction" not in plan(made)
    # As made from raw defects, and as made for defects that lack their words.
    columns = [f"defects.{c}" for c in made.schema["defects"].dataType.elementType.names]
    show = lambda df: sorted(map(repr, df.select("sample_id", "label", *[F.col(c).alias(c) for c in columns]).collect()))
    assert show(made) == show(generate.samples(pictures(spark, folder), 640, 480))
    bare = made.withColumn("defects", F.transform("defects", lambda d: d.dropFields("json", "place")))
    assert show(made) == show(generate._with_words(bare))


@needs_tables
def test_late_tasks_are_asked_only_where_they_can_be_chosen(spark):
    from loamstack.functions import draws
    from loamstack.plans.generation_queries import image_samples

    made = image_samples(spark, "/root/testdata/sf0.001")
    few, every = (generate.records(made, most=n, references=False).select("sample_id", "task", "answer", "options") for n in (4, 20))
    place = draws.key(0, F.col("sample_id"), F.concat(F.lit("order"), F.col("task")))
    ranked = every.filter("task <> 'uncertainty'").withColumn("n", F.row_number().over(W.partitionBy("sample_id").orderBy(place))).filter("n <= 4").drop("n")
    assert sorted(map(repr, few.filter("task <> 'uncertainty'").collect())) == sorted(map(repr, ranked.collect()))
    assert "_last" in plan(generate.records(made, references=False))
    shares = (0.0, 0.25, 0.45, 0.8, 1.0, 1.5)
    told = spark.range(3000).select(*[(draws.below(s, 0, F.col("id")) == (draws.uniform(0, F.col("id")) < s)).alias(f"s{i}") for i, s in enumerate(shares)])
    assert told.distinct().collect() == [(True,) * len(shares)]
