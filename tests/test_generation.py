"""Question banks, named questions, degraded pictures, comparisons and options of generated records."""

import pytest
from pyspark.sql import functions as F

from loamstack.operators import generate, options, taxonomy


def pictures(spark, n=240):
    kinds = ("crack", "dent", "corrosion")
    raw = [(i, None if i % 8 else "blur", "ds", ("screw", "panel", "gear")[i % 3], [] if i % 4 == 0 else [(k, kinds[(i + k) % 3], [10 + 60 * k + i % 7, 20, 50 + 60 * k, 80]) for k in range(1 + i % 5)]) for i in range(n)]
    df = spark.createDataFrame(raw, "image long, degradation string, dataset string, category string, raw array<struct<line:int,type:string,bbox:array<int>>>")
    return generate.samples(df.withColumn("raw", F.when(F.size("raw") > 0, F.col("raw"))), 400, 300)


@pytest.fixture(scope="module")
def banked(spark):
    holes = {t: "".join("{" + h + "}" for h in {"grounding_single": ["defect"], "grounding_counterfactual": ["defect"], "referring_region": ["box"], "region_word": ["defect"], "counting": ["defect"], "uncertainty": ["defect"]}.get(t, [])) for t in generate.WEIGHTS}
    rows = [(t, f"第 {i} 问{h}：请看图。", i) for t, h in holes.items() for i in range(60)]
    rows += [("classification_open", f"第 {i} 问：画面{{region}}是什么？", i) for i in range(60, 120)] + [("severity_action", f"第 {i} 问：{{defect}}有多重？", i) for i in range(60, 120)]
    rows += [("description", f"Please describe the state of the part number {i} in this picture.", 500 + i) for i in range(5)] + [("no_such_task", "第 1 问？", 0)]
    bank = spark.createDataFrame(rows, "task string, question string, ord int")
    return generate.records(pictures(spark, 4000), bank=bank, most=20).select("sample_id", "task", "question", "image_defect_types", "degradation").cache()


def test_the_bank_is_used_for_every_task(banked):
    asked = {r["task"]: r["n"] for r in banked.withColumn("q", F.regexp_extract("question", r"第 (\d+) 问", 0)).filter("q <> ''").groupBy("task").agg(F.countDistinct("q").alias("n")).collect()}
    assert set(asked) == set(generate.WEIGHTS) and min(asked.values()) >= 30
    assert banked.filter("question like 'Please%' or question like '%{%'").count() == 0


def test_pictures_of_several_types_get_questions_that_name_one(banked):
    mine = banked.filter("task in ('classification_open', 'severity_action')").withColumn("named", F.size("image_defect_types") > 1)
    marks = mine.withColumn("number", F.regexp_extract("question", r"第 (\d+) 问", 1)).filter("number <> ''")
    assert marks.filter("named and int(number) < 60 or not named and int(number) >= 60").count() == 0 and marks.filter("named").count() > 100


def test_degraded_pictures_are_asked_three_times(spark):
    r = generate.records(pictures(spark), references=False).filter("degradation is not null").select("sample_id", "task", "target_type", "image_defect_types", "question").collect()
    by = {}
    for x in r:
        by.setdefault(x["sample_id"], []).append(x)
    assert len(by) == 30 and all(len(v) == 3 == len({x["question"] for x in v}) and {x["task"] for x in v} == {"uncertainty"} for v in by.values())
    for v in by.values():
        shown = v[0]["image_defect_types"][:3]
        assert set(shown) <= {x["target_type"] for x in v}
    assert generate.records(pictures(spark), tasks=["description"], references=False).filter("degradation is not null").count() == 0


def test_normal_pictures_are_compared_with_others(spark):
    r = generate.records(pictures(spark), tasks=["pair_compare"], weights={"pair_compare": 1.0})
    rows = r.select("image", "images", "image_status", "answer").collect()
    assert {x["image_status"] for x in rows} == {"normal", "anomalous"} and all(x["images"][1] == x["image"] != x["images"][0] for x in rows)
    assert all(x["answer"].count("出现") <= 4 for x in rows) and any(x["answer"].count("出现") == 4 for x in rows)
    # Every normal picture that is fit to be read has one, as each group has three or more.
    normal = pictures(spark).filter("label = 'normal' and degradation is null").count()
    assert sum(x["image_status"] == "normal" for x in rows) == normal


def test_advice_is_given_to_about_half(spark):
    r = generate.records(pictures(spark, 600), tasks=["severity_action"], weights={"severity_action": 1.0}, references=False)
    share = r.agg(F.avg(F.exists(F.array(*map(F.lit, generate.ADVICE)), lambda a: F.endswith(F.col("answer"), a)).cast("int"))).first()[0]
    assert 0.4 < share < 0.6


def test_objects_come_from_categories(spark):
    got = {r["category"]: (r["object_zh"], r["role"]) for r in pictures(spark, 3).select("category", "object_zh", "role").collect()}
    assert got == {"screw": ("螺钉", "fastener"), "panel": ("检查口盖", "structure"), "gear": ("待检部件", "unknown")}


@pytest.mark.parametrize(("types", "role", "first", "never"), [
    (["scratch"], "structure", {"crack"}, {"thread_damage", "scratch"}), (["scratch", "crack"], "structure", set(), {"crack"}), (["corrosion"], "fastener", set(), {"dent", "paint_peeling", "crack"}), (["dent"], None, {"corrosion"}, {"dent"}), (["dent"], "unknown", {"corrosion"}, {"dent"}),
])
def test_options_come_from_what_looks_alike_and_can_be(spark, types, role, first, never):
    active = [d[0] for d in taxonomy.DEFECTS]
    df = spark.range(40).select("id", F.array(*map(F.lit, types)).alias("t"), F.lit(role).cast("string").alias("role"))
    names = {d[1]: d[0] for d in taxonomy.DEFECTS}
    letters = set()
    for r in df.select(options.options(F.col("t"), F.col("role"), active, 0, F.col("id")).alias("o")).collect():
        kinds = [names[o] for o in r["o"]]
        assert len(kinds) == 4 == len(set(kinds)) and types[0] in kinds and first <= set(kinds) and not (set(kinds) - {types[0]}) & (never | {"other_anomaly"})
        letters.add(kinds.index(types[0]))
    assert letters == {0, 1, 2, 3}
    few = df.select(options.options(F.col("t"), F.col("role"), [*types, "breakage"], 0, F.col("id")).alias("o")).first()["o"]
    assert len(few) == 2
