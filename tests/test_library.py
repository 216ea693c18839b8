"""Operators on small tables: the invariants and exact numbers that the surveyed system promises."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamstack.functions import geometry as G
from loamstack.functions import text as X
from loamstack.operators import balance, enrich, export, generate, imaging, quality, questions, split, stats, taxonomy
from loamstack.plans import config


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_geometry(spark):
    box = F.array(*map(F.lit, (150, 100, 300, 200)))
    assert one(spark, G.norm_box(box, F.lit(600), F.lit(400))) == [250, 250, 500, 500]
    assert one(spark, G.norm_box(F.array(*map(F.lit, (-5, 0, 700, 500))), F.lit(600), F.lit(400))) == [0, 0, 1000, 1000]
    assert one(spark, G.severity_from_area(F.lit("major"), F.lit(0.2))) == "critical"
    size = one(spark, G.smart_resize(F.lit(600.0), F.lit(801.0)))
    assert size["h"] % 28 == 0 and size["w"] % 28 == 0
    assert one(spark, G.iou(box, box)) == 1.0
    assert one(spark, G.region_word(F.array(*map(F.lit, (0, 0, 10, 10))), F.lit(90), F.lit(90))) == "左上"


@pytest.mark.parametrize("raw, clean", [("<think>a</think> b", "b"), ("a</reason> b", "b"), ("b <thinking> c", "b"), ("", ""), (None, ""), ("x", "x"), ("<think>a</think><Reason >c</ reason>d", "d")])
def test_strip_reasoning(spark, raw, clean):
    assert one(spark, X.strip_reasoning(F.lit(raw).cast("string"))) == clean


@pytest.mark.parametrize("text, ok", [("[]", True), ("[1] tail", False), ("[1],[2]", False), ("[1", False), ('[{"a": 1}]', True), ("", False)])
def test_strict_json(spark, text, ok):
    assert one(spark, X.is_json_array(F.lit(text))) is ok


def test_class_mapping(spark):
    want = {"HS": "scratch", "ch": "scratch", "AK": "dent", "bx": "dent", "ZW": "contamination", "QS": "part_missing", "ZZ": "other_anomaly", "class_7": "other_anomaly", "划痕": "other_anomaly", "deep crack 2": "crack", "": "other_anomaly"}
    df = spark.createDataFrame([(k,) for k in want], "raw string")
    assert {r["raw"]: r["type"] for r in taxonomy.map_defects(df, "raw").collect()} == want


def samples(spark, sizes):
    rows = [(f"{d}-{i}", d, "anomalous" if i < a else "normal") for d, (n, a) in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "sample_id string, dataset string, label string")


def test_source_cap(spark):
    assert balance.water_level([1000, 1000, 50], 0.4) == 100
    out = balance.cap_source_share(samples(spark, {"a": (1000, 500), "b": (1000, 500), "c": (50, 25)}), 0.4)
    assert {r[0]: r[1] for r in out.groupBy("dataset").count().collect()} == {"a": 100, "b": 100, "c": 50}
    for n in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        assert balance.cap_source_share(samples(spark, {"a": (300, 50), "b": (20, 5)}), 0.6).orderBy("sample_id").collect()[:3] == balance.cap_source_share(samples(spark, {"a": (300, 50), "b": (20, 5)}), 0.6).orderBy("sample_id").collect()[:3]
    spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_labels_and_classes(spark):
    s = samples(spark, {"a": (100, 10)})
    assert balance.balance_labels(s, 1.5).filter("label = 'normal'").count() == 15
    assert balance.balance_labels(s, 0).count() == 100
    rows = [("c", "corrosion", f"x{i}") for i in range(100)] + [("c", "dent", f"y{i}") for i in range(10)] + [("other", None, f"z{i}") for i in range(100)]
    out = balance.cap_classes(spark.createDataFrame(rows, "task string, target_type string, qa_id string"), ["c"], 3.0)
    assert {r[0]: r[1] for r in out.groupBy("target_type").count().collect()} == {"corrosion": 100, "dent": 30, None: 100}
    assert out.select("qa_id").distinct().count() == out.count()
    assert out.filter("oversampled").count() == 20


def test_quota(spark):
    assert balance.auto_total({"a": 1000, "b": 1000, "c": 10}, {"a": 0.49, "b": 0.49, "c": 0.02}) > 900
    takes = balance.quota_takes({"a": 100, "b": 5}, {"a": 0.5, "b": 0.5}, 50)
    assert takes["b"] == 5 and takes["a"] == 45
    r = spark.createDataFrame([("a", f"a{i}") for i in range(100)] + [("b", f"b{i}") for i in range(5)], "task string, qa_id string")
    assert balance.quota_sample(r, {"a": 0.5, "b": 0.5}, 50).count() == 50
    assert balance.quota_sample(r, {}).count() == 105


def test_split_has_no_leak(spark):
    rows = [(i, f"img{i // 2 if i % 3 else i}", "q") for i in range(600)]
    df = spark.createDataFrame(rows, "sample_id long, image string, question string")
    out = split.split_groups(df, "sample_id", "image", 0, (0.6, 0.2, 0.2))
    assert out.count() == 600 and split.leaks(out, "image").count() == 0
    assert out.select("split").distinct().count() == 3
    none = split.split_groups(df.withColumn("image", F.lit(None).cast("string")), "sample_id", "image")
    assert none.count() == 600


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(f"sid:{i:03d}", f"h{j}") for i in range(40) for j in (i, i + 1)], "member string, hub string")
    assert [r["root"] for r in split.components(edges).select("root").distinct().collect()] == ["sid:000"]


def test_dedup(spark):
    df = spark.createDataFrame([("i", "q", "a", 2), ("i", "q", "a", 1), ("i", "q2", "a", 3)], "image string, question string, answer string, ord int")
    assert sorted(r["ord"] for r in split.dedup_first(df, ["image", "question", "answer"], ["ord"]).collect()) == [1, 3]


KINDS = "task string, question string, answer string, output_format string, yes_no string, image_status string, answer_letter string, options array<string>, images array<string>, image_defect_types array<string>, answer_defect_types array<string>, turns array<struct<question:string,answer:string>>, degradation string"


@pytest.mark.parametrize("record, codes", [
    (("grounding_all", "q?", '[{"bbox_2d": [1, 2, 3, 4], "label": "x"}]', "json_only"), []),
    (("grounding_all", "q?", '[{"bbox_2d": [1, 2, 1, 4], "label": "x"}]', "json_only"), ["degenerate_box"]),
    (("grounding_all", "q?", '[{"bbox_2d": [1, 2, 1001, 4]}]', "json_only"), ["box_out_of_range"]),
    (("grounding_all", "q?", '[{"box": [1, 2]}]', "json_only"), ["bad_box_item"]),
    (("grounding_all", "q?", '[{"bbox_2d": [1, 2]}]', "json_only"), ["bad_box_len"]),
    (("grounding_negative", "q?", '[{"bbox_2d": [1, 2, 3, 4]}]', "json_only"), ["negative_with_boxes"]),
    (("grounding_negative", "q?", "[] 没有", "json_only"), ["not_pure_json"]),
    (("counting", "q?", '共 2 处\n[{"bbox_2d": [1, 2, 3, 4]}]', "text_then_json"), ["count_mismatch"]),
    (("description", "看{obj}", "a", "text"), ["unfilled_placeholder_q"]),
    (("description", "", "a", "text"), ["empty_qa"]),
    (("description", "q", "范围范围大", "text"), ["duplicated_word_a:范围范围"]),
    (("discrimination", "q", "存在缺陷", "text", "no"), ["negative_answer_says_positive"]),
    (("discrimination", "q", "不合格。", "text", "yes"), []),
    (("discrimination", "q", "合格。", "text", "yes"), ["positive_answer_says_negative"]),
    (("classification_mc", "q", "B. x", "text", None, None, "A", ["x", "x"]), ["mc_answer_letter_mismatch", "duplicate_options"]),
    (("classification_mc", "q", "AB", "text", None, None, "AB", ["x"]), ["bad_mc_letter"]),
    (("uncertainty", "q", "有裂纹", "text"), ["uncertainty_without_evidence", "uncertainty_without_hedge"]),
    (("description", "<image>q", "a", "text", None, None, None, None, ["1", "2"]), ["image_token_count_mismatch"]),
    (("description", "q", "a", "text", None, None, None, None, None, ["crack"], ["dent"]), ["answer_asserts_absent_defect"]),
    (("multi_turn", "q", "a", "dialog", None, None, None, None, None, None, None, [("q", "a")]), ["too_few_turns"]),
    (("multi_turn", "q", "a", "dialog", "no", None, None, None, None, None, None, [("q", "a"), ("q2", '[{"bbox_2d": [1, 2, 3, 4]}]')]), ["turn_1_negative_with_boxes"]),
    ((None, None, None), ["empty_qa"]),
])
def test_quality_codes(spark, record, codes):
    n = KINDS.count(", ") + 1
    row = tuple(record) + (None,) * (13 - len(record))
    assert n >= 13
    assert quality.with_errors(spark.createDataFrame([row], KINDS)).first()["errors"] == codes


def test_questions(spark):
    rows = [("discrimination", "请检查{obj}是否存在裂纹。", None), ("discrimination", "短", "length"), ("grounding_single", "请定位图中的缺陷位置。", "placeholder_missing"), ("discrimination", "请说明{box}处的状况。", "placeholder_not_allowed"),
            ("description", "请评估剩余寿命与趋势。", "unanswerable_trend"), ("description", "请给出缺陷的坐标信息。", "unanswerable_coordinates"), ("description", "请描述这玩意的状况。", "colloquial"), ("description", "请描述一下状况", "ending")]
    df = spark.createDataFrame([(t, q, i) for i, (t, q, _) in enumerate(rows)], "task string, question string, ord int")
    assert [r["reason"] for r in questions.validate(df).orderBy("ord").collect()] == [r[2] for r in rows]
    assert one(spark, questions.parse_array(F.lit('x ["a", "b\\"c"] y'))) == ["a", 'b"c']
    assert one(spark, questions.parse_array(F.lit('["a", "b", "trunc'))) == ["a", "b"]
    assert one(spark, questions.parse_array(F.lit("none"))) is None


def made(spark):
    raw = [(i, None if i % 9 else "blur", "ds", "cat", [] if i % 3 == 0 else [(0, ("crack", "dent", "corrosion")[k % 3], [10 + 60 * k, 20, 50 + 60 * k, 80]) for k in range(1 + i % 4)]) for i in range(120)]
    df = spark.createDataFrame(raw, "image long, degradation string, dataset string, category string, raw array<struct<line:int,type:string,bbox:array<int>>>")
    return generate.records(generate.samples(df.withColumn("raw", F.when(F.size("raw") > 0, F.col("raw"))), 400, 300))


def test_generated_records_hold_their_rules(spark):
    r = made(spark).cache()
    checked = quality.with_errors(r, generate.SYSTEMS).filter(F.size("errors") > 0).select("task", "errors", "answer")
    assert checked.collect() == []
    assert set(generate.WEIGHTS) == {x["task"] for x in r.select("task").distinct().collect()}
    assert r.groupBy("sample_id").count().agg(F.max("count")).first()[0] <= 4
    assert r.filter("degradation is not null and task <> 'uncertainty'").count() == 0
    mc = r.filter("task = 'classification_mc'").collect()
    assert mc and all(len(set(x["options"])) == len(x["options"]) >= 2 for x in mc)
    pair = r.filter("task = 'pair_compare'").collect()
    assert pair and all(len(x["images"]) == 2 and x["images"][0] != x["images"][1] for x in pair)
    spark.conf.set("spark.sql.shuffle.partitions", 7)
    assert sorted(x["qa_id"] for x in made(spark).select("qa_id").collect()) == sorted(x["qa_id"] for x in r.select("qa_id").collect())
    spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_export_and_enrich(spark):
    import json

    df = spark.createDataFrame([("1", "description", "text", "q", "a 3", ["/r/x.jpg", "/r/y.jpg"], "S"), ("2", "grounding_all", "json_only", "q", "[]", ["/r/z.jpg"], "")], "qa_id string, task string, output_format string, question string, answer string, images array<string>, system string")
    lines = {f: [json.loads(r["line"]) for r in export.export(df, f, "/r").orderBy("qa_id").collect()] for f in export.EXPORTERS}
    assert lines["sharegpt"][0]["conversations"][0]["value"] == "<image><image>q" and lines["sharegpt"][0]["system"] == "S" and "system" not in lines["sharegpt"][1]
    assert [m["role"] for m in lines["openai"][0]["messages"]] == ["system", "user", "assistant"] and lines["openai"][0]["messages"][1]["content"][1]["image"] == "y.jpg"
    assert lines["llamafactory"][0]["images"] == ["x.jpg", "y.jpg"] and lines["swift"][1]["meta"]["task"] == "grounding_all"
    cache = spark.createDataFrame([], "k string, a string, why string")
    todo = enrich.pending(df, cache)
    assert todo.count() == 1
    got = enrich.ask(todo, lambda q, a: "<think>x</think>better 3").collect()
    assert got[0]["a"] == "better 3" and got[0]["why"] is None
    bad = enrich.ask(todo, lambda q, a: "better 4")
    assert bad.first()["why"] == "facts_changed" and enrich.pending(df, bad).count() == 0
    out = enrich.apply(df, spark.createDataFrame(got, "k string, a string, why string")).orderBy("qa_id").collect()
    assert out[0]["answer"] == "better 3" and out[0]["answer_template"] == "a 3" and out[1]["answer"] == "[]"


def test_components():
    m = np.zeros((100, 100), bool)
    m[10:40, 10:40] = True
    assert imaging.components(m) == [(900, 10, 10, 40, 40)]
    m[50:60, 50:70] = m[80:90, 0:10] = True
    assert [c[0] for c in imaging.components(m)] == [900, 200, 100]
    assert imaging.components(np.zeros((5, 5))) == [] and len(imaging.components(np.ones((600, 700)))) == 1
    speck = np.zeros((1000, 1000), bool)
    speck[:3, :3] = True
    assert len(imaging.components(speck)) == 1
    rng = np.random.default_rng(0)
    for _ in range(30):
        mask = rng.random((20, 30)) < rng.uniform(0.2, 0.7)
        seen, boxes = np.zeros_like(mask), []
        for y, x in zip(*np.nonzero(mask)):
            if seen[y, x]:
                continue
            todo, own = [(y, x)], []
            seen[y, x] = True
            while todo:
                a, b = todo.pop()
                own.append((a, b))
                for c, d in ((a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)):
                    if 0 <= c < 20 and 0 <= d < 30 and mask[c, d] and not seen[c, d]:
                        seen[c, d] = True
                        todo.append((c, d))
            ys, xs = zip(*own)
            boxes.append((len(own), min(xs), min(ys), max(xs) + 1, max(ys) + 1))
        assert sorted(imaging.components(mask, None, 0.0)) == sorted(boxes)


def test_stats_and_config(spark):
    df = spark.createDataFrame([("a b c",)] * 3 + [("a b",)], "t string")
    assert stats.distinct_bigrams(df, "t").first()["ratio"] == round(2 / 7, 4)
    assert stats.distinct_bigrams(df.filter("t = 'zz'"), "t").first()["ratio"] == 0.0
    assert config.apply_overrides({"a": {"b": 1}}, ["a.b=2", "c.d=x"]) == {"a": {"b": 2}, "c": {"d": "x"}}
    assert config.merge_specs([{"name": "a", "x": 1}], [{"name": "a", "x": 2}, {"name": "b"}]) == [{"name": "a", "x": 2}, {"name": "b"}]
    assert [s["name"] for s in config.enabled([{"name": "a", "enabled": False}, {"name": "b"}])] == ["b"]


def test_first_rows_of_strata_without_a_task_for_each(spark, monkeypatch):
    from loamstack.functions import draws

    rows = [(i, "abc"[min(i % 5, 2)]) for i in range(3000)] + [(9000, None), (9001, None)]
    df = spark.createDataFrame(rows, "id long, s string")
    takes = {"a": 100, "b": 0, "c": 5000, None: 1}
    table = spark.createDataFrame(list(takes.items()), "s string, _take long")
    for prefix in (1, 4):
        monkeypatch.setattr(draws, "PREFIX", prefix)
        marked = draws.mark_first(df, ["s"], table, 3, F.col("id"))
        plan = marked._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "SortMergeJoin" not in plan
        got = {(r["id"], r["s"]): r["_first"] for r in marked.collect()}
        for s, n in takes.items():
            own = sorted((hashlib.md5(f"3:{i}".encode()).hexdigest(), i) for i, x in rows if x == s)
            assert [got[i, s] for _, i in own] == [k < n for k in range(len(own))]
    assert draws.mark_first(df.limit(0), ["s"], table, 3, F.col("id")).count() == 0


def test_cache_of_several_attempts(spark):
    from loamstack.operators import enrich

    first = spark.createDataFrame([("k1", None, "empty"), ("k2", "good", None)], "k string, a string, why string")
    second = spark.createDataFrame([("k1", "later", None), ("k2", None, "facts_changed"), ("k3", None, "empty")], "k string, a string, why string")
    cache = enrich.with_attempt(enrich.with_attempt(None, first, 1), second, 2)
    assert {r["k"]: (r["a"], r["why"]) for r in enrich.latest(cache).collect()} == {"k1": ("later", None), "k2": ("good", None), "k3": (None, "empty")}


def test_arrays_and_reports(spark, tmp_path):
    import json

    df = spark.range(10).repartition(3).selectExpr("string(id) AS qa_id", "'q' AS question", "concat('a', id) AS answer", "array('/r/x.jpg') AS images")
    export.write(df, "sharegpt", str(tmp_path / "a"), "/r", as_json_array=True)
    found = [x for f in (tmp_path / "a").glob("part-*") if (t := f.read_text()) for x in json.loads(t)]
    assert sorted(x["id"] for x in found) == [str(i) for i in range(10)]
    export.write(df.limit(0), "sharegpt", str(tmp_path / "b"), "/r", as_json_array=True)
    assert "".join(f.read_text() for f in (tmp_path / "b").glob("part-*")) == ""
    export.write_reports(str(tmp_path / "r"), generate.FORMATS, generate.SYSTEMS, counts=df.groupBy("question").count(), codes=quality.report(quality.with_errors(df)))
    lines = [json.loads(x) for f in (tmp_path / "r/stats.json").glob("part-*") for x in f.read_text().splitlines()]
    assert {"table": "counts", "row": {"question": "q", "count": 10}} in lines and {"table": "codes", "row": {"code": "n_input", "n": 10}} in lines
    prompts = json.loads("".join(f.read_text() for f in (tmp_path / "r/system_prompts.json").glob("part-*")))
    assert prompts["by_output_format"] == generate.SYSTEMS and prompts["task_to_output_format"]["counting"] == "text_then_json"
