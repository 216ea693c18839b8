"""Queries of quality rules, question checks, generation, export and enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamstack.functions import draws
from loamstack.functions import text as X
from loamstack.operators import enrich, export, generate, imaging, quality, questions, rewrite_cache, split, taxonomy
from loamstack.operators.balance import Sampling, cap_classes, quota_sample
from loamstack.plans.generation_queries import image_samples
from loamstack.plans.views import BOXES, RECORDS, H, W, boxes, draw, records, registered, table

QUERIES, ORACLE_SQL, query = registered()

_CASE = "(image + line) % 9"


def _checked(spark, d) -> DataFrame:
    """A record for each box; the case number decides what is wrong with it."""
    b, k = F.col("box"), (F.col("image") + F.col("line")) % 9
    item = F.struct(F.array(b[0], b[1], F.when(k == 1, b[0]).otherwise(b[2] * 2), b[3] * 2).alias("bbox"), F.lit("裂纹").alias("label"))
    json = X.boxes_json(F.array(item))
    rows = boxes(spark, d).select("image", "line", "part", "supp", k.alias("k"), json.alias("json"), b[2].alias("x2"))
    task = F.when(F.col("k").isin(3), "counting").when(F.col("k").isin(4), "grounding_negative").when(F.col("k").isin(5, 6), "discrimination").otherwise("grounding_all")
    answer = (F.when(F.col("k") == 2, F.concat("json", F.lit(" 以上"))).when(F.col("k") == 3, F.concat(F.lit("共 "), (F.col("line") % 3).cast("string"), F.lit(" 处。\n"), F.col("json")))
              .when(F.col("k") == 5, "图中存在异常，位于位于左侧。").when(F.col("k") == 6, "{obj} 未见异常。").when(F.col("k") == 7, "[]").otherwise(F.col("json")))
    fmt = F.when(F.col("k").isin(5, 6), "text").when(F.col("k") == 3, "text_then_json").otherwise("json_only")
    yes = F.when(F.col("k") == 5, "no").when(F.col("k") == 6, "yes")
    done = rows.select("image", "line", "part", "supp", task.alias("task"), F.lit("请检查图中的缺陷。").alias("question"), answer.alias("answer"), fmt.alias("output_format"), yes.alias("yes_no"), F.lit("anomalous").alias("image_status"))
    return quality.with_errors(done)


_ERRORS = f"""{BOXES}, c AS (SELECT image, line, part, supp, {_CASE} AS k, x1, y1, CASE WHEN {_CASE} = 1 THEN x1 ELSE x2 * 2 END AS bx, y2 * 2 AS by_ FROM boxes),
    e AS (SELECT *, CASE WHEN k IN (2, 5, 6, 7) THEN NULL WHEN bx <= x1 OR by_ <= y1 THEN 'degenerate_box' WHEN bx > 1000 OR by_ > 1000 THEN 'box_out_of_range' END AS box FROM c),
    q AS (SELECT image, line, part, supp, list_filter([CASE k WHEN 5 THEN 'duplicated_word_a:位于位于' WHEN 6 THEN 'unfilled_placeholder_a' END, CASE WHEN k = 2 THEN 'not_pure_json' END,
      CASE WHEN k = 4 THEN 'negative_with_boxes' END, CASE WHEN k = 7 THEN 'positive_without_boxes' END,
      CASE WHEN k = 2 THEN CASE WHEN x2_ <= x1 THEN 'degenerate_box' WHEN x2_ > 1000 OR by_ > 1000 THEN 'box_out_of_range' END ELSE box END,
      CASE WHEN k = 3 AND line % 3 <> 1 THEN 'count_mismatch' END, CASE WHEN k = 5 THEN 'negative_answer_says_positive' WHEN k = 6 THEN 'positive_answer_says_negative' END], lambda x: x IS NOT NULL) AS errors
      FROM (SELECT *, bx AS x2_ FROM e))"""


@query(f"""WITH {_ERRORS} SELECT image, line, part, supp, array_to_string(errors, ';') AS errors FROM q""")
def qc_errors(spark, d) -> DataFrame:
    return _checked(spark, d).select("image", "line", "part", "supp", F.array_join("errors", ";").alias("errors"))


@query(f"""WITH {_ERRORS} SELECT code, count(*) AS n FROM (SELECT unnest(errors || ['n_input'] || CASE WHEN len(errors) = 0 THEN ['n_pass'] ELSE [] END) AS code FROM q) GROUP BY 1""")
def qc_report(spark, d) -> DataFrame:
    return quality.report(_checked(spark, d))


#: Records that break one rule each, with the codes that they should get; {n} is the row's number.
_BROKEN = (
    ({"task": "description", "answer": "a bbox_2d {n}", "output_format": "text"}, ["text_format_has_boxes"]),
    ({"task": "counting", "answer": "共 1 处。[{{\"bbox_2d\": [1, 2, 3, 4]}}]", "output_format": "text_then_json"}, ["not_text_then_json"]),
    ({"task": "description", "image_defect_types": ["crack"], "answer_defect_types": ["crack", "dent"]}, ["answer_asserts_absent_defect"]),
    ({"task": "uncertainty", "answer": "无法确认。"}, ["uncertainty_without_evidence"]),
    ({"task": "uncertainty", "answer": "有裂纹。", "degradation": "blur"}, ["uncertainty_without_hedge"]),
    ({"task": "uncertainty", "answer": "无法确认 bbox_2d", "degradation": "blur"}, ["uncertainty_with_boxes"]),
    ({"task": "grounding_negative", "answer": "没有腐蚀锈蚀。"}, ["answer_mentions_unasked_term", "answer_not_json"]),
    ({"task": "grounding_all", "answer": "[{{\"box\": [1, {n}]}}]"}, ["bad_box_item"]),
    ({"task": "grounding_all", "answer": "[{{\"bbox_2d\": [1, {n}]}}]"}, ["bad_box_len"]),
    ({"task": "grounding_all", "answer": "[{{\"bbox_2d\": [1, 2, 90, 4]}}]", "coord_mode": "absolute", "image_hw": [50, 60]}, ["box_out_of_image"]),
    ({"task": "classification_mc", "answer": "AB. x", "answer_letter": "AB", "options": ["x", "y"]}, ["bad_mc_letter"]),
    ({"task": "classification_mc", "answer": "B. x", "answer_letter": "A", "options": ["x", "y"]}, ["mc_answer_letter_mismatch"]),
    ({"task": "classification_mc", "answer": "A. x", "answer_letter": "A", "options": ["x", "x"]}, ["duplicate_options"]),
    ({"task": "description", "answer": ""}, ["empty_qa"]),
    ({"task": "description", "question": "{{obj}} {n}"}, ["unfilled_placeholder_q"]),
    ({"task": "description", "question": "检查检查 {n}"}, ["duplicated_word_q:检查检查"]),
    ({"task": "description", "question": "<image> {n}", "images": ["a", "b"]}, ["image_token_count_mismatch"]),
    ({"task": "description", "output_format": "text", "system": "another"}, ["system_format_mismatch"]),
    ({"task": "multi_turn", "turns": [("q", "a")]}, ["too_few_turns"]),
    ({"task": "multi_turn", "turns": [("q", "a"), ("", "a")]}, ["empty_turn_1"]),
    ({"task": "multi_turn", "turns": [("{{obj}}?", "a"), ("q", "a")]}, ["unfilled_placeholder_turn_0"]),
    ({"task": "multi_turn", "turns": [("q", "位于位于"), ("q", "a")]}, ["duplicated_word_turn:位于位于"]),
    ({"task": "multi_turn", "yes_no": "no", "turns": [("q", "a"), ("q", "[{{\"bbox_2d\": [1, 2, 3, 4]}}]")]}, ["turn_1_negative_with_boxes"]),
    ({"task": "description"}, []),
)
_BROKEN_CODES = ", ".join(f"({i}, '{';'.join(codes)}')" for i, (_, codes) in enumerate(_BROKEN))


@query(f"""SELECT l_orderkey AS image, l_linenumber AS line, l_partkey AS part, errors FROM lineitem JOIN (VALUES {_BROKEN_CODES}) c(i, errors) ON i = (l_orderkey + l_partkey) % {len(_BROKEN)}""")
def qc_every_code(spark, d) -> DataFrame:
    """Each line as a record that breaks one rule."""
    i, n = (F.col("l_orderkey") + F.col("l_partkey")) % len(_BROKEN), F.col("l_partkey").cast("string")
    rows = [{"i": k, "question": "请看图。", "answer": "好。", **{c: v.replace("{{", "{").replace("}}", "}") if isinstance(v, str) else v for c, v in r.items()}} for k, (r, _) in enumerate(_BROKEN)]
    for r in rows:
        r["turns"] = [tuple(x.replace("{{", "{").replace("}}", "}") for x in t) for t in r["turns"]] if "turns" in r else None
    kind = "i int, " + ", ".join(f"{c} {t}" for c, t in quality.FIELDS.items())
    cases = spark.createDataFrame([(r["i"], *(r.get(c) for c in quality.FIELDS)) for r in rows], kind)
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("image"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), i.cast("int").alias("i"), n.alias("n"))
    filled = lines.join(F.broadcast(cases), "i").withColumns({c: F.replace(c, F.lit("{n}"), F.col("n")) for c in ("question", "answer")})
    checked = quality.with_errors(filled, {"text": "S"})
    return checked.select("image", "line", "part", F.array_join("errors", ";").alias("errors"))


_BODY = "b AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, role, text FROM conversations WHERE role <> 'system')"


@query(f"""WITH {_BODY}, s AS (SELECT conv_id, count(*) AS n, bool_or(role <> CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END) AS odd, bool_or(trim(text) = '') AS empty FROM b GROUP BY 1)
    SELECT conv_id, array_to_string(list_filter([CASE WHEN n < 2 THEN 'too_few_turns' END, CASE WHEN odd OR n % 2 <> 0 THEN 'roles_not_alternating' END, CASE WHEN empty THEN 'empty_turn' END], lambda x: x IS NOT NULL), ';') AS errors FROM s""")
def verify_turns(spark, d) -> DataFrame:
    rows = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    turns = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))
    checked = rows.filter(F.exists("t", lambda x: x["role"] != "system")).select("conv_id", quality.conversation_errors(turns, F.array().cast("array<string>")).alias("errors"))
    return checked.select("conv_id", F.array_join("errors", ";").alias("errors"))


_Q = "(['请检查{obj}是否存在裂纹。', '请给出{defect}的坐标。', '看看', '这玩意有问题吗？', '请评估剩余寿命与检查周期。', '请判断{ctx}表面状况', '请说明{obj}在机务与 AMM 中的要求。', '请定位{defect}所在区域。'])[(p_partkey % 8)::INT + 1]"
_T = "(['discrimination', 'grounding_single', 'region_word'])[(p_partkey // 8 % 3)::INT + 1]"


@query(f"""WITH q AS (SELECT p_partkey AS ord, {_T} AS task, {_Q} || (p_partkey // 24 % 40) || '？' AS question FROM part), r AS (SELECT *, row_number() OVER (PARTITION BY task, question ORDER BY ord) > 1 AS again, contains(question, '{{defect}}') AS hole FROM q)
    SELECT ord, task, CASE WHEN length(question) < 6 THEN 'length' WHEN again THEN 'repeated' WHEN contains(question, '这玩意') THEN 'colloquial' WHEN contains(question, '机务') THEN 'jargon'
      WHEN task = 'discrimination' AND hole THEN 'placeholder_not_allowed' WHEN task <> 'discrimination' AND NOT hole THEN 'placeholder_missing' WHEN contains(question, '剩余寿命') THEN 'unanswerable_trend'
      WHEN task <> 'grounding_single' AND contains(question, '坐标') THEN 'unanswerable_coordinates' END AS reason FROM r""")
def question_validate(spark, d) -> DataFrame:
    k = F.col("p_partkey")
    asked = ("请检查{obj}是否存在裂纹。", "请给出{defect}的坐标。", "看看", "这玩意有问题吗？", "请评估剩余寿命与检查周期。", "请判断{ctx}表面状况", "请说明{obj}在机务与 AMM 中的要求。", "请定位{defect}所在区域。")
    task = F.get(F.array(*map(F.lit, ("discrimination", "grounding_single", "region_word"))), (F.floor(k / 8) % 3).cast("int"))
    text = F.concat(F.get(F.array(*map(F.lit, asked)), (k % 8).cast("int")), (F.floor(k / 24) % 40).cast("string"), F.lit("？"))
    return questions.validate(table(spark, d, "part").select(k.alias("ord"), task.alias("task"), text.alias("question"))).select("ord", "task", "reason")


def _exported(spark, d) -> DataFrame:
    r = records(spark, d)
    images = F.when(F.col("ord") == 2, F.array(F.concat(F.lit("/data/"), F.col("qa_id"), F.lit("a.jpg")), F.concat(F.lit("/data/"), F.col("qa_id"), F.lit("b.jpg")))).otherwise(F.array(F.concat(F.lit("/data/"), F.col("qa_id"), F.lit(".jpg"))))
    return r.select("qa_id", "task", "image_status", F.lit("S").alias("system"), F.regexp_replace("question", "[^A-Za-z ]", "").alias("question"), F.regexp_replace("answer", "[^A-Za-z ]", "").alias("answer"), images.alias("images"))


_X = f"""WITH {RECORDS}, x AS (SELECT qa_id, task, image_status, regexp_replace(question, '[^A-Za-z ]', '', 'g') AS q, regexp_replace(answer, '[^A-Za-z ]', '', 'g') AS a, CASE WHEN ord = 2 THEN 2 ELSE 1 END AS n,
    CASE WHEN ord = 2 THEN '["' || qa_id || 'a.jpg","' || qa_id || 'b.jpg"]' ELSE '["' || qa_id || '.jpg"]' END AS images, ',"id":"' || qa_id || '","meta":{{"task":"' || task || '","image_status":"' || image_status || '"}}' || '}}' AS tail FROM records)"""


@query(f"""{_X} SELECT qa_id, '{{"conversations":[{{"from":"human","value":"' || repeat('<image>', n) || q || '"}},{{"from":"gpt","value":"' || a || '"}}],"images":' || images || ',"system":"S"' || tail AS line FROM x""")
def export_sharegpt(spark, d) -> DataFrame:
    return export.export(_exported(spark, d), "sharegpt", "/data")


_MSG = f"""{_X} SELECT qa_id, '{{"messages":[{{"role":"system","content":"S"}},{{"role":"user","content":"' || repeat('<image>', n) || q || '"}},{{"role":"assistant","content":"' || a || '"}}],"images":' || images || tail AS line FROM x"""


@query(_MSG)
def export_llamafactory(spark, d) -> DataFrame:
    return export.export(_exported(spark, d), "llamafactory", "/data")


@query(_MSG)
def export_swift(spark, d) -> DataFrame:
    return export.export(_exported(spark, d), "swift", "/data")


@query(f"""{_X} SELECT qa_id, '{{"messages":[{{"role":"system","content":"S"}},{{"role":"user","content":[' || CASE WHEN n = 2 THEN '{{"type":"image","image":"' || qa_id || 'a.jpg"}},{{"type":"image","image":"' || qa_id || 'b.jpg"}}' ELSE '{{"type":"image","image":"' || qa_id || '.jpg"}}' END
    || ',{{"type":"text","text":"' || q || '"}}]}},{{"role":"assistant","content":[{{"type":"text","text":"' || a || '"}}]}}]' || tail AS line FROM x""")
def export_openai(spark, d) -> DataFrame:
    return export.export(_exported(spark, d), "openai", "/data")


@query(rf"""WITH {RECORDS}, x AS (SELECT qa_id, answer, ord, CASE ord % 3 WHEN 0 THEN '<think>x</think> ' || answer WHEN 1 THEN answer || ' 42' ELSE '<think>' || answer END AS raw FROM records), s AS (SELECT qa_id, answer, trim(regexp_replace(regexp_replace(raw, '(?s)<think>.*?</think>', '', 'g'), '(?s)<think>.*$', ''), E' \t\n\r\f\v') AS new FROM x),
    f AS (SELECT *, array_to_string(regexp_extract_all(answer, '-?\d+(?:\.\d+)?'), '|') || '|' || regexp_extract(answer, '(?s)\[.*\]') AS before, array_to_string(regexp_extract_all(new, '-?\d+(?:\.\d+)?'), '|') || '|' || regexp_extract(new, '(?s)\[.*\]') AS after FROM s)
    SELECT qa_id, CASE WHEN new = '' THEN 'empty' WHEN before <> after THEN 'facts_changed' END AS why FROM f""")
def rewrite_gate(spark, d) -> DataFrame:
    k = F.col("ord") % 3
    raw = F.when(k == 0, F.concat(F.lit("<think>x</think> "), F.col("answer"))).when(k == 1, F.concat(F.col("answer"), F.lit(" 42"))).otherwise(F.concat(F.lit("<think>"), F.col("answer")))
    return records(spark, d).select("qa_id", enrich.gate(F.col("question"), F.col("answer"), raw).alias("why"))



_STEPS, _DONE = 8, 3
_ELIGIBLE = "task IN ('discrimination', 'description', 'classification_open')"


def _model(question: str, answer: str) -> str:
    """Says nothing, changes the facts, or repeats the answer."""
    return ("<think>well</think>", answer + " 42", "<think>well</think> " + answer, answer, answer)[len(answer) % 5]


@query(rf"""WITH {RECORDS}, k AS (SELECT task, answer, md5(task || chr(0) || question || chr(0) || answer) AS k FROM records WHERE {_ELIGIBLE}), d AS (SELECT DISTINCT task, k, trim(answer, E' \t\n\r\f\v') AS a, length(answer) % 5 AS says FROM k),
    s AS (SELECT *, ('0x' || substr(k, 1, 8))::BIGINT % {_STEPS} < {_DONE} AS first_run, CASE WHEN says = 0 OR a = '' THEN CASE WHEN says = 1 THEN 'facts_changed' ELSE 'empty' END WHEN says = 1 THEN 'facts_changed' END AS why FROM d)
    SELECT task, count(*) AS asked, count(*) FILTER (first_run) AS hits_of_second_run, count(*) FILTER (NOT first_run) AS asked_by_second_run, count(*) FILTER (why IS NULL) AS accepted, count(why) AS refused, count(*) FILTER (why = 'empty') AS empty_answers FROM s GROUP BY task""")
def rewrite_resume(spark, d) -> DataFrame:
    """A run that ends after 3 of its 8 steps, and a second one that asks for what lacks."""
    formats = F.when(F.col("task") == "grounding_all", "json_only").when(F.col("task") == "counting", "text_then_json").otherwise("text")
    r = split.written(records(spark, d).withColumn("output_format", formats), "records")
    cache = rewrite_cache.RewriteCache(spark, split.new_folder(spark, "rewrites"))
    cache.fill(r, _model, "m", steps=_STEPS, most=_DONE)
    hits = cache.report(r).select("task", F.col("hits").alias("hits_of_second_run"))
    second = cache.fill(r, _model, "m")
    tasks = r.select("task", X.cache_key(F.col("task"), F.col("question"), F.col("answer")).alias("k")).distinct()
    found = cache.rows().join(tasks, "k").groupBy("task").agg(F.count_if(F.col("attempt") == second).alias("asked_by_second_run"), F.count_if(F.col("why") == "empty").alias("empty_answers"))
    return cache.report(r).drop("hits").join(hits, "task").join(found, "task").select("task", "asked", "hits_of_second_run", "asked_by_second_run", "accepted", "refused", "empty_answers")


@query("""WITH RECURSIVE c AS (SELECT vec_id, unnest(range(0, 64)) AS p, unnest(embedding) > 0 AS on_ FROM embeddings), m AS (SELECT vec_id, p, p // 8 AS y, p % 8 AS x FROM c WHERE on_),
    e AS (SELECT a.vec_id, a.p AS a, b.p AS b FROM m a JOIN m b ON a.vec_id = b.vec_id AND abs(a.x - b.x) + abs(a.y - b.y) = 1),
    reach(vec_id, p, q) AS (SELECT vec_id, p, p FROM m UNION SELECT r.vec_id, e.b, r.q FROM reach r JOIN e ON e.vec_id = r.vec_id AND e.a = r.p),
    k AS (SELECT vec_id, p, min(q) AS root FROM reach GROUP BY 1, 2), s AS (SELECT vec_id, root, count(*) AS area, min(p % 8) || ',' || min(p // 8) || ',' || (max(p % 8) + 1) || ',' || (max(p // 8) + 1) AS box FROM k GROUP BY 1, 2)
    SELECT vec_id, count(*) AS n_components, max(area) AS largest, string_agg(area || '@' || box, ';' ORDER BY area DESC, box) AS components FROM s GROUP BY 1""")
def mask_components(spark, d) -> DataFrame:
    """Embeddings as 8 x 8 masks: connected components by the numpy labelling."""
    v = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: (x > 0).cast("int").cast("tinyint")).alias("mask"))
    found = v.select("vec_id", imaging.components_udf(8)(F.col("mask")).alias("c")).filter(F.size("c") > 0)
    box = lambda c: F.concat_ws(",", c["x0"].cast("string"), c["y0"].cast("string"), c["x1"].cast("string"), c["y1"].cast("string"))
    named = F.transform("c", lambda c: F.struct((-c["area"]).alias("o"), box(c).alias("box")))
    line = F.array_join(F.transform(F.array_sort(named), lambda c: F.concat((-c["o"]).cast("string"), F.lit("@"), c["box"])), ";")
    return found.select("vec_id", F.size("c").cast("bigint").alias("n_components"), F.array_max(F.transform("c", lambda c: c["area"])).alias("largest"), line.alias("components"))


@query(None)
def pipeline_end_to_end(spark, d) -> DataFrame:
    """Cap, balance, generate, dedup, class cap, checks, quota, split: counts by split and task."""
    s = split.written(image_samples(spark, d), "samples")  # assembled once, read three times
    s = Sampling(s).cap_source_share(0.4).balance_labels(1.0).apply()
    r = generate.records(s)
    # Made and checked in one pass; what later steps look at is written, the texts for the dedup alone.
    kept = ["sample_id", "task", "target_type", "qa_id"]
    r = split.written(r.select(*kept, "image", "question", "answer", quality.passes(r, generate.SYSTEMS).alias("passes")), "records")
    r = split.dedup_rare(r, ["image", "question", "answer"], ["qa_id"])
    r = split.written(r.filter("passes").select(*kept), "passing")
    r = cap_classes(r, ["classification_open", "classification_mc"], 3.0)
    r = quota_sample(r, generate.RATIO)
    return split.split_by(r, "sample_id").groupBy("split", "task").agg(F.count("*").alias("n"))


@query(f"""WITH {BOXES} SELECT DISTINCT image, {draw(9, 'image')} % 8 AS pick FROM boxes""")
def hash_pick(spark, d) -> DataFrame:
    return boxes(spark, d).select("image", (draws.number(9, F.col("image")) % 8).alias("pick")).distinct()
