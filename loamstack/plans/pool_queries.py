"""Queries of file arrangement, model pools, question pools and actions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamstack.operators import arrange, pool, quality, question_rounds, questions, taxonomy
from loamstack.plans.views import draw, registered, table
from loamstack.sources import profile

QUERIES, ORACLE_SQL, query = registered()

_DIRS = ("Train/Images", "data/Testing/x", "misc")
_MASK_DIRS = ("train/masks", "TRAIN/more", "Valid")
_ENDINGS = ("", "_mask", "-GT", "_Annotation", "_other")


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _at(values, i):
    return F.get(F.array(*map(F.lit, values)), i.cast("int"))


@query("""SELECT 'd' || l_suppkey AS directory, CASE WHEN sum(v) > 0 OR (sum(v) = 0 AND arg_min(v, (name, v)) > 0) THEN 'mask' ELSE 'photo' END AS kind
    FROM (SELECT l_suppkey, l_orderkey || '-' || l_linenumber AS name, CASE WHEN l_quantity <= 16 THEN 1 ELSE -1 END AS v FROM lineitem) GROUP BY l_suppkey""")
def mask_directories(spark, d) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.concat(F.lit("d"), F.col("l_suppkey").cast("string")).alias("directory"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("name"), F.col("l_quantity").alias("levels"))
    return arrange.kinds(rows)


@query(f"""WITH p AS (SELECT ({_sql_list(_DIRS)})[(o_orderkey % 3)::INT + 1] AS directory, o_orderkey || '.jpg' AS name, (['train', 'test', 'all'])[(o_orderkey % 3)::INT + 1] AS split, o_orderkey::VARCHAR AS stem FROM orders),
    m AS (SELECT (['train', 'train', 'test'])[(l_partkey % 3)::INT + 1] AS split, CASE WHEN e = '_other' THEN l_orderkey || e ELSE l_orderkey::VARCHAR END AS stem, (({_sql_list(_MASK_DIRS)})[(l_partkey % 3)::INT + 1], l_orderkey || e || '.png') AS place
        FROM (SELECT *, ({_sql_list(_ENDINGS)})[(l_linenumber % 5)::INT + 1] AS e FROM lineitem)),
    i AS (SELECT pool, stem, min(place) AS place FROM (SELECT split AS pool, stem, place FROM m UNION ALL SELECT '*', stem, place FROM m) GROUP BY 1, 2)
    SELECT p.split, p.directory, p.name, p.stem, i.place[1] || '/' || i.place[2] AS mask FROM p LEFT JOIN i ON i.stem = p.stem AND i.pool = CASE WHEN p.split IN (SELECT split FROM m) THEN p.split ELSE '*' END""")
def photo_mask_pairs(spark, d) -> DataFrame:
    photos = table(spark, d, "orders").select(_at(_DIRS, F.col("o_orderkey") % 3).alias("directory"), F.concat(F.col("o_orderkey").cast("string"), F.lit(".jpg")).alias("name"))
    masks = table(spark, d, "lineitem").select(_at(_MASK_DIRS, F.col("l_partkey") % 3).alias("directory"), F.concat(F.col("l_orderkey").cast("string"), _at(_ENDINGS, F.col("l_linenumber") % 5), F.lit(".png")).alias("name"))
    return arrange.paired(photos, masks)


MODELS = [{"name": "alpha", "weight": 3.0}, {"name": "beta", "weight": 1.0}, {"name": "gamma", "weight": 0.0}]
_MODELS = "(VALUES ('alpha', 0), ('beta', 1), ('gamma', 2)) m(name, i)"


@query(f"""SELECT event_id, string_agg(name, '>' ORDER BY name <> CASE WHEN u < 0.75 THEN 'alpha' ELSE 'beta' END, md5('7:' || event_id || ':' || name)) AS route
    FROM (SELECT event_id, {draw(7, 'event_id')} / 4294967296::DOUBLE AS u FROM events), {_MODELS} GROUP BY event_id""")
def route_weighted(spark, d) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.array_join(pool.route(MODELS, "weighted", F.col("event_id"), 7), ">").alias("route"))


@query(f"""SELECT event_id, string_agg(name, '>' ORDER BY (i + 3 - event_id % 3) % 3) AS route FROM events, {_MODELS} GROUP BY event_id""")
def route_round_robin(spark, d) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.array_join(pool.route(MODELS, "round_robin", F.col("event_id")), ">").alias("route"))


_LOG = "log AS (SELECT event_type AS model, event_id % 7 <> 0 AS ok, event_id * 37 % 4001 AS latency_ms, CASE event_id % 21 WHEN 0 THEN 'Timeout' WHEN 7 THEN 'empty' END AS err FROM events)"


def _log(spark, d) -> DataFrame:
    i = F.col("event_id")
    return table(spark, d, "events").select(F.col("event_type").alias("model"), (i % 7 != 0).alias("ok"), (i * 37 % 4001).alias("latency_ms"), F.when(i % 21 == 0, "Timeout").when(i % 21 == 7, "empty").alias("err"))


@query(f"""WITH {_LOG} SELECT coalesce(model, '*') AS model, count(*) AS calls, sum(ok::INT)::BIGINT AS ok, sum((NOT ok)::INT)::BIGINT AS fail, round(sum(ok::INT)::DOUBLE / count(*), 4) AS success_rate, round(sum(latency_ms)::DOUBLE / count(*) / 1000, 2) AS avg_latency_s
    FROM log GROUP BY ROLLUP (model)""")
def pool_summary(spark, d) -> DataFrame:
    return pool.summary(_log(spark, d))


@query(f"""WITH {_LOG} SELECT err, count(*) AS n FROM log WHERE NOT ok AND err <> '' GROUP BY 1 ORDER BY n DESC, err LIMIT 10""")
def pool_top_errors(spark, d) -> DataFrame:
    return pool.top_errors(_log(spark, d))


@query("""WITH r AS (SELECT event_type AS task, event_id % 3 = 0 AS ok, CASE WHEN event_id % 6 = 0 THEN 'm' || event_id % 4 END AS model, CASE event_id % 3 WHEN 1 THEN 'facts_changed' END AS why FROM events)
    SELECT 'total' AS dim, '' AS value, count(*) AS n FROM r UNION ALL SELECT 'adopted', '', count(*) FROM r WHERE ok UNION ALL SELECT 'task', task, count(*) FROM r WHERE ok GROUP BY 2
    UNION ALL SELECT 'model', model, count(*) FROM r WHERE ok AND model IS NOT NULL GROUP BY 2 UNION ALL SELECT 'refused', coalesce(why, 'no_response'), count(*) FROM r WHERE NOT ok GROUP BY 2""")
def rewrite_adoption(spark, d) -> DataFrame:
    i = F.col("event_id")
    r = table(spark, d, "events").select(F.col("event_type").alias("task"), (i % 3 == 0).alias("rewritten"), F.when(i % 6 == 0, F.concat(F.lit("m"), (i % 4).cast("string"))).alias("rewritten_by"), F.when(i % 3 == 1, "facts_changed").alias("rewrite_rejected"))
    return pool.adoption(r)


_BANK = """bank AS (SELECT 't' || item_id % 7 AS task, CASE WHEN item_id % 7 = 3 THEN text WHEN item_id % 2 = 0 THEN '请看图中的' || item_id || '，有没有问题？' WHEN item_id % 5 = 0 THEN '画面{region}的' || item_id || '是什么？' ELSE text END AS question FROM benchmark)"""


def _bank(spark, d) -> DataFrame:
    i = F.col("item_id")
    n = i.cast("string")
    q = F.when(i % 7 == 3, F.col("text")).when(i % 2 == 0, F.concat(F.lit("请看图中的"), n, F.lit("，有没有问题？"))).when(i % 5 == 0, F.concat(F.lit("画面{region}的"), n, F.lit("是什么？"))).otherwise(F.col("text"))
    return table(spark, d, "benchmark").select(F.concat(F.lit("t"), (i % 7).cast("string")).alias("task"), q.alias("question"))


_ENGLISH = "(length(regexp_replace(question, '[^A-Za-z]', '', 'g')) > greatest(8.0, length(question) * 0.4))"


@query(f"""WITH {_BANK} SELECT task, question FROM bank WHERE NOT {_ENGLISH} OR task NOT IN (SELECT task FROM bank WHERE NOT {_ENGLISH})""")
def question_language(spark, d) -> DataFrame:
    return questions.in_language(_bank(spark, d))


_SALVAGE = """r AS (SELECT p_partkey // 6 AS request, (['discrimination', 'description', 'counting'])[(p_partkey // 6 % 3)::INT + 1] AS task, p_partkey // 6 % 5 AS shape, row_number() OVER (PARTITION BY p_partkey // 6 ORDER BY p_partkey) - 1 AS pos, count(*) OVER (PARTITION BY p_partkey // 6) AS size,
        CASE p_size % 4 WHEN 0 THEN '这玩意有问题吗？' WHEN 1 THEN '请查看{obj}第' || p_size || '处。' WHEN 2 THEN '请清点图中的{defect}' || p_size || '处。' ELSE '看看' END AS question FROM part)"""


@query(f"""WITH {_SALVAGE}, s AS (SELECT *, CASE shape WHEN 4 THEN 'none' WHEN 3 THEN CASE WHEN size > 1 THEN 'salvaged' ELSE 'torn' END ELSE 'whole' END AS state FROM r),
    f AS (SELECT *, row_number() OVER (PARTITION BY task, question ORDER BY request, pos) > 1 AS again FROM s WHERE shape < 3 OR (shape = 3 AND pos < size - 1)),
    c AS (SELECT state, CASE WHEN length(question) < 6 THEN 'length' WHEN again THEN 'repeated' WHEN contains(question, '这玩意') THEN 'colloquial' WHEN task <> 'counting' AND contains(question, '{{defect}}') THEN 'placeholder_not_allowed'
        WHEN task = 'counting' AND NOT contains(question, '{{defect}}') THEN 'placeholder_missing' ELSE 'kept' END AS reason FROM f)
    SELECT state, reason, count(*) AS n FROM c GROUP BY 1, 2""")
def question_salvage(spark, d) -> DataFrame:
    """Six parts make an answer of a model; every fifth is torn in its last question, every fifth has no list."""
    k, size = F.col("p_partkey"), F.col("p_size")
    text = F.when(size % 4 == 0, "这玩意有问题吗？").when(size % 4 == 1, F.concat(F.lit("请查看{obj}第"), size.cast("string"), F.lit("处。"))).when(size % 4 == 2, F.concat(F.lit("请清点图中的{defect}"), size.cast("string"), F.lit("处。"))).otherwise("看看")
    parts = table(spark, d, "part").select(F.floor(k / 6).alias("request"), F.struct(k.alias("k"), text.alias("q")).alias("x"))
    said = parts.groupBy("request").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["q"]).alias("qs"))
    whole, shape = F.to_json("qs"), F.col("request") % 5
    answer = F.when(shape == 4, "没有问题").when(shape == 3, F.expr("substring(whole, 1, length(whole) - 3)")).otherwise(F.col("whole"))
    replies = said.withColumn("whole", whole).select("request", _at(("discrimination", "description", "counting"), F.col("request") % 3).alias("task"), answer.alias("text"))
    none = spark.createDataFrame([], "task string, question string")
    return question_rounds.checked(replies, none).groupBy("state", F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"""WITH {_BANK}, p AS (SELECT task, contains(question, '{{defect}}') OR contains(question, '{{region}}') AS named, list_sort(list(DISTINCT question)) AS qs FROM bank GROUP BY 1, 2),
    a AS (SELECT o_orderkey AS sample_id, 't' || o_custkey % 8 AS task, o_orderkey % 2 = 0 AS named FROM orders)
    SELECT sample_id, a.task, a.named, qs[({draw(0, "a.sample_id || ':' || a.task")} % len(qs))::INT + 1] AS question FROM a LEFT JOIN p ON p.task = a.task AND p.named = a.named""")
def question_pick(spark, d) -> DataFrame:
    asked = table(spark, d, "orders").select(F.col("o_orderkey").alias("sample_id"), F.concat(F.lit("t"), (F.col("o_custkey") % 8).cast("string")).alias("task"), (F.col("o_orderkey") % 2 == 0).alias("named"))
    return questions.pick(asked, _bank(spark, d)).select("sample_id", "task", "named", "question")


_ZH = ", ".join(f"('{x[1]}', '{x[0]}')" for x in taxonomy.DEFECTS)
_LABELS = ("裂纹", "凹坑", "dent", "腐蚀锈蚀", "", "别的")


@query(f"""WITH z AS (SELECT * FROM (VALUES {_ZH}) v(zh, type)), l AS (SELECT l_orderkey, l_linenumber, ({_sql_list(_LABELS)})[(l_partkey % 6)::INT + 1] AS label FROM lineitem),
    t AS (SELECT l_orderkey, coalesce(type, label) AS type, min((l_linenumber, label)) AS place FROM l LEFT JOIN z ON zh = label WHERE label <> '' AND l_orderkey % 5 <> 0 GROUP BY 1, 2)
    SELECT o AS image, coalesce(string_agg(type, ';' ORDER BY place), '') AS types FROM (SELECT DISTINCT l_orderkey AS o FROM lineitem) LEFT JOIN t ON l_orderkey = o GROUP BY 1""")
def types_in_answer(spark, d) -> DataFrame:
    """Answers made of each order's lines; those of every fifth order are cut and assert nothing."""
    label = _at(_LABELS, F.col("l_partkey") % 6)
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("image")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", label.alias("label")))).alias("x"))
    whole = F.concat(F.lit("共："), F.to_json(F.transform("x", lambda x: F.struct(F.array(x["l_linenumber"]).alias("bbox"), x["label"].alias("label")))))
    answer = F.when(F.col("image") % 5 == 0, F.expr("substring(whole, 1, length(whole) - 2)")).otherwise(F.col("whole"))
    return lines.select("image", whole.alias("whole")).select("image", F.array_join(questions.types_in_answer(answer), ";").alias("types"))


_TYPES = (*[x[0] for x in taxonomy.DEFECTS], "no_such_type")
_GRADED = ("good", "fair", "poor", "severe", "none")


@query(f"""WITH a AS (SELECT * FROM (VALUES {", ".join(f"('{k}', '{v}')" for k, v in taxonomy.ACTIONS.items())}) v(type, act)), g AS (SELECT * FROM (VALUES {", ".join(f"('{k}', '{v}')" for k, v in taxonomy.GRADE_ACTIONS.items())}) v(grade, act)),
    x AS (SELECT ({_sql_list(_TYPES)})[(l_partkey % 17)::INT + 1] AS type, ({_sql_list(_GRADED)})[(l_suppkey % 5)::INT + 1] AS grade, count(*) AS n FROM lineitem GROUP BY 1, 2)
    SELECT x.type, x.grade, coalesce(CASE WHEN x.type = 'corrosion' THEN g.act END, a.act, '{taxonomy.ACTIONS[taxonomy.OTHER]}') AS action, n FROM x LEFT JOIN a ON a.type = x.type LEFT JOIN g ON g.grade = x.grade""")
def defect_actions(spark, d) -> DataFrame:
    x = table(spark, d, "lineitem").select(_at(_TYPES, F.col("l_partkey") % 17).alias("type"), _at(_GRADED, F.col("l_suppkey") % 5).alias("grade")).groupBy("type", "grade").agg(F.count("*").alias("n"))
    return x.select("type", "grade", taxonomy.action(F.col("type"), F.col("grade")).alias("action"), "n")


@query("""WITH f AS (SELECT DISTINCT l_orderkey || '.jpg' AS path FROM lineitem), r AS (SELECT o_orderkey AS qa_id, CASE WHEN o_orderkey % 2 = 0 THEN [o_orderkey || '.jpg', o_orderkey + 1 || '.jpg'] ELSE [o_orderkey || '.jpg'] END AS images FROM orders)
    SELECT DISTINCT qa_id FROM (SELECT qa_id, unnest(images) AS path FROM r) WHERE path NOT IN (SELECT path FROM f)""")
def image_missing(spark, d) -> DataFrame:
    path = lambda k: F.concat(k.cast("string"), F.lit(".jpg"))
    k = F.col("o_orderkey")
    r = table(spark, d, "orders").select(k.alias("qa_id"), F.when(k % 2 == 0, F.array(path(k), path(k + 1))).alias("images"), path(k).alias("image"))
    return quality.images_missing(r, table(spark, d, "lineitem").select(path(F.col("l_orderkey")).alias("path")))


_FIELDS = ("image_path", "image", "path")


@query("""WITH e AS (SELECT event_type || '-' || event_id % 6 AS source, event_id % 6 AS k, 'u' || user_id AS u, user_id FROM events), c AS (SELECT c_custkey FROM customer),
    j AS (SELECT source, CASE k WHEN 0 THEN 'image' WHEN 1 THEN 'path' WHEN 4 THEN 'image_path' WHEN 5 THEN 'image' END AS field, k, CASE WHEN k IN (2, 3) THEN 'no_field' WHEN k = 4 OR c_custkey IS NULL THEN 'no_file' WHEN user_id % 2 = 0 THEN 'no_size' ELSE 'ok' END AS reason FROM e LEFT JOIN c ON c_custkey = user_id),
    r AS (SELECT source, reason, count(*) AS n FROM j GROUP BY 1, 2), w AS (SELECT source, arg_min(reason, (-n, list_position(['no_field', 'no_file', 'no_size', 'ok'], reason))) AS why, coalesce(sum(n) FILTER (reason = 'ok'), 0)::BIGINT AS n_ok, sum(n)::BIGINT AS n_items FROM r GROUP BY 1)
    SELECT source, n_items, n_ok, CASE WHEN n_ok > 0 THEN 'ok' ELSE why END AS reason, CASE WHEN split_part(source, '-', 2) IN ('2', '3') THEN '' ELSE CASE split_part(source, '-', 2) WHEN '0' THEN 'image=' WHEN '1' THEN 'path=' WHEN '4' THEN 'image_path=' ELSE 'image=' END || n_items END AS fields,
        CASE split_part(source, '-', 2) WHEN '0' THEN 'image=' || n_items WHEN '1' THEN 'path=' || n_items WHEN '2' THEN 'file=' || n_items WHEN '3' THEN 'image=' || n_items WHEN '4' THEN 'image_path=' || n_items ELSE 'image=' || n_items || ',label=' || n_items END AS keys FROM w""")
def source_reasons(spark, d) -> DataFrame:
    """Events as the items of manifests in six shapes: which field names a customer, and why sources gave no row."""
    k, u = F.col("event_id") % 6, F.concat(F.lit("u"), F.col("user_id").cast("string"))
    one = lambda name, v: F.create_map(F.lit(name), v)
    item = F.when(k == 0, one("image", u)).when(k == 1, one("path", u)).when(k == 2, one("file", u)).when(k == 3, one("image", F.lit(""))).when(k == 4, one("image_path", F.lit("gone"))).otherwise(F.create_map(F.lit("image"), u, F.lit("label"), F.lit("x")))
    e = table(spark, d, "events").select(F.concat_ws("-", "event_type", k.cast("string")).alias("source"), "user_id", item.alias("item"))
    named = F.coalesce(*[F.nullif(F.try_element_at("item", F.lit(n)), F.lit("")) for n in _FIELDS])
    files = table(spark, d, "customer").select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("file"))
    found = e.withColumn("named", named).join(files, F.col("named") == F.col("file"), "left")
    width = F.when(F.col("user_id") % 2 == 1, 8)
    return profile.profile(found.select("source", "item", profile.reason(profile.first_field(F.col("item"), _FIELDS), F.col("file"), width).alias("reason")), _FIELDS)
