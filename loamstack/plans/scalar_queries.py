"""Queries of the scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamstack.functions import geometry as G
from loamstack.functions import text as X
from loamstack.plans.views import BOXES, RECORDS, H, W, boxes, records, registered, table

QUERIES, ORACLE_SQL, query = registered()


w, h = lambda: F.lit(W), lambda: F.lit(H)


@query("""SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(p_name || ' - ' || p_type || '/' || p_brand)), '[\\s\\-/]+', '_', 'g'), '[^a-z0-9_]+', '', 'g'), '_+', '_', 'g'), '_') AS name_key FROM part""")
def norm_key_map(spark, d) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", X.norm_key(F.concat(F.col("p_name"), F.lit(" - "), F.col("p_type"), F.lit("/"), F.col("p_brand"))).alias("name_key"))




@query(f"""WITH {BOXES}, c AS (SELECT *, (x1 + x2)::DOUBLE / 2 / {W} AS cx, (y1 + y2)::DOUBLE / 2 / {H} AS cy FROM boxes),
    g AS (SELECT *, CASE WHEN cx < 1.0::DOUBLE / 3 THEN '左' WHEN cx < 2.0::DOUBLE / 3 THEN '中' ELSE '右' END AS c, CASE WHEN cy < 1.0::DOUBLE / 3 THEN '上' WHEN cy < 2.0::DOUBLE / 3 THEN '中' ELSE '下' END AS r FROM c)
    SELECT region, count(*) AS n FROM (SELECT CASE WHEN r = '中' AND c = '中' THEN '正中' WHEN r = '中' THEN c || '侧中部' WHEN c = '中' THEN '中' || r || '部' ELSE c || r END AS region FROM g) GROUP BY 1""")
def region_word(spark, d) -> DataFrame:
    return boxes(spark, d).select(G.region_word(F.col("box"), w(), h()).alias("region")).groupBy("region").agg(F.count("*").alias("n"))


_RATIO = f"CASE WHEN x2 > x1 AND y2 > y1 THEN ((x2 - x1) * (y2 - y1))::DOUBLE / {W * H} ELSE 0 END"


@query(f"""WITH {BOXES}, r AS (SELECT {_RATIO} AS a FROM boxes) SELECT CASE WHEN a < 0.002 THEN '范围极小' WHEN a < 0.01 THEN '范围较小' WHEN a < 0.05 THEN '范围中等' WHEN a < 0.15 THEN '范围较大' ELSE '范围很大' END AS size, count(*) AS n FROM r GROUP BY 1""")
def size_word(spark, d) -> DataFrame:
    return boxes(spark, d).select(G.size_word(G.area_ratio(F.col("box"), w(), h())).alias("size")).groupBy("size").agg(F.count("*").alias("n"))


@query(f"""WITH {BOXES}, r AS (SELECT part % 4 AS k, {_RATIO} AS a FROM boxes), s AS (SELECT (['minor', 'major', 'critical', 'odd'])[k::INT + 1] AS base, CASE WHEN a >= 0.08 THEN 1 WHEN a > 0 AND a < 0.003 THEN -1 ELSE 0 END AS step FROM r)
    SELECT base, (['minor', 'major', 'critical'])[least(3, greatest(1, step + CASE base WHEN 'minor' THEN 1 WHEN 'critical' THEN 3 ELSE 2 END))] AS severity, count(*) AS n FROM s GROUP BY 1, 2""")
def severity_from_area(spark, d) -> DataFrame:
    base = F.get(F.array(*map(F.lit, ("minor", "major", "critical", "odd"))), (F.col("part") % 4).cast("int"))
    return boxes(spark, d).select(base.alias("base"), G.area_ratio(F.col("box"), w(), h()).alias("a")).groupBy("base", G.severity_from_area(F.col("base"), F.col("a")).alias("severity")).agg(F.count("*").alias("n"))


@query(f"""WITH {BOXES} SELECT image, line, part, supp, x1 || ',' || y1 || ',' || x2 || ',' || y2 AS pixels, least(1000, greatest(0, round_even(x1::DOUBLE / {W} * 1000, 0)))::INT || ',' || least(1000, greatest(0, round_even(y1::DOUBLE / {H} * 1000, 0)))::INT || ',' ||
    least(1000, greatest(0, round_even(x2::DOUBLE / {W} * 1000, 0)))::INT || ',' || least(1000, greatest(0, round_even(y2::DOUBLE / {H} * 1000, 0)))::INT AS norm FROM boxes""")
def norm_box(spark, d) -> DataFrame:
    line = lambda b: F.array_join(b.cast("array<string>"), ",")
    return boxes(spark, d).select("image", "line", "part", "supp", line(F.col("box")).alias("pixels"), line(G.norm_box(F.col("box"), w(), h())).alias("norm"))


@query(f"""WITH {BOXES} SELECT image, count(*) AS n_boxes, round(max({_RATIO}), 12) AS max_ratio, min(x1) || ',' || min(y1) || ',' || max(x2) || ',' || max(y2) AS merged FROM boxes GROUP BY image""")
def bbox_area_ratio(spark, d) -> DataFrame:
    by = boxes(spark, d).groupBy("image").agg(F.count("*").alias("n_boxes"), F.round(F.max(G.area_ratio(F.col("box"), w(), h())), 12).alias("max_ratio"), F.collect_list("box").alias("bs"))
    return by.select("image", "n_boxes", "max_ratio", F.array_join(G.merged(F.col("bs")).cast("array<string>"), ",").alias("merged"))


@query(f"""WITH {BOXES}, p AS (SELECT a.image, a.line AS line_a, b.line AS line_b, greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)) AS i,
    (a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) AS s FROM boxes a JOIN boxes b ON a.image = b.image AND a.line < b.line)
    SELECT image, count(*) AS n_pairs, sum((i > 0)::INT)::BIGINT AS n_overlap, round(max(CASE WHEN i > 0 AND s - i > 0 THEN i::DOUBLE / (s - i) ELSE 0 END), 6) AS max_iou FROM p GROUP BY image""")
def iou_pairs(spark, d) -> DataFrame:
    """Overlaps inside an image, on its array of boxes; no join."""
    by = boxes(spark, d).groupBy("image").agg(F.collect_list(F.struct("line", "box")).alias("bs"))
    pairs = F.flatten(F.transform("bs", lambda a: F.transform(F.filter("bs", lambda b: a["line"] < b["line"]), lambda b: G.iou(a["box"], b["box"]))))
    found = by.select("image", pairs.alias("ious")).filter(F.size("ious") > 0)
    return found.select("image", F.size("ious").cast("bigint").alias("n_pairs"), F.size(F.filter("ious", lambda x: x > 0)).cast("bigint").alias("n_overlap"), F.round(F.array_max("ious"), 6).alias("max_iou"))


@query("""WITH s AS (SELECT p_partkey, p_size * 61.0::DOUBLE AS h, (p_partkey % 97 + 1) * 43.0::DOUBLE AS w FROM part), b AS (SELECT *, greatest(28, round_even(h / 28, 0) * 28) AS hb, greatest(28, round_even(w / 28, 0) * 28) AS wb FROM s)
    SELECT p_partkey, (CASE WHEN hb * wb > 1048576 THEN greatest(28, floor(h / sqrt(h * w / 1048576) / 28) * 28) WHEN hb * wb < 3136 THEN ceil(h * sqrt(3136.0::DOUBLE / (h * w)) / 28) * 28 ELSE hb END)::BIGINT AS h,
    (CASE WHEN hb * wb > 1048576 THEN greatest(28, floor(w / sqrt(h * w / 1048576) / 28) * 28) WHEN hb * wb < 3136 THEN ceil(w * sqrt(3136.0::DOUBLE / (h * w)) / 28) * 28 ELSE wb END)::BIGINT AS w FROM b""")
def smart_resize(spark, d) -> DataFrame:
    part = table(spark, d, "part")
    size = G.smart_resize(F.col("p_size") * 61.0, (F.col("p_partkey") % 97 + 1) * 43.0, most=1 << 20)
    return part.select("p_partkey", size.alias("s")).select("p_partkey", "s.h", "s.w")


@query(f"""WITH {RECORDS} SELECT sample_id, ord, substr(md5(sample_id || '|' || task || '|' || question), 1, 16) AS qa_id, md5(task || chr(0) || question || chr(0) || answer) AS cache_key FROM records""")
def qa_id_hash(spark, d) -> DataFrame:
    r = records(spark, d)
    return r.select("sample_id", "ord", X.qa_id(F.col("sample_id"), F.col("task"), F.col("question")).alias("qa_id"),
                    X.cache_key(F.col("task"), F.col("question"), F.col("answer")).alias("cache_key"))


@query("""SELECT event_id, array_to_string(regexp_extract_all(event_type || ' -' || props || ' [' || user_id || '] ' || (event_id % 7), '-?\\d+(?:\\.\\d+)?'), '|') || '|' || regexp_extract(event_type || ' -' || props || ' [' || user_id || '] ' || (event_id % 7), '(?s)\\[.*\\]') AS facts FROM events""")
def fact_fingerprint(spark, d) -> DataFrame:
    t = F.concat(F.col("event_type"), F.lit(" -"), F.col("props"), F.lit(" ["), F.col("user_id").cast("string"), F.lit("] "), (F.col("event_id") % 7).cast("string"))
    return table(spark, d, "events").select("event_id", F.array_join(X.facts(t), "|").alias("facts"))


_RAW = "CASE doc_id % 4 WHEN 0 THEN '<think>' || substr(text, 1, 20) || '</think> ' || substr(text, 21) WHEN 1 THEN substr(text, 1, 20) || '</reason>' || substr(text, 21) WHEN 2 THEN substr(text, 1, 20) || ' <thinking>' || substr(text, 21) ELSE text END"


@query(f"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace({_RAW}, '(?is)<\\s*think\\s*>.*?<\\s*/\\s*think\\s*>', '', 'g'), '(?is)^.*<\\s*/\\s*(?:think|thinking|reasoning|reason)\\s*>', ''),
    '(?is)<\\s*(?:think|thinking|reasoning|reason)\\s*>.*$', ''), '^\\s+|\\s+$', '', 'g') AS answer FROM documents""")
def strip_reasoning(spark, d) -> DataFrame:
    t = F.col("text")
    first, rest, k = F.substring(t, 1, 20), F.expr("substring(text, 21)"), F.col("doc_id") % 4
    raw = (F.when(k == 0, F.concat(F.lit("<think>"), first, F.lit("</think> "), rest)).when(k == 1, F.concat(first, F.lit("</reason>"), rest))
           .when(k == 2, F.concat(first, F.lit(" <thinking>"), rest)).otherwise(t))
    return table(spark, d, "documents").select("doc_id", X.strip_reasoning(raw).alias("answer"))


@query("""SELECT doc_id, length(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) > greatest(8, length(text) * 0.4::DOUBLE) AS english FROM documents""")
def is_english(spark, d) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.is_english(F.col("text")).alias("english"))


@query(f"""WITH {BOXES} SELECT image, count(*) AS n, round(min(greatest(0, {W / 2 + H / 2} - y2::DOUBLE)), 3) AS left_most, round(max(least({H}, greatest(0, {H / 2 - W / 2} + x2::DOUBLE))), 3) AS bottom FROM boxes GROUP BY image""")
def rotate_boxes(spark, d) -> DataFrame:
    """Boxes turned by a quarter."""
    turned = G.rotated_box(F.col("box"), w(), h(), F.lit(90.0))
    return boxes(spark, d).select("image", turned.alias("b")).groupBy("image").agg(F.count("*").alias("n"), F.round(F.min(F.col("b")[0]), 3).alias("left_most"), F.round(F.max(F.col("b")[3]), 3).alias("bottom"))
