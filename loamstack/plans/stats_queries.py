"""Queries of statistics and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamstack.functions import text as X
from loamstack.operators import balance, stats
from loamstack.plans.sampling_queries import _RATIO, RATIO
from loamstack.plans.views import BOXES, RECORDS, SAMPLES, boxes, records, registered, samples, table
from loamstack.sources import interim

QUERIES, ORACLE_SQL, query = registered()


@query(f"""WITH {RECORDS} SELECT 'total' AS dim, '' AS value, count(*) AS n FROM records UNION ALL SELECT 'task', task, count(*) FROM records GROUP BY 2 UNION ALL SELECT 'image_status', image_status, count(*) FROM records GROUP BY 2 UNION ALL SELECT 'target_type', target_type, count(*) FROM records GROUP BY 2""")
def stats_grouping_sets(spark, d) -> DataFrame:
    return stats.grouped_counts(records(spark, d), ["task", "image_status", "target_type"])


@query(f"""WITH {RECORDS}, t AS (SELECT regexp_extract_all(answer, '[一-龥]|[A-Za-z0-9_]+') AS t FROM records), b AS (SELECT unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS b FROM t)
    SELECT count(DISTINCT b) AS n_distinct, count(*) AS n_all, round(coalesce(count(DISTINCT b)::DOUBLE / nullif(count(*), 0), 0), 4) AS ratio FROM b""")
def distinct2(spark, d) -> DataFrame:
    return stats.distinct_bigrams(records(spark, d), "answer")


@query("""WITH c AS (SELECT event_type || props AS a, count(*) AS n FROM events GROUP BY 1), t AS (SELECT sum(n) AS top FROM (SELECT n FROM c ORDER BY n DESC, a LIMIT 20))
    SELECT sum(n)::BIGINT AS n_all, count(*) AS n_distinct, round(any_value(top)::DOUBLE / sum(n), 4) AS top_share, round(count(*)::DOUBLE / sum(n), 4) AS unique_ratio FROM c, t""")
def topk_answer_share(spark, d) -> DataFrame:
    e = table(spark, d, "events").select(F.concat("event_type", "props").alias("a"))
    return stats.top_share(e, "a", 20)


@query(f"""WITH {BOXES}, c AS (SELECT o_orderkey, o_orderstatus, count(image) AS n FROM orders LEFT JOIN boxes ON image = o_orderkey GROUP BY 1, 2), x AS (SELECT count(*) FILTER (n = 0) AS neg, count(*) FILTER (n = 0 AND o_orderstatus = 'O') AS a, count(*) FILTER (n = 0 AND o_orderstatus = 'F') AS b FROM c)
    SELECT neg AS n_negative, a AS n_normal, b AS n_counterfactual, round(coalesce(a::DOUBLE / nullif(neg, 0), 0), 4) AS normal_share, round(coalesce(b::DOUBLE / nullif(neg, 0), 0), 4) AS counterfactual_share FROM x""")
def negative_breakdown(spark, d) -> DataFrame:
    n = boxes(spark, d).groupBy(F.col("image").alias("o_orderkey")).agg(F.count("*").alias("n"))
    joined = table(spark, d, "orders").join(n, "o_orderkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    status = F.when(F.col("o_orderstatus") == "O", "normal").when(F.col("o_orderstatus") == "F", "anomalous")
    return stats.negatives(joined, F.col("n"), status)


_ANSWER = "'共 ' || line || E' 处\\n[{\"bbox_2d\": [' || x1 || ', ' || y1 || ', ' || x2 * 2 || ', ' || y2 * 2 || '], \"label\": \"a\"}]'"


@query(f"""WITH {BOXES}, b AS (SELECT x1, y1, x2 * 2 AS x2, y2 * 2 AS y2 FROM boxes), e AS (SELECT count(*) AS n, count(*) FILTER (least(x1, y1, x2, y2) <= 1 OR greatest(x1, y1, x2, y2) >= 999) AS k FROM b) SELECT n AS n_boxes, k AS n_edge, round(k::DOUBLE / n, 4) AS edge_share FROM e""")
def bbox_edge(spark, d) -> DataFrame:
    """Answers are written as text and parsed back."""
    b = F.col("box")
    item = F.struct(F.array(b[0], b[1], b[2] * 2, b[3] * 2).alias("bbox"), F.lit("a").alias("label"))
    answers = boxes(spark, d).select(F.concat(F.lit("共 "), F.col("line").cast("string"), F.lit(" 处\n"), X.boxes_json(F.array(item))).alias("answer"))
    return stats.edge_boxes(answers, "answer")


@query(f"""WITH {RECORDS}, {_RATIO}, s AS (SELECT sum(w) AS w FROM r), c AS (SELECT task, count(*) AS n FROM records GROUP BY 1), a AS (SELECT count(*) AS n FROM records)
    SELECT r.task, round(r.w / s.w, 4) AS target, round(coalesce(c.n, 0)::DOUBLE / a.n, 4) AS actual, round(coalesce(c.n, 0)::DOUBLE / a.n / (r.w / s.w), 3) AS attain FROM r CROSS JOIN s CROSS JOIN a LEFT JOIN c ON c.task = r.task""")
def ratio_gap(spark, d) -> DataFrame:
    return balance.ratio_gap(records(spark, d), RATIO)


@query(f"""WITH {RECORDS} SELECT target_type, count(*) AS n FROM records WHERE task IN ('classification_open', 'counting') GROUP BY 1""")
def class_distribution(spark, d) -> DataFrame:
    return stats.class_counts(records(spark, d), ["classification_open", "counting"])


@query(f"""WITH {SAMPLES}, {BOXES}, b AS (SELECT image, count(*) AS n FROM boxes GROUP BY 1), p AS (SELECT dataset, count(*) AS n, count(*) FILTER (label = 'normal') AS n_normal, count(*) FILTER (label = 'anomalous') AS n_anomalous, count(b.n) AS with_box, coalesce(sum(b.n), 0)::BIGINT AS n_boxes, count(DISTINCT category) AS n_categories,
    min(n_chars) AS min_chars, max(n_chars) AS max_chars FROM samples LEFT JOIN b ON image = sample_id GROUP BY 1) SELECT *, CASE WHEN with_box::DOUBLE / n < 0.5 THEN 'low_box_coverage' WHEN n_anomalous = 0 THEN 'no_anomalies' ELSE 'ok' END AS alert FROM p""")
def preflight_profile(spark, d) -> DataFrame:
    b = boxes(spark, d).groupBy(F.col("image").alias("sample_id")).agg(F.count("*").alias("b"))
    p = stats.profile(samples(spark, d).join(b, "sample_id", "left"), "dataset", [
        F.count_if(F.col("label") == "normal").alias("n_normal"), F.count_if(F.col("label") == "anomalous").alias("n_anomalous"), F.count("b").alias("with_box"), F.coalesce(F.sum("b"), F.lit(0)).alias("n_boxes"),
        F.countDistinct("category").alias("n_categories"), F.min("n_chars").alias("min_chars"), F.max("n_chars").alias("max_chars")])
    return p.withColumn("alert", F.when(F.col("with_box") / F.col("n") < 0.5, "low_box_coverage").when(F.col("n_anomalous") == 0, "no_anomalies").otherwise("ok"))


@query("""WITH c AS (SELECT event_type, regexp_extract(props, '"k":\\s*(\\d+)', 1)::INT AS k FROM events), r AS (SELECT event_type, count(*) AS n, count(*) FILTER (k % 5 <> 0) AS accepted, min(k) AS shortest, list_sort(list(k))[(count(*) // 2)::INT + 1] AS median, max(k) AS longest FROM c GROUP BY 1)
    SELECT event_type, n, accepted, round(accepted::DOUBLE / n, 4) AS rate, shortest, median, longest, CASE WHEN accepted::DOUBLE / n >= 0.8 THEN 'healthy' WHEN accepted::DOUBLE / n >= 0.6 THEN 'warn' ELSE 'stop' END AS verdict FROM r""")
def cache_report(spark, d) -> DataFrame:
    """Acceptance by model."""
    k = F.from_json("props", "struct<k:int>")["k"]
    return stats.acceptance(table(spark, d, "events"), "event_type", k % 5 != 0, k)


@query(f"""WITH {SAMPLES}, t AS (SELECT dataset, category, count(*) AS n FROM samples WHERE label = 'anomalous' GROUP BY 1, 2), l AS (SELECT dataset, string_agg(category || '=' || n, ',' ORDER BY category) AS types FROM t GROUP BY 1)
    SELECT s.dataset, count(*) AS n, count(*) FILTER (label = 'normal') AS normal, count(*) FILTER (label = 'anomalous') AS anomalous, coalesce(any_value(types), '') AS types FROM samples s LEFT JOIN l USING (dataset) GROUP BY 1""")
def ingest_summary(spark, d) -> DataFrame:
    """Samples by source and label, and how many show each type: the category of the anomalous ones stands for it, twice."""
    one = F.struct(F.col("category").alias("type"))
    s = samples(spark, d).withColumn("defects", F.when(F.col("label") == "anomalous", F.array(one, one)).otherwise(F.array().cast("array<struct<type:string>>")))
    return interim.summary(s)


@query(f"""WITH {RECORDS}, t AS (SELECT task, count(*) AS n, count(DISTINCT question) AS q FROM records GROUP BY 1) SELECT task, q AS n_questions, CASE WHEN q < 45 THEN 'few_questions' WHEN n < 50 THEN 'few_records' END AS warning FROM t WHERE q < 45 OR n < 50""")
def build_warnings(spark, d) -> DataFrame:
    return stats.thin_tasks(records(spark, d), 45, 50)


@query("""WITH m AS (SELECT p_brand, p_size AS grade, avg(p_retailprice) AS price FROM part GROUP BY 1, 2), l AS (SELECT *, lag(price) OVER (PARTITION BY p_brand ORDER BY grade) AS before FROM m),
    k AS (SELECT p_brand, count(*) FILTER (price > before) AS up, count(*) FILTER (before IS NOT NULL) AS steps FROM l GROUP BY 1)
    SELECT *, CASE WHEN 5 * up >= 4 * steps THEN 'ok' WHEN 5 * up <= steps THEN 'reversed' ELSE 'unclear' END AS verdict FROM k""")
def grade_monotonicity(spark, d) -> DataFrame:
    """Whether a mean rises from grade to grade."""
    return stats.monotonicity(table(spark, d, "part"), "p_brand", "p_size", "p_retailprice")


@query("""SELECT p_type, count(*) AS n, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey) FILTER (r <= 3) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS r FROM part) GROUP BY 1""")
def raw_class_preview(spark, d) -> DataFrame:
    return stats.examples(table(spark, d, "part"), "p_type", "p_partkey")
