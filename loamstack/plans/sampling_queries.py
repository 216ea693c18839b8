"""Queries of balancing, quotas and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamstack.functions import draws
from loamstack.operators import balance, split
from loamstack.plans.views import RECORDS, SAMPLES, order, records, registered, samples

QUERIES, ORACLE_SQL, query = registered()

RATIO = {"discrimination": 0.3, "counting": 0.1, "description": 0.25, "classification_open": 0.2, "grounding_all": 0.15, "absent_task": 0.2}
_RATIO = "r AS (SELECT * FROM (VALUES " + ", ".join(f"('{t}', {v}::DOUBLE)" for t, v in RATIO.items()) + ") v(task, w))"
_ORD = order(0, "sample_id")


@query(f"""WITH {SAMPLES}, n AS (SELECT count(*) AS n FROM samples WHERE label = 'anomalous') SELECT sample_id, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_ORD}) AS r FROM samples), n WHERE label = 'anomalous' OR r <= floor(n.n * 1.5)""")
def label_balance(spark, d) -> DataFrame:
    return balance.balance_labels(samples(spark, d), 1.5).select("sample_id", "label")


@query(f"""WITH {SAMPLES}, w AS (SELECT * FROM (VALUES ('en', 0.5::DOUBLE), ('fr', 1.0::DOUBLE), ('de', 2.3::DOUBLE), ('es', 0.0::DOUBLE)) v(dataset, w)), c AS (SELECT dataset, count(*) AS n FROM samples GROUP BY 1),
    t AS (SELECT c.dataset, n, round_even(n * coalesce(w, 1), 0)::BIGINT AS want FROM c LEFT JOIN w USING (dataset)), k AS (SELECT s.sample_id, s.dataset, row_number() OVER (PARTITION BY s.dataset ORDER BY {order(0, 's.sample_id')}) AS r, n, want FROM samples s JOIN t USING (dataset))
    SELECT dataset, sample_id, g::INT AS copy FROM k, range(0, 10) x(g) WHERE r + g * n <= want""")
def source_weights(spark, d) -> DataFrame:
    return balance.weigh_sources(samples(spark, d), {"en": 0.5, "fr": 1.0, "de": 2.3, "es": 0.0}).select("dataset", "sample_id", "copy")


@query(f"""WITH {SAMPLES}, sizes AS (SELECT dataset, count(*) AS n FROM samples GROUP BY 1), lv AS (SELECT max(l) AS level FROM (SELECT g.l, least(any_value(m.m), g.l) AS top, sum(least(n, g.l)) AS total FROM sizes, (SELECT max(n) AS m FROM sizes) m, range(1, 100001) g(l) WHERE g.l <= m.m GROUP BY g.l) WHERE top <= 0.4::DOUBLE * total + 1e-9),
    ds AS (SELECT s.dataset, s.n, count(*) FILTER (label = 'anomalous') AS anom, any_value(level) AS level FROM sizes s JOIN samples USING (dataset), lv GROUP BY 1, 2),
    take AS (SELECT dataset, CASE WHEN n <= level THEN anom ELSE round_even(level * (anom::DOUBLE / n), 0)::BIGINT END AS ta, CASE WHEN n <= level THEN n - anom ELSE level - round_even(level * (anom::DOUBLE / n), 0)::BIGINT END AS tn FROM ds)
    SELECT sample_id, dataset, label FROM (SELECT s.*, row_number() OVER (PARTITION BY s.dataset, s.label ORDER BY {order(0, 's.sample_id')}) AS r, CASE s.label WHEN 'anomalous' THEN ta ELSE tn END AS t FROM samples s JOIN take USING (dataset)) WHERE r <= t""")
def source_share_cap(spark, d) -> DataFrame:
    return balance.cap_source_share(samples(spark, d), 0.4).select("sample_id", "dataset", "label")


_MINE = "task IN ('classification_open', 'counting')"


@query(f"""WITH {RECORDS}, p AS (SELECT * FROM records WHERE {_MINE}), c AS (SELECT target_type, count(*) AS n FROM p GROUP BY 1), m AS (SELECT list_sort(list(n))[(count(*) // 2)::INT + 1] AS mid FROM c),
    b AS (SELECT greatest(1, floor(mid * 1.5))::BIGINT AS cap, greatest(1, floor(floor(mid * 1.5) / 1.5))::BIGINT AS low FROM m), t AS (SELECT target_type, n, least(cap, greatest(n, least(low, floor(n * 3.0)::BIGINT))) AS want FROM c, b),
    k AS (SELECT p.qa_id, p.task, p.target_type, n, want, row_number() OVER (PARTITION BY p.target_type ORDER BY {order(0, 'p.qa_id')}) AS r FROM p JOIN t USING (target_type))
    SELECT CASE WHEN g = 0 THEN qa_id ELSE qa_id || '#os' || g END AS qa_id, task, target_type, g > 0 AS oversampled FROM k, range(0, 5) x(g) WHERE r + g * n <= want
    UNION ALL SELECT qa_id, task, target_type, false FROM records WHERE NOT {_MINE}""")
def class_cap_oversample(spark, d) -> DataFrame:
    r = records(spark, d).select("qa_id", "task", "target_type")
    return balance.cap_classes(r, ["classification_open", "counting"], 1.5)


_SIZES = f"WITH {RECORDS}, {_RATIO}, s AS (SELECT task, count(*) AS n FROM records GROUP BY 1), c AS (SELECT task, n, w, w / sum(w) OVER () AS share FROM s JOIN r USING (task))"


@query(f"""{_SIZES}, q AS (SELECT *, sum(share) OVER (ORDER BY n / share, share) AS run FROM c) SELECT floor(min(n / share))::BIGINT AS total FROM q WHERE run >= 0.6::DOUBLE - 1e-9""")
def auto_total(spark, d) -> DataFrame:
    sizes = balance.counts(records(spark, d), "task")
    return spark.createDataFrame([(balance.auto_total(sizes, RATIO),)], "total long")


@query(f"""{_SIZES} SELECT floor(min(n / share))::BIGINT AS total FROM c""")
def ratio_strict_total(spark, d) -> DataFrame:
    sizes = balance.counts(records(spark, d), "task")
    return spark.createDataFrame([(balance.strict_total(sizes, RATIO),)], "total long")


def _round(i: int, before: str) -> str:
    """One round of the quota as SQL: rows still open share what is left."""
    return f"""q{i} AS (SELECT task, n, w, open AND n - got > want AS open, got + least(want, n - got) * open::INT AS got, left_ - sum(least(want, n - got) * open::INT) OVER () AS left_ FROM
        (SELECT *, CASE WHEN open AND left_ > 0 THEN round_even(left_ * w / sum(w) FILTER (open) OVER (), 0)::BIGINT ELSE 0 END AS want FROM {before}))"""


@query(f"""WITH {RECORDS}, {_RATIO}, q0 AS (SELECT task, count(*) AS n, any_value(w) AS w, true AS open, 0::BIGINT AS got, 160::HUGEINT AS left_ FROM records JOIN r USING (task) GROUP BY 1),
    {_round(1, 'q0')}, {_round(2, 'q1')}, {_round(3, 'q2')}, {_round(4, 'q3')}
    SELECT qa_id, task FROM (SELECT x.qa_id, x.task, got, row_number() OVER (PARTITION BY x.task ORDER BY {order(0, 'x.qa_id')}) AS r FROM records x JOIN q4 USING (task)) WHERE r <= got""")
def quota_sample(spark, d) -> DataFrame:
    return balance.quota_sample(records(spark, d), RATIO, 160).select("qa_id", "task")


@query(f"""WITH {SAMPLES}, {RECORDS}, n AS (SELECT floor(count(*) * 0.4::DOUBLE / (1 - 0.4::DOUBLE))::BIGINT AS want FROM records), p AS (SELECT sample_id::VARCHAR AS qa_id FROM samples WHERE dataset = 'es'),
    g AS (SELECT unnest(range(0, (SELECT want FROM n) // (SELECT count(*) FROM p) + 1)) AS g), c AS (SELECT p.qa_id, g, row_number() OVER (ORDER BY g, {order(0, 'p.qa_id')}) AS r FROM p, g)
    SELECT qa_id, 'train' AS origin FROM records UNION ALL SELECT qa_id, 'general' FROM c, n WHERE r <= want""")
def mix_general(spark, d) -> DataFrame:
    pool = samples(spark, d).filter("dataset = 'es'").select(F.col("sample_id").cast("string").alias("qa_id"), F.lit("general").alias("origin"))
    return balance.mix_general(records(spark, d).select("qa_id", F.lit("train").alias("origin")), pool, 0.4)


@query(f"""WITH {SAMPLES} SELECT dataset, sample_id FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY {order(7, 'sample_id')}) AS r FROM samples) WHERE r <= 25""")
def reservoir_per_source(spark, d) -> DataFrame:
    return draws.top_per_stratum(samples(spark, d), ["dataset"], 25, 7, F.col("sample_id")).select("dataset", "sample_id")


@query(f"""WITH {RECORDS} SELECT task, qa_id FROM (SELECT *, row_number() OVER (PARTITION BY task ORDER BY (image_status = 'anomalous') DESC, {order(3, 'qa_id')}) AS r FROM records) WHERE r = 1""")
def preview_one_per_task(spark, d) -> DataFrame:
    first = [F.col("image_status") != "anomalous", draws.key(3, F.col("qa_id")), "qa_id"]
    return split.dedup_first(records(spark, d), ["task"], first).select("task", "qa_id")


@query(f"""WITH {RECORDS}, n AS (SELECT greatest(1, 30 // count(DISTINCT task)) AS per FROM records) SELECT task, qa_id FROM (SELECT task, qa_id, row_number() OVER (ORDER BY r, task) AS k FROM (SELECT *, row_number() OVER (PARTITION BY task ORDER BY {order(1, 'qa_id')}) AS r FROM records), n WHERE r <= per) WHERE k <= 30""")
def smoke_sample(spark, d) -> DataFrame:
    """At most 30 records, spread evenly over tasks."""
    from pyspark.sql import Window as W

    r = records(spark, d)
    per = max(1, 30 // max(1, r.select("task").distinct().count()))
    some = draws.top_per_stratum(r, ["task"], per, 1, F.col("qa_id"))
    place = F.row_number().over(W.partitionBy("task").orderBy(draws.key(1, F.col("qa_id")), "qa_id"))
    return some.withColumn("_p", place).orderBy("_p", "task").limit(30).select("task", "qa_id")
