"""Samples, boxes and records as projections of the driver's tables, once as DataFrames and once as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

W, H = 640, 480
TASKS = ("discrimination", "counting", "description", "classification_open", "grounding_all")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("sample_id"), F.col("lang").alias("dataset"), F.col("source").alias("category"), "text", "n_chars")
    bad = table(spark, sf_dir, "labels").filter("quality = 0 or toxic = 1").select(F.col("doc_id").alias("sample_id"), F.lit("anomalous").alias("label"))
    return docs.join(bad, "sample_id", "left").withColumn("label", F.coalesce("label", F.lit("normal"))).withColumn("commercial_ok", F.col("sample_id") % 2 == 0)


SAMPLES = """samples AS (SELECT d.doc_id AS sample_id, d.lang AS dataset, d.source AS category, d.text, d.n_chars,
    CASE WHEN l.quality = 0 OR l.toxic = 1 THEN 'anomalous' ELSE 'normal' END AS label, d.doc_id % 2 = 0 AS commercial_ok
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image, line, part, box array<bigint> on a canvas of W x H."""
    n, p, s = F.col("l_linenumber").cast("bigint"), F.col("l_partkey"), F.col("l_suppkey")
    x, y, q = p * 7 % 560, s * 37 % 420, F.col("l_quantity").cast("bigint")
    box = F.array(x, y, F.least(F.lit(W).cast("bigint"), x + 4 + q * n), F.least(F.lit(H).cast("bigint"), y + 3 + p % 17 * n))
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("image"), n.alias("line"), p.alias("part"), s.alias("supp"), box.alias("box"))


BOXES = """boxes AS (SELECT l_orderkey AS image, l_linenumber::BIGINT AS line, l_partkey AS part, l_suppkey AS supp, l_partkey * 7 % 560 AS x1, l_suppkey * 37 % 420 AS y1,
    least(640, l_partkey * 7 % 560 + 4 + l_quantity::BIGINT * l_linenumber) AS x2, least(480, l_suppkey * 37 % 420 + 3 + l_partkey % 17 * l_linenumber) AS y2 FROM lineitem)"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a user's turn and the assistant's next one."""
    turns = table(spark, sf_dir, "conversations")
    ask = turns.filter("role = 'user'").select(F.col("conv_id").alias("sample_id"), F.col("turn").alias("ord"), F.col("text").alias("question"))
    say = turns.filter("role = 'assistant'").select(F.col("conv_id").alias("sample_id"), (F.col("turn") - 1).alias("ord"), F.col("text").alias("answer"))
    task = F.get(F.array(*map(F.lit, TASKS)), ((F.col("sample_id") + F.col("ord")) % 5).cast("int"))
    status = F.when(F.col("sample_id") % 3 == 0, "normal").otherwise("anomalous")
    return ask.join(say, ["sample_id", "ord"]).withColumn("task", task).withColumn("image_status", status).withColumn(
        "qa_id", F.concat_ws("-", "sample_id", "ord")).withColumn("target_type", F.concat(F.lit("t"), (F.col("sample_id") * F.col("sample_id") % 7).cast("string")))


RECORDS = """records AS (SELECT a.conv_id AS sample_id, a.turn AS ord, a.text AS question, b.text AS answer,
    (['discrimination','counting','description','classification_open','grounding_all'])[((a.conv_id + a.turn) % 5)::INT + 1] AS task,
    CASE WHEN a.conv_id % 3 = 0 THEN 'normal' ELSE 'anomalous' END AS image_status, a.conv_id || '-' || a.turn AS qa_id, 't' || (a.conv_id * a.conv_id % 7) AS target_type
    FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn - 1 = a.turn WHERE a.role = 'user' AND b.role = 'assistant')"""


def draw(seed: int, expr: str) -> str:
    return f"(('0x' || substr(md5('{seed}:' || {expr}), 1, 8))::BIGINT)"


def order(seed: int, expr: str) -> str:
    return f"md5('{seed}:' || {expr}), {expr}"


def registered() -> tuple[dict, dict, object]:
    """Empty tables of queries and SQL, and a decorator that fills them."""
    queries, oracle = {}, {}

    def query(sql: str | None):
        def add(f):
            queries[f.__name__] = f
            if sql:
                oracle[f.__name__] = sql
            return f

        return add

    return queries, oracle, query
