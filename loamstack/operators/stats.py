"""Statistics of samples and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamstack.functions.text import bigrams, tokens


def grouped_counts(df: DataFrame, dims: list[str]) -> DataFrame:
    """dim, value, n of several columns in one pass, and the whole as dim ``total``."""
    pairs = F.array(F.struct(F.lit("total").alias("dim"), F.lit("").alias("value")), *[F.struct(F.lit(d).alias("dim"), F.coalesce(F.col(d).cast("string"), F.lit("")).alias("value")) for d in dims])
    return df.select(F.explode(pairs).alias("p")).groupBy("p.dim", "p.value").agg(F.count("*").alias("n"))


def distinct_bigrams(df: DataFrame, col: str) -> DataFrame:
    """Distinct over all neighbouring tokens, 4 digits, 0 without any."""
    pairs = df.select(tokens(F.col(col)).alias("_t")).select(F.explode(bigrams(F.col("_t"))).alias("b")).groupBy("b").agg(F.count("*").alias("n"))
    return pairs.agg(F.count("*").alias("n_distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_all")).withColumn(
        "ratio", F.round(F.coalesce(F.try_divide("n_distinct", "n_all"), F.lit(0.0)), 4))


def top_share(df: DataFrame, col: str, k: int = 20) -> DataFrame:
    """Rows of the k most frequent values over all rows, and distinct over all."""
    found = df.groupBy(col).agg(F.count("*").alias("n"))
    top = found.orderBy(F.desc("n"), col).limit(k).agg(F.sum("n").alias("top"))
    whole = found.agg(F.sum("n").alias("n_all"), F.count("*").alias("n_distinct"))
    return whole.crossJoin(F.broadcast(top)).select("n_all", "n_distinct", F.round(F.col("top") / F.col("n_all"), 4).alias("top_share"), F.round(F.col("n_distinct") / F.col("n_all"), 4).alias("unique_ratio"))


def negatives(df: DataFrame, n_boxes: Column, status: Column) -> DataFrame:
    empty = n_boxes == 0
    n = F.count_if(empty)
    part = lambda c: F.count_if(empty & c)
    share = lambda x: F.round(F.coalesce(F.try_divide(x, n), F.lit(0.0)), 4)
    return df.agg(n.alias("n_negative"), part(status == "normal").alias("n_normal"), part(status == "anomalous").alias("n_counterfactual"),
                  share(part(status == "normal")).alias("normal_share"), share(part(status == "anomalous")).alias("counterfactual_share"))


BOXES = "array<struct<bbox_2d:array<int>,label:string>>"


def edge_boxes(df: DataFrame, answer: str) -> DataFrame:
    """How many boxes of JSON answers touch the edge of the 0 to 1000 frame."""
    boxes = df.select(F.explode(F.from_json(F.regexp_extract(answer, r"(?s)\[.*\]", 0), BOXES)).alias("b")).filter("size(b.bbox_2d) = 4")
    touches = (F.array_min("b.bbox_2d") <= 1) | (F.array_max("b.bbox_2d") >= 999)
    return boxes.agg(F.count("*").alias("n_boxes"), F.count_if(touches).alias("n_edge"), F.round(F.coalesce(F.try_divide(F.count_if(touches), F.count("*")), F.lit(0.0)), 4).alias("edge_share"))


def profile(df: DataFrame, by: str, aggs: list[Column]) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n"), *aggs)


def upper_median(values: Column) -> Column:
    """The element at place n // 2 of the sorted values."""
    return F.get(F.array_sort(values), F.floor(F.size(values) / 2).cast("int"))


def class_counts(df: DataFrame, tasks: list[str], col: str = "target_type") -> DataFrame:
    """Rows of each class in ``tasks``."""
    return df.filter(F.col("task").isin(tasks)).groupBy(col).agg(F.count("*").alias("n"))


def acceptance(df: DataFrame, by: str, accepted: Column, size: Column, good: float = 0.8, poor: float = 0.6) -> DataFrame:
    """Share of accepted rows, sizes and a verdict for each value of ``by``.

    The upper median comes from counts of values, not from a collected group.
    """
    e = df.select(by, accepted.alias("ok"), size.alias("k"))
    sums = e.groupBy(by).agg(F.count("*").alias("n"), F.count_if("ok").alias("accepted"), F.min("k").alias("shortest"), F.max("k").alias("longest"))
    run = F.sum("c").over(W.partitionBy(by).orderBy("k").rowsBetween(W.unboundedPreceding, 0))
    counted = e.groupBy(by, "k").agg(F.count("*").alias("c")).withColumn("run", run)
    middle = counted.join(sums.select(by, "n"), by).filter(F.col("run") > F.floor(F.col("n") / 2)).groupBy(by).agg(F.min("k").alias("median"))
    rate = F.col("accepted") / F.col("n")
    return sums.join(middle, by).select(by, "n", "accepted", F.round(rate, 4).alias("rate"), "shortest", "median", "longest", F.when(rate >= good, "healthy").when(rate >= poor, "warn").otherwise("stop").alias("verdict"))


def thin_tasks(df: DataFrame, least_questions: int, least_records: int) -> DataFrame:
    """Tasks with too few different questions, or too few records."""
    t = df.groupBy("task").agg(F.count("*").alias("n"), F.countDistinct("question").alias("n_questions"))
    few = F.col("n_questions") < least_questions
    return t.filter(few | (F.col("n") < least_records)).select("task", "n_questions", F.when(few, "few_questions").otherwise("few_records").alias("warning"))


def monotonicity(df: DataFrame, by: str, grade: str, value: str) -> DataFrame:
    """Whether the mean of ``value`` rises from grade to grade: in four fifths of the steps, in a fifth, or between."""
    m = df.groupBy(by, F.col(grade).alias("_grade")).agg(F.avg(value).alias("_mean"))
    steps = m.withColumn("_before", F.lag("_mean").over(W.partitionBy(by).orderBy("_grade")))
    up, n = F.count_if(F.col("_mean") > F.col("_before")), F.count("_before")
    return steps.groupBy(by).agg(up.alias("up"), n.alias("steps"), F.when(5 * up >= 4 * n, "ok").when(5 * up <= n, "reversed").otherwise("unclear").alias("verdict"))


def examples(df: DataFrame, by: str, value: str, k: int = 3) -> DataFrame:
    """How many rows each value of ``by`` has, and its ``k`` least values of another column."""
    ranked = df.withColumn("_r", F.row_number().over(W.partitionBy(by).orderBy(value))).filter(F.col("_r") <= k)
    first = ranked.groupBy(by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(value)), lambda x: x.cast("string")), ",").alias("examples"))
    return df.groupBy(by).agg(F.count("*").alias("n")).join(first, by)
