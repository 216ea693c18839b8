"""The interim store of samples between reading and generation: JSON lines by dataset, with the summary of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write(samples: DataFrame, root: str) -> None:
    """``samples`` (dataset and others) as JSON lines in a folder for each dataset, so that a choice of datasets reads only theirs."""
    samples.write.partitionBy("dataset").mode("overwrite").json(root)


def read(spark: SparkSession, root: str, schema: str, only: list[str] | None = None, commercial: bool = False, categories: list[str] | None = None) -> DataFrame:
    """Samples of the datasets in ``only`` (all if none are named), if asked for only those with ``commercial_ok``, and of ``categories``.

    Files whose names begin with "_" are passed over, torn lines dropped. The choice of datasets reaches the listing of folders.
    """
    rows = spark.read.schema(f"{schema}, dataset string, _torn string").option("columnNameOfCorruptRecord", "_torn").json(root).filter("_torn IS NULL").drop("_torn")
    rows = rows.filter(F.col("dataset").isin(*only)) if only else rows
    rows = rows.filter(F.coalesce("commercial_ok", F.lit(False))) if commercial else rows
    return rows.filter(F.col("category").isin(*categories)) if categories is not None else rows


def union(*parts: DataFrame) -> DataFrame:
    """Samples or records of several sources; columns that one lacks are null there."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def summary(samples: DataFrame) -> DataFrame:
    """dataset, n, normal, anomalous, types (``type=n`` by name): samples (dataset, label, defects) of a run; a type counts once for each sample."""
    base = samples.groupBy("dataset").agg(F.count("*").alias("n"), F.count_if(F.col("label") == "normal").alias("normal"), F.count_if(F.col("label") == "anomalous").alias("anomalous"))
    kinds = samples.select("dataset", F.explode(F.array_distinct(F.transform("defects", lambda d: d["type"]))).alias("type")).groupBy("dataset", "type").agg(F.count("*").alias("n"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("type", "n"))), lambda x: F.concat(x["type"], F.lit("="), x["n"].cast("string"))), ",")
    return base.join(kinds.groupBy("dataset").agg(listed.alias("types")), "dataset", "left").select("dataset", "n", "normal", "anomalous", F.coalesce("types", F.lit("")).alias("types"))
