"""Deduplication, group-wise splits and leak checks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamstack.functions.draws import number

RATIOS = (0.95, 0.03, 0.02)


def dedup_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key: a min over a struct, so that copies are combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(first.alias("_first")).select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def dedup_rare(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """``dedup_first`` for a table in which few keys repeat: only rows whose key's hash comes again are grouped, the others stay where they are. Reads ``df`` three times."""
    hashed = F.xxhash64(*keys).alias("_hash")
    again = written(df.select(hashed).groupBy("_hash").count().filter("count > 1").select("_hash"), "again")
    marked = df.select("*", hashed)
    few = dedup_first(marked.join(again, "_hash", "left_semi").drop("_hash"), keys, order)
    return marked.join(again, "_hash", "left_anti").drop("_hash").unionByName(few)


def split_of(draw: Column, ratios: tuple = RATIOS) -> Column:
    p = (draw % 10000) / F.lit(10000.0)
    return F.when(p < ratios[0], "train").when(p < ratios[0] + ratios[1], "val").otherwise("test")


def split_by(df: DataFrame, col: str, seed: int = 0, ratios: tuple = RATIOS) -> DataFrame:
    return df.withColumn("split", split_of(number(seed, F.concat(F.lit("sid:"), F.col(col).cast("string"))), ratios))


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared checkpoint folder.

    A local session that names no folder gets one of its own below /tmp; elsewhere the setting is needed.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file:///tmp/checkpoints/loamstack"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Through a table in the shared checkpoint folder: cuts the lineage and outlives a lost executor."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """member, root (the least member of its component) for rows of (member, hub) strings.

    Labels go to hubs and back, a minimum each way, then each label jumps to its own label.
    """
    edges = written(edges.select("member", "hub").distinct(), "edges")
    labels = written(edges.select("member").distinct().withColumn("root", F.col("member")), "roots")
    while True:
        hubs = edges.join(labels, "member").groupBy("hub").agg(F.min("root").alias("root"))
        near = edges.join(hubs, "hub").groupBy("member").agg(F.min("root").alias("near"))
        step = written(near.join(labels, "member"), "near")
        jump = step.select(F.col("member").alias("near"), F.col("near").alias("far"))
        new = written(step.join(jump, "near", "left").select("member", F.col("root").alias("old"), F.least("near", F.coalesce("far", "near")).alias("root")), "roots")
        if new.filter("root <> old").limit(1).count() == 0:
            return new.select("member", "root")
        labels = new.select("member", "root")


def split_groups(df: DataFrame, id_col: str, hub_col: str, seed: int = 0, ratios: tuple = RATIOS) -> DataFrame:
    """Rows linked by an id or a hub (such as an image) fall into one split. Only hubs of two ids or more can link."""
    member = F.concat(F.lit("sid:"), F.col(id_col).cast("string"))
    edges = df.filter(F.col(hub_col).isNotNull()).select(member.alias("member"), F.col(hub_col).cast("string").alias("hub")).distinct()
    linking = edges.groupBy("hub").count().filter("count > 1").select("hub")
    roots = components(edges.join(linking, "hub"))
    joined = df.withColumn("_member", member).join(roots, F.col("_member") == F.col("member"), "left")
    root = F.coalesce("root", "_member")
    return joined.select(*df.columns, root.alias("root"), split_of(number(seed, root), ratios).alias("split"))


def leaks(df: DataFrame, hub_col: str) -> DataFrame:
    """Hubs that lie in several splits, with the splits."""
    return df.groupBy(hub_col).agg(F.array_join(F.array_sort(F.collect_set("split")), ",").alias("splits"), F.countDistinct("split").alias("n")).filter("n > 1").select(hub_col, "splits")


def merge_over(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``new`` and the rows of ``old`` whose key it lacks."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def without(df: DataFrame, other: DataFrame, col: str) -> DataFrame:
    """``df`` without rows whose ``col`` is in ``other``, as benchmark items are kept out of training data."""
    return df.join(other.select(col).distinct(), col, "left_anti")


def rank_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in any order; for keys of many rows dedup_first spares the sort."""
    return df.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_r = 1").drop("_r")
