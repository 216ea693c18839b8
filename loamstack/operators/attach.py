"""Joins that attach annotations and files to images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def annotations(images: DataFrame, found: DataFrame, classes: DataFrame, image: str, cls: str, fields: list[Column | str]) -> DataFrame:
    """``images`` with ``a``: their annotations of known classes as structs of ``fields`` in order, empty if there are none.

    An image's annotations form one array, as in a record, and must fit into one.
    """
    by_image = found.join(classes, cls).groupBy(image).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("a"))
    kind = by_image.schema["a"].dataType
    return images.join(by_image, image, "left").withColumn("a", F.coalesce("a", F.array().cast(kind)))


def label(annotated: Column) -> Column:
    return F.when(F.size(annotated) > 0, "anomalous").otherwise("normal")


def first_by_priority(left: DataFrame, right: DataFrame, one: str, on: str, prio: Column, tie: Column) -> DataFrame:
    """For each ``one`` of ``left`` the row of ``right`` with the least priority, then the least tie; null if none matches."""
    joined = left.join(right, on, "left").withColumn("prio", prio)
    rest = [c for c in joined.columns if c not in left.columns]
    best = F.min_by(F.struct(*rest), F.struct(F.col("prio"), tie.alias("tie")))
    return joined.groupBy(one).agg(best.alias("_best")).select(one, "_best.*")
