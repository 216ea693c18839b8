"""Deterministic draws: a number of 32 bits from the MD5 of a seed and keys, the same in any engine and partitioning."""

from __future__ import annotations

from functools import reduce
from math import ceil
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def key(seed: int | str, *cols: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols]).cast("binary"))


def number(seed: int | str, *cols: Column) -> Column:
    """0 to 2**32 - 1."""
    return F.conv(F.substring(key(seed, *cols), 1, 8), 16, 10).cast("bigint")


def uniform(seed: int | str, *cols: Column) -> Column:
    return number(seed, *cols) / F.lit(float(1 << 32))


def below(share: float, seed: int | str, *cols: Column) -> Column:
    """Whether ``uniform`` is below a share, told by the digits without making a number of them."""
    least = ceil(share * (1 << 32))
    return F.lit(least > 0) if least <= 0 or least >= 1 << 32 else F.substring(key(seed, *cols), 1, 8) < f"{least:08x}"


def pick(values: Column, seed: int | str, *cols: Column) -> Column:
    """One element of an array, null if it is empty."""
    return F.get(values, F.try_mod(number(seed, *cols), F.size(values).cast("bigint")).cast("int"))


#: Hex digits of a draw by which rows are counted, and rows up to which a table of strata is sent to all.
PREFIX, MOST_SENT = 4, 10_000


def mark_first(df: DataFrame, strata: list[str], takes: DataFrame, seed: int | str, *ids: Column) -> DataFrame:
    """``df`` with ``_first``: whether a row is among the first ``_take`` of its stratum in the order of draws, then ids.

    ``takes`` has a row for each stratum (its columns and ``_take``); strata without one have no first rows. Draws are
    uniform, so rows are counted by stratum and the first digits of their draws. That tells the digits at which the take is
    reached; only the rows with just these digits (a 65536th part of a stratum) are ranked, to find the last draw that is in.
    The rows themselves are then compared with that draw where they are: no task sees a whole stratum, and none moves.
    Rows of one stratum with the same ids are in or out together.
    """
    spark = df.sparkSession
    place = F.struct(key(seed, *ids).alias("k"), *[c.alias(f"i{n}") for n, c in enumerate(ids)])
    own = df.select(*[F.col(c).alias("_" + c) for c in strata], place.alias("_place")).withColumn("_prefix", F.substring("_place.k", 1, PREFIX))
    names = ["_" + c for c in strata]
    takes = takes.withColumnsRenamed(dict(zip(strata, names, strict=True)))
    same = lambda a, b: reduce(and_, [a[c].eqNullSafe(b[d]) for c, d in zip(names, ["t" + c for c in names], strict=True)])
    keyed = lambda t: t.withColumnsRenamed({c: "t" + c for c in names})
    before = F.coalesce(F.sum("_n").over(W.partitionBy(*names).orderBy("_prefix").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranges = own.groupBy(*names, "_prefix").agg(F.count("*").alias("_n")).withColumn("_before", before)
    asked = keyed(takes)
    reached = ranges.join(asked, same(ranges, asked)).filter((F.col("_before") < F.col("_take")) & (F.col("_before") + F.col("_n") >= F.col("_take")))
    edges = _sent(keyed(reached.select(*names, F.col("_prefix").alias("_edge"), (F.col("_take") - F.col("_before")).alias("_rest"))))
    edge = own.join(edges, same(own, edges) & (F.col("_prefix") == F.col("_edge")))
    rank = F.row_number().over(W.partitionBy(*names, "_prefix").orderBy("_place"))
    cuts = edge.withColumn("_r", rank).filter(F.col("_r") == F.col("_rest")).select(*names, F.col("_place").alias("_last"))
    last = _sent(keyed(cuts))
    limits = takes.join(last, same(takes, last), "left").select(*["_" + c for c in strata], "_take", "_last")
    limits = _sent(keyed(limits))
    on = reduce(and_, [df[c].eqNullSafe(limits["t_" + c]) for c in strata])
    first = F.when(F.coalesce("_take", F.lit(0)) <= 0, False).when(F.col("_last").isNull(), True).otherwise(place <= F.col("_last"))
    return df.join(limits, on, "left").select(*[df[c] for c in df.columns], first.alias("_first"))


def _sent(table: DataFrame) -> DataFrame:
    """A table of strata, worked out once and sent to all tasks if it is small."""
    found = table.limit(MOST_SENT + 1).collect()
    return F.broadcast(table.sparkSession.createDataFrame(found, table.schema)) if len(found) <= MOST_SENT else table


def top_per_stratum(df: DataFrame, strata: list[str], n: int, seed: int | str, *ids: Column) -> DataFrame:
    """At most n rows of each stratum, in the order of their draws. Up to 1000 the planner trims each stratum before the shuffle."""
    if n > 1000:
        takes = df.select(*strata).distinct().withColumn("_take", F.lit(n).cast("long"))
        return mark_first(df, strata, takes, seed, *ids).filter("_first").drop("_first")
    order = W.partitionBy(*strata).orderBy(key(seed, *ids), *ids)
    return df.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= n).drop("_r")
