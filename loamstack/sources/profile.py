"""Why a manifest gave rows or none: keys, the field that hit, joins that found nothing, counted in the pass that reads it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: In the order in which they are looked for; ``ok`` means that a row came out.
REASONS = ("no_field", "no_file", "no_size", "ok")


def first_field(item: Column, names: tuple[str, ...]) -> Column:
    """The first of ``names`` that is filled in a map, null if none is."""
    return F.coalesce(*[F.when(F.coalesce(F.try_element_at(item, F.lit(n)), F.lit("")) != "", F.lit(n)) for n in names])


def reason(field: Column, file: Column, width: Column) -> Column:
    """Why an item gave no row: no field names a file, the file isn't there, its size can't be read."""
    return F.when(field.isNull(), "no_field").when(file.isNull(), "no_file").when(width.isNull(), "no_size").otherwise("ok")


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` (with ``reason``) and the counts of its reasons, known once an action has run over it; no pass of their own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n_items"), *[F.count_if(F.col("reason") == r).alias(r) for r in REASONS]), seen


def profile(items: DataFrame, names: tuple[str, ...], most_keys: int = 8) -> DataFrame:
    """source, n_items, n_ok, reason, fields, keys of ``items`` (source, item map<string,string>, reason).

    reason: ``ok`` if any item gave a row, else the commonest (ties: the one that is looked for first). fields: how often each of ``names`` was
    the one that hit, as ``name=n``; keys: the ``most_keys`` commonest keys of the items (ties by name).
    """
    hit = first_field(F.col("item"), names)
    order = F.array_position(F.array(*map(F.lit, REASONS)), F.col("reason"))
    base = items.groupBy("source").agg(F.count("*").alias("n_items"), F.count_if(F.col("reason") == "ok").alias("n_ok"))
    ranked = lambda df, value: df.groupBy("source").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), F.col(value).alias("v")))).alias("x"))
    why = items.groupBy("source", "reason").agg(F.count("*").alias("n"), F.min(order).alias("place")).groupBy("source").agg(F.min_by("reason", F.struct((-F.col("n")).alias("o"), "place")).alias("_why"))
    fields = ranked(items.select("source", hit.alias("field")).filter("field IS NOT NULL").groupBy("source", "field").agg(F.count("*").alias("n")), "field")
    keys = ranked(items.select("source", F.explode(F.map_keys("item")).alias("key")).groupBy("source", "key").agg(F.count("*").alias("n")), "key")
    shown = lambda x: F.concat(x["v"], F.lit("="), (-x["o"]).cast("string"))
    named = lambda df, name, most: df.select("source", F.array_join(F.transform(F.slice("x", 1, most), shown), ",").alias(name))
    joined = base.join(why, "source", "left").join(named(fields, "fields", len(names)), "source", "left").join(named(keys, "keys", most_keys), "source", "left")
    return joined.select("source", "n_items", "n_ok", F.when(F.col("n_ok") > 0, "ok").otherwise(F.col("_why")).alias("reason"), F.coalesce("fields", F.lit("")).alias("fields"), F.coalesce("keys", F.lit("")).alias("keys"))
