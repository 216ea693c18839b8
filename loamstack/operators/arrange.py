"""Photos and masks that lie in directories of unknown meaning: which directories hold masks, and which mask belongs to a photo.

Files are rows of directory and name. A null directory or name counts as empty; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Gray levels up to which a picture can be a mask, endings of mask names, directory names of the two splits.
MASK_LEVELS = 16
MASK_ENDINGS = ("_mask", "_gt", "_label", "_seg", "_annot", "_annotation", "-mask", "-gt", "-label")
TRAIN = ("train", "training")
TEST = ("test", "testing", "val", "valid", "validation")


def stem_key(name: Column) -> Column:
    """The name without its extension and without one ending of masks, in any case."""
    stem = F.regexp_replace(F.coalesce(name, F.lit("")), r"(?<=[^.])\.[^.]*$", "")
    return F.regexp_replace(stem, f"(?i)({'|'.join(sorted(MASK_ENDINGS, key=len, reverse=True))})$", "")


def split_of(directory: Column) -> Column:
    """train or test by the first part of the path that says so, else all."""
    parts = F.filter(F.split(F.lower(F.coalesce(directory, F.lit(""))), "/"), lambda p: p.isin(*TRAIN, *TEST))
    first = F.get(parts, 0)
    return F.when(first.isin(*TRAIN), "train").when(first.isNotNull(), "test").otherwise("all")


def kinds(files: DataFrame) -> DataFrame:
    """directory, kind: mask or photo, by the votes of all its files (directory, name, levels); a tie goes to the first name.

    Every file votes, so that no ranking inside a directory is needed; unreadable files (levels null) vote for photo.
    """
    vote = F.when(F.col("levels") <= MASK_LEVELS, 1).otherwise(-1)
    counted = files.select(F.coalesce("directory", F.lit("")).alias("directory"), F.coalesce("name", F.lit("")).alias("name"), vote.alias("v"))
    found = counted.groupBy("directory").agg(F.sum("v").alias("n"), F.min(F.struct("name", "v")).alias("first"))
    return found.select("directory", F.when((F.col("n") > 0) | ((F.col("n") == 0) & (F.col("first.v") > 0)), "mask").otherwise("photo").alias("kind"))


def paired(photos: DataFrame, masks: DataFrame) -> DataFrame:
    """split, directory, name, stem, mask of each photo; mask is null for orphans.

    A photo takes masks of its split, or of all splits if its own has none; of several with its stem the first by path.
    """
    shape = lambda df: df.select(split_of(F.col("directory")).alias("split"), F.coalesce("directory", F.lit("")).alias("directory"), F.coalesce("name", F.lit("")).alias("name"), stem_key(F.col("name")).alias("stem"))
    found = shape(masks).select("stem", F.explode(F.array("split", F.lit("*"))).alias("pool"), F.struct("directory", "name").alias("at"))
    index = found.groupBy("pool", "stem").agg(F.min("at").alias("at"))
    held = index.select(F.col("pool").alias("split")).distinct()  # three splits at most
    asked = shape(photos).join(F.broadcast(held.withColumn("_own", F.lit(True))), "split", "left").withColumn("pool", F.when(F.col("_own"), F.col("split")).otherwise("*"))
    return asked.join(index, ["pool", "stem"], "left").select("split", "directory", "name", "stem", F.concat_ws("/", "at.directory", "at.name").alias("_path"), "at").select(
        "split", "directory", "name", "stem", F.when(F.col("at").isNotNull(), F.col("_path")).alias("mask"))
