"""How pixels look under each class of graded masks, and whether the classes' order is one of rising severity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

_SUMS = ("redness", "brightness", "saturation", "roughness")
_PARTS = "cls int, px long, imgs long, " + ", ".join(f"{s} double" for s in _SUMS)
#: What should rise (1) or fall (-1) from class to class, and how many of these speak for or against the order.
CHECKS = {"redness": 1, "brightness": -1, "roughness": 1, "px": -1, "imgs": -1}
FOR, AGAINST = 4, 1


def appearance(pixels: np.ndarray, width: int) -> np.ndarray:
    """Redness, brightness, saturation and roughness (differences to the left and upper neighbour) of 0xRRGGBB pixels."""
    rgb = np.stack([pixels >> 16 & 255, pixels >> 8 & 255, pixels & 255]).astype(np.float64)
    r, g, b = rgb
    grey = 0.299 * r + 0.587 * g + 0.114 * b
    plane, most = grey.reshape(-1, width), rgb.max(0)
    rough = np.zeros_like(plane)
    rough[:, 1:] += np.abs(np.diff(plane, axis=1))
    rough[1:] += np.abs(np.diff(plane, axis=0))
    return np.stack([(r - b) / (r + b + 1), grey, (most - rgb.min(0)) / (most + 1), rough.ravel()])


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by class over all images of a task."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for width, pixels, mask in zip(b.column("width"), b.column("pixels"), b.column("mask"), strict=True):
            if not (width.as_py() and pixels.is_valid and mask.is_valid) or len(pixels) != len(mask) or not len(pixels) or len(pixels) % width.as_py() or pixels.values.null_count or mask.values.null_count:
                continue
            cls, place = np.unique(np.asarray(mask.values), return_inverse=True)
            n = np.bincount(place, minlength=len(cls))
            sums = [np.bincount(place, x, len(cls)) for x in appearance(np.asarray(pixels.values).astype(np.int64), width.as_py())]
            for i, c in enumerate(cls.tolist()):
                total[c] = total.get(c, 0) + np.array([n[i], 1, *(s[i] for s in sums)], np.float64)
    columns = [pa.array(list(total), pa.int32()), *(pa.array([int(v[k]) for v in total.values()], pa.int64()) for k in (0, 1)), *(pa.array([v[k] for v in total.values()], pa.float64()) for k in range(2, 6))]
    yield pa.RecordBatch.from_arrays(columns, names=["cls", "px", "imgs", *_SUMS])


#: Beyond this many values a mask is no map of classes.
MOST_CLASSES = 12


def mask_values(masks: DataFrame) -> DataFrame:
    """value, px, imgs, share (of all pixels) of ``masks`` (values: the classes of a mask's pixels, array<int>), by expressions only.

    A mask is reduced to a row for each of its values before the shuffle; null masks and null pixels don't count.
    """
    kinds = F.transform(F.array_distinct("values"), lambda v: F.struct(v.alias("value"), F.size(F.filter("values", lambda x: x == v)).cast("long").alias("n")))
    one = masks.select(F.explode(kinds).alias("k")).select("k.*").filter("value IS NOT NULL")
    counts = one.groupBy("value").agg(F.sum("n").alias("px"), F.count("*").alias("imgs"))
    # The values are few: one window over them.
    return counts.select("value", "px", "imgs", (F.col("px") / F.sum("px").over(W.partitionBy(F.lit(1)))).alias("share"))


def guessed_map(values: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """value, name: a first guess of what the values above 0 mean, by falling area (ties: the smaller value); null beyond ``names``.

    Empty if there are more than ``MOST_CLASSES`` values: then these are no masks of classes.
    """
    some = values.filter("value <> 0").withColumn("_n", F.count("*").over(W.partitionBy(F.lit(1)))).filter(F.col("_n") <= MOST_CLASSES)
    place = F.row_number().over(W.partitionBy(F.lit(1)).orderBy(F.desc("px"), "value"))
    return some.select("value", F.get(F.array(*map(F.lit, names)), place - 1).alias("name"))


def pixel_stats(images: DataFrame) -> DataFrame:
    """cls, px, imgs (images that show it) and the means of redness, brightness, saturation and roughness.

    ``images`` has width, pixels (0xRRGGBB, row by row) and mask (a class for each pixel). Images without pixels, with nulls among them, or
    whose mask has another size are passed over.
    """
    own = images.select(F.col("width").cast("int"), F.col("pixels").cast("array<int>"), F.col("mask").cast("array<int>"))
    summed = own.mapInArrow(_partial, _PARTS).groupBy("cls").agg(F.sum("px").alias("px"), F.sum("imgs").alias("imgs"), *[F.sum(s).alias(s) for s in _SUMS])
    return summed.select("cls", "px", "imgs", *[(F.col(s) / F.col("px")).alias(s) for s in _SUMS])


def direction(stats: DataFrame) -> DataFrame:
    """check, holds: whether each measure moves one way through all classes above 0; with fewer than two of these nothing is said.

    The classes are few: one window over them.
    """
    some = stats.filter("cls <> 0").withColumn("_n", F.count("*").over(W.partitionBy(F.lit(1)))).filter("_n > 1")
    steps = some.select([F.signum(F.col(c) - F.lag(c).over(W.partitionBy(F.lit(1)).orderBy("cls"))).alias(c) for c in CHECKS])
    held = steps.agg(F.count("*").alias("_n"), *[F.coalesce(F.min(F.coalesce(F.col(c) == way, F.lit(True))), F.lit(True)).alias(c) for c, way in CHECKS.items()]).filter("_n > 0")
    return held.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("holds")) for c in CHECKS])).alias("x")).select("x.*")


def verdict(checks: DataFrame) -> DataFrame:
    """hits, verdict: ``as_given`` if enough checks hold, ``reversed`` if hardly any does, else ``unclear``."""
    hits = checks.agg(F.count_if("holds").alias("hits"), F.count("*").alias("n")).filter("n > 0")
    return hits.select("hits", F.when(F.col("hits") >= FOR, "as_given").when(F.col("hits") <= AGAINST, "reversed").otherwise("unclear").alias("verdict"))
