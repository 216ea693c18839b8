"""Connected regions of masks that are cut into stripes, so that one huge mask is the work of several tasks.

Each stripe is labelled on its own, by its runs: a run is a stretch of one class in a row, and runs of neighbouring rows
that overlap and have the same class belong together (4-connected). A stripe gives its regions and the runs of its first
and last row. Borders are rows of their own: the last row of a stripe meets the first one of the next, overlapping runs
of one class become links, and the components of the links merge regions across stripes. Only regions at a border take
part in that; the others are complete already. Class 0 is background.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loamstack.operators.imaging import LEAST_RATIO, MOST
from loamstack.operators.split import components, written

_REGION = pa.struct([("label", pa.int64()), ("cls", pa.int32()), ("area", pa.int64()), ("x0", pa.int32()), ("y0", pa.int32()), ("x1", pa.int32()), ("y1", pa.int32()), ("border", pa.bool_())])
_RUN = pa.struct([("x0", pa.int32()), ("x1", pa.int32()), ("cls", pa.int32()), ("label", pa.int64())])
_REGIONS = "array<struct<label:long,cls:int,area:long,x0:int,y0:int,x1:int,y1:int,border:boolean>>"
_RUNS = "array<struct<x0:int,x1:int,cls:int,label:long>>"


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start, end and class of the runs of a mask (rows x columns), in reading order."""
    h, w = mask.shape
    first = np.ones((h, w), bool)
    first[:, 1:] = mask[:, 1:] != mask[:, :-1]
    at = np.flatnonzero(first)
    end = np.append(at[1:], h * w)
    cls = mask.ravel()[at]
    at, end, cls = at[cls != 0], end[cls != 0], cls[cls != 0]
    return at // w, at % w, at % w + end - at, cls


def overlaps(a: tuple[np.ndarray, np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the runs (start, end, class; sorted, apart) of two rows that overlap and have one class."""
    first, stop = np.searchsorted(b[1], a[0], "right"), np.searchsorted(b[0], a[1], "left")
    n = np.maximum(stop - first, 0)
    of = np.repeat(np.arange(len(n)), n)
    other = np.arange(len(of)) + np.repeat(first - np.cumsum(n) + n, n)
    same = a[2][of] == b[2][other]
    return of[same], other[same]


def labelled(mask: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """Runs, and for each the number of the first run of its region."""
    row, x0, x1, cls = found = runs(mask)
    w = mask.shape[1]
    # One line of all rows, the next row under each: its runs are searched at their place in that line.
    of, other = overlaps(((row + 1) * w + x0, (row + 1) * w + x1, cls), (row * w + x0, row * w + x1, cls))
    label = np.arange(len(row))
    while len(of):
        low = np.minimum(label[of], label[other])
        new = label.copy()
        # The root of each end takes the smaller label, then labels jump to their own labels.
        np.minimum.at(new, label[of], low)
        np.minimum.at(new, label[other], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    return found, label


def _stripe(mask: np.ndarray, top: int) -> tuple[list[dict], list[dict], list[dict]]:
    """Regions of a stripe whose first row is ``top``, runs of its first row and of its last one."""
    (row, x0, x1, cls), label = labelled(mask)
    names, place = np.unique(label, return_inverse=True)
    n = len(names)
    area = np.bincount(place, x1 - x0, n).astype(np.int64)
    low = [np.full(n, np.iinfo(np.int64).max) for _ in range(2)]
    high = [np.zeros(n, np.int64) for _ in range(2)]
    for k, (a, b) in enumerate(((x0, x1), (row, row + 1))):
        np.minimum.at(low[k], place, a)
        np.maximum.at(high[k], place, b)
    edge = np.zeros(n, bool)
    edge[place[(row == 0) | (row == mask.shape[0] - 1)]] = True
    regions = [{"label": int(names[i]), "cls": int(cls[names[i]]), "area": int(area[i]), "x0": int(low[0][i]), "y0": int(low[1][i]) + top, "x1": int(high[0][i]), "y1": int(high[1][i]) + top, "border": bool(edge[i])} for i in range(n)]
    rows = [[{"x0": int(x0[i]), "x1": int(x1[i]), "cls": int(cls[i]), "label": int(label[i])} for i in np.flatnonzero(row == r)] for r in (0, mask.shape[0] - 1)]
    return regions, rows[0], rows[1]


def _label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = [_stripe(np.asarray(pixels.values).reshape(-1, width.as_py()), top.as_py()) if width.as_py() and len(pixels) else ([], [], []) for top, width, pixels in zip(b.column("top"), b.column("width"), b.column("pixels"), strict=True)]
        columns = [pa.array(list(c), pa.list_(t)) for c, t in zip(zip(*out, strict=True), (_REGION, _RUN, _RUN), strict=True)] if out else [pa.array([], pa.list_(t)) for t in (_REGION, _RUN, _RUN)]
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("stripe"), *columns], names=["id", "stripe", "regions", "first", "last"])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of borders (id, stripe, last, next_first) the labels on both sides that belong together."""
    for b in batches:
        rows: list[tuple] = []
        for id_, stripe, last, first in zip(b.column("id").to_pylist(), b.column("stripe").to_pylist(), b.column("last"), b.column("next_first"), strict=True):
            sides = [[np.asarray(x.values.field(k)) for k in range(4)] for x in (last, first)]
            of, other = overlaps(tuple(sides[0][:3]), tuple(sides[1][:3]))
            rows += sorted({(id_, stripe, int(sides[0][3][i]), int(sides[1][3][j])) for i, j in zip(of, other, strict=True)})
        names = ["id", "stripe", "above", "below"]
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)


def _node(id_: Column, stripe: Column, label: Column) -> Column:
    return F.concat_ws(":", id_, stripe.cast("string"), label.cast("string"))


def regions(stripes: DataFrame) -> DataFrame:
    """id, cls, area, x0, y0, x1, y1 of every region of masks given as ``stripes``.

    A stripe is id, stripe (0, 1 ... without gaps), top (its first row), width, pixels (its classes row by row). A null or empty
    stripe has no regions, and nothing is linked across it.
    """
    own = stripes.select(F.col("id").cast("string"), F.col("stripe").cast("int"), F.col("top").cast("int"), F.coalesce(F.col("width").cast("int"), F.lit(0)).alias("width"), F.coalesce(F.col("pixels").cast("array<int>"), F.array().cast("array<int>")).alias("pixels"))
    found = written(own.mapInArrow(_label, f"id string, stripe int, regions {_REGIONS}, first {_RUNS}, last {_RUNS}"), "stripes")
    below = found.select("id", (F.col("stripe") - 1).alias("stripe"), F.col("first").alias("next_first"))
    borders = found.select("id", "stripe", "last").join(below, ["id", "stripe"]).filter((F.size("last") > 0) & (F.size("next_first") > 0))
    links = borders.mapInArrow(_links, "id string, stripe int, above long, below long")
    ends = F.array(_node(F.col("id"), F.col("stripe"), F.col("above")), _node(F.col("id"), F.col("stripe") + 1, F.col("below")))
    hub = F.concat_ws(":", "id", F.col("stripe").cast("string"), F.col("above").cast("string"), F.col("below").cast("string"))
    roots = components(links.select(F.explode(ends).alias("member"), hub.alias("hub")))
    every = found.select("id", "stripe", F.explode("regions").alias("r")).select("id", "stripe", "r.*")
    whole = every.filter("NOT border").select("id", "cls", "area", "x0", "y0", "x1", "y1")
    at_border = every.filter("border").withColumn("member", _node(F.col("id"), F.col("stripe"), F.col("label"))).join(roots, "member", "left")
    merged = at_border.groupBy("id", "cls", F.coalesce("root", "member").alias("root")).agg(F.sum("area").alias("area"), *[F.min(c).alias(c) for c in ("x0", "y0")], *[F.max(c).alias(c) for c in ("x1", "y1")])
    return whole.unionByName(merged.select("id", "cls", "area", "x0", "y0", "x1", "y1"))


def largest(found: DataFrame, pixels: DataFrame, most: int = MOST, least_ratio: float = LEAST_RATIO) -> DataFrame:
    """Of each class of each mask the ``most`` largest regions (ties: the upper, then the left one), of these those of at least ``least_ratio``
    of the mask's ``pixels`` (id, pixels); a class of which nothing is left keeps the box of all its regions."""
    place = F.row_number().over(W.partitionBy("id", "cls").orderBy(F.desc("area"), "y0", "x0"))
    top = found.withColumn("_r", place).filter(F.col("_r") <= most).drop("_r")
    kept = top.join(pixels.select(F.col("id").cast("string"), "pixels"), "id").filter(F.col("area") >= least_ratio * F.col("pixels")).drop("pixels")
    every = found.groupBy("id", "cls").agg(F.sum("area").alias("area"), *[F.min(c).alias(c) for c in ("x0", "y0")], *[F.max(c).alias(c) for c in ("x1", "y1")])
    return kept.unionByName(every.join(kept.select("id", "cls").distinct(), ["id", "cls"], "left_anti"))
