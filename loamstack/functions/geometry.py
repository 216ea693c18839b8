"""Box geometry as Columns. A box is an array of x1, y1, x2, y2."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamstack.functions import constants as K

# The order of severities.
SEVERITIES = ("minor", "major", "critical")


def area(box: Column) -> Column:
    return (box[2] - box[0]) * (box[3] - box[1])


def area_ratio(box: Column, w: Column, h: Column) -> Column:
    ratio = area(box).cast("double") / (w * h)
    return F.when((w > 0) & (h > 0) & (box[2] > box[0]) & (box[3] > box[1]), ratio).otherwise(0.0)


def iou(a: Column, b: Column) -> Column:
    iw = F.greatest(F.lit(0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    ih = F.greatest(F.lit(0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    both = (iw * ih).cast("double")
    union = area(a) + area(b) - both
    return F.when((both > 0) & (union > 0), both / union).otherwise(0.0)


def meets(a: Column, b: Column) -> Column:
    """Whether two boxes share an area: ``iou`` above 0 without working it out. A null box meets none."""
    return F.coalesce((a[0] < b[2]) & (b[0] < a[2]) & (a[1] < b[3]) & (b[1] < a[3]) & (a[0] < a[2]) & (a[1] < a[3]) & (b[0] < b[2]) & (b[1] < b[3]), F.lit(False))


def merged(boxes: Column) -> Column:
    """The least box around all."""
    side = lambda f, i: f(F.transform(boxes, lambda b: b[i]))
    return F.array(side(F.array_min, 0), side(F.array_min, 1), side(F.array_max, 2), side(F.array_max, 3))


def region_word(box: Column, w: Column, h: Column) -> Column:
    """The ninth of the picture that holds the centre."""
    cx, cy = (box[0] + box[2]) / 2.0 / w, (box[1] + box[3]) / 2.0 / h
    third = lambda v: F.when(v < 1 / 3, 0).when(v < 2 / 3, 1).otherwise(2)
    # One look at a constant list: words put together by branches are worked out several times for each box.
    words = K.array(["正中" if row == col == "中" else col + "侧中部" if row == "中" else "中" + row + "部" if col == "中" else col + row for row in "上中下" for col in "左中右"])
    return F.when(box.isNull() | (w <= 0) | (h <= 0), "画面中").otherwise(F.get(words, third(cy) * 3 + third(cx)))


def size_word(ratio: Column) -> Column:
    # Upper bounds and words.
    return (F.when(ratio < 0.002, "范围极小").when(ratio < 0.01, "范围较小").when(ratio < 0.05, "范围中等").when(ratio < 0.15, "范围较大").otherwise("范围很大"))


def severity_from_area(base: Column, ratio: Column) -> Column:
    """One step up from 0.08 of the picture, one step down under 0.003."""
    place = F.coalesce(F.nullif(F.array_position(K.array(SEVERITIES), base), F.lit(0)), F.lit(2))
    step = F.when(ratio >= 0.08, 1).when((ratio > 0) & (ratio < 0.003), -1).otherwise(0)
    return F.get(K.array(SEVERITIES), (F.least(F.lit(3), F.greatest(F.lit(1), place + step)) - 1).cast("int"))


def norm_box(box: Column, w: Column, h: Column, mode: str = "norm1000") -> Column:
    """Coordinates from 0 to 1000, halves to even; with mode "abs", pixels."""
    if mode == "abs":
        return F.transform(box, lambda v: F.rint(v.cast("double")).cast("int"))
    scaled = F.transform(box, lambda v, i: F.least(F.lit(1000.0), F.greatest(F.lit(0.0), F.rint(v / F.when(i % 2 == 0, w).otherwise(h) * 1000))).cast("int"))
    return F.when((w <= 0) | (h <= 0), F.array(*[F.lit(0)] * 4)).otherwise(scaled)


def norm_text(box: Column, w: Column, h: Column) -> Column:
    """``norm_box`` of a box of four as a text, without an array, so that it is compiled in a plain projection."""
    side = lambda v, of: F.least(F.lit(1000.0), F.greatest(F.lit(0.0), F.rint(v / of * 1000))).cast("int").cast("string")
    scaled = F.concat(F.lit("["), F.concat_ws(", ", *[side(box[i], (w, h)[i % 2]) for i in range(4)]), F.lit("]"))
    return F.when((w <= 0) | (h <= 0), "[0, 0, 0, 0]").when(box.isNotNull(), scaled)


def smart_resize(h: Column, w: Column, factor: int = 28, least: int = 4 * 28 * 28, most: int = 16384 * 28 * 28) -> Column:
    """struct<h,w>: multiples of ``factor`` whose area lies between the bounds."""
    near = lambda v: F.greatest(F.lit(float(factor)), F.rint(v / factor) * factor)
    hb, wb = near(h), near(w)
    down, up = F.sqrt(h * w / float(most)), F.sqrt(F.lit(float(least)) / (h * w))
    shrink = lambda v: F.greatest(F.lit(float(factor)), F.floor(v / down / factor).cast("double") * factor)
    grow = lambda v: F.ceil(v * up / factor).cast("double") * factor
    fit = lambda v, b: F.when(hb * wb > most, shrink(v)).when(hb * wb < least, grow(v)).otherwise(b).cast("bigint")
    return F.struct(fit(h, hb).alias("h"), fit(w, wb).alias("w"))


def rotated_box(box: Column, w: Column, h: Column, degrees: Column) -> Column:
    """The box around a box turned about the picture's centre."""
    t = F.radians(degrees)
    corner = lambda x, y: F.struct((w / 2 + (x - w / 2) * F.cos(t) - (y - h / 2) * F.sin(t)).alias("x"), (h / 2 + (x - w / 2) * F.sin(t) + (y - h / 2) * F.cos(t)).alias("y"))
    corners = F.array(corner(box[0], box[1]), corner(box[2], box[1]), corner(box[2], box[3]), corner(box[0], box[3]))
    xs, ys = F.transform(corners, lambda c: c["x"]), F.transform(corners, lambda c: c["y"])
    clip = lambda v, top: F.greatest(F.lit(0.0), F.least(v, top.cast("double")))
    return F.array(clip(F.array_min(xs), w), clip(F.array_min(ys), h), clip(F.array_max(xs), w), clip(F.array_max(ys), h))
