"""Queries of masks and pixels: embeddings laid side by side as images."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamstack.operators import grades, stripes
from loamstack.plans.views import registered, table

QUERIES, ORACLE_SQL, query = registered()

_SIDE, _STRIPE = 64, 16
_CLS = "CASE WHEN e > 0.02 THEN 1 WHEN e < -0.3 THEN 2 ELSE 0 END"
_CELLS = f"c AS (SELECT vec_id // {_SIDE} AS id, vec_id % {_SIDE} AS y, unnest(range(0, {_SIDE})) AS x, unnest(embedding)::DOUBLE AS e FROM embeddings)"


@query(f"""WITH RECURSIVE {_CELLS}, m AS (SELECT id, y, x, y * {_SIDE} + x AS p, {_CLS} AS cls FROM c), p AS (SELECT * FROM m WHERE cls <> 0),
    e AS (SELECT a.id, a.p AS a, b.p AS b FROM p a JOIN p b ON a.id = b.id AND a.cls = b.cls AND b.p IN (a.p - 1, a.p + 1, a.p - {_SIDE}, a.p + {_SIDE}) AND abs(a.x - b.x) + abs(a.y - b.y) = 1),
    up AS (SELECT p.*, NOT EXISTS (SELECT 1 FROM e WHERE e.id = p.id AND e.a = p.p AND e.b < e.a) AS seed FROM p),
    reach(id, p, q) AS (SELECT id, p, p FROM up WHERE seed UNION SELECT r.id, e.b, r.q FROM reach r JOIN e ON e.id = r.id AND e.a = r.p),
    k AS (SELECT id, p, min(q) AS root FROM reach GROUP BY 1, 2),
    s AS (SELECT p.id, cls, root, count(*) AS area, min(x) AS x0, min(y) AS y0, max(x) + 1 AS x1, max(y) + 1 AS y1 FROM k JOIN p ON p.id = k.id AND p.p = k.p GROUP BY 1, 2, 3),
    r AS (SELECT *, row_number() OVER (PARTITION BY id, cls ORDER BY area DESC, y0, x0) AS n FROM s), z AS (SELECT id, count(*) AS pixels FROM m GROUP BY 1),
    t AS (SELECT r.* FROM r JOIN z USING (id) WHERE n <= 12 AND area >= 0.003::DOUBLE * pixels)
    SELECT id::VARCHAR AS id, cls, area, x0::INT AS x0, y0::INT AS y0, x1::INT AS x1, y1::INT AS y1 FROM t
    UNION ALL SELECT id::VARCHAR, cls, sum(area)::BIGINT, min(x0)::INT, min(y0)::INT, max(x1)::INT, max(y1)::INT FROM s WHERE (id, cls) NOT IN (SELECT (id, cls) FROM t) GROUP BY id, cls""")
def mask_stripes(spark, d) -> DataFrame:
    """Embeddings as the rows of 64 x 64 masks of two classes, cut into stripes of 16 rows: the twelve largest regions, then the least area."""
    e = table(spark, d, "embeddings")
    cls = F.transform("embedding", lambda v: F.when(v.cast("double") > 0.02, 1).when(v.cast("double") < -0.3, 2).otherwise(0))
    y = F.col("vec_id") % _SIDE
    rows = e.select(F.floor(F.col("vec_id") / _SIDE).cast("string").alias("id"), F.floor(y / _STRIPE).cast("int").alias("stripe"), y.alias("y"), cls.alias("row"))
    cut = rows.groupBy("id", "stripe").agg(F.array_sort(F.collect_list(F.struct("y", "row"))).alias("rows")).select("id", "stripe", F.col("rows")[0]["y"].alias("top"), F.lit(_SIDE).alias("width"), F.flatten(F.transform("rows", lambda r: r["row"])).alias("pixels"))
    sizes = cut.groupBy("id").agg(F.sum(F.size("pixels")).alias("pixels"))
    return stripes.largest(stripes.regions(cut), sizes, 12, 0.003)


_PART = "(abs(floor(embedding[{0}]::DOUBLE * 1000))::BIGINT % 256)"
_IMAGE = f"""i AS (SELECT vec_id, label, k, k % 8 AS x, k // 8 AS y, (k // 16 + label) % 4 AS cls, {_PART.format('k + 1')}::DOUBLE AS r, {_PART.format('(k + 9) % 64 + 1')}::DOUBLE AS g, {_PART.format('(k + 30) % 64 + 1')}::DOUBLE AS b FROM embeddings, range(0, 64) t(k)),
    w AS (SELECT *, 0.299 * r + 0.587 * g + 0.114 * b AS grey, greatest(r, g, b) AS hi, least(r, g, b) AS lo FROM i),
    v AS (SELECT *, (r - b) / (r + b + 1) AS redness, (hi - lo) / (hi + 1) AS sat, coalesce(abs(grey - lag(grey) OVER (PARTITION BY vec_id, y ORDER BY x)), 0) + coalesce(abs(grey - lag(grey) OVER (PARTITION BY vec_id, x ORDER BY y)), 0) AS rough FROM w),
    s AS (SELECT cls, count(*) AS px, count(DISTINCT vec_id) AS imgs, avg(redness) AS redness, avg(grey) AS brightness, avg(sat) AS saturation, avg(rough) AS roughness FROM v GROUP BY 1)"""


def _graded(spark, d) -> DataFrame:
    part = lambda v: F.pmod(F.abs(F.floor(v.cast("double") * 1000)), F.lit(256)).cast("int")
    at = lambda by: F.transform("embedding", lambda _, i: part(F.get("embedding", ((i + by) % 64).cast("int"))))
    e = table(spark, d, "embeddings").select("label", "embedding", at(0).alias("r"), at(9).alias("g"), at(30).alias("b"))
    pixels = F.zip_with("r", F.zip_with("g", "b", lambda g, b: g * 256 + b), lambda r, x: r * 65536 + x)
    return e.select(F.lit(8).alias("width"), pixels.alias("pixels"), F.transform("r", lambda _, i: (F.floor(i / 16) + F.col("label")) % 4).alias("mask"))


@query(f"""WITH {_IMAGE} SELECT cls::INT AS cls, px, imgs, round(redness, 4) AS redness, round(brightness, 4) AS brightness, round(saturation, 4) AS saturation, round(roughness, 4) AS roughness FROM s""")
def grade_pixels(spark, d) -> DataFrame:
    """How embeddings look as 8 x 8 images, by class."""
    return grades.pixel_stats(_graded(spark, d)).select("cls", "px", "imgs", *[F.round(c, 4).alias(c) for c in ("redness", "brightness", "saturation", "roughness")])


_UP = "bool_and(coalesce({0} {1} p_{0}, true))"


@query(f"""WITH {_IMAGE}, l AS (SELECT *, {", ".join(f"lag({c}) OVER (ORDER BY cls) AS p_{c}" for c in grades.CHECKS)} FROM s WHERE cls <> 0), f AS (SELECT [{", ".join(_UP.format(c, ">" if way > 0 else "<") for c, way in grades.CHECKS.items())}] AS h FROM l),
    n AS (SELECT len(list_filter(h, lambda x: x))::BIGINT AS hits FROM f) SELECT hits, CASE WHEN hits >= 4 THEN 'as_given' WHEN hits <= 1 THEN 'reversed' ELSE 'unclear' END AS verdict FROM n""")
def grade_direction(spark, d) -> DataFrame:
    return grades.verdict(grades.direction(grades.pixel_stats(_graded(spark, d))))


@query(f"""WITH {_IMAGE}, o AS (SELECT cls::INT AS value, px, imgs, px / sum(px) OVER () AS share FROM s), g AS (SELECT value, row_number() OVER (ORDER BY px DESC, value) AS n FROM o WHERE value <> 0)
    SELECT o.value, px, imgs, round(share, 6) AS share, (['good', 'fair', 'poor', 'severe'])[n::INT] AS name FROM o LEFT JOIN g ON g.value = o.value""")
def mask_class_guess(spark, d) -> DataFrame:
    """Values of embeddings as masks, and what they might mean by their area."""
    values = grades.mask_values(_graded(spark, d).select(F.col("mask").cast("array<int>").alias("values")))
    return values.join(grades.guessed_map(values, ("good", "fair", "poor", "severe")), "value", "left").select("value", "px", "imgs", F.round("share", 6).alias("share"), "name")
