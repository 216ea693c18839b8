"""Queries of generated questions: orders as pictures, their lines as boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamstack.functions import constants as K
from loamstack.functions.geometry import area_ratio
from loamstack.operators import generate, options, taxonomy
from loamstack.plans.join_queries import CATEGORIES
from loamstack.plans.views import BOXES, H, W, boxes, draw, registered, table

QUERIES, ORACLE_SQL, query = registered()

_ACTIVE = [x[0] for x in taxonomy.DEFECTS if x[0] != taxonomy.OTHER]


def _defects(spark, d) -> DataFrame:
    """Boxes of images with their types."""
    part = table(spark, d, "part").select(F.col("p_partkey").alias("part"), F.get(K.array([x[0] for x in taxonomy.DEFECTS]), (F.col("p_partkey") % 15).cast("int")).alias("type"))
    return boxes(spark, d).join(part, "part").select("image", "line", "part", "supp", "type", F.col("box").cast("array<int>").alias("bbox"))


def _orders(spark, d) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, d, "orders").select(k.alias("image"), F.when(F.col("o_orderstatus") == "P", "blur").alias("degradation"), F.concat(F.lit("ds"), (c % 4).cast("string")).alias("dataset"), F.get(K.array(CATEGORIES), (c % 8).cast("int")).alias("category"))


def pictures(spark, d) -> DataFrame:
    """Orders as images with their boxes as raw defects."""
    by = _defects(spark, d).groupBy("image").agg(F.sort_array(F.collect_list(F.struct("line", "part", "supp", "type", "bbox"))).alias("raw"))
    return _orders(spark, d).join(by, "image", "left")


def image_samples(spark, d) -> DataFrame:
    """Orders as images with their boxes as defects, which are described before they are put together: a projection is compiled, a lambda isn't."""
    b = _defects(spark, d).withColumn("ratio", area_ratio(F.col("bbox"), F.lit(W), F.lit(H)))
    b = b.select("image", F.struct("line", "part", "supp", generate.described(F.col("type"), F.col("bbox"), F.col("ratio"), W, H).alias("d")).alias("x"))
    by = b.groupBy("image").agg(F.sort_array(F.collect_list("x")).alias("x")).select("image", F.col("x")["d"].alias("defects"))
    return generate.samples(_orders(spark, d).join(by, "image", "left"), W, H)


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


#: Of CATEGORIES in their order.
_ROLES = ("fastener", "fastener", "avionics", "structure", "structure", "unknown", "fastener_kit", "unknown")
_POSSIBLE = "CASE role " + " ".join(f"WHEN '{r}' THEN list_contains({_list(t)}, t)" for r, t in taxonomy.PART_DEFECTS.items()) + " ELSE true END"
_ALIKE = " OR ".join(f"(t = '{x}' AND first_type = '{y}')" for pair in taxonomy.CONFUSABLE for x, y in (pair, pair[::-1]))
_GROUP = "CASE {0} " + " ".join(f"WHEN '{x[0]}' THEN '{x[2]}'" for x in taxonomy.DEFECTS) + " END"
_NAME = "CASE {0} " + " ".join(f"WHEN '{x[0]}' THEN '{x[1]}'" for x in taxonomy.DEFECTS) + " END"


def _pick(values: str, name: str) -> str:
    return f"{values}[({draw(0, f'''sid || ':{name}' ''')} % greatest(1, len({values})))::INT + 1]"


def _u(name: str) -> str:
    return f"({draw(0, f'''sid || ':{name}' ''')} / 4294967296::DOUBLE)"


_SHOWN = f"""{BOXES}, img AS (SELECT o_orderkey AS sid, o_orderstatus = 'P' AS degraded, o_custkey % 8 AS grp, ({_list(_ROLES)})[(o_custkey % 8)::INT + 1] AS role FROM orders),
    found AS (SELECT image AS sid, row_number() OVER (PARTITION BY image ORDER BY line, part, supp) - 1 AS i, ({_list([x[0] for x in taxonomy.DEFECTS])})[(part % 15)::INT + 1] AS type, x1, y1, x2, y2 FROM boxes),
    kinds AS (SELECT sid, list(type ORDER BY i) AS types FROM (SELECT sid, type, min(i) AS i FROM found GROUP BY 1, 2) GROUP BY 1),
    shown AS (SELECT img.*, coalesce(types, []) AS types, types[1] AS first_type, types IS NOT NULL AS bad, list_filter({_list(_ACTIVE)}, lambda t: NOT list_contains(coalesce(types, []), t)) AS absent FROM img LEFT JOIN kinds USING (sid))"""
_CHOICE = f"""wrong AS (SELECT sid, t, row_number() OVER (PARTITION BY sid ORDER BY CASE WHEN {_ALIKE} THEN 0 WHEN {_GROUP.format('t')} = {_GROUP.format('first_type')} THEN 1 ELSE 2 END, md5('0:' || sid || ':' || t), t) AS n
        FROM (SELECT sid, role, first_type, unnest(absent) AS t FROM shown WHERE bad) WHERE {_POSSIBLE}),
    choice AS (SELECT sid, list({_NAME.format('t')} ORDER BY md5('0:' || sid || ':o:' || t), t) AS options, list(t ORDER BY md5('0:' || sid || ':o:' || t), t) AS kinds FROM (SELECT sid, t FROM wrong WHERE n <= 3 UNION ALL SELECT sid, first_type FROM shown WHERE bad) GROUP BY 1)"""


@query(f"""WITH {_SHOWN}, {_CHOICE} SELECT sid AS sample_id, array_to_string(options, '|') AS options, substr('ABCDEF', list_position(kinds, first_type)::INT, 1) AS letter FROM choice JOIN shown USING (sid)""")
def mc_options(spark, d) -> DataFrame:
    """Four options for every picture with a defect: what looks alike, then the same group, then the rest, as far as the part can show it."""
    s = taxonomy.with_objects(pictures(spark, d).filter("size(raw) > 0")).withColumn("types", F.array_distinct(F.transform("raw", lambda x: x["type"])))
    found = s.select(F.col("image").alias("sample_id"), options.named(F.col("types")[0]).alias("zh"), options.options(F.col("types"), F.col("role"), _ACTIVE, 0, F.col("image")).alias("o"))
    return found.select("sample_id", F.array_join("o", "|").alias("options"), options.letter(F.col("o"), F.col("zh")).alias("letter"))


_WEIGHTS = ", ".join(f"('{t}', {w}::DOUBLE)" for t, w in generate.WEIGHTS.items())
_TRY = "('0x' || substr(md5('0:' || sid || ':{0}:' || i), 1, 8))::BIGINT / 4294967296::DOUBLE"
_CLEAR = f"""near AS (SELECT s.sid, coalesce(f.x1, 0) AS nx, coalesce(f.y1, 0) AS ny, greatest(8, coalesce(f.x2 - f.x1, {W // 6})) AS bw, greatest(8, coalesce(f.y2 - f.y1, {H // 6})) AS bh
        FROM shown s LEFT JOIN (SELECT sid, count(*) AS n FROM found GROUP BY 1) c ON c.sid = s.sid LEFT JOIN found f ON f.sid = s.sid AND f.i = {draw(0, "s.sid || ':near'")} % c.n),
    tries AS (SELECT sid, i, bw, bh, trunc(CASE WHEN i < 30 THEN nx + ({_TRY.format('x')} * 4 - 2) * bw ELSE {_TRY.format('x')} * ({W} - bw) END)::BIGINT AS x, trunc(CASE WHEN i < 30 THEN ny + ({_TRY.format('y')} * 4 - 2) * bh ELSE {_TRY.format('y')} * ({H} - bh) END)::BIGINT AS y FROM near, range(0, 60) t(i)),
    clear AS (SELECT DISTINCT sid FROM tries t WHERE x >= 0 AND y >= 0 AND x + bw <= {W} AND y + bh <= {H} AND NOT EXISTS (SELECT 1 FROM found f WHERE f.sid = t.sid AND least(f.x2, t.x + t.bw) > greatest(f.x1, t.x) AND least(f.y2, t.y + t.bh) > greatest(f.y1, t.y)))"""
_FACTS = f"""top AS (SELECT sid, arg_max(type, (CASE WHEN type = 'corrosion' THEN x1 % 4 ELSE -1 END, CASE WHEN type = 'corrosion' THEN 0 ELSE round((x2 - x1) * (y2 - y1) / {W * H}::DOUBLE, 6) END, -i)) AS top_type, bool_or(type = 'corrosion') AS graded FROM found GROUP BY 1),
    groups AS (SELECT grp, count(*) FILTER (NOT bad) >= 3 AS paired FROM shown GROUP BY 1),
    drawn AS (SELECT *, {_pick('types', 'kind')} AS kind, {_pick('absent', 'away')} AS away, bad AND {_u('hit')} < 0.55 AS hit, {_u('zero')} < 0.25 AS zero FROM shown),
    facts AS (SELECT s.*, c.sid IS NOT NULL AS clear, top_type, coalesce(graded, false) AS graded, paired, options, kinds
        FROM drawn s LEFT JOIN clear c ON c.sid = s.sid LEFT JOIN top ON top.sid = s.sid LEFT JOIN choice ON choice.sid = s.sid JOIN groups ON groups.grp = s.grp),
    counted AS (SELECT facts.*, (SELECT count(*) FROM found f WHERE f.sid = facts.sid) AS n_all, (SELECT count(*) FROM found f WHERE f.sid = facts.sid AND f.type = kind) AS n_kind FROM facts),
    offers AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY md5('0:' || sid || ':order' || task)) AS place FROM counted, (VALUES {_WEIGHTS}) w(task, weight)
        WHERE NOT degraded AND ('0x' || substr(md5('0:' || sid || ':take' || task), 1, 8))::BIGINT / 4294967296::DOUBLE < weight AND CASE WHEN task IN ('discrimination', 'description', 'object_recognition', 'multi_turn') THEN true
            WHEN task = 'grounding_negative' THEN NOT bad WHEN task = 'referring_region' THEN hit OR clear WHEN task = 'pair_compare' THEN paired WHEN task = 'uncertainty' THEN false WHEN task = 'grade_assessment' THEN bad AND graded
            WHEN task = 'grounding_counterfactual' THEN bad AND away IS NOT NULL WHEN task = 'classification_mc' THEN bad AND len(options) >= 2 ELSE bad END)"""


@query(f"""WITH {_SHOWN}, {_CHOICE}, {_CLEAR}, {_FACTS}
    SELECT sid AS sample_id, task, CASE task WHEN 'grounding_single' THEN kind WHEN 'grounding_counterfactual' THEN away WHEN 'classification_open' THEN first_type WHEN 'classification_mc' THEN first_type WHEN 'severity_action' THEN top_type END AS target_type,
        CASE WHEN task = 'grounding_single' THEN n_kind WHEN task = 'grounding_all' THEN n_all WHEN task IN ('grounding_negative', 'grounding_counterfactual') THEN 0 WHEN task = 'counting' THEN CASE WHEN zero AND away IS NOT NULL THEN 0 ELSE n_kind END END::INT AS n_boxes,
        CASE WHEN task = 'referring_region' THEN CASE WHEN hit THEN 'yes' ELSE 'no' END WHEN task IN ('discrimination', 'multi_turn') THEN CASE WHEN bad THEN 'yes' ELSE 'no' END END AS yes_no,
        CASE WHEN task = 'classification_mc' THEN array_to_string(options, '|') END AS options, CASE WHEN task = 'classification_mc' THEN substr('ABCDEF', list_position(kinds, first_type)::INT, 1) END AS answer_letter FROM offers WHERE place <= 4
    UNION ALL SELECT sid, 'uncertainty', t, NULL, NULL, NULL, NULL FROM (SELECT sid, t, row_number() OVER (PARTITION BY sid ORDER BY p, h) AS n FROM (SELECT sid, unnest(types) AS t, unnest(range(len(types))) AS p, '' AS h FROM shown WHERE degraded
        UNION ALL SELECT sid, t, 1000, md5('0:' || sid || ':doubt:' || t) FROM (SELECT sid, unnest(absent) AS t FROM shown WHERE degraded))) WHERE n <= 3""")
def generate_records(spark, d) -> DataFrame:
    """Seventeen tasks drawn for each image in one projection: which ones, what they ask for, and how their answers count."""
    r = generate.records(image_samples(spark, d))
    return r.select("sample_id", "task", "target_type", "n_boxes", "yes_no", F.array_join("options", "|").alias("options"), "answer_letter")
