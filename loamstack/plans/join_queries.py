"""Queries of joins, mappings, deduplication and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamstack.functions import text as X
from loamstack.operators import attach, balance, enrich, generate, split, taxonomy
from loamstack.plans.views import BOXES, RECORDS, SAMPLES, boxes, draw, order, records, registered, samples, table

QUERIES, ORACLE_SQL, query = registered()

_KEY = "trim(regexp_replace(regexp_replace(regexp_replace(lower(trim({0})), '[\\s\\-/]+', '_', 'g'), '[^a-z0-9_]+', '', 'g'), '_+', '_', 'g'), '_')"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(str(x) if isinstance(x, int) else f"'{x}'" for x in r) + ")" for r in rows)


_ALIASES = _values([(n, d[0], i) for i, (n, d) in enumerate([(n, d) for d in taxonomy.DEFECTS for n in (d[0], *d[5])])])
_DEFECTS = _values([(d[0], d[2]) for d in taxonomy.DEFECTS])
_OBJECTS = _values([(o[0], i) for i, o in enumerate(taxonomy.OBJECTS)])
#: Raw class names in many spellings: an alias with what a source puts around it.
_RAW = "(['Crack', 'paint-peel-off', 'HS', 'ak', 'deep scratch!', 'rusty spot', 'Screw/Too Long', 'zz', '', 'broken_cable 2', 'class_7', 'oil leak', 'metal bent', 'missing'])[(l_partkey % 14)::INT + 1]"
RAW = ("Crack", "paint-peel-off", "HS", "ak", "deep scratch!", "rusty spot", "Screw/Too Long", "zz", "", "broken_cable 2", "class_7", "oil leak", "metal bent", "missing")


@query(f"""WITH a AS (SELECT {_KEY.format('n')} AS alias, arg_max(t, i) AS type, min(i) AS ord FROM (VALUES {_ALIASES}) v(n, t, i) GROUP BY 1),
    r AS (SELECT DISTINCT {_RAW} AS raw FROM lineitem), k AS (SELECT raw, {_KEY.format('raw')} AS key FROM r),
    m AS (SELECT raw, coalesce((SELECT type FROM a WHERE a.alias = k.key AND k.key <> ''), (SELECT type FROM a WHERE length(alias) >= 4 AND contains(k.key, alias) ORDER BY length(alias) DESC, ord LIMIT 1), 'other_anomaly') AS type FROM k)
    SELECT m.raw, m.type, count(*) AS n FROM lineitem JOIN m ON m.raw = {_RAW} GROUP BY 1, 2""")
def class_map_exact_then_substring(spark, d) -> DataFrame:
    raw = F.get(F.array(*map(F.lit, RAW)), (F.col("l_partkey") % 14).cast("int"))
    rows = table(spark, d, "lineitem").select(raw.alias("raw")).groupBy("raw").agg(F.count("*").alias("n"))
    return rows.join(taxonomy.map_defects(rows, "raw"), "raw").select("raw", "type", "n")


_CAT = "(['Screw', 'hex bolt', 'PCB-3', 'left wing', 'panel', 'gear', 'screw_bag', ''])[(p_partkey % 8)::INT + 1]"
CATEGORIES = ("Screw", "hex bolt", "PCB-3", "left wing", "panel", "gear", "screw_bag", "")


@query(f"""WITH o AS (SELECT * FROM (VALUES {_OBJECTS}) v(object, ord)), c AS (SELECT DISTINCT {_CAT} AS category FROM part), k AS (SELECT category, {_KEY.format('category')} AS key FROM c),
    m AS (SELECT category, coalesce((SELECT object FROM o WHERE object = key), (SELECT object FROM o WHERE length(object) >= 3 AND contains(key, object) ORDER BY length(object) DESC, ord LIMIT 1), 'unknown') AS object FROM k)
    SELECT p_partkey, category, object FROM part JOIN m ON m.category = {_CAT}""")
def object_map(spark, d) -> DataFrame:
    part = table(spark, d, "part").select("p_partkey", F.get(F.array(*map(F.lit, CATEGORIES)), (F.col("p_partkey") % 8).cast("int")).alias("category"))
    return part.join(taxonomy.map_objects(part, "category"), "category").select("p_partkey", "category", "object")


_TYPE = "([" + ", ".join(f"'{x[0]}'" for x in taxonomy.DEFECTS) + "])[(p_partkey % 16)::INT + 1]"


@query(f"""WITH d AS (SELECT * FROM (VALUES {_DEFECTS}) v(type, grp)), p AS (SELECT p_partkey, {_TYPE} AS type FROM part)
    SELECT p_partkey, p.type, coalesce(string_agg(b.type, ';' ORDER BY b.type), '') AS siblings FROM p JOIN d a ON a.type = p.type LEFT JOIN d b ON a.grp = b.grp AND a.type <> b.type GROUP BY 1, 2""")
def siblings(spark, d) -> DataFrame:
    """Of each part's type the other types of its group."""
    kind = F.get(F.array(*[F.lit(x[0]) for x in taxonomy.DEFECTS]), (F.col("p_partkey") % 16).cast("int"))
    near = taxonomy.siblings(spark).groupBy("type").agg(F.array_join(F.array_sort(F.collect_list("sibling")), ";").alias("siblings"))
    parts = table(spark, d, "part").select("p_partkey", kind.alias("type"))
    return parts.join(F.broadcast(near), "type", "left").select("p_partkey", "type", F.coalesce("siblings", F.lit("")).alias("siblings"))


@query(f"""WITH {BOXES}, a AS (SELECT b.image, b.line, b.x1, p.p_type FROM boxes b JOIN part p ON b.part = p.p_partkey WHERE p.p_brand NOT IN (SELECT p_brand FROM part GROUP BY 1 HAVING min(p_size) = 1 AND count(*) > 90))
    SELECT o_orderkey AS image, count(a.image) AS n_boxes, CASE WHEN count(a.image) = 0 THEN 'normal' ELSE 'anomalous' END AS label, coalesce(string_agg(a.p_type || '@' || a.x1, ';' ORDER BY a.line, a.p_type, a.x1), '') AS defects
    FROM orders LEFT JOIN a ON a.image = o_orderkey GROUP BY 1""")
def anno_assemble(spark, d) -> DataFrame:
    """Images with their annotations in order; annotations of placeholder categories fall out."""
    part = table(spark, d, "part")
    placeholder = part.groupBy("p_brand").agg(F.min("p_size").alias("s"), F.count("*").alias("n")).filter("s = 1 and n > 90").select("p_brand")
    classes = part.join(placeholder, "p_brand", "left_anti").select(F.col("p_partkey").alias("part"), "p_type")
    found = attach.annotations(table(spark, d, "orders").select(F.col("o_orderkey").alias("image")), boxes(spark, d), classes, "image", "part", ["line", "p_type", F.col("box")[0].alias("x1")])
    return found.select("image", F.size("a").cast("bigint").alias("n_boxes"), attach.label(F.col("a")).alias("label"),
                         F.coalesce(F.array_join(F.transform("a", lambda x: F.concat_ws("@", x["p_type"], x["x1"].cast("string"))), ";"), F.lit("")).alias("defects"))


@query("""SELECT image, file, prio FROM (SELECT o_orderkey AS image, l_partkey AS file, (o_orderkey + l_partkey) % 5 AS prio, row_number() OVER (PARTITION BY o_orderkey ORDER BY (o_orderkey + l_partkey) % 5, l_partkey) AS r
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey) WHERE r = 1""")
def first_match_by_priority(spark, d) -> DataFrame:
    """Each image with the first of its candidate files: those that its lines name."""
    files = table(spark, d, "lineitem").select(F.col("l_partkey").alias("file"), F.col("l_orderkey").alias("k"))
    images = table(spark, d, "orders").select(F.col("o_orderkey").alias("image"), F.col("o_orderkey").alias("k"))
    return attach.first_by_priority(images, files, "image", "k", (F.col("image") + F.col("file")) % 5, F.col("file")).select("image", "file", "prio")


@query("""WITH c AS (SELECT DISTINCT md5(event_type || chr(0) || props || chr(0)) AS k FROM events WHERE event_id % 2 = 0), r AS (SELECT event_type, md5(event_type || chr(0) || props || chr(0)) AS k FROM events WHERE event_id % 2 = 1)
    SELECT event_type, count(c.k) AS hits, count(*) - count(c.k) AS misses FROM r LEFT JOIN c USING (k) GROUP BY 1""")
def cache_hit_miss(spark, d) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "event_type", X.cache_key(F.col("event_type"), F.col("props"), F.lit("")).alias("k"))
    return enrich.hits(e.filter("event_id % 2 = 1"), e.filter("event_id % 2 = 0"), "event_type")


@query(f"""WITH {SAMPLES}, p AS (SELECT dataset, category, sample_id::VARCHAR AS reference, {draw('ref0', 'sample_id')} % 64 AS b FROM samples WHERE label = 'normal'),
    q AS (SELECT *, row_number() OVER (PARTITION BY dataset, category, b ORDER BY reference) AS place, count(*) OVER (PARTITION BY dataset, category, b) AS n, count(*) OVER (PARTITION BY dataset, category) AS every FROM p),
    k AS (SELECT dataset, category, list_sort(list(DISTINCT b)) AS bs FROM q WHERE every >= 3 GROUP BY 1, 2),
    s AS (SELECT sample_id, dataset, category, bs[({draw('ref', 'sample_id')} % len(bs))::INT + 1] AS b FROM samples JOIN k USING (dataset, category) WHERE label = 'anomalous')
    SELECT s.sample_id, q.reference AS ref FROM s JOIN q USING (dataset, category, b) WHERE q.place = {draw('ref2', 's.sample_id')} % q.n + 1""")
def ref_pool_pick(spark, d) -> DataFrame:
    """A normal reference of the same dataset and category for each anomalous sample."""
    s = samples(spark, d).withColumn("image", F.col("sample_id").cast("string"))
    return generate.with_references(s).filter("label = 'anomalous' and reference is not null").select("sample_id", F.col("reference").alias("ref"))


@query(f"""WITH {SAMPLES} SELECT dataset, category, min(sample_id) AS sample_id, any_value(length(text))::INT AS n FROM (SELECT *, row_number() OVER (PARTITION BY dataset, category, text ORDER BY sample_id) AS r FROM samples) WHERE r = 1 GROUP BY dataset, category, text""")
def dedup_first(spark, d) -> DataFrame:
    s = samples(spark, d).select("sample_id", "dataset", "category", "text")
    return split.dedup_first(s, ["dataset", "category", "text"], ["sample_id"]).select("dataset", "category", "sample_id", F.length("text").alias("n"))


@query(f"""WITH {BOXES}, t AS (SELECT image, list_distinct(list(p_type)) AS types FROM boxes JOIN part ON part = p_partkey GROUP BY 1), a AS (SELECT list(DISTINCT p_type) AS every FROM part)
    SELECT image, array_to_string(list_sort(list_filter(every, lambda x: NOT list_contains(types, x))), ';') AS absent FROM t, a""")
def type_pool_difference(spark, d) -> DataFrame:
    """The types an image does not show."""
    part = table(spark, d, "part").select(F.col("p_partkey").alias("part"), "p_type")
    every = part.agg(F.collect_set("p_type").alias("every"))  # the few types there are
    shown = boxes(spark, d).join(part, "part").groupBy("image").agg(F.collect_set("p_type").alias("types"))
    return shown.crossJoin(F.broadcast(every)).select("image", F.array_join(F.array_sort(F.array_except("every", "types")), ";").alias("absent"))


_SPLIT = "CASE WHEN {0} % 10000 / 10000.0::DOUBLE < 0.95 THEN 'train' WHEN {0} % 10000 / 10000.0::DOUBLE < 0.95::DOUBLE + 0.03::DOUBLE THEN 'val' ELSE 'test' END"


@query(f"""WITH {SAMPLES} SELECT sample_id, {_SPLIT.format(draw(0, "'sid:' || sample_id"))} AS split FROM samples""")
def split_assign_simple(spark, d) -> DataFrame:
    return split.split_by(samples(spark, d), "sample_id").select("sample_id", "split")


_LINKS = "l AS (SELECT DISTINCT 'sid:' || l_orderkey AS m, l_shipdate::DATE || '/' || l_partkey AS hub FROM lineitem)"


def _linked(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("sample_id"), F.concat_ws("/", F.col("l_shipdate").cast("date").cast("string"), F.col("l_partkey").cast("string")).alias("image"))


_ROOTS = f"""WITH RECURSIVE {_LINKS}, e AS (SELECT DISTINCT a.m AS a, b.m AS b FROM l a JOIN l b USING (hub)),
    reach(m, r) AS (SELECT m, m FROM l UNION SELECT e.b, reach.r FROM reach JOIN e ON e.a = reach.m), roots AS (SELECT m, min(r) AS root FROM reach GROUP BY 1)"""


@query(f"""{_ROOTS} SELECT substr(m, 5)::BIGINT AS sample_id, root, {_SPLIT.format(draw(0, 'root'))} AS split FROM roots""")
def group_split_components(spark, d) -> DataFrame:
    """Orders that ship one part on one day are linked, as samples are by an image."""
    return split.split_groups(_linked(spark, d), "sample_id", "image").select("sample_id", "root", "split").distinct()


@query(f"""WITH {SAMPLES}, s AS (SELECT text, {_SPLIT.format(draw(0, "'sid:' || sample_id"))} AS split FROM samples) SELECT md5(text) AS text_md5, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM s GROUP BY text HAVING count(DISTINCT split) > 1""")
def split_leak_check(spark, d) -> DataFrame:
    s = split.split_by(samples(spark, d), "sample_id").select(F.md5(F.col("text").cast("binary")).alias("text_md5"), "split")
    return split.leaks(s, "text_md5")


@query("""WITH n AS (SELECT item_id % 30 AS task, item_id, 'new' AS origin FROM benchmark WHERE item_id % 3 = 0), o AS (SELECT item_id % 30 AS task, item_id, 'old' AS origin FROM benchmark)
    SELECT * FROM n UNION ALL SELECT * FROM o WHERE task NOT IN (SELECT task FROM n)""")
def bank_merge(spark, d) -> DataFrame:
    b = table(spark, d, "benchmark").select((F.col("item_id") % 30).alias("task"), "item_id")
    return split.merge_over(b.withColumn("origin", F.lit("old")), b.filter("item_id % 3 = 0").withColumn("origin", F.lit("new")), "task")


@query("""SELECT d.doc_id FROM documents d ANTI JOIN (SELECT DISTINCT text FROM benchmark) b ON d.text = b.text""")
def benchmark_anti_join(spark, d) -> DataFrame:
    return split.without(table(spark, d, "documents"), table(spark, d, "benchmark"), "text").select("doc_id")


@query(f"""WITH {SAMPLES}, sizes AS (SELECT dataset, count(*) AS n FROM samples GROUP BY 1), lv AS (SELECT max(l) AS level FROM (SELECT g.l, least(any_value(m.m), g.l) AS top, sum(least(n, g.l)) AS total FROM sizes, (SELECT max(n) AS m FROM sizes) m, range(1, 100001) g(l) WHERE g.l <= m.m GROUP BY g.l) WHERE top <= 0.4::DOUBLE * total + 1e-9),
    st AS (SELECT dataset, label, count(*) AS c FROM samples GROUP BY 1, 2), ds AS (SELECT s.dataset, s.n, coalesce(a.c, 0) AS anom, level FROM sizes s LEFT JOIN st a ON a.dataset = s.dataset AND a.label = 'anomalous', lv),
    take AS (SELECT dataset, CASE WHEN n <= level THEN anom ELSE round_even(level * (anom::DOUBLE / n), 0)::BIGINT END AS ta, CASE WHEN n <= level THEN n - anom ELSE level - round_even(level * (anom::DOUBLE / n), 0)::BIGINT END AS tn FROM ds),
    capped AS (SELECT * FROM (SELECT s.*, row_number() OVER (PARTITION BY s.dataset, s.label ORDER BY {order(0, 's.sample_id')}) AS r, CASE s.label WHEN 'anomalous' THEN ta ELSE tn END AS t FROM samples s JOIN take USING (dataset)) WHERE r <= t),
    na AS (SELECT count(*) AS n FROM capped WHERE label = 'anomalous'), bal AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {order(0, 'sample_id')}) AS q FROM capped) , na WHERE label = 'anomalous' OR q <= na.n),
    dd AS (SELECT dataset, label, text, min(sample_id) AS sample_id FROM bal GROUP BY 1, 2, 3)
    SELECT {_SPLIT.format(draw(0, "'sid:' || sample_id"))} AS split, dataset, label, count(*) AS n FROM dd GROUP BY 1, 2, 3""")
def flagship_split_counts(spark, d) -> DataFrame:
    """Share cap, label balance, dedup, split: counts of what is left."""
    s = balance.Sampling(samples(spark, d)).cap_source_share(0.4).balance_labels(1.0).apply()
    s = split.dedup_first(s.select("dataset", "label", "text", "sample_id"), ["dataset", "label", "text"], ["sample_id"])
    return split.split_by(s, "sample_id").groupBy("split", "dataset", "label").agg(F.count("*").alias("n"))


@query(f"""WITH {RECORDS} SELECT count(*) AS n_records, count(DISTINCT sample_id) AS n_samples FROM records""")
def record_counts(spark, d) -> DataFrame:
    return records(spark, d).agg(F.count("*").alias("n_records"), F.countDistinct("sample_id").alias("n_samples"))
