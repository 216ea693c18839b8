"""Readers of annotated image sources. Each gives rows of one schema:

image_path, category, split, width, height, label, defects array<struct<raw,type,bbox,area_ratio,severity,region,grade>>

A defect of corrosion whose raw name is a grade has that grade and its severity.

An image whose size cannot be read is dropped. Boxes come first, then the components of a mask, then a defect without
a box for a source that has only image labels.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstack.functions import geometry as G
from loamstack.operators import imaging
from loamstack.operators.split import rank_first
from loamstack.operators.taxonomy import GRADES, defect_dim, map_defects
from loamstack.sources import json_array, profile

#: Masks whose pixels are read.
MASKS = ("png", "bmp", "PNG", "BMP")
IMAGES = ("png", "jpg", "jpeg", "bmp", "PNG", "JPG", "JPEG", "BMP")
# Names that mean "no defect".
NORMAL = ("good", "ok", "normal")
_PLAIN = ("background", "none", "good", "normal", "ok")


def files(spark: SparkSession, root: str, suffixes: tuple = IMAGES) -> DataFrame:
    """path (below root), content; content is only read where a column needs it."""
    glob = "*.{" + ",".join(suffixes) + "}"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    below = F.regexp_replace("path", "^.*?" + root.rstrip("/").replace("file://", "").replace(".", r"\.") + "/", "")
    return found.select(below.alias("path"), "content")


def sized(df: DataFrame) -> DataFrame:
    s = imaging.size_of_udf()(F.col("content"))
    return df.withColumn("_s", s).withColumns({"width": F.col("_s.w"), "height": F.col("_s.h")}).drop("_s", "content").filter("width is not null")


def assemble(images: DataFrame, found: DataFrame) -> DataFrame:
    """``images`` (image_path, category, split, width, height, is_normal) with ``found`` (image_path, ord, raw, box array<double>; a null box is image-level).

    A column ``as_type`` names the type of defects whose raw names are its grades.
    """
    spark = images.sparkSession
    named = found.join(map_defects(found, "raw"), "raw")
    if "as_type" in found.columns:
        named = named.withColumn("type", F.coalesce("as_type", "type"))
    mapped = named.join(F.broadcast(defect_dim(spark).select("type", "severity", "area_scales")), "type")
    wide = mapped.join(images.select("image_path", "width", "height"), "image_path")
    box = F.transform("box", lambda v: v.cast("int"))
    grade = F.when((F.col("type") == "corrosion") & F.col("raw").isin(*[g[0] for g in GRADES]), F.col("raw"))
    graded = F.try_element_at(F.create_map(*[F.lit(x) for g in GRADES for x in (g[0], g[2])]), grade)
    ratio = F.round(G.area_ratio(F.col("box"), F.col("width"), F.col("height")), 6)
    one = F.struct("ord", "raw", "type", box.alias("bbox"), F.when(F.col("box").isNotNull(), ratio).otherwise(0.0).alias("area_ratio"),
                   F.when(graded.isNotNull(), graded).when(F.col("area_scales") & F.col("box").isNotNull(), G.severity_from_area(F.col("severity"), ratio)).otherwise(F.col("severity")).alias("severity"), G.region_word(F.col("box"), F.col("width"), F.col("height")).alias("region"),
                   grade.alias("grade"))
    defects = wide.select("image_path", one.alias("d")).groupBy("image_path").agg(F.array_sort(F.collect_list("d")).alias("_d"))
    plain = lambda d: F.struct(d["raw"].alias("raw"), d["type"].alias("type"), d["bbox"].alias("bbox"), d["area_ratio"].alias("area_ratio"), d["severity"].alias("severity"), d["region"].alias("region"), d["grade"].alias("grade"))
    empty = F.array().cast("array<struct<raw:string,type:string,bbox:array<int>,area_ratio:double,severity:string,region:string,grade:string>>")
    joined = images.join(defects, "image_path", "left").withColumn("defects", F.coalesce(F.transform("_d", plain), empty))
    return joined.withColumn("label", F.when(F.size("defects") > 0, "anomalous").otherwise("normal")).select("image_path", "category", "split", "width", "height", "label", "defects")


_IMAGE, _ANNOTATION, _CATEGORY = "struct<id:long,file_name:string,width:int,height:int>", "struct<id:long,image_id:long,category_id:long,bbox:array<double>>", "struct<id:long,name:string,supercategory:string>"


def coco(spark: SparkSession, root: str, splits: tuple = ("train", "valid", "test"), name: str = "_annotations.coco.json", categories: list[str] | None = None) -> DataFrame:
    """<split>/<name> beside the images. A placeholder category (supercategory none, and named as one) is dropped.

    Files whose names begin with "_" are read by byte ranges (``json_array``); others by Spark's reader, each in one task.
    ``categories`` names those whose annotations are wanted; of files read by ranges the others never leave the reader.
    """
    if name.startswith("_"):
        paths = {k: f"{root.rstrip('/')}/{k}/{name}" for k in splits}
        split = F.element_at(F.create_map(*[F.lit(x) for k, p in paths.items() for x in (p, k)]), F.col("path")).alias("split")
        parsed = lambda key, kind, only=None: json_array.elements(spark, list(paths.values()), (key,), only).select(split, F.col("at").alias("ord"), F.from_json("text", kind).alias("x")).select("split", "ord", "x.*")
        raw = parsed("categories", _CATEGORY)
        wanted = None
        if categories is not None:  # a few rows of configuration
            wanted = ("annotations", "category_id", [r["id"] for r in raw.filter(F.col("name").isin(*categories)).select("id").distinct().collect()])
        image, ann = parsed("images", _IMAGE), parsed("annotations", _ANNOTATION, wanted)
    else:
        doc = spark.read.schema(f"images array<{_IMAGE}>, annotations array<{_ANNOTATION}>, categories array<{_CATEGORY}>").option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", name).json(root).withColumn("split", F.regexp_extract(F.input_file_name(), r"([^/]+)/[^/]+$", 1))
        doc = doc.filter(F.col("split").isin(*splits))
        image = doc.select("split", F.explode("images").alias("i")).select("split", "i.*")
        ann = doc.select("split", F.posexplode("annotations").alias("ord", "a")).select("split", "ord", "a.*")
        raw = doc.select("split", F.explode("categories").alias("c")).select("split", "c.*")
    ann, cat = ann.select("split", "ord", "image_id", "category_id", "bbox"), raw.select("split", F.col("id").alias("category_id"), "name", "supercategory")
    if categories is not None:
        ann = ann.join(cat.filter(F.col("name").isin(*categories)).select("split", "category_id"), ["split", "category_id"], "left_semi")
    holders = cat.join(cat.select("split", F.col("supercategory").alias("name")).distinct(), ["split", "name"], "left_semi").filter(F.lower("supercategory") == "none").select("split", "category_id")
    names = cat.select("split", "category_id", "name")
    kept = ann.join(holders, ["split", "category_id"], "left_anti").join(names, ["split", "category_id"], "left").withColumn("raw", F.coalesce("name", F.lit("defect"))).filter(~F.lower("raw").isin(*_PLAIN))
    path = F.concat_ws("/", "split", "file_name").alias("image_path")
    images = image.select(path, F.lit(None).cast("string").alias("category"), "split", "width", "height").filter("width > 0 and height > 0")
    b = F.col("bbox")
    found = kept.join(image.select("split", F.col("id").alias("image_id"), "file_name"), ["split", "image_id"]).select(path, "ord", "raw", F.array(b[0], b[1], b[0] + b[2], b[1] + b[3]).alias("box"))
    return assemble(images, found)


def yolo_names(spark: SparkSession, root: str) -> list[str]:
    """The names in data.yaml, data.yml or dataset.yaml: a list or a map by number, in a block or in brackets; none without such a file."""
    found = {r["name"]: r["value"] for r in spark.read.option("pathGlobFilter", "{data.yaml,data.yml,dataset.yaml}").text(root, wholetext=True).select("value", F.regexp_extract(F.input_file_name(), "([^/]+)$", 1).alias("name")).collect()}
    text = next((found[n] for n in ("data.yaml", "data.yml", "dataset.yaml") if n in found), "")
    plain = lambda v: re.sub(r"\s+#.*$", "", v).strip().strip("'\"")
    m = re.search(r"(?m)^names[ \t]*:[ \t]*(?:#.*)?(.*)$((?:\n(?:[ \t]+.*|-.*|[ \t]*))*)", text)
    if not m:
        return []
    if flow := re.match(r"\s*([\[{])(.*?)[\]}]", m[1] + m[2], re.S):
        items = [plain(x) for x in flow[2].split(",") if x.strip()]
        pairs = [x.split(":", 1) for x in items] if flow[1] == "{" else list(enumerate(items))
    else:
        lines = [x.strip() for x in m[2].split("\n") if x.strip() and not x.strip().startswith("#")]
        pairs = [x.split(":", 1) for x in lines] if lines and not lines[0].startswith("-") else list(enumerate(x[1:] for x in lines))
    return [plain(v) for _, v in sorted((int(str(k).strip("' \"")), v) for k, v in pairs)]


def yolo(spark: SparkSession, root: str, names: list[str] | None = None) -> DataFrame:
    """images/ and labels/*.txt of ``class cx cy w h``, relative to the image; lines of under five numbers are skipped. Names are those of ``yolo_names`` unless given."""
    names = yolo_names(spark, root) if names is None else names
    images = sized(files(spark, root)).select(F.col("path").alias("image_path"), F.lit(None).cast("string").alias("category"), F.lit(None).cast("string").alias("split"), "width", "height", _stem(F.col("path")).alias("stem"))
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(root).withColumn("stem", _stem(F.input_file_name()))
    v = F.split(F.trim("value"), r"\s+")
    n = lambda i: F.get(v, i).try_cast("double")
    rows = lines.filter(F.size(v) >= 5).select("stem", F.monotonically_increasing_id().alias("ord"), F.get(v, 0).try_cast("int").alias("cls"), n(1).alias("cx"), n(2).alias("cy"), n(3).alias("bw"), n(4).alias("bh"))
    table = F.array(*map(F.lit, names)) if names else F.array().cast("array<string>")
    joined = rows.join(images, "stem")
    x, y, w, h = F.col("cx") * F.col("width"), F.col("cy") * F.col("height"), F.col("bw") * F.col("width"), F.col("bh") * F.col("height")
    found = joined.select("image_path", "ord", F.coalesce(F.get(table, F.col("cls")), F.concat(F.lit("class_"), F.col("cls").cast("string"))).alias("raw"), F.array(x - w / 2, y - h / 2, x + w / 2, y + h / 2).alias("box"))
    return assemble(images.drop("stem"), found)


def _stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def manifest_csv(spark: SparkSession, path: str, root: str, hints: dict[str, str] | None = None) -> DataFrame:
    """object, split, label, image, mask; a label other than normal is a defect, named by ``hints`` of the object."""
    rows = spark.read.option("header", "true").schema("object string, split string, label string, image string, mask string").csv(path)
    rows = rows.select(*[F.trim(c).alias(c) for c in rows.columns])
    images = rows.select(F.col("image").alias("image_path"), F.col("object").alias("category"), "split")
    images = images.join(sized(files(spark, root)).withColumnRenamed("path", "image_path"), "image_path")
    hint = F.try_element_at(F.create_map(*[F.lit(x) for kv in (hints or {"": ""}).items() for x in kv]), F.col("object"))
    bad = rows.filter(F.lower("label") != "normal").select(F.col("image").alias("image_path"), F.coalesce(hint, F.lit("anomaly")).alias("raw"), F.col("mask").alias("path"))
    return assemble(images, _masked(spark, root, bad))


def _masked(spark: SparkSession, root: str, bad: DataFrame) -> DataFrame:
    """Defects (image_path, raw, path of a mask or null) as the components of their masks; without one, at image level."""
    boxes = imaging.mask_boxes_udf()(F.col("content"))
    masks = files(spark, root, MASKS).join(bad.select("path").filter("path is not null").distinct(), "path", "left_semi").select("path", boxes.alias("b"))
    return _boxed(bad.join(masks, "path", "left"))


def _boxed(bad: DataFrame) -> DataFrame:
    """Defects (image_path, raw, components ``b``) as one for each component; at image level where there are none, or the mask can't be read."""
    joined = bad.select("image_path", "raw", F.posexplode_outer("b").alias("ord", "c"))
    box = F.when(F.col("c").isNotNull(), F.array(*[F.col("c")[k].cast("double") for k in ("x0", "y0", "x1", "y1")]))
    return joined.select("image_path", F.coalesce("ord", F.lit(0)).alias("ord"), "raw", box.alias("box"))


def unread_masks(spark: SparkSession, root: str) -> DataFrame:
    """path of masks and images below ``root`` whose pixels can't be read: broken, interlaced or of another kind."""
    return files(spark, root, MASKS).filter(imaging.mask_boxes_udf()(F.col("content")).isNull()).select("path")


#: Fields of a manifest's items, in the order in which they are tried.
IMAGE_FIELDS, MASK_FIELDS, CLASS_FIELDS, CATEGORY_FIELDS = ("image_path", "image", "img_path", "path"), ("mask_path", "mask"), ("anomaly_class", "label", "class"), ("category", "object")


def _manifest_items(spark: SparkSession, root: str) -> DataFrame:
    """file, split, m: the items of all manifests below ``root``; a manifest without a list has one row without m."""
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(root, wholetext=True).withColumn("file", _stem(F.input_file_name()))
    lists = F.when(F.ltrim("value").startswith("["), F.create_map(F.lit(""), F.col("value"))).otherwise(F.from_json("value", "map<string,string>"))
    found = F.filter(F.transform(F.map_entries(lists), lambda e: F.struct(e["key"].alias("split"), F.when(F.ltrim(e["value"]).startswith("["), F.from_json(e["value"], "array<map<string,string>>")).alias("items"))), lambda e: F.size(e["items"]) > 0)
    return raw.select("file", F.explode_outer(found).alias("e")).select("file", F.col("e.split").alias("split"), F.explode_outer("e.items").alias("m"))


def _manifest_rows(spark: SparkSession, root: str, items: DataFrame) -> DataFrame:
    """file, split, m, field (the one that names the image), image and mask (below ``root``; null if they aren't there), cls, category."""
    first = lambda names: F.coalesce(*[F.nullif(F.try_element_at("m", F.lit(n)), F.lit("")) for n in names])
    rows = items.select("file", F.when(F.col("split").isin("train", "test"), F.col("split")).alias("split"), "m", profile.first_field(F.col("m"), IMAGE_FIELDS).alias("field"), first(IMAGE_FIELDS).alias("image"), first(MASK_FIELDS).alias("mask"),
                        first(CLASS_FIELDS).alias("cls"), F.coalesce(first(CATEGORY_FIELDS), F.col("file")).alias("category"))
    there = files(spark, root).select("path")
    for c in ("image", "mask"):
        direct = there.select(F.col("path").alias(f"{c}_1"))
        below = there.select(F.col("path").alias(f"{c}_2"))
        rows = (rows.join(direct, F.col(c) == F.col(f"{c}_1"), "left").join(below, F.concat_ws("/", "category", c) == F.col(f"{c}_2"), "left")
                .withColumn(c, F.coalesce(f"{c}_1", f"{c}_2")).drop(f"{c}_1", f"{c}_2"))
    return rows


def manifest_profile(spark: SparkSession, root: str) -> DataFrame:
    """Why each manifest below ``root`` gave rows or none (see ``profile.profile``); ``no_items`` if it holds no list of objects."""
    rows = _manifest_rows(spark, root, _manifest_items(spark, root)).join(sized(files(spark, root)).select(F.col("path").alias("image"), "width"), "image", "left")
    judged = rows.select(F.col("file").alias("source"), F.col("m").alias("item"), profile.reason(F.col("field"), F.col("image"), F.col("width")).alias("reason"))
    found = profile.profile(judged.filter("item IS NOT NULL"), IMAGE_FIELDS)
    bare = judged.groupBy("source").agg(F.count("item").alias("n")).filter("n = 0").select("source", F.lit(0).cast("long").alias("n_items"), F.lit(0).cast("long").alias("n_ok"), F.lit("no_items").alias("reason"), F.lit("").alias("fields"), F.lit("").alias("keys"))
    return found.unionByName(bare)


def manifest_json(spark: SparkSession, root: str) -> DataFrame:
    """JSON manifests in several shapes: a list, train and test lists, or any key that holds a list of objects.

    Fields are the first of several names that is filled; a path is tried as it is and below the manifest's category.
    """
    rows = _manifest_rows(spark, root, _manifest_items(spark, root))
    rows = rows.filter("image is not null")
    images = rows.select(F.col("image").alias("image_path"), "category", "split").join(sized(files(spark, root)).withColumnRenamed("path", "image_path"), "image_path")
    cls = F.lower(F.coalesce("cls", F.lit("")))
    bad = rows.filter(~cls.isin("ok", "good", "normal", "0", "")).select(F.col("image").alias("image_path"), F.col("cls").alias("raw"), F.col("mask").alias("path"))
    return assemble(images, _masked(spark, root, bad))


def directories(spark: SparkSession, root: str, names: dict[str, str] | None = None) -> DataFrame:
    """<category>/<split>/<defect>/*.png with masks <category>/ground_truth/<defect>/<stem>[_mask].png or <stem>/<k>.png."""
    part = lambda k: F.regexp_extract("path", r"^([^/]+)/(train|test|validation)/([^/]+)/([^/]+)\.[^./]+$", k)
    images = sized(files(spark, root)).withColumns({"category": part(1), "split": part(2), "kind": part(3), "stem": part(4)}).filter("kind <> ''").withColumnRenamed("path", "image_path")
    mask = lambda k: F.regexp_extract("path", r"^([^/]+)/ground_truth/([^/]+)/([^/]+?)(_mask)?(?:/([^/]+))?\.[^./]+$", k)
    boxes = imaging.mask_boxes_udf()(F.col("content"))
    masks = files(spark, root, MASKS).select("path", boxes.alias("b"), mask(1).alias("category"), mask(2).alias("kind"), mask(3).alias("stem"), mask(4).alias("suffix"), mask(5).alias("part")).filter("kind <> ''")
    # Of several files for one mask the first that can be read.
    single = rank_first(masks.filter("part = ''"), ["category", "kind", "stem"], [F.col("b").isNull(), F.desc("suffix"), "path"])
    every = single.unionByName(masks.filter("part <> ''")).select("category", "kind", "stem", "b")
    name = F.try_element_at(F.create_map(*[F.lit(x) for kv in (names or {"": ""}).items() for x in kv]), F.col("stem"))
    bad = images.filter(~F.lower("kind").isin(*NORMAL)).join(every, ["category", "kind", "stem"], "left").select("image_path", F.coalesce(name, F.col("kind")).alias("raw"), "b")
    return assemble(images.drop("kind", "stem"), _boxed(bad))


def masks(spark: SparkSession, root: str, class_map: dict[int, str], images: str = "images", labels: str = "masks", background: tuple[int, ...] = (0,), grade_type: str | None = None) -> DataFrame:
    """<images>/<stem> with <labels>/<stem>.png whose values are classes; a class without a name becomes class_<value>, those in ``background`` are no defects.

    With ``grade_type`` the names are grades of that type: "good" is one of corrosion then, and not the name of what is no defect.
    """
    found = sized(files(spark, root)).filter(F.col("path").startswith(images + "/")).select(F.col("path").alias("image_path"), F.lit(None).cast("string").alias("category"), F.lit(None).cast("string").alias("split"), "width", "height", _stem(F.col("path")).alias("stem"))
    boxes = imaging.mask_boxes_udf(background)(F.col("content"))
    comps = files(spark, root, MASKS).filter(F.col("path").startswith(labels + "/")).select(_stem(F.col("path")).alias("stem"), F.posexplode(boxes).alias("ord", "c"))
    name = F.try_element_at(F.create_map(*[F.lit(x) for kv in (class_map or {-1: ""}).items() for x in kv]), F.col("c.cls"))
    defects = found.join(comps, "stem").select("image_path", "ord", F.coalesce(name, F.concat(F.lit("class_"), F.col("c.cls").cast("string"))).alias("raw"), F.array(*[F.col("c")[k].cast("double") for k in ("x0", "y0", "x1", "y1")]).alias("box"))
    return assemble(found.drop("stem"), defects.withColumn("as_type", F.lit(grade_type)) if grade_type else defects)


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank and torn lines are dropped, unknown keys ignored."""
    rows = spark.read.schema(schema + ", _torn string").option("columnNameOfCorruptRecord", "_torn").json(path)
    return rows.filter("_torn is null").drop("_torn")


#: Readers by key.
REGISTRY: dict[str, Callable[..., DataFrame]] = {"coco": coco, "yolo": yolo, "csv": manifest_csv, "json": manifest_json, "directories": directories, "masks": masks, "jsonl": jsonl}


def read(spark: SparkSession, kind: str, **options) -> DataFrame:
    """KeyError for an unknown kind."""
    return REGISTRY[kind](spark, **options)
