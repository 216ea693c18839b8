"""The shared taxonomy as small tables, and the mapping of raw names onto it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstack.functions import constants as K
from loamstack.functions.text import norm_key

# Type, Chinese name, group, default severity, whether the area changes the severity, aliases.
DEFECTS = (
    ("fastener_missing", "紧固件缺失", "fastener", "major", False,
     ("missing-head", "missing_head", "missing", "missing_screw", "missing_pushpin", "missing_bolt", "missing_rivet", "missing_nut", "missing_washer", "absent", "missing_connector", "missing_cable", "missing_separator", "lost_head")),
    ("fastener_loose", "紧固件松动", "fastener", "major", False,
     ("loose", "loosened", "looseness", "bolt_loose", "rotation", "rotated", "backed_out", "protruding", "proud_head", "lifted")),
    ("thread_damage", "螺纹损伤", "fastener", "major", False,
     ("thread_side", "thread_top", "thread", "stripped_thread", "manipulated_front", "front_bent", "deformed_thread")),
    ("fastener_wrong_spec", "紧固件规格不符", "fastener", "major", False,
     ("screw_too_long", "screw_too_short", "1_very_short_screw", "wrong_screw", "mismatch", "wrong_part", "swapped")),
    ("fastener_damage", "紧固件损伤", "fastener", "major", False,
     ("fastener_damage", "damaged_fastener", "fastener_defect", "fastener_fault", "screw_damage", "bolt_damage", "rivet_damage", "head_damage", "damaged_head")),
    ("corrosion", "腐蚀锈蚀", "surface", "major", True,
     ("corrosion", "rust", "rusty", "oxidation", "oxidized", "pitting", "pit", "pitted", "crazing", "rolled-in_scale", "severe", "poor", "fair", "corroded")),
    ("crack", "裂纹", "structure", "critical", False,
     ("crack", "cracked", "cracks", "crazing_crack", "fracture", "fissure", "rupture")),
    ("dent", "凹坑", "structure", "major", True,
     ("dent", "dented", "dint", "depression", "deformation", "bent", "deformed", "bend", "ak", "bx")),
    ("scratch", "划伤", "surface", "minor", True,
     ("scratch", "scratches", "scratch_head", "scratch_neck", "scratched", "scuff", "abrasion", "gouge", "nick", "hs", "ch")),
    ("paint_peeling", "漆层剥落", "surface", "minor", True,
     ("paint-peel-off", "paint_peel_off", "peel", "peeling", "flaking", "flake", "coating_loss", "blister", "patches")),
    ("breakage", "断裂破损", "structure", "critical", False,
     ("broken", "break", "part_broken", "bag_broken", "broken_cable", "hole", "puncture", "tear", "torn")),
    ("contamination", "污染异物", "surface", "minor", True,
     ("contamination", "contaminated", "foreign_object", "fod", "stain", "dirt", "grease", "leak", "oil_leak", "spot", "inclusion", "spots", "color", "discoloration", "discolored", "zw", "yw")),
    ("misalignment", "错位不齐", "structure", "major", False,
     ("misplaced", "misaligned", "wrong_cable_location", "shift", "offset", "wrong_position", "tilted", "flip", "flipped", "upside_down", "reversed", "wrong_orientation")),
    ("extra_part", "多余件", "structure", "major", False,
     ("extra_cable", "1_additional_pushpin", "additional", "redundant", "duplicate")),
    ("part_missing", "零件缺失", "structure", "major", False,
     ("qs", "missing_part", "part_missing", "component_missing", "absent_part")),
    ("other_anomaly", "异常", "other", "minor", True,
     ("anomaly", "defect", "damage", "bad", "abnormal", "combined", "misc")),
)
# Object, Chinese name, role, context.
OBJECTS = (
    ("screw", "螺钉", "fastener", "蒙皮壁板紧固螺钉"), ("bolt", "螺栓", "fastener", "结构连接螺栓"), ("nut", "螺母", "fastener", "结构连接螺母"),
    ("rivet", "铆钉", "fastener", "蒙皮铆接铆钉"), ("washer", "垫圈", "fastener", "紧固垫圈"), ("screw_bag", "紧固件组件", "fastener_kit", "紧固件套件清点"),
    ("fuselage", "机身蒙皮", "structure", "机身蒙皮壁板"), ("panel", "检查口盖", "structure", "可卸口盖壁板"), ("wing", "机翼", "structure", "机翼外表面"),
    ("pcb", "电路板", "avionics", "航电模块电路板"), ("metal_part", "金属零件", "structure", "金属结构件"), ("unknown", "待检部件", "unknown", "待检部件"),
)
# Types that look alike, and the types that a part of each role can show.
CONFUSABLE = (
    ("scratch", "crack"), ("corrosion", "paint_peeling"), ("fastener_missing", "fastener_loose"), ("dent", "corrosion"), ("thread_damage", "fastener_wrong_spec"), ("breakage", "crack"),
)
PART_DEFECTS = {
    "fastener": ("fastener_missing", "fastener_loose", "thread_damage", "fastener_wrong_spec", "corrosion", "scratch", "breakage"),
    "fastener_kit": ("fastener_missing", "fastener_wrong_spec", "extra_part", "corrosion", "thread_damage"),
    "structure": ("fastener_missing", "fastener_loose", "crack", "dent", "corrosion", "scratch", "paint_peeling", "breakage", "misalignment"),
    "avionics": ("fastener_missing", "misalignment", "extra_part", "corrosion", "breakage", "contamination"),
}
# Grades of corrosion in order, Chinese names, severities.
GRADES = (("good", "轻微锈蚀", "minor"), ("fair", "点蚀起皮", "major"), ("poor", "层状剥落", "major"), ("severe", "截面损失", "critical"))
#: What is to be done about each type, and about each grade of corrosion: example sentences, replaced by a user's own tables.
ACTIONS = {
    "fastener_missing": "补上规格一致的紧固件，并查看孔边有无损坏", "fastener_loose": "重新拧紧并画上防松标记", "thread_damage": "换新紧固件，同时查看配合孔的螺纹",
    "fastener_wrong_spec": "核对规格后换上正确的紧固件", "fastener_damage": "判断能否继续使用，不能则换新", "corrosion": "清除锈迹，测量余厚后重新做防护",
    "crack": "暂停使用此处，进一步检测裂纹长度", "dent": "测量深度和直径，再决定修整还是换件", "scratch": "磨平划痕并恢复保护层",
    "paint_peeling": "去掉松动的漆皮后补漆", "breakage": "换新零件，并查看周围是否受损", "contamination": "清洁表面并查明来源",
    "misalignment": "调回正确位置后重新固定", "extra_part": "取走多出的零件，回查装配步骤", "part_missing": "按清单查出所缺零件并补装", "other_anomaly": "记录下来，请专业人员判断",
}
GRADE_ACTIONS = {"good": "清洁后登记，下次检查时复看", "fair": "除去锈点，测量坑深后补涂保护层", "poor": "除锈后测量余厚，再决定是否加强", "severe": "暂停使用此处，测量剩余截面后决定换件"}
OTHER = "other_anomaly"


def defect_dim(spark: SparkSession) -> DataFrame:
    rows = [(i, *d[:5]) for i, d in enumerate(DEFECTS)]
    return spark.createDataFrame(rows, "ord int, type string, zh string, grp string, severity string, area_scales boolean")


def alias_dim(spark: SparkSession) -> DataFrame:
    """alias key, type, ord; a name that two types have goes to the later one."""
    names = [(n, d[0]) for d in DEFECTS for n in (d[0], *d[5])]
    rows = [(n, t, i) for i, (n, t) in enumerate(names)]
    keyed = spark.createDataFrame(rows, "name string, type string, ord int").withColumn("alias", norm_key(F.col("name")))
    return keyed.groupBy("alias").agg(F.max_by("type", "ord").alias("type"), F.min("ord").alias("ord"))


def object_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *o) for i, o in enumerate(OBJECTS)], "ord int, object string, zh string, role string, ctx string")


def _map_names(names: DataFrame, col: str, dim: DataFrame, key: str, value: str, least: int, default: str) -> DataFrame:
    """Exact key first, then the longest key of ``least`` signs or more inside the name. ``dim`` is a fixed table of under 200 rows.

    Names are made distinct before the substring join, so it is bounded by the number of distinct raw names.
    """
    keyed = names.select(col).distinct().withColumn("_key", norm_key(F.coalesce(F.col(col), F.lit(""))))
    dim = dim.select(F.col(key).alias("_k"), F.col(value).alias("_v"), "ord")
    hit = (F.col("_key") == F.col("_k")) | ((F.length("_k") >= least) & F.contains("_key", "_k"))
    joined = keyed.join(F.broadcast(dim), hit & (F.col("_key") != ""), "left")
    rank = F.struct((F.col("_key") == F.col("_k")).alias("exact"), F.length("_k").alias("n"), (-F.col("ord")).alias("o"))
    return joined.groupBy(col).agg(F.coalesce(F.max_by("_v", F.when(F.col("_k").isNotNull(), rank)), F.lit(default)).alias(value))


def map_defects(names: DataFrame, col: str) -> DataFrame:
    """``col`` and type, a row for each distinct raw name."""
    return _map_names(names, col, alias_dim(names.sparkSession), "alias", "type", 4, OTHER)


def map_objects(names: DataFrame, col: str) -> DataFrame:
    return _map_names(names, col, object_dim(names.sparkSession), "object", "object", 3, "unknown")


def with_objects(df: DataFrame, col: str = "category", hints: dict[str, str] | None = None) -> DataFrame:
    """``df`` with object, object_zh, role and ctx, mapped from the names in ``col``; ``hints`` names the object of some; names without an object are ``unknown``."""
    dim = object_dim(df.sparkSession).select("object", F.col("zh").alias("object_zh"), "role", "ctx")
    mapped = map_objects(df.select(F.col(col).alias("_name")), "_name")
    if hints:
        hint = K.look(hints, F.col("_name"))
        mapped = mapped.select("_name", F.coalesce(hint, "object").alias("object"))
    known = mapped.join(F.broadcast(dim), "object")
    return df.join(known, F.col(col).eqNullSafe(F.col("_name"))).drop("_name")


def siblings(spark: SparkSession) -> DataFrame:
    """type, sibling: other types of the same group."""
    d = defect_dim(spark)
    return d.select("type", "grp").join(d.select(F.col("type").alias("sibling"), "grp"), "grp").filter("type <> sibling").select("type", "sibling")


def action(type_: Column, grade: Column, actions: dict[str, str] | None = None, grade_actions: dict[str, str] | None = None) -> Column:
    """What is to be done: by the grade if it is one of corrosion, else by the type; unknown types as the general anomaly."""
    actions, grade_actions = actions or ACTIONS, grade_actions or GRADE_ACTIONS
    return F.coalesce(F.when(type_ == "corrosion", K.look(grade_actions, grade)), K.look(actions, type_), F.lit(actions[OTHER]))
