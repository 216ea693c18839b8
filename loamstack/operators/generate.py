"""Question and answer records from samples, in projections: which tasks a sample gets first, then the text of those alone.

For each sample every task that applies is drawn in an order of its own, taken with its weight, and the first four
that give a record stay. Draws are MD5 numbers of seed, sample and task, so records don't depend on partitioning.
Each field of a record is a column of its own, so fields that nobody selects are not worked out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamstack.functions import constants as K
from loamstack.functions import draws
from loamstack.functions import geometry as G
from loamstack.functions import text as X
from loamstack.operators import options as O
from loamstack.operators import questions as Q
from loamstack.operators.split import written
from loamstack.operators.taxonomy import DEFECTS, GRADES, OTHER, action, with_objects

MOST = 4
# The weight with which each task is taken, and its share of the quota.
WEIGHTS = {
    "grounding_single": 1.0, "grounding_all": 0.8, "grounding_negative": 1.0, "grounding_counterfactual": 1.0, "referring_region": 0.6, "counting": 0.45, "region_word": 0.4, "discrimination": 0.9,
    "classification_open": 0.7, "classification_mc": 0.7, "description": 0.8, "severity_action": 0.6, "object_recognition": 0.25, "grade_assessment": 0.9, "uncertainty": 1.0, "multi_turn": 0.5, "pair_compare": 0.8,
}
RATIO = {
    "discrimination": 0.14, "classification_open": 0.10, "classification_mc": 0.08, "grounding_single": 0.13, "grounding_all": 0.10, "grounding_negative": 0.06, "grounding_counterfactual": 0.08, "referring_region": 0.05,
    "region_word": 0.02, "counting": 0.03, "multi_turn": 0.08, "pair_compare": 0.04, "uncertainty": 0.04, "description": 0.05, "severity_action": 0.03, "object_recognition": 0.01,
}
FORMATS = {t: "text" for t in WEIGHTS} | {"grounding_single": "json_only", "grounding_all": "json_only", "grounding_negative": "json_only", "grounding_counterfactual": "json_only", "counting": "text_then_json", "multi_turn": "dialog"}
SYSTEMS = {
    "json_only": "你负责在检查照片中定位缺陷，只输出 JSON 数组，坐标为 0 到 1000 的整数；没有目标时输出 []。",
    "text": "你负责描述检查照片，只说图中看得到的事实；看不清时直说并建议补拍。",
    "text_then_json": "你先用一句话给出数量，再另起一行输出 JSON 数组，坐标为 0 到 1000 的整数。",
    "dialog": "你围绕同一张检查照片连续回答；需要位置时输出 JSON 数组，坐标为 0 到 1000 的整数。",
}
#: Question templates of each task; {defect}, {obj} and {box} are filled in.
QUESTIONS = {
    "grounding_single": ("请定位图中的{defect}。", "图中{obj}上的{defect}在哪里？"), "grounding_all": ("请列出图中全部异常的位置。", "请找出{obj}上的所有缺陷。"), "grounding_negative": ("请找出{obj}上的所有缺陷。", "请列出图中全部异常的位置。"),
    "grounding_counterfactual": ("请定位图中的{defect}。", "请给出{obj}上{defect}的边界框。"), "referring_region": ("区域 {box} 内是否有异常？", "请判断 {box} 处的状况。"), "counting": ("图中有几处{defect}？", "请清点{obj}上的{defect}。"),
    "region_word": ("{defect}位于画面的什么方位？", "请说明{defect}所在的方位。"), "discrimination": ("这张图是否有异常？", "请判断{obj}是否合格。"), "classification_open": ("图中的缺陷属于哪一类？", "请说明{obj}上的缺陷类型。", "画面{region}的缺陷属于哪一类？", "请说明{obj}{region}处的缺陷类型。"),
    "classification_mc": ("图中的缺陷是哪一种？", "请选出图中缺陷的类型。"), "description": ("请写一段检查记录。", "请描述{obj}的状况。"), "severity_action": ("请评估缺陷的严重程度。", "缺陷有多严重？应如何处理？", "请评估{defect}的严重程度。", "画面{region}的{defect}有多严重？应如何处理？"),
    "object_recognition": ("图中是什么部件？", "请指出被检部件。"), "grade_assessment": ("请评定锈蚀等级。", "图中锈蚀到了哪一级？"), "uncertainty": ("图中是否有{defect}？", "请确认{obj}上有没有{defect}。"),
    "multi_turn": ("请看这张检查照片，有异常吗？", "这张图里有问题吗？"), "pair_compare": ("对比两张图，第二张有什么不同？", "以第一张为参考，第二张有何差异？"),
}
NAMES = {d[0]: d[1] for d in DEFECTS}
CAUSES = {"blur": "画面模糊", "occlusion": "目标被遮挡", "overexposure": "画面过曝", "darkness": "画面过暗"}
SEVERITY_NAMES = {"minor": "轻微", "major": "中等", "critical": "严重"}
GRADE_NAMES = {g: (zh, i) for i, (g, zh, _) in enumerate(GRADES)}

#: Tasks whose questions name what is asked if a picture shows several types, and the marks of such questions.
NAMED = {"classification_open": ("{region}",), "severity_action": ("{defect}", "{region}")}
# Types that a degraded picture is asked about, defects that a comparison lists, the share of answers with an advice.
ASKED_IF_DEGRADED, MOST_COMPARED, ADVICE_RATE = 3, 4, 0.5
ADVICE = ("最终结论以现场复核为准。", "处理前请由检验人员确认。", "图片判断仅供参考。")
#: Tasks whose records can lack a region or options.
LATE = ("referring_region", "classification_mc")
#: Numbers of the tries for a clean box: thirty next to a defect, thirty anywhere.
TRIES = ((0, 3), (4, 11), (12, 29), (30, 59))
#: Questions of a bank that become part of the plan.
MOST_QUESTIONS = 20_000

_KINDS = {
    "question": "string", "answer": "string", "yes_no": "string", "answer_letter": "string", "options": "array<string>", "n_boxes": "int", "region": "string", "variant": "string", "target_type": "string",
    "severity": "string", "grade": "string", "asked": "array<string>", "said": "array<string>", "turns": "array<struct<question:string,answer:string>>", "images": "array<string>",
}


def _words(zh: Column, region: Column) -> Column:
    return F.concat(zh, F.lit("位于画面"), region)


def described(type_: Column, box: Column, ratio: Column, w: int, h: int) -> Column:
    """A defect of a sample from its type, box and share of the picture. In a projection of plain rows it is compiled, in an array's lambda interpreted."""
    severities = {d[0]: d[3] for d in DEFECTS}
    scaled = [d[0] for d in DEFECTS if d[4]]
    base, zh, region = K.look(severities, type_), O.named(type_), G.region_word(box, F.lit(w), F.lit(h))
    grade = F.when(type_ == "corrosion", F.get(K.array([g[0] for g in GRADES]), (box[0] % 4).cast("int")))
    return F.struct(type_.alias("type"), zh.alias("zh"), box.alias("bbox"), F.round(ratio, 6).alias("area_ratio"), F.when(type_.isin(scaled), G.severity_from_area(base, ratio)).otherwise(base).alias("severity"),
                    region.alias("region"), grade.alias("grade"), X.box_json(G.norm_text(box, F.lit(w), F.lit(h)), zh).alias("json"), _words(zh, region).alias("place"))


def samples(rows: DataFrame, w: int, h: int) -> DataFrame:
    """Rows of image, degradation, dataset, category and raw defects (type, bbox) as samples; objects are mapped from the category unless rows have them.

    Rows with ``defects`` (see ``described``) need no raw ones.
    """
    rows = rows if "object_zh" in rows.columns else with_objects(rows)
    made = "defects" in rows.columns
    if made:
        defects = F.col("defects")
    else:
        sized = F.transform("raw", lambda d: F.struct(d.alias("d"), G.area_ratio(d["bbox"], F.lit(w), F.lit(h)).alias("ratio")))  # read several times, worked out once
        defects = F.transform(sized, lambda x: described(x["d"]["type"], x["d"]["bbox"], x["ratio"], w, h))
    defects = F.coalesce(defects, F.array().cast("array<struct<type:string,zh:string,bbox:array<int>,area_ratio:double,severity:string,region:string,grade:string,json:string,place:string>>"))
    image = F.concat(F.lit("/data/"), F.col("image").cast("string"), F.lit(".jpg"))
    label = F.when(F.size("defects" if made else "raw") > 0, "anomalous").otherwise("normal")  # not of the defects, which a filter on it would work out again
    return rows.select(F.col("image").alias("sample_id"), image.alias("image"), F.lit(w).alias("width"), F.lit(h).alias("height"), "dataset", "category", "degradation", "object", "object_zh", "role", "ctx",
                       defects.alias("defects"), label.alias("label"))


def scoped(df: DataFrame, active: list[str]) -> DataFrame:
    """Types outside ``active`` become the general anomaly."""
    other = F.lit(NAMES[OTHER])
    general = lambda d: d.withField("type", F.lit(OTHER)).withField("zh", other).withField("json", X.box_json(G.norm_text(d["bbox"], F.col("width"), F.col("height")), other)).withField("place", _words(other, d["region"]))
    changed = F.transform("defects", lambda d: F.when(d["type"].isin(active), d).otherwise(general(d)))
    # Most pictures have none of them, which is told without a lambda.
    outside = F.size(F.array_except(F.col("defects")["type"], K.array(active))) > 0
    return df.withColumn("defects", F.when(outside, changed).otherwise(F.col("defects")))


def _with_words(df: DataFrame) -> DataFrame:
    """Defects that were not made by ``described`` get their JSON and their place in words."""
    if {"json", "place"} <= set(df.schema["defects"].dataType.elementType.names):
        return df
    return df.withColumn("defects", F.transform("defects", lambda d: d.withField("json", X.box_json(G.norm_text(d["bbox"], F.col("width"), F.col("height")), d["zh"])).withField("place", _words(d["zh"], d["region"]))))


def with_references(df: DataFrame, least: int = 3) -> DataFrame:
    """Adds ``reference``: another, normal image of the same dataset and category, if there are ``least`` of them.

    References are ranked within hash buckets of their group, and samples are joined to one drawn rank of one bucket; a
    normal sample skips its own rank, or the bucket that holds nothing else.
    """
    from pyspark.sql import Window as W

    group = ["dataset", "category"]
    every = written(df.select("sample_id", *group, "image", "label"), "labels")  # read four times, made once
    normal = every.filter("label = 'normal'").select("sample_id", *group, F.col("image").alias("reference")).withColumn("_b", (draws.number("ref0", F.col("sample_id")) % 64).cast("int"))
    rank = F.row_number().over(W.partitionBy(*group, "_b").orderBy("reference"))
    pool = normal.withColumn("_place", rank)
    sizes = pool.groupBy(*group, "_b").agg(F.max("_place").alias("n"))
    known = sizes.groupBy(*group).agg(F.sum("n").alias("_all"), F.array_sort(F.collect_list(F.struct("_b", "n"))).alias("_buckets")).filter(F.col("_all") >= least)
    own = pool.select("sample_id", *group, F.col("_b").alias("_own_b"), F.col("_place").alias("_own"))
    others = every.filter("label <> 'normal'").select("sample_id", *group, F.lit(None).cast("int").alias("_own_b"), F.lit(None).cast("int").alias("_own"))
    # Each bucket with the one after it: a sample is joined to the drawn one and doesn't carry the list of all.
    buckets = known.select(*group, F.size("_buckets").alias("_size"), "_buckets", F.posexplode("_buckets").alias("_at", "_x")).withColumn("_after", F.get("_buckets", F.try_mod(F.col("_at") + 1, F.col("_size"))))
    asked = others.unionByName(own).join(known.select(*group, F.size("_buckets").alias("_size")), group)
    at = (draws.number("ref", F.col("sample_id")) % F.col("_size")).cast("int")
    alone = lambda x: F.coalesce((x["_b"] == F.col("_own_b")) & (x["n"] == 1), F.lit(False))
    drawn = asked.withColumn("_at", at).join(buckets.drop("_size", "_buckets"), [*group, "_at"])
    drawn = drawn.withColumn("_x", F.when(alone(F.col("_x")), F.col("_after")).otherwise(F.col("_x")))
    mine = F.coalesce(F.col("_x._b") == F.col("_own_b"), F.lit(False))
    place = (draws.number("ref2", F.col("sample_id")) % (F.col("_x.n") - mine.cast("int")) + 1).cast("int")
    drawn = drawn.select("sample_id", *group, F.col("_x._b").alias("_b"), place.alias("_p"), mine.alias("_mine"), "_own")
    drawn = drawn.select("sample_id", *group, "_b", (F.col("_p") + (F.col("_mine") & (F.col("_p") >= F.col("_own"))).cast("int")).alias("_place"))
    found = drawn.join(pool.drop("sample_id"), [*group, "_b", "_place"]).select("sample_id", "reference")
    # What follows costs far more than the bytes of a sample tell: by them the planner makes about one task for each core, and one more needs a second round.
    return df.repartition(_tasks(df), "sample_id").join(found, "sample_id", "left")


def _tasks(df: DataFrame) -> int:
    """Four for each core, or as many as the session has shuffle partitions."""
    spark = df.sparkSession
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def pools(bank: DataFrame | None) -> dict[str, list[str]]:
    """Questions of each task: its templates, then those of ``bank`` (task, question, ord) in its language, each once. A bank is configuration."""
    found = {t: list(q) for t, q in QUESTIONS.items()}
    if bank is not None:
        rows = Q.in_language(bank.filter(F.col("task").isin(*found))).orderBy("task", "ord", "question").limit(MOST_QUESTIONS + 1).collect()
        if len(rows) > MOST_QUESTIONS:
            raise ValueError(f"a bank of more than {MOST_QUESTIONS} questions")
        for r in rows:
            if r["question"] not in found[r["task"]]:
                found[r["task"]].append(r["question"])
    return found


class _Builder:
    """The columns of a sample as the tasks see them."""

    def __init__(self, seed: int, active: list[str], has_reference: bool, questions: dict[str, list[str]], weights: dict[str, float], on: list[str]):
        self.seed, self.id, self.questions, self.weights, self.on = seed, F.col("sample_id"), questions, weights, on
        self.defects, self.w, self.h = F.col("defects"), F.col("width"), F.col("height")
        self.first = F.get(self.defects, 0)
        self.anomalous, self.degraded = F.col("label") == "anomalous", F.col("degradation").isNotNull()
        # Worked out once for each sample, see drawn().
        self.types, self.absent, self.hit, self.kind, self.away, self.any_box, self.near, self.region_box, self.options, self.doubtful, self.top = (F.col(c) for c in ("_types", "_absent", "_hit", "_kind", "_away", "_any_box", "_near", "_region_box", "_options", "_doubtful", "_top"))
        self.known = self.anomalous & (self.first["type"] != OTHER)
        self.reference = F.col("reference") if has_reference else F.lit(None).cast("string")

    def below(self, share: float, name: str) -> Column:
        return draws.below(share, self.seed, self.id, F.lit(name))

    def pick(self, values: Column, name: str) -> Column:
        return draws.pick(values, self.seed, self.id, F.lit(name))

    def question(self, task: str, defect: Column | None = None, box: Column | None = None, region: Column | None = None, draw: str = "") -> Column:
        every = self.questions[task]
        pool = K.array(every)
        if task in NAMED:
            named = [q for q in every if any(m in q for m in NAMED[task])]
            pool = F.when(F.size(self.types) > 1, K.array(named or every)).otherwise(K.array([q for q in every if q not in set(named)] or every))
        empty = F.lit("")
        return X.fill(self.pick(pool, "q" + task + draw), {"obj": F.col("object_zh"), "ctx": F.col("ctx"), "defect": empty if defect is None else defect, "box": empty if box is None else box, "region": empty if region is None else region})

    def advice(self, name: str) -> Column:
        """A sentence of advice, or nothing."""
        return F.when(self.below(ADVICE_RATE, "advise" + name), self.pick(K.array(ADVICE), "advice" + name)).otherwise("")

    def doubtful_types(self) -> Column:
        """The types that a degraded picture is asked about: those that it shows come first."""
        shown = F.filter(self.types, lambda t: t != OTHER)
        others = F.transform(F.sort_array(F.transform(self.absent, lambda t: F.struct(draws.key(self.seed, self.id, F.lit("doubt"), t).alias("h"), t.alias("t")))), lambda x: x["t"])
        return F.slice(F.concat(shown, others), 1, ASKED_IF_DEGRADED)

    def top_defect(self) -> Column:
        """The most severe grade is judged if there is one, else the largest defect."""
        grades = {g: i for g, (_, i) in GRADE_NAMES.items()}
        return F.array_max(F.transform(self.defects, lambda x, i: F.struct(F.coalesce(K.look(grades, x["grade"]), F.lit(-1)).alias("rank"), F.when(x["grade"].isNull(), x["area_ratio"]).otherwise(0.0).alias("a"), (-i).alias("i"),
                                                                           x["zh"].alias("zh"), x["severity"].alias("severity"), x["type"].alias("type"), x["grade"].alias("grade"), x["region"].alias("region"))))

    def json(self, defects: Column) -> Column:
        return X.json_list(defects["json"])

    def of(self, kind: Column) -> Column:
        return F.filter(self.defects, lambda d: d["type"] == kind)

    def taken(self, task: str) -> Column:
        """Whether the task is on and drawn; degraded pictures have none of these."""
        return ~self.degraded & self.below(self.weights[task], "take" + task) if task in self.on else F.lit(False)

    def place(self, task: str) -> Column:
        """The task's place among those of the sample."""
        return draws.key(self.seed, self.id, F.lit("order" + task))

    def wanted(self, task: str) -> Column:
        """Whether the task is taken and comes early enough to be chosen, whether or not later ones are there."""
        return self.taken(task) & (self.place(task) <= F.col("_last"))

    @staticmethod
    def record(when: Column, question: Column, answer: Column, **extra: Column) -> tuple[Column, dict[str, Column]]:
        """Whether there is a record, and its fields."""
        return F.coalesce(when, F.lit(False)), {"question": question, "answer": answer, **extra}

    def beside(self) -> Column:
        """Where boxes are tried first, and their size: that of a drawn defect; without defects a sixth of each side."""
        return F.coalesce(self.pick(self.defects, "near")["bbox"], F.array(F.lit(0), F.lit(0), (self.w / 6).cast("int"), (self.h / 6).cast("int")))

    def clean_box(self) -> Column:
        """A box that meets no defect: thirty tries next to one, then thirty anywhere. Most pictures need few of them, so later ones wait for the earlier."""
        x0, y0, bw, bh = (self.near[k] for k in ("x", "y", "w", "h"))

        def corner(i: Column, close: bool) -> Column:
            u = lambda k: draws.uniform(self.seed, self.id, F.lit(k), i)
            x = (x0 + (u("x") * 4 - 2) * bw if close else u("x") * (self.w - bw)).cast("int")
            y = (y0 + (u("y") * 4 - 2) * bh if close else u("y") * (self.h - bh)).cast("int")
            return F.struct(x.alias("x"), y.alias("y"))

        box = lambda c: F.array(c["x"], c["y"], c["x"] + bw, c["y"] + bh)
        fits = lambda b: (b[0] >= 0) & (b[1] >= 0) & (b[2] <= self.w) & (b[3] <= self.h) & F.forall(self.defects, lambda d: ~G.meets(b, d["bbox"]))
        first = lambda a, b: F.get(F.filter(F.transform(F.transform(F.sequence(F.lit(a), F.lit(b)), lambda i: corner(i, b < 30)), box), fits), 0)
        return F.coalesce(*[first(a, b) for a, b in TRIES])

    def shown(self, df: DataFrame, active: list[str]) -> DataFrame:
        """``df`` with what several tasks share: types, absent types, one of each, a box."""
        types = F.array_distinct(self.defects["type"])
        df = df.withColumn("_types", types).withColumn("_absent", F.array_except(K.array(active), F.concat(self.types, F.array(F.lit(OTHER)))))
        return df.withColumns({"_hit": self.anomalous & self.below(0.55, "hit"), "_kind": self.pick(self.types, "kind"), "_away": self.pick(self.absent, "away"), "_any_box": self.pick(self.defects, "box"),
                               "_doubtful": F.when(self.degraded, self.doubtful_types())})

    def drawn(self, df: DataFrame, active: list[str]) -> DataFrame:
        """``df`` with what only one task needs and costs most: a region, the options, the top defect. Left out where the task can't be chosen, by ``_last``."""
        df = df.withColumns({"_options": F.when(self.anomalous & self.wanted("classification_mc"), O.options(self.types, F.col("role"), active, self.seed, self.id)),
                             "_top": F.when(self.anomalous & self.wanted("severity_action"), self.top_defect()), "_near": F.when(self.wanted("referring_region"), self.beside())})
        size = lambda i: F.greatest(F.lit(8), self.near[i + 2] - self.near[i])
        df = df.withColumn("_near", F.when(self.near.isNotNull(), F.struct(self.near[0].alias("x"), self.near[1].alias("y"), size(0).alias("w"), size(1).alias("h"))))
        return df.withColumn("_region_box", F.when(self.near.isNotNull(), F.when(self.hit, self.any_box["bbox"]).otherwise(self.clean_box())))

    def tasks(self) -> dict[str, tuple[Column, dict[str, Column]]]:
        d, first, none = self.defects, self.first, F.array().cast("array<string>")
        kind, away, any_box, region_box, options = self.kind, self.away, self.any_box, self.region_box, self.options
        kind_zh, away_zh = K.look(NAMES, kind), K.look(NAMES, away)
        hit, top = self.hit, self.top
        box_words = X.box_text(G.norm_box(region_box, self.w, self.h))
        zero = self.below(0.25, "zero") & away.isNotNull()
        mine = F.when(zero, none.cast("array<string>")).otherwise(F.array(kind))
        counted = F.when(zero, F.slice(d, 1, 0)).otherwise(self.of(kind))
        worst = F.array_max(F.transform(d, lambda x, i: F.struct(x["area_ratio"].alias("a"), (-i).alias("i"), x["zh"].alias("zh"), x["severity"].alias("severity"), x["type"].alias("type"), x["grade"].alias("grade"))))
        grades = {g: i for g, (_, i) in GRADE_NAMES.items()}
        graded = F.array_max(F.transform(F.filter(d, lambda x: x["grade"].isNotNull()), lambda x: F.struct(K.look(grades, x["grade"]).alias("rank"), x["grade"].alias("grade"))))
        letter, listed = O.letter(options, first["zh"]), O.listed(options)
        grade_zh = {g: zh for g, (zh, _) in GRADE_NAMES.items()}
        top_name = F.concat(top["zh"], F.coalesce(F.concat(F.lit("（"), K.look(grade_zh, top["grade"]), F.lit("）")), F.lit("")))
        evidence = F.when(first["grade"].isNotNull(), F.concat(F.lit("，程度为"), K.look(grade_zh, first["grade"]), F.lit("。"))).otherwise(F.concat(F.lit("，在画面"), first["region"], F.lit("，"), G.size_word(first["area_ratio"]), F.lit("。")))
        compared = F.array_join(F.transform(F.slice(d, 1, MOST_COMPARED), lambda x: F.concat(F.lit("画面"), x["region"], F.lit("出现"), x["zh"])), "；")
        places = F.array_distinct(d["place"])
        where = F.concat(F.when(F.size(d) > 1, F.concat(F.lit("共 "), F.size(d).cast("string"), F.lit(" 处："))).otherwise(""), F.array_join(places, "，"), F.lit("。"))
        turn = lambda q, a: F.struct(q.alias("question"), a.alias("answer"))
        opening = self.question("multi_turn")
        bad_turns = F.array(turn(opening, F.concat(F.lit("有异常，"), where)), turn(F.lit("请给出它们的位置。"), self.json(d)), turn(F.lit("最严重的是哪一处？"), F.concat(worst["zh"], F.lit("，程度"), K.look(SEVERITY_NAMES, worst["severity"]), F.lit("。"))))
        good_turns = F.array(turn(opening, F.lit("没有发现异常。")), turn(F.lit("请列出全部缺陷的位置。"), F.lit("[]")))
        r, normal = self.record, ~self.anomalous
        return {
            "grounding_single": r(self.anomalous, self.question("grounding_single", kind_zh), self.json(self.of(kind)), n_boxes=F.size(self.of(kind)), target_type=kind, asked=F.array(kind), said=F.array(kind)),
            "grounding_all": r(self.anomalous, self.question("grounding_all"), self.json(d), n_boxes=F.size(d), asked=none, said=self.types),
            "grounding_negative": r(normal, self.question("grounding_negative"), F.lit("[]"), n_boxes=F.lit(0), asked=none, said=none),
            "grounding_counterfactual": r(self.anomalous & away.isNotNull(), self.question("grounding_counterfactual", away_zh), F.lit("[]"), n_boxes=F.lit(0), variant=F.lit("absent_type"), target_type=away, asked=F.array(away), said=none),
            "referring_region": r(region_box.isNotNull(), self.question("referring_region", box=box_words), F.when(hit, F.concat(F.lit("该区域有"), any_box["zh"], F.lit("。"))).otherwise("该区域没有发现问题。"),
                                  yes_no=F.when(hit, "yes").otherwise("no"), said=F.when(hit, F.array(any_box["type"])).otherwise(none)),
            "counting": r(self.anomalous, self.question("counting", F.when(zero, away_zh).otherwise(kind_zh)), F.concat(F.lit("共 "), F.size(counted).cast("string"), F.lit(" 处。\n"), self.json(counted)), n_boxes=F.size(counted), said=mine),
            "region_word": r(self.anomalous, self.question("region_word", any_box["zh"]), F.concat(any_box["zh"], F.lit("在画面"), any_box["region"], F.lit("。")), region=any_box["region"], said=F.array(any_box["type"])),
            "discrimination": r(F.lit(True), self.question("discrimination"), F.when(self.anomalous, F.concat(F.lit("存在缺陷。"), where)).otherwise("没有发现异常，表面完好。"), yes_no=F.when(self.anomalous, "yes").otherwise("no"), said=self.types),
            "classification_open": r(self.known, self.question("classification_open", region=first["region"]), F.concat(first["zh"], evidence), target_type=first["type"], said=F.array(first["type"])),
            "classification_mc": r(self.known & (F.size(options) >= 2), F.concat(self.question("classification_mc"), F.lit("\n"), listed), F.concat(letter, F.lit(". "), first["zh"]), answer_letter=letter, options=options, target_type=first["type"], said=F.array(first["type"])),
            "description": r(F.lit(True), self.question("description"), F.when(self.anomalous, F.concat(F.lit("检查发现缺陷，"), where)).otherwise("表面完好，没有裂纹、划伤和锈迹。"), said=self.types),
            "severity_action": r(self.known, self.question("severity_action", top["zh"], region=top["region"]), F.concat(top_name, F.lit("，程度"), K.look(SEVERITY_NAMES, top["severity"]), F.lit("，建议"), action(top["type"], top["grade"]), F.lit("。"), self.advice("severity")),
                                 severity=top["severity"], target_type=top["type"], asked=F.array(top["type"]), said=F.array(top["type"])),
            "object_recognition": r(F.lit(True), self.question("object_recognition"), F.concat(F.lit("图中是"), F.col("object_zh"), F.lit("，对应"), F.col("ctx"), F.lit("。")), said=none),
            "grade_assessment": r(self.anomalous & F.array_max(d["grade"]).isNotNull(), self.question("grade_assessment"), F.concat(F.lit("锈蚀等级为"), K.look({g: zh for g, (zh, _) in GRADE_NAMES.items()}, graded["grade"]), F.lit("。")), grade=graded["grade"], said=none),
            "multi_turn": r(F.lit(True), opening, F.when(self.anomalous, F.get(bad_turns, 0)["answer"]).otherwise(F.get(good_turns, 0)["answer"]), turns=F.when(self.anomalous, bad_turns).otherwise(good_turns), yes_no=F.when(self.anomalous, "yes").otherwise("no"), said=self.types),
            "pair_compare": r(self.reference.isNotNull(), self.question("pair_compare"), F.when(self.anomalous, F.concat(F.lit("与参考图相比，"), compared, F.lit("。"))).otherwise("与参考图一致，没有发现差异。"), images=F.array(self.reference, F.col("image")), said=self.types),
        }

    def doubts(self) -> list[tuple[Column, dict[str, Column]]]:
        """What a degraded picture is asked: whether it shows one of several types, which nobody can say."""
        cause = F.coalesce(K.look(CAUSES, F.col("degradation")), F.lit("成像不清"))
        kinds = [F.get(self.doubtful, k) for k in range(ASKED_IF_DEGRADED)]
        return [self.record(t.isNotNull(), self.question("uncertainty", K.look(NAMES, t), draw=str(k)), F.concat(cause, F.lit("，无法确认，建议补拍。")), target_type=t, asked=F.array(t), said=F.array().cast("array<string>")) for k, t in enumerate(kinds)]


def records(df: DataFrame, seed: int = 0, active: list[str] | None = None, most: int = MOST, references: bool = True, tasks: list[str] | None = None, weights: dict[str, float] | None = None, bank: DataFrame | None = None) -> DataFrame:
    """Records of all samples. Degraded samples give the task ``uncertainty`` alone, for up to three types.

    ``tasks`` names those that are switched on; a weight of 0 switches one off. ``bank`` adds questions (see ``pools``).
    """
    weights = WEIGHTS | (weights or {})
    on = [t for t in WEIGHTS if weights[t] > 0 and (tasks is None or t in tasks)]
    if not on:
        raise ValueError("no task is switched on")
    active = active or [x[0] for x in DEFECTS if x[0] != OTHER]
    df = _with_words(df)
    df = scoped(with_references(df) if references else df, active)
    b = _Builder(seed, active, references, pools(bank), weights, on)
    df = b.shown(df, active)
    # Number of the record's kind, task, whether it is there, its place among the sample's records and its fields.
    kinds = [(t, when & b.taken(t), b.place(t), fields) for t, (when, fields) in b.tasks().items() if t in on]
    if "uncertainty" in on:
        kinds += [("uncertainty", b.degraded & when, F.lit(str(k)), fields) for k, (when, fields) in enumerate(b.doubts())]
    # Those that aren't there come last. The array is a column of its own, as expressions of a generator and of a filter's array aren't compiled;
    # the outer generator keeps the planner from a filter on the array's size, which would be pushed below all projections and repeat them.
    none = F.struct(F.lit("~").alias("h"), F.lit(-1).alias("k"))
    offers = lambda late: [F.when(there, F.struct(h.alias("h"), F.lit(k).alias("k"))).otherwise(none) for k, (t, there, h, _) in enumerate(kinds) if (t in LATE) == late]
    # Whether a record of LATE is there costs most to say, so it is only asked where it could be among the first.
    df = df.withColumn("_offers", F.slice(F.sort_array(F.array(none, *offers(False))), 1, most))
    df = b.drawn(df.withColumn("_last", F.coalesce(F.get("_offers", most - 1)["h"], F.lit("~"))), active)
    df = df.withColumn("_chosen", F.slice(F.sort_array(F.concat("_offers", F.array(none, *offers(True)))), 1, most))
    df = df.select("*", F.explode_outer("_chosen").alias("_c")).withColumn("_k", F.col("_c.k")).filter("_k >= 0")
    keep = ["sample_id", "image", "dataset", "category", "degradation", F.col("label").alias("image_status"), b.types.alias("image_defect_types"), F.array("height", "width").alias("image_hw")]
    task = F.get(K.array([t for t, *_ in kinds]), F.col("_k")).alias("task")

    def field(name: str) -> Column:
        out = F.lit(None)
        for k, (*_, fields) in reversed(list(enumerate(kinds))):
            if name in fields:
                out = F.when(F.col("_k") == k, fields[name]).otherwise(out)
        return out.cast(_KINDS[name]).alias(name)

    out = df.select(*keep, task, *[field(f) for f in _KINDS])
    out = out.withColumn("output_format", K.look(FORMATS, F.col("task"))).withColumn("system", K.look(SYSTEMS, F.col("output_format")))
    return (out.withColumn("qa_id", X.qa_id(F.col("sample_id"), F.col("task"), F.col("question"))).withColumn("coord_mode", F.lit("norm1000"))
            .withColumnsRenamed({"asked": "asked_defect_types", "said": "answer_defect_types"}))
