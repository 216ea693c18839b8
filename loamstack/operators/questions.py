"""Validation and merging of generated questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamstack.functions import draws
from loamstack.functions import text as X
from loamstack.operators.taxonomy import DEFECTS

# Words, endings and topics that a question must not have, and the placeholders of each task.
COLLOQUIAL = ("呗", "咋", "嘛", "哈哈", "啦", "喽", "哟", "呐", "啊？", "这玩意", "整一下", "搞一下", "瞅", "瞧瞧", "弄一下")
JARGON = ("工卡", "AMM", "SRM", "适航", "放行", "定检", "IPC", "NDT", "机务")
ENDS = ("。", "？", "；", "！", ")", "）")
UNANSWERABLE = (
    ("parts", "备件|料号|件号清单|堆修|抛光修复方案|平滑处理"), ("trend", "疲劳|剩余寿命|扩展趋势|扩展风险|监测建议|检查周期|检查频次|监控频率|老化程度"),
    ("release", "放行|适航|签署|停飞|停机|投入运行|验收标准"), ("limits", r"允许限值|允许极限|允许限度|手册章节|A\s*类损坏|公差"), ("aerodynamics", "气动"),
    ("cause", "成因|整改措施|预防措施"), ("unlabelled", "电气连接|透明件|雾化|密封条|标识标牌|积水|焊缝|渗漏|过热|烧蚀|虚焊"),
    ("system", "哪个系统|归属系统|控制参数|飞行安全中的作用"), ("measure", "几何尺寸|深度等级|具体尺寸|长度与|面积与形态"),
)
ALLOWED = {
    "grounding_single": ("defect", "defect_en", "obj", "ctx"),
    "grounding_all": ("obj", "ctx"),
    "grounding_negative": ("obj", "ctx"),
    "grounding_counterfactual": ("defect", "defect_en", "obj", "ctx"),
    "referring_region": ("box", "obj", "ctx"),
    "region_word": ("defect", "obj", "ctx"),
    "counting": ("defect", "obj", "ctx"),
    "discrimination": ("obj", "ctx"),
    "classification_open": ("obj", "ctx", "region"),
    "description": ("obj", "ctx"),
    "severity_action": ("obj", "ctx", "defect", "region"),
    "object_recognition": ("obj", "ctx"),
    "grade_assessment": ("defect", "obj", "ctx"),
    "uncertainty": ("defect", "obj", "ctx"),
    "multi_turn": ("obj", "ctx"),
    "pair_compare": ("obj", "ctx"),
}
REQUIRED = {
    "grade_assessment": ("defect",),
    "grounding_single": ("defect",),
    "grounding_counterfactual": ("defect",),
    "referring_region": ("box",),
    "region_word": ("defect",),
    "counting": ("defect",),
    "uncertainty": ("defect",),
}
FORBIDDEN = {
    "object_recognition": ("obj", "ctx"),
}
TEXT_TASKS = ("referring_region", "region_word", "discrimination", "classification_open", "classification_mc", "description", "severity_action", "object_recognition", "grade_assessment", "uncertainty", "pair_compare", "multi_turn")
COORDINATES = "坐标|bbox|边界框|检测框|JSON|json"


def _of(task: Column, table: dict[str, tuple[str, ...]]) -> Column:
    out = F.array().cast("array<string>")
    for name, words in table.items():
        out = F.when(task == name, F.array(*map(F.lit, words))).otherwise(out)
    return out


def reject_reason(task: Column, question: Column, repeated: Column) -> Column:
    """Why a question is rejected, null if it is not; the first reason counts."""
    q = F.trim(question)
    has = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(q, w))
    jargon = sum((F.length(q) - F.length(F.replace(q, F.lit(w), F.lit("")))) / len(w) for w in JARGON)
    holes = X.placeholders(q)
    reason = (F.when((F.length(q) < 6) | (F.length(q) > 120), "length").when(repeated, "repeated").when(has(COLLOQUIAL), "colloquial").when(~F.exists(F.array(*map(F.lit, ENDS)), lambda e: q.endswith(e)), "ending")
              .when(jargon > 1, "jargon").when(F.length(q) - F.length(F.replace(q, F.lit("，"), F.lit(""))) > 3, "clauses").when(F.size(F.array_except(holes, _of(task, ALLOWED))) > 0, "placeholder_not_allowed")
              .when(F.size(F.array_except(_of(task, REQUIRED), holes)) > 0, "placeholder_missing").when(F.length(F.regexp_replace(q, X.PLACEHOLDER, "")) != F.length(F.regexp_replace(F.regexp_replace(q, X.PLACEHOLDER, ""), "[{}]", "")), "not_formattable")
              .when(F.size(F.array_intersect(holes, _of(task, FORBIDDEN))) > 0, "leak"))
    for name, pattern in UNANSWERABLE:
        reason = reason.when(q.rlike(pattern), f"unanswerable_{name}")
    return reason.when(task.isin(*TEXT_TASKS) & ~F.contains(q, F.lit("{box}")) & q.rlike(COORDINATES), "unanswerable_coordinates")


def validate(questions: DataFrame, order: str = "ord") -> DataFrame:
    """``questions`` (task, question, ord) with ``reason``; of repeated texts of a task the first counts."""
    again = F.row_number().over(W.partitionBy("task", F.trim("question")).orderBy(order)) > 1
    return questions.withColumn("_again", again).withColumn("reason", reject_reason(F.col("task"), F.col("question"), F.col("_again"))).drop("_again")


def parse_array(text: Column) -> Column:
    """The strings of a JSON array, or the whole ones of a truncated array; null without any."""
    part = F.regexp_extract(text, r"(?s)\[.*", 0)
    whole = F.regexp_extract(text, r"(?s)\[.*\]", 0)
    items = F.transform(F.regexp_extract_all(part, F.lit(r'"((?:[^"\\]|\\.)*)"'), 0), lambda s: F.from_json(F.concat(F.lit('{"v":'), s, F.lit("}")), "struct<v:string>")["v"])
    return F.when(X.is_json_array(whole), F.from_json(whole, "array<string>")).when(F.size(items) > 0, items)


def merged(seed: DataFrame, bank: DataFrame) -> DataFrame:
    """task, question, ord: seed questions first, then those of the bank for known tasks, each text once. Banks are configuration: a task's questions are ordered in one window."""
    both = seed.select("task", "question", F.lit(0).alias("part"), "ord").unionByName(bank.join(seed.select("task").distinct(), "task", "left_semi").select("task", "question", F.lit(1).alias("part"), "ord"))
    first = both.groupBy("task", "question").agg(F.min(F.struct("part", "ord")).alias("p"))
    return first.select("task", "question", F.row_number().over(W.partitionBy("task").orderBy("p", "question")).alias("ord"))


def in_language(bank: DataFrame) -> DataFrame:
    """``bank`` (task, question) without English questions, for tasks that have others; a task with English ones alone keeps them."""
    english = X.is_english(F.col("question"))
    other = bank.filter(~F.coalesce(english, F.lit(False))).select("task").distinct().withColumn("_other", F.lit(True))
    return bank.join(other, "task", "left").filter(F.col("_other").isNull() | ~F.coalesce(english, F.lit(False))).select(*bank.columns)


def pick(asked: DataFrame, bank: DataFrame, seed: int = 0) -> DataFrame:
    """``asked`` (sample_id, task, named) with ``question``: of the task's questions those that name what is asked if ``named``
    and those that don't if not, one of them drawn; null if there are none. The bank is a few hundred rows of configuration.
    """
    names = F.exists(F.array(F.lit("{defect}"), F.lit("{region}")), lambda m: F.contains(F.col("question"), m))
    pools = bank.select("task", names.alias("named"), "question").groupBy("task", "named").agg(F.array_sort(F.collect_set("question")).alias("_pool"))
    return asked.join(pools, ["task", "named"], "left").withColumn("question", draws.pick(F.col("_pool"), seed, F.col("sample_id"), F.col("task"))).drop("_pool")


def types_in_answer(answer: Column) -> Column:
    """Types that the boxes of an answer assert, in order, each once; labels without a type stay as they are."""
    whole = F.regexp_extract(F.coalesce(answer, F.lit("")), r"(?s)\[.*\]", 0)
    known = F.create_map(*[F.lit(x) for d in DEFECTS for x in (d[1], d[0])])
    labels = F.transform(F.from_json(whole, "array<string>"), lambda item: F.get_json_object(item, "$.label"))
    types = F.transform(F.filter(labels, lambda x: x.isNotNull() & (x != "")), lambda x: F.coalesce(F.try_element_at(known, x), x))
    return F.when(X.is_json_array(whole), F.array_distinct(types)).otherwise(F.array().cast("array<string>"))
