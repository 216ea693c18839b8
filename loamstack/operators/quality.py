"""Quality rules of records and of exported conversations: one array of error codes for each row, in one projection."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamstack.functions import text as X

# Words that hedge, and how answers claim or deny an anomaly.
HEDGES = "无法确认|不足以|不可辨|补拍|重新取证"
CLAIMS = "存在(异常|缺陷)|不合格"
DENIES = "未(见|发现)异常|(?<!不)合格。"
NEGATIVE_TASKS = ("grounding_negative", "grounding_counterfactual")

#: Columns that rules read; a column that a table lacks counts as null.
FIELDS = {
    "task": "string", "question": "string", "answer": "string", "output_format": "string", "system": "string", "image_status": "string", "image_defect_types": "array<string>",
    "answer_defect_types": "array<string>", "images": "array<string>", "turns": "array<struct<question:string,answer:string>>", "options": "array<string>", "answer_letter": "string",
    "yes_no": "string", "degradation": "string", "image_quality": "string", "coord_mode": "string", "image_hw": "array<int>",
}


def _fields(df: DataFrame) -> dict[str, Column]:
    return {k: F.col(k) if k in df.columns else F.lit(None).cast(t) for k, t in FIELDS.items()}


def _codes(*rules: tuple[Column, Column | str]) -> Column:
    found = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(code) if isinstance(code, str) else code) for c, code in rules])
    return F.filter(found, lambda x: x.isNotNull())


def _broken(*rules: tuple[Column, Column | str]) -> Column:
    """Whether any of the rules gives a code, without working codes out."""
    return reduce(or_, [F.coalesce(c, F.lit(False)) for c, _ in rules])


def box_part(answer: Column) -> Column:
    return F.regexp_extract(answer, r"(?s)\[.*\]", 0)


def box_items(part: Column) -> Column:
    """The items of a bracketed part as JSON texts, null if it is no JSON array."""
    return F.when(X.is_json_array(part), F.from_json(part, "array<string>"))


def boxes_of(items: Column) -> Column:
    """array<struct<raw,box>>: each item's box as text and as numbers."""
    raw = F.transform(items, lambda i: F.get_json_object(i, "$.bbox_2d"))
    return F.transform(raw, lambda r: F.struct(r.alias("raw"), F.from_json(r, "array<double>").alias("box")))


def _let(value: Column, f) -> Column:
    """f(value), with value worked out once."""
    return F.get(F.transform(F.array(value), f), 0)


def _box_code(item: Column, norm: Column, hw: Column) -> Column:
    raw, box = item["raw"], item["box"]
    low, high = F.array_min(box), F.array_max(box)
    outside = (box[0] < 0) | (box[1] < 0) | (box[2] > hw[1]) | (box[3] > hw[0])
    return (F.when(raw.isNull(), "bad_box_item").when(box.isNull() | (F.size(box) != 4), "bad_box_len").when((box[2] <= box[0]) | (box[3] <= box[1]), "degenerate_box")
            .when(norm & ((low < 0) | (high > 1000)), "box_out_of_range").when(~norm & outside, "box_out_of_image"))


def _bad_box(f: dict[str, Column], boxes: Column) -> Column:
    """The first box's code that is one."""
    norm = F.coalesce(f["coord_mode"], F.lit("norm1000")) == "norm1000"
    return F.get(F.filter(F.transform(boxes, lambda b: _box_code(b, norm, f["image_hw"])), lambda c: c.isNotNull()), 0)


def _form_rules(f: dict[str, Column]) -> list[tuple[Column, Column | str]]:
    """What depends on the task and the answer's text."""
    task, question, answer = F.coalesce(f["task"], F.lit("")), F.coalesce(f["question"], F.lit("")), F.coalesce(f["answer"], F.lit(""))
    fmt, ans, negative = f["output_format"], F.trim(answer), task.isin(*NEGATIVE_TASKS)
    image, said = f["image_defect_types"], f["answer_defect_types"]
    terms = F.filter(F.regexp_extract_all(answer, F.lit("[一-龥]{2,6}"), 0), lambda t: (F.length(t) >= 3) & ~F.contains(question, t))
    last_line = F.trim(F.regexp_replace(ans, r"(?s)^.*\n", ""))
    return [
        ((fmt == "json_only") & ~X.is_json_array(ans), "not_pure_json"),
        ((fmt == "text") & F.contains(ans, F.lit("bbox_2d")), "text_format_has_boxes"),
        ((fmt == "text_then_json") & (~F.contains(ans, F.lit("\n")) | ~last_line.startswith("[")), "not_text_then_json"),
        ((F.size(image) > 0) & (F.size(F.array_except(said, image)) > 0), "answer_asserts_absent_defect"),
        ((task == "uncertainty") & F.coalesce(f["degradation"], f["image_quality"]).isNull(), "uncertainty_without_evidence"),
        (negative & (F.size(terms) > 0), "answer_mentions_unasked_term"),
        ((task == "uncertainty") & ~answer.rlike(HEDGES), "uncertainty_without_hedge"),
        ((task == "uncertainty") & F.contains(answer, F.lit("bbox_2d")), "uncertainty_with_boxes"),
    ]


def _boxed(f: dict[str, Column]) -> Column:
    """Whether the task's answer holds boxes; ``_box_rules`` find nothing in others."""
    task = F.coalesce(f["task"], F.lit(""))
    return task.startswith("grounding") | (task == "counting")


def _box_rules(f: dict[str, Column], items: Column, bad_box: Column) -> list[tuple[Column, Column | str]]:
    """What depends on the boxes of the answer; the items of its JSON and the code of its boxes are given."""
    task, boxed = F.coalesce(f["task"], F.lit("")), _boxed(f)
    stated = F.try_to_number(F.nullif(F.regexp_extract(F.coalesce(f["answer"], F.lit("")), r"共\s*(\d+)\s*处", 1), F.lit("")), F.lit("9999999999"))
    return [
        (boxed & items.isNull(), "answer_not_json"),
        (task.isin(*NEGATIVE_TASKS) & (F.size(items) > 0), "negative_with_boxes"),
        (task.isin("grounding_single", "grounding_all") & items.isNotNull() & (F.size(items) == 0) & (f["image_status"] == "anomalous"), "positive_without_boxes"),
        (boxed & bad_box.isNotNull(), bad_box),
        ((task == "counting") & items.isNotNull() & (stated != F.size(items)), "count_mismatch"),
    ]


def _choice_rules(f: dict[str, Column]) -> list[tuple[Column, Column | str]]:
    """What depends on the letter, or on yes and no."""
    task, answer, yes = F.coalesce(f["task"], F.lit("")), F.coalesce(f["answer"], F.lit("")), f["yes_no"]
    mc, letter = task == "classification_mc", F.coalesce(f["answer_letter"], F.lit(""))
    good_letter = letter.rlike("^[A-F]$")
    return [
        (mc & ~good_letter, "bad_mc_letter"),
        (mc & good_letter & ~answer.startswith(letter), "mc_answer_letter_mismatch"),
        (mc & (F.size(F.array_distinct(f["options"])) != F.size(f["options"])), "duplicate_options"),
        ((task == "discrimination") & (yes == "no") & answer.rlike(CLAIMS), "negative_answer_says_positive"),
        ((task == "discrimination") & (yes == "yes") & answer.rlike(DENIES), "positive_answer_says_negative"),
    ]


def _answer_codes(f: dict[str, Column], items: Column, bad_box: Column) -> Column:
    return _codes(*_form_rules(f), *_box_rules(f, items, bad_box), *_choice_rules(f))


def _answer_broken(f: dict[str, Column]) -> Column:
    """The same as a yes or no; an answer is parsed once, and only for tasks with boxes."""
    boxes = _let(box_part(F.coalesce(f["answer"], F.lit(""))), lambda p: _let(box_items(p), lambda items: _let(_bad_box(f, boxes_of(items)), lambda bad: _broken(*_box_rules(f, items, bad)))))
    return _broken(*_form_rules(f), *_choice_rules(f)) | (_boxed(f) & boxes)


def _text_rules(f: dict[str, Column]) -> list[tuple[Column, Column | str]]:
    question, answer = F.coalesce(f["question"], F.lit("")), F.coalesce(f["answer"], F.lit(""))
    doubled = lambda t, name: F.concat(F.lit(f"duplicated_word_{name}:"), X.doubled_word(t))
    tokens = F.size(F.regexp_extract_all(question, F.lit("<image>"), 0))
    return [
        ((question == "") | (answer == ""), "empty_qa"), (X.has_placeholder(question), "unfilled_placeholder_q"), (X.has_placeholder(answer), "unfilled_placeholder_a"),
        (X.has_doubled(question), doubled(question, "q")), (X.has_doubled(answer), doubled(answer, "a")),
        ((F.size(f["images"]) > 0) & (tokens > 0) & (tokens != F.size(f["images"])), "image_token_count_mismatch"),
    ]


def _turn_probe(f: dict[str, Column], answer: Column) -> dict[str, Column]:
    """A turn as the rules of records see it."""
    return f | {"answer": answer, "task": F.when(f["yes_no"] == "no", "grounding_negative").otherwise("grounding_all")}


def _turns_broken(f: dict[str, Column]) -> Column:
    """Whether ``_turn_codes`` finds anything."""
    turns = f["turns"]

    def one(t: Column) -> Column:
        q, a = F.coalesce(t["question"], F.lit("")), F.coalesce(t["answer"], F.lit(""))
        probe = _turn_probe(f, a)
        inner = F.contains(a, F.lit("[")) & (_broken(*_text_rules(probe)) | _answer_broken(probe))
        return (q == "") | (a == "") | X.has_placeholder(F.concat(q, a)) | X.has_doubled(a) | inner

    return F.coalesce(F.size(turns) > 0, F.lit(False)) & ((F.size(turns) < 2) | F.exists(turns, one))


def _turn_codes(f: dict[str, Column]) -> Column:
    turns = f["turns"]

    def one(t: Column, i: Column) -> Column:
        name = lambda code: F.concat(F.lit(code), i.cast("string"))
        q, a = F.coalesce(t["question"], F.lit("")), F.coalesce(t["answer"], F.lit(""))
        empty = (q == "") | (a == "")
        probe = _turn_probe(f, a)
        answered = _let(box_part(a), lambda p: _let(box_items(p), lambda items: _let(_bad_box(probe, boxes_of(items)), lambda bad: _answer_codes(probe, items, bad))))
        inner = F.transform(F.concat(_codes(*_text_rules(probe)), answered), lambda e: F.concat(F.lit("turn_"), i.cast("string"), F.lit("_"), e))
        own = _codes((empty, name("empty_turn_")), (~empty & X.has_placeholder(F.concat(q, a)), name("unfilled_placeholder_turn_")))
        return F.concat(own, F.when(~empty & F.contains(a, F.lit("[")), inner).otherwise(F.array().cast("array<string>")))

    doubled = F.get(F.filter(F.transform(turns, lambda t: X.doubled_word(t["answer"])), lambda w: w.isNotNull()), 0)
    found = F.concat(_codes((F.size(turns) < 2, "too_few_turns")), F.flatten(F.transform(turns, one)), _codes((doubled.isNotNull(), F.concat(F.lit("duplicated_word_turn:"), doubled))))
    return F.when(F.size(turns) > 0, found).otherwise(F.array().cast("array<string>"))


def _system_rule(f: dict[str, Column], systems: dict[str, str] | None) -> tuple[Column, str]:
    wrong = F.lit(False)
    for fmt, prompt in (systems or {}).items():
        wrong = wrong | ((f["output_format"] == fmt) & f["system"].isNotNull() & (f["system"] != prompt))
    return wrong, "system_format_mismatch"


def with_errors(df: DataFrame, systems: dict[str, str] | None = None) -> DataFrame:
    """``df`` with ``errors``; ``systems`` maps output formats to the system prompt that they must carry."""
    f = _fields(df)
    # Each step in a projection of its own: what several rules test is parsed once.
    parsed = (df.withColumn("_part", box_part(F.coalesce(f["answer"], F.lit("")))).withColumn("_items", box_items(F.col("_part")))
              .withColumn("_boxes", boxes_of(F.col("_items"))).withColumn("_bad_box", _bad_box(f, F.col("_boxes"))))
    errors = F.concat(_turn_codes(f), _codes(*_text_rules(f)), _codes(_system_rule(f, systems)), _answer_codes(f, F.col("_items"), F.col("_bad_box")))
    return parsed.withColumn("errors", errors).drop("_part", "_items", "_boxes", "_bad_box")


def passes(df: DataFrame, systems: dict[str, str] | None = None) -> Column:
    """Whether ``with_errors`` finds nothing in a row of ``df``. A filter on the codes themselves would be pushed below the projections that parse, and parse an answer for each rule."""
    f = _fields(df)
    return ~(_broken(*_text_rules(f), _system_rule(f, systems)) | _answer_broken(f) | _turns_broken(f))


def passing(df: DataFrame, systems: dict[str, str] | None = None) -> DataFrame:
    return df.filter(passes(df, systems))


def report(checked: DataFrame) -> DataFrame:
    """code, n: the histogram of errors, with n_input and n_pass as codes of their own."""
    codes = F.concat("errors", F.array(F.lit("n_input")), F.when(F.size("errors") == 0, F.array(F.lit("n_pass"))).otherwise(F.array().cast("array<string>")))
    return checked.select(F.explode(codes).alias("code")).groupBy("code").agg(F.count("*").alias("n"))


def conversation_errors(turns: Column, images: Column, system: Column | None = None, systems: list[str] | None = None) -> Column:
    """Release rules of one exported conversation: array<struct<role,content>>, images."""
    body = F.filter(turns, lambda t: t["role"] != "system")
    odd = F.exists(F.transform(body, lambda t, i: t["role"] != F.when(i % 2 == 0, "user").otherwise("assistant")), lambda x: x)
    tokens = F.size(F.regexp_extract_all(F.coalesce(F.array_join(F.transform(body, lambda t: t["content"]), " "), F.lit("")), F.lit("<image>"), 0))
    empty = F.exists(body, lambda t: F.coalesce(F.trim(t["content"]), F.lit("")) == "")
    holes = F.exists(body, lambda t: X.has_placeholder(F.coalesce(t["content"], F.lit(""))))
    rules = [(F.size(body) < 2, "too_few_turns"), (odd | (F.size(body) % 2 != 0), "roles_not_alternating"), (tokens != F.coalesce(F.size(images), F.lit(0)), "image_token_count_mismatch"), (empty, "empty_turn"), (holes, "unfilled_placeholder")]
    if system is not None and systems:
        rules.append((system.isNotNull() & ~system.isin(systems), "unknown_system"))
    return _codes(*rules)


def images_missing(records: DataFrame, files: DataFrame, key: str = "qa_id") -> DataFrame:
    """``key`` of the records (images array, or image) that name a file which ``files`` (path) lacks; a null path is missing too."""
    named = F.when(F.size("images") > 0, F.col("images")).otherwise(F.array("image")) if "images" in records.columns else F.array("image")
    asked = records.select(F.col(key), F.explode(named).alias("path"))
    return asked.join(files.select("path").distinct(), "path", "left_anti").select(key).distinct()
