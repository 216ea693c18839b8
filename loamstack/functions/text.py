"""Text functions as Columns."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words whose doubling marks a broken template.
DOUBLED = ("范围范围", "程度程度", "严重严重", "位于位于", "缺陷缺陷", "检查检查", "区域区域")
PLACEHOLDER = r"\{([a-z_]+)\}"
_TAG = r"(?:think|thinking|reasoning|reason)"


def norm_key(name: Column) -> Column:
    """Lower case, separators to one underscore, other signs dropped."""
    joined = F.regexp_replace(F.lower(F.trim(name)), r"[\s\-/]+", "_")
    return F.btrim(F.regexp_replace(F.regexp_replace(joined, r"[^a-z0-9_]+", ""), r"_+", "_"), F.lit("_"))


def is_english(text: Column) -> Column:
    """More ASCII letters than 8 and than two fifths of the text."""
    return F.length(F.regexp_replace(text, "[^A-Za-z]", "")) > F.greatest(F.lit(8.0), F.length(text) * 0.4)


def facts(text: Column) -> Column:
    """What a rewrite must keep: the numbers in order, then the widest bracketed part."""
    numbers = F.regexp_extract_all(text, F.lit(r"-?\d+(?:\.\d+)?"), 0)
    return F.concat(numbers, F.array(F.regexp_extract(text, r"(?s)\[.*\]", 0)))


def strip_reasoning(text: Column) -> Column:
    """Drop closed reasoning blocks, what stands before a lone closing tag, and what follows a lone opening tag."""
    blocks = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?is)<\s*(think|thinking|reasoning|reason)\s*>.*?<\s*/\s*\1\s*>", "")
    tail = F.regexp_replace(blocks, rf"(?is)^.*<\s*/\s*{_TAG}\s*>", "")
    return F.regexp_replace(F.regexp_replace(tail, rf"(?is)<\s*{_TAG}\s*>.*$", ""), r"^\s+|\s+$", "")


def qa_id(sample_id: Column, task: Column, question: Column) -> Column:
    return F.substring(F.md5(F.concat_ws("|", sample_id.cast("string"), task, question).cast("binary")), 1, 16)


def cache_key(task: Column, question: Column, answer: Column) -> Column:
    return F.md5(F.concat_ws("\u0000", task, question, answer).cast("binary"))


def placeholders(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(PLACEHOLDER), 1))


def has_placeholder(text: Column) -> Column:
    return text.rlike(PLACEHOLDER)


def doubled_word(text: Column) -> Column:
    """The first doubled word, or null."""
    return F.get(F.filter(F.array(*map(F.lit, DOUBLED)), lambda w: F.contains(text, w)), 0)


def has_doubled(text: Column) -> Column:
    """Whether there is a doubled word."""
    return reduce(or_, [F.contains(text, F.lit(w)) for w in DOUBLED])


def is_json_array(text: Column) -> Column:
    """Whether the whole text is one JSON array: Spark's parsers take trailing garbage, so it is wrapped first."""
    wrapped = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    return F.coalesce(text.startswith("[") & text.endswith("]") & (wrapped == 1), F.lit(False))


def fill(template: Column, fields: dict[str, Column]) -> Column:
    """Replace {name} by each field."""
    for name, value in fields.items():
        template = F.replace(template, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return template


def box_text(box: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(box, lambda v: v.cast("string")), ", "), F.lit("]"))


def box_json(box: Column, label: Column) -> Column:
    """One item of ``boxes_json``; the box is a text."""
    return F.concat(F.lit('{"bbox_2d": '), box, F.lit(', "label": "'), label, F.lit('"}'))


def json_list(items: Column) -> Column:
    """JSON of an array of items that are JSON already, with a space after separators."""
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def boxes_json(items: Column) -> Column:
    """JSON of array<struct<bbox,label>> with a space after separators."""
    return json_list(F.transform(items, lambda d: box_json(box_text(d["bbox"]), d["label"])))


def tokens(text: Column) -> Column:
    """A token is a Chinese character or a run of ASCII word signs."""
    return F.regexp_extract_all(text, F.lit(r"[一-龥]|[A-Za-z0-9_]+"), 0)


def bigrams(found: Column) -> Column:
    """Neighbouring ones of an array of tokens, which should be a column, not an expression that each use works out anew."""
    n = F.greatest(F.size(found) - 1, F.lit(0))
    return F.zip_with(F.slice(found, F.lit(1), n), F.slice(found, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b))
