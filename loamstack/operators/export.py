"""Exported conversations as JSON lines."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IMAGE = "<image>"
# The record columns that go into meta.
META = ("task", "family", "output_format", "dataset", "category", "split", "image_status", "image_defect_types", "asked_defect_types", "answer_defect_types", "variant", "coord_mode", "image_hw", "license")


class _Parts:
    def __init__(self, df: DataFrame, root: str | None):
        have = set(df.columns)
        one = F.array(F.struct(F.col("question").alias("question"), F.col("answer").alias("answer")))
        self.turns = F.when(F.size("turns") > 0, F.transform("turns", lambda t: F.struct(t["question"].alias("question"), t["answer"].alias("answer")))).otherwise(one) if "turns" in have else one
        single = F.array(F.col("image")) if "image" in have else F.array().cast("array<string>")
        images = F.when(F.size("images") > 0, F.col("images")).otherwise(single) if "images" in have else single
        self.images = F.transform(images, lambda p: F.regexp_replace(p, f"^{root.rstrip('/')}/", "")) if root else images
        self.system = F.col("system") if "system" in have else F.lit(None).cast("string")
        self.id = F.col("qa_id").alias("id")
        self.meta = F.struct(*[F.col(c) for c in META if c in have]).alias("meta")

    def asked(self, q: Column, i: Column) -> Column:
        return F.when(i == 0, F.concat(F.expr("''"), F.repeat(F.lit(IMAGE), F.size(self.images)), q)).otherwise(q)

    def pairs(self, user, assistant) -> Column:
        return F.flatten(F.transform(self.turns, lambda t, i: F.array(user(t["question"], i), assistant(t["answer"]))))

    def messages(self) -> Column:
        m = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
        body = self.pairs(lambda q, i: m("user", self.asked(q, i)), lambda a: m("assistant", a))
        return F.when(F.coalesce(self.system, F.lit("")) != "", F.concat(F.array(m("system", self.system)), body)).otherwise(body)


def sharegpt(p: _Parts) -> Column:
    m = lambda who, value: F.struct(F.lit(who).alias("from"), value.alias("value"))
    talk = p.pairs(lambda q, i: m("human", p.asked(q, i)), lambda a: m("gpt", a))
    return F.struct(talk.alias("conversations"), p.images.alias("images"), F.nullif(p.system, F.lit("")).alias("system"), p.id, p.meta)


def messages(p: _Parts) -> Column:
    return F.struct(p.messages().alias("messages"), p.images.alias("images"), p.id, p.meta)


def parts(p: _Parts) -> Column:
    """Content as a list of parts; the system prompt stays a plain string, so messages are joined as JSON texts."""
    none = F.lit(None).cast("string")
    part = lambda kind, image, text: F.struct(F.lit(kind).alias("type"), image.alias("image"), text.alias("text"))
    said = lambda role, content: F.to_json(F.struct(F.lit(role).alias("role"), content.alias("content")))
    pictures = F.transform(p.images, lambda x: part("image", x, none))
    text = lambda x: F.array(part("text", none, x))
    body = p.pairs(lambda q, i: said("user", F.when(i == 0, F.concat(pictures, text(q))).otherwise(text(q))), lambda a: said("assistant", text(a)))
    system = F.to_json(F.struct(F.lit("system").alias("role"), p.system.alias("content")))
    every = F.when(F.coalesce(p.system, F.lit("")) != "", F.concat(F.array(system), body)).otherwise(body)
    rest = F.to_json(F.struct(p.id, p.meta))
    return F.concat(F.lit('{"messages":['), F.array_join(every, ","), F.lit("],"), F.substring(rest, 2, 1 << 30))


#: Both message formats keep every image of a record.
EXPORTERS = {"sharegpt": sharegpt, "llamafactory": messages, "swift": messages, "openai": parts}


def export(records: DataFrame, fmt: str, root: str | None = None) -> DataFrame:
    """qa_id and ``line``, the record in format ``fmt``; null fields are left out."""
    built = EXPORTERS[fmt](_Parts(records, root))
    return records.select("qa_id", (built if fmt == "openai" else F.to_json(built)).alias("line"))


def write(records: DataFrame, fmt: str, path: str, root: str | None = None, as_json_array: bool = False) -> None:
    """JSON lines, or with ``as_json_array`` one JSON array in each file."""
    lines = export(records, fmt, root).select("line")
    (lines.mapInArrow(_array, "line string") if as_json_array else lines).write.text(path)


def _array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a partition with brackets and commas; a partition without rows stays empty."""
    held, first = None, True
    out = lambda line: pa.RecordBatch.from_arrays([pa.array([line], pa.string())], names=["line"])
    for b in batches:
        for line in b.column(0):
            if held is not None:
                yield out(("[" if first else "") + held + ",")
                first = False
            held = line.as_py()
    if held is not None:
        yield out(("[" if first else "") + held + "]")


def write_reports(folder: str, formats: dict[str, str], systems: dict[str, str], **tables: DataFrame) -> None:
    """``system_prompts.json``: the prompts by output format and the format of each task, as a model needs them again later; ``stats.json``:
    a line for each row of the given tables (small ones), with the table's name."""
    spark = next(iter(tables.values())).sparkSession
    prompts = json.dumps({"by_output_format": systems, "task_to_output_format": formats}, ensure_ascii=False)
    spark.createDataFrame([(prompts,)], "line string").coalesce(1).write.mode("overwrite").text(f"{folder}/system_prompts.json")
    rows = [t.select(F.to_json(F.struct(F.lit(name).alias("table"), F.struct(*t.columns).alias("row"))).alias("line")) for name, t in tables.items()]
    reduce(DataFrame.union, rows).coalesce(1).write.mode("overwrite").text(f"{folder}/stats.json")
