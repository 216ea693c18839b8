"""Rewriting of answers by a language model behind gates and a cache. The model is a function from (question, answer) to text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamstack.functions import text as X

#: Answers in these formats, and multiple choice, are never rewritten.
PROTECTED_FORMATS = ("json_only", "text_then_json", "dialog")
PROTECTED_TASKS = ("classification_mc",)


def eligible(df: DataFrame) -> Column:
    return ~F.coalesce(F.col("output_format").isin(*PROTECTED_FORMATS), F.lit(False)) & ~F.col("task").isin(*PROTECTED_TASKS)


def gate(question: Column, answer: Column, rewritten: Column) -> Column:
    """Why a rewrite is refused, null if it is taken."""
    new = X.strip_reasoning(rewritten)
    return F.when(new == "", "empty").when(X.facts(answer) != X.facts(new), "facts_changed").when(X.has_placeholder(new), "placeholder").when(X.doubled_word(new).isNotNull(), "doubled_word")


def pending(df: DataFrame, cache: DataFrame) -> DataFrame:
    """Eligible questions that the cache (k, a, why) lacks, each once."""
    asked = df.filter(eligible(df)).withColumn("k", X.cache_key(F.col("task"), F.col("question"), F.col("answer")))
    return asked.select("k", "question", "answer").dropDuplicates(["k"]).join(cache.select("k"), "k", "left_anti")


def ask(missing: DataFrame, model: Callable[[str, str], str], workers: int = 16) -> DataFrame:
    """Rows for the cache: k, a (null if refused), why. ``workers`` bounds the calls that run at once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"k": b["k"], "question": b["question"], "answer": b["answer"], "raw": [model(q, a) for q, a in zip(b["question"], b["answer"], strict=True)]})

    raw = missing.repartition(workers, "k").mapInPandas(run, "k string, question string, answer string, raw string")
    why = gate(F.col("question"), F.col("answer"), F.col("raw"))
    return raw.select("k", F.when(why.isNull(), X.strip_reasoning(F.col("raw"))).alias("a"), why.alias("why"))


def hits(asked: DataFrame, cache: DataFrame, by: str) -> DataFrame:
    """hits and misses of ``asked`` (k) in ``cache`` (k) for each value of ``by``."""
    known = cache.select("k").distinct().withColumn("_hit", F.lit(1))
    found = asked.join(known, "k", "left").groupBy(by).agg(F.count("_hit").alias("hits"), F.count("*").alias("_n"))
    return found.select(by, "hits", (F.col("_n") - F.col("hits")).alias("misses"))


def with_attempt(cache: DataFrame | None, found: DataFrame, attempt: int) -> DataFrame:
    """The rows of a cache (k, a, why, attempt) and those of one more attempt; ``rewrite_cache`` keeps them in files."""
    new = found.select("k", "a", "why", F.lit(attempt).alias("attempt"))
    return new if cache is None else cache.select("k", "a", "why", "attempt").unionByName(new)


def latest(cache: DataFrame) -> DataFrame:
    """One row for each question: an accepted answer before refusals, then the latest attempt, then the least text."""
    order = F.struct(F.col("a").isNotNull().alias("ok"), (F.col("attempt") if "attempt" in cache.columns else F.lit(0)).alias("n"), F.coalesce("a", "why", F.lit("")).alias("t"))
    return cache.groupBy("k").agg(F.max_by(F.struct("a", "why"), order).alias("_row")).select("k", "_row.a", "_row.why")


def apply(df: DataFrame, cache: DataFrame) -> DataFrame:
    """``df`` with accepted answers in place: answer, answer_template, rewritten, rewrite_rejected."""
    keyed = df.withColumn("_k", F.when(eligible(df), X.cache_key(F.col("task"), F.col("question"), F.col("answer"))))
    known = latest(cache).select("k", F.col("a").alias("_a"), F.col("why").alias("_why"))
    joined = keyed.join(known, F.col("_k") == F.col("k"), "left")
    return joined.select(*[F.coalesce("_a", "answer").alias("answer") if c == "answer" else F.col(c) for c in df.columns],
                         F.when(F.col("_a").isNotNull(), F.col("answer")).alias("answer_template"), F.col("_a").isNotNull().alias("rewritten"), F.col("_why").alias("rewrite_rejected"))
