"""A bank of questions that language models write in rounds, until each task has enough.

The state is a folder of two tables: ``asked`` (what each round asked of each task and what became of it) and ``found``
(every question that came back, with the reason for which it was refused, null if it is kept). A round is decided from these
alone, so a stopped run goes on with the round that lacks. Tasks and questions are some thousand rows of configuration;
the calls are rows of a Spark job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamstack.operators import pool, questions

#: Questions of a task in one round, rounds, and how many known questions a prompt repeats.
CHUNK, ROUNDS, SHOWN = 25, 3, 40
#: More is asked than lacks, as some will be refused; tokens for each question and for all.
SPARE, EXTRA, TOKENS_EACH, TOKENS_MORE, LEAST_TOKENS, LEAST_ASK = 1.6, 2, 64, 512, 2048, 5
_ASKED = "round int, task string, want int, budget int, ask int, outcome string, n_kept long"
_FOUND = "round int, task string, question string, pos int, reason string"


def reply_state(text: Column) -> Column:
    """whole: a JSON array; salvaged: whole items of a torn one; torn: not one item; none: no array at all; silent: no text."""
    items = questions.parse_array(text)
    whole = F.get_json_object(F.concat(F.lit('{"v":'), F.regexp_extract(text, r"(?s)\[.*\]", 0), F.lit("}")), "$.v")
    opened = F.contains(text, F.lit("["))
    return (F.when(F.coalesce(F.trim(text), F.lit("")) == "", "silent").when(items.isNotNull() & whole.isNotNull(), "whole").when(items.isNotNull(), "salvaged").when(opened, "torn").otherwise("none"))


def checked(replies: DataFrame, known: DataFrame) -> DataFrame:
    """Questions of ``replies`` (request, task, text) with pos, state (see ``reply_state``) and reason (null: kept).

    A question repeats if ``known`` (task, question) has it or if an earlier one of its task in the same round does (by request and pos).
    """
    said = replies.select("request", "task", reply_state(F.col("text")).alias("state"), F.posexplode(questions.parse_array(F.col("text"))).alias("pos", "question"))
    trimmed = said.filter(F.col("question").isNotNull()).withColumn("question", F.trim("question"))
    old = known.select("task", F.trim("question").alias("question")).distinct().withColumn("_old", F.lit(True))
    again = F.row_number().over(W.partitionBy("task", "question").orderBy("request", "pos")) > 1
    joined = trimmed.withColumn("_again", again).join(old, ["task", "question"], "left")
    repeated = F.col("_again") | F.coalesce("_old", F.lit(False))
    return joined.select("request", "task", "question", "pos", "state", questions.reject_reason(F.col("task"), F.col("question"), repeated).alias("reason"))


def _read(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    there = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    return spark.read.schema(schema).parquet(f"{path}/{name}") if there else spark.createDataFrame([], schema)


class QuestionRounds:
    """The state in ``path`` for ``prompts`` (task, prompt; ``{n}`` is the number of questions asked for) and ``seeds`` (task, question)."""

    def __init__(self, prompts: DataFrame, seeds: DataFrame, path: str):
        self.spark, self.prompts, self.seeds, self.path = prompts.sparkSession, prompts, seeds, path.rstrip("/")

    def asked(self) -> DataFrame:
        return _read(self.spark, self.path, "asked", _ASKED)

    def found(self) -> DataFrame:
        """Questions of finished rounds."""
        return _read(self.spark, self.path, "found", _FOUND).join(self.asked().select("round").distinct(), "round", "left_semi")

    def bank(self, target: int) -> DataFrame:
        """task, question, ord: the first ``target`` questions that were kept for each task."""
        place = F.row_number().over(W.partitionBy("task").orderBy("round", "pos", "question"))
        return self.found().filter("reason IS NULL").select("task", "question", place.alias("ord")).filter(F.col("ord") <= target)

    def due(self, target: int, chunk: int = CHUNK) -> DataFrame:
        """task, prompt, want, budget, ask of the next round: tasks that lack questions and haven't been given up.

        A task is given up after a round without a question, unless its answer was torn: then it is asked for half as many.
        """
        have = self.found().filter("reason IS NULL").groupBy("task").agg(F.count("*").alias("have"))
        last = self.asked().groupBy("task").agg(F.max_by(F.struct("ask", "outcome", "n_kept"), "round").alias("last"))
        first = F.least(F.lit(chunk), F.floor(F.lit(target) * SPARE + EXTRA)).cast("int")
        rows = self.prompts.join(have, "task", "left").join(last, "task", "left").withColumn("need", F.lit(target) - F.coalesce("have", F.lit(0)))
        torn = F.col("last.outcome") == "torn"
        ask = F.when(F.col("last").isNull(), first).when((F.col("last.n_kept") == 0) & torn, F.greatest(F.lit(LEAST_ASK), F.floor(F.col("last.ask") / 2))).otherwise(F.col("last.ask")).cast("int")
        given_up = F.coalesce((F.col("last.n_kept") == 0) & ~torn, F.lit(False))
        open_ = rows.filter((F.col("need") > 0) & ~given_up).withColumn("ask", ask)
        want = F.least(F.col("ask"), (F.floor(F.col("need") * SPARE) + EXTRA).cast("int"))
        known = self.found().filter("reason IS NULL").withColumn("_r", F.row_number().over(W.partitionBy("task").orderBy(F.desc("round"), F.desc("pos")))).filter(F.col("_r") <= SHOWN)
        shown = known.groupBy("task").agg(F.array_sort(F.collect_list(F.struct((-F.col("_r")).alias("o"), "question"))).alias("shown"))
        joined = open_.withColumn("want", want).join(shown, "task", "left")
        listed = F.concat(F.lit("\n\n已有的问题，请勿重复：\n"), F.array_join(F.transform("shown", lambda x: F.concat(F.lit("- "), x["question"])), "\n"))
        text = F.concat(F.replace(F.col("prompt"), F.lit("{n}"), F.col("want").cast("string")), F.coalesce(listed, F.lit("")))
        return joined.select("task", text.alias("prompt"), "want", F.greatest(F.lit(LEAST_TOKENS), F.col("want") * TOKENS_EACH + TOKENS_MORE).cast("int").alias("budget"), "ask")

    def run(self, clients: dict[str, Callable[[str, int], str]], target: int, rounds: int = ROUNDS, chunk: int = CHUNK, strategy: str = "round_robin", workers: int = 16) -> DataFrame:
        """Rounds until every task has ``target`` questions, is given up, or ``rounds`` have been made in all; returns the bank."""
        models = [{"name": n} for n in clients]
        while (done := (self.asked().agg(F.max("round")).first()[0] or 0)) < rounds:
            # Fixed rows: a round's requests are as many as there are tasks.
            due = self.due(target, chunk).orderBy("task").collect()
            if not due:
                break
            number = done + 1
            requests = self.spark.createDataFrame([(i, *r) for i, r in enumerate(due)], "request long, task string, prompt string, want int, budget int, ask int")
            log = pool.call(requests.withColumn("route", pool.route(models, strategy, F.col("request"))), clients, workers=workers)
            log.write.mode("overwrite").parquet(f"{self.path}/log/round={number}")
            said = self.spark.read.parquet(f"{self.path}/log/round={number}").filter("ok").select(F.col("request").cast("long"), "text")
            replies = requests.select("request", "task").join(said, "request")
            known = self.seeds.select("task", "question").unionByName(self.found().filter("reason IS NULL").select("task", "question"))
            checked(replies, known).select("task", "question", "pos", "reason").write.mode("overwrite").parquet(f"{self.path}/found/round={number}")
            kept = self.spark.read.parquet(f"{self.path}/found/round={number}").filter("reason IS NULL").groupBy("task").agg(F.count("*").alias("n_kept"))
            state = replies.select("task", reply_state(F.col("text")).alias("outcome"))
            outcome = requests.join(state, "task", "left").join(kept, "task", "left")
            # A round counts when this table is there.
            outcome.select("task", "want", "budget", "ask", F.coalesce("outcome", F.lit("silent")).alias("outcome"), F.coalesce("n_kept", F.lit(0)).cast("long").alias("n_kept")).write.mode("overwrite").parquet(f"{self.path}/asked/round={number}")
        return self.bank(target)

    def report(self, target: int) -> DataFrame:
        """task, n (kept, at most the target), refused, short (whether the target was missed)."""
        counts = self.found().groupBy("task").agg(F.count_if(F.col("reason").isNull()).alias("k"), F.count("reason").alias("refused"))
        n = F.least(F.coalesce("k", F.lit(0)), F.lit(target)).cast("long")
        return self.prompts.select("task").join(counts, "task", "left").select("task", n.alias("n"), F.coalesce("refused", F.lit(0)).alias("refused"), (n < target).alias("short"))
