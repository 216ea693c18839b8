"""A cache of rewritten answers that is written while a run goes on, so that a stopped run loses one step at most.

The cache is a folder of JSON lines (k, a, m, why), one subfolder for each attempt and step: ``attempt=1/step=0``. A run
deals the questions that the cache lacks into steps by their key and answers one step after the other; each step is a
Spark job whose files appear when it is done. The next run anti-joins what is there, whatever became of the one before.
Lines that are torn (copied while written, say) are passed over on reading, so their questions are asked again. A key may
occur in several attempts; ``enrich.latest`` picks the row that counts.

Refused answers are kept with the reason and not asked again; ``again`` names reasons that are.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstack.functions import text as X
from loamstack.operators import enrich
from loamstack.operators.split import new_folder, written

#: Questions between two commits, and the largest number of steps of a run (beyond it steps grow).
FLUSH_ROWS, MOST_STEPS = 20_000, 1000
_LINE = "k string, a string, m string, why string, _torn string"


def step_of(key, steps: int):
    """The step in which a question is asked."""
    return F.pmod(F.conv(F.substring(key, 1, 8), 16, 10).cast("long"), F.lit(steps)).cast("int")


class RewriteCache:
    """The cache in ``path``, which need not exist yet."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _exists(self) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def rows(self) -> DataFrame:
        """k, a (null if refused), m, why, attempt, step: all whole lines."""
        if not self._exists():
            return self.spark.createDataFrame([], "k string, a string, m string, why string, attempt int, step int")
        found = self.spark.read.schema(_LINE + ", attempt int, step int").option("columnNameOfCorruptRecord", "_torn").json(self.path)
        return found.filter("_torn IS NULL AND k IS NOT NULL").drop("_torn")

    def latest(self) -> DataFrame:
        """One row for each question: k, a, why."""
        return enrich.latest(self.rows())

    def missing(self, records: DataFrame, again: tuple[str, ...] = ()) -> DataFrame:
        """Eligible questions (k, question, answer) without a row, each once; those refused for a reason in ``again`` count as without."""
        known = self.latest()
        return enrich.pending(records, known.filter(F.col("a").isNotNull() | F.col("why").isNull() | ~F.col("why").isin(*again)) if again else known)

    def fill(self, records: DataFrame, model: Callable[[str, str], str], name: str | None = None, workers: int = 16, steps: int | None = None, most: int | None = None, again: tuple[str, ...] = ()) -> int:
        """Ask ``model`` what is missing and commit each step; returns the number of this attempt.

        ``steps`` fixes how many there are (otherwise FLUSH_ROWS questions each); ``most`` ends the run after so many.
        """
        asked = written(self.missing(records, again), "asked")
        steps = steps or min(MOST_STEPS, math.ceil(asked.count() / FLUSH_ROWS) or 1)
        attempt = (self.rows().agg(F.max("attempt")).first()[0] or 0) + 1
        folder = new_folder(self.spark, "steps")
        asked.withColumn("step", step_of(F.col("k"), steps)).repartition(steps, "step").write.partitionBy("step").parquet(folder)
        dealt = self.spark.read.schema("k string, question string, answer string, step int").parquet(folder)
        for step in range(steps if most is None else min(most, steps)):
            found = enrich.ask(dealt.filter(F.col("step") == step).drop("step"), model, workers)
            # Overwrites what a failed try of this very step may have left.
            found.select("k", "a", F.when(F.col("a").isNotNull(), F.lit(name)).alias("m"), "why").write.mode("overwrite").json(f"{self.path}/attempt={attempt}/step={step}")
        return attempt

    def apply(self, records: DataFrame) -> DataFrame:
        """See ``enrich.apply``."""
        return enrich.apply(records, self.rows())

    def compact(self, path: str) -> RewriteCache:
        """A new cache in ``path`` with one row for each question, as attempt 0."""
        one = self.rows().groupBy("k").agg(F.max_by(F.struct("a", "m", "why"), F.struct(F.col("a").isNotNull().alias("ok"), "attempt", "step")).alias("r"))
        one.select("k", "r.*").write.json(f"{path.rstrip('/')}/attempt=0/step=0")
        return RewriteCache(self.spark, path)

    def report(self, records: DataFrame) -> DataFrame:
        """task, asked (distinct questions), hits, accepted and refused ones among the hits."""
        asked = records.filter(enrich.eligible(records)).select("task", X.cache_key(F.col("task"), F.col("question"), F.col("answer")).alias("k")).distinct()
        joined = asked.join(self.latest().withColumn("hit", F.lit(1)), "k", "left").groupBy("task")
        return joined.agg(F.count("*").alias("asked"), F.count("hit").alias("hits"), F.count("a").alias("accepted"), F.count("why").alias("refused"))

