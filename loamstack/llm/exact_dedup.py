"""Exact deduplication against a persistent digest index that is bucketed and sorted by hash.

The index is a catalogue table to which each batch appends one row for each of its distinct normalised texts: ``digest``
(32 bytes), ``keep_id``, ``n`` (its rows in the batch), ``is_new`` and ``batch``. A batch is reduced to one row for each of
its digests before anything is joined, so a text that a third of all rows share crosses the network once per map task.
The batch's groups meet the index in a sort-merge anti join: the index stays where it is (same buckets; each append adds
files to a bucket, so a bucket is sorted again as it is read), and what is new is appended.

Batches are told apart by a number. A batch that is added again, after a lost driver for instance, meets its own rows as
its own: nothing is appended twice and the result is the same.

Edge cases: a null text counts as empty; a null doc_id ranks after all others; of repeated rows with one doc_id and
one text exactly one is kept; an empty table gives an empty result and leaves the index empty. Columns other than
doc_id and text are never looked at, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstack.llm.store import materialise

#: Fixed value: what counts as one space.
BLANKS = r"[\x20\x09-\x0D]+"
#: A digest with over 1/HOT of the rows is hot.
HOT = 2000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


class DigestIndex:
    """A digest table that batches are deduplicated against and then added to."""

    def __init__(self, spark: SparkSession, table: str, buckets: int | None = None):
        self.spark, self.table = spark, table
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def read(self) -> DataFrame:
        """All rows that batches have appended: digest, keep_id, n, is_new, batch."""
        return self.spark.read.table(self.table)

    def groups(self) -> DataFrame:
        """digest, keep_id, group_size (rows of all batches), batch (the one it came with). The buckets spare the shuffle."""
        return self.read().groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"), F.min(F.when(F.col("is_new"), F.col("batch"))).alias("batch"))

    def _append(self, groups: DataFrame) -> None:
        (groups.select("digest", "keep_id", "n", "is_new", "batch").repartition(self.buckets, "digest")
         .write.bucketBy(self.buckets, "digest").sortBy("digest").mode("append").format("parquet").saveAsTable(self.table))

    def record(self, docs: DataFrame, batch: int | None = None) -> DataFrame:
        """Append a batch; returns its rows (digest, doc_id, copies, batch). Without a number the batch is a new one."""
        rows = materialise(docs.select("doc_id", digest(F.col("text")).alias("digest")).groupBy("digest", "doc_id").agg(F.count("*").alias("copies")), "digests")
        groups = rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("n"))
        if not self.exists():
            self._append(groups.limit(0).withColumns({"is_new": F.lit(True), "batch": F.lit(0).cast("long")}))
        if batch is None:
            batch = (self.read().agg(F.max("batch")).first()[0] or 0) + 1
        log = self.read()
        known = log.filter((F.col("batch") != batch) & F.col("is_new")).select("digest", F.col("keep_id").alias("known_id")).hint("merge")
        mine = log.filter(F.col("batch") == batch).select("digest").hint("merge")
        fresh = groups.join(known, "digest", "left_anti").withColumn("is_new", F.lit(True))
        seen = groups.join(known, "digest").select("digest", F.col("known_id").alias("keep_id"), "n", F.lit(False).alias("is_new"))
        # Written first: the table can't be read and appended to at once.
        self._append(materialise(fresh.unionByName(seen).join(mine, "digest", "left_anti").withColumn("batch", F.lit(batch).cast("long")), "digest-groups"))
        return rows.withColumn("batch", F.lit(batch).cast("long"))

    def decide(self, rows: DataFrame) -> DataFrame:
        """For rows of ``record``, one for each row of the batch: doc_id, keep_id, group_size (rows seen so far), kept, digest."""
        # A text that was seen once needs no join. Those with over 1/HOT of all rows, at most HOT, are sent to all tasks, so that no
        # digest fills one; the others are exchanged for this join alone, which adaptive execution may split.
        several = materialise(self.groups().filter("group_size > 1").withColumnRenamed("batch", "first_batch"), "several")
        total = self.read().agg(F.sum("n")).first()[0] or 0
        hot, rest = several.filter(F.col("group_size") > total / HOT), several.filter(F.col("group_size") <= total / HOT)
        known = rows.join(F.broadcast(hot), "digest", "left")
        found = known.filter("group_size IS NOT NULL").unionByName(known.filter("group_size IS NULL").select(*rows.columns).join(rest.hint("merge"), "digest", "left"))
        joined = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        alone = F.col("group_size").isNull()
        first = alone | ((F.col("copy") == 1) & (F.col("batch") == F.col("first_batch")) & F.col("doc_id").eqNullSafe(F.col("keep_id")))
        return joined.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), first.alias("kept"), "digest")

    def add(self, docs: DataFrame, batch: int | None = None) -> DataFrame:
        """Deduplicate a batch against all before it, and add it: see ``decide``."""
        return self.decide(self.record(docs, batch))


def drop_copies(docs: DataFrame, index: DigestIndex, batch: int | None = None) -> DataFrame:
    """``docs`` without rows whose normalised text is in the index or in a row with a smaller doc_id; adds to the index."""
    keep = materialise(index.add(docs, batch).filter("kept").select(F.col("doc_id").alias("_kept_id"), F.col("digest").alias("_kept_digest")), "kept")
    tagged = docs.withColumn("_digest", digest(F.col("text")))
    on = tagged["doc_id"].eqNullSafe(keep["_kept_id"]) & (tagged["_digest"] == keep["_kept_digest"])
    kept = tagged.join(keep, on, "left_semi")
    repeated = docs.groupBy("doc_id").count().filter("count > 1").limit(1).count() > 0
    # Rows with one doc_id and one text are interchangeable for this purpose; any one of them stays.
    return (kept.dropDuplicates(["doc_id", "_digest"]) if repeated else kept).drop("_digest")
