"""Quality rules with cross-document line frequency, in Spark expressions only.

1. Each text is measured in its row: words, their code points, symbols, lines equal to an earlier one, and the words of
   8-word windows that the text holds twice or more. A window is the hash of its words' hashes (64 bits).
2. Lines are normalised (lower case, white space runs as one space, numbers as 0) and hashed (64 bits). For each host the
   distinct texts that hold a line are counted: copies of a text count once, they are the work of the deduplication.
3. A line above the limit of its host is removed: in over ``LEAST_DOCUMENTS`` texts and over ``SHARE`` of the host's texts.
   A document that loses more than ``MOST_LOST`` of its words to removed lines is depleted and rejected.

Lines meet the frequent ones in a shuffle join. Lines with over 1/``HOT`` of all rows, at most ``HOT`` by that bound, are
decided by a broadcast before it, so that no line fills a task.

Edge cases: a null text counts as empty and has no words, so the base rules reject it; a null host is the host ''; without a
host column all rows are of one host; rows with one doc_id count one by one; doc_id may be null and of any type; lines
without a word are neither counted nor removed; an empty table gives an empty result; columns other than doc_id, the host
and text are never looked at (``clean`` carries them along).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamstack.llm.store import materialise

#: White space and symbols of the contract, words of a window, base limits.
BLANK, SYMBOLS, WINDOW = r"[\x20\x09-\x0D]", r"[#*$%&|<>]", 8
FEWEST_WORDS, MOST_REPEATED = 20, 30
LEAST_DOCUMENTS, SHARE, MOST_LOST = 20, 0.001, 0.5
HOT = 2000


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]+", "0"), BLANK + "+", " "))


def line_hash(line: Column) -> Column:
    return F.xxhash64(normalised(line))


def _shifted(values: Column, by: int) -> Column:
    return F.slice(values, by + 1, F.greatest(F.size(values) - by, F.lit(0)))


def _windows(hashes: Column) -> Column:
    """The hash of each run of ``WINDOW`` words, from those of 1, 2 and 4 words."""
    for by in (1, 2, 4):
        hashes = F.zip_with(hashes, _shifted(hashes, by), lambda a, b: F.xxhash64(a, b))
    return hashes


def _covered(windows: Column) -> Column:
    """Words in windows that occur twice or more: equal neighbours in the sorted windows, then the lengths between their places."""
    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    pairs = F.filter(F.zip_with(ordered, _shifted(ordered, 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))), lambda p: p.isNotNull())
    places = F.sort_array(F.array_distinct(F.flatten(pairs)))
    lengths = F.zip_with(places, _shifted(places, 1), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda n, x: n + x)


def measured(docs: DataFrame, host: str | None = "source", row: str | None = None) -> DataFrame:
    """row (a number of its own, or the column of that name), doc_id, host, digest, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lines (hash and words of each)."""
    own = docs.select((F.col(row) if row else F.monotonically_increasing_id()).alias("row"), "doc_id", (F.coalesce(F.col(host).cast("string"), F.lit("")) if host else F.lit("")).alias("host"), F.coalesce("text", F.lit("")).alias("text"))
    cut = own.select("row", "doc_id", "host", F.xxhash64("text").alias("digest"), "text", F.split("text", BLANK).alias("pieces"),
                     F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    # A split at single signs: one piece more than there are signs of white space.
    hashed = cut.select("row", "doc_id", "host", "digest", F.transform(F.filter("pieces", lambda w: w != ""), lambda w: F.xxhash64(w)).alias("words"),
                        (F.length("text") - F.size("pieces") + 1).cast("long").alias("word_chars"), F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                        F.transform("lines", lambda x: F.struct(line_hash(x).alias("hash"), F.size(words_of(x)).alias("words"))).alias("lines"))
    n = F.size("words")
    windows = F.when(n >= WINDOW, F.slice(_windows(F.col("words")), 1, n - WINDOW + 1)).otherwise(F.array().cast("array<long>"))
    with_windows = hashed.select("row", "doc_id", "host", "digest", n.cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", "lines", windows.alias("windows"))
    repeat = F.when(F.size(F.array_distinct("windows")) < F.size("windows"), _covered(F.col("windows"))).otherwise(F.lit(0).cast("long"))
    done = with_windows.select("row", "doc_id", "host", "digest", "n_words", "word_chars", "n_symbols", "n_dup_lines", repeat.alias("n_repeat_words"), "lines")
    return done.withColumn("base_failed", (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def _decided(rows: DataFrame, least: int, share: float) -> tuple[DataFrame, DataFrame]:
    """Lines (host, hash): those with over 1/HOT of all rows, with their verdict, and the other frequent ones."""
    lines = rows.select("host", "digest", F.explode("lines.hash").alias("hash"))
    by_text = lines.groupBy("host", "hash", "digest").agg(F.count("*").alias("n"))
    counted = by_text.groupBy("host", "hash").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_texts"))
    total = rows.agg(F.sum(F.size("lines"))).first()[0] or 0
    some = materialise(counted.filter((F.col("n_texts") > least) | (F.col("n_rows") > total / HOT)), "lines")
    hosts = rows.groupBy("host", "digest").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("n_host"))
    judged = materialise(some.join(hosts, "host").withColumn("frequent", (F.col("n_texts") > least) & (F.col("n_texts") > share * F.col("n_host"))), "judged-lines")
    hot = F.col("n_rows") > total / HOT
    return judged.filter(hot).select("host", "hash", "frequent"), judged.filter(~hot & F.col("frequent")).select("host", "hash")


def _removed(rows: DataFrame, least: int, share: float) -> DataFrame:
    """row, hash, words: the lines that go."""
    hot, rare = _decided(rows, least, share)
    lines = rows.select("row", "host", F.explode("lines").alias("line")).select("row", "host", "line.hash", "line.words")
    known = lines.join(F.broadcast(hot), ["host", "hash"], "left")
    columns = ["row", "hash", "words"]
    return known.filter("frequent").select(columns).unionByName(known.filter("frequent IS NULL").join(rare, ["host", "hash"]).select(columns))


def _verdict(rows: DataFrame, removed: DataFrame, lost: float) -> DataFrame:
    gone = removed.groupBy("row").agg(F.sum("words").alias("n_removed_words"))
    joined = rows.drop("lines").join(gone, "row", "left").withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)).cast("long"))
    return joined.withColumn("kept", ~F.col("base_failed") & (F.col("n_removed_words") <= lost * F.col("n_words")))


def judge(docs: DataFrame, host: str | None = "source", least: int = LEAST_DOCUMENTS, share: float = SHARE, lost: float = MOST_LOST) -> DataFrame:
    """One row for each row of ``docs``: doc_id, the measures, base_failed, n_removed_words, kept."""
    rows = materialise(measured(docs, host), "measures")
    return _verdict(rows, _removed(rows, least, share), lost).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")


def clean(docs: DataFrame, host: str | None = "source", least: int = LEAST_DOCUMENTS, share: float = SHARE, lost: float = MOST_LOST) -> DataFrame:
    """The documents that are kept, without the removed lines; all columns of ``docs``."""
    # Written with their numbers: both passes have to see the same ones.
    numbered = materialise(docs.select(F.monotonically_increasing_id().alias("_line_row"), F.struct(*[docs[c] for c in docs.columns]).alias("_own")), "documents")
    keyed = numbered.select(F.col("_line_row"), *[F.col(f"_own.`{c}`").alias(c) for c in {"doc_id", "text", *([host] if host else [])}])
    rows = materialise(measured(keyed, host, "_line_row"), "measures")
    removed = materialise(_removed(rows, least, share), "removed")
    stay = _verdict(rows, removed, lost).filter("kept").select(F.col("row").alias("_line_row"))
    gone = removed.groupBy(F.col("row").alias("_line_row")).agg(F.collect_set("hash").alias("_gone"))
    joined = numbered.join(stay, "_line_row").join(gone, "_line_row", "left")
    left = F.array_join(F.filter(F.split(F.col("_own.text"), "\n"), lambda x: ~x.rlike(r"[^\x20\x09-\x0D]") | ~F.array_contains("_gone", line_hash(x))), "\n")
    text = F.when(F.col("_gone").isNull(), F.col("_own.text")).otherwise(left)
    return joined.select(*[(text if c == "text" else F.col(f"_own.`{c}`")).alias(c) for c in docs.columns])
