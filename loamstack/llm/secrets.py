"""Secret scanning with DataFrame expressions only: three fixed patterns and a pair of character Markov models.

Fixed patterns give the base spans. Besides, every long run of credential characters, or what base spans leave of it, is
scored by two first-order character models, one of random strings and one of ordinary identifiers. If the log-likelihood
ratio in favour of "random" reaches ``min_llr`` (nats) in all and ``PER_SIGN`` for each sign, it becomes a span of kind
``random``. The models are counts of first signs and of pairs of labelled samples with add-one smoothing, folded into one
table of ratios over alphabet**2 pairs and one of first signs.

Positions come from the pieces between the matches (``split``) and the matches (``regexp_extract_all``): the lengths
of what stands before a match add up to its start, in code points.

Edge cases: a null text counts as empty; spans of one kind never overlap, spans of different kinds may; repeated rows
each get their result; an empty table gives an empty result; without samples every run scores 0 and none is added.
Only the columns doc_id and text are read by ``scan``; ``redact`` keeps all columns and changes text alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns, their kinds in order, and the least lengths of what they match.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 8
#: A run of 16 or more that starts with AKIA, and one of 32 or more: a shorter run can hold no such match.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

#: What may stand in a credential; longest runs of RUN_LEAST or more are scored.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN_LEAST = 20
RUN = rf"[A-Za-z0-9+/_=-]{{{RUN_LEAST},}}"
MIN_LLR, PER_SIGN = 12.0, 0.6
SAMPLE_ROWS = 4000
#: Words of the labelled ordinary identifiers, besides those of the documents.
NAMES = (
    "the", "quick", "brown", "fox", "jumps", "over", "lazy", "dog", "get", "set", "list", "map", "name", "value", "index", "count", "size", "length", "first", "last", "next", "find", "make",
    "build", "create", "read", "write", "open", "close", "load", "save", "send", "receive", "request", "response", "client", "server", "session", "user", "account", "order", "item", "price",
    "total", "number", "string", "object", "array", "integer", "boolean", "default", "config", "option", "setting", "handler", "manager", "factory", "service", "controller", "model", "view",
    "template", "import", "export", "common", "collect", "util", "utils", "core", "base", "test", "tests", "main", "source", "package", "module", "class", "method", "function", "abstract",
    "immutable", "sorted", "multi", "public", "private", "static", "final", "google", "apache", "spring", "java", "python", "org", "com", "net", "www", "http", "https", "html", "index",
    "image", "images", "content", "upload", "download", "documents", "report", "reports", "version", "release", "update", "delete", "insert", "select", "column", "table", "schema",
    "database", "connection", "address", "network", "protocol", "buffer", "stream", "reader", "writer", "parser", "format", "language", "english", "message", "error", "exception", "warning",
    "debug", "logger", "thread", "process", "memory", "system", "kernel", "driver", "device", "window", "button", "layout", "style", "color", "width", "height",
)

_SPAN = "array<struct<start:int,end:int>>"


def _spans(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """Start and end of each match, leftmost first; with ``least``, only those whose group is that long."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    sized = F.zip_with(found, F.regexp_extract_all(text, F.lit(pattern), group), lambda m, g: F.struct(F.length(m).alias("n"), (F.length(g) >= least).alias("ok"))) if least else \
        F.transform(found, lambda m: F.struct(F.length(m).alias("n"), F.lit(True).alias("ok")))
    steps = F.zip_with(F.transform(F.slice(gaps, 1, F.size(found)), F.length), sized, lambda g, m: F.struct(g.alias("g"), m["n"].alias("n"), m["ok"].alias("ok")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(acc: Column, s: Column) -> Column:
        begin = acc["at"] + s["g"]
        end = begin + s["n"]
        return F.struct(end.alias("at"), F.when(s["ok"], F.concat(acc["spans"], F.array(F.struct(begin.alias("start"), end.alias("end"))))).otherwise(acc["spans"]).alias("spans"))

    return F.when(text.rlike(pattern), F.aggregate(steps, start, step)["spans"]).otherwise(F.array().cast(_SPAN))


def default_samples(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Labelled samples (token, is_random): digests in several alphabets against identifiers.

    Ordinary ones are words of at most ``rows`` documents (those with the least hashes), alone and joined as in names and
    paths, ``rows`` identifiers and paths of NAMES, UUIDs, numbers, and rules of one repeated sign.
    """
    spark = docs.sparkSession
    d = F.sha2(F.col("id").cast("string"), 512)
    b64 = F.regexp_replace(F.base64(F.unhex(d)), r"[\r\n=]", "")
    random = spark.range(rows).select(F.explode(F.array(
        F.substring(b64, 1, 40), F.upper(F.substring(F.regexp_replace(b64, r"[+/]", ""), 1, 24)),
        F.substring(F.regexp_replace(b64, r"[+/]", ""), 30, 32), F.translate(F.substring(b64, 40, 40), "+/", "-_"))).alias("token"), F.lit(True).alias("is_random"))
    # Only ids are ordered; at most ``rows`` of them are sent round, and texts stay where they are.
    picked = docs.select(F.col("doc_id").alias("_picked")).filter("_picked is not null").orderBy(F.xxhash64("_picked"), "_picked").limit(rows)
    words = docs.join(F.broadcast(picked), docs["doc_id"] == picked["_picked"], "left_semi").filter(F.length("text") > 0).select(F.regexp_extract_all("text", F.lit(r"(?<![A-Za-z0-9+/_=-])[A-Za-z]{2,19}(?![A-Za-z0-9+/_=-])"), 0).alias("w"))

    def joined(w: Column) -> Column:
        title = F.transform(w, lambda x: F.initcap(x))
        return F.array(F.array_join(w, "_"), F.array_join(w, "-"), F.array_join(w, "/"), F.upper(F.array_join(w, "_")), F.array_join(title, ""),
                       F.concat(F.array_join(F.slice(w, 1, 3), "/"), F.lit("/"), F.array_join(title, "")))

    ordinary = words.select(F.explode(F.concat("w", F.transform("w", lambda x: F.upper(x)), joined(F.slice("w", 1, 6)))).alias("token"))
    # Six names for each number, drawn by its digest.
    name = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.get(F.array(*map(F.lit, NAMES)), (F.conv(F.substring(d, 1 + i * 4, F.lit(4)), 16, 10).cast("int") % len(NAMES))))
    named = spark.range(rows).select(F.explode(joined(name)).alias("token"))
    uuid = F.concat_ws("-", F.substring(d, 1, 8), F.substring(d, 9, 4), F.substring(d, 13, 4), F.substring(d, 17, 4), F.substring(d, 21, 12))
    plain = spark.range(rows).select(F.explode(F.array(
        F.lpad(F.col("id").cast("string"), 24, "0"), F.conv(F.substring(d, 1, 15), 16, 10), uuid, F.upper(uuid), *[F.lit(c * 40) for c in "-=_/+"])).alias("token"))
    return random.unionByName(ordinary.unionByName(named).unionByName(plain).withColumn("is_random", F.lit(False)))


class MarkovRatio:
    """Log-likelihood ratios of first signs and of pairs, random against ordinary."""

    def __init__(self, table: dict[str, float], start: dict[str, float] | None = None):
        self.table, self.start = table, start or {}

    @classmethod
    def fit(cls, samples: DataFrame) -> MarkovRatio:
        """Counts in all samples; what reaches the driver is at most 2 * alphabet * (alphabet + 1) counts."""
        inside = samples.select(F.regexp_extract_all("token", F.lit(r"[A-Za-z0-9+/_=-]{2,}"), 0).alias("runs"), "is_random").select(F.explode("runs").alias("token"), "is_random")
        # A sign alone is a first one.
        pairs = inside.select("is_random", F.explode(F.transform(F.sequence(F.lit(0), F.length("token") - 1), lambda i: F.when(i == 0, F.col("token").substr(1, 1)).otherwise(F.col("token").substr(i, F.lit(2))))).alias("pair"))
        counts: dict[bool, dict[str, int]] = {True: {}, False: {}}
        for r in pairs.groupBy("is_random", "pair").count().collect():
            counts[r["is_random"]][r["pair"]] = r["count"]

        def ratios(before: str) -> dict[str, float]:
            whole = {k: sum(c.get(before + b, 0) for b in ALPHABET) + len(ALPHABET) for k, c in counts.items()}
            return {before + b: math.log((counts[True].get(before + b, 0) + 1) / whole[True]) - math.log((counts[False].get(before + b, 0) + 1) / whole[False]) for b in ALPHABET}

        return cls({k: v for a in ALPHABET for k, v in ratios(a).items()}, ratios(""))

    def score(self, token: Column) -> Column:
        """The ratio of a token of ALPHABET, as a fold over its pairs with literal tables."""
        n = len(ALPHABET)
        number = lambda values: F.split(F.lit(",".join(f"{v:.6f}" for v in values)), ",").cast("array<double>")
        place = F.split(F.lit(",".join(str(ALPHABET.find(chr(c))) for c in range(128))), ",").cast("array<int>")
        ratio, start = number(self.table[a + b] for a in ALPHABET for b in ALPHABET), number(self.start.get(a, 0.0) for a in ALPHABET)
        places = F.transform(F.split(token, ""), lambda c: F.get(place, F.ascii(c)))
        return F.aggregate(F.sequence(F.lit(0), F.size(places) - 2), F.get(start, F.get(places, 0)), lambda acc, i: acc + F.get(ratio, F.get(places, i) * n + F.get(places, i + 1)))

    def is_random(self, token: Column, min_llr: float = MIN_LLR, per_sign: float = PER_SIGN) -> Column:
        return self.score(token) >= F.greatest(F.lit(min_llr), F.length(token) * per_sign)


def _outside(run: Column, base: Column) -> Column:
    """What sorted base spans leave of a run, in parts."""
    kind = "array<struct<start:int,end:int>>"
    span = lambda a, b: F.array(F.struct(a.alias("start"), b.alias("end")))
    begin = F.struct(run["start"].alias("at"), F.array().cast(kind).alias("parts"))

    def step(acc: Column, b: Column) -> Column:
        parts = F.when(b["start"] > acc["at"], F.concat(acc["parts"], span(acc["at"], b["start"]))).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), parts.alias("parts"))

    touching = F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
    return F.aggregate(touching, begin, step, lambda acc: F.when(acc["at"] < run["end"], F.concat(acc["parts"], span(acc["at"], run["end"]))).otherwise(acc["parts"]))


def scan(docs: DataFrame, model: MarkovRatio, min_llr: float = MIN_LLR) -> DataFrame:
    """doc_id and spans array<struct<start,kind,end>> by start, then kind; kind is a place in KINDS."""
    text = F.col("text")
    kind = lambda spans, k: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end")))
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text", F.concat(kind(_spans(text, ASSIGN, 1, ASSIGN_LEAST), 0), kind(_spans(text, ACCESS), 1), kind(_spans(text, HEX), 2)).alias("base"), _spans(text, RUN).alias("runs"))
    free = base.select("doc_id", "text", "base", F.filter(F.flatten(F.transform("runs", lambda r: _outside(r, F.array_sort("base")))), lambda r: r["end"] - r["start"] >= RUN_LEAST).alias("runs"))
    odd = F.filter("runs", lambda r: model.is_random(F.substring(F.col("text"), r["start"] + 1, r["end"] - r["start"]), min_llr))
    return free.select("doc_id", F.array_sort(F.concat("base", kind(odd, 3))).alias("spans"))


def joined(spans: Column) -> Column:
    name = lambda k: F.get(F.array(*map(F.lit, KINDS)), k)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, model: MarkovRatio, min_llr: float = MIN_LLR, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (overlapping spans by one mark); all rows stay."""
    # Spans are computed beside the row, so that ids need not be unique.
    text, whole = F.col("_row.text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    spans = scan(docs.select(whole.alias("doc_id"), "text"), model, min_llr).withColumnRenamed("doc_id", "_row")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def cut(acc: Column, s: Column) -> Column:
        piece = F.when(s["start"] >= acc["at"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], piece).alias("out"))

    cuts = F.aggregate("spans", start, cut, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text) - acc["at"])))
    new = F.when(F.size("spans") > 0, cuts).otherwise(text)
    return spans.select(*[(new if c == "text" else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
