"""Calls of several language models: the order in which they are tried, the calls themselves, and what the log of calls says.

Models are dictionaries (name, and if wanted enabled, tags, weight, generation), a handful from configuration; a client is a
function from prompt to text. Requests are rows and are never gathered.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamstack.functions import draws

# Ends of addresses that clients add by themselves.
ENDPOINTS = ("/chat/completions", "/completions", "/embeddings")
LOG = "request string, n int, model string, ok boolean, latency_ms long, err string, text string"


def base_url(address: str | None) -> str:
    """The address without a slash at its end and without the endpoint."""
    found = (address or "").strip().rstrip("/")
    return next((found[: -len(e)] for e in ENDPOINTS if found.endswith(e)), found)


def available(models: list[dict], purpose: dict | None = None) -> list[dict]:
    """Enabled models that a purpose names ("*" or no names: all) and that share one of its tags, if it has any."""
    purpose = purpose or {}
    names, tags = purpose.get("models") or ["*"], set(purpose.get("tags") or ())
    return [m for m in models if m.get("enabled", True) and ("*" in names or m["name"] in names) and (not tags or tags & set(m.get("tags", ())))]


def parameters(*layers: dict | None) -> dict:
    """Later layers win: all models, the model, the purpose, the call. Keys with a leading underscore are notes."""
    return {k: v for layer in layers for k, v in (layer or {}).items() if not k.startswith("_")}


def route(models: list[dict], strategy: str, request: Column, seed: int = 0) -> Column:
    """The names of ``models`` in the order in which a request tries them; empty without models.

    failover: as configured. round_robin: begins at the request's number modulo the models (``request`` is a number).
    Any other: the first is drawn by weight (all alike if no weight is above 0), the rest come in drawn order.
    """
    names = [m["name"] for m in models]
    if not names:
        return F.array().cast("array<string>")
    every = F.array(*map(F.lit, names))
    if strategy == "failover":
        return every
    if strategy == "round_robin":
        start = F.pmod(request, F.lit(len(names))).cast("int")
        return F.transform(every, lambda _, i: F.get(every, (i + start) % len(names)))
    weights = [max(0.0, m.get("weight", 1.0)) for m in models]
    weights = weights if sum(weights) else [1.0] * len(names)
    bounds = [sum(weights[: i + 1]) / sum(weights) for i in range(len(names))]
    u = draws.uniform(seed, request)
    first = F.coalesce(*[F.when(u < b, n) for n, b in zip(names, bounds, strict=True)])
    return F.transform(F.array_sort(F.transform(every, lambda n: F.struct((n != first).alias("later"), draws.key(seed, request, n).alias("h"), n.alias("name")))), lambda x: x["name"])


def _said(text: str | None) -> bool:
    """Whether anything stands outside reasoning."""
    return bool(re.sub(r"(?is)<(think|reason)\w*\s*>.*?(</\1\w*\s*>|\Z)", "", text or "").strip())


def call(requests: DataFrame, clients: dict[str, Callable[..., str]], retries: int = 1, backoff: float = 0.0, workers: int = 16) -> DataFrame:
    """One row for each attempt on ``requests`` (request, prompt, route). ``workers`` bounds the requests that run at once.

    With a column ``budget`` clients are called with the prompt and the tokens that the answer may have.

    A model is tried ``retries`` more times, then the next of the route, until one says something; an answer of reasoning
    alone is a failure, as is a name without a client. A null route or prompt is an empty one.
    """

    given = ["prompt"] + ["budget"] * ("budget" in requests.columns)

    def attempts(names: list[str], *asked) -> Iterator[tuple]:
        for name in names:
            for again in range(retries + 1):
                if again:
                    time.sleep(backoff * 2 ** (again - 1))
                text, start = None, time.monotonic()
                try:
                    text = clients[name](*asked)
                    err = None if _said(text) else "empty"
                except Exception as x:  # whatever a model does, the next one is tried
                    err = type(x).__name__
                yield name, err is None, int(1000 * (time.monotonic() - start)), err, text
                if err is None:
                    return

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            asked = zip(*[b[c] for c in given], strict=True)
            rows = [(i, n, *a) for i, names, x in zip(b["request"], b["route"], asked, strict=True) for n, a in enumerate(attempts(list(names), *x))]
            yield pd.DataFrame(rows, columns=["request", "n", "model", "ok", "latency_ms", "err", "text"])

    asked = requests.select(F.col("request").cast("string"), F.coalesce("prompt", F.lit("")).alias("prompt"), F.coalesce("route", F.array().cast("array<string>")).alias("route"), *given[1:])
    return asked.repartition(workers).mapInPandas(run, LOG)


def summary(log: DataFrame) -> DataFrame:
    """model (``*``: all), calls, ok, fail, success_rate, avg_latency_s of a log (model, ok, latency_ms)."""
    one = log.select(F.coalesce("model", F.lit("")).alias("model"), F.coalesce("ok", F.lit(False)).cast("bigint").alias("ok"), F.coalesce("latency_ms", F.lit(0)).alias("ms"))
    found = one.rollup("model").agg(F.count("*").alias("calls"), F.sum("ok").alias("ok"), F.sum("ms").alias("ms"))
    rate, mean = F.round(F.col("ok") / F.col("calls"), 4), F.round(F.col("ms") / F.col("calls") / 1000, 2)
    return found.filter("calls > 0").select(F.coalesce("model", F.lit("*")).alias("model"), "calls", "ok", (F.col("calls") - F.col("ok")).alias("fail"), rate.alias("success_rate"), mean.alias("avg_latency_s"))


def top_errors(log: DataFrame, most: int = 10) -> DataFrame:
    """err, n: the most frequent errors of failed calls, ties by text."""
    return log.filter("not ok and err <> ''").groupBy("err").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "err").limit(most)


def adoption(records: DataFrame) -> DataFrame:
    """dim, value, n of rewritten records (task, rewritten_by, rewritten, rewrite_rejected): total, adopted, by task and model, why refused."""
    pair = lambda when, dim, value: F.when(when, F.struct(F.lit(dim).alias("dim"), value.alias("value")))
    ok, none = F.coalesce("rewritten", F.lit(False)), F.lit("")
    pairs = F.array(pair(F.lit(True), "total", none), pair(ok, "adopted", none), pair(ok, "task", F.coalesce("task", none)), pair(ok & F.col("rewritten_by").isNotNull(), "model", F.col("rewritten_by")),
                    pair(~ok, "refused", F.coalesce("rewrite_rejected", F.lit("no_response"))))
    return records.select(F.explode(F.array_compact(pairs)).alias("p")).groupBy("p.dim", "p.value").agg(F.count("*").alias("n"))
