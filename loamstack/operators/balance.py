"""Balancing, quotas and sampling. Counts of a few strata reach the driver; rows never do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamstack.operators.chain import Chain

#: Values of a column by which rows are balanced; the counts of so many reach the driver, more are refused.
MOST_STRATA = 100_000


def counts(df: DataFrame, col: str) -> dict:
    found = df.groupBy(col).count().limit(MOST_STRATA + 1).collect()
    if len(found) > MOST_STRATA:
        raise ValueError(f"{col} has more than {MOST_STRATA} values: it is no column of strata")
    return {r[0]: r[1] for r in found}


def take_per(df: DataFrame, col: str, takes: dict, seed: int, *ids: Column) -> DataFrame:
    """The first ``takes[value]`` rows (none if absent) of each value of ``col``, in the order of their draws."""
    return Chain(df, [col], seed, *ids).first({(k,): v for k, v in takes.items()}).apply()


def label_takes(sizes: dict, ratio: float) -> dict:
    """All anomalous rows (and those of other labels), and at most floor(anomalous * ratio) normal ones."""
    return {k: v for k, v in sizes.items() if k != "normal"} | {"normal": int(sizes.get("anomalous", 0) * ratio)}


def balance_labels(samples: DataFrame, ratio: float, seed: int = 0, id_col: str = "sample_id") -> DataFrame:
    """See ``label_takes``; a ratio of 0 or less keeps all."""
    if ratio <= 0:
        return samples
    chain = Chain(samples, ["label"], seed, F.col(id_col))
    label = lambda cell: cell[0]
    return chain.first(label_takes(chain.sizes(label), ratio), label).apply()


def water_level(sizes: list[int], max_share: float) -> int:
    """The largest level L with min(largest, L) <= share * sum(min(size, L)); share is at least 1 / sources."""
    if not sizes:
        return 0
    share, most = max(max_share, 1 / len(sizes)), max(sizes)
    low, high = 0, most
    while low < high:
        mid = (low + high + 1) // 2
        if min(most, mid) <= share * sum(min(s, mid) for s in sizes) + 1e-9:
            low = mid
        else:
            high = mid - 1
    return low


def share_takes(sizes: dict, max_share: float) -> dict:
    """By (dataset, label) of the same sizes: no dataset above ``max_share``; what a dataset loses is spread over its labels in proportion."""
    size: dict = {}
    for (d, _), n in sizes.items():
        size[d] = size.get(d, 0) + n
    level, takes = water_level(list(size.values()), max_share), {}
    for d, n in size.items():
        anomalous = sizes.get((d, "anomalous"), 0)
        some = anomalous if n <= level else round(level * (anomalous / n))
        takes |= {(d, "anomalous"): some, (d, "normal"): min(n, level) - some}
    return takes


class Sampling(Chain):
    """Steps on samples (dataset, label) that read them once and are applied in one filter: ``Sampling(s).cap_source_share(0.4).balance_labels(1.0).apply()``."""

    def __init__(self, samples: DataFrame, seed: int = 0, id_col: str = "sample_id"):
        super().__init__(samples, ["dataset", "label"], seed, F.col(id_col))

    def cap_source_share(self, max_share: float) -> Sampling:
        return self.first(share_takes(self.sizes(), max_share))

    def balance_labels(self, ratio: float) -> Sampling:
        label = lambda cell: cell[1]
        return self.first(label_takes(self.sizes(label), ratio), label) if ratio > 0 else self

    def weigh_sources(self, weights: dict[str, float]) -> Sampling:
        """As a last step; see ``weigh_sources``."""
        dataset = lambda cell: cell[0]
        return self.spread({d: round(n * max(0.0, weights.get(d, 1.0))) for d, n in self.sizes(dataset).items()}, dataset)


def cap_source_share(samples: DataFrame, max_share: float, seed: int = 0, id_col: str = "sample_id") -> DataFrame:
    """No dataset above ``max_share`` of the result; see ``share_takes``."""
    return Sampling(samples, seed, id_col).cap_source_share(max_share).apply()


def weigh_sources(samples: DataFrame, weights: dict[str, float], seed: int = 0, id_col: str = "sample_id") -> DataFrame:
    """Weight 0 drops a dataset, below 1 takes round(n * w) rows, above 1 adds copies until round(n * w); ``copy`` counts from 0."""
    chain = Chain(samples, ["dataset"], seed, F.col(id_col))
    dataset = lambda cell: cell[0]
    want = {d: round(n * max(0.0, weights.get(d, 1.0))) for d, n in chain.sizes(dataset).items()}
    return chain.spread(want, dataset).apply().withColumnRenamed("_copy", "copy")


def cap_classes(records: DataFrame, tasks: list[str], times: float, max_copies: float = 3.0, seed: int = 0, id_col: str = "qa_id") -> DataFrame:
    """In ``tasks``, bring classes (target_type) between median / times and median * times; the median is the upper one.

    Small classes get copies with ids ``id#osN`` and oversampled = true, at most ``max_copies`` times their size.
    """
    mine = F.col("task").isin(tasks) & F.col("target_type").isNotNull()
    part = records.filter(mine)
    chain = Chain(part, ["target_type"], seed, F.col(id_col))
    size = chain.sizes(lambda cell: cell[0])
    out = records.withColumn("oversampled", F.lit(False))
    if not size:
        return out
    middle = sorted(size.values())[len(size) // 2]
    cap = max(1, int(middle * times))
    floor = max(1, int(cap / times))
    want = {t: min(cap, max(n, min(floor, int(n * max_copies)))) for t, n in size.items()}
    copies = chain.spread(want, lambda cell: cell[0]).apply()
    name = F.when(F.col("_copy") == 0, F.col(id_col)).otherwise(F.concat(F.col(id_col), F.lit("#os"), F.col("_copy").cast("string")))
    done = copies.withColumn(id_col, name).withColumn("oversampled", F.col("_copy") > 0).select(*records.columns, "oversampled")
    return out.filter(~mine | F.col("target_type").isNull()).unionByName(done)


def auto_total(sizes: dict[str, int], ratio: dict[str, float], share: float = 0.6) -> int:
    """The total at which tasks with ``share`` of the weight are not short: a weighted quantile of size / ratio."""
    weight = sum(r for t, r in ratio.items() if r > 0 and sizes.get(t))
    caps = sorted((sizes[t] / (r / weight), r / weight) for t, r in ratio.items() if r > 0 and sizes.get(t))
    run = 0.0
    for cap, w in caps:
        run += w
        if run >= share - 1e-9:
            return int(cap)
    return int(caps[-1][0]) if caps else 0


def strict_total(sizes: dict[str, int], ratio: dict[str, float]) -> int:
    weight = sum(r for t, r in ratio.items() if r > 0 and sizes.get(t))
    return int(min((sizes[t] / (r / weight) for t, r in ratio.items() if r > 0 and sizes.get(t)), default=0))


def quota_takes(sizes: dict[str, int], ratio: dict[str, float], total: int, rounds: int = 4) -> dict[str, int]:
    """Rows of each task: shares of what is left among tasks that still have rows, in at most ``rounds`` rounds."""
    open_, takes, left = {t: r for t, r in ratio.items() if r > 0 and sizes.get(t)}, {}, total
    for _ in range(rounds):
        weight = sum(open_.values())
        if left <= 0 or not open_:
            break
        now = left
        for t in list(open_):
            want, have = round(now * open_[t] / weight), sizes[t] - takes.get(t, 0)
            got = min(want, have)
            takes[t], left = takes.get(t, 0) + got, left - got
            if have <= want:
                del open_[t]
    return takes


def quota_sample(records: DataFrame, ratio: dict[str, float], total: int | None = None, seed: int = 0, id_col: str = "qa_id") -> DataFrame:
    """Rows of each task by quota; tasks outside ``ratio`` are dropped; an empty ratio keeps all."""
    if not ratio:
        return records
    chain = Chain(records, ["task"], seed, F.col(id_col))
    task = lambda cell: cell[0]
    sizes = chain.sizes(task)
    return chain.first(quota_takes(sizes, ratio, auto_total(sizes, ratio) if total is None else total), task).apply()


def mix_general(train: DataFrame, pool: DataFrame, share: float, seed: int = 0, id_col: str = "qa_id") -> DataFrame:
    """``train`` with rows of ``pool`` until they make up ``share`` (0 to 0.5, exclusive); pool rows repeat if they are too few."""
    if not 0 < share < 0.5:
        return train
    chain = Chain(pool.withColumn("_all", F.lit(1)), ["_all"], seed, F.col(id_col))
    want = int(train.count() * share / (1 - share))
    if not chain.sizes() or not want:
        return train
    picked = chain.spread({(1,): want}).apply().drop("_all", "_copy")
    return train.unionByName(picked, allowMissingColumns=True)


def ratio_gap(records: DataFrame, ratio: dict[str, float]) -> DataFrame:
    """task, target, actual, attain (actual / target, 3 digits)."""
    weight = sum(r for r in ratio.values() if r > 0)
    table = records.sparkSession.createDataFrame([(t, r / weight) for t, r in ratio.items() if r > 0], "task string, target double")
    total = records.agg(F.count("*").alias("_all"))
    found = records.groupBy("task").agg(F.count("*").alias("n"))
    joined = table.join(found, "task", "left").crossJoin(F.broadcast(total))  # one row of totals
    actual = F.coalesce(F.col("n"), F.lit(0)) / F.col("_all")
    return joined.select("task", F.round("target", 4).alias("target"), F.round(actual, 4).alias("actual"), F.round(actual / F.col("target"), 3).alias("attain"))
