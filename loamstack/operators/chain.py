"""Chained sampling that is decided from one count table.

All steps of a chain keep the first rows of their strata in one order, that of the rows' draws. So what is left of a cell
(the rows that agree in all columns a chain looks at) is always the first n of it, and a step changes nothing but these
numbers. Rows are read once, for a narrow table of cell, draw and ids, and counted by cell and first digits of the draw. On these
counts a step finds the digits at which its take is reached; where several cells meet in those digits, it counts the rows
with just these digits by the next ones, until they are few enough to be looked at. At the end each cell has one last
draw, and a single filter applies all steps to the rows.

Counts that reach the driver: cells (at most ``MOST_CELLS``, more are refused) times first digits (at most ``MOST_COUNTS``
in all), and at most ``FEW`` draws at a time. Rows with the same draw and ids are in or out together.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable
from functools import reduce
from operator import and_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamstack.functions.draws import MOST_SENT, key
from loamstack.operators.split import written

MOST_CELLS, MOST_COUNTS, FEW = 100_000, 2_000_000, 5000
#: Hex digits of a draw, and those that a closer look adds.
DIGITS, MORE = 32, 4


def _sortable(place: tuple) -> tuple:
    """Nulls first, as Spark orders them."""
    return tuple((v is not None, v) for v in place)


class Chain:
    """Steps on the strata of ``df`` that ``by`` spans; ``first``, ``spread``, then ``apply`` or ``marked``."""

    def __init__(self, df: DataFrame, by: list[str], seed: int | str, *ids: Column):
        self.df, self.by, self.spark = df, by, df.sparkSession
        self.place = F.struct(key(seed, *ids).alias("k"), *[c.alias(f"i{n}") for n, c in enumerate(ids)])
        own = df.select(*[F.col(c).alias(f"c{n}") for n, c in enumerate(by)], self.place.alias("p"))
        self.rows = written(own, "draws")
        columns = [f"c{n}" for n in range(len(by))]
        cells = self.rows.groupBy(*columns).agg(F.count("*").alias("n")).limit(MOST_CELLS + 1).collect()
        if len(cells) > MOST_CELLS:
            raise ValueError(f"{by} have more than {MOST_CELLS} combinations: they are no columns of strata")
        self.cells = {tuple(r[c] for c in columns): i for i, r in enumerate(cells)}
        self.size = np.array([r["n"] for r in cells], np.int64)
        self.take, self.whole = self.size.copy(), np.ones(len(cells), np.int64)
        self.extra, self.copied = np.zeros(len(cells), np.int64), False
        digits = 0
        while digits < MORE and len(cells) * 16 ** (digits + 1) <= MOST_COUNTS:
            digits += 1
        self.digits = max(1, digits)
        self.counts = self._counted("", self.digits, None)

    def _same(self, cells: list[int] | None) -> Column:
        """Whether a row of the narrow table is of one of the cells."""
        if cells is None or len(cells) == len(self.cells):
            return F.lit(True)
        names = list(self.cells)
        return reduce(lambda a, b: a | b, [reduce(and_, [F.col(f"c{n}").eqNullSafe(F.lit(v)) for n, v in enumerate(names[i])], F.lit(True)) for i in cells])

    def _counted(self, prefix: str, digits: int, cells: list[int] | None) -> np.ndarray:
        """Rows by cell (all of them) and by the next ``digits`` of the draws that begin with ``prefix``, added up; a zero in front."""
        columns = [f"c{n}" for n in range(len(self.by))]
        next_ = F.conv(F.substring("p.k", len(prefix) + 1, digits), 16, 10).cast("int").alias("d")
        found = self.rows.filter(F.col("p.k").startswith(prefix) & self._same(cells)).groupBy(*columns, next_).agg(F.count("*").alias("n")).collect()
        out = np.zeros((len(self.cells), 16**digits + 1), np.int64)
        for r in found:
            out[self.cells[tuple(r[c] for c in columns)], r["d"] + 1] = r["n"]
        return out.cumsum(axis=1)

    def _first(self, cells: list[int], left: np.ndarray, n: int, prefix: str, counts: np.ndarray) -> np.ndarray:
        """Of the first ``left[c]`` rows of each cell (with draws that begin with ``prefix``) how many are among the first n of all."""
        out = np.zeros_like(left)
        total = left[cells].sum()
        if n >= total:
            out[cells] = left[cells]
            return out
        if n <= 0:
            return out
        if len(alive := [c for c in cells if left[c]]) == 1:
            out[alive[0]] = n
            return out
        kept = np.minimum(counts[alive], left[alive][:, None])
        at = int(np.searchsorted(kept.sum(axis=0), n)) - 1
        out[alive] = kept[:, at]
        inside = np.zeros_like(left)
        inside[alive] = kept[:, at + 1] - kept[:, at]
        digits = len(f"{counts.shape[1] - 2:x}")
        prefix, n = prefix + f"{at:0{digits}x}", n - int(kept[:, at].sum())
        if (counts[alive, at + 1] - counts[alive, at]).sum() <= FEW or len(prefix) >= DIGITS:
            return out + self._looked_at(alive, inside, n, prefix)
        further = min(MORE, DIGITS - len(prefix))
        return out + self._first(alive, inside, n, prefix, self._counted(prefix, further, alive))

    def _draws(self, prefix: str, cells: list[int]) -> list[tuple[tuple, int]]:
        """Place and cell of the rows whose draws begin with ``prefix``, in order."""
        columns = [f"c{n}" for n in range(len(self.by))]
        found = self.rows.filter(F.col("p.k").startswith(prefix) & self._same(cells)).collect()
        return sorted(((tuple(r["p"]), self.cells[tuple(r[c] for c in columns)]) for r in found), key=lambda x: _sortable(x[0]))

    def _looked_at(self, cells: list[int], left: np.ndarray, n: int, prefix: str) -> np.ndarray:
        out = np.zeros_like(left)
        for _, c in self._draws(prefix, cells):
            if out[c] < left[c] and n:
                out[c] += 1
                n -= 1
        return out

    def sizes(self, of: Callable[[tuple], Hashable] = lambda cell: cell) -> dict:
        """Rows that are left, by stratum."""
        out: dict = {}
        for cell, i in self.cells.items():
            out[of(cell)] = out.get(of(cell), 0) + int(self.take[i])
        return out

    def _strata(self, of: Callable[[tuple], Hashable]) -> dict:
        out: dict = {}
        for cell, i in self.cells.items():
            out.setdefault(of(cell), []).append(i)
        return out

    def first(self, takes: dict, of: Callable[[tuple], Hashable] = lambda cell: cell) -> Chain:
        """Keep the first ``takes[stratum]`` rows (none if absent) of each stratum; ``of`` names a cell's stratum."""
        take = np.zeros_like(self.take)
        for name, cells in self._strata(of).items():
            take += self._first(cells, self.take, int(takes.get(name, 0)), "", self.counts)
        self.take = take
        return self

    def spread(self, want: dict, of: Callable[[tuple], Hashable] = lambda cell: cell) -> Chain:
        """As a last step: copies of the rows of each stratum until there are ``want[stratum]``: whole rounds, then the first."""
        sizes, self.copied = self.sizes(of), True
        for name, cells in self._strata(of).items():
            rounds, rest = divmod(int(want.get(name, 0)), sizes[name]) if sizes[name] else (0, 0)
            self.whole[cells] = rounds
            self.extra += self._first(cells, self.take, rest, "", self.counts)
        return self

    def _last(self, takes: np.ndarray) -> dict[int, tuple]:
        """The last place that is in, for each cell of which some rows are in and some are not."""
        out: dict[int, tuple] = {}
        edges: dict[str, list[int]] = {}
        rest = takes.copy()
        for c in np.flatnonzero((takes > 0) & (takes < self.size)):
            at = int(np.searchsorted(self.counts[c], takes[c])) - 1
            rest[c] = takes[c] - self.counts[c, at]
            if self.counts[c, at + 1] - self.counts[c, at] <= FEW:
                edges.setdefault(f"{at:0{self.digits}x}", []).append(int(c))
            else:
                out[int(c)] = self._deep(int(c), f"{at:0{self.digits}x}", int(rest[c]))
        while edges:
            # As many edges at a time as hold few rows.
            batch, held = [], 0
            for prefix in list(edges):
                at = int(prefix, 16)
                rows = sum(int(self.counts[c, at + 1] - self.counts[c, at]) for c in edges[prefix])
                if batch and held + rows > 20 * FEW:
                    break
                batch.append((prefix, edges.pop(prefix)))
                held += rows
            kind = T.StructType([T.StructField("edge", T.StringType()), *[T.StructField(f"e{n}", self.rows.schema[f"c{n}"].dataType) for n in range(len(self.by))]])
            names = list(self.cells)
            table = self.spark.createDataFrame([(p, *names[c]) for p, cells in batch for c in cells], kind)
            on = reduce(and_, [F.substring("p.k", 1, self.digits) == F.col("edge"), *[F.col(f"c{n}").eqNullSafe(F.col(f"e{n}")) for n in range(len(self.by))]])
            found: dict[int, list[tuple]] = {}
            for r in self.rows.join(F.broadcast(table), on, "left_semi").collect():
                found.setdefault(self.cells[tuple(r[f"c{n}"] for n in range(len(self.by)))], []).append(tuple(r["p"]))
            for c, places in found.items():
                out[c] = sorted(places, key=_sortable)[int(rest[c]) - 1]
        return out

    def _deep(self, cell: int, prefix: str, n: int) -> tuple:
        """The n-th place of a cell among the draws that begin with ``prefix``."""
        while len(prefix) < DIGITS:
            further = min(MORE, DIGITS - len(prefix))
            counts = self._counted(prefix, further, [cell])[cell]
            at = int(np.searchsorted(counts, n)) - 1
            prefix, n = prefix + f"{at:0{further}x}", n - int(counts[at])
            if counts[at + 1] - counts[at] <= FEW:
                break
        return self._draws(prefix, [cell])[n - 1][0]

    def marked(self) -> DataFrame:
        """``df`` with ``_copies``: how often a row is in the result."""
        last, extra = self._last(self.take), self._last(self.extra)
        place = self.rows.schema["p"].dataType
        named = [(f"__limit_{n}", self.df.schema[c].dataType) for n, c in enumerate(self.by)] + [("__limit_whole", T.LongType())]
        named += [x for k in ("take", "extra") for x in ((f"__limit_{k}", T.StringType()), (f"__limit_last_{k}", place))]
        state = lambda takes, i: "none" if not takes[i] else "all" if takes[i] == self.size[i] else "some"
        rows = [(*cell, int(self.whole[i]), state(self.take, i), last.get(i), state(self.extra, i), extra.get(i)) for cell, i in self.cells.items()]
        limits = self.spark.createDataFrame(rows, T.StructType([T.StructField(*x) for x in named]))
        limits = F.broadcast(limits) if len(rows) <= MOST_SENT else limits
        inside = lambda k: F.when(F.col(f"__limit_{k}") == "some", self.place <= F.col(f"__limit_last_{k}")).otherwise(F.col(f"__limit_{k}") == "all")
        on = reduce(and_, [self.df[c].eqNullSafe(limits[f"__limit_{n}"]) for n, c in enumerate(self.by)])
        copies = F.when(inside("take"), F.col("__limit_whole") + inside("extra").cast("long")).otherwise(0)
        return self.df.join(limits, on).select(*[self.df[c] for c in self.df.columns], copies.alias("_copies"))

    def apply(self) -> DataFrame:
        """The rows that are left; after ``spread`` each as often as wanted, numbered by ``_copy`` from 0."""
        some = self.marked().filter("_copies > 0")
        if not self.copied:
            return some.drop("_copies")
        return some.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies").cast("int") - 1))).drop("_copies")
