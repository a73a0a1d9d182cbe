"""Gradient-boosted trees over binned features, trained by distributed histograms and scored as a column expression.

Every level of every tree is one aggregation over the whole table: gradients are summed per node, feature and bin, so
what reaches the driver has a fixed size. A model is a plain Python value and scoring needs no Python on executors.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears_mart.stages import stage_table

_RIDGE = 1.0


@dataclass(frozen=True)
class Split:
    """Rows with `feature` of at most `bin` go low, the others high; a leaf is a plain number."""

    feature: str
    bin: int
    low: Split | float
    high: Split | float


@dataclass(frozen=True)
class Trees:
    base: float
    trees: tuple[Split | float, ...]

    def margin(self, feature: Callable[[str], Column] = F.col) -> Column:
        total = F.lit(self.base)
        for tree in self.trees:
            total = total + _value(tree, feature)
        return total

    def probability(self, feature: Callable[[str], Column] = F.col) -> Column:
        return 1 / (1 + F.exp(-self.margin(feature)))


def _value(tree: Split | float, feature: Callable[[str], Column]) -> Column:
    if not isinstance(tree, Split):
        return F.lit(float(tree))
    return F.when(feature(tree.feature) <= tree.bin, _value(tree.low, feature)).otherwise(_value(tree.high, feature))


def _best(cells: dict[tuple[str, int], tuple[float, float]]) -> tuple[float, str, int, tuple, tuple] | None:
    """The split of one node with the greatest gain: gain, feature, bin, and (gradient, weight) on either side."""
    best = None
    for name in sorted({f for f, _ in cells}):
        bins = sorted((b, *v) for (f, b), v in cells.items() if f == name)
        g, h = sum(x[1] for x in bins), sum(x[2] for x in bins)
        gl = hl = 0.0
        for b, gb, hb in bins[:-1]:
            gl, hl = gl + gb, hl + hb
            gain = gl**2 / (hl + _RIDGE) + (g - gl) ** 2 / (h - hl + _RIDGE) - g**2 / (h + _RIDGE)
            if gain > 1e-6 and (best is None or gain > best[0] + 1e-12):
                best = (gain, name, b, (gl, hl), (g - gl, h - hl))
    return best


def fit(rows: DataFrame, features: Sequence[str], label: str, rounds: int = 10, depth: int = 2, rate: float = 0.4, weight: str | None = None) -> Trees:
    """Trees for rows with whole-number `features` of few values and a 0/1 `label`; all rows count.

    Rows are first grouped to distinct feature values, which is what all rounds read. Null features are a bin below all
    others and rows without a label are left out; `weight` names a column with a row's number of copies. Without rows of both labels the model is a constant.
    """
    binned = rows.where(F.col(label).isNotNull()).select(
        *[F.coalesce(F.col(f).cast("int"), F.lit(-1)).alias(f) for f in features], F.col(label).cast("double").alias("_y"), (F.col(weight) if weight else F.lit(1)).alias("_w")
    )
    table = stage_table(binned.groupBy(*features, "_y").agg(F.sum("_w").alias("_n")), "trees-table")
    ones, n = table.agg(F.sum(F.col("_y") * F.col("_n")), F.sum("_n")).first()
    ones, n = ones or 0.0, n or 0
    model = Trees(math.log((ones + 0.5) / (n - ones + 0.5)), ())
    if not 0 < ones < n:
        return model
    cell = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in features]))
    for _ in range(rounds):
        p = model.probability()
        graded = table.withColumns({"_g": (p - F.col("_y")) * F.col("_n"), "_h": p * (1 - p) * F.col("_n")})
        grown = _grow(graded, cell, depth, rate)
        if not isinstance(grown, Split):
            break
        model = Trees(model.base, (*model.trees, grown))
    return model


def _grow(graded: DataFrame, cell: Column, depth: int, rate: float) -> Split | float:
    """One tree, level by level. `shape` maps a node's path of 0 and 1 to its split, `leaves` open paths to values."""
    shape: dict[str, tuple[str, int]] = {}
    leaves: dict[str, float] = {"": 0.0}
    for level in range(depth):
        open_ = [p for p in leaves if len(p) == level]
        if not open_:
            break
        node = _path(shape, "", level)
        sums = graded.select(node.alias("node"), cell.alias("c"), "_g", "_h").groupBy("node", "c.f", "c.b")
        cells: dict[str, dict[tuple[str, int], tuple[float, float]]] = {}
        for r in sums.agg(F.sum("_g").alias("g"), F.sum("_h").alias("h")).collect():
            cells.setdefault(r.node, {})[(r.f, r.b)] = (r.g, r.h)
        for path in open_:
            found = _best(cells.get(path, {}))
            if found:
                _, name, b, low, high = found
                shape[path] = (name, b)
                del leaves[path]
                for way, (g, h) in (("0", low), ("1", high)):
                    leaves[path + way] = -rate * g / (h + _RIDGE)
    return _tree(shape, leaves, "")


def _path(shape: dict[str, tuple[str, int]], at: str, level: int) -> Column:
    if at not in shape or len(at) == level:
        return F.lit(at)
    name, b = shape[at]
    return F.when(F.col(name) <= b, _path(shape, at + "0", level)).otherwise(_path(shape, at + "1", level))


def _tree(shape: dict, leaves: dict, at: str) -> Split | float:
    if at not in shape:
        return leaves[at]
    return Split(*shape[at], _tree(shape, leaves, at + "0"), _tree(shape, leaves, at + "1"))
