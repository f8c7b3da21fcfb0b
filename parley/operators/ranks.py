"""Exact rank cuts: which rows are the first ``n`` in an order, without sorting them.

Sorting or ranking a whole table would put it into one task. Here the value at
a rank is found by counting: a histogram of the order values' leading bits
shows which bucket the rank falls into, that bucket is counted again by its
next bits, and so on. Every pass is a map-side-combined count over the order
columns only; the driver sees at most a few thousand counts per cut. The answer
is a threshold that each row is then compared with where it lies.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BUCKET_BITS = 12
_LOWEST = -(2**63)


class Cut(tuple):
    """Order values of the last row before a cut; ``tied`` if rows behind it share them."""

    tied = False


# Lowest and highest first order value of a group, and its number of rows.
Bounds = tuple[int, int, int]


@dataclass
class _Search:
    """State of one cut: the rank still to find among the rows of ``node()``."""

    group: str
    rank: int
    fixed: tuple[int, ...] = ()
    low: int | None = None
    high: int | None = None
    cut: Cut | None = None

    def node(self) -> tuple:
        return (self.group, self.fixed, self.low, self.high)


@dataclass
class _Pass:
    """The distinct nodes of the open searches, as one CASE over the rows."""

    searches: list[_Search]
    nodes: list[tuple] = field(init=False)

    def __post_init__(self) -> None:
        self.nodes = list(dict.fromkeys(s.node() for s in self.searches))

    def case(self, value) -> Column:
        out = F.lit(None)
        for i, (group, fixed, low, high) in enumerate(self.nodes):
            test = F.col("_group") == group
            for level, v in enumerate(fixed):
                test = test & (F.col(f"_o{level}") == v)
            if low is not None:
                test = test & F.col(f"_o{len(fixed)}").between(low, high)
            out = F.when(test, value(i, len(fixed))).otherwise(out)
        return out

    def rows(self, slim: DataFrame) -> DataFrame:
        node = self.case(lambda i, _: F.lit(i))
        return slim.withColumn("_node", node).where(F.col("_node").isNotNull())


def order_cuts(
    df: DataFrame,
    group: Column,
    order: Sequence[Column],
    ranks: Mapping[str, Sequence[int]],
    bounds: Mapping[str, Bounds],
) -> dict[str, list[Cut | None]]:
    """For each group and each rank, the order values of the row at that rank.

    ``order`` columns are whole numbers, compared one after another; ``bounds``
    come from ``order_bounds`` or are known beforehand. A rank at or beyond the
    group's size gives None: there is nothing to cut. Rows that share all order
    values with others cannot be told apart: a cut that would have to part them
    comes after all of them and has ``tied`` set.
    """
    slim = df.select(
        group.alias("_group"), *[_whole(o).alias(f"_o{i}") for i, o in enumerate(order)]
    )
    searches = {}
    for g, rs in ranks.items():
        low, high, rows = bounds[g]
        for r in rs:
            cut = None if 0 < r < rows else Cut()
            searches[g, r] = _Search(g, r, low=low, high=high, cut=cut)
    todo = [s for s in searches.values() if s.cut is None]
    while todo:
        _open_level(slim, [s for s in todo if s.low is None])
        todo = [s for s in todo if s.cut is None]
        _narrow(slim, todo, len(order))
        todo = [s for s in todo if s.cut is None]
    return {g: [searches[g, r].cut or None for r in rs] for g, rs in ranks.items()}


def _whole(col: Column) -> Column:
    return F.coalesce(col.cast("bigint"), F.lit(_LOWEST))


def order_bounds(
    df: DataFrame, group: Column, order: Column, at_most: int = 1024
) -> dict[str, Bounds]:
    """Bounds of every group, in one aggregation; one group more than ``at_most`` if there are more."""
    value = _whole(order)
    found = (
        df.groupBy(group.alias("_group"))
        .agg(F.min(value), F.max(value), F.count(F.lit(1)))
        .limit(at_most + 1)
    )
    return {r[0]: (r[1], r[2], r[3]) for r in found.collect()}


def _open_level(slim: DataFrame, searches: list[_Search]) -> None:
    """Range of the next order column's values."""
    if not searches:
        return
    step = _Pass(searches)
    found = (
        step.rows(slim)
        .withColumn("_v", step.case(lambda _, level: F.col(f"_o{level}")))
        .groupBy("_node")
        .agg(F.min("_v"), F.max("_v"))
        .collect()
    )
    bounds = {r[0]: r[1:] for r in found}
    at = [step.nodes.index(s.node()) for s in searches]
    for s, i in zip(searches, at, strict=True):
        s.low, s.high = bounds[i]


def _narrow(slim: DataFrame, searches: list[_Search], levels: int) -> None:
    """Count by leading bits and step into the bucket that holds the rank."""
    if not searches:
        return
    step = _Pass(searches)
    shifts = []
    for _, _, low, high in step.nodes:
        shift = 0
        while (high >> shift) - (low >> shift) >= 2**_BUCKET_BITS:
            shift += 1
        shifts.append(shift)
    counts: dict[int, list[tuple[int, int]]] = {}
    bucket = step.case(lambda i, level: F.shiftright(F.col(f"_o{level}"), shifts[i]))
    found = step.rows(slim).withColumn("_b", bucket).groupBy("_node", "_b").count().collect()
    for node, b, rows in found:
        counts.setdefault(node, []).append((b, rows))
    at = [step.nodes.index(s.node()) for s in searches]
    for s, i in zip(searches, at, strict=True):
        for b, rows in sorted(counts[i]):
            if s.rank <= rows:
                break
            s.rank -= rows
        s.low = max(s.low, b << shifts[i])
        s.high = min(s.high, ((b + 1) << shifts[i]) - 1)
        if s.rank == rows:
            s.cut = Cut((*s.fixed, s.high))
        elif s.low == s.high:
            s.fixed, s.low, s.high = (*s.fixed, s.low), None, None
            if len(s.fixed) == levels:
                s.cut = Cut(s.fixed)
                s.cut.tied = True


def within_cut(order: Sequence[Column], cut: Cut) -> Column:
    """Whether a row comes no later than the cut; nulls come first.

    Plain comparisons, so that the scan can use them too.
    """
    test = F.lit(True)
    for column, value in reversed(list(zip(order, cut, strict=False))):
        if value == _LOWEST:
            before, equal = F.lit(False), column.isNull() | (column == value)
        else:
            before, equal = column.isNull() | (column < value), column == value
        test = before | (equal & test)
    return test
