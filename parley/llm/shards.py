"""K-d tree sharding: shards of near-equal bytes whose rows are alike in their metadata."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.session import materialize

#: Bytes that a record takes beside its text.
RECORD_BYTES = 8
#: A coordinate is a whole number: the scaled metadata value, then a hash that puts equal values in an order.
VALUE_BITS, TIE_BITS = 24, 36
#: Bins of a histogram in the search for a weighted median.
BINS = 4096
#: A cut may miss its share by so much of a shard.
TOLERANCE = 1e-3
#: Rows that are numbered together within a shard.
CELL_ROWS = 10_000

_TOP = 1 << (VALUE_BITS + TIE_BITS)


@dataclass
class Node:
    """A branch of the tree: leaves ``first`` to ``first + leaves - 1``, and where it is cut."""

    first: int
    leaves: int
    axis: str = ""
    cut: int = 0
    low: int = 0
    high: int = _TOP
    below: int = 0
    share: float = 0.0
    children: list[Node] = field(default_factory=list)


def size_of(text: Column) -> Column:
    """Bytes that a text takes in a shard."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + RECORD_BYTES


def _number(col: Column, kind: str) -> Column:
    """A metadata value as a number: numbers as they are, text by its first bytes; null is null."""
    if kind == "string":
        bytes_of = F.substring(col.cast("binary"), 1, 6)
        return F.conv(F.rpad(F.hex(bytes_of), 12, "0"), 16, 10).cast("double")
    return col.cast("double")


def _coordinates(df: DataFrame, dims: dict[str, Column]) -> DataFrame:
    """Every dimension scaled to whole numbers over its range in the table; nulls come first."""
    names = list(dims)
    ends = df.agg(*(f(d).alias(f"{n}_{f.__name__}") for n, d in dims.items() for f in (F.min, F.max))).first()
    # Equal texts stand side by side, so only a cut through their group parts them.
    of_text = F.shiftrightunsigned(F.xxhash64("crc", "size"), 64 - TIE_BITS // 2)
    of_row = F.when(F.col("number") > 0, F.xxhash64("key", "number")).otherwise(F.xxhash64("key"))
    tie = F.shiftleft(of_text, TIE_BITS // 2) + F.shiftrightunsigned(of_row, 64 - TIE_BITS // 2)
    out = {}
    for n in names:
        low, high = ends[f"{n}_min"], ends[f"{n}_max"]
        if low is None or high <= low:
            value = F.when(dims[n].isNull(), F.lit(0)).otherwise(F.lit(1))
        else:
            value = F.coalesce(F.floor((dims[n] - low) / (high - low) * ((1 << VALUE_BITS) - 2)) + 1, F.lit(0))
        out[n] = F.shiftleft(value.cast("long"), TIE_BITS) + tie
    return df.select("key", "size", "crc", "number", *(c.alias(n) for n, c in out.items()))


def _counted_repeats(sized: DataFrame) -> DataFrame:
    """Column ``number``: 0, 1, 2 and so on for rows equal in key and text, so that a cut can part them.

    Rows are numbered inside each split (column ``split``), after those of the splits before it, so that
    no task sees more than a split's rows however many are equal.
    """
    same = F.xxhash64("key", "crc", "size")
    if sized.groupBy(same).count().where("count > 1").isEmpty():
        return sized.withColumn("number", F.lit(0).cast("long"))
    sized = sized.withColumn("same", same)
    counts = sized.groupBy("same", "split").agg(F.count("*").alias("n"))
    before = Window.partitionBy("same").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("same", "split", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("same", "split").orderBy("key")) - 1
    numbered = sized.withColumn("within", within).join(offsets, ["same", "split"])
    return numbered.withColumn("number", F.col("within") + F.col("before")).drop("same", "within", "before")


def _leaf(node: Node) -> Column:
    """The first leaf of the undivided branch that a row belongs to."""
    if not node.children:
        return F.lit(node.first)
    low, high = node.children
    return F.when(F.col(node.axis) < F.lit(node.cut), _leaf(low)).otherwise(_leaf(high))


def _widest(rows: DataFrame, root: Node, level: list[Node], names: list[str]) -> None:
    """Choose for every node of the level the dimension with the widest spread of values."""
    value = {n: F.shiftright(n, TIE_BITS) for n in names}
    found = rows.groupBy(_leaf(root).alias("leaf")).agg(
        F.sum("size").alias("bytes"),
        *((F.max(value[n]) - F.min(value[n])).alias(n) for n in names),
    )
    by_leaf = {r["leaf"]: r for r in found.collect()}  # one row a shard at most
    for node in level:
        r = by_leaf.get(node.first)
        node.axis = max(names, key=lambda n: r[n] if r else 0)
        node.share = (r["bytes"] if r else 0) * (node.leaves // 2) / node.leaves


def _medians(rows: DataFrame, root: Node, level: list[Node], slack: float) -> None:
    """Weighted medians of all nodes of a level, by histograms that narrow down around them."""
    open_nodes = list(level)
    leaf = _leaf(root)
    while open_nodes:
        at = [
            (n, F.floor((F.col(n.axis) - n.low) / F.lit(max(1, -(-(n.high - n.low) // BINS))))) for n in open_nodes
        ]
        inside = [(leaf == n.first) & F.col(n.axis).between(n.low, n.high - 1) for n in open_nodes]
        pick = reduce(
            lambda whole, one: whole.when(one[1], F.struct(F.lit(one[0][0].first).alias("leaf"), one[0][1].alias("bin"))),
            zip(at[1:], inside[1:], strict=True),
            F.when(inside[0], F.struct(F.lit(at[0][0].first).alias("leaf"), at[0][1].alias("bin"))),
        )
        # At most BINS rows for each node reach the driver.
        counted = rows.select(pick.alias("p"), "size").where("p IS NOT NULL").groupBy("p").agg(F.sum("size").alias("b"))
        bins: dict[int, list[tuple[int, int]]] = {}
        for r in counted.collect():
            bins.setdefault(r["p"]["leaf"], []).append((r["p"]["bin"], r["b"]))
        left = []
        for n in open_nodes:
            width = max(1, -(-(n.high - n.low) // BINS))
            for b, size in sorted(bins.get(n.first, ())):
                if n.below + size >= n.share:
                    break
                n.below += size
            else:
                n.cut = n.high
                continue
            low, high = n.low + b * width, min(n.high, n.low + (b + 1) * width)
            if size <= slack or width == 1:
                n.cut = low if n.share - n.below < n.below + size - n.share else high
            else:
                n.low, n.high = low, high
                left.append(n)
        open_nodes = left


def kd_tree(rows: DataFrame, names: list[str], shards: int, total: int) -> Node:
    """Cut the rows again and again at weighted medians, until every leaf holds the target bytes."""
    root = Node(0, shards)
    level = [root] if shards > 1 else []
    while level:
        _widest(rows, root, level, names)
        _medians(rows, root, level, TOLERANCE * total / shards)
        for n in level:
            half = n.leaves // 2
            n.children = [Node(n.first, half), Node(n.first + half, n.leaves - half)]
        level = [c for n in level for c in n.children if c.leaves > 1]
    return root


def shard(
    df: DataFrame,
    shards: int = 24,
    dims: tuple[str, ...] = ("n_chars", "lang"),
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """Columns key, ``size``, ``text_crc32``, ``shard`` and ``slot`` for every row.

    The tree splits at the weighted median of the dimension that is widest in a
    branch (each scaled to its range in the table), in the proportion of the
    leaves below, so shards have near-equal bytes: a cut misses by
    ``TOLERANCE`` of a shard, or half a row, at most. Equal values, as of a source
    with a third of all rows, are put in order by a hash, so a large group
    is cut as well; equal texts agree in length and language and so stay together unless a cut goes through their group.
    Rows equal in key and text are told apart by a number, so a group of them is cut too. Null dimensions come first, a null text has size 8 and
    checksum 0, an empty table gives no rows. Slots are numbered without gaps in
    each shard; repeated rows and null keys get slots of their own.

    Texts are read once, for their sizes; what is cut is a table of a few numbers
    a row. A level costs one pass for the spreads and about two for the medians.
    """
    kinds = dict(df.dtypes)
    prepared = df.select(
        F.col(f"`{key}`").alias("key"),
        size_of(F.col(f"`{text}`")).alias("size"),
        F.crc32(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")).alias("crc"),
        F.spark_partition_id().alias("split"),
        *(_number(F.col(f"`{d}`"), kinds[d]).alias(f"d{i}") for i, d in enumerate(dims)),
    )
    names = [f"d{i}" for i in range(len(dims))]
    sized = _counted_repeats(materialize(prepared, "sizes"))
    rows = materialize(_coordinates(sized, {n: F.col(n) for n in names}), "coordinates")
    total, n = rows.agg(F.sum("size"), F.count("*")).first()
    tree = kd_tree(rows, names, shards, total or 0)
    cells = max(1, -(-n // (shards * CELL_ROWS)))
    return _numbered(rows.withColumn("shard", _leaf(tree)), cells, key)


def _numbered(rows: DataFrame, cells: int, key: str) -> DataFrame:
    """Slots in each shard: cells of a shard follow one another, rows of a cell are numbered by key."""
    rows = rows.withColumn("cell", F.pmod(F.xxhash64("key", "crc", "size", "number"), F.lit(cells)))
    rows = materialize(rows.select("key", "size", "crc", "number", "shard", "cell"), "shards")
    counts = rows.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("shard", "cell").orderBy("key", "crc", "size", "number")
    placed = rows.withColumn("slot", F.row_number().over(within) - 1).join(offsets, ["shard", "cell"])
    return placed.select(
        F.col("key").alias(key),
        "size",
        F.col("crc").alias("text_crc32"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("slot") + F.col("before")).cast("long").alias("slot"),
    )
