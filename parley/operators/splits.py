"""Splitting, first rows per split, choice of the evaluation split."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.constants import (
    SEED,
    TEST,
    TEST_FRACTION,
    TRAIN,
    VALIDATION,
    VALIDATION_FRACTION,
)
from parley.operators.ranks import Bounds, Cut, order_bounds, order_cuts, within_cut
from parley.sources.datasets import POSITION, SPLIT, named, with_split

# Cuts are one comparison per split in the filter; more splits than this are ranked in windows,
# which then spread over many tasks anyway. Which rows are the first does not depend on it.
_CUT_SPLITS = 64
# Rows of a file that are counted together in stored order, as a power of two; files and splits named in a filter.
_STORED_BITS = 16
_LISTED = 10_000
_WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def split_sizes(rows: int, test: float, validation: float) -> tuple[int, int, int]:
    """Train, validation and test sizes: both cuts round up."""
    held_out = math.ceil((test + validation) * rows)
    share = test / (test + validation) if test + validation > 0 else 0.5
    n_test = math.ceil(share * held_out)
    return rows - held_out, held_out - n_test, n_test


def split_hash(key: Sequence[str], seed: int) -> Column:
    """The hash that orders rows for splitting, as hex: of seed and key, joined by a colon.

    The columns of a composite key are written with their lengths, so that no two keys read alike;
    a null key has no colon and a null column no length.
    """
    values = [named(k).cast("string") for k in key]
    if len(values) == 1:
        return F.sha1(F.concat_ws(":", F.lit(str(seed)), values[0]))
    told = [F.coalesce(F.concat_ws(":", F.length(v).cast("string"), v), F.lit("-")) for v in values]
    sized = [F.when(v.isNull(), F.lit("-")).otherwise(t) for v, t in zip(values, told, strict=True)]
    return F.sha1(F.concat_ws(":", F.lit(str(seed)), *sized))


def _hash_words(digest: Column) -> list[Column]:
    """A 160-bit hex digest as whole numbers that sort the same way."""
    return [
        F.conv(F.substring(digest, at, size), 16, 10).cast("bigint")
        for at, size in ((1, 15), (16, 15), (31, 10))
    ]


def _base_split(df: DataFrame, others: str) -> DataFrame | None:
    """The rows to split: ``train`` if there is one, else the first split; None if all three splits are there.

    What becomes of rows of other splits, a null split among them, the caller must say if there are any.
    Which of the three names there are, and the least of the others, is all that reaches the driver.
    """
    if SPLIT not in df.columns:
        return df
    name = F.col(SPLIT)
    has = [F.max((name == s).cast("int")).alias(s) for s in (TRAIN, VALIDATION, TEST)]
    found = df.agg(*has, F.min(name).alias("least"), F.max(name).alias("most"), F.count_if(name.isNull()).alias("nulls")).first()
    if all(found[s] for s in (TRAIN, VALIDATION, TEST)):
        return None
    base = TRAIN if found[TRAIN] else found["least"]
    single = base is None or (found["least"] == found["most"] and not found["nulls"])
    if single or others == "merge":
        return df
    if others == "drop":
        return df.where(name == base)
    raise ValueError(f"there are other splits beside {base!r}: say others='drop' or others='merge'")


def split_dataset(
    df: DataFrame,
    key: str | Sequence[str],
    test: float = TEST_FRACTION,
    validation: float = VALIDATION_FRACTION,
    seed: int = SEED,
    mode: str = "exact",
    others: str = "error",
) -> DataFrame:
    """Assign each row to train, validation or test by a seeded hash of its key.

    The result does not depend on partitioning or task order. A frame that has
    all three splits is returned as it is. Of a frame with several splits, ``train`` or
    else the first one is split; ``others`` says whether rows of the others are
    an error, are left out (``"drop"``) or are split with them (``"merge"``).

    ``mode="exact"`` gives exactly the asked sizes: the hash values at the two
    cut ranks are found by counting (see ``ranks``), then each row is compared
    with them in place, without a shuffle. Rows with equal keys fall on the same side: a cut that
    would part them comes after all of them, so sizes are exact where keys identify rows. The
    counting passes read only the key, so ``materialize`` an expensive input
    first. ``mode="hash"`` compares the hash with the fractions directly: one
    pass without any count, sizes right on average.
    """
    if mode not in ("exact", "hash"):
        raise ValueError(f"mode must be 'exact' or 'hash', not {mode!r}")
    key = [key] if isinstance(key, str) else list(key)
    if others not in ("error", "drop", "merge"):
        raise ValueError(f"others must be 'error', 'drop' or 'merge', not {others!r}")
    base = _base_split(df, others)
    if base is None:
        return df
    digest = split_hash(key, seed)
    if mode == "hash":
        at = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))
        part = F.when(at < test, TEST).when(at < test + validation, VALIDATION).otherwise(TRAIN)
        return base.withColumn(SPLIT, part)

    rows = base.count()
    _, n_validation, n_test = split_sizes(rows, test, validation)
    order = _hash_words(digest)
    ends = [n_test, n_test + n_validation]
    cuts = order_cuts(base, F.lit("all"), order, {"all": ends}, {"all": (0, 16**15 - 1, rows)})["all"]

    def upto(end: int, cut: Cut | None) -> Column:
        return F.lit(end > 0) if cut is None else within_cut(order, cut)

    in_test, held_out = (upto(end, cut) for end, cut in zip(ends, cuts, strict=True))
    part = F.when(in_test, TEST).when(held_out, VALIDATION).otherwise(TRAIN)
    return base.withColumn(SPLIT, part)


def head_per_split(
    df: DataFrame, n: int, order_by: Sequence[str] = (POSITION,), by: str = SPLIT
) -> DataFrame:
    """The first ``n`` rows of each split.

    Whole-number order columns: the order value at rank ``n`` is found by
    counting, and rows are filtered in place, at the scan where possible, without
    any sort or shuffle. In stored order: rows are counted by file and place, which reads no data
    column, and compared with the place of the last one needed; files behind it are not opened. Stored places tell rows apart
    (``read_dataset``); rows of one place come together. Other orders go through two top-n windows, the first in salted groups, so that no task receives a whole
    split. Rows that share all order values are taken in the order of a hash of the whole row, so that
    the same rows come first whichever way they are found.
    """
    df = with_split(df) if by == SPLIT else df
    order_by = list(order_by)
    if order_by == [POSITION]:
        return _head_stored(df, n, by)
    if n > 0 and all(isinstance(df.schema[c].dataType, _WHOLE_NUMBERS) for c in order_by):
        bounds = order_bounds(df, F.col(by), F.col(order_by[0]), _CUT_SPLITS)
        if len(bounds) <= _CUT_SPLITS:
            df, exact = _head_by_cut(df, n, order_by, by, bounds)
            if exact:
                return df
    tie = F.xxhash64(*[named(f.name) for f in df.schema.fields if _hashable(f.dataType)])
    salted = df.withColumn("_tie", tie).withColumn("_salt", F.pmod("_tie", F.lit(_salts(df))))
    order = [*order_by, "_tie"]
    return _top_n(_top_n(salted, n, [by, "_salt"], order).drop("_salt"), n, [by], order).drop("_tie")


def _hashable(kind: T.DataType) -> bool:
    """Spark hashes no maps, nor what holds them."""
    return "map<" not in kind.simpleString() and "variant" not in kind.simpleString()


def _stored_counts(df: DataFrame, by: str) -> DataFrame:
    """Rows of each group by file and range of places, and how many rows the group has up to there in stored order."""
    at = F.col(POSITION)
    where = [at["part"].alias("part"), at["file"].alias("file"), F.shiftright(at["row"], _STORED_BITS).alias("range")]
    counted = df.groupBy(F.col(by).alias("_by"), *where).agg(F.count(F.lit(1)).alias("rows"))
    so_far = F.sum("rows").over(Window.partitionBy("_by").orderBy("part", "file", "range"))
    return counted.withColumn("before", so_far - F.col("rows"))


def _in_files(df: DataFrame, files: DataFrame) -> DataFrame:
    """The rows of some files; the scan opens no others, unless they are too many to name."""
    names = [r[0] for r in files.select("file").distinct().limit(_LISTED + 1).collect()]
    return df.where(F.col(f"{POSITION}.file").isin(names)) if len(names) <= _LISTED else df


def _stored_places(df: DataFrame, by: str, rank: int, counts: DataFrame) -> DataFrame:
    """Columns ``_by`` and ``_last``: the stored place of each group's row at a rank from 1; none for groups with fewer rows.

    Only the range of places that holds the rank is put in order: at most ``2 ** _STORED_BITS`` places of a group.
    """
    cut = counts.where((F.col("before") < rank) & (F.col("before") + F.col("rows") >= rank))
    slim = _in_files(df, cut).select(F.col(by).alias("_of"), F.col(POSITION).alias("_last"))
    inside = (
        F.col("_of").eqNullSafe(F.col("_by"))
        & F.col("_last.part").eqNullSafe(F.col("part"))
        & (F.col("_last.file") == F.col("file"))
        & (F.shiftright("_last.row", _STORED_BITS) == F.col("range"))
    )
    nth = F.row_number().over(Window.partitionBy("_by").orderBy("_last.row"))
    ranked = slim.join(cut, inside).withColumn("_nth", nth)
    return ranked.where(F.col("_nth") == F.lit(rank) - F.col("before")).select("_by", "_last")


def _head_stored(df: DataFrame, n: int, by: str) -> DataFrame:
    """The first ``n`` rows of each group in stored order: those up to the place of its ``n``-th row."""
    if n <= 0:
        return df.limit(0)
    counts = _stored_counts(df, by)
    places = _stored_places(df, by, n, counts)
    kept = _in_files(df, counts.where(F.col("before") < n))
    few = places.limit(_LISTED + 1).collect()
    if len(few) <= _LISTED:
        places = F.broadcast(df.sparkSession.createDataFrame(few, places.schema))
    ends = kept.join(places, F.col(by).eqNullSafe(F.col("_by")), "left")
    return ends.where(F.col("_last").isNull() | (F.col(POSITION) <= F.col("_last"))).drop("_by", "_last")


def _salts(df: DataFrame) -> int:
    return max(2, math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def _top_n(df: DataFrame, n: int, by: list[str], order_by: list[str]) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(*order_by))
    return df.withColumn("_nth", nth).where(F.col("_nth") <= n).drop("_nth")


def _head_by_cut(
    df: DataFrame, n: int, order_by: list[str], by: str, bounds: dict[str, Bounds]
) -> tuple[DataFrame, bool]:
    """Rows up to each split's cut, and whether these are exactly the first ``n``."""
    order = [F.col(c) for c in order_by]
    exact = bounds.pop(None, None) is None
    found = order_cuts(df, F.col(by), order, {name: [n] for name in bounds}, bounds)
    cuts = {name: cut for name, (cut,) in found.items() if cut is not None}
    exact = exact and not any(cut.tied for cut in cuts.values())
    if not cuts:
        return df, exact
    keep = F.col(by).isNull() | ~F.col(by).isin(*cuts)
    for name, cut in cuts.items():
        keep = keep | ((F.col(by) == name) & within_cut(order, cut))
    return df.where(keep), exact


def select_eval_split(
    df: DataFrame, max_rows: int | None = None, order_by: Sequence[str] = (POSITION,)
) -> DataFrame:
    """All rows, or the first ``max_rows``, of ``validation``, or of ``test`` where validation is empty."""
    for name in (VALIDATION, TEST):
        part = df.where(F.col(SPLIT) == name)
        if not part.select(SPLIT).isEmpty():
            return part if max_rows is None else head_per_split(part, max_rows, order_by)
    raise ValueError("the dataset has neither validation nor test rows")


def pick_example(
    df: DataFrame, split: str = TRAIN, i: int = 0, order_by: Sequence[str] = (POSITION,)
) -> DataFrame:
    """Row ``i`` of a split, or of the first split if that one does not exist.

    In stored order only the file that holds the row is read, whatever ``i``.
    """
    df = with_split(df)
    found = F.when(F.max(F.col(SPLIT) == split), F.lit(split)).otherwise(F.min(SPLIT))
    chosen = df.select(SPLIT).agg(found).first()[0]
    df = df.where(F.col(SPLIT) == chosen)
    if list(order_by) == [POSITION]:
        found = _stored_places(df, SPLIT, i + 1, _stored_counts(df, SPLIT)).first()
        if found is None:
            return df.limit(0)
        at = F.col(POSITION)
        return df.where((at["file"] == found["_last"]["file"]) & (at["row"] == found["_last"]["row"])).limit(1)
    if i > 0 and all(isinstance(df.schema[c].dataType, _WHOLE_NUMBERS) for c in order_by):
        order = [F.col(c) for c in order_by]
        bounds = order_bounds(df, F.col(SPLIT), order[0])
        if not bounds or i >= bounds[chosen][2]:
            return df.limit(0)
        before, upto = order_cuts(df, F.col(SPLIT), order, {chosen: [i, i + 1]}, bounds)[chosen]
        if not before.tied and not (upto and upto.tied):
            # Only the one row lies between the cuts.
            return df.where(~within_cut(order, before) & (within_cut(order, upto) if upto else F.lit(True)))
    first = head_per_split(df, i + 1, order_by)
    return first.orderBy(*order_by).offset(i).limit(1)
