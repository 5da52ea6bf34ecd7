"""Signals per key: differences, median smoothing, and frame-by-cell matrices."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pandas.api.indexers import BaseIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from packwatch.functions.scalars import US_PER_DAY, US_PER_SECOND
from packwatch.operators.keyed import blocks, cut_columns, positions, scan, slices

#: Half-width from which a running median is kept in order rather than sorted anew per row.
WIDE = 64
#: Rows of a block there.
WIDE_BLOCK = 100_000


def differences(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Add ``{value}_diff``: the change since the previous row of the key."""
    cut = slices(df, keys, order[0], order[1:])
    found = scan(cut, keys, order, _last=("lag", F.struct(*values)))
    changed = {f"{v}_diff": F.col(v) - F.col(f"_last.{v}") for v in values}
    return found.withColumns(changed).drop("_last", *cut_columns(cut))


def gaps(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """Pairs of consecutive rows: ``before`` holds ``keep`` of the earlier one.

    ``gap_s`` and ``gap_days`` give the time between them.
    """
    cut = slices(df, keys, order[0], order[1:])
    found = scan(cut, keys, order, before=("lag", F.struct(order[0], *keep)))
    gap = F.col(order[0]) - F.col(f"before.{order[0]}")
    return (
        found.where(F.col("before").isNotNull())
        .withColumn("gap_s", gap / US_PER_SECOND)
        .withColumn("gap_days", gap / US_PER_DAY)
        .drop(*cut_columns(cut))
    )


def median_of(values: Column) -> Column:
    """Middle element of an array of odd length."""
    return F.element_at(F.sort_array(values), ((F.size(values) + 1) / 2).cast("int"))


def smoothed_steps(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    win: int = 20,
    block: int | None = None,
) -> DataFrame:
    """Median-smooth a signal and give its consecutive changes.

    Row ``i`` of ``n`` takes the median of the ``2 h + 1`` rows around it with
    ``h = min(win, i, n - 1 - i)``, so the window shrinks at both ends. Adds ``smooth``
    and ``step`` (NULL on the first row). Rows without a value are left out.

    Narrow windows are sorted, row by row. From a half-width of ``WIDE`` on, blocks of
    bounded size go through a running median that adds and removes one value at a
    time, so its cost grows with the logarithm of the width.
    """
    present = df.where(F.col(value).isNotNull())
    cut = slices(present, keys, order[0], order[1:])
    if win >= WIDE:
        return _wide_steps(cut, df.columns, keys, order, value, win, block)
    if cut_columns(cut) or block:
        numbered = positions(cut, keys, order, "_pos")
        placed = blocks(numbered, "_pos", before=win + 1, after=win, size=block)
        own, by, sort = F.col("_own"), [*keys, "_block"], ["_pos"]
    else:
        placed, own, by, sort = cut, F.lit(True), list(keys), list(order)
    w = Window.partitionBy(*by).orderBy(*sort)
    around = F.collect_list(value).over(w.rowsBetween(-win, win))
    left = F.least(F.lit(win), F.row_number().over(w) - 1)
    right = F.size("_around") - 1 - F.col("_left")
    half = F.least(F.col("_left"), right)
    middle = F.slice("_around", F.col("_left") - half + 1, half * 2 + 1)
    return (
        placed.withColumns({"_around": around, "_left": left})
        .withColumn("smooth", median_of(middle))
        .withColumn("step", F.col("smooth") - F.lag("smooth").over(w))
        .where(own)
        .select(*df.columns, "smooth", "step")
    )


class _Around(BaseIndexer):
    """Windows of ``half`` rows on both sides of each row."""

    def get_window_bounds(self, num_values=0, min_periods=None, center=None, closed=None, step=None):
        at = np.arange(num_values, dtype=np.int64)
        return at - self.half, at + self.half + 1


def running_median(values: np.ndarray, win: int) -> np.ndarray:
    """Middle of the ``2 h + 1`` values around each one, ``h = min(win, i, n - 1 - i)``; NaN is the greatest."""
    at = np.arange(len(values), dtype=np.int64)
    half = np.minimum(win, np.minimum(at, at[::-1]))
    # over ranks, as a window of plain values would pass over NaN and infinities
    known, ranks = np.unique(values, return_inverse=True)
    middle = pd.Series(ranks.astype("float64")).rolling(_Around(half=half), min_periods=1).median()
    return known[middle.to_numpy().astype(np.int64)]


def _wide_steps(
    cut: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    win: int,
    block: int | None,
) -> DataFrame:
    """The same for wide windows, in blocks that repeat ``win`` rows of their neighbours."""
    numbered = positions(cut, keys, order, "_pos").drop(*cut_columns(cut))
    placed = blocks(numbered, "_pos", before=win + 1, after=win, size=block or max(WIDE_BLOCK, 4 * win))
    kind = numbered.schema[value].dataType

    def smoothed(table: pa.Table) -> pa.Table:
        table = table.sort_by("_pos")
        column = table.column(value)
        found = pa.array(running_median(column.to_numpy(), win), column.type)
        before = pa.concat_arrays([pa.nulls(1, column.type), found[:-1]])
        table = table.append_column("smooth", found).append_column("_before", before)
        return table.filter(table.column("_own")).select([*columns, "smooth", "_before"])

    fields = [*numbered.select(*columns).schema, T.StructField("smooth", kind), T.StructField("_before", kind)]
    found = placed.groupBy(*keys, "_block").applyInArrow(smoothed, T.StructType(fields))
    return found.withColumn("step", F.col("smooth") - F.col("_before")).select(*columns, "smooth", "step")


def positions_where(values: Column, test: Callable[[Column], Column]) -> Column:
    """1-based positions of the array elements that pass the test, in order."""
    marked = F.transform(values, lambda v, i: F.when(test(v), i + 1))
    return F.array_compact(marked)


def cells(df: DataFrame, keep: Sequence[str], vector: str) -> DataFrame:
    """Frames x cells in long form: ``cell_no`` (from 1) and ``voltage``."""
    return df.select(*keep, F.posexplode(vector).alias("_at", "voltage")).select(
        *keep, (F.col("_at") + 1).alias("cell_no"), "voltage"
    )


def vector_mean(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / F.size(v)


def vector_std(v: Column, sample: bool = True) -> Column:
    """Standard deviation of an array, over n - 1 or over n."""

    def spread(s: Column) -> Column:
        squares = F.transform(s["v"], lambda x: (x - s["mean"]) * (x - s["mean"]))
        return F.aggregate(squares, F.lit(0.0), lambda a, x: a + x)

    # the one-element array binds the mean, so that it is computed once per row
    bound = F.array(F.struct(v.alias("v"), vector_mean(v).alias("mean")))
    size = F.size(v) - 1 if sample else F.size(v)
    return F.sqrt(F.try_divide(F.element_at(F.transform(bound, spread), 1), size))


def signal_stats(value: str) -> list[Column]:
    """Mean, sum, range and spread of a column, for ``agg``."""
    return [
        F.avg(value).alias("mean"),
        F.sum(value).alias("total"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
        F.stddev_samp(value).alias("std_samp"),
        F.stddev_pop(value).alias("std_pop"),
    ]
