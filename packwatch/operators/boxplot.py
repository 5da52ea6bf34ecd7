"""Quartiles, box fences and outliers per group.

Quartile ``q`` sits at position ``q * (n + 1) / 4`` of the sorted values (missing values
first); between two positions it is interpolated. Groups of fewer than three rows have
no first quartile and drop out.

Ordinary groups are ranked with one window. A group with more than ``hot_rows`` rows is
never sorted: a mergeable sketch of its values brackets the wanted positions, and one exact
count, combined on the map side, tells the few rows within the brackets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from packwatch.functions.scalars import half_up, rank_fraction, rank_whole
from packwatch.operators.keyed import hot_keys, hot_rows, present
from packwatch.session import settle

QUARTERS = (1, 2, 3)
#: Quantiles read from a sketch, and how many of them a bracket reaches beyond its position.
GRID, MARGIN = 1024, 4
#: Size of a sketch: about 0.13 % of rank error, of the 0.39 % that a bracket allows.
SKETCH = 4096
#: Wanted positions: the lower and the upper one of each quartile.
WANTED = 2 * len(QUARTERS)


def quartiles(
    df: DataFrame, groups: Sequence[str], metrics: Sequence[str], small: bool = False
) -> DataFrame:
    """One row per group and metric: ``metric, n, q1, q2, q3``; ``q2`` is the exact median.

    ``small=True`` states that no group can be large, which saves measuring them.
    """
    df = present(df, groups).select(*groups, *[F.col(m).cast("double").alias(m) for m in metrics])
    hot = None if small else hot_keys(df, groups)
    if hot is None:
        return _ranked(_long(df, groups, metrics), groups)
    known = hot.select(*groups)
    ordinary = _long(df.join(known, list(groups), "left_anti"), groups, metrics)
    large = _long(df.join(known, list(groups), "left_semi"), groups, metrics)
    metric = F.explode(F.array(*[F.lit(m) for m in metrics])).alias("metric")
    cells = hot.select(*groups, metric, "n")
    return _ranked(ordinary, groups).unionByName(_narrowed(large, cells, groups))


def _long(df: DataFrame, keep: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    return df.unpivot(list(keep), list(metrics), "metric", "value")


def _ranked(long: DataFrame, groups: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*groups, "metric").orderBy(F.col("value").asc_nulls_first())
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (
        long.withColumn("n", F.count(F.lit(1)).over(whole))
        .withColumn("rank", F.row_number().over(w))
        .withColumn("next", F.lead("value", 1, 0.0).over(w))
    )

    def at(quarter: int) -> Column:
        f = rank_fraction(F.col("n"), quarter)
        here = F.col("rank") == rank_whole(F.col("n"), quarter)
        return F.max(F.when(here, F.col("value") * (1 - f) + F.col("next") * f))

    return (
        ranked.where(F.col("n") >= 3)
        .groupBy(*groups, "metric")
        .agg(F.max("n").alias("n"), *[at(q).alias(f"q{q}") for q in QUARTERS])
    )


def _narrowed(long: DataFrame, cells: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Quartiles of hot groups, given their sizes.

    Each round sketches the values of a cell, takes two of its values around each wanted position
    as pivots, counts the values below, at, between and above them, and keeps the parts that hold a
    wanted rank, until these have no more than ``hot_rows`` rows or one value each. Counts are
    exact, so a pivot that misses costs a round and not the result; a part holds about one row in
    a hundred, whatever the spread of the values, and never the pivots of its cell, so rounds
    end. NULL and NaN have parts of their own. Cells, at most six per hot group and metric,
    are settled, so that every later step sees the same ones and the planner knows their
    size; so are the rows left after a round.
    """
    keys = by = [*groups, "metric"]
    whole = [rank_whole(F.col("n"), q) for q in QUARTERS]
    ranks = F.array_distinct(F.array(*whole, *[r + 1 for r in whole]))
    # "left" is the rank counted from the start of the cell
    cells = cells.withColumn(
        "_ranks", F.transform(ranks, lambda r: F.struct(r.alias("rank"), r.alias("left")))
    )
    rows = long
    level = 0
    while True:
        cell = f"_part{level}"
        pivots = settle(_pivots(rows, cells, keys), "pivots")
        rows = rows.join(pivots, keys).select(*keys, "value", _part(F.col("value")).alias(cell))
        counted = rows.groupBy(*keys, cell).agg(
            F.count(F.lit(1)).alias("_c"), F.min("value").alias("_lo"), F.max("value").alias("_hi")
        )
        cells = settle(_holding(counted, cells, keys, cell), "cells")
        keys = [*keys, cell]
        largest = cells.where(F.col("_lo") < F.col("_hi")).agg(F.max("_c")).first()[0]
        if largest is None or largest <= hot_rows(long):
            break
        rows = settle(rows.join(cells.select(*keys), keys), "narrowed")
        level += 1
    values = (
        rows.join(cells.select(*keys), keys)
        .groupBy(*keys, "value")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    picked = _holding(values, cells, keys, "value").select(
        *by, "n", "value", F.explode("_ranks.rank").alias("rank")
    )

    def at(quarter: int) -> Column:
        f = rank_fraction(F.col("n"), quarter)
        k = rank_whole(F.col("n"), quarter)
        low = F.max(F.when(F.col("rank") == k, F.col("value") * (1 - f)))
        high = F.max(F.when(F.col("rank") == k + 1, F.col("value") * f))
        return low + high

    return picked.groupBy(*by, "n").agg(*[at(q).alias(f"q{q}") for q in QUARTERS])


def _pivots(rows: DataFrame, cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Values ``_p0, _p1, ...`` of every cell, two around each wanted position, by a sketch."""
    sketched = rows.groupBy(*keys).agg(
        F.kll_sketch_agg_double("value", F.lit(SKETCH)).alias("_sketch"),
        F.count_if(F.col("value").isNull()).alias("_nulls"),
    )
    known = F.kll_sketch_get_n_double("_sketch")
    grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    # a sketch takes neither NULL nor NaN
    quantiles = F.when(known > 0, F.kll_sketch_get_quantile_double("_sketch", grid))
    found = cells.select(*keys, "_ranks").join(
        sketched.select(*keys, "_nulls", known.alias("_known"), quantiles.alias("_grid")), list(keys)
    )

    def around(k: int) -> list[Column]:
        at = (F.get("_ranks", F.lit(k))["left"] - F.col("_nulls")) * GRID / F.col("_known")
        low = F.greatest(F.least(F.floor(at) - MARGIN, F.lit(GRID)), F.lit(0))
        high = F.greatest(F.least(F.ceil(at) + MARGIN, F.lit(GRID)), F.lit(0))
        wanted = F.size("_ranks") > k
        return [F.when(wanted, F.get("_grid", i.cast("int"))) for i in (low, high)]

    pivots = [p for k in range(WANTED) for p in around(k)]
    return found.where(F.col("_known") > 0).select(
        *keys, *[p.alias(f"_p{i}") for i, p in enumerate(pivots)]
    ).unionByName(found.where(F.col("_known") == 0).select(*keys), allowMissingColumns=True)


def _part(value: Column) -> Column:
    """The part of its cell that a value lies in: below, at or above each of the pivots."""
    pivots = [F.col(f"_p{i}") for i in range(2 * WANTED)]
    beyond = [
        F.coalesce((p < value).cast("int") + (p <= value).cast("int"), F.lit(0)) for p in pivots
    ]
    place = F.when(value.isNull(), -1).when(F.isnan(value), 2 * len(pivots) + 1)
    return place.otherwise(reduce(add, beyond)).cast("long")


def _holding(
    counted: DataFrame, cells: DataFrame, keys: Sequence[str], order: str
) -> DataFrame:
    """The counted cells that hold a wanted rank of their parent cell."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_first())
    before = F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    held = F.filter(
        "_ranks",
        lambda r: (r["left"] > F.col("_before")) & (r["left"] <= F.col("_before") + F.col("_c")),
    )
    moved = F.transform(
        held, lambda r: F.struct(r["rank"].alias("rank"), (r["left"] - F.col("_before")).alias("left"))
    )
    return (
        counted.withColumn("_before", before)
        .join(cells.select(*keys, "n", "_ranks"), list(keys))
        .withColumn("_ranks", moved)
        .where(F.size("_ranks") > 0)
        .drop("_before")
    )


def with_fences(
    boxes: DataFrame,
    factor: float = 1.5,
    rule: str = "quartile",
    names: tuple[str, str] = ("max_value", "min_value"),
) -> DataFrame:
    """Add the upper and the lower fence.

    ``rule="quartile"`` keeps the platform's own formula ``q3 +- factor * q1``;
    ``rule="iqr"`` gives the usual ``q3 + factor * iqr`` and ``q1 - factor * iqr``.
    """
    q1, q3 = F.col("q1"), F.col("q3")
    if rule == "quartile":
        upper, lower = q3 + q1 * factor, q3 - q1 * factor
    elif rule == "iqr":
        upper, lower = q3 + (q3 - q1) * factor, q1 - (q3 - q1) * factor
    else:
        raise ValueError(f"unknown fence rule {rule!r}")
    return boxes.withColumns(dict(zip(names, (upper, lower))))


def wide_boxes(boxes: DataFrame, groups: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """One row per group with a struct ``Q3, Q2, Q1, maxvalue, minvalue`` per metric."""
    box = F.struct(
        *[half_up(q, 1).alias(q.upper()) for q in ("q3", "q2", "q1")],
        half_up("max_value", 1).alias("maxvalue"),
        half_up("min_value", 1).alias("minvalue"),
    )
    return boxes.groupBy(*groups).agg(
        *[F.max(F.when(F.col("metric") == m, box)).alias(f"{m}_box") for m in metrics]
    )


def outliers(
    df: DataFrame,
    boxes: DataFrame,
    groups: Sequence[str],
    unit: str,
    sides: Mapping[str, str],
    how: str = "inner",
) -> tuple[DataFrame, DataFrame]:
    """Reported groups, and their outlying units.

    ``sides`` names the fence of each metric: ``above`` the rounded upper one or ``below``
    the rounded lower one. The first frame has one row per group: the box structs and the
    number of outliers per metric. ``how="inner"`` keeps the groups with an outlier in
    every metric, ``how="full"`` those with one in any. The second frame has one row per
    reported group, metric and outlying unit, so that a large group stays distributed.
    """
    metrics = list(sides)
    # one small row per group, needed for the tests and for the report
    wide = settle(wide_boxes(boxes, groups, metrics), "boxes")
    fence = {"above": "maxvalue", "below": "minvalue"}
    limits = wide.select(
        *groups, *[F.col(f"{m}_box")[fence[s]].alias(f"{m}_limit") for m, s in sides.items()]
    )

    def beyond(m: str) -> Column:
        value, limit = F.col(m), F.col(f"{m}_limit")
        return value > limit if sides[m] == "above" else value < limit

    # the size of the limits on disk decides whether they are broadcast
    tested = present(df, groups).select(*groups, unit, *metrics).join(limits, list(groups))
    numbers = F.array(*[F.col(f"{m}_outliers") for m in metrics])
    enough = (F.array_min(numbers) if how == "inner" else F.array_max(numbers)) > 0
    counted = (
        tested.groupBy(*groups)
        .agg(*[F.count_if(beyond(m)).alias(f"{m}_outliers") for m in metrics])
        .where(enough)
    )
    listed = (
        tested.join(counted.select(*groups), list(groups), "left_semi")
        .unpivot([*groups, unit], _tests(metrics, beyond), "metric", "outlier")
        .where(F.col("outlier").isNotNull())
    )
    return wide.join(counted, list(groups)), listed


def _tests(metrics, beyond):
    return [F.when(beyond(m), F.col(m).cast("double")).alias(m) for m in metrics]
