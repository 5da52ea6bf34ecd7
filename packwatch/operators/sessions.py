"""Charging sessions from ordered frames, and what follows from them.

A session opens with the first frame whose state flag is on and closes with the next
frame whose flag is off. Frames are taken in time order; of frames of the same instant
those with the flag off come first, so a closing frame at the very start of a session
does not close it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from packwatch.operators.keyed import (
    blocks,
    cut_columns,
    in_slice,
    is_sliced,
    positions,
    runs,
    scan,
    slices,
)


def session_rows(
    frames: DataFrame,
    on: Column,
    keys: Sequence[str] = ("vin",),
    at: str = "msg_us",
    tie: str = "frame_id",
    keep: Sequence[str] = (),
    label: Sequence[str] = (),
) -> DataFrame:
    """Frames with the session they belong to; see ``keyed.runs`` for the added columns."""
    cut = slices(frames.withColumn("on", F.coalesce(on, F.lit(False))), keys, at)
    return runs(cut, keys, [at, "on", tie], "on", at, keep, label)


def sessions(
    rows: DataFrame,
    keys: Sequence[str] = ("vin",),
    at: str = "msg_us",
    soc: str = "soc_pct",
    extra: Sequence[Column] = (),
    keep_open: bool = False,
    until: str | None = None,
    soc_high: str | None = None,
) -> DataFrame:
    """One row per session of the frames given by :func:`session_rows`.

    Start and end are the first and last time of the charging frames, ``start_soc`` and
    ``end_soc`` their lowest and highest state of charge. ``until`` and ``soc_high`` name
    columns with the last time and the highest state of charge of rows that stand for
    a whole stretch of frames.
    """
    on, closing = F.col("on"), F.col("closing")
    found = (
        rows.where(on | closing)
        .groupBy(*keys, F.col("run_start").alias("start_us"))
        .agg(
            F.max(F.when(on, F.col(until or at))).alias("end_us"),
            F.min(F.when(on, F.col(soc))).alias("start_soc"),
            F.max(F.when(on, F.col(soc_high or soc))).alias("end_soc"),
            F.coalesce(F.bool_or(closing), F.lit(False)).alias("closed"),
            *extra,
            *[F.min(c).alias(c) for c in cut_columns(rows)],
        )
    )
    return found if keep_open else found.where("closed").drop("closed")


def large_charges(found: DataFrame, over: float = 40.0) -> DataFrame:
    """Sessions that gained more than ``over`` percent."""
    return found.where(F.col("end_soc") - F.col("start_soc") > over)


def crossing(found: DataFrame, level: float = 80.0) -> DataFrame:
    """Sessions that start below ``level`` percent and reach it."""
    return found.where((F.col("start_soc") < level) & (F.col("end_soc") >= level))


def last_n(
    found: DataFrame,
    n: int = 10,
    keys: Sequence[str] = ("vin",),
    carry: Sequence[str] = (),
) -> DataFrame:
    """For each session from the n-th of its key on, the latest ``n`` sessions in order.

    Adds ``recent``: an array of ``n`` structs ``start_us, end_us`` and the ``carry``
    columns.
    """
    member = F.struct("start_us", "end_us", *carry)
    if not is_sliced(found):
        w = in_slice(found, keys, ["start_us"])
        grown = found.withColumn("recent", F.collect_list(member).over(w.rowsBetween(1 - n, 0)))
        return grown.where(F.size("recent") == n)
    numbered = positions(found, keys, ["start_us"], "_pos").drop("_hot", "_slice")
    near = (
        Window.partitionBy(*keys, "_block").orderBy("_pos").rowsBetween(1 - n, Window.currentRow)
    )
    return (
        blocks(numbered, "_pos", before=n - 1)
        .withColumn("recent", F.collect_list(member).over(near))
        .where(F.col("_own") & (F.size("recent") == n))
        .drop("_pos", "_block", "_own")
    )


def sorted_times(recent: Column | str) -> Column:
    """All 2 n start and end times of ``recent``, ascending."""
    both = F.transform(recent, lambda s: F.array(s["start_us"], s["end_us"]))
    return F.sort_array(F.flatten(both))


def followed_by(
    rows: DataFrame,
    first: Column,
    then: Column,
    keys: Sequence[str] = ("vin",),
    order: Sequence[str] = ("msg_us", "frame_id"),
) -> DataFrame:
    """Rows that satisfy ``first`` and whose very next row of the key satisfies ``then``."""
    cut = slices(rows, keys, order[0], order[1:])
    step = F.struct(F.coalesce(then, F.lit(False)).alias("ok"), F.col(order[0]).alias("at"))
    return (
        scan(cut, keys, order, _next=("lead", step))
        .where(first & F.col("_next.ok"))
        .withColumn("next_at", F.col("_next.at"))
        .drop("_next", *cut_columns(cut))
    )
