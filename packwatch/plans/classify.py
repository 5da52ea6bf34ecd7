"""First-use season and monthly class of each vehicle."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packwatch.functions.calendar import month_range
from packwatch.functions.scalars import band, season


def in_month(frames: DataFrame, as_of: date | None) -> DataFrame:
    if as_of is None:
        return frames
    first, after = month_range(as_of)
    return frames.where((F.col("dt") >= f"{first}") & (F.col("dt") < f"{after}"))


def top_row(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """The values of the last row per key in the given order, combined on the map side."""
    top = F.max_by(F.struct(*values), F.struct(*order))
    return df.groupBy(*keys).agg(top.alias("_top")).select(*keys, "_top.*")


def first_use(frames: DataFrame, as_of: date | None = None, new_below: float = 1.0) -> DataFrame:
    """Season of first use of vehicles that have hardly been driven, ``none`` for the others.

    Looks at the frame with the highest odometer reading, the latest one of equals.
    """
    top = top_row(
        in_month(frames, as_of),
        ["enterprise", "vin"],
        ["odo", "msg_ts"],
        ["odo", "msg_ts"],
    )
    quarter = F.when(F.col("odo") <= new_below, season(F.month("msg_ts"))).otherwise("none")
    return top.where(F.col("odo").isNotNull()).select("enterprise", "vin", quarter.alias("quarter"))


def upsert(
    old: DataFrame, new: DataFrame, key: str, values: Sequence[str], winner: str
) -> DataFrame:
    """Full outer merge on ``key``; where both sides know a key, ``winner`` decides.

    ``winner="old"`` takes the whole old row, ``winner="new"`` prefers each new value.
    """
    merged = old.alias("old").join(new.alias("new"), key, "full")

    def pick(c: str) -> Column:
        was, now = F.col(f"old.{c}"), F.col(f"new.{c}")
        if winner == "new":
            return F.coalesce(now, was).alias(c)
        return F.when(F.col(f"old.{key}").isNull(), now).otherwise(was).alias(c)

    return merged.select(*[F.col(key) if c == key else pick(c) for c in values])


def upsert_first_use(old: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(old, new, "vin", ["enterprise", "vin", "quarter"], "old")


def classes(
    frames: DataFrame, initial: DataFrame, base: DataFrame, as_of: date | None = None
) -> DataFrame:
    """Class of each vehicle: province, type, delivery year, first-use season, odometer band."""
    last = top_row(
        in_month(frames, as_of),
        ["enterprise", "vin"],
        ["province", "vehicleType", "odo"],
        ["msg_ts", "frame_id"] if "frame_id" in frames.columns else ["msg_ts"],
    )
    key = F.concat_ws(
        "-",
        "province",
        "vehicleType",
        F.date_format("delivery_time", "yyyy"),
        "quarter",
        band("odo", 10_000).cast("string"),
    )
    return (
        last.join(initial.select("vin", "quarter"), "vin")
        .join(base.select("vin", "delivery_time"), "vin")
        .select("enterprise", "vin", key.alias("classification"))
    )


def merge_classes(this_month: DataFrame, last_month: DataFrame, month: str | None = None) -> DataFrame:
    """This month's classes; vehicles not seen this month keep last month's."""
    merged = upsert(last_month, this_month, "vin", ["enterprise", "vin", "classification"], "new")
    return merged if month is None else merged.withColumn("dt", F.lit(month))
