"""Warning and failure counts by hour and day, and the risk overview.

Counting is done once at the finest grain, combined on the map side; everything else
works on those counts. ``as_of`` selects the period before it, as a scheduled run does;
without it every period is computed, as a backfill does.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from packwatch.functions.calendar import previous_day, previous_hour
from packwatch.functions.scalars import hour_text

# fixed values: review states that still count as open, and the risk levels
OPEN_REVIEWS = ("1", "2", "3")
RISK_LEVELS = {"highrisk_num": "1", "medrisk_num": "2", "lowrisk_num": "3"}


def between(ts: str, span: tuple[date, date] | tuple[datetime, datetime]) -> Column:
    """Half-open range on the bare column, so that it reaches the scan.

    The bounds are text, which becomes a constant of the column's own time type.
    """
    return (F.col(ts) >= F.lit(str(span[0]))) & (F.col(ts) < F.lit(str(span[1])))


def _reattached(
    counts: DataFrame, period: Sequence[str], measures: Sequence[str], total: Column
) -> DataFrame:
    """Totals per vehicle and measure, with every vehicle type and enterprise of the vehicle.

    The counts are read once and shuffled once, by period and vehicle; each vehicle's types and
    enterprises, of which there are few, go along as an array. Counts without period or
    vehicle are left out.
    """
    counts = counts.dropna(subset=[*period, "vin"]).repartition(*period, "vin")
    owners = F.collect_set(F.struct("vehicle_type", "enterprise"))
    owned = counts.withColumn("_owners", owners.over(Window.partitionBy(*period, "vin")))
    totals = owned.groupBy(*period, "vin", *measures).agg(
        total.alias("total"), F.first("_owners").alias("_owners")
    )
    return totals.select("vin", *measures, "total", *period, F.inline("_owners")).select(
        "vin", "vehicle_type", "enterprise", *measures, "total", *period
    )


def hourly_warnings(
    warnings: DataFrame, as_of: datetime | None = None, at: str = "warning_start_time"
) -> DataFrame:
    """Warnings per hour, vehicle, province and type; ``dt`` is the hour as text."""
    if as_of is not None:
        warnings = warnings.where(between(at, previous_hour(as_of)))
    counts = (
        warnings.withColumn("dt", hour_text(at))
        .groupBy("dt", "vin", "province", "warning_type", "vehicle_type", "enterprise")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    found = _reattached(counts, ["dt"], ["province", "warning_type"], F.sum("_n"))
    return found.withColumns(
        {
            "year": F.substring("dt", 1, 4),
            "month": F.substring("dt", 6, 2),
            "day": F.substring("dt", 9, 2),
        }
    )


def daily_warnings(hourly: DataFrame, as_of: date | None = None) -> DataFrame:
    """Daily totals of the hourly table; only its partitions of the day are read."""
    if as_of is not None:
        day = previous_day(as_of)[0]
        hourly = hourly.where(
            (F.col("year") == f"{day:%Y}") & (F.col("month") == f"{day:%m}") & (F.col("day") == f"{day:%d}")
        )
    days = (
        hourly.withColumn("dt", F.concat_ws("-", "year", "month", "day"))
        .groupBy("dt", "vin", "province", "warning_type", "vehicle_type", "enterprise")
        .agg(F.sum("total").alias("total"))
    )
    return _reattached(days, ["dt"], ["province", "warning_type"], F.sum("total"))


def hourly_failures(
    failures: DataFrame, as_of: datetime | None = None, at: str = "failureStartTime"
) -> DataFrame:
    """Failures per hour, vehicle and type; ``day`` is the partition of the table."""
    if as_of is not None:
        failures = failures.where(between(at, previous_hour(as_of)))
    return (
        failures.withColumn("dt", hour_text(at))
        .groupBy("enterprise", "province", "vehicleType", "vin", "failureType", "dt")
        .agg(F.count("failureType").alias("total"))
        .withColumn("day", F.substring("dt", 1, 10))
    )


def daily_failures(hourly: DataFrame, as_of: date | None = None) -> DataFrame:
    if as_of is not None:
        hourly = hourly.where(F.col("day") == f"{previous_day(as_of)[0]:%Y-%m-%d}")
    return hourly.groupBy(
        "enterprise", "province", "vehicleType", "vin", "failureType", F.col("day").alias("dt")
    ).agg(F.sum("total").alias("total"))


def _risk_counts(warnings: DataFrame, by: Sequence[str], weight: str | None) -> DataFrame:
    times = F.col(weight) if weight else F.lit(1)

    def count(level: str) -> Column:
        return F.sum(F.when(F.col("risk_level") == level, times).otherwise(0)).cast("long")

    counts = [count(v).alias(c) for c, v in RISK_LEVELS.items()]
    still_open = F.col("review_status").isin(*OPEN_REVIEWS)
    return warnings.where(still_open).groupBy(*by).agg(*counts)


def _stamped(df: DataFrame, as_of: datetime | None) -> DataFrame:
    if as_of is None:
        return df
    return df.withColumn("dt", F.lit(f"{as_of:%Y-%m-%d %H:%M:%S}"))


def province_risk(
    warnings: DataFrame, as_of: datetime | None = None, weight: str | None = None
) -> DataFrame:
    """Open warnings per enterprise and province, a column for each risk level.

    ``weight`` names the number of warnings a row stands for, if it is not one.
    """
    counted = _risk_counts(warnings, ["enterprise", "province"], weight)
    return _stamped(counted.withColumn("safety_num", F.lit(0).cast("long")), as_of)


def risk_levels(
    warnings: DataFrame, as_of: datetime | None = None, weight: str | None = None
) -> DataFrame:
    """Open warnings per enterprise, a column for each risk level."""
    return _stamped(_risk_counts(warnings, ["enterprise"], weight), as_of)
