"""Weekly box statistics: the pack-exception report and the limits per vehicle class."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packwatch.functions.calendar import previous_week
from packwatch.functions.scalars import half_up
from packwatch.operators.boxplot import outliers, quartiles, with_fences
from packwatch.session import settle

GROUPS = ("enterprise", "province", "vehicleType")

# fixed values: metric of the weekly means -> side of its fence, report field
SIDES = {
    "diff_Voltage": "above",
    "temper_rate": "above",
    "temper": "above",
    "diff_temper": "above",
    "resistance": "below",
    "wDischargeRate": "above",
}
REPORT_FIELDS = {
    "diff_Voltage": "vol_diff_exception",
    "temper_rate": "temper_rate_exception",
    "temper": "temper_exception",
    "diff_temper": "temper_diff_exception",
    "resistance": "resistance_exception",
    "wDischargeRate": "discharge_rate_exception",
}
# fixed values: metric -> name of its limit when charging and when not
LIMITS = {
    "diff_voltage": ("chargeMaxVolDiff", "unchargeMaxVolDiff"),
    "temper_rate": ("chargeMaxTemperRate", "unchargeMaxTemperRate"),
    "temper": ("chargeMaxTemper", "unchargeMaxTemper"),
    "diff_temper": ("chargeMaxTemperDiff", "unchargeMaxTemperDiff"),
    "resistance": ("chargeMinResistance", "unchargeMinResistance"),
}


def in_week(frames: DataFrame, as_of: date | None) -> DataFrame:
    """Frames of the last full week, by their ``dt`` partition."""
    if as_of is None:
        return frames
    first, after = previous_week(as_of)
    return frames.where((F.col("dt") >= f"{first}") & (F.col("dt") < f"{after}"))


def vehicle_means(
    frames: DataFrame, as_of: date | None = None, period: Sequence[str] = ()
) -> DataFrame:
    """Mean of the six metrics per vehicle, to one decimal."""
    spread = F.col("maxProbeTemperature") - F.col("minProbeTemperature")
    means = {
        "diff_Voltage": F.col("differenceCellVoltage"),
        "diff_temper": spread,
        "temper_rate": F.col("maxTemperatureRate"),
        "temper": F.col("averageProbeTemperature"),
        "resistance": F.col("resistance"),
        "wDischargeRate": F.col("wDischargeRate"),
    }
    return (
        in_week(frames, as_of)
        .groupBy(*period, *GROUPS, "vin")
        .agg(*[half_up(F.avg(c), 1).alias(name) for name, c in means.items()])
    )


def pack_exceptions(
    means: DataFrame,
    groups: Sequence[str] = GROUPS,
    unit: str = "vin",
    sides: Mapping[str, str] = SIDES,
    rule: str = "quartile",
    how: str = "inner",
) -> tuple[DataFrame, DataFrame]:
    """Box values per group, and the units beyond a fence; see ``boxplot.outliers``.

    ``means`` is read several times, so it should be a stored table.
    """
    boxes = with_fences(quartiles(means, groups, list(sides)), rule=rule)
    return outliers(means, boxes, groups, unit, sides, how)


def exception_documents(
    report: DataFrame,
    listed: DataFrame,
    groups: Sequence[str] = GROUPS,
    unit: str = "vin",
    fields: Mapping[str, str] = REPORT_FIELDS,
    page_size: int = 10_000,
) -> DataFrame:
    """The report as nested documents: per metric a struct with its box and its vehicles.

    A group with more outliers than ``page_size`` is spread over several documents, told
    apart by ``page``, each with the same boxes and its own share of the vehicles.
    """
    most = F.array_max(F.array(*[F.col(f"{m}_outliers") for m in fields]))
    paged = report.withColumn("_pages", F.ceil(most / page_size).cast("int"))
    vehicle = F.struct(F.col(unit).alias("vin"), F.col("outlier").alias("outliers"))
    shares = (
        listed.join(paged.select(*groups, "_pages"), list(groups))
        .withColumn("page", F.pmod(F.xxhash64(unit), F.col("_pages")).cast("int"))
        .groupBy(*groups, "page")
        .agg(
            *[
                F.sort_array(F.collect_list(F.when(F.col("metric") == m, vehicle))).alias(m)
                for m in fields
            ]
        )
    )
    nested = [
        F.struct(f"{m}_box.*", F.col(m).alias("vehicles")).alias(name)
        for m, name in fields.items()
    ]
    return shares.join(report, list(groups)).select(*groups, "page", *nested)


def class_limits(
    frames: DataFrame,
    classes: DataFrame,
    as_of: date | None = None,
    states: tuple[str, str] = ("1", "0"),
) -> DataFrame:
    """Box limits of each vehicle's class, while charging and while not, for every vehicle.

    Frames are averaged per vehicle and state before they meet the classes.
    """
    means = (
        in_week(frames, as_of)
        .where(F.col("chargeStatus").isin(*states))
        .groupBy("enterprise", "vin", "chargeStatus")
        .agg(
            half_up(F.avg("differenceCellVoltage"), 1).alias("diff_voltage"),
            half_up(F.avg("maxTemperatureRate"), 1).alias("temper_rate"),
            half_up(F.avg("maxProbeTemperature"), 1).alias("temper"),
            half_up(
                F.avg(F.col("maxProbeTemperature") - F.col("minProbeTemperature")), 1
            ).alias("diff_temper"),
            half_up(F.avg("resistance"), 1).alias("resistance"),
        )
    )
    known = classes.select("vin", "classification").distinct()
    classed = settle(means.join(known, "vin"), "class-means")
    by = ["enterprise", "classification", "chargeStatus"]
    boxes = with_fences(quartiles(classed, by, list(LIMITS)))

    def limit(metric: str, state: str, name: str):
        value = "min_value" if metric == "resistance" else "max_value"
        here = (F.col("metric") == metric) & (F.col("chargeStatus") == state)
        return half_up(F.max(F.when(here, F.col(value))), 1).alias(name)

    both = boxes.groupBy("enterprise", "classification").agg(
        F.count_distinct("chargeStatus").alias("_states"),
        *[limit(m, s, n) for m, names in LIMITS.items() for s, n in zip(states, names)],
    )
    limits = both.where(F.col("_states") == len(states)).drop("_states")
    return (
        classes.select("enterprise", "vin", "classification")
        .join(limits, ["enterprise", "classification"], "left")
        .drop("classification")
    )
