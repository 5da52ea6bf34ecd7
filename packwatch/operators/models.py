"""Battery-health models as grouped Spark operators.

Every model returns its score next to the flag ``"1"`` (warn) or ``"0"``. Thresholds are
parameters; the defaults are those of the platform.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packwatch.functions.scalars import US_PER_DAY
from packwatch.operators.boxplot import quartiles
from packwatch.operators.keyed import cut_columns, positions, slices
from packwatch.operators.signals import cells, differences, gaps, smoothed_steps, vector_mean, vector_std


def flag(condition: Column) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), "1").otherwise("0")


def cell_dispersion(
    df: DataFrame,
    keys: Sequence[str],
    vector: str,
    mean_factor: float = 3.0,
    std_factor: float = 3.0,
) -> DataFrame:
    """Cells whose deviation from the frame mean is out of line with the other cells.

    Per cell the absolute mean and the standard deviation of (voltage - frame mean) are
    box-tested among the cells of the key; any outlier warns.
    """
    framed = df.select(*keys, vector, vector_mean(F.col(vector)).alias("_mean"))
    shift = F.col("voltage") - F.col("_mean")
    per_cell = (
        cells(framed, [*keys, "_mean"], vector)
        .groupBy(*keys, "cell_no")
        .agg(F.abs(F.avg(shift)).alias("mean_dev"), F.stddev_samp(shift).alias("std_dev"))
    )
    # a pack has a fixed number of cells
    boxes = quartiles(per_cell, keys, ["mean_dev", "std_dev"], small=True)
    factor = F.when(F.col("metric") == "mean_dev", mean_factor).otherwise(std_factor)
    reach = (F.col("q3") - F.col("q1")) * factor
    limits = (
        boxes.withColumn("low", F.col("q1") - reach)
        .withColumn("high", F.col("q3") + reach)
        .groupBy(*keys)
        .agg(
            *[
                F.max(F.when(F.col("metric") == m, F.col(side))).alias(f"{m}_{side}")
                for m in ("mean_dev", "std_dev")
                for side in ("low", "high")
            ]
        )
    )

    def out(m: str) -> Column:
        return (F.col(m) < F.col(f"{m}_low")) | (F.col(m) > F.col(f"{m}_high"))

    return (
        per_cell.join(limits, list(keys), "left")
        .groupBy(*keys)
        .agg(
            F.count_if(out("mean_dev")).alias("mean_outliers"),
            F.count_if(out("std_dev")).alias("std_outliers"),
        )
        .withColumn("is_warning", flag(F.col("mean_outliers") + F.col("std_outliers") > 0))
    )


def voltage_fluctuation(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    high: str,
    low: str,
    ratio_below: float,
    least_change: float = 0.005,
) -> DataFrame:
    """Highest and lowest cell voltage that move by very different amounts in total."""
    moved = differences(df, keys, order, [high, low])
    summed = moved.groupBy(*keys).agg(
        F.coalesce(F.sum(F.abs(f"{high}_diff")), F.lit(0.0)).alias("high_path"),
        F.coalesce(F.sum(F.abs(f"{low}_diff")), F.lit(0.0)).alias("low_path"),
        (F.count(f"{high}_diff") + F.count(f"{low}_diff")).alias("changes"),
    )
    longer, shorter = F.greatest("high_path", "low_path"), F.least("high_path", "low_path")
    mean_change = F.try_divide(F.col("high_path") + F.col("low_path"), F.col("changes"))
    return (
        summed.withColumn("mean_change", mean_change)
        .withColumn("ratio", F.try_divide(shorter, longer))
        .withColumn(
            "is_warning",
            flag((F.col("mean_change") > least_change) & (F.col("ratio") < ratio_below)),
        )
        .drop("changes")
    )


def resistance_drop(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str = "resistance",
    drop: float = 300.0,
    win: int = 20,
) -> DataFrame:
    """Sudden fall of the median-smoothed insulation resistance."""
    return (
        smoothed_steps(df, keys, order, value, win)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("frames"), F.min("step").alias("lowest_step"))
        .withColumn("is_warning", flag(F.col("lowest_step") < -drop))
    )


def rest_gaps(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    keep: Sequence[str],
    odo: str = "odo",
    soc: str = "soc_pct",
    speed: str = "speed",
    least_days: float = 0.5,
    soc_change: float = 5.0,
) -> DataFrame:
    """Consecutive frames at least ``least_days`` apart between which the vehicle stood still."""
    pairs = gaps(df, keys, order, [odo, soc, speed, *keep])

    def was(c: str) -> Column:
        return F.col(f"before.{c}")

    return pairs.where(
        (F.col("gap_days") >= least_days)
        & (F.col(odo) == was(odo))
        & (F.abs(F.col(soc) - was(soc)) <= soc_change)
        & (F.col(speed) == 0)
        & (was(speed) == 0)
    )


def self_discharge(
    pairs: DataFrame,
    keys: Sequence[str],
    before: str,
    after: str,
    days: str = "gap_days",
    sigmas: float = 6.0,
    least_drop: float = 30.0,
) -> DataFrame:
    """Cells that lose far more voltage per day at rest than the pack does on average.

    ``before`` and ``after`` are the cell-voltage arrays (volts) at both ends of a rest.
    """
    drop = F.zip_with(before, after, lambda b, a: (b - a) / F.col(days) * 1000)
    scored = (
        pairs.withColumn("_drop", drop)
        .withColumn("_top", F.array_max("_drop"))
        .withColumn("_limit", vector_mean(F.col("_drop")) + vector_std(F.col("_drop")) * sigmas)
    )
    hit = (F.col("_top") > F.col("_limit")) & (F.col("_top") > least_drop)
    return (
        scored.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("rests"),
            F.max("_top").alias("largest_drop"),
            F.count_if(hit).alias("warnings"),
        )
        .withColumn("is_warning", flag(F.col("warnings") > 0))
    )


def spread_growth(
    df: DataFrame,
    keys: Sequence[str],
    x: str,
    y: str,
    slope_over: float = 0.05,
    range_over: float = 40.0,
) -> DataFrame:
    """Least-squares slope of the charge voltage spread and where the line meets the axes."""
    line = df.groupBy(*keys).agg(
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        (F.max(x) - F.min(x)).alias("x_range"),
    )
    return line.withColumn(
        "x_axis", F.try_divide(-F.col("intercept"), F.col("slope"))
    ).withColumn(
        "is_warning", flag((F.col("slope") > slope_over) & (F.col("x_range") > range_over))
    )


def connection_impedance(
    df: DataFrame,
    keys: Sequence[str],
    spread: str,
    current: str,
    slow_limit: float = 8.0,
    fast_limit: float = 2.0,
    frames_over: int = 50,
    charging_below: float = -5.0,
    slow_mean: float = 30.0,
    fast_mean: float = 50.0,
    slow_peak: float = 50.0,
) -> DataFrame:
    """Voltage spread that grows with the charging current: mean of spread / |current|.

    Only frames charging with more than 5 A count (negative current charges). Slow and fast
    charging have their own limits; between the two the peak current decides. The whole
    model is one aggregation, combined on the map side.
    """
    charging = F.col(current) < charging_below
    strength = F.when(charging, F.abs(F.col(current)))
    scored = df.groupBy(*keys).agg(
        F.count_if(F.col(current).isNotNull() & F.col(spread).isNotNull()).alias("frames"),
        F.avg(F.try_divide(F.col(spread), strength)).alias("impedance"),
        F.avg(strength).alias("mean_current"),
        F.max(strength).alias("peak_current"),
    )
    mean, peak = F.col("mean_current"), F.col("peak_current")
    fast = (mean >= fast_mean) | ((mean > slow_mean) & (peak > slow_peak))
    limit = F.when(fast, fast_limit).otherwise(slow_limit)
    return scored.withColumn(
        "is_warning",
        flag((F.col("frames") > frames_over) & (F.col("impedance") >= limit)),
    )


def sampling_inputs(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    high_cell: str,
    low_cell: str,
    spread: str,
    piece: int = 10_000,
) -> DataFrame:
    """Ordered cell numbers of the sampling model, in pieces of at most ``piece`` frames.

    The model itself is not defined yet, so ``is_warning`` stays NULL. ``total`` and ``n``
    of all pieces of a key add up to the mean spread of the whole signal; ``sampling_result`` gives one
    row per key.
    """
    cut = slices(df, keys, order[0], order[1:])
    numbered = positions(cut, keys, order, "_pos").drop(*cut_columns(cut))
    signal = F.sort_array(F.collect_list(F.struct("_pos", high_cell, low_cell)))
    return (
        numbered.withColumn("piece", F.floor((F.col("_pos") - 1) / piece))
        .groupBy(*keys, "piece")
        .agg(
            signal.alias("_s"),
            F.count(spread).alias("n"),
            F.sum(spread).alias("total"),
        )
        .select(
            *keys,
            "piece",
            F.col(f"_s.{high_cell}").alias("high_cells"),
            F.col(f"_s.{low_cell}").alias("low_cells"),
            "n",
            "total",
            F.lit(None).cast("string").alias("is_warning"),
        )
    )


def sampling_result(df: DataFrame, keys: Sequence[str], spread: str) -> DataFrame:
    """One row per key, however long its signal: frames, mean spread, and the flag, which stays NULL."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("frames"),
        F.avg(spread).alias("mean_spread"),
        F.lit(None).cast("string").alias("is_warning"),
    )


def session_gaps(recent: Column | str) -> Column:
    """Days from each session start to the one before it; 0 for the first."""
    return F.transform(
        recent,
        lambda s, i: F.when(i == 0, F.lit(0.0)).otherwise(
            (s["start_us"] - F.element_at(recent, F.greatest(i, F.lit(1)))["start_us"]) / US_PER_DAY
        ),
    )
