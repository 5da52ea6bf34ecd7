"""What happens within charging sessions: records, histograms and the spread trend."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packwatch.functions.calendar import day_micros, previous_day
from packwatch.functions.flags import slope
from packwatch.functions.scalars import US_PER_HOUR, band
from packwatch.operators.histogram import CELLS, CURRENT_BUCKETS, CURRENT_STEP, filled_histograms
from packwatch.operators.keyed import cut_columns, in_windows, scan, slices
from packwatch.operators.models import flag, session_gaps
from packwatch.operators.sessions import crossing, last_n, session_rows, sessions

SLOW, FAST = "0", "1"
SESSION = ("vin", "start_us")


# columns of the earliest frame that describe a session
DESCRIBE = ("enterprise", "vehicle_type", "province")
# the same for given windows, which also have an end of their own
WINDOW = (*DESCRIBE, "window_end_us")


def charge_type(mean_current: Column, peak_current: Column) -> Column:
    return F.when((mean_current >= 30) | (peak_current >= 70), FAST).otherwise(SLOW)


def own_rows(frames: DataFrame, on: Column, describe: Sequence[str] = DESCRIBE) -> DataFrame:
    """Frames of the sessions of each vehicle, with ``gap_us`` to the last frame.

    The ``describe`` columns take the values of the first frame of the session.
    """
    rows = session_rows(frames, on, keep=["msg_us"], label=describe)
    gap = F.when(F.col("opening"), F.lit(0)).otherwise(F.col("msg_us") - F.col("prev.msg_us"))
    return rows.withColumns({"gap_us": gap.cast("long"), "start_us": F.col("run_start")})


def window_rows(
    frames: DataFrame,
    windows: DataFrame,
    disjoint: bool = False,
    describe: Sequence[str] = DESCRIBE,
) -> DataFrame:
    """The same for given windows (``vin, start_us, end_us``), which may overlap.

    ``window_end_us`` tells windows of one start apart.
    """
    key = ["vin", "start_us", "window_end_us"]
    windows = windows.select("vin", "start_us", F.col("end_us").alias("window_end_us"))
    concerned = frames.join(windows.select("vin").distinct(), "vin", "left_semi")
    cut = slices(concerned, ["vin"], "msg_us", ["frame_id"])
    timed = scan(cut, ["vin"], ["msg_us", "frame_id"], _last=("lag", F.col("msg_us"))).drop(
        *cut_columns(cut)
    )
    found = in_windows(timed, windows, ["vin"], "msg_us", "start_us", "window_end_us", disjoint)
    follows = F.coalesce(F.col("_last") >= F.col("start_us"), F.lit(False))
    gap = F.when(follows, F.col("msg_us") - F.col("_last")).otherwise(0).cast("long")
    first = found.where(~follows).select(*key, *describe)
    return (
        found.drop(*describe)
        .withColumns({"gap_us": gap, "on": F.lit(True), "closing": F.lit(True)})
        .join(first, key)
        .drop("_last")
    )


def _totals() -> dict[str, tuple]:
    """Aggregates of a session, each with the function that makes and merges it."""
    on = F.col("on")

    def charging(c: Column) -> Column:
        return F.when(on, c)

    current = F.col("total_current")
    return {
        "end_us": (F.max, charging(F.col("msg_us"))),
        "start_soc": (F.min, charging(F.col("soc"))),
        "end_soc": (F.max, charging(F.col("soc"))),
        "ampere_hours": (F.sum, charging(F.col("gap_us") / US_PER_HOUR * current)),
        "_current": (F.sum, charging(current)),
        "_frames": (F.sum, charging(F.when(current.isNotNull(), 1))),
        "_peak": (F.max, charging(current)),
        "_closed": (F.max, F.col("closing")),
    }


def _records(found: DataFrame, *columns: str) -> DataFrame:
    mean = F.try_divide(F.col("_current"), F.col("_frames"))
    kind = charge_type(mean, F.col("_peak")).alias("charge_type")
    values = ["end_us", "start_soc", "end_soc", "ampere_hours", kind]
    return found.where("_closed").select(*SESSION, *values, *columns)


def mode_and_charge(rows: DataFrame, describe: Sequence[str] = DESCRIBE) -> DataFrame:
    """One record per session: type, ampere-hours, lowest and highest state of charge.

    One hash aggregation over the rows of :func:`own_rows` or :func:`window_rows`.
    """
    totals = [make(c).alias(name) for name, (make, c) in _totals().items()]
    grouped = rows.where(F.col("on") | F.col("closing")).groupBy(*SESSION, *describe)
    return _records(grouped.agg(*totals), *describe)


def charge_records(
    rows: DataFrame, base: DataFrame, describe: Sequence[str] = DESCRIBE
) -> DataFrame:
    """The full charge record of each session, with the licence plate of the vehicle.

    ``max_cells`` and ``min_cells`` tell how often each cell had the highest and the
    lowest voltage. They come from the same pass over the rows as the other values.
    """
    on = F.col("on")
    cells = {
        "max_cells": F.when(on, F.col("max_cell_num")),
        "min_cells": F.when(on, F.col("min_cell_num")),
    }
    found = filled_histograms(
        rows.where(on | F.col("closing")), [*SESSION, *describe], cells, CELLS, _totals()
    )
    return _records(found, *describe, *cells).join(base.select("vin", "license_plate"), "vin")


def current_histograms(
    frames: DataFrame, records: DataFrame, as_of: date | None = None, disjoint: bool = False
) -> DataFrame:
    """Charging frames per 5 A bucket, by province, vehicle type, vehicle and charge type.

    ``records`` is read several times, so it should be a stored table. With ``as_of`` the
    records that ended on the day before count, and frames are read from the partition before the one in which
    the earliest of them began (their ``dt`` may be a day of another time zone) up to that day.
    """
    if as_of is not None:
        day, after = previous_day(as_of)
        ended = F.col("end_us")
        records = records.where((ended >= day_micros(day)) & (ended < day_micros(after)))
        begun = records.agg(F.min("start_us").alias("us")).first()["us"]
        if begun is None:
            frames = frames.where(F.lit(False))
        else:
            earliest = min(day, datetime.fromtimestamp(begun // 1_000_000, timezone.utc).date())
            frames = frames.where(F.col("dt").between(f"{previous_day(earliest)[0]}", f"{day}"))
    charging = frames.where(F.col("charge_status") == "1").select(
        "vin", "province", "vehicle_type", "msg_us", "total_current"
    )
    windows = records.select(
        "vin", "start_us", "end_us", "charge_type", F.col("province").alias("_province")
    )
    inside = in_windows(charging, windows, ["vin"], "msg_us", "start_us", "end_us", disjoint)
    return filled_histograms(
        inside.where(F.col("province") == F.col("_province")),
        ["province", "vehicle_type", "vin", "charge_type"],
        {"frequency": band("total_current", CURRENT_STEP)},
        CURRENT_BUCKETS,
    )


def session_spread(rows: DataFrame, spread: str, least_soc: float = 0.8) -> DataFrame:
    """Sessions crossing 80 %, with the mean voltage spread of their frames from 80 % on."""
    high = F.col("on") & (F.col("soc") >= least_soc)
    mean = F.avg(F.when(high, F.col(spread))).alias("spread")
    return crossing(sessions(rows, extra=[mean]))


def spread_trend(
    rows: DataFrame,
    spread: str,
    n: int = 10,
    slope_over: float = 0.05,
    range_over: float = 40.0,
) -> DataFrame:
    """Whether the voltage spread grows over the last ``n`` sessions, at each session."""
    return trend_of(session_spread(rows, spread), n, slope_over, range_over)


def trend_of(
    spreads: DataFrame, n: int = 10, slope_over: float = 0.05, range_over: float = 40.0
) -> DataFrame:
    """The same from the rows of :func:`session_spread`, as computed or as stored.

    ``day_diff`` holds the days from each session to the one before it.
    """
    found = last_n(spreads, n, carry=["spread"])
    return (
        found.select(
            "vin",
            "start_us",
            F.transform("recent", lambda s: s["spread"]).alias("vol_diff"),
            session_gaps(F.col("recent")).alias("day_diff"),
        )
        .withColumn("slope", F.expr(slope("day_diff", "vol_diff")))
        .withColumn("day_range", F.array_max("day_diff") - F.array_min("day_diff"))
        .withColumn(
            "is_warning",
            flag((F.col("slope") > slope_over) & (F.col("day_range") > range_over)),
        )
    )
