"""The scheduled jobs: read stored tables, compute one period, store the result.

Each job takes its moment as ``as_of`` and replaces exactly the partition of its period as a whole,
so running it again gives the same tables, and an empty run empties its period. ``Layout`` names the table folders.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packwatch import schemas
from packwatch.functions.calendar import previous_day, previous_month, previous_week
from packwatch.operators.keyed import slices
from packwatch.operators.sessions import sessions
from packwatch.plans import charging, classify, health, warnings, weekly
from packwatch.session import settle
from packwatch.sources.readers import clean_frames, read_frames, read_stored
from packwatch.sources.writers import overwrite_table, write_documents, write_period

TEXT, WHOLE = schemas.TEXT, schemas.WHOLE
HOURLY_WARNINGS = schemas.struct(
    vin=TEXT, vehicle_type=TEXT, enterprise=TEXT, province=TEXT, warning_type=TEXT,
    total=WHOLE, year=TEXT, month=TEXT, day=TEXT, dt=TEXT,
)
HOURLY_FAILURES = schemas.struct(
    enterprise=TEXT, province=TEXT, vehicleType=TEXT, vin=TEXT, failureType=TEXT,
    total=WHOLE, day=TEXT, dt=TEXT,
)
CLASSES = schemas.struct(enterprise=TEXT, vin=TEXT, classification=TEXT, dt=TEXT)


OPEN_CHARGES = schemas.struct(vin=TEXT, start_us=WHOLE, dt=TEXT)
RECORDS = schemas.struct(
    vin=TEXT, license_plate=TEXT, start_us=WHOLE, end_us=WHOLE, start_soc=schemas.NUMBER, end_soc=schemas.NUMBER,
    ampere_hours=schemas.NUMBER, charge_type=TEXT, province=TEXT, vehicle_type=TEXT, enterprise=TEXT, dt=TEXT,
)
SPREADS = schemas.struct(vin=TEXT, start_us=WHOLE, end_us=WHOLE, spread=schemas.NUMBER, dt=TEXT)

#: Models that run over the charges closed in a day, with the index of their documents.
MODELS = {
    "connection_impedance_es": health.impedance_run,
    "resistance_reduce": health.resistance_run,
    "bms_sampling": health.sampling_run,
}


@dataclass(frozen=True)
class Layout:
    root: str

    def table(self, name: str) -> str:
        return os.path.join(self.root, "tables", name)

    def documents(self, index: str, period: str) -> str:
        return os.path.join(self.root, "documents", index, f"period={period}")


def load_day(raw: DataFrame, layout: Layout, day: date) -> None:
    """Clean the raw frames of one day into its partition."""
    clean = clean_frames(raw.where(F.col("dt") == f"{day}"))
    write_period(clean, layout.table("frames"), {"dt": f"{day}"})


def hourly_warnings(found: DataFrame, layout: Layout, as_of: datetime) -> None:
    """Warnings of the last full hour; the hour is a partition below its day."""
    counted = warnings.hourly_warnings(found, as_of)
    start = warnings.previous_hour(as_of)[0]
    period = {"year": f"{start:%Y}", "month": f"{start:%m}", "day": f"{start:%d}", "dt": f"{start:%Y-%m-%d %H}"}
    write_period(counted, layout.table("warnings_hourly"), period)
    hour = f"{start:%Y-%m-%d-%H}"
    rows = counted.drop("year", "month", "day")
    publish(rows, layout, "warninginfo_statistic_perhour", hour)


def daily_warnings(spark: SparkSession, layout: Layout, as_of: date) -> None:
    stored = read_stored(spark, layout.table("warnings_hourly"), HOURLY_WARNINGS)
    day = f"{previous_day(as_of)[0]}"
    publish(warnings.daily_warnings(stored, as_of), layout, "warninginfo_statistic_perday", day)


def hourly_failures(found: DataFrame, layout: Layout, as_of: datetime) -> None:
    counted = warnings.hourly_failures(found, as_of)
    start = warnings.previous_hour(as_of)[0]
    write_period(counted, layout.table("failures_hourly"), {"day": f"{start:%Y-%m-%d}", "dt": f"{start:%Y-%m-%d %H}"})
    hour = f"{start:%Y-%m-%d-%H}"
    publish(counted.drop("day"), layout, "failure_statistics_perhour", hour)


def daily_failures(spark: SparkSession, layout: Layout, as_of: date) -> None:
    stored = read_stored(spark, layout.table("failures_hourly"), HOURLY_FAILURES)
    day = f"{previous_day(as_of)[0]}"
    publish(warnings.daily_failures(stored, as_of), layout, "failure_statistics_perday", day)


def risk(found: DataFrame, layout: Layout, as_of: datetime) -> None:
    period = f"{as_of:%Y-%m-%d-%H}"
    publish(warnings.province_risk(found, as_of), layout, "province_warning_index", period)
    publish(warnings.risk_levels(found, as_of), layout, "risk_level_index", period)


def weekly_report(spark: SparkSession, layout: Layout, as_of: date) -> None:
    """Store the weekly means, then report the packs beyond the fences of their group."""
    frames = read_frames(spark, layout.table("frames"))
    overwrite_table(weekly.vehicle_means(frames, as_of), layout.table("week_means"))
    means = spark.read.parquet(layout.table("week_means"))
    report, listed = weekly.pack_exceptions(means)
    week = f"{previous_week(as_of)[0]}"
    found = weekly.exception_documents(report, listed).withColumnRenamed("vehicleType", "vehicle_type")
    publish(found.withColumn("dt", F.lit(week)), layout, "batterypack_exception", week)


def class_limits(spark: SparkSession, layout: Layout, as_of: date) -> None:
    """Box limits of the last week by the classes of the month before its Sunday."""
    week, after = previous_week(as_of)
    month = previous_month(after - timedelta(days=1))
    known = spark.read.schema(CLASSES).parquet(layout.table("classes")).where(F.col("dt") == month)
    frames = read_frames(spark, layout.table("frames"))
    found = weekly.class_limits(frames, known, as_of).withColumn("dt", F.lit(f"{week}"))
    publish(found, layout, "warningboxplot", f"{week}")


def monthly_classes(
    spark: SparkSession, base: DataFrame, layout: Layout, as_of: date, first_run: bool = False
) -> None:
    """Update the first-use seasons, then classify every vehicle for the month."""
    frames = read_frames(spark, layout.table("frames"))
    seasons = layout.table("first_use")
    fresh = classify.first_use(frames, as_of)
    if first_run:
        overwrite_table(fresh, seasons)
    else:
        known = spark.read.schema(fresh.schema).parquet(seasons)
        overwrite_table(classify.upsert_first_use(known, fresh), seasons, reads_itself=True)
    initial = spark.read.schema(fresh.schema).parquet(seasons)
    now, month = classify.classes(frames, initial, base, as_of), f"{as_of:%Y-%m}"
    if first_run:
        found = now.withColumn("dt", F.lit(month))
    else:
        stored = spark.read.schema(CLASSES).parquet(layout.table("classes"))
        last = stored.where(F.col("dt") == previous_month(as_of)).drop("dt")
        found = classify.merge_classes(now, last, month)
    write_period(found, layout.table("classes"), {"dt": month})


def plan_frames(spark: SparkSession, layout: Layout) -> DataFrame:
    """The stored clean frames under the names that session and model plans take.

    Frames have no number of their own, so a hash of the whole frame orders those of one vehicle and instant. Rows
    without a vehicle or a time have no place in a session and are left out.
    """
    clean = read_frames(spark, layout.table("frames"))
    return clean.where("vin IS NOT NULL AND msg_ts IS NOT NULL").select(
        "vin",
        F.unix_micros("msg_ts").alias("msg_us"),
        F.xxhash64(*[F.col(c) for c in clean.columns]).alias("frame_id"),
        F.col("chargeStatus").alias("charge_status"),
        "soc",
        F.round(F.col("soc") * 100, 8).alias("soc_pct"),
        F.col("totalCurrent").alias("total_current"),
        F.col("maxCellVoltageNum").try_cast("int").alias("max_cell_num"),
        F.col("minCellVoltageNum").try_cast("int").alias("min_cell_num"),
        F.col("differenceCellVoltage").alias("cell_spread"),
        "resistance",
        "province",
        F.col("vehicleType").alias("vehicle_type"),
        "enterprise",
        "dt",
    )


def charge_rows(spark: SparkSession, layout: Layout, day: date) -> DataFrame:
    """Session rows of a day's frames, and of the charges that were open when it began.

    A table keeps which charges were still open at the end of a day, and since when. The next day reads its own
    frames, and earlier ones of just those vehicles, back to where the earliest of them began.
    """
    eve = previous_day(day)[0]
    frames = plan_frames(spark, layout)
    still = read_stored(spark, layout.table("open_charges"), OPEN_CHARGES).where(F.col("dt") == f"{eve}").drop("dt")
    found = frames.where(F.col("dt") == f"{day}")
    begun = still.agg(F.min("start_us").alias("us")).first()["us"]
    if begun is not None:
        first = min(eve, datetime.fromtimestamp(begun // 1_000_000, timezone.utc).date())
        earlier = frames.where(F.col("dt").between(f"{previous_day(first)[0]}", f"{eve}")).join(still, "vin")
        found = found.unionByName(earlier.where(F.col("msg_us") >= F.col("start_us")).drop("start_us"))
    return charging.own_rows(found, F.col("charge_status") == "1")


def daily_charges(spark: SparkSession, base: DataFrame, layout: Layout, as_of: date) -> None:
    """Records of the charges that closed yesterday, whenever they began, stored and published."""
    day, _ = previous_day(as_of)
    rows = charge_rows(spark, layout, day)
    counted = settle(charging.charge_records(rows, base), "charge-records")
    kept = counted.select(*[F.col(c) for c in RECORDS.names if c != "dt"])
    write_period(kept, layout.table("charge_records"), {"dt": f"{day}"})
    opened = sessions(rows, keep_open=True).where("NOT closed").select("vin", "start_us")
    write_period(opened, layout.table("open_charges"), {"dt": f"{day}"})
    publish(counted, layout, "charge_record", f"{day}")


def stored_charges(spark: SparkSession, layout: Layout) -> DataFrame:
    """The charge records as stored, with their times in microseconds."""
    return read_stored(spark, layout.table("charge_records"), RECORDS)


def daily_current_histograms(spark: SparkSession, layout: Layout, as_of: date) -> None:
    """Current histograms of yesterday's charges, from the stored frames and records."""
    current_histograms(plan_frames(spark, layout), stored_charges(spark, layout), layout, as_of)


def daily_spreads(spark: SparkSession, layout: Layout, as_of: date, **limits: float) -> None:
    """Trend of the voltage spread at every charge closed yesterday that crossed 80 %.

    The spread of each such charge is stored once. A trend looks at those stored until then, of yesterday's
    vehicles only, so no frames of earlier charges are read again.
    """
    day, _ = previous_day(as_of)
    fresh = charging.session_spread(charge_rows(spark, layout, day), "cell_spread")
    write_period(fresh.select("vin", "start_us", "end_us", "spread"), layout.table("charge_spreads"), {"dt": f"{day}"})
    stored = read_stored(spark, layout.table("charge_spreads"), SPREADS)
    today = stored.where(F.col("dt") == f"{day}")
    history = stored.where(F.col("dt") <= f"{day}").join(today.select("vin").distinct(), "vin", "left_semi")
    trends = charging.trend_of(slices(history.drop("dt"), ["vin"], "start_us"), **limits)
    publish(trends.join(today.select("vin", "start_us"), ["vin", "start_us"]), layout, "charge_vol_day_diff", f"{day}")


def daily_models(spark: SparkSession, layout: Layout, as_of: date) -> None:
    """Impedance, resistance and sampling models over yesterday's charges, from the stored frames and records.

    The frames of the charges are brought together once, for all models.
    """
    day, _ = previous_day(as_of)
    charges = stored_charges(spark, layout).where(F.col("dt") == f"{day}").select(*health.WINDOW)
    begun = charges.agg(F.min("start_us").alias("us")).first()["us"]
    first = day if begun is None else min(day, datetime.fromtimestamp(begun // 1_000_000, timezone.utc).date())
    frames = plan_frames(spark, layout).where(F.col("dt").between(f"{previous_day(first)[0]}", f"{day}"))
    used = frames.select(
        "vin", "msg_us", "frame_id", "cell_spread", "total_current", "resistance", "max_cell_num", "min_cell_num"
    )
    inside = settle(health.window_frames(used, charges), "charge-frames")
    for index, model in MODELS.items():
        publish(model(inside), layout, index, f"{day}")


def current_histograms(
    frames: DataFrame, records: DataFrame, layout: Layout, as_of: date
) -> None:
    """Current histograms of the charges that ended yesterday."""
    day = f"{previous_day(as_of)[0]}"
    found = charging.current_histograms(frames, records, as_of)
    publish(found.withColumn("statis_time", F.lit(day)), layout, "charge_current_frequency", day)


def publish(df: DataFrame, layout: Layout, index: str, period: str) -> None:
    """Write the documents of one period, in place of those of an earlier run."""
    write_documents(df, layout.documents(index, period), index, mode="overwrite")
