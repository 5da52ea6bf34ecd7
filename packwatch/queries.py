"""The registered queries: each takes (spark, folder) and runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packwatch import lens
from packwatch.functions import flags
from packwatch.functions import scalars as S
from packwatch.operators import keyed, models, sessions, signals
from packwatch.operators.boxplot import quartiles, with_fences
from packwatch.operators.histogram import array_text
from packwatch.plans import charging, classify, health, warnings, weekly
from packwatch.session import settle, work_folder
from packwatch.sources import readers
from packwatch.sources.readers import clean_frames
from packwatch.streaming import detectors

Query = Callable[[SparkSession, str], DataFrame]

LAST_N = 3
ORDER = ["msg_us", "frame_id"]
# stretches of time in which a stream arrives
PARTS = 2
# frames of a signal that goes through a function at once
STRETCH = 60


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return lens.table(spark, folder, "events")


def _frames(spark: SparkSession, folder: str) -> DataFrame:
    return lens.frames(_events(spark, folder))


def _session_rows(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Frames with their session, carrying only the columns the query needs."""
    frames = _frames(spark, folder).select(
        "vin", "msg_us", "frame_id", "charge_status", "soc_pct", *columns
    )
    return sessions.session_rows(frames, lens.charging())


def _charge_rows(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    frames = _frames(spark, folder).select(
        *["vin", "msg_us", "frame_id", "charge_status", "soc", "total_current"],
        *charging.DESCRIBE,
        *columns,
    )
    return charging.own_rows(frames, lens.charging())


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: S.half_up(c, digits) for c in columns})


# --- ingest and scalars ---


def json_extract_frames(spark, folder):
    clean = clean_frames(lens.raw_frames(_events(spark, folder)))
    vector = S.numeric_vector("cellVoltage")
    return clean.select(
        "frame_id",
        "vin",
        F.col("msgTime").try_cast("long").alias("msg_ms"),
        "speed",
        "odo",
        "chargeStatus",
        F.col("maxCellVoltageNum").try_cast("int").alias("max_cell_num"),
        "resistance",
        "totalCurrent",
        "soc",
        (F.element_at(vector, 1) + F.element_at(vector, 2)).alias("cell_sum"),
        F.col("city").isNull().alias("no_city"),
        "dt",
    )


def unit_scale_bucket(spark, folder):
    f = _frames(spark, folder)
    n = F.col("k").cast("long")
    return f.select(
        "frame_id",
        (F.col("cell_spread") * 1000).alias("spread_mv"),
        (F.floor(F.col("msg_us") / 1000) / (1000 * 60 * 60)).alias("msg_hours"),
        (F.floor(F.col("msg_us") / 1000) / (1000 * 3600 * 24)).alias("msg_days"),
        S.band("odo", 10_000).alias("odo_band"),
        S.band(F.col("total_current") - 50, 5).alias("current_band"),
        (F.col("high_v") - F.col("low_v")).alias("difference"),
        S.rank_whole(n, 3).alias("q3_whole"),
        S.rank_fraction(n, 3).alias("q3_fraction"),
        S.rank_whole(n, 1).alias("q1_whole"),
        S.rank_fraction(n, 1).alias("q1_fraction"),
        S.half_up("total_current", 1).alias("current_1dp"),
    )


def vector_parse_axis_stats(spark, folder):
    parsed = lens.vector_frames(lens.table(spark, folder, "embeddings")).select(
        "vec_id", S.numeric_vector("cell_text").alias("v")
    )
    names = ["mean", "total", "lowest", "highest", "std_samp", "std_pop"]
    v = F.col("v")
    by_frame = parsed.select(
        F.lit("frame").alias("axis"),
        F.col("vec_id").alias("id"),
        signals.vector_mean(v).alias("mean"),
        F.aggregate(v, F.lit(0.0), lambda a, x: a + x).alias("total"),
        F.array_min(v).alias("lowest"),
        F.array_max(v).alias("highest"),
        signals.vector_std(v).alias("std_samp"),
        signals.vector_std(v, sample=False).alias("std_pop"),
    )
    by_cell = (
        signals.cells(parsed, [], "v")
        .groupBy("cell_no")
        .agg(*signals.signal_stats("voltage"))
        .select(F.lit("cell").alias("axis"), F.col("cell_no").cast("long").alias("id"), *names)
    )
    return _rounded(by_frame.unionByName(by_cell), 6, *names)


# --- warnings, failures, risk ---


def province_risk(spark, folder):
    return warnings.province_risk(lens.order_warnings(spark, folder), weight="n")


def risk_level(spark, folder):
    return warnings.risk_levels(lens.order_warnings(spark, folder), weight="n")


def warnings_hourly(spark, folder):
    return warnings.hourly_warnings(lens.warnings(_events(spark, folder)))


def warnings_daily(spark, folder):
    return warnings.daily_warnings(warnings_hourly(spark, folder))


def failures_hourly(spark, folder):
    return warnings.hourly_failures(lens.failures(_events(spark, folder)))


def failures_daily(spark, folder):
    return warnings.daily_failures(failures_hourly(spark, folder))


# --- box statistics ---


def weekly_vehicle_means(spark, folder):
    frames = lens.weekly_frames(_events(spark, folder))
    weeks = frames.withColumn("week", S.week_start("msg_ts").cast("string"))
    return weekly.vehicle_means(weeks, period=["week"])


def _boxes_text(boxes: DataFrame) -> DataFrame:
    return _rounded(boxes, 4, "q1", "q2", "q3")


def tukey_quartiles(spark, folder):
    units = (
        lens.table(spark, folder, "lineitem")
        .groupBy("l_returnflag", "l_linestatus", "l_suppkey")
        .agg(
            *[
                S.half_up(F.avg(f"l_{c}"), 3).alias(c)
                for c in ("quantity", "extendedprice", "discount", "tax")
            ]
        )
    )
    groups = ["l_returnflag", "l_linestatus"]
    metrics = ["quantity", "extendedprice", "discount", "tax"]
    return _boxes_text(quartiles(settle(units, "units"), groups, metrics))


def box_fences(spark, folder):
    units = lens.box_units(_events(spark, folder))
    boxes = quartiles(units, ["event_type"], list(lens.BOX_SIDES))
    both = with_fences(with_fences(boxes), rule="iqr", names=("iqr_max", "iqr_min"))
    return _rounded(_boxes_text(both), 4, "max_value", "min_value", "iqr_max", "iqr_min")


def _pack_exceptions(spark, folder):
    units = lens.box_units(_events(spark, folder))
    return weekly.pack_exceptions(units, ["event_type"], "event_id", lens.BOX_SIDES)


def pack_exception_report(spark, folder):
    report, _ = _pack_exceptions(spark, folder)
    flat = [
        F.col(f"{m}_box")[field].alias(f"{m}_{field.lower()}")
        for m in lens.BOX_SIDES
        for field in ("Q3", "Q2", "Q1", "maxvalue", "minvalue")
    ]
    return report.select("event_type", *flat, *[f"{m}_outliers" for m in lens.BOX_SIDES])


def pack_exception_outliers(spark, folder):
    _, listed = _pack_exceptions(spark, folder)
    return _rounded(listed, 6, "outlier")


def class_state_limits(spark, folder):
    frames = lens.weekly_frames(_events(spark, folder))
    classes = lens.vehicles(lens.table(spark, folder, "customer"))
    return weekly.class_limits(frames, classes.select("enterprise", "vin", "classification"))


# --- classification ---


def _first_use(spark, folder):
    frames = lens.order_frames(lens.table(spark, folder, "orders")).withColumn(
        "odo", F.col("price") / 400_000
    )
    old = classify.first_use(frames.where(lens.before_cutoff()))
    new = classify.first_use(frames.where(~lens.before_cutoff()))
    return classify.upsert_first_use(old, new)


def first_use_upsert(spark, folder):
    return _first_use(spark, folder)


def vehicle_classes(spark, folder):
    frames = lens.order_frames(lens.table(spark, folder, "orders")).withColumn(
        "odo", F.col("price")
    )
    base = lens.vehicles(lens.table(spark, folder, "customer"))
    initial = settle(_first_use(spark, folder), "first-use")
    last_month = classify.classes(frames.where(lens.before_cutoff()), initial, base)
    this_month = classify.classes(frames.where(~lens.before_cutoff()), initial, base)
    return classify.merge_classes(this_month, last_month, "1999-01")


# --- sessions ---

SESSION_COLUMNS = ["vin", "start_us", "end_us", "start_soc", "end_soc"]


def charge_sessions(spark, folder):
    return sessions.sessions(_session_rows(spark, folder)).select(*SESSION_COLUMNS)


def charge_large(spark, folder):
    found = sessions.sessions(_session_rows(spark, folder))
    return sessions.large_charges(found).select(*SESSION_COLUMNS)


def _last_n(found: DataFrame) -> DataFrame:
    times = sessions.sorted_times("recent")
    return found.select("vin", "start_us", array_text(times).alias("times"))


def charge_last_n(spark, folder):
    found = sessions.crossing(sessions.sessions(_session_rows(spark, folder)))
    return _last_n(sessions.last_n(found, LAST_N))


def charge_end_pattern(spark, folder):
    frames = _frames(spark, folder).select("vin", "msg_us", "frame_id", "charge_status")
    matched = sessions.followed_by(
        frames, F.col("charge_status") == "1", F.col("charge_status") == "0"
    )
    return matched.select("vin", "msg_us")


def charge_mode_ah(spark, folder):
    return _rounded(charging.mode_and_charge(_charge_rows(spark, folder)), 6, "ampere_hours")


def cell_histogram(spark, folder):
    rows = _charge_rows(spark, folder, "max_cell_num", "min_cell_num")
    base = lens.vehicles(lens.table(spark, folder, "customer"))
    return charging.charge_records(rows, base).select(
        "vin",
        "start_us",
        "license_plate",
        "charge_type",
        array_text("max_cells").alias("max_cells"),
        array_text("min_cells").alias("min_cells"),
    )


def current_histogram(spark, folder):
    records = settle(charging.mode_and_charge(_charge_rows(spark, folder)), "records")
    found = charging.current_histograms(_frames(spark, folder), records, disjoint=True)
    return found.withColumn("frequency", array_text("frequency"))


# --- models ---


def spread_trend(spark, folder):
    rows = _session_rows(spark, folder, "soc", "cell_spread")
    found = charging.spread_trend(rows, "cell_spread", LAST_N, slope_over=0.01, range_over=3.0)
    series = {
        name: F.array_join(
            F.transform(name, lambda x: F.round(x.cast("decimal(28,8)"), 4).cast("string")), ","
        )
        for name in ("vol_diff", "day_diff")
    }
    return _rounded(found.withColumns(series), 6, "slope", "day_range")


def spread_line(spark, folder):
    rows = _session_rows(spark, folder, "soc", "cell_spread")
    found = charging.session_spread(rows, "cell_spread")
    days = found.withColumn("day", F.col("start_us") / S.US_PER_DAY - 19_700)
    lines = models.spread_growth(days, ["vin"], "day", "spread", slope_over=0.01, range_over=10.0)
    return _rounded(lines, 4, "slope", "intercept", "x_axis", "x_range")


def impedance_flag(spark, folder):
    frames = _frames(spark, folder).select(
        "vin",
        "cell_spread",
        F.when(lens.charging(), -F.col("total_current")).otherwise(F.col("total_current")).alias("total_current"),
        F.lit(0).alias("start_us"),
        F.lit(0).alias("end_us"),
    )
    found = health.impedance_run(frames, slow_limit=9.0, fast_limit=11.0, slow_mean=45.0)
    return _rounded(found.drop("start_us", "end_us"), 6, "impedance", "mean_current", "peak_current")


def impedance_windows(spark, folder):
    """Impedance over the ten days from the start of each large charge, and over all time up to each: windows that overlap."""
    frames = _frames(spark, folder).select(
        "vin",
        "msg_us",
        "cell_spread",
        F.when(lens.charging(), -F.col("total_current")).otherwise(F.col("total_current")).alias("total_current"),
    )
    ten_days = _ten_days(spark, folder)
    before = ten_days.select("vin", F.lit(0).cast("long").alias("start_us"), F.col("start_us").alias("end_us"))
    wanted = settle(ten_days.unionByName(before), "windows")
    found = health.run_models(frames, wanted, lambda f: health.impedance_run(f, slow_limit=9.0, fast_limit=11.0, slow_mean=45.0))
    return _rounded(found, 6, "impedance", "mean_current", "peak_current")


def _ten_days(spark, folder):
    """Windows of ten days from the start of each large charge."""
    starts = sessions.large_charges(sessions.sessions(_session_rows(spark, folder))).select("vin", "start_us")
    return starts.select("vin", "start_us", (F.col("start_us") + 10 * S.US_PER_DAY).alias("end_us"))


def resistance_windows(spark, folder):
    """Fall of the resistance within ten days from the start of each large charge: windows that overlap."""
    frames = _frames(spark, folder).select("vin", "msg_us", "frame_id", "resistance")
    wanted = settle(_ten_days(spark, folder), "windows")
    found = health.run_models(frames, wanted, lambda f: health.resistance_run(f, drop=70.0))
    return _rounded(found, 4, "lowest_step")


def bms_windows(spark, folder):
    """Result of the sampling model over the same windows."""
    frames = _frames(spark, folder).select("vin", "msg_us", "cell_spread")
    wanted = settle(_ten_days(spark, folder), "windows")
    return _rounded(health.run_models(frames, wanted, health.sampling_run), 4, "mean_spread")


def resistance_drop(spark, folder):
    frames = _frames(spark, folder).select("vin", "msg_us", "frame_id", "resistance")
    return _rounded(
        models.resistance_drop(frames, ["vin"], ORDER, drop=70.0), 4, "lowest_step"
    )


def fluctuation_flag(spark, folder):
    frames = _frames(spark, folder).select("vin", "msg_us", "frame_id", "high_v", "low_v")
    found = models.voltage_fluctuation(frames, ["vin"], ORDER, "high_v", "low_v", 0.8)
    found = _rounded(found, 3, "high_path", "low_path")
    return _rounded(found, 6, "mean_change", "ratio")


def cell_dispersion(spark, folder):
    parsed = lens.vector_frames(lens.table(spark, folder, "embeddings")).select(
        "label", S.numeric_vector("cell_text").alias("v")
    )
    return models.cell_dispersion(parsed, ["label"], "v", mean_factor=1.0, std_factor=1.0)


def self_discharge(spark, folder):
    vectors = lens.table(spark, folder, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("cells")
    )
    frames = (
        _frames(spark, folder)
        .select("vin", "msg_us", "frame_id", "odo", "soc_pct", "speed")
        .withColumn("vec_id", F.col("frame_id") % vectors.select(F.count(F.lit(1))).scalar())
    )
    rests = models.rest_gaps(frames, ["vin"], ORDER, ["vec_id"]).select(
        "vin", "gap_days", "vec_id", F.col("before.vec_id").alias("vec_before")
    )
    pairs = rests.join(
        vectors.select(F.col("vec_id").alias("vec_before"), F.col("cells").alias("cells_before")),
        "vec_before",
    ).join(vectors, "vec_id")
    found = models.self_discharge(pairs, ["vin"], "cells_before", "cells", sigmas=2.4)
    return _rounded(found, 4, "largest_drop")


def bms_inputs(spark, folder):
    frames = _frames(spark, folder).select(
        "vin",
        "msg_us",
        "frame_id",
        "max_cell_num",
        "min_cell_num",
        "cell_spread",
        F.lit(0).alias("start_us"),
        F.lit(0).alias("end_us"),
    )
    found = health.sampling_signal(frames, piece=50).withColumns(
        {"high_cells": array_text("high_cells"), "low_cells": array_text("low_cells")}
    )
    return _rounded(found.drop("start_us", "end_us"), 4, "total")


def trend_function(spark, folder):
    """The SQL function of the spread trend, on the spreads of the last charges in millivolts and their gaps in hours."""
    flags.register(spark)
    rows = _session_rows(spark, folder, "soc", "cell_spread")
    found = charging.spread_trend(rows, "cell_spread", LAST_N)
    flag = F.expr("charge_vol_diff_exp(transform(vol_diff, v -> v * 1000), transform(day_diff, d -> d * 24))")
    return found.select("vin", "start_us", flag.alias("is_warning"))


def signal_functions(spark, folder):
    """The SQL functions over signals, on stretches of STRETCH frames of each vehicle."""
    flags.register(spark)
    frames = _frames(spark, folder).select(
        "vin",
        "msg_us",
        "frame_id",
        (F.col("cell_spread") * 1000).alias("spread"),
        F.when(lens.charging(), -F.col("total_current")).otherwise(F.col("total_current")).alias("cur"),
        *["soc", "resistance", "high_v", "low_v"],
        F.col("max_cell_num").cast("int").alias("high_cell"),
        F.col("min_cell_num").cast("int").alias("low_cell"),
    )
    cut = keyed.slices(frames, ["vin"], ORDER[0], ORDER[1:])
    numbered = keyed.positions(cut, ["vin"], ORDER, "_pos")
    signal = F.sort_array(F.collect_list(F.struct("_pos", *frames.columns[3:]))).alias("s")
    found = numbered.groupBy("vin", F.floor((F.col("_pos") - 1) / STRETCH).alias("piece")).agg(signal)
    return found.select(
        "vin",
        "piece",
        F.size("s").alias("frames"),
        F.expr("conn_impedance(s.spread, s.cur, s.soc, 9D, 11D)").alias("impedance"),
        F.expr("r_reduce(s.resistance, 70, 20)").alias("resistance"),
        F.expr("vol_fluctuation(s.high_v, s.low_v, 0.8D)").alias("fluctuation"),
        F.expr("bms_sampling(s.high_cell, s.low_cell, s.spread[0])").alias("sampling"),
    )


# --- streams ---


def _streamed(spark, folder, detect):
    """What a detector finds in the events, which arrive as JSON messages in PARTS stretches of time.

    The detector is started anew for each, on what has arrived since its last run.
    """
    landed, state = work_folder(spark, "messages"), work_folder(spark, "detector")
    found = None
    for i, part in enumerate(lens.landings(lens.messages(_events(spark, folder)), PARTS)):
        part.write.parquet(f"{landed}/{i:04d}")
        arrived = readers.message_stream(spark, "parquet", path=f"{landed}/*")
        # none of them is broken, so none needs to be read a second time for the dead letters
        found = detect(readers.frame_messages(arrived).where("NOT broken").drop("broken", "message"), state)
    return found


def _status(code):
    return F.col("chargeStatus") == code


def _streamed_sessions(spark, folder):
    return _streamed(spark, folder, lambda s, state: detectors.run_sessions(s, _status("1"), state))


def stream_sessions(spark, folder):
    return _streamed_sessions(spark, folder).select(*SESSION_COLUMNS)


def stream_large(spark, folder):
    return sessions.large_charges(_streamed_sessions(spark, folder)).select(*SESSION_COLUMNS)


def stream_last_n(spark, folder):
    return _last_n(_streamed(spark, folder, lambda s, state: detectors.run_last_n(s, _status("1"), LAST_N, state)))


def stream_pattern(spark, folder):
    def detect(s, state):
        return detectors.run_pattern(s, _status("1"), _status("0"), folder=state)

    found = _streamed(spark, folder, detect)
    return found.select("vin", "msg_us")


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        json_extract_frames,
        unit_scale_bucket,
        vector_parse_axis_stats,
        province_risk,
        risk_level,
        warnings_hourly,
        warnings_daily,
        failures_hourly,
        failures_daily,
        weekly_vehicle_means,
        tukey_quartiles,
        box_fences,
        pack_exception_report,
        pack_exception_outliers,
        class_state_limits,
        first_use_upsert,
        vehicle_classes,
        charge_sessions,
        charge_large,
        charge_last_n,
        charge_end_pattern,
        charge_mode_ah,
        cell_histogram,
        current_histogram,
        spread_trend,
        spread_line,
        impedance_flag,
        impedance_windows,
        resistance_windows,
        bms_windows,
        resistance_drop,
        fluctuation_flag,
        cell_dispersion,
        self_discharge,
        bms_inputs,
        trend_function,
        signal_functions,
        stream_sessions,
        stream_large,
        stream_last_n,
        stream_pattern,
    )
}
