from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from packwatch.functions.scalars import US_PER_HOUR
from packwatch.operators.sessions import session_rows
from packwatch.plans import charging, classify, health, warnings, weekly

WARNING = (
    "vin string, vehicle_type string, enterprise string, province string, warning_type string, "
    "warning_start_time timestamp, risk_level string, review_status string"
)


@pytest.fixture()
def warned(spark):
    t = datetime
    rows = [
        ("v1", "A", "e", "p", "w1", t(2024, 1, 1, 9, 59, 59, 999999), "1", "1"),
        ("v1", "A", "e", "p", "w1", t(2024, 1, 1, 10, 0), "1", "1"),
        ("v1", "B", "e", "p", "w1", t(2024, 1, 1, 10, 30), "2", "2"),
        ("v1", "A", "e", "q", "w2", t(2024, 1, 1, 10, 59, 59, 999999), "3", "3"),
        ("v2", "A", "e", "p", "w1", t(2024, 1, 1, 10, 5), "4", "1"),
        ("v2", "A", "f", "p", "w1", t(2024, 1, 1, 11, 0), "1", "4"),
    ]
    return spark.createDataFrame(rows, WARNING)


def test_hourly_and_daily_warnings(warned):
    hour = warnings.hourly_warnings(warned, datetime(2024, 1, 1, 11, 20))
    got = sorted((r.vin, r.vehicle_type, r.province, r.warning_type, r.total) for r in hour.collect())
    # two types of one vehicle: each count appears under both
    assert got == [
        ("v1", "A", "p", "w1", 2),
        ("v1", "A", "q", "w2", 1),
        ("v1", "B", "p", "w1", 2),
        ("v1", "B", "q", "w2", 1),
        ("v2", "A", "p", "w1", 1),
    ]
    assert {(r.dt, r.year, r.month, r.day) for r in hour.collect()} == {("2024-01-01 10", "2024", "01", "01")}
    hourly = warnings.hourly_warnings(warned)
    daily = warnings.daily_warnings(hourly, date(2024, 1, 2)).collect()
    # 1 from 9 h and 2 under each of two types from 10 h
    assert {r.total for r in daily if (r.vin, r.province) == ("v1", "p")} == {5}
    assert {r.dt for r in daily} == {"2024-01-01"}
    assert warnings.daily_warnings(hourly, date(2024, 1, 1)).count() == 0
    assert sum(r.total for r in warnings.daily_warnings(hourly.where("vin = 'v2'")).where("enterprise = 'e'").collect()) == 2


def test_failures(spark):
    t = datetime
    rows = [
        ("e", "p", "T", "v", "f1", t(2024, 1, 1, 10, 0)),
        ("e", "p", "T", "v", "f1", t(2024, 1, 1, 10, 59)),
        ("e", "p", "T", "v", None, t(2024, 1, 1, 10, 1)),
        ("e", "p", "T", "v", "f1", t(2024, 1, 1, 11, 0)),
    ]
    df = spark.createDataFrame(
        rows, "enterprise string, province string, vehicleType string, vin string, failureType string, failureStartTime timestamp"
    )
    hour = warnings.hourly_failures(df, datetime(2024, 1, 1, 11, 59))
    assert sorted((str(r.failureType), r.total, r.day) for r in hour.collect()) == [
        ("None", 0, "2024-01-01"),
        ("f1", 2, "2024-01-01"),
    ]
    daily = warnings.daily_failures(warnings.hourly_failures(df), date(2024, 1, 2))
    assert sorted((str(r.failureType), r.total) for r in daily.collect()) == [("None", 0), ("f1", 3)]


def test_risk(warned):
    row = warnings.province_risk(warned, datetime(2024, 1, 1, 12)).where("province = 'p'").collect()
    assert [(r.enterprise, r.highrisk_num, r.medrisk_num, r.lowrisk_num, r.safety_num, r.dt) for r in row] == [
        ("e", 2, 1, 0, 0, "2024-01-01 12:00:00")
    ]
    levels = warnings.risk_levels(warned).collect()
    assert [tuple(r) for r in levels] == [("e", 2, 1, 1)]


def test_hour_filter_reaches_the_scan(warned, tmp_path):
    path = str(tmp_path / "w")
    warned.write.parquet(path)
    read = warned.sparkSession.read.parquet(path)
    found = warnings.hourly_warnings(read, datetime(2024, 1, 1, 11, 20))
    found.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = found._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(warning_start_time" in plan and "LessThan(warning_start_time" in plan


def test_weekly_means_and_range(spark):
    rows = [("e", "p", "t", "v", d, x, 1.0, 0.5, 0.1, 20.0, 100.0, 2.0) for d, x in [
        ("2024-01-07", 9.0), ("2024-01-08", 1.0), ("2024-01-14", 1.1), ("2024-01-15", 9.0)]]
    df = spark.createDataFrame(
        rows,
        "enterprise string, province string, vehicleType string, vin string, dt string, "
        "differenceCellVoltage double, maxProbeTemperature double, minProbeTemperature double, "
        "maxTemperatureRate double, averageProbeTemperature double, resistance double, wDischargeRate double",
    )
    for day in (15, 17, 21):
        row = weekly.vehicle_means(df, date(2024, 1, day)).first()
        assert (row.diff_Voltage, row.diff_temper) == (1.1, 0.5)


def test_class_limits_need_both_states(spark):
    rows, classes = [], []
    for c in ("x", "y"):
        for i in range(3):
            vin = f"{c}{i}"
            classes.append(("e", vin, c))
            for state in "10" if c == "x" else "1":
                rows.append(("e", vin, state, float(i + 1), float(i + 1), 5.0 + i, 5.0, 100.0 * (i + 1)))
    classes.append(("e", "unseen", "x"))
    df = spark.createDataFrame(
        rows,
        "enterprise string, vin string, chargeStatus string, differenceCellVoltage double, "
        "maxTemperatureRate double, maxProbeTemperature double, minProbeTemperature double, resistance double",
    )
    known = spark.createDataFrame(classes, "enterprise string, vin string, classification string")
    got = {r.vin: r for r in weekly.class_limits(df, known).collect()}
    assert len(got) == 7
    assert got["x1"].chargeMaxVolDiff == 4.5 and got["unseen"].unchargeMinResistance == 150.0
    assert got["y1"].chargeMaxVolDiff is None


def test_first_use(spark):
    t = datetime
    rows = [
        ("e", "a", 0.5, t(2024, 4, 1)), ("e", "a", 1.0, t(2024, 7, 1)),
        ("e", "b", 0.2, t(2024, 1, 1)), ("e", "c", 1.1, t(2024, 4, 1)),
        ("e", "d", 0.0, t(2024, 10, 2)), ("e", "f", 0.9, t(2024, 3, 31)),
    ]
    df = spark.createDataFrame(rows, "enterprise string, vin string, odo double, msg_ts timestamp")
    new = classify.first_use(df)
    assert {r.vin: r.quarter for r in new.collect()} == {
        "a": "summer", "b": "winter", "c": "none", "d": "automn", "f": "spring",
    }
    old = spark.createDataFrame([("e0", "a", "winter"), ("e0", "z", "none")], "enterprise string, vin string, quarter string")
    merged = classify.upsert_first_use(old, new)
    got = {r.vin: (r.enterprise, r.quarter) for r in merged.collect()}
    assert got["a"] == ("e0", "winter") and got["z"] == ("e0", "none") and got["d"] == ("e", "automn")
    again = classify.upsert_first_use(merged, new)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, merged.collect()))


def test_classes(spark):
    t = datetime
    frames = spark.createDataFrame(
        [("e", "a", "p", "t", 19_999.0, t(2024, 3, 30), "2024-03-30"), ("e", "a", "q", "t", 20_000.0, t(2024, 3, 30, 5), "2024-03-30"),
         ("e", "b", None, "t", 0.0, t(2024, 2, 29), "2024-02-29"), ("e", "c", "p", "t", 0.0, t(2024, 2, 28), "2024-02-28")],
        "enterprise string, vin string, province string, vehicleType string, odo double, msg_ts timestamp, dt string",
    )
    initial = spark.createDataFrame([(v, "spring") for v in "abc"], "vin string, quarter string")
    base = spark.createDataFrame([(v, date(2020, 5, 1)) for v in "abc"], "vin string, delivery_time date")
    now = classify.classes(frames, initial, base, as_of=date(2024, 3, 31))
    assert {r.vin: r.classification for r in now.collect()} == {"a": "q-t-2020-spring-2", "b": "t-2020-spring-0"}
    last = spark.createDataFrame([("e", "a", "old"), ("e", "c", "kept")], "enterprise string, vin string, classification string")
    merged = {r.vin: (r.classification, r.dt) for r in classify.merge_classes(now, last, "2024-03").collect()}
    assert merged == {"a": ("q-t-2020-spring-2", "2024-03"), "b": ("t-2020-spring-0", "2024-03"), "c": ("kept", "2024-03")}


FRAME = (
    "vin string, msg_us long, frame_id long, charge_status string, soc double, total_current double, "
    "max_cell_num int, min_cell_num int, province string, vehicle_type string, enterprise string, dt string"
)


def charge_frames(spark, currents, step=US_PER_HOUR, cells=(1, 96, 97)):
    n = len(currents)
    rows = [
        ("v", i * step, i, "1" if i < n else "0", 0.1 + i / 100, float(c), cells[i % len(cells)], 5, "p", "t", "e", "1970-01-01")
        for i, c in enumerate([*currents, 0.0])
    ]
    return spark.createDataFrame(rows, FRAME)


def record(spark, currents):
    frames = charge_frames(spark, currents)
    own = charging.mode_and_charge(charging.own_rows(frames, F.col("charge_status") == "1")).first()
    windows = spark.createDataFrame([("v", 0, (len(currents) - 1) * US_PER_HOUR)], "vin string, start_us long, end_us long")
    given = charging.mode_and_charge(charging.window_rows(frames, windows)).first()
    assert own == given
    return own


def test_charge_record(spark, hot):
    assert record(spark, [10.0]).ampere_hours == 0.0  # a single frame
    assert record(spark, [30.0, 30.0]).charge_type == "1"  # mean 30
    assert record(spark, [1.0, 1.0, 1.0, 70.0]).charge_type == "1"  # peak 70
    slow = record(spark, [10.0, 20.0, 40.0])
    assert (slow.charge_type, slow.ampere_hours) == ("0", 60.0)
    assert (slow.start_soc, round(slow.end_soc, 6), slow.province) == (0.1, 0.12, "p")


def test_cell_histograms(spark):
    frames = charge_frames(spark, [1.0] * 7)
    rows = charging.own_rows(frames, F.col("charge_status") == "1")
    base = spark.createDataFrame([("v", "plate")], "vin string, license_plate string")
    row = charging.charge_records(rows, base).first()
    assert len(row.max_cells) == len(row.min_cells) == 96
    assert (row.max_cells[0], row.max_cells[95], sum(row.max_cells)) == (3, 2, 5)  # cell 97 is none
    assert row.min_cells[4] == sum(row.min_cells) == 7 and row.license_plate == "plate"


def test_current_histogram(spark, hot):
    currents = [-4.0, 0.0, 4.9, 5.0, 154.9, 155.0]
    frames = charge_frames(spark, currents, step=10)
    more = spark.createDataFrame(
        [("v", 25, 90, "0", 0.5, 5.0, 1, 1, "p", "t", "e", "1970-01-01"),  # not charging
         ("v", 26, 91, "1", 0.5, 5.0, 1, 1, "q", "t", "e", "1970-01-01"),  # other province
         ("w", 26, 92, "1", 0.5, 200.0, 1, 1, "p", "t", "e", "1970-01-01")],
        FRAME,
    )
    records = spark.createDataFrame(
        [("v", 0, 50, "1", "p"), ("v", 10, 30, "0", "p"), ("w", 26, 26, "0", "p")],
        "vin string, start_us long, end_us long, charge_type string, province string",
    )
    found = charging.current_histograms(frames.unionByName(more), records, as_of=date(1970, 1, 2))
    got = {(r.vin, r.charge_type): r.frequency for r in found.collect()}
    assert [len(v) for v in got.values()] == [31] * 3
    assert (got["v", "1"][0], got["v", "1"][1], got["v", "1"][30], sum(got["v", "1"])) == (3, 1, 1, 5)
    assert (got["v", "0"][0], got["v", "0"][1], sum(got["v", "0"])) == (2, 1, 3)  # both ends count
    assert sum(got["w", "0"]) == 0  # only a value outside the domain
    assert charging.current_histograms(frames, records, as_of=date(1970, 1, 3)).count() == 0


def test_spread_trend(spark, hot):
    day = 24 * US_PER_HOUR
    rows, i = [], 0
    for s in range(12):
        for soc, status in ((0.5, "1"), (0.8, "1"), (0.9, "1"), (0.9, "0")):
            spread = 100.0 if soc < 0.8 else 1.0 + s + (0.5 if soc == 0.9 else -0.5)
            rows.append(("v", s * day * (s + 1) // 2 + i % 4, i, status, soc, soc * 100, spread))
            i += 1
    df = spark.createDataFrame(rows, "vin string, msg_us long, frame_id long, charge_status string, soc double, soc_pct double, x double")
    found = charging.spread_trend(
        session_rows(df, F.col("charge_status") == "1"), "x", 10, range_over=9.5
    ).collect()
    got = {r.start_us // day: r for r in found}
    assert sorted(got) == [45, 55, 66]  # from the tenth session on
    first = got[45]
    assert first.vol_diff == [1.0 + s for s in range(10)]
    assert [round(d) for d in first.day_diff] == list(range(10))
    assert first.slope == pytest.approx(1.0, abs=1e-6) and first.is_warning == "0"
    assert got[66].day_diff[0] == 0.0 and got[66].is_warning == "1"


def test_models_over_windows(spark, hot):
    rows = [("v", t, t, 0.2, -20.0, 1000.0 - (500.0 if t >= 60 else 0.0), t % 96 + 1, 1) for t in range(120)]
    frames = spark.createDataFrame(
        rows,
        "vin string, msg_us long, frame_id long, cell_spread double, total_current double, resistance double, max_cell_num int, min_cell_num int",
    )
    windows = spark.createDataFrame([("v", 0, 59), ("v", 0, 119), ("v", 100, 110)], "vin string, start_us long, end_us long")

    def flags(model):
        found = health.run_models(frames, windows, model).collect()
        return {(r.start_us, r.end_us): r.is_warning for r in found}

    assert flags(health.impedance_run) == {(0, 59): "1", (0, 119): "1", (100, 110): "0"}
    assert flags(health.resistance_run) == {(0, 59): "0", (0, 119): "1", (100, 110): "0"}
    assert set(flags(health.sampling_run).values()) == {None}
    assert [tuple(r) for r in health.whole_history(frames).collect()] == [("v", 0, 119)]


def test_current_histogram_of_a_charge_begun_days_before(spark):
    day = 86_400_000_000
    frames = spark.createDataFrame(
        [("v", d * day + 5, d, "1", 0.5, 7.0, 1, 1, "p", "t", "e", f"1970-01-0{d + 1}") for d in range(5)], FRAME
    )
    records = spark.createDataFrame(
        [("v", 5, 4 * day + 5, "0", "p")], "vin string, start_us long, end_us long, charge_type string, province string"
    )
    found = charging.current_histograms(frames, records, as_of=date(1970, 1, 6)).first()
    assert (found.frequency[1], sum(found.frequency)) == (5, 5)
