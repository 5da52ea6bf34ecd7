"""The scheduled jobs on stored tables, each run twice."""

import json
from datetime import date, datetime, timedelta

import pytest

from packwatch.plans import jobs, late, warnings
from packwatch.sources.readers import read_stored


@pytest.fixture()
def layout(tmp_path):
    return jobs.Layout(str(tmp_path))


def documents(spark, layout, index):
    return spark.read.json(f"{layout.root}/documents/{index}")


def test_warnings_and_failures(spark, layout):
    t = datetime
    warned = spark.createDataFrame(
        [("v", "T", "e", "p", "w", t(2024, 1, 1, h, m), "1", "1") for h in (9, 10) for m in (0, 59)],
        "vin string, vehicle_type string, enterprise string, province string, warning_type string, "
        "warning_start_time timestamp, risk_level string, review_status string",
    )
    for hour in (10, 11, 11):
        jobs.hourly_warnings(warned, layout, t(2024, 1, 1, hour, 5))
    jobs.daily_warnings(spark, layout, date(2024, 1, 2))
    hourly = documents(spark, layout, "warninginfo_statistic_perhour")
    assert sorted((r.dt, r.total, r.warningType) for r in hourly.collect()) == [
        ("2024-01-01 09", 2, "w"),
        ("2024-01-01 10", 2, "w"),
    ]
    daily = documents(spark, layout, "warninginfo_statistic_perday").collect()
    assert [(r.dt, r.total, r.vehicleType) for r in daily] == [("2024-01-01", 4, "T")]

    failed = spark.createDataFrame(
        [("e", "p", "T", "v", "f", t(2024, 1, 1, h, 1)) for h in (9, 9, 10)],
        "enterprise string, province string, vehicleType string, vin string, failureType string, failureStartTime timestamp",
    )
    for hour in (10, 11, 11):
        jobs.hourly_failures(failed, layout, t(2024, 1, 1, hour))
    jobs.daily_failures(spark, layout, date(2024, 1, 2))
    assert documents(spark, layout, "failure_statistics_perday").first().total == 3
    jobs.risk(warned, layout, t(2024, 1, 1, 12))
    assert documents(spark, layout, "province_warning_index").first().highriskNum == 4
    assert documents(spark, layout, "risk_level_index").first().medriskNum == 0


def test_frames_to_report_and_classes(spark, layout):
    """Raw frames of January; vehicle 9 stands out in every metric."""
    docs = []
    for day in (9, 10):
        for v in range(10):
            odd = 50 if v == 9 else 1
            docs.append(
                {
                    "vin": f"v{v}", "enterprise": "e", "province": "p", "vehicleType": "t",
                    "msgTime": f"2024-01-{day:02d} 08:00:00", "chargeStatus": "1" if day == 9 else "0",
                    "differenceCellVoltage": odd * (10 + v), "maxProbeTemperature": odd * (20 + v),
                    "minProbeTemperature": 1, "maxTemperatureRate": odd * (1 + v / 10),
                    "averageProbeTemperature": odd * (15 + v), "wDischargeRate": odd * (2 + v),
                    "resistance": -10_000 if v == 9 else 1000 + v, "odo": 0.5 if v < 5 else 20_000,
                    "soc": "50%",
                }
            )
    rows = [(json.dumps(d), d["msgTime"][:10]) for d in docs]
    raw = spark.createDataFrame(rows, "data string, dt string")
    for day in (9, 10, 10):
        jobs.load_day(raw, layout, date(2024, 1, day))
    assert jobs.read_frames(spark, layout.table("frames")).count() == 20

    for _ in range(2):
        jobs.weekly_report(spark, layout, date(2024, 1, 17))
    doc = documents(spark, layout, "batterypack_exception").collect()
    assert len(doc) == 1 and (doc[0].vehicleType, doc[0].dt) == ("t", "2024-01-08")
    for field in ("cellVoldiffException", "temperException", "resistanceException"):
        assert [v.vin for v in doc[0][field].vehicles] == ["v9"]

    base = spark.createDataFrame([(f"v{v}", date(2020, 1, 1)) for v in range(10)], "vin string, delivery_time date")
    jobs.monthly_classes(spark, base, layout, date(2023, 12, 31), first_run=True)
    for _ in range(2):
        jobs.monthly_classes(spark, base, layout, date(2024, 1, 31))
    stored = spark.read.schema(jobs.CLASSES).parquet(layout.table("classes"))
    got = {r.vin: r.classification for r in stored.where("dt = '2024-01'").collect()}
    assert len(got) == 10 and got["v0"] == "p-t-2020-winter-0" and got["v7"] == "p-t-2020-none-2"

    # the week of 29 January ends in February, so January's classes count
    jobs.class_limits(spark, layout, date(2024, 2, 7))
    limits = documents(spark, layout, "warningboxplot").collect()
    assert len(limits) == 10 and {r.dt for r in limits} == {"2024-01-29"}


def test_current_histograms(spark, layout):
    frames = spark.createDataFrame(
        [("v", t * 1_000_000, t, "1", 7.0, "p", "t", "1970-01-01") for t in range(5)],
        "vin string, msg_us long, frame_id long, charge_status string, total_current double, province string, vehicle_type string, dt string",
    )
    records = spark.createDataFrame(
        [("v", 0, 3_000_000, "0", "p")], "vin string, start_us long, end_us long, charge_type string, province string"
    )
    jobs.current_histograms(frames, records, layout, date(1970, 1, 2))
    row = documents(spark, layout, "charge_current_frequency").first()
    assert (row.chargeType, row.chargeCurrentFrequency[1], row.time) == ("0", 4, "1970-01-01")


WARNED = (
    "vin string, vehicle_type string, enterprise string, province string, warning_type string, "
    "warning_start_time timestamp, risk_level string, review_status string"
)


def warned(spark, *times):
    return spark.createDataFrame([("v", "T", "e", "p", "w", t, "1", "1") for t in times], WARNED)


def stored_hours(spark, layout):
    rows = jobs.read_stored(spark, layout.table("warnings_hourly"), jobs.HOURLY_WARNINGS).collect()
    return sorted((r.dt, r.total) for r in rows)


def test_an_empty_rerun_empties_its_period(spark, layout):
    at = datetime(2024, 1, 1, 9, 30)
    jobs.hourly_warnings(warned(spark, at, datetime(2024, 1, 1, 8, 1)), layout, datetime(2024, 1, 1, 9, 5))
    jobs.hourly_warnings(warned(spark, at), layout, datetime(2024, 1, 1, 10, 5))
    assert stored_hours(spark, layout) == [("2024-01-01 08", 1), ("2024-01-01 09", 1)]
    jobs.hourly_warnings(warned(spark), layout, datetime(2024, 1, 1, 10, 5))
    assert stored_hours(spark, layout) == [("2024-01-01 08", 1)]
    jobs.daily_warnings(spark, layout, date(2024, 1, 2))
    assert documents(spark, layout, "warninginfo_statistic_perday").first().total == 1
    raw = spark.createDataFrame([('{"vin":"v"}', "2024-01-01")], "data string, dt string")
    jobs.load_day(raw, layout, date(2024, 1, 1))
    jobs.load_day(raw.where("false"), layout, date(2024, 1, 1))
    assert jobs.read_frames(spark, layout.table("frames")).count() == 0


def test_a_day_without_any_stored_table(spark, layout):
    jobs.daily_warnings(spark, layout, date(2024, 1, 2))
    jobs.daily_failures(spark, layout, date(2024, 1, 2))
    for index in ("warninginfo_statistic_perday", "failure_statistics_perday"):
        assert spark.read.text(f"{layout.root}/documents/{index}").count() == 0


def test_period_values_are_plain(spark, tmp_path):
    with pytest.raises(ValueError):
        jobs.write_period(spark.range(1), str(tmp_path), {"dt": "../x"})


def test_late_files_rerun_their_hours_and_days_only(spark, layout, tmp_path):
    t = datetime
    source = str(tmp_path / "warnings")
    ran = []

    def land(name, *times):
        warned(spark, *times).coalesce(1).write.mode("overwrite").parquet(f"{source}/{name}")

    def refresh(hour_job=jobs.hourly_warnings):
        def hour(found, where, as_of):
            ran.append(as_of)
            hour_job(found, where, as_of)

        read = spark.read.schema(WARNED).parquet(f"{source}/*")
        return late.refresh(read, layout, "warnings", "warning_start_time", hour, jobs.daily_warnings)

    def from_scratch():
        return sorted(map(tuple, warnings.hourly_warnings(spark.read.schema(WARNED).parquet(f"{source}/*")).select("dt", "total").collect()))

    land("a", t(2024, 1, 1, 9, 1), t(2024, 1, 1, 10, 1), t(2024, 1, 2, 3, 1))
    land("b", t(2024, 1, 1, 10, 2), None)
    assert refresh() == [t(2024, 1, 1, 9), t(2024, 1, 1, 10), t(2024, 1, 2, 3)]
    assert stored_hours(spark, layout) == from_scratch() == [("2024-01-01 09", 1), ("2024-01-01 10", 2), ("2024-01-02 03", 1)]
    assert refresh() == []
    # a late file: one hour that was there, one that was not
    land("c", t(2024, 1, 1, 9, 59), t(2024, 1, 3, 0, 0))
    assert refresh() == [t(2024, 1, 1, 9), t(2024, 1, 3, 0)]
    assert stored_hours(spark, layout) == from_scratch()
    # a run that breaks off is made up for by the next
    land("d", t(2024, 1, 2, 3, 5))

    def broken(*_):
        raise RuntimeError

    with pytest.raises(RuntimeError):
        refresh(broken)
    assert refresh() == [t(2024, 1, 2, 3)] and stored_hours(spark, layout) == from_scratch()
    # files replaced by ones without rows: their hours become empty, and so does the day
    land("c")
    assert refresh() == [t(2024, 1, 1, 9), t(2024, 1, 3, 0)]
    assert stored_hours(spark, layout) == from_scratch() == [("2024-01-01 09", 1), ("2024-01-01 10", 2), ("2024-01-02 03", 2)]
    daily = documents(spark, layout, "warninginfo_statistic_perday").collect()
    assert sorted((r.dt, r.total) for r in daily) == [("2024-01-01", 3), ("2024-01-02", 2)]
    assert refresh() == [] and len(ran) == 9


def test_raw_messages_to_records_and_histograms(spark, layout):
    """JSON frames of three days: a charge over midnights, one within a day, one left open; each day run twice."""
    def frame(vin, at, status, soc, current):
        doc = {
            "vin": vin, "msgTime": at, "chargeStatus": status, "soc": f"{soc}%", "totalCurrent": current, "maxCellVoltageNum": "3",
            "minCellVoltageNum": "4", "province": "p", "vehicleType": "t", "enterprise": "e",
        }
        return json.dumps(doc), at[:10]

    raw = spark.createDataFrame(
        [
            frame("a", "2024-01-01 22:00:00", "1", 20, 10.0),
            frame("a", "2024-01-01 23:00:00", "1", 30, 10.0),
            frame("b", "2024-01-01 09:00:00", "1", 40, 7.0),
            frame("b", "2024-01-01 10:00:00.250001", "1", 50, 7.0),
            frame("b", "2024-01-01 11:00:00", "0", 50, 0.0),
            frame("a", "2024-01-02 12:00:00", "1", 60, 10.0),
            frame("a", "2024-01-03 01:00:00", "1", 85, 10.0),
            frame("a", "2024-01-03 02:00:00", "0", 85, 0.0),
            frame("c", "2024-01-03 03:00:00", "1", 5, 1.0),
            ("no json", "2024-01-03"),
        ],
        "data string, dt string",
    )
    base = spark.createDataFrame([("a", "A-1"), ("b", "B-1"), ("c", "C-1")], "vin string, license_plate string")
    for day in (1, 2, 3):
        for _ in range(2):
            jobs.load_day(raw, layout, date(2024, 1, day))
            jobs.daily_charges(spark, base, layout, date(2024, 1, day + 1))
            jobs.daily_current_histograms(spark, layout, date(2024, 1, day + 1))
    hour = 3_600_000_000
    start = 1_704_067_200_000_000
    got = {r.vin: r for r in jobs.stored_charges(spark, layout).collect()}
    assert sorted((r.vin, r.dt, r.start_us - start, r.end_us - start, r.license_plate) for r in got.values()) == [
        ("a", "2024-01-03", 22 * hour, 49 * hour, "A-1"),
        ("b", "2024-01-01", 9 * hour, 10 * hour + 250_001, "B-1"),
    ]
    assert got["a"].ampere_hours == pytest.approx(270.0) and got["a"].end_soc == 0.85
    stored = jobs.read_stored(spark, layout.table("open_charges"), jobs.OPEN_CHARGES).collect()
    assert sorted((r.dt, r.vin) for r in stored) == [("2024-01-01", "a"), ("2024-01-02", "a"), ("2024-01-03", "c")]
    counted = documents(spark, layout, "charge_current_frequency").collect()
    # four frames of a in the bucket from 10 to 15 A, two of b in that from 5 to 10 A
    assert sorted((r.time, r.chargeCurrentFrequency[2], r.chargeCurrentFrequency[1]) for r in counted) == [
        ("2024-01-01", 0, 2),
        ("2024-01-03", 4, 0),
    ]
    assert documents(spark, layout, "charge_record").count() == 2


def test_models_over_the_charges_of_a_day(spark, layout):
    """Three charges of one vehicle, the second over midnight; each day is run twice."""
    docs = []

    def charge(day, hour, minute, spread, resistance):
        start = datetime(2024, 1, day, hour, minute)
        for k in range(60):
            docs.append(
                {
                    "vin": "a", "msgTime": f"{start + timedelta(minutes=k):%Y-%m-%d %H:%M:%S}",
                    "chargeStatus": "1" if k < 59 else "0", "soc": f"{70 + k // 3}%", "totalCurrent": "-20",
                    "differenceCellVoltage": str(spread), "resistance": str(1000 if k < 30 else resistance),
                    "maxCellVoltageNum": "3", "minCellVoltageNum": "4", "province": "p", "vehicleType": "t", "enterprise": "e",
                }
            )

    charge(1, 8, 0, 0.02, 1000)
    charge(2, 23, 30, 0.2, 600)
    charge(4, 10, 0, 0.4, 1000)
    raw = spark.createDataFrame([(json.dumps(d), d["msgTime"][:10]) for d in docs], "data string, dt string")
    base = spark.createDataFrame([("a", "A-1")], "vin string, license_plate string")
    for day in (1, 2, 3, 4):
        for _ in range(2):
            jobs.load_day(raw, layout, date(2024, 1, day))
            jobs.daily_charges(spark, base, layout, date(2024, 1, day + 1))
            jobs.daily_spreads(spark, layout, date(2024, 1, day + 1), n=2, slope_over=0.01, range_over=1.0)
            jobs.daily_models(spark, layout, date(2024, 1, day + 1))
    starts = ["2024-01-01 08:00:00", "2024-01-02 23:30:00", "2024-01-04 10:00:00"]
    impedance = documents(spark, layout, "connection_impedance_es").collect()
    # 1, 10 and 20 mV per A: beyond the limit of 8 from the second charge on
    assert sorted((r.chargeStartTime, r.frames, r.isWarning) for r in impedance) == [(s, 59, f) for s, f in zip(starts, "011")]
    reduced = documents(spark, layout, "resistance_reduce").collect()
    assert sorted((r.startTime, r.isWarning) for r in reduced) == [(s, f) for s, f in zip(starts, "010")]
    sampled = documents(spark, layout, "bms_sampling").collect()
    assert sorted((r.startTime, r.frames, round(r.mean_spread, 6)) for r in sampled) == [
        (s, 59, x) for s, x in zip(starts, (20.0, 200.0, 400.0))
    ]
    # from the second charge on there are two to compare
    trends = documents(spark, layout, "charge_vol_day_diff").collect()
    assert sorted((r.dt, [round(x, 6) for x in r.volDiff], r.isWarning) for r in trends) == [
        (starts[1], [0.02, 0.2], "1"),
        (starts[2], [0.2, 0.4], "1"),
    ]
    assert read_stored(spark, layout.table("charge_spreads"), jobs.SPREADS).count() == 3
