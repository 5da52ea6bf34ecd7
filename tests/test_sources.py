import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from packwatch import schemas
from packwatch.plans import charging
from packwatch.sources import readers, writers
from packwatch.sources.fields import DOCUMENTS


def test_clean_frames(spark, tmp_path):
    docs = [
        {"vin": "a", "msgTime": "1704067200500", "speed": "12.5", "odo": 7, "soc": "100%", "totalCurrent": "x"},
        {"vin": "b", "msgTime": "2024-01-01 00:00:00", "soc": "0%", "cellVoltage": "[3.1,3.2]", "resistance": None},
    ]
    folder = tmp_path / "ods" / "dt=2024-01-01"
    folder.mkdir(parents=True)
    (folder / "part.txt").write_text("\n".join([*map(json.dumps, docs), "{broken"]) + "\n")
    raw = readers.read_raw_frames(spark, str(tmp_path / "ods"))
    clean = readers.clean_frames(raw)
    assert clean.columns[:48] == list(schemas.FRAME_FIELDS)
    got = {r.vin: r for r in clean.where("dt = '2024-01-01'").collect()}
    assert (got["a"].speed, got["a"].odo, got["a"].soc, got["a"].totalCurrent) == (12.5, 7.0, 1.0, None)
    assert got["a"].msg_ts == datetime(2024, 1, 1, 0, 0, 0, 500000)
    assert (got["b"].soc, got["b"].cellVoltage, got["b"].resistance) == (0.0, "[3.1,3.2]", None)
    assert got["b"].msg_ts == datetime(2024, 1, 1) and got[None].speed is None
    field = raw.select(readers.raw_field("data", "$.vin").alias("v")).collect()
    assert sorted(str(r.v) for r in field) == ["None", "a", "b"]

    target = str(tmp_path / "dwd")
    writers.append_partition(clean.drop("dt"), target, dt="2024-01-01")
    writers.append_partition(clean.drop("dt").limit(1), target, dt="2024-01-02")
    back = readers.read_frames(spark, target)
    assert back.count() == 4 and back.where("dt = '2024-01-02'").count() == 1


def test_delimited(spark, tmp_path):
    path = tmp_path / "base"
    path.mkdir()
    (path / "f").write_text("v1\t2020-05-01\tplate one\nv2\t\tx\n")
    rows = readers.read_delimited(spark, str(path), "vehicle_base_info").collect()
    assert [tuple(r) for r in rows] == [("v1", "2020-05-01", "plate one"), ("v2", None, "x")]


def test_domain(spark):
    rows = readers.domain(spark, "cellVoltageNum", 1, 96).collect()
    assert len(rows) == 96 and (rows[95].cellVoltageNum, rows[95].frequency) == (96, 0)


def test_documents_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("e", "p", 1, 2, 3, 0, "now")], "enterprise string, province string, highrisk_num long, medrisk_num long, lowrisk_num long, safety_num long, dt string")
    path = str(tmp_path / "docs")
    writers.write_documents(df, path, "province_warning_index")
    stored = spark.read.json(path)
    assert {"highriskNum", "medriskNum", "lowriskNum", "safetyNum"} <= set(stored.columns)
    back = readers.read_documents(spark, path, "province_warning_index", df.schema)
    assert back.collect() == df.collect() and len(DOCUMENTS) == 16


def test_times_of_documents_round_trip(spark, tmp_path):
    """Charge records come back from documents with their microseconds and select the same frames."""
    day = 86_400_000_000
    kinds = "vin string, start_us long, end_us long, charge_type string, province string, vehicle_type string"
    df = spark.createDataFrame(
        [("v", 3 * day + 5, 3 * day + 9_000_001, "0", "p", "t"), ("w", 3 * day, 3 * day + 1_000_000, "1", "p", "t"), ("x", None, 7, "1", "p", "t")],
        kinds,
    )
    path = str(tmp_path / "records")
    writers.write_documents(df, path, "charge_record")
    texts = {r.vin: (r.chargeStartTime, r.chargeEndTime) for r in spark.read.json(path).collect()}
    assert texts["w"] == ("1970-01-04 00:00:00", "1970-01-04 00:00:01")
    assert texts["v"] == ("1970-01-04 00:00:00.000005", "1970-01-04 00:00:09.000001")
    back = readers.read_documents(spark, path, "charge_record", df.schema)
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    # the first frame of v lies on its start, the last one a microsecond after its end
    frames = spark.createDataFrame(
        [("v", 3 * day + t, "1", 7.0, "p", "t", "1970-01-04") for t in (5, 9_000_001, 9_000_002)],
        "vin string, msg_us long, charge_status string, total_current double, province string, vehicle_type string, dt string",
    )
    found = charging.current_histograms(frames, back, as_of=date(1970, 1, 5)).collect()
    assert [(r.vin, r.frequency[1], sum(r.frequency)) for r in found] == [("v", 2, 2)]


def test_dynamic_partitions_are_idempotent(spark, tmp_path):
    path = str(tmp_path / "stats")
    day1 = spark.createDataFrame([("v", 1, "01", "01")], "vin string, total long, month string, day string")
    day2 = spark.createDataFrame([("v", 5, "01", "02")], day1.schema)
    for df in (day1, day2, day2):
        writers.write_partitions(df, path, ["year", "month", "day"], {"year": "2024"})
    back = spark.read.schema("vin string, total long, year string, month string, day string").parquet(path)
    assert sorted((r.total, r.day) for r in back.collect()) == [(1, "01"), (5, "02")]


def test_overwrite_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite_table(spark.range(3), path)
    table = spark.read.parquet(path)
    writers.overwrite_table(table.unionByName(spark.range(3, 5)), path, reads_itself=True)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize(
    "schema, line, want",
    [
        (schemas.CHARGE_MESSAGE, '{"vin":"a","chargeStatus":"1","soc":"80%","msgTime":"5"}', ("a", "1", "80%", "5")),
        (
            schemas.MONITOR_MESSAGE,
            '{"vin":"a","msgTime":5,"speed":1.5,"startupStatus":"1","gearStatus":"2","chargeStatus":"0","soc":"7%"}',
            ("a", 5, 1.5, "1", "2", "0", "7%"),
        ),
        (schemas.CHARGE_NOTIFICATION, '{"endMsgTime":"9","startMsgTime":"3","vin":"a"}', ("9", "3", "a")),
        (schemas.PATTERN_MESSAGE, '{"vin":"a","msgTime":5,"chargeStatus":"1"}', ("a", 5, "1")),
    ],
)
def test_message_streams(spark, tmp_path, schema, line, want):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "one.txt").write_text(line + "\nnot json\n")
    stream = readers.parse_messages(readers.message_stream(spark, "text", path=str(folder)), schema)
    rows = []
    query = (
        writers.on_each_batch(stream, lambda df, n: rows.extend(df.collect()), str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert sorted(map(tuple, rows), key=repr) == sorted([want, (None,) * len(want)], key=repr)


def test_console(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\n")
    stream = readers.message_stream(spark, "text", path=str(tmp_path))
    query = writers.to_console(stream).trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None
