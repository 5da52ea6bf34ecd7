import random

import pytest
from pyspark.sql import functions as F

from packwatch.operators.sessions import followed_by, large_charges, last_n, session_rows, sessions, crossing
from packwatch.sources import readers
from packwatch.streaming import detectors, triggers
from streams import charging, file_stream

SCHEMA = "vin string, msg_us long, frame_id long, charge_status string, soc_pct double"


@pytest.fixture(autouse=True)
def few_states(spark):
    """Every state partition starts a Python worker in every batch."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out, ident, clock = [], 0, 10_000_000
    for _ in range(700):
        clock += rng.choice([1, 20, 700_000])
        soc = float(rng.choice([10, 50, 79, 80, 95]))
        out.append((rng.choice("aab"), clock, ident, rng.choice("1110"), soc))
        ident += 1
    return out


def parts(rows, n):
    size = -(-len(rows) // n)
    return [rows[i : i + size] for i in range(0, len(rows), size)]


@pytest.mark.parametrize("n", [1, 3])
def test_sessions_equal_batch(spark, rows, tmp_path, n):
    batch = sessions(session_rows(spark.createDataFrame(rows, SCHEMA), charging()))
    columns = ["vin", "start_us", "end_us", "start_soc", "end_soc"]
    want = sorted(map(tuple, batch.select(*columns).collect()))
    stream = file_stream(spark, tmp_path, parts(rows, n), SCHEMA)
    found = detectors.run_sessions(stream, charging(), str(tmp_path / "out"))
    assert want and sorted(map(tuple, found.select(*columns).collect())) == want
    assert large_charges(found).count() == large_charges(batch).count() > 0


@pytest.mark.parametrize("n", [1, 3])
def test_last_n_equals_batch(spark, rows, tmp_path, n):
    batch = sessions(session_rows(spark.createDataFrame(rows, SCHEMA), charging()))
    want = last_n(crossing(batch), 4).select("vin", "start_us", "recent").collect()
    stream = file_stream(spark, tmp_path, parts(rows, n), SCHEMA)
    got = detectors.run_last_n(stream, charging(), 4, str(tmp_path / "out")).collect()
    assert want and sorted(map(tuple, got)) == sorted(map(tuple, want))


@pytest.mark.parametrize("n", [1, 3])
def test_pattern_equals_batch(spark, rows, tmp_path, n):
    first, then = charging(), F.col("charge_status") == "0"
    want = followed_by(spark.createDataFrame(rows, SCHEMA), first, then)
    want = sorted((r.vin, r.msg_us) for r in want.collect())
    stream = file_stream(spark, tmp_path, parts(rows, n), SCHEMA)
    got = detectors.run_pattern(stream, first, then, folder=str(tmp_path / "out"))
    assert want and sorted((r.vin, r.msg_us) for r in got.collect()) == want


def one_vehicle(frames):
    return [("v", t, i, s, soc) for i, (t, s, soc) in enumerate(frames)]


def test_session_over_batches(spark, tmp_path):
    batches = [
        one_vehicle([(5, "0", 1.0), (10, "1", 20.0)]),
        one_vehicle([(30, "1", 60.0), (20, "1", 10.0)]),
        one_vehicle([(25, "0", 99.0)]),  # late, yet after the start: closes with the end so far
        one_vehicle([(40, "1", 5.0), (40, "0", 5.0)]),  # closing at the start does not close
    ]
    stream = file_stream(spark, tmp_path, batches, SCHEMA)
    found = detectors.run_sessions(stream, charging(), str(tmp_path / "out")).collect()
    assert [tuple(r) for r in found] == [("v", 10, 30, 10.0, 60.0)]


def test_last_ten_drops_the_oldest(spark, tmp_path):
    def charge(i, low=70.0):
        t = i * 100
        return [(t, "1", low), (t + 50, "1", 85.0), (t + 60, "0", 85.0)]

    frames = [f for i in range(1, 13) for f in charge(i)]
    frames += charge(13, low=80.0)  # starts at 80 %, so it does not cross
    batches = [one_vehicle(frames[i : i + 5]) for i in range(0, len(frames), 5)]
    stream = file_stream(spark, tmp_path, batches, SCHEMA)
    found = detectors.run_last_n(stream, charging(), 10, str(tmp_path / "out")).collect()
    got = {r.start_us: [m.start_us for m in r.recent] for r in found}
    assert sorted(got) == [1000, 1100, 1200]  # none at the ninth
    assert got[1200] == [i * 100 for i in range(3, 13)]


def test_pattern_order_and_lateness(spark, tmp_path):
    s = 1_000_000
    batches = [
        one_vehicle([(10 * s, "1", 0.0), (12 * s, "1", 0.0)]),
        one_vehicle([(11 * s + 500_000, "0", 0.0)]),  # within the second: comes in between
        one_vehicle([(10 * s + 1, "0", 0.0), (20 * s, "0", 0.0)]),  # the first one is too late
    ]
    stream = file_stream(spark, tmp_path, batches, SCHEMA)
    got = detectors.run_pattern(
        stream, charging(), F.col("charge_status") == "0", folder=str(tmp_path / "out")
    )
    assert sorted((r.msg_us, r.next_at) for r in got.collect()) == [
        (10 * s, 11 * s + 500_000),
        (12 * s, 20 * s),
    ]


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    out = str(tmp_path / "out")
    stream = file_stream(spark, tmp_path, [one_vehicle([(10, "1", 20.0)])], SCHEMA)
    assert detectors.run_sessions(stream, charging(), out).count() == 0
    file_stream(spark, tmp_path, [one_vehicle([(30, "1", 60.0), (40, "0", 0.0)])], SCHEMA, start=1)
    found = detectors.run_sessions(stream, charging(), out).collect()
    assert [tuple(r) for r in found] == [("v", 10, 30, 20.0, 60.0)]
    assert detectors.run_sessions(stream, charging(), out).count() == 1  # nothing new


def test_driving_sessions(spark, tmp_path):
    """The same detector serves any state column."""
    schema = "vin string, msg_us long, frame_id long, startup_status string, soc_pct double"
    stream = file_stream(spark, tmp_path, [[("v", 1, 1, "1", 50.0), ("v", 9, 2, "2", 40.0)]], schema)
    found = detectors.run_sessions(stream, F.col("startup_status") == "1", str(tmp_path / "out"))
    assert [tuple(r)[:3] for r in found.collect()] == [("v", 1, 1)]


def test_records_for_notifications(spark, tmp_path):
    frames = spark.createDataFrame(
        [("v", t * 1_000_000, t, 0.1 * t, 10.0, 1, 2, "p", "t", "e") for t in range(1, 8)],
        "vin string, msg_us long, frame_id long, soc double, total_current double, max_cell_num int, "
        "min_cell_num int, province string, vehicle_type string, enterprise string",
    )
    base = spark.createDataFrame([("v", "plate")], "vin string, license_plate string")
    lines = [[('{"vin":"v","startMsgTime":"2000","endMsgTime":"4000"}',), ('{"vin":"w","startMsgTime":"1000","endMsgTime":"2000"}',)],
             [('{"vin":"v","startMsgTime":"3000","endMsgTime":"7000"}',)]]
    stream = file_stream(spark, tmp_path, lines, "value string")
    notes = readers.parse_messages(stream, detectors.struct(vin=detectors.TEXT, startMsgTime=detectors.TEXT, endMsgTime=detectors.TEXT))
    path = str(tmp_path / "docs")
    query = triggers.record_charges(notes, frames, base, path, str(tmp_path / "cp"))
    query.trigger(availableNow=True).start().awaitTermination()
    got = spark.read.json(path).select("chargeStartTime", "chargeEndTime", "licensePlate", "chargeElectricity").collect()
    start = "1970-01-01 00:00:0"
    assert sorted(map(tuple, got)) == [
        (f"{start}2", f"{start}4", "plate", 20 / 3600),
        (f"{start}3", f"{start}7", "plate", 40 / 3600),
    ]


def test_restart_of_the_pattern_with_nothing_new(spark, tmp_path):
    """Rows still waiting come from the state store, whichever run put them there."""
    out, first, then = str(tmp_path / "out"), charging(), F.col("charge_status") == "0"
    stream = file_stream(spark, tmp_path, [one_vehicle([(10, "1", 20.0), (40, "0", 0.0)])], SCHEMA)
    want = [("v", 10, 40)]
    for _ in range(2):
        found = detectors.run_pattern(stream, first, then, folder=out).collect()
        assert [tuple(r) for r in found] == want


def test_no_message_at_all(spark, tmp_path):
    stream = file_stream(spark, tmp_path, [[]], SCHEMA)
    assert detectors.run_sessions(stream, charging(), str(tmp_path / "a")).count() == 0
    assert detectors.run_pattern(stream, charging(), charging(), folder=str(tmp_path / "b")).count() == 0


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    s = 1_000_000
    batches = [
        one_vehicle([(10 * s, "1", 0.0), (20 * s, "0", 0.0)]),
        one_vehicle([(19 * s + 5_000, "1", 0.0), (18 * s, "0", 0.0), (17 * s, "0", 0.0)]),  # one within the second
        one_vehicle([(30 * s, "1", 0.0)]),
    ]
    stream = file_stream(spark, tmp_path, batches, SCHEMA)
    query = detectors.start_pattern(stream, charging(), F.col("charge_status") == "0", str(tmp_path / "out"))
    query.awaitTermination()
    assert detectors.late_rows(query) == 2
    found = detectors.found_rows(spark, str(tmp_path / "out"), detectors.MATCH)
    assert [tuple(r) for r in found.collect()] == [("v", 19 * s + 5_000, 20 * s)]


def test_rows_delivered_twice_count_once(spark, tmp_path):
    s = 1_000_000
    batches = [[("v", 10 * s, 1, "1", 0.0), ("v", 10 * s + 1, 2, "0", 0.0)], [("v", 10 * s, 1, "1", 0.0)], [("v", 30 * s, 3, "1", 0.0)]]
    stream = file_stream(spark, tmp_path, batches, SCHEMA)
    out = str(tmp_path / "out")
    once = ("vin", "msg_us", "frame_id")
    detectors.start_pattern(stream, charging(), charging(), out, 5 * s, once_by=once).awaitTermination()
    assert detectors.found_rows(spark, out, detectors.MATCH).count() == 0
    again = str(tmp_path / "again")
    detectors.start_pattern(stream, charging(), charging(), again, 5 * s).awaitTermination()
    assert detectors.found_rows(spark, again, detectors.MATCH).count() == 1  # the same row, next to itself


def test_a_timer_closes_silent_sessions(spark, tmp_path):
    s = 1_000_000
    batches = [
        [("a", 10 * s, 1, "1", 20.0), ("a", 12 * s, 2, "1", 30.0), ("b", 11 * s, 3, "1", 50.0)],
        [("b", 60 * s, 4, "1", 60.0)],
        [("b", 200 * s, 5, "1", 70.0)],
        [("c", 230 * s, 6, "1", 1.0)],
    ]
    stream = file_stream(spark, tmp_path, batches, SCHEMA)
    out = str(tmp_path / "out")
    found = sorted(map(tuple, detectors.run_sessions(stream, charging(), out, silence_us=100 * s).collect()))
    # a falls silent for good; b sends again within the silence, and then too late
    assert found[0] == ("a", 10 * s, 12 * s, 20.0, 30.0)
    assert [f[0] for f in found[1:]] in ([], ["b"])


def test_state_touched_is_that_of_the_batch(spark, tmp_path):
    many = [(f"v{i}", 10, i, "1", 1.0) for i in range(50)]
    stream = file_stream(spark, tmp_path, [many, [("v7", 20, 99, "0", 1.0)]], SCHEMA)
    query = detectors.start_sessions(stream, charging(), str(tmp_path / "out"))
    query.awaitTermination()
    touched = [(o.numRowsUpdated, o.numRowsRemoved) for p in query.recentProgress for o in p.stateOperators if p.numInputRows]
    assert touched == [(50, 0), (0, 1)] or [sum(t) for t in touched] == [50, 1]


MESSAGES = [
    '{"vin":"v","msgTime":"1970-01-01 00:00:10.000001","chargeStatus":"1","soc":"57%"}',
    "no message",
    '{"vin":"v","msgTime":"20000","chargeStatus":"1","soc":"81%"}',
    '{"msgTime":"30000"}',
    '{"vin":"v","msgTime":"never","chargeStatus":"0"}',
    '{"vin":"v","msgTime":"30000","chargeStatus":"0"}',
]
WANT = [("v", 10_000_001, 20_000_000, 57.0, 81.0)]


@pytest.mark.parametrize("format", ["text", "parquet"])
def test_messages_enter_every_detector(spark, tmp_path, format):
    """Raw JSON in batches of one file: sessions, last n and pattern, broken messages beside them, none lost or doubled."""
    def arrived():
        return readers.frame_messages(readers.message_stream(spark, format, path=f"{tmp_path}/in/*", maxFilesPerTrigger="1"))

    def land(i):
        spark.createDataFrame([(MESSAGES[i],)], "value string").coalesce(1).write.format(format).save(f"{tmp_path}/in/{i}")

    charge, end = F.col("chargeStatus") == "1", F.col("chargeStatus") == "0"
    for stop in (4, 6, 6):
        for i in range(0 if stop == 4 else 4, stop):
            if not (tmp_path / "in" / str(i)).exists():
                land(i)
        found = detectors.run_sessions(arrived(), charge, str(tmp_path / "s")).collect()
        recent = detectors.run_last_n(arrived(), charge, 1, str(tmp_path / "n")).collect()
        pairs = detectors.run_pattern(arrived(), charge, end, folder=str(tmp_path / "p")).collect()
    assert [tuple(r) for r in found] == WANT
    assert [(r.start_us, [tuple(m) for m in r.recent]) for r in recent] == [(10_000_001, [(10_000_001, 20_000_000)])]
    assert [tuple(r) for r in pairs] == [("v", 20_000_000, 30_000_000)]
    for place in "snp":
        letters = detectors.dead_letters(spark, str(tmp_path / place))
        assert sorted(r.value for r in letters.collect()) == sorted([MESSAGES[1], MESSAGES[3], MESSAGES[4]])


def test_sessions_start_two_models_once(spark, tmp_path):
    """Frames to sessions to two indexes; one sink fails at first, and the finished one is not run again."""
    s = 1_000_000
    fields = "charge_status string, soc double, total_current double, cell_spread double, max_cell_num int, min_cell_num int"
    rows = [(v, t * s, t, st, 0.1 * t, -10.0, 0.05, 1, 2, "p", "t", "e") for v in "ab" for t, st in ((1, "1"), (2, "1"), (3, "0"))]
    frames = spark.createDataFrame(rows, f"vin string, msg_us long, frame_id long, {fields}, province string, vehicle_type string, enterprise string")
    base = spark.createDataFrame([("a", "A-1"), ("b", "B-1")], "vin string, license_plate string")
    detector = str(tmp_path / "detector")
    stream = file_stream(spark, tmp_path, [[(r[0], r[1], r[2], r[3], 50.0) for r in rows]], SCHEMA)
    detectors.run_sessions(stream, charging(), detector)

    runs, path = [], str(tmp_path / "models")
    records, impedance = triggers.record_model(frames, base), triggers.impedance_model(frames)

    def counted(batch):
        runs.append("records")
        return records(batch)

    def fails_once(batch):
        runs.append("impedance")
        if runs.count("impedance") == 1:
            raise RuntimeError("lost")
        return impedance(batch)

    outputs = {"records": (counted, "charge_record"), "impedance": (fails_once, "connection_impedance_es")}
    for attempt in range(3):
        found = triggers.closed_sessions(spark, detector)
        query = triggers.fan_out(found, outputs, path, str(tmp_path / "cp")).trigger(availableNow=True).start()
        if attempt == 0:
            with pytest.raises(Exception, match="lost"):
                query.awaitTermination()
        else:
            query.awaitTermination()
    assert runs == ["records", "impedance", "impedance"]
    got = spark.read.json(f"{path}/records/query=*").select("vin", "chargeStartTime", "licensePlate").collect()
    assert sorted(map(tuple, got)) == [(v, "1970-01-01 00:00:01", f"{v.upper()}-1") for v in "ab"]
    flags = spark.read.json(f"{path}/impedance/query=*").select("vin", "chargeStartTime", "isWarning").collect()
    assert sorted(map(tuple, flags)) == [(v, "1970-01-01 00:00:01", "0") for v in "ab"]
