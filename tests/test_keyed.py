"""Ordered operators against plain Python, with ordinary and with hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from packwatch.operators import keyed
from packwatch.operators.sessions import followed_by, last_n, session_rows, sessions, sorted_times


@pytest.fixture(scope="module")
def frames(spark):
    rng = random.Random(7)
    rows, ident = [], 0
    for vin, n in (("a", 120), ("b", 1), ("c", 17), ("d", 40)):
        clock = 1_000
        for _ in range(n):
            clock += rng.choice([0, 1, 5, 400])
            rows.append((vin, clock, ident, rng.choice("110x"), float(rng.randrange(101))))
            ident += 1
    rng.shuffle(rows)
    return rows, spark.createDataFrame(
        rows, "vin string, msg_us long, frame_id long, charge_status string, soc_pct double"
    )


def machine(rows):
    """Sessions by walking through the frames of each vehicle, off before on at equal times."""
    out, state = [], {}
    for vin, t, _, status, soc in sorted(rows, key=lambda r: (r[0], r[1], r[3] == "1", r[2])):
        s = state.get(vin)
        if status == "1":
            if s is None:
                state[vin] = [t, t, soc, soc]
            else:
                s[0], s[1] = min(s[0], t), max(s[1], t)
                s[2], s[3] = min(s[2], soc), max(s[3], soc)
        elif s is not None and s[0] < t:
            out.append((vin, *s))
            state[vin] = None
    return sorted(out)


def charging():
    return F.col("charge_status") == "1"


COLUMNS = ["vin", "start_us", "end_us", "start_soc", "end_soc"]


def test_sessions(frames, hot):
    rows, df = frames
    found = sessions(session_rows(df, charging())).select(*COLUMNS).collect()
    assert sorted(map(tuple, found)) == machine(rows)


def test_scan_steps(frames, hot):
    rows, df = frames
    order = ["msg_us", "frame_id"]
    on_time = F.when(charging(), F.col("msg_us"))
    got = keyed.scan(
        keyed.slices(df, ["vin"], "msg_us"),
        ["vin"],
        order,
        before=("lag", F.col("soc_pct")),
        after=("lead", F.col("soc_pct")),
        total=("sum", F.col("soc_pct")),
        latest=("last", on_time),
        highest=("max", F.col("soc_pct")),
    )
    names = ["frame_id", "before", "after", "total", "latest", "highest"]
    got = sorted(tuple(r) for r in got.select(*names).collect())
    want = []
    for vin in "abcd":
        own = sorted((r for r in rows if r[0] == vin), key=lambda r: (r[1], r[2]))
        for i, r in enumerate(own):
            past = [x[1] for x in own[: i + 1] if x[3] == "1"]
            want.append(
                (
                    r[2],
                    own[i - 1][4] if i else None,
                    own[i + 1][4] if i + 1 < len(own) else None,
                    sum(x[4] for x in own[: i + 1]),
                    past[-1] if past else None,
                    max((x[4] for x in own[:i]), default=None),
                )
            )
    assert got == sorted(want)


def test_last_n(frames, hot):
    rows, df = frames
    found = sessions(session_rows(df, charging()))
    got = {
        (r.vin, r.start_us): list(r.t)
        for r in last_n(found, 4).select("vin", "start_us", sorted_times("recent").alias("t")).collect()
    }
    want, all_found = {}, machine(rows)
    for vin in "abcd":
        own = [s for s in all_found if s[0] == vin]
        for i in range(3, len(own)):
            times = sorted(t for s in own[i - 3 : i + 1] for t in s[1:3])
            want[(vin, own[i][1])] = times
    assert want and got == want


def test_pattern(frames, hot):
    rows, df = frames
    got = followed_by(df, charging(), F.col("charge_status") == "0")
    got = sorted((r.vin, r.frame_id) for r in got.collect())
    want = []
    for vin in "abcd":
        own = sorted((r for r in rows if r[0] == vin), key=lambda r: (r[1], r[2]))
        want += [(vin, a[2]) for a, b in zip(own, own[1:]) if a[3] == "1" and b[3] == "0"]
    assert want and got == sorted(want)


def test_windows_with_and_without_overlap(spark, frames, hot):
    rows, df = frames
    windows = [
        ("a", 1_000, 1_400, "w1"),
        ("a", 1_401, 1_900, "w2"),
        ("a", 1_900, 2_500, "w3"),  # touches w2
        ("a", 3_000, 9_000, "w4"),  # holds w5 and w6
        ("a", 3_100, 3_200, "w5"),
        ("a", 4_000, 4_700, "w6"),
        ("a", 12_000, 12_400, "w7"),
        ("c", 0, 99_999, "w8"),
        ("e", 0, 99_999, "w9"),
        ("b", 0, 2**63 - 1, "x1"),  # all time, twice, and an instant in it
        ("b", 0, 2**63 - 1, "x2"),
        ("b", 2_000, 2_000, "x3"),
        ("b", 5_000, 4_000, "x4"),  # ends before it starts
    ]
    table = spark.createDataFrame(windows, "vin string, start_us long, end_us long, name string")
    got = keyed.in_windows(df, table, ["vin"], "msg_us", "start_us", "end_us")
    got = sorted((r.frame_id, r.name) for r in got.collect())
    want = sorted(
        (r[2], w[3]) for r in rows for w in windows if r[0] == w[0] and w[1] <= r[1] <= w[2]
    )
    assert want and got == want


def test_long_windows_make_few_rows(spark):
    """Windows of ten years and from the year 1970 on, in days that would be thousands of bins."""
    year = 365 * 86_400_000_000
    windows = [("v", 0, 54 * year, "a"), ("v", 44 * year, 54 * year, "b"), ("v", 50 * year, 51 * year, "c"), ("w", None, 5, "d")]
    table = spark.createDataFrame(windows, "vin string, start_us long, end_us long, name string")
    stretches, opened = keyed._stretches(table.where("name <> 'd'"), ["vin"], "start_us", "end_us")
    assert stretches.count() == 4 and opened.count() == 4 + 3 + 1
    rows = spark.createDataFrame([("v", t * year, t) for t in (0, 43, 44, 50, 52, 54, 55)] + [("w", 1, 1)], "vin string, msg_us long, frame_id long")
    got = keyed.in_windows(rows, table, ["vin"], "msg_us", "start_us", "end_us").collect()
    assert sorted((r.frame_id, r.name) for r in got) == [
        (0, "a"), (43, "a"), (44, "a"), (44, "b"), (50, "a"), (50, "b"), (50, "c"), (52, "a"), (52, "b"), (54, "a"), (54, "b"),
    ]


def test_keys_without_value_are_left_out(spark, hot):
    df = spark.createDataFrame(
        [(None, 1, 1, "1", 1.0)] * 5 + [("a", 1, 2, "1", 1.0), ("a", 2, 3, "0", 1.0)],
        "vin string, msg_us long, frame_id long, charge_status string, soc_pct double",
    )
    found = sessions(session_rows(df, charging())).collect()
    assert [(r.vin, r.start_us, r.end_us) for r in found] == [("a", 1, 1)]


def case(spark, statuses, times=None):
    times = times or range(1, len(statuses) + 1)
    rows = [("v", t, i, s, 10.0 * i) for i, (t, s) in enumerate(zip(times, statuses))]
    df = spark.createDataFrame(
        rows, "vin string, msg_us long, frame_id long, charge_status string, soc_pct double"
    )
    found = sessions(session_rows(df, charging())).select(*COLUMNS).collect()
    return sorted(tuple(r)[1:] for r in found)


def test_session_edges(spark):
    assert case(spark, "0110") == [(2, 3, 10.0, 20.0)]  # first message not charging
    assert case(spark, "11") == []  # still open
    assert case(spark, "120") == [(1, 1, 0.0, 0.0)]  # any other status closes
    assert case(spark, "10", [5, 5]) == []  # closing message at the start itself
    assert case(spark, "1100", [5, 9, 5, 12]) == [(5, 9, 0.0, 10.0)]
    assert case(spark, "1010", [1, 2, 2, 3]) == [(1, 1, 0.0, 0.0), (2, 2, 20.0, 20.0)]


def test_no_extra_work_without_hot_keys(frames):
    _, df = frames
    assert not keyed.is_sliced(keyed.slices(df, ["vin"], "msg_us"))


def awkward(spark):
    """One vehicle with rows without a time, one at time 0, and many rows of one instant."""
    times = [None, None, 0, *[1_700_000_000_000_000] * 1000, *range(1_700_000_000_000_001, 1_700_000_000_001_000)]
    rows = [("a", t, i, i % 7 == 3) for i, t in enumerate(times)]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, "vin string, msg_us long, frame_id long, flag boolean")


def test_slices_stay_even(spark):
    spark.conf.set(keyed.HOT_ROWS_SETTING, "100")
    try:
        cut = keyed.slices(awkward(spark), ["vin"], "msg_us", ["frame_id"])
        sizes = [r["count"] for r in cut.groupBy("_slice").count().collect()]
    finally:
        spark.conf.unset(keyed.HOT_ROWS_SETTING)
    assert sum(sizes) == 2002 and max(sizes) <= 300


def test_same_results_with_awkward_times(spark):
    order = ["msg_us", "frame_id"]

    def results():
        df = awkward(spark)
        cut = keyed.slices(df, ["vin"], "msg_us", ["frame_id"])
        steps = keyed.scan(
            cut, ["vin"], order, n=("sum", F.lit(1)), before=("lag", F.col("frame_id")), after=("lead", F.col("frame_id"))
        )
        pairs = followed_by(df, F.col("flag"), ~F.col("flag"))
        runs = session_rows(df, F.col("flag")).select("frame_id", "run_start", "opening", "closing")
        return [
            sorted(map(str, found.collect()))
            for found in (steps.select("frame_id", "n", "before", "after"), pairs.select("frame_id", "next_at"), runs)
        ]

    plain = results()
    spark.conf.set(keyed.HOT_ROWS_SETTING, "50")
    try:
        assert results() == plain
    finally:
        spark.conf.unset(keyed.HOT_ROWS_SETTING)
