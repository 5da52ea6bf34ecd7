import random
import statistics
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from packwatch.functions import flags
from packwatch.functions.scalars import US_PER_DAY
from packwatch.operators import models, signals

ORDER = ["t", "id"]


def signal(spark, **series):
    rows = [(k, i, i, float(v)) for k, values in series.items() for i, v in enumerate(values)]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, "vin string, t long, id long, r double")


def smooth(x, win):
    n = len(x)
    out = []
    for i in range(n):
        h = min(win, i, n - 1 - i)
        out.append(statistics.median(x[i - h : i + h + 1]))
    return out


@pytest.mark.parametrize("win", [1, 4, 20])
def test_median_smoothing(spark, hot, win):
    rng = random.Random(5)
    series = {f"n{n}": [rng.randrange(1000) for _ in range(n)] for n in (1, 2, 4, 40, 41, 100)}
    df = signal(spark, **series)
    for block in (None, 30):
        rows = signals.smoothed_steps(df, ["vin"], ORDER, "r", win, block).collect()
        for name, x in series.items():
            own = sorted((r for r in rows if r.vin == name), key=lambda r: r.t)
            want = smooth(x, win)
            assert [r.smooth for r in own] == want
            assert [r.step for r in own[1:]] == [b - a for a, b in zip(want, want[1:])]
            assert own[0].step is None


@pytest.mark.parametrize("block", [None, 90])
def test_wide_medians(spark, hot, monkeypatch, block):
    """A median kept in order gives what sorting gives, also for ends, ties, infinities and NaN."""
    rng = random.Random(6)
    odd = [float("inf"), float("-inf"), float("nan"), 0.0, 0.0]
    series = {f"n{n}": [rng.choice(odd) if k % 9 == 0 else rng.random() for k in range(n)] for n in (1, 2, 129, 130, 500)}
    df = signal(spark, **series)
    found = signals.smoothed_steps(df, ["vin"], ORDER, "r", signals.WIDE, block).collect()
    monkeypatch.setattr(signals, "WIDE", 1000)
    assert sorted(map(str, found)) == sorted(map(str, signals.smoothed_steps(df, ["vin"], ORDER, "r", 64).collect()))


def test_cost_of_wide_medians():
    """Fifty times the width costs a few times as much."""
    values = np.random.default_rng(7).random(100_000)

    def seconds(win):
        start = time.process_time()
        signals.running_median(values, win)
        return time.process_time() - start

    narrow = min(seconds(20) for _ in range(3))
    assert min(seconds(1000) for _ in range(3)) < 5 * narrow


def test_resistance_drop(spark, hot):
    df = signal(
        spark,
        spike=[1000.0] * 50 + [0.0] + [1000.0] * 50,
        step301=[1000.0] * 50 + [699.0] * 50,
        step300=[1000.0] * 50 + [700.0] * 50,
        short=[1000.0],
    )
    got = {r.vin: r.is_warning for r in models.resistance_drop(df, ["vin"], ORDER, "r").collect()}
    assert got == {"spike": "0", "step301": "1", "step300": "0", "short": "0"}


def test_fluctuation(spark, hot):
    def pair(spark, high, low):
        rows = [("v", i, i, float(a), float(b)) for i, (a, b) in enumerate(zip(high, low))]
        df = spark.createDataFrame(rows, "vin string, t long, id long, h double, l double")
        return models.voltage_fluctuation(df, ["vin"], ORDER, "h", "l", 0.5).first()

    assert pair(spark, [3, 3, 3], [2, 2, 2]).is_warning == "0"
    assert pair(spark, [0, 1, 0], [0, 0.25, 0]).is_warning == "1"
    assert pair(spark, [0, 1, 0], [0, 0.5, 0]).is_warning == "0"  # ratio equal to the limit
    tiny = pair(spark, [0, 0.0078125, 0], [0, 0.001953125, 0])  # mean change 0.0048828125
    assert tiny.is_warning == "0" and tiny.ratio == 0.25


def impedance(spark, currents, spread=200.0):
    rows = [("v", float(i), spread) for i in currents]
    df = spark.createDataFrame(rows, "vin string, i double, s double")
    return models.connection_impedance(df, ["vin"], "s", "i").first().is_warning


def test_impedance(spark):
    assert impedance(spark, [-20.0] * 51) == "1"  # 200 / 20 = 10 >= 8
    assert impedance(spark, [-20.0] * 50) == "0"  # not more than 50 frames
    assert impedance(spark, [-30.0] * 60) == "0"  # 6.7 < 8, slow
    assert impedance(spark, [-50.0] * 60) == "1"  # 4 >= 2, fast
    assert impedance(spark, [-30.0, -50.0] * 30) == "0"  # mean 40, peak 50: slow limit
    assert impedance(spark, [-30.0, -51.0] * 30) == "1"  # peak above 50: fast limit
    assert impedance(spark, [-5.0, 0.0, 10.0] * 30) == "0"  # nothing below -5 A
    assert impedance(spark, [0.0] * 60) == "0"


def test_dispersion(spark):
    def flagged(change):
        rng = random.Random(2)
        rows = []
        for _ in range(30):
            base = [3.5 + rng.gauss(0, 0.01) for _ in range(24)]
            base[3] = change(base[3], rng)
            rows.append(("v", base))
        df = spark.createDataFrame(rows, "vin string, c array<double>")
        return models.cell_dispersion(df, ["vin"], "c").first()

    assert flagged(lambda v, _: v).is_warning == "0"
    assert flagged(lambda v, _: v + 0.2).mean_outliers >= 1
    noisy = flagged(lambda v, rng: v + rng.choice([-0.2, 0.2]))
    assert noisy.std_outliers >= 1 and noisy.is_warning == "1"


def discharge(spark, days, moved=0.0, soc=0.0, drop=0.5, cells=96):
    t1 = int(days * US_PER_DAY)
    flat = [3.5] * cells
    low = [3.5 - drop * days] + [3.5 + (i % 2) * 1e-4 for i in range(cells - 1)]
    rows = [("v", 0, 0, 5.0, 50.0, 0.0, flat), ("v", t1, 1, 5.0 + moved, 50.0 - soc, 0.0, low)]
    df = spark.createDataFrame(
        rows,
        "vin string, t long, id long, odo double, soc_pct double, speed double, c array<double>",
    )
    pairs = models.rest_gaps(df, ["vin"], ORDER, ["c"])
    found = models.self_discharge(pairs.withColumn("b", F.col("before.c")), ["vin"], "b", "c")
    row = found.first()
    return row and row.is_warning


def test_self_discharge(spark, hot):
    assert discharge(spark, 0.49) is None
    assert discharge(spark, 0.5) == "1"
    assert discharge(spark, 0.75) == "1"  # fractions of a day count as such
    assert discharge(spark, 2.0) == "1"
    assert discharge(spark, 2.0, moved=1.0) is None
    assert discharge(spark, 2.0, soc=5.0) == "1"
    assert discharge(spark, 2.0, soc=6.0) is None
    assert discharge(spark, 2.0, drop=0.02) == "0"  # below 30 mV a day
    assert discharge(spark, 2.0, cells=20) == "0"  # 6 sigma is out of reach of 20 cells


def growth(spark, xs, ys):
    df = spark.createDataFrame([("v", float(x), float(y)) for x, y in zip(xs, ys)], "vin string, x double, y double")
    grouped = models.spread_growth(df, ["vin"], "x", "y").first()
    flags.register(spark)
    as_function = (
        df.groupBy("vin")
        .agg(F.collect_list("y").alias("y"), F.collect_list("x").alias("x"))
        .select(F.expr("charge_vol_diff_exp(y, x)"))
        .first()[0]
    )
    assert as_function == grouped.is_warning
    return grouped


def test_spread_growth(spark):
    line = growth(spark, [0, 10, 41], [1, 2, 5.1])
    assert line.is_warning == "1" and line.slope == pytest.approx(0.1)
    assert line.intercept == pytest.approx(1.0) and line.x_axis == pytest.approx(-10.0)
    assert growth(spark, [0, 10, 40], [1, 2, 5]).is_warning == "0"  # range 40
    assert growth(spark, [0, 41], [0, 41 * 0.049]).is_warning == "0"
    assert growth(spark, [0, 41], [0, 41 * 0.051]).is_warning == "1"
    assert growth(spark, [5, 5, 5], [1, 2, 3]).is_warning == "0"  # constant x


def test_sampling_inputs(spark, hot):
    rows = [("v", t, t, t % 96 + 1, (t * 7) % 96 + 1, t / 8) for t in range(25)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "vin string, t long, id long, h int, l int, s double")
    got = sorted(
        models.sampling_inputs(df, ["vin"], ORDER, "h", "l", "s", piece=10).collect(),
        key=lambda r: r.piece,
    )
    assert [len(r.high_cells) for r in got] == [10, 10, 5]
    assert [h for r in got for h in r.high_cells] == [t % 96 + 1 for t in range(25)]
    assert [x for r in got for x in r.low_cells] == [(t * 7) % 96 + 1 for t in range(25)]
    assert sum(r.total for r in got) / sum(r.n for r in got) == 1.5
    assert all(r.is_warning is None for r in got)


def test_array_functions_agree_with_grouped_models(spark):
    flags.register(spark)
    rng = random.Random(11)
    for trial in range(6):
        n = rng.choice([2, 45, 60, 90])
        level = rng.choice([0.0, 400.0])
        r = [1000.0 - (level if i > n // 2 else 0.0) + rng.randrange(20) for i in range(n)]
        cur = [-rng.choice([20.0, 40.0, 60.0]) for _ in range(n)]
        spread = [rng.choice([50.0, 150.0, 300.0]) for _ in range(n)]
        rows = [("v", i, i, *x) for i, x in enumerate(zip(r, cur, spread))]
        df = spark.createDataFrame(rows, "vin string, t long, id long, r double, i double, s double")
        arrays = spark.createDataFrame([(r, cur, spread)], "r array<double>, i array<double>, s array<double>")
        got = arrays.selectExpr(
            "r_reduce(r, 300, 20) AS a",
            "conn_impedance(s, i, s, 8D, 2D) AS b",
            "vol_fluctuation(r, s, 0.5D) AS c",
            "bms_sampling(array(1), array(2), 0.5D) AS d",
        ).first()
        assert got.a == models.resistance_drop(df, ["vin"], ORDER, "r").first().is_warning
        assert got.b == models.connection_impedance(df, ["vin"], "s", "i").first().is_warning
        assert got.c == models.voltage_fluctuation(df, ["vin"], ORDER, "r", "s", 0.5).first().is_warning
        assert got.d is None


def test_array_functions_on_empty_signals(spark):
    flags.register(spark)
    got = spark.sql(
        "SELECT r_reduce(array(), 300, 20), r_reduce(null, 300, 20), r_reduce(array(1D), 300, 20), "
        "vol_fluctuation(array(), array(), 1D), cell_vol_high_dis(array(), 1, 1), "
        "conn_impedance(array(), array(), array(), 8D, 2D)"
    ).first()
    assert tuple(got) == (None, None, "0", None, None, "0")


def test_dispersion_function(spark):
    flags.register(spark)
    rng = random.Random(4)
    frames = [[round(3.5 + rng.gauss(0, 0.01), 6) for _ in range(12)] for _ in range(15)]
    for shift in (0.0, 0.5):
        moved = [[v + (shift if j == 2 else 0.0) for j, v in enumerate(f)] for f in frames]
        texts = spark.createDataFrame([(["[" + ",".join(map(str, f)) + "]" for f in moved],)], "f array<string>")
        got = texts.selectExpr("cell_vol_high_dis(f, 3, 3)").first()[0]
        df = spark.createDataFrame([("v", f) for f in moved], "vin string, c array<double>")
        assert got == models.cell_dispersion(df, ["vin"], "c").first().is_warning
    assert got == "1"


def test_vector_statistics(spark):
    df = spark.createDataFrame([([1.0, 2.0, 4.0],), ([5.0],)], "v array<double>")
    v = F.col("v")
    got = df.select(
        signals.vector_mean(v), signals.vector_std(v), signals.vector_std(v, sample=False)
    ).collect()
    assert got[0] == pytest.approx((7 / 3, statistics.stdev([1, 2, 4]), statistics.pstdev([1, 2, 4])))
    assert tuple(got[1]) == (5.0, None, 0.0)


def test_positions_where(spark):
    df = spark.createDataFrame([([3.0, -7.0, 1.0, -9.0],), ([],)], "v array<double>")
    got = df.select(signals.positions_where(F.col("v"), lambda x: x < -5)).collect()
    assert [r[0] for r in got] == [[2, 4], []]
