import random

import pytest

from packwatch.operators import boxplot
from packwatch.operators.boxplot import quartiles, with_fences
from packwatch.plans.weekly import exception_documents, pack_exceptions


def tukey(values):
    """Quartiles by hand: position q (n + 1) / 4 of the sorted values, None first."""
    s = sorted(values, key=lambda v: (v is not None, v if v is not None else 0.0))
    n, out = len(s), []
    if n < 3:
        return None
    for q in (1, 2, 3):
        k, f = divmod((n + 1) * q, 4)
        low, high = s[k - 1], s[k] if k < n else 0.0
        out.append(None if low is None or high is None else low * (1 - f / 4) + high * (f / 4))
    return tuple(out)


def check(spark, groups):
    rows = [(g, v) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.q1, r.q2, r.q3) for r in quartiles(df, ["g"], ["v"]).collect()}
    want = {g: tukey(v) for g, v in groups.items() if len(v) >= 3}
    assert got == want  # the same arithmetic, so equal to the last bit


def test_sizes_ties_and_nulls(spark, hot):
    check(
        spark,
        {
            "one": [5.0],
            "two": [1.0, 2.0],
            "three": [3.0, 1.0, 2.0],
            "four": [4.0, 1.0, 3.0, 2.0],
            "seven": [7.0, 7.0, 1.0, 7.0, 2.0, 7.0, 3.0],
            "flat": [2.5] * 12,
            "null": [None, None, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, None],
        },
    )


def test_known_quartiles(spark):
    df = spark.createDataFrame([("a", float(i)) for i in (1, 2, 3, 4)], "g string, v double")
    row = quartiles(df, ["g"], ["v"]).first()
    assert (row.q1, row.q2, row.q3) == (1.25, 2.5, 3.75)
    fences = with_fences(quartiles(df, ["g"], ["v"])).first()
    assert (fences.max_value, fences.min_value) == (3.75 + 1.875, 3.75 - 1.875)
    usual = with_fences(quartiles(df, ["g"], ["v"]), rule="iqr").first()
    assert (usual.max_value, usual.min_value) == (7.5, -2.5)


def test_values_beyond_all_bounds(spark):
    """Infinities and NaN stay out of the bins of finite values, wide ranges end."""
    inf, nan = float("inf"), float("nan")
    groups = {
        "mixed": [float(i % 97) for i in range(400)] + [inf, -inf, nan, None],
        "wide": [-1.7e308] * 30 + [0.5] * 30 + [1.7e308] * 30,
        "infinite": [inf] * 40 + [1.0, 2.0],
        "powers": [(-1.0) ** i * 10.0 ** (i % 600 - 300) for i in range(1800)],
        "nothing": [nan] * 25 + [None] * 25,
        "null": [None] * 30,
    }
    rows = [(g, v) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g string, v double")
    plain = sorted(map(str, quartiles(df, ["g"], ["v"]).collect()))
    spark.conf.set("spark.packwatch.hotRows", "20")
    try:
        assert sorted(map(str, quartiles(df, ["g"], ["v"]).collect())) == plain
    finally:
        spark.conf.unset("spark.packwatch.hotRows")


def test_skewed_values(spark, hot):
    rng = random.Random(1)
    check(
        spark,
        {
            "tail": [rng.paretovariate(0.3) for _ in range(400)],
            "heavy": [0.0] * 300 + [rng.random() for _ in range(100)],
            "tiny": [1.0 + rng.randrange(50) * 2.0**-50 for _ in range(200)],
        },
    )


def test_rounds_do_not_depend_on_the_spread(spark, monkeypatch):
    """Values over 600 powers of ten narrow as fast as evenly spread ones."""
    rounds = []

    def counting(df, purpose, settle=boxplot.settle):
        rounds.append(purpose)
        return settle(df, purpose)

    monkeypatch.setattr(boxplot, "settle", counting)
    rng = random.Random(2)
    n, limit = 40_000, 1_000
    spark.conf.set("spark.packwatch.hotRows", str(limit))
    found = []
    try:
        for values in ([rng.random() for _ in range(n)], [10.0 ** rng.uniform(-300, 300) for _ in range(n)]):
            rounds.clear()
            check(spark, {"one": values})
            found.append(rounds.count("pivots"))
    finally:
        spark.conf.unset("spark.packwatch.hotRows")
    assert found == [1, 1]


METRICS = ["a", "b"]
SIDES = {"a": "above", "b": "below"}
FIELDS = {"a": "a_exception", "b": "b_exception"}


@pytest.fixture()
def units(spark):
    """x: outliers in both metrics, y: in one of two, z: in none."""
    rows = []
    for g, odd in (("x", (1000.0, -1000.0)), ("y", (1000.0, 10.0)), ("z", (10.0, 10.0))):
        rows += [(g, f"{g}{i:02d}", 10.0 + i % 3, 10.0 + i % 3) for i in range(20)]
        rows.append((g, f"{g}odd", *odd))
    return spark.createDataFrame(rows, "g string, vin string, a double, b double")


def test_outlier_report(units, hot):
    report, listed = pack_exceptions(units, ["g"], "vin", SIDES)
    assert [r.g for r in report.collect()] == ["x"]
    # lower fence q3 - 1.5 q1 is negative here, so only the extreme value is below it
    assert sorted((r.g, r.metric, r.vin, r.outlier) for r in listed.collect()) == [
        ("x", "a", "xodd", 1000.0),
        ("x", "b", "xodd", -1000.0),
    ]
    full, _ = pack_exceptions(units, ["g"], "vin", SIDES, how="full")
    assert sorted(r.g for r in full.collect()) == ["x", "y"]


def test_nested_documents(units):
    report, listed = pack_exceptions(units, ["g"], "vin", SIDES)
    doc = exception_documents(report, listed, ["g"], "vin", FIELDS).collect()
    assert len(doc) == 1 and doc[0].page == 0
    assert doc[0].a_exception.asDict(recursive=True) == {
        "Q3": 12.0,
        "Q2": 11.0,
        "Q1": 10.0,
        "maxvalue": 27.0,
        "minvalue": -3.0,
        "vehicles": [{"vin": "xodd", "outliers": 1000.0}],
    }


def test_documents_of_large_groups_are_paged(spark):
    rows = [("x", f"v{i}", 1.0 if i % 4 else 100.0 + i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, vin string, a double")
    report, listed = pack_exceptions(df, ["g"], "vin", {"a": "above"})
    n = listed.count()
    pages = exception_documents(report, listed, ["g"], "vin", {"a": "a_exception"}, page_size=10)
    found = [v.vin for d in pages.collect() for v in d.a_exception.vehicles]
    assert n > 0 and len(found) == len(set(found)) == n
