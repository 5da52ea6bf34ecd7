from datetime import date, datetime

from pyspark.sql import functions as F

from packwatch.functions import calendar
from packwatch.functions import scalars as S


def one(spark, sql, **columns):
    df = spark.sql(sql).select(*[c.alias(n) for n, c in columns.items()])
    return [tuple(r) for r in df.collect()]


def test_percent(spark):
    sql = "SELECT explode(array('100%', '0%', '80%', 'x%', '', null)) AS s"
    got = one(spark, sql, r=S.percent_ratio("s"), n=S.percent_number("s"))
    assert got == [(1.0, 100.0), (0.0, 0.0), (0.8, 80.0), (None, None), (None, None), (None, None)]


def test_band_cuts_toward_zero(spark):
    sql = "SELECT explode(array(-4D, 0D, 4.9D, 5D, 154.9D, 155D)) AS c"
    assert [r[0] for r in one(spark, sql, b=S.band("c", 5))] == [0, 0, 0, 1, 30, 31]


def test_half_up(spark):
    sql = "SELECT explode(array(0.25D, -0.25D, 1.15D, 12.349999999999998D, 2.04D)) AS c"
    assert [r[0] for r in one(spark, sql, b=S.half_up("c", 1))] == [0.3, -0.3, 1.2, 12.4, 2.0]


def test_rank_split(spark):
    sql = "SELECT explode(array(3L, 4L, 7L)) AS n"
    got = one(spark, sql, k=S.rank_whole(F.col("n"), 3), f=S.rank_fraction(F.col("n"), 3))
    assert got == [(3, 0.0), (3, 0.75), (6, 0.0)]


def test_season(spark):
    sql = "SELECT explode(sequence(1, 12)) AS m"
    got = [r[0] for r in one(spark, sql, s=S.season(F.col("m")))]
    assert got == ["winter"] * 2 + ["spring"] * 3 + ["summer"] * 3 + ["automn"] * 3 + ["winter"]


def test_vector(spark):
    sql = "SELECT explode(array('[3.1,3.2]', 'no', null)) AS s"
    assert [r[0] for r in one(spark, sql, v=S.numeric_vector("s"))] == [[3.1, 3.2], None, None]


def test_week_and_hour(spark):
    sql = "SELECT timestamp'2024-01-21 23:59:59.5' AS t"
    got = one(spark, sql, w=S.week_start("t"), h=S.hour_text("t"))
    assert got == [(date(2024, 1, 15), "2024-01-21 23")]


def test_run_dates():
    week = (date(2024, 1, 8), date(2024, 1, 15))
    for day in (date(2024, 1, 15), date(2024, 1, 17), date(2024, 1, 21)):
        assert calendar.previous_week(day) == week
    assert calendar.previous_hour(datetime(2024, 1, 1, 0, 30)) == (
        datetime(2023, 12, 31, 23),
        datetime(2024, 1, 1),
    )
    assert calendar.previous_day(datetime(2024, 3, 1, 5)) == (date(2024, 2, 29), date(2024, 3, 1))
    assert calendar.previous_month(date(2024, 3, 31)) == "2024-02"
    assert calendar.month_range(date(2024, 3, 31)) == (date(2024, 2, 29), date(2024, 3, 31))


def test_text_that_is_no_time(spark):
    df = spark.createDataFrame([("2024-03-06 07:08:09",), ("bad",), ("",), (None,)], "t string")
    found = [tuple(r) for r in df.select(S.hour_text("t"), S.week_start("t").cast("string")).collect()]
    assert found == [("2024-03-06 07", "2024-03-04"), (None, None), (None, None), (None, None)]
