"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

US_PER_SECOND = 1_000_000
US_PER_HOUR = 3_600 * US_PER_SECOND
US_PER_DAY = 24 * US_PER_HOUR


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def percent_number(c: Column | str) -> Column:
    """``"80%"`` -> 80.0; NULL where the text is not a number."""
    c = _col(c)
    return c.substr(F.lit(1), F.length(c) - 1).try_cast("double")


def percent_ratio(c: Column | str) -> Column:
    """``"80%"`` -> 0.8."""
    return percent_number(c) / 100


def half_up(c: Column | str, digits: int) -> Column:
    """Round half away from zero on the value cleaned to 8 decimals.

    Cleaning first removes the last-bit noise of float sums, so that the result does
    not depend on the order in which partitions were added up.
    """
    return F.round(_col(c).cast("decimal(28,8)"), digits).cast("double")


def band(c: Column | str, width: float) -> Column:
    """Number of the band of the given width, cut toward zero."""
    return (_col(c) / F.lit(width)).try_cast("int")


def rank_whole(n: Column, quarter: int) -> Column:
    """Whole part of the quartile position ``quarter * (n + 1) / 4``."""
    return F.floor((n + 1) * quarter / 4).cast("long")


def rank_fraction(n: Column, quarter: int) -> Column:
    """Fractional part of the quartile position."""
    return ((n + 1) * quarter / 4) % 1


def micros(ts: Column | str) -> Column:
    """Epoch microseconds of a timestamp, with or without time zone."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def week_start(ts: Column | str) -> Column:
    """Monday of the week, as a date; NULL where a text is no time."""
    return F.date_trunc("week", _col(ts).try_cast("timestamp")).cast("date")


def hour_text(ts: Column | str) -> Column:
    """Hour of a timestamp or of its text; NULL where the text is no time."""
    return F.date_format(_col(ts).try_cast("timestamp"), "yyyy-MM-dd HH")


def season(month: Column) -> Column:
    # fixed values: the season names are data, spelling included
    return (
        F.when(month.between(3, 5), "spring")
        .when(month.between(6, 8), "summer")
        .when(month.between(9, 11), "automn")
        .otherwise("winter")
    )


def numeric_vector(text: Column | str) -> Column:
    """``"[3.1,3.2]"`` -> array<double>; NULL where the text is not such a list."""
    return F.from_json(_col(text), "array<double>")
