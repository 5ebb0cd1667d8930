"""Column expressions whose results are defined to the last digit.

All stay in whole-stage code; none is a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a CSV cell says where it has no value.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def scaled_round(x: Column, digits: int) -> Column:
    """Half away from zero, on the scaled value: not the decimal rendering's rounding."""
    scale = F.lit(10.0**digits)
    return F.round(x.cast("double") * scale, 0) / scale


def snapped_round(x: Column, digits: int, snap: int = 6) -> Column:
    """scaled_round() of an interpolated value or a mean, first snapped to ``snap`` digits so that its last bit can't turn a tie."""
    return scaled_round(scaled_round(x, snap), digits)


def even_round(x: Column, digits: int = 0) -> Column:
    """Half to even, on the scaled value."""
    return F.rint(x.cast("double") * F.lit(10.0**digits)) / F.lit(10.0**digits)


def erfc(x: Column) -> Column:
    """The complementary error function, to 1e-12 of itself: the series of erf up to 2.5, the continued fraction beyond."""
    x = x.cast("double")
    a = F.abs(x)
    term = lambda s, k: s["term"] * 2.0 * s["x"] * s["x"] / (2.0 * k + 1.0)
    start = F.struct(a.alias("x"), a.alias("term"), a.alias("sum"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(60)), start, lambda s, k: F.struct(s["x"].alias("x"), term(s, k).alias("term"), (s["sum"] + term(s, k)).alias("sum")), lambda s: s["sum"])
    fraction = F.aggregate(F.sequence(F.lit(80), F.lit(1), F.lit(-1)), F.struct(a.alias("x"), a.alias("f")), lambda s, k: F.struct(s["x"].alias("x"), (s["x"] + k / 2.0 / s["f"]).alias("f")), lambda s: s["f"])
    right = F.when(a <= 2.5, 1.0 - 2.0 / F.sqrt(F.pi()) * F.exp(-a * a) * series).otherwise(F.exp(-a * a) / F.sqrt(F.pi()) / fraction)
    return F.when(x < 0, 2.0 - right).otherwise(right)


def true(x: Column) -> Column:
    """A condition in which unknown is false."""
    return F.coalesce(x, F.lit(False))


def is_in(x: Column, values) -> Column:
    return true(x.isin(*values)) if len(values) else F.lit(False)


def outside(x: Column, low: float, high: float) -> Column:
    """Whether a value is known and outside a closed range."""
    return true(~x.between(low, high))


def na_to_null(x: Column) -> Column:
    return F.when(~x.isin(*NA_TOKENS), x)


def number(x: Column) -> Column:
    """A number, or null where the text is none; never NaN."""
    n = x.try_cast("double")
    return F.when(~F.isnan(n), n)


def wall_clock(text: Column, offset: str) -> Column:
    """ISO 8601 text as local time: a final Z means UTC, anything else is local already."""
    utc = text.endswith("Z")
    shifted = F.convert_timezone(F.lit("UTC"), F.lit(offset), F.rtrim(text, F.lit("Z")).try_cast("timestamp_ntz"))
    return F.when(utc, shifted).otherwise(text.try_cast("timestamp_ntz"))


def floor_minute(ts: Column) -> Column:
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def clock_hour(ts: Column, seconds: bool = False) -> Column:
    """The hour of the day with its fraction, in doubles."""
    hour = F.hour(ts).cast("double") + F.minute(ts).cast("double") / F.lit(60.0)
    return hour + F.second(ts).cast("double") / F.lit(3600.0) if seconds else hour


def signed_hour(hour: Column) -> Column:
    """Hours from midnight, in [-12, 12)."""
    return F.pmod(hour + F.lit(12.0), F.lit(24.0)) - F.lit(12.0)


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes with their fraction, from microseconds."""
    us = lambda x: F.unix_micros(x.cast("timestamp")).cast("double")
    return (us(end) - us(start)) / F.lit(60e6)


def midpoint(start: Column, end: Column) -> Column:
    return start + (end - start) / 2


def study_week(day: Column, start) -> Column:
    """The rounded week of the study, as it is published: 1 + days / 7, half to even."""
    return F.rint(F.lit(1.0) + F.datediff(day, F.lit(start)).cast("double") / F.lit(7.0)).cast("int")


def calendar_week(day: Column, start) -> Column:
    """Whole weeks of seven days, from 1."""
    return (F.floor(F.datediff(day, F.lit(start)) / F.lit(7.0)) + 1).cast("int")


def joined_in_order(order: str, value: str, separator: str = "->") -> Column:
    """An aggregate: the group's values in order, joined. For groups of known small size."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]), separator)


def preview(values: Column, most: int = 12) -> Column:
    """An array's first values in order, and how many more there are."""
    ordered = F.array_sort(F.array_distinct(values))
    more = F.size(ordered) - most
    return F.concat(F.array_join(F.slice(ordered, 1, most), ", "), F.when(more > 0, F.concat(F.lit(" +"), more.cast("string"), F.lit(" more"))).otherwise(""))
