"""The ordered rules that clean event rows. Each is DataFrame -> DataFrame, to be chained with transform().

Order matters: clocks, then minutes, units, values, duplicates, runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions import exprs as X


def normalise_clock(df: DataFrame, offset: str, name: str = "timestamp") -> DataFrame:
    """Text of either clock as local time; adds was_utc and was_unparseable."""
    text = F.col(name)
    return df.withColumns({"was_utc": X.true(text.endswith("Z")), "_local": X.wall_clock(text, offset)}).withColumn("was_unparseable", F.col("_local").isNull()).drop(name).withColumnRenamed("_local", name)


def snap_to_minute(df: DataFrame, name: str = "timestamp") -> DataFrame:
    """Floor to the minute; was_off_minute says that the seconds weren't 0 (fractions alone don't count)."""
    return df.withColumns({"was_off_minute": X.true(F.second(name) != 0), name: X.floor_minute(F.col(name))})


def unit_column(df: DataFrame, candidates: tuple[str, ...]) -> str | None:
    """The first of the candidate columns that the table has."""
    return next((c for c in candidates if c in df.columns), None)


def rescale_units(df: DataFrame, value: str, divisors: dict[str, int], unit: str | None) -> DataFrame:
    """Values per minute. An unknown unit makes the value null and keeps the row; adds unit_raw, was_rescaled, unit_unknown."""
    raw = F.col(unit) if unit else F.lit(None).cast("string")
    named = F.lower(F.trim(raw))
    known = raw.isNull() | X.is_in(named, list(divisors))
    table = F.create_map(*[F.lit(x) for pair in divisors.items() for x in (pair[0], float(pair[1]))])
    divisor = F.coalesce(F.when(named.isNotNull(), F.element_at(table, named)), F.lit(1.0))
    number = X.number(F.col(value).cast("string"))
    return df.withColumns({"unit_raw": raw, "unit_unknown": ~known, "was_rescaled": divisor > 1, value: F.when(known, number / divisor)})


def null_invalid(df: DataFrame, value: str, sentinels: tuple = (), valid: tuple | None = None) -> DataFrame:
    """Sentinels, and values outside the range, become null; the row stays. Adds value_was_invalid."""
    number = X.number(F.col(value).cast("string"))
    bad = X.is_in(number, [float(s) for s in sentinels])
    if valid:
        bad = bad | X.outside(number, *valid)
    return df.withColumns({"value_was_invalid": bad, value: F.when(~bad, number)})


def first_seen(df: DataFrame, keys: list[str], order: list, flags: tuple[str, ...] = ()) -> DataFrame:
    """One row for each key: the first in ``order``. Adds n_dropped, the rows that went for it, and n_<flag>: of all the key's rows, those with each flag.

    Nulls in a key are equal. Rows of a key are combined before the shuffle, so that it has one row for each key and part
    however often a key is repeated. Of rows that ``order`` doesn't tell apart, any one may stay.
    """
    others = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*others), F.struct(*order)).alias("_first")
    one = df.groupBy(*keys).agg(first, (F.count("*") - 1).alias("n_dropped"), *[F.count_if(F.col(c)).alias(f"n_{c}") for c in flags])
    return one.select(*[F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns], "n_dropped", *[f"n_{c}" for c in flags])


Step = Column | Callable[[Callable[[str], Column]], Column] | None


def _past(name: str) -> Column:
    """A column of the row before."""
    return F.col(f"_past_{name}")


def _goes_on(order: list[str], step: Step) -> Column:
    """Whether a row is of the run of the row before."""
    same = _past("value") == F.col("_value")
    if step is not None:
        same = same & (step(_past) if callable(step) else F.col(order[0]) - _past(order[0]) == step)
    return X.true(same)


def runs(df: DataFrame, value: str, by: list[str], order: str | list[str], step: Step = None, segment: Column | None = None, hold: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Run lengths: adds run_id (from 1), run_length, and run_start on a run's first row.

    A run breaks when the value changes, is null, or (with ``step``) when a row isn't that far from the one before: a distance of the single
    ``order`` column, or a condition made from the row before's columns. ``order`` tells the rows of a ``by`` apart.

    With ``segment``, which must not fall as ``order`` rises, a ``by`` is worked on in parts: runs are numbered within each segment, and
    a row for each segment, with its ends and its number of runs, is what a ``by`` is stitched together from. So no task holds more than
    a segment's rows, or a row for each segment of a ``by``. Segments' rows are read twice: ``hold`` may keep them between.
    """
    order = [order] if isinstance(order, str) else list(order)
    parts = [*by] if segment is None else [*by, "_segment"]
    keyed = df.withColumns({"_value": F.col(value), **({} if segment is None else {"_segment": segment})})
    w = Window.partitionBy(*parts).orderBy(*order)
    behind = {"_past_value": F.lag("_value").over(w), **{f"_past_{c}": F.lag(c).over(w) for c in order}}
    ends = {"_first": F.lag(F.lit(1)).over(w).isNull(), "_last": F.lead(F.lit(1)).over(w).isNull()} if segment is not None else {}
    started = keyed.withColumns({**behind, **ends}).withColumn("run_start", ~_goes_on(order, step)).drop(*behind)
    local = started.withColumn("run_id", F.sum(F.col("run_start").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    local = local.withColumn("run_length", F.count("*").over(Window.partitionBy(*parts, "run_id")))
    if segment is not None:
        local = _stitched(hold(local) if hold else local, by, order, step)
    return local.select(*df.columns, "run_id", "run_length", "run_start")


def _stitched(local: DataFrame, by: list[str], order: list[str], step: Step) -> DataFrame:
    """Runs that are numbered within segments, numbered and measured over all segments of a ``by``."""
    part = F.struct(*by, "_segment").alias("_part")  # a struct's nulls are equal to each other, in joins too
    row, edge = F.struct(*order, "_value"), lambda end: F.max(F.when(F.col(end), F.col("run_length")))
    ends = local.where("_first OR _last").groupBy(part).agg(F.min(row).alias("_a"), F.max(row).alias("_b"), F.max("run_id").alias("_runs"), edge("_first").alias("_head"), edge("_last").alias("_tail"))
    whose = [F.col("_part")[c] for c in by]
    of = Window.partitionBy(*whose).orderBy(F.col("_part._segment"))
    met = ends.withColumns({"_past": F.lag("_b").over(of), "_value": F.col("_a._value"), **{c: F.col("_a")[c] for c in order}})
    met = met.withColumns({"_past_value": F.col("_past._value"), **{f"_past_{c}": F.col("_past")[c] for c in order}}).withColumn("_glued", _goes_on(order, step))
    met = met.withColumn("_before", F.sum(F.col("_runs") - F.col("_glued").cast("long")).over(of.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_runs"))
    # The first and the last run of a segment may go on in others: their parts are added up.
    tail = F.when(F.col("_runs") > 1, F.col("_tail")).otherwise(0)
    edges = F.array(F.struct(F.lit(0).alias("_end"), (F.col("_before") + 1).alias("_id"), F.col("_head").alias("_n")), F.struct(F.lit(1).alias("_end"), (F.col("_before") + F.col("_runs")).alias("_id"), tail.alias("_n")))
    whole = met.select("_part", "_before", "_runs", "_glued", F.inline(edges)).withColumn("_n", F.sum("_n").over(Window.partitionBy(*whose, "_id")))
    at = lambda i: F.max(F.when(F.col("_end") == i, F.col("_n")))
    stitch = whole.groupBy("_part", "_before", "_runs", "_glued").agg(at(0).alias("_head"), at(1).alias("_tail"))
    first, last = F.col("run_id") == 1, F.col("run_id") == F.col("_runs")
    length = F.when(first, F.col("_head")).when(last, F.col("_tail")).otherwise(F.col("run_length"))
    return local.withColumn("_part", part).join(stitch, "_part").withColumns({"run_length": length, "run_start": F.col("run_start") & ~(first & F.col("_glued")), "run_id": F.col("run_id") + F.col("_before")})


def flag_stuck(df: DataFrame, value: str, minutes: int, by: str = "participant_id", order: str = "timestamp", hold: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """is_stuck: the value didn't move for at least so many minutes in a row, without a gap; stuck_start: the first row of such a run.

    Worked on by day, so that a participant with most of the rows is in many tasks.
    """
    found = runs(df, value, [by], order, F.expr("INTERVAL '1' MINUTE"), F.to_date(order), hold)
    stuck = X.true((F.col("run_length") >= minutes) & F.col(value).isNotNull())
    return found.withColumns({"is_stuck": stuck, "stuck_start": stuck & F.col("run_start")}).drop("run_id", "run_length", "run_start")


def grid(people: DataFrame, start, end, key: str = "participant_id", name: str = "date") -> DataFrame:
    """Every person on every day. The days are one array, so this is no join of two tables."""
    days = F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY")))
    return people.select(key).distinct().select(key, days.alias(name))
