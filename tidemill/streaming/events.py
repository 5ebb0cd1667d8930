"""The event rules over a stream: the stateless ones as they are, duplicates within a watermark, days as windows.

An extension: batch runs are the published ones. Late rows beyond the watermark are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.conf import Study
from tidemill.functions import exprs as X
from tidemill.operators import rules


def clean_steps(stream: DataFrame, study: Study, late: str = "2 days") -> DataFrame:
    """Steps by minute: clocks, minutes, units and values as in batch, then duplicates within the watermark."""
    unit = rules.unit_column(stream, study.unit_columns)
    rows = (
        stream.transform(rules.normalise_clock, study.offset)
        .transform(rules.snap_to_minute)
        .transform(rules.rescale_units, "steps", study.unit_divisors, unit)
        .transform(rules.null_invalid, "steps", study.steps_sentinels)
        .where("timestamp IS NOT NULL")
        .withColumn("event_time", F.col("timestamp").cast("timestamp"))
    )
    return rows.withWatermark("event_time", late).dropDuplicatesWithinWatermark(["participant_id", "event_time"])


def daily_steps(clean: DataFrame) -> DataFrame:
    """A participant's day, once the watermark has passed it."""
    by_day = clean.groupBy("participant_id", F.window("event_time", "1 day"))
    out = by_day.agg(F.sum(X.even_round(F.col("steps")).cast("long")).alias("steps_total"), F.count_if(F.col("steps") > 0).alias("active_minutes"))
    return out.select("participant_id", F.to_date("window.start").alias("date"), "steps_total", "active_minutes")


def sessions(stream: DataFrame, who: str, at: str, gap: str, late: str = "1 hour") -> DataFrame:
    """Bursts of events without a gap, with how many events each has."""
    marked = stream.withWatermark(at, late)
    return marked.groupBy(who, F.session_window(at, gap)).agg(F.count("*").alias("n")).select(who, "session_window.start", "session_window.end", "n")
