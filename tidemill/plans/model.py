"""The modelled tables: devices, days, weeks and cohorts. Quality travels with every row as flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.conf import Study
from tidemill.functions import exprs as X

WHO = "participant_id"

#: Means over complete days only, then over all nights or days, with their digits.
ACTIVE = {"steps_total": 1, "active_minutes": 1, "activity_midpoint_hour": 3, "hr_resting_bpm": 2}
RESTING = {"total_sleep_min": 1, "sleep_efficiency_pct": 2, "deep_sleep_pct": 2, "rem_sleep_pct": 2, "mid_sleep_hour": 3, "sleep_onset_hour": 3, "restlessness": 4}
SCORES = {"fatigue_score": 2, "stress_score": 2, "readiness_score": 2, "sleep_quality_score": 2}


def _complete(column: str) -> Column:
    return F.when(F.col("is_complete_day"), F.col(column))


def _mean(x: Column, column: str, digits: int) -> Column:
    return X.scaled_round(F.avg(x), digits).alias(f"{column}_mean")


def _sd(x: Column, column: str, digits: int) -> Column:
    return X.scaled_round(F.stddev_samp(x), digits).alias(f"{column}_sd")


def _means(columns: dict[str, int], complete: bool) -> list[Column]:
    return [_mean(_complete(c) if complete else F.col(c), c, d) for c, d in columns.items()]


def participant_devices(participants: DataFrame, devices: DataFrame) -> DataFrame:
    """The roster with each participant's own device, if it is known."""
    own = devices.select(WHO, "device_id", "device_model", "wear_site", "calibration_date", "firmware_version", "firmware_source")
    both = participants.join(own, [WHO, "device_id"], "left")
    return both.select(WHO, "device_id", "device_model", "wear_site", "calibration_date", "firmware_version", "firmware_source", "age", "gender", F.col("chronotype").alias("chronotype_declared"), "max_heart_rate").orderBy(WHO)


def daily_steps(steps: DataFrame) -> DataFrame:
    """Sums of a participant's day; the hour's weight is the steps taken in it."""
    return steps.groupBy(WHO, "date").agg(
        F.sum("steps").cast("long").alias("steps_total"),
        F.count_if(F.col("steps") > 0).alias("active_minutes"),
        F.max("steps").alias("steps_peak_minute"),
        F.count_if("was_sentinel").alias("_steps_nulled"),
        F.count_if("was_rescaled").alias("_rescaled"),
        F.sum(F.col("steps") * X.clock_hour(F.col("timestamp"))).alias("_weight"),
    )


def daily_heart_rate(hr: DataFrame) -> DataFrame:
    """A participant's day without the minutes of a stuck sensor, which are counted instead."""
    bpm = F.when(~F.col("is_stuck"), F.col("heart_rate_bpm"))
    return hr.groupBy(WHO, "date").agg(
        X.scaled_round(F.avg(bpm), 1).alias("hr_mean_bpm"),
        X.snapped_round(F.percentile(bpm, 0.05), 1).alias("hr_resting_bpm"),
        F.min(bpm).alias("hr_min_bpm"),
        F.max(bpm).alias("hr_max_bpm"),
        F.count_if("is_stuck").alias("_stuck"),
        F.count_if("was_out_of_range").alias("_hr_nulled"),
        F.count_if("was_utc").alias("_utc"),
    )


def daily_metrics(coverage: DataFrame, participants: DataFrame, steps: DataFrame, hr: DataFrame, sleep: DataFrame, survey: DataFrame, study: Study, calendar_week: bool = False) -> DataFrame:
    """One row for each participant and day of the grid, whatever there is of it."""
    by = [WHO, "date"]
    people = participants.select(WHO, F.col("chronotype").alias("chronotype_declared"), "age", "gender", "max_heart_rate")
    nights = sleep.select(
        *by,
        F.lit(True).alias("_night"),
        "total_sleep_min",
        "time_in_bed_min",
        *[X.scaled_round(F.col(c), 2).alias(c) for c in ("sleep_efficiency_pct", "deep_sleep_pct", "rem_sleep_pct")],
        X.scaled_round(F.col("mid_sleep_hour_signed"), 3).alias("mid_sleep_hour"),
        X.scaled_round(F.col("sleep_onset_hour_signed"), 3).alias("sleep_onset_hour"),
        "restlessness",
    )
    answers = survey.select(*by, F.lit(True).alias("_answer"), *SCORES)
    df = coverage.join(people, WHO, "left")
    for part in (daily_steps(steps), daily_heart_rate(hr), nights, answers):
        df = df.join(part, by, "left")
    none = lambda c: F.coalesce(F.col(c), F.lit(0))
    week = X.calendar_week if calendar_week else X.study_week
    return df.select(
        *by,
        week(F.col("date"), study.start).alias("study_week"),
        (F.datediff("date", F.lit(study.start)) + 1).alias("study_day"),
        *["chronotype_declared", "age", "gender", "max_heart_rate", "steps_total", "active_minutes", "steps_peak_minute"],
        F.when(F.col("steps_total") > 0, X.scaled_round(F.col("_weight") / F.col("steps_total"), 3)).alias("activity_midpoint_hour"),
        *["hr_mean_bpm", "hr_resting_bpm", "hr_min_bpm", "hr_max_bpm", "total_sleep_min", "time_in_bed_min"],
        *["sleep_efficiency_pct", "deep_sleep_pct", "rem_sleep_pct", "mid_sleep_hour", "sleep_onset_hour", "restlessness"],
        *SCORES,
        *["steps_minutes", "hr_minutes", X.scaled_round(F.col("coverage_pct"), 2).alias("coverage_pct"), "is_complete_day", "is_missing_day"],
        X.true(F.col("_night")).alias("has_sleep_session"),
        X.true(F.col("_answer")).alias("has_survey"),
        (none("_steps_nulled") + none("_hr_nulled")).alias("minutes_nulled"),
        none("_rescaled").alias("minutes_unit_rescaled"),
        none("_stuck").alias("hr_stuck_minutes"),
        none("_utc").alias("minutes_tz_corrected"),
    )


def weekly_summary(daily: DataFrame) -> DataFrame:
    """A participant's weeks: activity over complete days, sleep over every night."""
    total = lambda c: F.sum(c).cast("long").alias(c)
    out = daily.groupBy(WHO, "study_week").agg(
        F.min("date").alias("week_start"),
        F.max("date").alias("week_end"),
        *[F.max(c).alias(c) for c in ("chronotype_declared", "age", "gender")],
        F.count("*").alias("days_in_week"),
        F.count_if("is_complete_day").alias("days_complete"),
        F.count_if("is_missing_day").alias("days_missing"),
        F.count_if("has_sleep_session").alias("nights_with_sleep"),
        F.count_if("has_survey").alias("days_with_survey"),
        X.scaled_round(F.avg("coverage_pct"), 2).alias("mean_coverage_pct"),
        *_means({**ACTIVE, "hr_mean_bpm": 2}, True),
        *[_sd(_complete(c), c, ACTIVE[c]) for c in ("steps_total", "hr_resting_bpm")],
        F.sum(_complete("steps_total")).cast("long").alias("steps_total_sum"),
        X.scaled_round(F.max(_complete("hr_max_bpm")), 0).alias("hr_max_bpm_week"),
        *_means(RESTING, False),
        *[_sd(F.col(c), c, RESTING[c]) for c in ("total_sleep_min", "sleep_efficiency_pct", "mid_sleep_hour")],
        *_means(SCORES, False),
        *[total(c) for c in ("minutes_nulled", "hr_stuck_minutes", "minutes_unit_rescaled")],
    )
    return out.orderBy(WHO, "study_week")


def cohort_metrics(daily: DataFrame) -> DataFrame:
    """Each chronotype over the whole study and by week, in one pass over the days."""
    known = daily.where("chronotype_declared IS NOT NULL").withColumnRenamed("chronotype_declared", "chronotype")
    sets = known.groupingSets([["chronotype"], ["chronotype", "study_week"]], "chronotype", "study_week")
    out = sets.agg(
        F.grouping("study_week").alias("_whole"),
        F.count_distinct(WHO).alias("n_participants"),
        F.count("*").alias("n_participant_days"),
        F.count_if("is_complete_day").alias("n_complete_days"),
        F.count_if("has_sleep_session").alias("n_nights"),
        *_means(RESTING, False),
        *[_sd(F.col(c), c, RESTING[c]) for c in ("mid_sleep_hour", "total_sleep_min")],
        X.snapped_round(F.median("mid_sleep_hour"), 3).alias("mid_sleep_hour_median"),
        *_means(ACTIVE, True),
        _sd(_complete("steps_total"), "steps_total", 1),
        *_means(SCORES, False),
    )
    whole = F.col("_whole") == 1
    named = out.withColumns({"period_type": F.when(whole, "study").otherwise("week"), "period_label": F.when(whole, "all").otherwise(F.col("study_week").cast("string"))}).drop("_whole")
    first = ["period_type", "period_label", "study_week", "chronotype"]
    return named.select(*first, *[c for c in named.columns if c not in first]).orderBy(F.desc("period_type"), F.asc_nulls_first("study_week"), "chronotype")
