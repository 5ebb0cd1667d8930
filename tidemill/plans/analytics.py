"""Comparisons of the two chronotypes."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import exprs as X

#: Place, metric as published, unit, and the cohort table's column.
COMPARED = [
    (1, "Participants", "", "n_participants"),
    (2, "Nights with a valid sleep session", "nights", "n_nights"),
    (3, "Complete participant-days", "days", "n_complete_days"),
    (10, "Mid-sleep time", "h from midnight", "mid_sleep_hour_mean"),
    (11, "Sleep onset time", "h from midnight", "sleep_onset_hour_mean"),
    (12, "Total sleep", "min", "total_sleep_min_mean"),
    (13, "Sleep efficiency (stage-derived)", "%", "sleep_efficiency_pct_mean"),
    (14, "Deep sleep", "% of sleep", "deep_sleep_pct_mean"),
    (15, "REM sleep", "% of sleep", "rem_sleep_pct_mean"),
    (16, "Restlessness index", "0-1", "restlessness_mean"),
    (20, "Activity midpoint (step-weighted)", "h of day", "activity_midpoint_hour_mean"),
    (21, "Daily steps", "steps", "steps_total_mean"),
    (22, "Active minutes per day", "min", "active_minutes_mean"),
    (30, "Resting heart rate (p5)", "bpm", "hr_resting_bpm_mean"),
    (40, "Readiness score", "0-10", "readiness_score_mean"),
    (41, "Sleep quality score", "1-5", "sleep_quality_score_mean"),
    (42, "Fatigue score", "1-5", "fatigue_score_mean"),
]

#: Per-participant columns whose difference is tested, their names, and whether they define a chronotype.
TESTED = [
    ("mid_sleep_hour_median", "Mid-sleep time (h)", True),
    ("sleep_onset_hour_median", "Sleep onset time (h)", True),
    ("activity_midpoint_hour_mean", "Activity midpoint (h)", True),
    ("total_sleep_min_mean", "Total sleep (min)", False),
    ("sleep_efficiency_pct_mean", "Sleep efficiency (%)", False),
    ("deep_sleep_pct_mean", "Deep sleep (%)", False),
    ("steps_total_mean", "Daily steps", False),
    ("hr_resting_bpm_mean", "Resting HR (bpm)", False),
]
LEAST_D, MOST_P = 0.5, 0.05


def compared(table: DataFrame, side: Column, metrics: list[tuple[int, str, str, str]]) -> DataFrame:
    """ord, metric, unit, a, b, delta: one row for each metric, from one row for each side ("A", "B")."""
    wide = table.agg(*[F.max(F.when(side == s, F.col(c).cast("double"))).alias(f"{c}_{s}") for _, _, _, c in metrics for s in "AB"])
    rows = [F.struct(F.lit(o).alias("ord"), F.lit(m).alias("metric"), F.lit(u).alias("unit"), F.col(f"{c}_A").alias("a"), F.col(f"{c}_B").alias("b")) for o, m, u, c in metrics]
    return wide.select(F.inline(F.array(*rows))).withColumn("delta", X.even_round(F.col("b") - F.col("a"), 3))


def cohort_comparison(cohorts: DataFrame) -> DataFrame:
    """The whole study's cohorts side by side."""
    out = compared(cohorts.where("period_type = 'study'"), F.col("chronotype"), COMPARED).orderBy("ord")
    return out.select("metric", "unit", F.col("a").alias("morning_type_a"), F.col("b").alias("evening_type_b"), F.col("delta").alias("delta_b_minus_a"))


def chronotype_validation(daily: DataFrame) -> DataFrame:
    """Declared chronotypes against a split of the participants' median mid-sleep at its median."""
    each = daily.where("has_sleep_session").groupBy("participant_id").agg(F.max("chronotype_declared").alias("chronotype_declared"), F.median("mid_sleep_hour").alias("m"))
    cut = each.agg(F.median("m").alias("threshold"))  # one row
    sided = each.crossJoin(F.broadcast(cut)).withColumn("chronotype_derived", F.when(F.col("m") <= F.col("threshold"), "A").otherwise("B"))
    out = sided.groupBy("chronotype_declared", "chronotype_derived").agg(
        F.count("*").alias("n_participants"),
        X.snapped_round(F.min("m"), 3).alias("mid_sleep_median_min"),
        X.snapped_round(F.avg("m"), 3).alias("mid_sleep_median_mean"),
        X.snapped_round(F.max("m"), 3).alias("mid_sleep_median_max"),
        X.snapped_round(F.max("threshold"), 3).alias("split_threshold_hour"),
    )
    return out.withColumn("agrees", F.col("chronotype_declared") == F.col("chronotype_derived")).orderBy(F.asc_nulls_last("chronotype_declared"), "chronotype_derived")


TREND = ["study_week", "chronotype", "n_participants", "n_complete_days", "n_nights", "mid_sleep_hour_mean", "total_sleep_min_mean", "sleep_efficiency_pct_mean", "deep_sleep_pct_mean", "activity_midpoint_hour_mean", "steps_total_mean", "hr_resting_bpm_mean", "readiness_score_mean"]


def weekly_trend(cohorts: DataFrame) -> DataFrame:
    return cohorts.where("period_type = 'week'").select(*TREND).orderBy(F.asc_nulls_last("study_week"), "chronotype")


def per_participant(daily: DataFrame) -> DataFrame:
    """Each participant over the whole study: activity over complete days, sleep over every night."""
    complete = lambda c: F.avg(F.when(F.col("is_complete_day"), F.col(c))).alias(f"{c}_mean")
    return (
        daily.where("chronotype_declared IS NOT NULL")
        .groupBy("participant_id")
        .agg(
            F.max("chronotype_declared").alias("chronotype"),
            *[F.median(c).alias(f"{c}_median") for c in ("mid_sleep_hour", "sleep_onset_hour")],
            *[F.avg(c).alias(f"{c}_mean") for c in ("total_sleep_min", "sleep_efficiency_pct", "deep_sleep_pct")],
            *[complete(c) for c in ("steps_total", "activity_midpoint_hour", "hr_resting_bpm")],
            F.count_if("has_sleep_session").alias("nights"),
        )
        .orderBy("participant_id")
    )


def moments(rows: DataFrame, is_a: Column, columns: list[str]) -> DataFrame:
    """metric, n, mean and variance of either side, of each column: one pass, one row for each column."""
    aggs = []
    for c in columns:
        for s, side in (("a", is_a), ("b", ~is_a)):
            x = F.when(side, F.col(c).cast("double"))
            aggs += [F.count(x).alias(f"{c}|n_{s}"), F.avg(x).alias(f"{c}|mean_{s}"), F.var_samp(x).alias(f"{c}|var_{s}")]
    wide = rows.agg(*aggs)
    names = ["n_a", "mean_a", "var_a", "n_b", "mean_b", "var_b"]
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), *[F.col(f"`{c}|{n}`").alias(n) for n in names]) for c in columns])))


def effects(m: DataFrame) -> DataFrame:
    """Difference, Welch's t and Cohen's d of moments() where both sides have two values or more."""
    some = m.where("n_a >= 2 AND n_b >= 2")
    error = F.sqrt(F.col("var_a") / F.col("n_a") + F.col("var_b") / F.col("n_b"))
    pooled = F.sqrt(((F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b")) / (F.col("n_a") + F.col("n_b") - 2))
    diff = F.col("mean_b") - F.col("mean_a")
    return some.withColumns({"diff": diff, "t": F.try_divide(diff, error), "d": F.try_divide(diff, pooled)})


def effect_sizes(people: DataFrame) -> DataFrame:
    """Which metrics separate the cohorts: large enough, and hardly by chance (normal approximation). Cohort B is everyone who isn't A."""
    found = effects(moments(people, X.true(F.col("chronotype") == "A"), [c for c, _, _ in TESTED]))
    names = people.sparkSession.createDataFrame([(i, *x) for i, x in enumerate(TESTED)], "place int, metric string, name string, timing boolean")
    p = X.erfc(F.abs("t") / F.sqrt(F.lit(2.0)))
    rounded = lambda c, n, name: X.scaled_round(F.col(c), n).alias(name)
    columns = [F.col("name").alias("metric"), F.col("timing").alias("defines_chronotype"), rounded("mean_a", 3, "morning_a_mean"), rounded("mean_b", 3, "evening_b_mean"), rounded("diff", 3, "difference_b_minus_a")]
    columns += [rounded("d", 2, "cohens_d"), rounded("t", 2, "welch_t"), X.scaled_round(p, 4).alias("p_approx"), X.true((F.abs("d") >= LEAST_D) & (p < MOST_P)).alias("separates_cohorts")]
    return found.join(F.broadcast(names), "metric").orderBy("place").select(*columns)
