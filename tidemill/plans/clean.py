"""Cleaned tables: each build gives its tables and the checks of what was found on the way."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.conf import Study
from tidemill.functions import exprs as X
from tidemill.operators import rules
from tidemill.operators.checks import Check, Found, Hold, evaluate

#: The names of rules and tables in this module, and the columns of what it builds.
WHO = "participant_id"


#: What "first seen" goes by: the file, then the place in it.
SEEN = ("_source_uri", "_block", "_ordinal")


def _seen(df: DataFrame) -> list[str]:
    return [c for c in SEEN if c in df.columns]


def _ruled(bronze: DataFrame, value: str, study: Study, sentinels: tuple = (), valid: tuple | None = None) -> DataFrame:
    """Every landed row on the study's clock, minutes and units; no row goes yet."""
    unit = rules.unit_column(bronze, study.unit_columns)
    return (
        bronze.transform(rules.normalise_clock, study.offset)
        .transform(rules.snap_to_minute)
        .transform(rules.rescale_units, value, study.unit_divisors, unit)
        .transform(rules.null_invalid, value, sentinels, valid)
    )


#: What the rules mark on a row; each is counted over all landed rows of a minute.
FLAGS = ("was_utc", "was_unparseable", "was_off_minute", "unit_unknown", "was_rescaled", "value_was_invalid", "has_unit")


def _single(ruled: DataFrame, value: str) -> DataFrame:
    marked = ruled.withColumn("has_unit", F.col("unit_raw").isNotNull()).select(WHO, "timestamp", value, "unit_raw", *FLAGS, *_seen(ruled))
    return marked.transform(rules.first_seen, ["timestamp", WHO], _seen(ruled) or [F.lit(0)], FLAGS).drop(*SEEN)


def _found(df: DataFrame, study: Study, bronze: DataFrame) -> list[Check]:
    """What the rules found on all landed rows, those included that go as duplicates after."""
    unit = rules.unit_column(bronze, study.unit_columns)
    n = lambda flag: F.col(f"n_{flag}")
    found = [
        Check("timezone_normalised", "error", n("was_utc"), f"UTC clock brought to UTC{study.offset}"),
        Check("timestamp_unparseable", "error", n("was_unparseable"), "timestamp is no ISO 8601 text"),
        Check("timestamp_snapped_to_minute", "error", n("was_off_minute"), "seconds dropped before duplicates go"),
        Check("unit_unknown", "error", n("unit_unknown"), "unit not known: value set to null"),
        Check("unit_rescaled", "error", n("was_rescaled"), "brought to values per minute"),
        Check("value_out_of_domain", "error", n("value_was_invalid"), "impossible value set to null; the minute stays"),
        Check("duplicate_rows_removed", "error", F.col("n_dropped"), "later rows of a participant's minute dropped, on {} day(s); the first seen stays", spans=F.to_date("timestamp")),
    ]
    if unit and unit != study.unit_columns[0]:
        found.append(Check("unit_field_nonstandard_name", "warn", n("has_unit"), f"the unit stands in {unit}"))
    return found


def build_steps(bronze: DataFrame, study: Study, hold: Hold | None = None) -> tuple[DataFrame, Found]:
    """Steps by participant and minute, and checks.

    With ``hold``, which keeps a table, landed rows are scanned once: the cleaned rows are kept with what the rules counted on them,
    and the table and its checks are read from there.
    """
    table = "silver_steps_minute"
    df = _single(_ruled(bronze, "steps", study, sentinels=study.steps_sentinels), "steps")
    df = hold(df, "steps") if hold else df
    checks = evaluate(df, table, _found(df, study, bronze), hold=hold)
    out = df.select(WHO, "timestamp", F.to_date("timestamp").alias("date"), X.even_round(F.col("steps")).cast("int").alias("steps"), "unit_raw", "was_rescaled", "was_utc", "was_off_minute", F.col("value_was_invalid").alias("was_sentinel"))
    return out, checks


def build_heart_rate(bronze: DataFrame, study: Study, hold: Hold | None = None) -> tuple[DataFrame, Found]:
    """Heart rate by participant and minute, and checks; ``hold`` as in build_steps()."""
    table = "silver_heart_rate_minute"
    df = _single(_ruled(bronze, "heart_rate_bpm", study, valid=study.heart_rate_range), "heart_rate_bpm").select(WHO, "timestamp", "heart_rate_bpm", "was_utc", "was_off_minute", "value_was_invalid", "n_dropped", *[f"n_{c}" for c in FLAGS])
    df = df.transform(rules.flag_stuck, "heart_rate_bpm", study.stuck_minutes, hold=(lambda rows: hold(rows, "heart rate")) if hold else None)
    stuck = Check("stuck_sensor_flagged", "error", F.col("is_stuck"), f"{{}} run(s) unchanged for {study.stuck_minutes} minutes or more; kept", parts=F.col("stuck_start"))
    checks = evaluate(df, table, [*_found(df, study, bronze), stuck], hold=hold)
    bpm = X.even_round(F.col("heart_rate_bpm")).cast("short").alias("heart_rate_bpm")
    out = df.select(WHO, "timestamp", F.to_date("timestamp").alias("date"), bpm, "is_stuck", "was_utc", "was_off_minute", F.col("value_was_invalid").alias("was_out_of_range"))
    return out, checks


def build_sleep(sessions: DataFrame, stages: DataFrame, study: Study) -> tuple[DataFrame, DataFrame, DataFrame, Found]:
    """Sessions derived from their stages, the stages of those that stay, rejected sessions, and checks."""
    clock = lambda c: X.wall_clock(F.col(c), study.offset)
    g = stages.withColumns({"start_time": clock("start_time"), "end_time": clock("end_time"), "duration_min_stated": X.number(F.col("duration_min").cast("string")), "date": F.col("date").try_cast("date")})
    g = g.withColumn("duration_min_derived", X.minutes_between(F.col("start_time"), F.col("end_time")))
    mismatch = X.true(F.abs(F.col("duration_min_stated") - F.col("duration_min_derived")) > study.stage_tolerance_min)
    g = g.withColumns({"duration_mismatch": mismatch, "is_asleep": ~X.is_in(F.col("stage"), list(study.awake))})
    minutes = F.col("duration_min_derived")
    sums = g.groupBy("session_key").agg(
        F.min("start_time").alias("first_start"),
        F.max("end_time").alias("last_end"),
        F.count("*").alias("n_stages"),
        F.bool_or("duration_mismatch").alias("any_mismatch"),
        F.max(F.when(F.col("is_asleep"), F.col("end_time"))).alias("asleep_end"),
        F.sum(F.when(F.col("is_asleep"), F.coalesce(minutes, F.lit(0.0)))).alias("total_sleep_min"),
        *[F.sum(F.when(F.col("stage") == s, F.coalesce(minutes, F.lit(0.0))).otherwise(0.0)).alias(f"{s}_min") for s in study.stages],
        X.joined_in_order("stage_idx", "stage").alias("stage_order"),
    )
    head = sessions.drop("n_stages").withColumns({"date": F.col("date").try_cast("date"), "onset_stated": clock("sleep_onset"), "end_stated": clock("sleep_end"), "efficiency_pct_stated": X.number(F.col("efficiency_pct").cast("string")), "restlessness": X.number(F.col("restlessness").cast("string"))})
    s = head.drop("sleep_onset", "sleep_end", "efficiency_pct").join(sums, "session_key", "left").fillna(0.0, [f"{x}_min" for x in study.stages]).fillna(0, ["n_stages"])
    s = s.withColumns({"sleep_onset": F.col("first_start"), "sleep_end": F.col("asleep_end"), "time_in_bed_min": X.minutes_between(F.col("first_start"), F.col("last_end"))})
    share = lambda a, b: F.try_divide(F.col(a), F.col(b)) * 100.0
    mid = X.midpoint(F.col("sleep_onset"), F.col("sleep_end"))
    off = F.abs(X.minutes_between(F.col("sleep_end"), F.col("end_stated")) * 60.0)
    s = s.withColumns(
        {
            "sleep_efficiency_pct": share("total_sleep_min", "time_in_bed_min"),
            "deep_sleep_pct": share("deep_min", "total_sleep_min"),
            "rem_sleep_pct": share("rem_min", "total_sleep_min"),
            "mid_sleep_time": mid,
            "mid_sleep_hour_signed": X.signed_hour(X.clock_hour(mid, seconds=True)),
            "sleep_onset_hour_signed": X.signed_hour(X.clock_hour(F.col("sleep_onset"))),
            "end_corrupt": X.true(off > study.end_tolerance_s),
            "stage_order_canonical": X.true(F.col("stage_order") == study.stage_order),
        }
    )
    # A session without stages has no mismatch of durations; it is incomplete.
    broken = X.true(F.col("any_mismatch"))
    reason = F.when(broken, "stage_duration_mismatch").when(F.col("end_corrupt"), "sleep_end_corrupt").when(F.col("total_sleep_min").isNull() | ~X.true(F.col("time_in_bed_min") > 0), "incomplete_stages")
    s = s.withColumn("reject_reason", F.when(F.col("session_key").isNull(), "incomplete_stages").otherwise(reason))
    checks = evaluate(
        s,
        "silver_sleep_sessions",
        [
            Check("sleep_end_corrupt", "error", F.col("end_corrupt"), "stated end is not the last sleeping stage's"),
            Check("stage_order_non_canonical", "warn", ~F.col("stage_order_canonical"), f"stages aren't {study.stage_order}"),
            Check("source_efficiency_ignored", "warn", X.true(F.col("efficiency_pct_stated") == 100.0), "stated as exactly 100; efficiency is derived from the stages", always=True),
            Check("sessions_quarantined", "error", F.col("reject_reason").isNotNull(), "rejected sessions go to quarantine"),
        ],
    )
    stage = Check("stage_duration_mismatch", "error", F.col("duration_mismatch"), "stages whose stated minutes aren't those between their times; their sessions are rejected")
    checks = checks + evaluate(g, "silver_sleep_stages", [stage])
    columns = ["session_key", WHO, "date", "sleep_onset", "sleep_end", "mid_sleep_time", "mid_sleep_hour_signed", "sleep_onset_hour_signed", "total_sleep_min", "time_in_bed_min", "sleep_efficiency_pct", "deep_sleep_pct", "rem_sleep_pct", *[f"{x}_min" for x in study.stages], "restlessness", "efficiency_pct_stated", "n_stages", "stage_order_canonical"]
    good = s.where("reject_reason IS NULL").select(columns)
    kept = g.join(good.select("session_key"), "session_key", "left_semi").select("session_key", WHO, "date", "stage_idx", "stage", "is_asleep", "start_time", "end_time", "duration_min_stated", "duration_min_derived", "duration_mismatch")
    return good, kept, s.where("reject_reason IS NOT NULL").select(*columns, "reject_reason"), checks


def build_participants(bronze: DataFrame, study: Study, order: list[str] | None = None) -> tuple[DataFrame, Found]:
    """The roster, one row for each participant (the first in ``order``, by itself the first seen), and checks."""
    whole = lambda c: X.number(F.col(c).cast("string")).cast("int").alias(c)
    df = bronze.transform(rules.first_seen, [WHO], order or _seen(bronze) or ["device_id"])
    malformed = evaluate(
        bronze,
        "silver_participants",
        [
            Check("participant_id_malformed", "error", ~X.true(F.col(WHO).rlike(study.participant_pattern)), "id has another form"),
            Check("device_id_malformed", "error", ~X.true(F.col("device_id").rlike(study.device_pattern)), "device id has another form"),
        ],
    )
    checks = malformed + evaluate(df, "silver_participants", [Check("duplicate_participant", "error", F.col("n_dropped"), "later rows of a participant dropped")])
    people, devices = F.count("*"), F.count_distinct("device_id")
    single = df.agg(
        F.lit("silver_participants").alias("table"),
        F.lit("participant_device_one_to_one").alias("rule"),
        F.when(people == devices, "info").otherwise("error").alias("severity"),
        (people - devices).alias("n_affected"),
        F.concat(people.cast("string"), F.lit(" participants, "), devices.cast("string"), F.lit(" distinct devices")).alias("detail"),
        F.lit("").alias("participants"),
    )
    checks = checks + single
    return df.select(WHO, "device_id", whole("age"), whole("height_cm"), "gender", "chronotype", whole("max_heart_rate")), checks


def build_devices(bronze: DataFrame, participants: DataFrame, study: Study) -> tuple[DataFrame, Found]:
    """Devices of known participants, with the firmware's version from the label where it is blank; and checks."""
    label = F.col("device_label")
    in_label = F.nullif(F.regexp_extract(label, study.firmware_pattern, 1), F.lit(""))
    own = F.nullif(F.trim("firmware_version"), F.lit(""))
    known = participants.select(WHO).distinct().withColumn("_known", F.lit(True))
    df = bronze.join(known, WHO, "left").withColumns(
        {
            "calibration_date": F.col("calibration_date").try_cast("date"),
            "_conflict": X.true(own != in_label),
            "_filled": own.isNull() & in_label.isNotNull(),
            "firmware_source": F.when(own.isNull() & in_label.isNotNull(), "device_label").otherwise("firmware_version"),
            "firmware_version": F.coalesce(own, in_label),
            "device_model": F.nullif(F.trim(F.split(label, "·")[0]), F.lit("")),
            "_orphan": F.col("_known").isNull(),
        }
    )
    checks = evaluate(
        df,
        "silver_devices",
        [
            Check("firmware_label_conflict", "error", F.col("_conflict"), "column and label name different versions"),
            Check("firmware_backfilled_from_label", "warn", F.col("_filled"), "blank version taken from the label"),
            Check("calibration_after_study_start", "error", X.true(F.col("calibration_date") >= F.lit(study.start)), "calibrated after the study began"),
            Check("device_orphan_participant", "error", F.col("_orphan"), "participant isn't on the roster: row dropped"),
        ],
    )
    return df.where("NOT _orphan").select(WHO, "device_id", "wear_site", "calibration_date", "firmware_version", "firmware_source", "device_model", "device_label"), checks


def build_survey(bronze: DataFrame, participants: DataFrame, study: Study, order: list[str] | None = None) -> tuple[DataFrame, DataFrame, Found]:
    """Survey answers of known participants by day (the first in ``order``, by itself the first seen), rejected ones, and checks."""
    scores = list(study.score_ranges)
    typed = bronze.withColumns({"date": F.col("date").try_cast("date"), **{c: X.number(F.col(c).cast("string")).cast("short") for c in scores}})
    known = participants.select(WHO).distinct().withColumn("_known", F.lit(True))
    df = typed.join(known, WHO, "left").withColumn("_orphan", F.col("_known").isNull())
    single = df.transform(rules.first_seen, [WHO, "date"], order or _seen(df) or [x for c in scores for x in (F.col(c).isNull().alias(f"no_{c}"), c)])
    table = "silver_wellness_survey"
    ranges = [Check(f"{c}_out_of_range", "error", X.outside(F.col(c), *study.score_ranges[c]), f"expected {study.score_ranges[c][0]} to {study.score_ranges[c][1]}; kept") for c in scores]
    checks = evaluate(df, table, [*ranges, Check("survey_orphan_participant", "error", F.col("_orphan"), "participant isn't on the roster: quarantined")])
    dropped = evaluate(single, table, [Check("duplicate_survey_response", "error", F.col("n_dropped"), "later answers of a day dropped")])
    rejected = df.where("_orphan").select(WHO, "date", *scores, F.lit("orphan_participant").alias("reject_reason"))
    return single.where("NOT _orphan").select(WHO, "date", *scores), rejected, checks + dropped


def build_coverage(participants: DataFrame, steps: DataFrame, hr: DataFrame, sleep: DataFrame, survey: DataFrame, study: Study) -> tuple[DataFrame, Found]:
    """Every participant on every day of the study, with what there is of each stream; and checks."""
    by = [WHO, "date"]
    spine = rules.grid(participants, study.start, study.end)
    minutes = lambda df, name: df.groupBy(*by).agg(F.count_distinct("timestamp").alias(name))
    rows = lambda df, name: df.groupBy(*by).agg(F.count("*").alias(name))
    parts = [minutes(steps, "steps_minutes"), minutes(hr, "hr_minutes"), rows(sleep, "sleep_sessions"), rows(survey, "survey_responses")]
    names = ["steps_minutes", "hr_minutes", "sleep_sessions", "survey_responses"]
    df = reduce(lambda a, b: a.join(b, by, "left"), parts, spine)
    df = df.withColumns({n: F.coalesce(n, F.lit(0)).cast("int") for n in names})
    share = lambda n: F.col(n) / F.lit(float(study.minutes_per_day)) * 100.0
    df = df.withColumns({"steps_coverage_pct": share("steps_minutes"), "hr_coverage_pct": share("hr_minutes")})
    df = df.withColumn("coverage_pct", F.least("steps_coverage_pct", "hr_coverage_pct"))
    df = df.withColumns({"is_complete_day": F.col("coverage_pct") >= study.complete_pct, "is_missing_day": F.col("coverage_pct") == 0})
    checks = evaluate(
        df,
        "silver_participant_day_coverage",
        [
            Check("participant_day_missing", "error", F.col("is_missing_day"), "a day without events"),
            Check("participant_day_partial", "error", ~F.col("is_missing_day") & ~F.col("is_complete_day"), f"a day under {study.complete_pct} % of its minutes"),
            Check("grid_size", "info", F.lit(1), "participants by days", always=True),
            Check("survey_missing_day", "warn", F.col("survey_responses") == 0, "a day without an answer"),
        ],
    )
    return df, checks


def undocumented_fields(records: DataFrame, table: str, study: Study) -> Found:
    """Checks for fields that no document names, with how many participants have each table's."""
    known = F.array(*[F.lit(x) for x in study.documented[table]])
    extra = records.select(F.col("_source_participant_dir").alias("who"), F.explode(F.array_except(F.map_keys("record"), known)).alias("field")).distinct()
    names = extra.select("field").distinct().agg(F.array_join(F.array_sort(F.collect_set("field")), ", ")).first()[0]
    return evaluate(extra.select("who").distinct(), f"bronze_{table}", [Check("undocumented_source_field", "error", F.lit(1), f"fields: {names}")], who="who")
