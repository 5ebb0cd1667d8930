"""Queries that render the driver's tables as a study's raw export and take it through landing, rules and builds.

What is written goes to the shared folder as the formats of an export: JSON arrays by participant, and CSV.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.conf import Study
from tidemill.functions import exprs as X
from tidemill.plans import analytics, clean, model, quality
from tidemill.plans.queries import ORACLE_SQL, QUERIES, _scratch, query
from tidemill.plans.run import DEVICES, PARTICIPANTS, SURVEY
from tidemill.sources import files

__all__ = ["ORACLE_SQL", "QUERIES"]

STUDY = Study()
AT = datetime(2026, 1, 1)


def _who(number: Column) -> Column:
    return F.format_string("P%03d", number)


def _arrays(df: DataFrame, who: str, order: str) -> str:
    """Each participant's records as one JSON array in a folder of its own; null fields are left out."""
    base = _scratch(df.sparkSession)
    record = F.struct(*[c for c in df.columns if c not in (who, order)])
    in_order = F.transform(F.array_sort(F.collect_list(F.struct(order, record.alias("r")))), lambda x: x["r"])
    df.groupBy(F.col(who).alias("who")).agg(F.to_json(in_order).alias("value")).write.partitionBy("who").text(base)
    return base


def _csv(df: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """A CSV in an order of its own, in as many parts as sorting has, written and read back with each row's place: the part, and the place in it."""
    path = _scratch(df.sparkSession)
    df.orderBy(order).select(*columns).write.csv(path, header=True)
    return files.lineage(files.read_csv(df.sparkSession, path, columns, placed=True), "run", AT)


def _events(events: DataFrame, value: str, unit: str) -> DataFrame:
    """Landed records of events: a seventh with a UTC clock, a fifth by the hour, an eleventh with a sentinel."""
    seventh, fifth, eleventh = (F.col("event_id") % k == 0 for k in (7, 5, 11))
    second = "yyyy-MM-dd'T'HH:mm:ss"
    local = F.col("ts").cast("timestamp_ntz")
    rows = events.select(
        "event_id",
        _who(F.col("user_id")).alias("who"),
        _who(F.col("user_id")).alias("participant_id"),
        F.when(seventh, F.concat(F.date_format(local + F.expr("INTERVAL 5 HOURS"), second), F.lit("Z"))).otherwise(F.date_format(local, second)).alias("timestamp"),
        F.when(eleventh, F.lit(-1.0)).when(fifth, F.col("value") * 60).otherwise(F.col("value")).alias(value),
        F.when(fifth & ~eleventh, F.lit("steps_per_hour")).alias(unit),
    )
    return files.read_records(events.sparkSession, files.join(_arrays(rows, "who", "event_id"), "*", "*.txt"), "run", AT)


def _columns(records: DataFrame) -> DataFrame:
    return files.fields(records, files.field_names(records))


RULED = """
ruled AS (
  SELECT event_id, printf('P%03d', user_id) AS participant_id, date_trunc('minute', ts) AS timestamp, event_id % 7 = 0 AS was_utc, second(ts) <> 0 AS was_off_minute,
         event_id % 5 = 0 AND event_id % 11 <> 0 AS was_rescaled, event_id % 11 = 0 AS was_sentinel,
         CASE WHEN event_id % 11 = 0 THEN -1 WHEN event_id % 5 = 0 THEN value * 60 / 60 ELSE value END AS v,
         row_number() OVER (PARTITION BY user_id, date_trunc('minute', ts) ORDER BY event_id) AS k
  FROM events)
"""


@query("""
SELECT 'participant_id' AS field, count(*) AS n, 'string' AS type FROM events UNION ALL SELECT 'steps', count(*) FILTER (WHERE value IS NOT NULL OR event_id % 11 = 0), 'double' FROM events
UNION ALL SELECT 'timestamp', count(*) FILTER (WHERE ts IS NOT NULL), 'timestamp' FROM events UNION ALL SELECT '_unit', count(*), 'string' FROM events WHERE event_id % 5 = 0 AND event_id % 11 <> 0
""")
def export_landed_fields(events):
    """The fields of landed records: how many have each, and what its values are."""
    return files.field_types(_events(events, "steps", "_unit"))


@query("SELECT printf('P%03d', user_id) AS participant_id, printf('who=P%03d', user_id) AS folder, count(*) AS n, 0 AS first_place, count(*) - 1 AS last_place, 'run' AS run_id, TIMESTAMP '2026-01-01' AS at FROM events GROUP BY user_id")
def export_lineage(events):
    """Each participant's records, their folder, and the places of the first and the last."""
    records = _events(events, "steps", "_unit")
    by = records.groupBy(F.col("record")["participant_id"].alias("participant_id"), F.col("_source_participant_dir").alias("folder"))
    return by.agg(F.count("*").alias("n"), F.min("_ordinal").alias("first_place"), F.max("_ordinal").cast("long").alias("last_place"), F.first("_run_id").alias("run_id"), F.first("_ingested_at").alias("at"))


@query("SELECT printf('who=P%03d', user_id) AS folder, 1::BIGINT AS files FROM events GROUP BY user_id")
def export_inventory(events):
    """The files of an export by folder."""
    made = _arrays(events.select("event_id", _who(F.col("user_id")).alias("who"), "event_type"), "who", "event_id")
    return files.inventory(events.sparkSession, made).where("name LIKE '%.txt' AND bytes > 0").groupBy("folder").agg(F.count("*").alias("files"))


@query(f"""
WITH {RULED}
SELECT participant_id, timestamp, CAST(timestamp AS DATE) AS date, CAST(CASE WHEN NOT was_sentinel THEN round_even(v, 0) END AS INTEGER) AS steps,
       CASE WHEN was_rescaled THEN 'steps_per_hour' END AS unit_raw, was_rescaled, was_utc, was_off_minute, was_sentinel
FROM ruled WHERE k = 1
""")
def export_steps(events):
    """Steps from their landed records: clocks, minutes, units, sentinels, first seen."""
    return clean.build_steps(_columns(_events(events, "steps", "_unit")), STUDY)[0]


@query(f"""
WITH {RULED}, found AS (
  SELECT 'timezone_normalised' AS rule, 'error' AS severity, count(*) FILTER (WHERE was_utc) AS n_affected FROM ruled
  UNION ALL SELECT 'timestamp_snapped_to_minute', 'error', count(*) FILTER (WHERE was_off_minute) FROM ruled
  UNION ALL SELECT 'unit_rescaled', 'error', count(*) FILTER (WHERE was_rescaled) FROM ruled
  UNION ALL SELECT 'value_out_of_domain', 'error', count(*) FILTER (WHERE was_sentinel) FROM ruled
  UNION ALL SELECT 'unit_field_nonstandard_name', 'warn', count(*) FILTER (WHERE was_rescaled) FROM ruled
  UNION ALL SELECT 'duplicate_rows_removed', 'error', count(*) FILTER (WHERE k > 1) FROM ruled)
SELECT * FROM found WHERE n_affected > 0
""")
def export_steps_checks(events):
    """What the rules found on all landed rows, before duplicates go, and the duplicates."""
    return clean.build_steps(_columns(_events(events, "steps", "_unit")), STUDY)[1].select("rule", "severity", "n_affected")


@query(f"""
WITH {RULED}, one AS (SELECT *, CASE WHEN v BETWEEN 20 AND 250 THEN v END AS bpm FROM ruled WHERE k = 1),
g AS (SELECT *, CASE WHEN bpm = lag(bpm) OVER w AND timestamp - lag(timestamp) OVER w = INTERVAL 1 MINUTE THEN 0 ELSE 1 END AS new FROM one WINDOW w AS (PARTITION BY participant_id ORDER BY timestamp)),
r AS (SELECT *, sum(new) OVER (PARTITION BY participant_id ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS run FROM g)
SELECT participant_id, timestamp, CAST(timestamp AS DATE) AS date, CAST(round_even(bpm, 0) AS SMALLINT) AS heart_rate_bpm, was_utc, was_off_minute, NOT (v BETWEEN 20 AND 250) AS was_out_of_range,
       bpm IS NOT NULL AND count(*) OVER (PARTITION BY participant_id, run) >= 60 AS is_stuck
FROM r
""")
def export_heart_rate(events):
    """Heart rates from their landed records; the unit's field has its documented name."""
    return clean.build_heart_rate(_columns(_events(events, "heart_rate_bpm", "unit")), STUDY)[0]


@query(f"""
WITH {RULED}, found AS (
  SELECT 'timezone_normalised' AS rule, 'error' AS severity, count(*) FILTER (WHERE was_utc) AS n_affected FROM ruled
  UNION ALL SELECT 'timestamp_snapped_to_minute', 'error', count(*) FILTER (WHERE was_off_minute) FROM ruled
  UNION ALL SELECT 'unit_rescaled', 'error', count(*) FILTER (WHERE was_rescaled) FROM ruled
  UNION ALL SELECT 'value_out_of_domain', 'error', count(*) FILTER (WHERE NOT (v BETWEEN 20 AND 250)) FROM ruled
  UNION ALL SELECT 'duplicate_rows_removed', 'error', count(*) FILTER (WHERE k > 1) FROM ruled)
SELECT * FROM found WHERE n_affected > 0
""")
def export_heart_rate_checks(events):
    """What the rules found on all landed heart rates."""
    return clean.build_heart_rate(_columns(_events(events, "heart_rate_bpm", "unit")), STUDY)[1].select("rule", "severity", "n_affected")


@query("""
SELECT 'bronze_steps' AS "table", 'undocumented_source_field' AS rule, 'error' AS severity, count(DISTINCT user_id) AS n_affected, 'fields: _unit' AS detail
FROM events WHERE event_id % 5 = 0 AND event_id % 11 <> 0 HAVING count(*) > 0
""")
def export_undocumented(events):
    """Fields that no document names, and how many participants have them."""
    return clean.undocumented_fields(_events(events, "steps", "_unit"), "steps", STUDY).drop("participants")


def _nights(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """A night for each conversation, a stage for each turn; some stated lengths and ends are wrong."""
    from pyspark.sql import Window

    minutes = (F.lit(10) + F.length("text") % 50).cast("int")
    w = Window.partitionBy("conv_id").orderBy("turn")
    base = F.lit(datetime(2024, 1, 1, 23)).cast("timestamp_ntz") + F.make_dt_interval(F.col("conv_id").cast("int"))
    each = conversations.withColumn("m", minutes).withColumn("upto", F.sum("m").over(w).cast("int")).withColumn("base", base)
    each = each.withColumns({"start": F.col("base") + F.make_dt_interval(mins=F.col("upto") - F.col("m")), "stop": F.col("base") + F.make_dt_interval(mins=F.col("upto"))})
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    stage = F.element_at(F.array(*map(F.lit, ("light", "deep", "rem", "awake"))), (F.col("turn") % 4 + 1).cast("int"))
    stated = (F.col("m") + F.when((F.col("conv_id") % 9 == 0) & (F.col("turn") == 0), 5).otherwise(0)).cast("string")
    each = each.withColumns({"who": _who(F.col("conv_id") % 100), "stage": stage, "g": F.struct("turn", stage.alias("stage"), iso("start").alias("start_time"), iso("stop").alias("end_time"), stated.alias("duration_min"))})
    asleep = F.max(F.when(F.col("stage") != "awake", F.col("stop")))
    nights = each.groupBy("conv_id", "who").agg(F.transform(F.array_sort(F.collect_list("g")), lambda x: x.dropFields("turn")).alias("stages"), F.first("base").alias("base"), asleep.alias("end"))
    rows = nights.select(
        "conv_id",
        "who",
        F.col("who").alias("participant_id"),
        F.date_format("base", "yyyy-MM-dd").alias("date"),
        iso("base").alias("sleep_onset"),
        iso(F.col("end") + F.make_dt_interval(mins=F.when(F.col("conv_id") % 10 == 0, 10).otherwise(0))).alias("sleep_end"),
        F.when(F.col("conv_id") % 3 == 0, "90.5").otherwise("100.0").alias("efficiency_pct"),
        F.lit("0.2").alias("restlessness"),
        "stages",
    )
    landed = files.read_sleep(conversations.sparkSession, files.join(_arrays(rows, "who", "conv_id"), "*", "*.txt"), "run", AT)
    return clean.build_sleep(*landed, STUDY)


NIGHTS = """
each AS (SELECT conv_id, turn, CAST(10 + length(text) % 50 AS INTEGER) AS m, ['light', 'deep', 'rem', 'awake'][turn % 4 + 1] AS stage, TIMESTAMP '2024-01-01 23:00:00' + to_days(conv_id::INTEGER) AS base FROM conversations),
timed AS (SELECT *, sum(m) OVER (PARTITION BY conv_id ORDER BY turn) AS upto FROM each),
nights AS (
  SELECT conv_id, printf('P%03d', conv_id % 100) || '|' || strftime(any_value(base), '%Y-%m-%d|%Y-%m-%dT%H:%M:%S') AS session_key, count(*) AS n_stages, CAST(sum(m) AS DOUBLE) AS time_in_bed_min,
         CAST(sum(m) FILTER (WHERE stage <> 'awake') AS DOUBLE) AS total_sleep_min, CAST(coalesce(sum(m) FILTER (WHERE stage = 'deep'), 0) AS DOUBLE) AS deep_min,
         any_value(base) AS sleep_onset, any_value(base) + to_minutes(CAST(max(upto) FILTER (WHERE stage <> 'awake') AS BIGINT)) AS sleep_end, string_agg(stage, '->' ORDER BY turn) = 'light->deep->rem->light->awake' AS stage_order_canonical,
         CASE WHEN conv_id % 9 = 0 AND min(turn) = 0 THEN 'stage_duration_mismatch' WHEN conv_id % 10 = 0 THEN 'sleep_end_corrupt' END AS reject_reason
  FROM timed GROUP BY conv_id)
"""


@query(f"""
WITH {NIGHTS}
SELECT session_key, n_stages, time_in_bed_min, total_sleep_min, deep_min, round(100 * total_sleep_min / time_in_bed_min, 6) AS efficiency, sleep_onset, sleep_end, stage_order_canonical, reject_reason FROM nights
""")
def export_sleep(conversations):
    """Nights derived from their stages, and the rejected ones with the reason."""
    good, _, bad, _ = _nights(conversations)
    both = good.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(bad)
    efficiency = F.round("sleep_efficiency_pct", 6).alias("efficiency")
    return both.select("session_key", "n_stages", "time_in_bed_min", "total_sleep_min", "deep_min", efficiency, "sleep_onset", "sleep_end", "stage_order_canonical", "reject_reason")


@query(f"""
WITH {NIGHTS}, found AS (
  SELECT 'silver_sleep_sessions' AS "table", 'sleep_end_corrupt' AS rule, 'error' AS severity, count(*) FILTER (WHERE conv_id % 10 = 0) AS n_affected FROM nights
  UNION ALL SELECT 'silver_sleep_sessions', 'stage_order_non_canonical', 'warn', count(*) FILTER (WHERE NOT stage_order_canonical) FROM nights
  UNION ALL SELECT 'silver_sleep_sessions', 'source_efficiency_ignored', 'warn', count(*) FILTER (WHERE conv_id % 3 <> 0) FROM nights
  UNION ALL SELECT 'silver_sleep_sessions', 'sessions_quarantined', 'error', count(*) FILTER (WHERE reject_reason IS NOT NULL) FROM nights
  UNION ALL SELECT 'silver_sleep_stages', 'stage_duration_mismatch', 'error', count(*) FILTER (WHERE conv_id % 9 = 0 AND turn = 0) FROM each)
SELECT * FROM found WHERE n_affected > 0 OR rule = 'source_efficiency_ignored'
""")
def export_sleep_checks(conversations):
    return _nights(conversations)[3].select("table", "rule", "severity", "n_affected")


@query(f"""
WITH {NIGHTS}
SELECT n.session_key, t.turn AS stage_idx, t.stage, t.stage <> 'awake' AS is_asleep, CAST(t.m AS DOUBLE) AS duration_min_derived FROM timed t JOIN nights n USING (conv_id) WHERE n.reject_reason IS NULL
""")
def export_sleep_stages(conversations):
    """Stages of the nights that stay. Turns are numbered from 0, as places in an array are."""
    return _nights(conversations)[1].select("session_key", F.col("stage_idx").cast("long").alias("stage_idx"), "stage", "is_asleep", "duration_min_derived")


def _roster(customer: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = customer.select(
        "c_custkey",
        _who(F.col("c_custkey") % 90).alias("participant_id"),
        F.format_string("FBT-%04d-%08X", F.col("c_custkey") % 1000, F.col("c_custkey")).alias("device_id"),
        (F.col("c_nationkey") + 20).alias("age"),
        F.when(F.col("c_custkey") % 13 == 0, "NA").otherwise("170").alias("height_cm"),
        F.when(F.col("c_custkey") % 2 == 0, "f").otherwise("m").alias("gender"),
        F.when(F.col("c_nationkey") % 2 == 0, "A").otherwise("B").alias("chronotype"),
        F.lit("n/a").alias("max_heart_rate"),
    )
    return clean.build_participants(_csv(rows, "c_custkey", PARTICIPANTS), STUDY)


ROSTER = """
roster AS (SELECT * FROM (
  SELECT printf('P%03d', c_custkey % 90) AS participant_id, printf('FBT-%04d-%08X', c_custkey % 1000, c_custkey) AS device_id, CAST(c_nationkey + 20 AS INTEGER) AS age, CASE WHEN c_custkey % 13 <> 0 THEN 170 END AS height_cm,
         CASE WHEN c_custkey % 2 = 0 THEN 'f' ELSE 'm' END AS gender, CASE WHEN c_nationkey % 2 = 0 THEN 'A' ELSE 'B' END AS chronotype, CAST(NULL AS INTEGER) AS max_heart_rate,
         row_number() OVER (PARTITION BY c_custkey % 90 ORDER BY c_custkey) AS k FROM customer) WHERE k = 1)
"""


@query(f"WITH {ROSTER} SELECT * EXCLUDE (k) FROM roster")
def export_participants(customer):
    """The roster from its CSV: of a participant's rows, the first in the file."""
    return _roster(customer)[0]


@query("""
SELECT 'duplicate_participant' AS rule, 'error' AS severity, count(*) - count(DISTINCT c_custkey % 90) AS n_affected, '' AS detail FROM customer HAVING count(*) > count(DISTINCT c_custkey % 90)
UNION ALL SELECT 'participant_device_one_to_one', 'info', 0, count(DISTINCT c_custkey % 90) || ' participants, ' || count(DISTINCT c_custkey % 90) || ' distinct devices' FROM customer
""")
def export_participants_checks(customer):
    """Repeated participants, and whether each has a device of its own."""
    found = _roster(customer)[1].select("rule", "severity", "n_affected", "detail")
    return found.withColumn("detail", F.when(F.col("severity") == "info", F.col("detail")).otherwise(""))


def _devices(supplier: DataFrame, people: DataFrame) -> tuple[DataFrame, DataFrame]:
    nation = F.col("s_nationkey").cast("string")
    rows = supplier.select(
        "s_suppkey",
        _who(F.col("s_suppkey")).alias("participant_id"),
        F.format_string("FBT-%04d-%08X", F.col("s_suppkey"), F.col("s_suppkey")).alias("device_id"),
        F.lit("wrist").alias("wear_site"),
        F.when(F.col("s_suppkey") % 6 == 0, "2026-01-20").otherwise("2025-12-01").alias("calibration_date"),
        F.when(F.col("s_suppkey") % 4 == 0, "").otherwise(F.concat(F.lit("1.0."), nation)).alias("firmware_version"),
        F.concat(F.lit("Band "), nation, F.lit(" · fw1.0."), F.when(F.col("s_suppkey") % 5 == 0, "99").otherwise(nation)).alias("device_label"),
    )
    return clean.build_devices(_csv(rows, "s_suppkey", DEVICES), people, STUDY)


DEVICES_SQL = f"""
{ROSTER}, devices AS (
  SELECT printf('P%03d', s_suppkey) AS participant_id, printf('FBT-%04d-%08X', s_suppkey, s_suppkey) AS device_id, 'wrist' AS wear_site, CASE WHEN s_suppkey % 6 = 0 THEN DATE '2026-01-20' ELSE DATE '2025-12-01' END AS calibration_date,
         '1.0.' || CASE WHEN s_suppkey % 20 = 0 THEN '99' ELSE s_nationkey::VARCHAR END AS firmware_version, CASE WHEN s_suppkey % 4 = 0 THEN 'device_label' ELSE 'firmware_version' END AS firmware_source,
         'Band ' || s_nationkey AS device_model, 'Band ' || s_nationkey || ' · fw1.0.' || CASE WHEN s_suppkey % 5 = 0 THEN '99' ELSE s_nationkey::VARCHAR END AS device_label
  FROM supplier WHERE printf('P%03d', s_suppkey) IN (SELECT participant_id FROM roster))
"""


@query(f"WITH {DEVICES_SQL} SELECT * FROM devices")
def export_devices(customer, supplier):
    """Devices of known participants; a blank version comes from the label."""
    return _devices(supplier, _roster(customer)[0])[0]


@query(f"""
WITH {ROSTER}, found AS (
  SELECT 'firmware_label_conflict' AS rule, 'error' AS severity, count(*) FILTER (WHERE s_suppkey % 5 = 0 AND s_suppkey % 4 <> 0) AS n_affected FROM supplier
  UNION ALL SELECT 'firmware_backfilled_from_label', 'warn', count(*) FILTER (WHERE s_suppkey % 4 = 0) FROM supplier
  UNION ALL SELECT 'calibration_after_study_start', 'error', count(*) FILTER (WHERE s_suppkey % 6 = 0) FROM supplier
  UNION ALL SELECT 'device_orphan_participant', 'error', count(*) FILTER (WHERE printf('P%03d', s_suppkey) NOT IN (SELECT participant_id FROM roster)) FROM supplier)
SELECT * FROM found WHERE n_affected > 0
""")
def export_devices_checks(customer, supplier):
    """Conflicts and gaps of versions, late calibrations and devices of nobody, over all landed rows."""
    return _devices(supplier, _roster(customer)[0])[1].select("rule", "severity", "n_affected")


@query(f"""
WITH {DEVICES_SQL}
SELECT r.participant_id, r.chronotype AS chronotype_declared, d.device_model, d.firmware_version FROM roster r LEFT JOIN devices d USING (participant_id, device_id)
""")
def export_participant_devices(customer, supplier):
    """The roster with its devices: nobody goes who has none."""
    people = _roster(customer)[0]
    return model.participant_devices(people, _devices(supplier, people)[0]).select("participant_id", "chronotype_declared", "device_model", "firmware_version")


def _survey(orders: DataFrame, customer: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = orders.select(
        "o_orderkey",
        _who(F.col("o_custkey") % 110).alias("participant_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        *[(F.col("o_orderkey") % k).cast("string").alias(c) for c, k in zip(SURVEY[2:], (7, 5, 12, 6), strict=True)],
    )
    return clean.build_survey(_csv(rows, "o_orderkey", SURVEY), _roster(customer)[0], STUDY)


ANSWERS = f"""
{ROSTER}, answers AS (
  SELECT printf('P%03d', o_custkey % 110) AS participant_id, CAST(o_orderdate AS DATE) AS date, CAST(o_orderkey % 7 AS SMALLINT) AS fatigue_score, CAST(o_orderkey % 5 AS SMALLINT) AS stress_score,
         CAST(o_orderkey % 12 AS SMALLINT) AS readiness_score, CAST(o_orderkey % 6 AS SMALLINT) AS sleep_quality_score, row_number() OVER (PARTITION BY o_custkey % 110, o_orderdate::DATE ORDER BY o_orderkey) AS k
  FROM orders)
"""


@query(f"WITH {ANSWERS} SELECT * EXCLUDE (k), NULL AS reject_reason FROM answers WHERE k = 1 AND participant_id IN (SELECT participant_id FROM roster) UNION ALL SELECT * EXCLUDE (k), 'orphan_participant' FROM answers WHERE participant_id NOT IN (SELECT participant_id FROM roster)")
def export_survey(orders, customer):
    """Answers of known participants, the first of a day by its place in the file, and the rejected ones."""
    single, rejected, _ = _survey(orders, customer)
    return single.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(rejected)


@query(f"""
WITH {ANSWERS}, found AS (
  SELECT 'fatigue_score_out_of_range' AS rule, 'error' AS severity, count(*) FILTER (WHERE fatigue_score NOT BETWEEN 1 AND 5) AS n_affected FROM answers
  UNION ALL SELECT 'stress_score_out_of_range', 'error', count(*) FILTER (WHERE stress_score NOT BETWEEN 1 AND 5) FROM answers
  UNION ALL SELECT 'readiness_score_out_of_range', 'error', count(*) FILTER (WHERE readiness_score NOT BETWEEN 0 AND 10) FROM answers
  UNION ALL SELECT 'sleep_quality_score_out_of_range', 'error', count(*) FILTER (WHERE sleep_quality_score NOT BETWEEN 1 AND 5) FROM answers
  UNION ALL SELECT 'survey_orphan_participant', 'error', count(*) FILTER (WHERE participant_id NOT IN (SELECT participant_id FROM roster)) FROM answers
  UNION ALL SELECT 'duplicate_survey_response', 'error', count(*) FILTER (WHERE k > 1) FROM answers)
SELECT * FROM found WHERE n_affected > 0
""")
def export_survey_checks(orders, customer):
    """Scores outside their scales, orphans and later answers, counted over all landed rows."""
    return _survey(orders, customer)[2].select("rule", "severity", "n_affected")


LABELLED = f"""
{NIGHTS}, {ROSTER},
slept AS (SELECT conv_id, 82800 + 30 * max(upto) FILTER (WHERE stage <> 'awake') AS mid FROM timed GROUP BY conv_id),
hours AS (SELECT printf('P%03d', conv_id % 100) AS participant_id, (CASE WHEN mid % 86400 >= 43200 THEN mid % 86400 - 86400 ELSE mid % 86400 END) / 3600.0::DOUBLE AS h FROM slept JOIN nights USING (conv_id) WHERE reject_reason IS NULL),
each_one AS (SELECT participant_id, any_value(chronotype) AS declared, median(sign(h) * floor(abs(h) * 1000 + 0.5) / 1000) AS m FROM hours LEFT JOIN roster USING (participant_id) GROUP BY participant_id),
cut AS (SELECT median(m) AS threshold FROM each_one),
sided AS (SELECT *, CASE WHEN m <= threshold THEN 'A' ELSE 'B' END AS derived FROM each_one CROSS JOIN cut)
"""


def _validation(conversations: DataFrame, customer: DataFrame) -> DataFrame:
    who = "participant_id"
    people = _roster(customer)[0].select(who, F.col("chronotype").alias("chronotype_declared"))
    hour = X.scaled_round(F.col("mid_sleep_hour_signed"), 3).alias("mid_sleep_hour")
    nights = _nights(conversations)[0].select(who, hour, F.lit(True).alias("has_sleep_session"))
    return analytics.chronotype_validation(nights.join(people, who, "left"))


@query(f"""
WITH {LABELLED}
SELECT declared AS chronotype_declared, derived AS chronotype_derived, count(*) AS n_participants, round(round(min(m), 6), 3) AS mid_sleep_median_min, round(round(avg(m), 6), 3) AS mid_sleep_median_mean,
       round(round(max(m), 6), 3) AS mid_sleep_median_max, round(round(max(threshold), 6), 3) AS split_threshold_hour, declared = derived AS agrees FROM sided GROUP BY declared, derived
""")
def export_chronotype_validation(conversations, customer):
    """Declared chronotypes against a split of the mid-sleep of landed nights; people who aren't on the roster have none declared."""
    return _validation(conversations, customer)


@query(f"""
WITH {LABELLED}
SELECT coalesce(sum(CASE WHEN declared = derived THEN 1 END), 0)::BIGINT AS agree, count(*) AS "of", CASE WHEN count(*) > 0 THEN coalesce(sum(CASE WHEN declared = derived THEN 1 END), 0) * 100.0::DOUBLE / count(*) END AS agree_pct FROM sided
""")
def export_chronotype_agreement(conversations, customer):
    """How many derived labels are the declared ones."""
    return quality.agreement(_validation(conversations, customer))
