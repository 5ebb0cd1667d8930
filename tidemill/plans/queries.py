"""Queries over the driver's tables, by name, and their SQL.

Each applies the library's operators to whole tables; users stand for participants, events
for minutes, conversations for sleep stages, customers and orders for rosters and devices.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions import exprs as X
from tidemill.operators import checks as K
from tidemill.operators import profile as P
from tidemill.operators import rules as R
from tidemill.plans import analytics as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

START, END = date(2024, 1, 1), date(2024, 1, 30)


def query(sql: str | None = None) -> Callable:
    """Register a query (of the tables that its arguments name) and its SQL."""

    def put(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        names = f.__code__.co_varnames[: f.__code__.co_argcount]
        QUERIES[f.__name__] = lambda spark, sf_dir: f(*[spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names])
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def _n(x, name: str):
    return x.cast("long").alias(name)


def _daily(events: DataFrame) -> DataFrame:
    """A user's day: what the weekly and cohort queries are built on."""
    day = events.withColumns({"date": F.to_date("ts"), "cohort": F.when(F.col("user_id") % 2 == 0, "A").otherwise("B")})
    return day.groupBy("user_id", "cohort", "date").agg(
        F.count("*").alias("n_events"),
        X.scaled_round(F.sum("value"), 4).alias("total"),
        (F.count("*") >= 3).alias("is_complete_day"),
        F.count_if(F.col("event_type") == "error").alias("n_errors"),
        X.study_week(F.col("date"), START).alias("study_week"),
    )


DAILY = """
daily AS (
  SELECT user_id, CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS cohort, CAST(ts AS DATE) AS date,
         count(*) AS n_events, round(sum(value), 4) AS total, count(*) >= 3 AS is_complete_day,
         count(*) FILTER (WHERE event_type = 'error') AS n_errors,
         CAST(1 + (CAST(ts AS DATE) - DATE '2024-01-01') / 7 AS INTEGER) AS study_week
  FROM events GROUP BY ALL)
"""


@query("""
SELECT user_id, CAST(ts AS DATE) AS date, round(sum(value), 3) AS value_total,
       count(*) FILTER (WHERE value > 50) AS active, max(value) AS peak,
       CASE WHEN sum(value) > 0 THEN round(sum(value * (hour(ts) + minute(ts) / 60.0)) / sum(value), 3) END AS midpoint_hour
FROM events GROUP BY ALL
""")
def daily_activity(events):
    return events.groupBy("user_id", F.to_date("ts").alias("date")).agg(
        X.scaled_round(F.sum("value"), 3).alias("value_total"),
        F.count_if(F.col("value") > 50).alias("active"),
        F.max("value").alias("peak"),
        F.when(F.sum("value") > 0, X.scaled_round(F.sum(F.col("value") * X.clock_hour(F.col("ts"))) / F.sum("value"), 3)).alias("midpoint_hour"),
    )


@query("""
SELECT user_id, round(avg(value) FILTER (WHERE event_type <> 'error'), 1) AS mean_value,
       min(value) FILTER (WHERE event_type <> 'error') AS min_value, max(value) FILTER (WHERE event_type <> 'error') AS max_value,
       round(round(quantile_cont(value, 0.05) FILTER (WHERE event_type <> 'error'), 6), 1) AS resting_value,
       count(*) FILTER (WHERE event_type = 'error') AS n_error
FROM events GROUP BY user_id
""")
def hr_daily_filtered(events):
    x = F.when(F.col("event_type") != "error", F.col("value"))
    return events.groupBy("user_id").agg(
        # A sum of doubles depends on the order of the rows, and a tie would turn with it; nine digits are beyond the sum's error.
        X.snapped_round(F.avg(x), 1, snap=9).alias("mean_value"),
        F.min(x).alias("min_value"),
        F.max(x).alias("max_value"),
        X.snapped_round(F.percentile(x, 0.05), 1).alias("resting_value"),
        F.count_if(F.col("event_type") == "error").alias("n_error"),
    )


@query("""
SELECT CAST(1 + (CAST(ts AS DATE) - DATE '2024-01-01') / 7 AS INTEGER) AS study_week,
       CAST(floor((CAST(ts AS DATE) - DATE '2024-01-01') / 7) + 1 AS INTEGER) AS calendar_week,
       count(*) AS n, min(CAST(ts AS DATE)) AS first_day, max(CAST(ts AS DATE)) AS last_day
FROM events GROUP BY 1, 2
""")
def study_week_rounding(events):
    day = F.to_date("ts")
    return events.groupBy(X.study_week(day, START).alias("study_week"), X.calendar_week(day, START).alias("calendar_week")).agg(F.count("*").alias("n"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))


@query("""
SELECT event_id, date_trunc('minute', ts - INTERVAL 5 HOUR) AS local_minute, extract(second FROM ts) <> 0 AS was_off_minute
FROM events
""")
def utc_shift_snap_minute(events):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    df = events.select("event_id", text.alias("timestamp")).transform(R.normalise_clock, "-05:00").transform(R.snap_to_minute)
    return df.select("event_id", F.col("timestamp").alias("local_minute"), "was_off_minute")


@query("""
WITH t AS (SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN event_id % 2 = 0 THEN 'Z' ELSE '' END || CASE WHEN event_id % 101 = 0 THEN '?' ELSE '' END AS s FROM events)
SELECT event_id, CASE WHEN s LIKE '%Z' THEN try_cast(rtrim(s, 'Z') AS TIMESTAMP) - INTERVAL 5 HOUR ELSE try_cast(s AS TIMESTAMP) END AS local,
       s LIKE '%Z' AS was_utc, try_cast(rtrim(s, 'Z') AS TIMESTAMP) IS NULL AS was_unparseable
FROM t
""")
def iso_string_parse_mixed(events):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("event_id") % 2 == 0, "Z").otherwise(""), F.when(F.col("event_id") % 101 == 0, "?").otherwise(""))
    df = events.select("event_id", text.alias("timestamp")).transform(R.normalise_clock, "-05:00")
    return df.select("event_id", F.col("timestamp").alias("local"), "was_utc", "was_unparseable")


UNITS = {"view": 1, "click": 1, "purchase": 60, "signup": 60}


@query("""
SELECT event_id, CASE WHEN event_type <> 'error' THEN value / CASE WHEN event_type IN ('purchase', 'signup') THEN 60.0 ELSE 1.0 END END AS value,
       event_type IN ('purchase', 'signup') AS was_rescaled, event_type = 'error' AS unit_unknown
FROM events
""")
def unit_rescale_map(events):
    df = events.select("event_id", "value", F.concat(F.lit(" "), F.upper("event_type")).alias("unit")).transform(R.rescale_units, "value", UNITS, "unit")
    return df.select("event_id", "value", "was_rescaled", "unit_unknown")


@query("""
SELECT event_id, CASE WHEN NOT (value > 200 OR value < 1 OR round(value) = 77) THEN round(value) END AS value,
       (value > 200 OR value < 1 OR round(value) = 77) AS value_was_invalid
FROM events
""")
def sentinel_null_keep_row(events):
    whole = X.scaled_round(F.col("value"), 0)
    bounded = F.when(F.col("value") > 200, 999.0).when(F.col("value") < 1, -1.0).otherwise(whole)
    df = events.select("event_id", bounded.alias("value")).transform(R.null_invalid, "value", (77, -1), (-5, 200))
    return df.select("event_id", "value", "value_was_invalid")


@query("""
SELECT 'l_quantity' AS "column", count(*) FILTER (WHERE l_quantity NOT BETWEEN 5 AND 45) AS n_outside, min(l_quantity) AS lowest, max(l_quantity) AS highest FROM lineitem
UNION ALL SELECT 'l_discount', count(*) FILTER (WHERE l_discount NOT BETWEEN 0.02 AND 0.08), min(l_discount), max(l_discount) FROM lineitem
""")
def range_check_counts(lineitem):
    return P.range_check(lineitem, "l_quantity", 5, 45).unionByName(P.range_check(lineitem, "l_discount", 0.02, 0.08))


@query("""
SELECT user_id, hour, event_id, n_dropped FROM (
  SELECT user_id, date_trunc('hour', ts) AS hour, event_id, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id) AS k,
         count(*) OVER (PARTITION BY user_id, date_trunc('hour', ts)) - 1 AS n_dropped FROM events) WHERE k = 1
""")
def dedupe_first_seen(events):
    df = events.select("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "event_id")
    return df.transform(R.first_seen, ["user_id", "hour"], ["event_id"]).select("user_id", "hour", "event_id", "n_dropped")


@query("""
SELECT o_orderkey, o_custkey, month, is_duplicated FROM (
  SELECT o_orderkey, o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate)) > 1 AS is_duplicated FROM orders)
""")
def duplicate_all_copies(orders):
    month = F.date_trunc("month", "o_orderdate").cast("date")
    return P.duplicated(orders.select("o_orderkey", "o_custkey", month.alias("month")), ["o_custkey", "month"])


@query("""
WITH s AS (SELECT user_id, ts, event_id, event_type, CASE WHEN event_type = lag(event_type) OVER w AND ts - lag(ts) OVER w <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run_id FROM s)
SELECT user_id, run_id, min(event_type) AS event_type, count(*) AS run_length, min(ts) AS started, max(ts) AS ended, count(*) >= 3 AS is_stuck FROM r GROUP BY user_id, run_id
""")
def rle_runs_gap_aware(events):
    """Runs of equal events without a gap over 6 hours; a user is worked on by day."""
    near = lambda past: F.col("ts") - past("ts") <= F.expr("INTERVAL '6' HOUR")
    df = R.runs(events.select("user_id", "ts", "event_id", "event_type"), "event_type", ["user_id"], ["ts", "event_id"], near, F.to_date("ts"))
    return df.groupBy("user_id", "run_id").agg(F.min("event_type").alias("event_type"), F.count("*").alias("run_length"), F.min("ts").alias("started"), F.max("ts").alias("ended"), (F.count("*") >= 3).alias("is_stuck"))


@query("""
WITH s AS (SELECT conv_id, turn, role, CASE WHEN role = lag(role) OVER w AND turn - lag(turn) OVER w = 1 THEN 0 ELSE 1 END AS new FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
r AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS run_id FROM s)
SELECT conv_id, turn, role, CAST(run_id AS BIGINT) AS run_id, count(*) OVER (PARTITION BY conv_id, run_id) AS run_length FROM r
""")
def flag_stuck_runs(conversations):
    return R.runs(conversations.select("conv_id", "turn", "role"), "role", ["conv_id"], "turn", F.lit(1).cast("long")).select("conv_id", "turn", "role", "run_id", "run_length")


@query("""
WITH s AS (SELECT user_id, event_id, event_type, CASE WHEN event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) THEN 0 ELSE 1 END AS new FROM events),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM s),
l AS (SELECT user_id, run, count(*) AS n FROM r GROUP BY 1, 2)
SELECT CAST(CASE WHEN n <= 1 THEN 0 WHEN n <= 2 THEN 1 WHEN n <= 4 THEN 2 ELSE 3 END AS INTEGER) AS bin, count(*) AS runs, CAST(sum(n) AS BIGINT) AS events FROM l GROUP BY 1
""")
def rle_runs_plain(events):
    """Runs of equal events by length; a user is worked on by 4096 numbers of events at a time."""
    df = R.runs(events.select("user_id", "event_id", "event_type"), "event_type", ["user_id"], "event_id", segment=F.floor(F.col("event_id") / 4096))
    each = df.where("run_start").select(F.col("run_length").alias("n"))
    return each.groupBy(P.bins(F.col("n"), [0, 1, 2, 4, 10**9]).alias("bin")).agg(F.count("*").alias("runs"), _n(F.sum("n"), "events"))


@query("""
SELECT conv_id, string_agg(role, '->' ORDER BY turn) AS stage_order, string_agg(role, '->' ORDER BY turn) LIKE 'system->user->assistant%' AS canonical FROM conversations GROUP BY conv_id
""")
def stage_order_string(conversations):
    order = X.joined_in_order("turn", "role")
    return conversations.groupBy("conv_id").agg(order.alias("stage_order")).withColumn("canonical", F.col("stage_order").startswith("system->user->assistant"))


@query("""
SELECT conv_id, turn, role, lead(role) OVER w AS next_role, coalesce(lead(turn) OVER w - turn = 1, FALSE) AS contiguous FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
""")
def stage_contiguity_lead(conversations):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return conversations.select("conv_id", "turn", "role", F.lead("role").over(w).alias("next_role"), X.true(F.lead("turn").over(w) - F.col("turn") == 1).alias("contiguous"))


KINDS = ["click", "purchase", "view", "refund"]


@query("SELECT user_id, " + ", ".join(f"round(coalesce(sum(value) FILTER (WHERE event_type = '{k}'), 0), 4) AS {k}" for k in KINDS) + " FROM events GROUP BY user_id")
def stage_minutes_pivot(events):
    wide = events.groupBy("user_id").pivot("event_type", KINDS).sum("value").fillna(0.0, KINDS)
    return wide.select("user_id", *[X.scaled_round(F.col(k), 4).alias(k) for k in KINDS])


@query("""
WITH s AS (SELECT l_orderkey, count(*) AS lines, sum(l_quantity) AS qty, sum(l_quantity) FILTER (WHERE l_returnflag <> 'R') AS kept_qty, bool_or(l_discount > 0.09) AS deep_cut FROM lineitem GROUP BY 1),
j AS (SELECT o_orderkey, coalesce(lines, 0) AS lines, qty, coalesce(kept_qty, 0) AS kept_qty, CASE WHEN qty > 0 THEN round(100 * coalesce(kept_qty, 0) / qty, 2) END AS kept_pct, deep_cut FROM orders LEFT JOIN s ON o_orderkey = l_orderkey)
SELECT *, CASE WHEN lines = 0 THEN 'incomplete' WHEN deep_cut THEN 'deep_cut' WHEN kept_pct < 50 THEN 'mostly_returned' END AS reject_reason FROM j
""")
def sleep_like_session(orders, lineitem):
    kept = F.when(F.col("l_returnflag") != "R", F.col("l_quantity"))
    s = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("qty"), F.coalesce(F.sum(kept), F.lit(0.0)).alias("kept_qty"), F.bool_or(F.col("l_discount") > 0.09).alias("deep_cut"))
    j = orders.select("o_orderkey").join(s, "o_orderkey", "left").fillna(0, ["lines", "kept_qty"])
    j = j.withColumn("kept_pct", X.scaled_round(F.try_divide(F.col("kept_qty") * 100.0, F.col("qty")), 2)).select("o_orderkey", "lines", "qty", "kept_qty", "kept_pct", "deep_cut")
    return j.withColumn("reject_reason", F.when(F.col("lines") == 0, "incomplete").when(F.col("deep_cut"), "deep_cut").when(F.col("kept_pct") < 50, "mostly_returned"))


@query("""
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS date, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1, 2),
m AS (SELECT *, a + to_microseconds(CAST(floor((epoch_us(b) - epoch_us(a)) / 2.0) AS BIGINT)) AS mid FROM d)
SELECT user_id, date, round(((hour(mid) + minute(mid) / 60.0 + extract(second FROM mid) / 3600.0 + 12) % 24) - 12, 6) AS mid_hour_signed, round((epoch_us(b) - epoch_us(a)) / 60e6, 4) AS minutes FROM m
""")
def signed_hour_wrap(events):
    d = events.groupBy("user_id", F.to_date("ts").alias("date")).agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    mid = X.midpoint(F.col("a"), F.col("b"))
    return d.select("user_id", "date", X.scaled_round(X.signed_hour(X.clock_hour(mid, seconds=True)), 6).alias("mid_hour_signed"), X.scaled_round(X.minutes_between(F.col("a"), F.col("b")), 4).alias("minutes"))


@query("""
WITH u AS (SELECT DISTINCT user_id FROM events), g AS (SELECT user_id, CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS date FROM u),
c AS (SELECT user_id, CAST(ts AS DATE) AS date, count(DISTINCT date_trunc('hour', ts)) AS hours, count(*) FILTER (WHERE event_type = 'view') AS views FROM events GROUP BY 1, 2)
SELECT g.user_id, g.date, CAST(coalesce(hours, 0) AS INTEGER) AS hours, CAST(coalesce(views, 0) AS INTEGER) AS views, least(coalesce(hours, 0) / 24.0 * 100, coalesce(views, 0) / 4.0 * 100) AS coverage_pct,
       least(coalesce(hours, 0) / 24.0 * 100, coalesce(views, 0) / 4.0 * 100) >= 12.5 AS is_complete_day, coalesce(hours, 0) = 0 AS is_missing_day
FROM g LEFT JOIN c USING (user_id, date)
""")
def coverage_grid(events):
    spine = R.grid(events, START, END, "user_id")
    c = events.groupBy("user_id", F.to_date("ts").alias("date")).agg(F.count_distinct(F.date_trunc("hour", "ts")).cast("int").alias("hours"), F.count_if(F.col("event_type") == "view").cast("int").alias("views"))
    df = spine.join(c, ["user_id", "date"], "left").fillna(0, ["hours", "views"])
    pct = F.least(F.col("hours") / F.lit(24.0) * 100, F.col("views") / F.lit(4.0) * 100)
    return df.withColumns({"coverage_pct": pct, "is_complete_day": pct >= 12.5, "is_missing_day": F.col("hours") == 0})


@query("""
SELECT c_custkey, c_name, n_name, r_name, coalesce(n_orders, 0) AS n_orders, total, first_day, n_orders IS NOT NULL AS has_orders, n_urgent
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total, min(CAST(o_orderdate AS DATE)) AS first_day FROM orders GROUP BY 1) o ON o.o_custkey = c_custkey
LEFT JOIN (SELECT o_custkey, count(*) AS n_urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) u ON u.o_custkey = c_custkey
""")
def spine_star_join(customer, nation, region, orders):
    o = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"), X.scaled_round(F.sum("o_totalprice"), 2).alias("total"), F.min(F.to_date("o_orderdate")).alias("first_day"), F.nullif(F.count_if(F.col("o_orderpriority") == "1-URGENT"), F.lit(0)).alias("n_urgent"))
    df = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").join(o, "c_custkey", "left")
    return df.select("c_custkey", "c_name", "n_name", "r_name", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), "total", "first_day", F.col("n_orders").isNotNull().alias("has_orders"), "n_urgent")


@query("""
SELECT user_id, date, n, bought, spent FROM (SELECT user_id, CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1, 2)
LEFT JOIN (SELECT user_id, CAST(ts AS DATE) AS date, count(*) AS bought, round(sum(value), 4) AS spent FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) USING (user_id, date)
""")
def roster_devices_left(events):
    day = events.withColumn("date", F.to_date("ts"))
    own = day.where("event_type = 'purchase'").groupBy("user_id", "date").agg(F.count("*").alias("bought"), X.scaled_round(F.sum("value"), 4).alias("spent"))
    return day.groupBy("user_id", "date").agg(F.count("*").alias("n")).join(own, ["user_id", "date"], "left")


@query("SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def semi_known(documents, labels):
    return documents.select("doc_id", "lang", "source").join(labels, "doc_id", "left_semi")


@query("SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_orphans(documents, labels):
    return documents.select("doc_id", "lang", "source").join(labels, "doc_id", "left_anti")


@query("""
SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN d.doc_id IS NULL THEN 'right_only' WHEN l.doc_id IS NULL THEN 'left_only' ELSE 'both' END AS indicator
FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id
""")
def outer_indicator(documents, labels):
    return P.key_overlap(documents, labels, "doc_id")


@query("SELECT c_mktsegment, count(*) AS n, round(avg(o_totalprice), 2) AS mean_price FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1")
def inner_using_group(orders, customer):
    named = customer.withColumnRenamed("c_custkey", "o_custkey")
    joined = "SELECT c_mktsegment, count(*) AS n, avg(o_totalprice) AS m FROM {o} JOIN {c} USING (o_custkey) GROUP BY 1"
    return orders.sparkSession.sql(joined, o=orders, c=named).select("c_mktsegment", "n", X.scaled_round(F.col("m"), 2).alias("mean_price"))


@query("""
WITH p AS (SELECT c_nationkey, median(c_acctbal) AS m FROM customer GROUP BY 1), cut AS (SELECT median(m) AS threshold FROM p)
SELECT c_nationkey, round(round(m, 6), 3) AS m, round(round(threshold, 6), 3) AS threshold, CASE WHEN m <= threshold THEN 'A' ELSE 'B' END AS side FROM p CROSS JOIN cut
""")
def cross_scalar_median_split(customer):
    p = P.quantiles(customer, ["c_nationkey"], "c_acctbal", (0.5,)).select("c_nationkey", F.col("value").alias("m"))
    df = p.crossJoin(F.broadcast(P.quantiles(p, [], "m", (0.5,)).select(F.col("value").alias("threshold"))))  # one row
    return df.select("c_nationkey", X.snapped_round(F.col("m"), 3).alias("m"), X.snapped_round(F.col("threshold"), 3).alias("threshold"), F.when(F.col("m") <= F.col("threshold"), "A").otherwise("B").alias("side"))


@query(f"""
WITH {DAILY}
SELECT user_id, study_week, min(date) AS week_start, max(date) AS week_end, any_value(cohort) AS cohort, count(*) AS days_in_week,
       count(*) FILTER (WHERE is_complete_day) AS days_complete, round(avg(n_events) FILTER (WHERE is_complete_day), 1) AS events_mean,
       round(round(stddev_samp(total) FILTER (WHERE is_complete_day), 6), 1) AS total_sd, round(round(avg(total), 6), 2) AS total_mean_all,
       CAST(sum(n_events) FILTER (WHERE is_complete_day) AS BIGINT) AS events_sum, CAST(sum(n_errors) AS BIGINT) AS n_errors
FROM daily GROUP BY user_id, study_week
""")
def weekly_summary_two_denominators(events):
    full = lambda c: F.when(F.col("is_complete_day"), F.col(c))
    return _daily(events).groupBy("user_id", "study_week").agg(
        F.min("date").alias("week_start"),
        F.max("date").alias("week_end"),
        F.max("cohort").alias("cohort"),
        F.count("*").alias("days_in_week"),
        F.count_if("is_complete_day").alias("days_complete"),
        X.scaled_round(F.avg(full("n_events")), 1).alias("events_mean"),
        X.snapped_round(F.stddev_samp(full("total")), 1).alias("total_sd"),
        X.snapped_round(F.avg("total"), 2).alias("total_mean_all"),
        _n(F.sum(full("n_events")), "events_sum"),
        _n(F.sum("n_errors"), "n_errors"),
    )


def _cohorts(events: DataFrame) -> DataFrame:
    sets = _daily(events).groupingSets([["cohort"], ["cohort", "study_week"]], "cohort", "study_week")
    return sets.agg(
        F.when(F.grouping("study_week") == 1, "study").otherwise("week").alias("period_type"),
        F.count_distinct("user_id").alias("n_users"),
        F.count("*").alias("n_days"),
        F.count_if("is_complete_day").alias("n_complete"),
        X.snapped_round(F.avg("total"), 3).alias("total_mean"),
        X.snapped_round(F.median("total"), 3).alias("total_median"),
        X.snapped_round(F.stddev_samp("total"), 3).alias("total_sd"),
    )


COHORTS = """
cohorts AS (
  SELECT cohort, study_week, CASE WHEN grouping(study_week) = 1 THEN 'study' ELSE 'week' END AS period_type, count(DISTINCT user_id) AS n_users, count(*) AS n_days,
         count(*) FILTER (WHERE is_complete_day) AS n_complete, round(round(avg(total), 6), 3) AS total_mean, round(round(median(total), 6), 3) AS total_median, round(round(stddev_samp(total), 6), 3) AS total_sd
  FROM daily GROUP BY GROUPING SETS ((cohort), (cohort, study_week)))
"""


@query(f"WITH {DAILY}, {COHORTS} SELECT * FROM cohorts ORDER BY period_type DESC, study_week NULLS FIRST, cohort")
def cohort_grouping_sets(events):
    return _cohorts(events).orderBy(F.desc("period_type"), F.asc_nulls_first("study_week"), "cohort")


COMPARED = [(1, "Users", "", "n_users"), (2, "Days", "days", "n_days"), (10, "Mean", "value", "total_mean"), (11, "Median", "value", "total_median")]


@query(
    f"WITH {DAILY}, {COHORTS}, s AS (SELECT * FROM cohorts WHERE period_type = 'study'), w AS ("
    + " UNION ALL ".join(f"SELECT {o} AS ord, '{m}' AS metric, '{u}' AS unit, CAST(max({c}) FILTER (WHERE cohort = 'A') AS DOUBLE) AS a, CAST(max({c}) FILTER (WHERE cohort = 'B') AS DOUBLE) AS b FROM s" for o, m, u, c in COMPARED)
    + ") SELECT *, round_even((b - a) * 1000, 0) / 1000 AS delta FROM w"
)
def cohort_pivot_unpivot(events):
    return A.compared(_cohorts(events).where("period_type = 'study'"), F.col("cohort"), COMPARED)


@query(f"WITH {DAILY}, {COHORTS} SELECT study_week, cohort, n_users, n_complete, total_mean FROM cohorts WHERE period_type = 'week'")
def weekly_trend(events):
    return _cohorts(events).where("period_type = 'week'").select("study_week", "cohort", "n_users", "n_complete", "total_mean")


@query(f"""
WITH {DAILY}
SELECT user_id, any_value(cohort) AS cohort, round(round(median(total), 6), 3) AS total_median, round(round(avg(total), 6), 4) AS total_mean, round(avg(n_events) FILTER (WHERE is_complete_day), 4) AS events_mean, count(*) AS days FROM daily GROUP BY user_id
""")
def per_participant_collapse(events):
    d = _daily(events)
    return d.groupBy("user_id").agg(F.max("cohort").alias("cohort"), X.snapped_round(F.median("total"), 3).alias("total_median"), X.snapped_round(F.avg("total"), 4).alias("total_mean"), X.scaled_round(F.avg(F.when(F.col("is_complete_day"), F.col("n_events"))), 4).alias("events_mean"), F.count("*").alias("days"))


TESTED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _effects(lineitem: DataFrame) -> DataFrame:
    return A.effects(A.moments(lineitem, F.col("l_returnflag") == "A", TESTED))


MOMENTS = "WITH m AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS metric, count(*) FILTER (WHERE f) AS n_a, avg({c}) FILTER (WHERE f) AS ma, var_samp({c}) FILTER (WHERE f) AS va, count(*) FILTER (WHERE NOT f) AS n_b, avg({c}) FILTER (WHERE NOT f) AS mb, var_samp({c}) FILTER (WHERE NOT f) AS vb FROM (SELECT *, l_returnflag = 'A' AS f FROM lineitem)"
    for c in TESTED
) + ")"


@query(MOMENTS + """ SELECT metric, n_a, n_b, round(ma, 4) AS mean_a, round(mb, 4) AS mean_b, round(mb - ma, 3) AS diff,
round(round((mb - ma) / sqrt(va / n_a + vb / n_b), 6), 2) AS t, round(round((mb - ma) / sqrt(((n_a - 1) * va + (n_b - 1) * vb) / (n_a + n_b - 2)), 6), 3) AS d FROM m""")
def effect_size_welch(lineitem):
    e = _effects(lineitem)
    return e.select("metric", "n_a", "n_b", *[X.scaled_round(F.col(c), n).alias(c) for c, n in (("mean_a", 4), ("mean_b", 4), ("diff", 3))], X.snapped_round(F.col("t"), 2).alias("t"), X.snapped_round(F.col("d"), 3).alias("d"))


@query(MOMENTS + """, x AS (SELECT metric, least(abs(mb - ma) / sqrt(va / n_a + vb / n_b) / sqrt(2), 4) AS x FROM m)
SELECT metric, round(1 - 2 / sqrt(pi()) * (SELECT sum(CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END * power(x, 2 * k + 1) / (gamma(k + 1) * (2 * k + 1))) FROM generate_series(0, 90) AS g(k)), 4) AS p_approx FROM x""")
def effect_size_p(lineitem):
    """The p of effect_size_welch, by the complementary error function; a row for each of TESTED. The SQL takes its series."""
    return _effects(lineitem).select("metric", X.scaled_round(X.erfc(F.abs("t") / F.sqrt(F.lit(2.0))), 4).alias("p_approx"))


@query(f"WITH {DAILY} SELECT user_id, date, n_events, total FROM daily ORDER BY total DESC, user_id, date LIMIT 10")
def topk_days(events):
    return _daily(events).select("user_id", "date", "n_events", "total").orderBy(F.desc("total"), "user_id", "date").limit(10)


@query("SELECT DISTINCT user_id, event_type FROM events")
def distinct_pairs(events):
    return events.select("user_id", "event_type").distinct()


@query("SELECT count(*) FILTER (WHERE event_type = 'error') AS errors, count(*) FILTER (WHERE value > 200) AS high, count(*) FILTER (WHERE value > 200 AND event_type = 'error') AS \"both\" FROM events")
def flag_sums(events):
    error, high = F.col("event_type") == "error", F.col("value") > 200
    return events.agg(F.count_if(error).alias("errors"), F.count_if(high).alias("high"), F.count_if(error & high).alias("both"))


@query("""
SELECT "table", rule, severity, n_affected FROM (
  SELECT o_orderpriority AS "table", 'status_' || o_orderstatus AS rule, CASE o_orderstatus WHEN 'F' THEN 'error' WHEN 'O' THEN 'warn' ELSE 'info' END AS severity, count(*) AS n_affected FROM orders GROUP BY 1, 2, 3)
ORDER BY CASE severity WHEN 'error' THEN 1 WHEN 'warn' THEN 2 ELSE 4 END, 1, 2
""")
def severity_rank_sort(orders):
    severity = F.when(F.col("o_orderstatus") == "F", "error").when(F.col("o_orderstatus") == "O", "warn").otherwise("info")
    df = orders.groupBy(F.col("o_orderpriority").alias("table"), F.concat(F.lit("status_"), "o_orderstatus").alias("rule"), severity.alias("severity")).agg(F.count("*").alias("n_affected"))
    return K.by_severity(df)


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def value_counts(lineitem):
    return P.value_counts(lineitem, "l_returnflag", "l_linestatus")


def _profile_sql(table: str, columns: dict[str, bool]) -> str:
    one = "SELECT '{c}' AS \"column\", count({c}) AS non_null, round(100.0 * (count(*) - count({c})) / count(*), 2) AS null_pct, count(DISTINCT {c}) AS n_unique, CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max, {m} AS mean, {o} AS mode FROM {t}"
    mode = "(SELECT CAST({c} AS VARCHAR) FROM {t} GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
    return " UNION ALL ".join(one.format(c=c, t=table, m=f"round(avg({c}), 6)" if number else "CAST(NULL AS DOUBLE)", o="CAST(NULL AS VARCHAR)" if number else mode.format(c=c, t=table)) for c, number in columns.items())


@query(_profile_sql("part", {"p_partkey": True, "p_brand": False, "p_type": False, "p_size": True}))
def column_profile(part):
    return P.profile(part.select("p_partkey", "p_brand", "p_type", "p_size")).withColumn("mean", X.scaled_round(F.col("mean"), 6))


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, max({c}) AS max FROM lineitem" for c in TESTED))
def describe_exact(lineitem):
    d = P.describe(lineitem, TESTED)
    return d.withColumns({c: X.scaled_round(F.col(c), 4) for c in ("mean", "std")})


@query("SELECT lang, round(quantile_cont(n_chars, 0.01), 4) AS q01, round(quantile_cont(n_chars, 0.5), 4) AS q50, round(quantile_cont(n_chars, 0.99), 4) AS q99 FROM documents GROUP BY lang")
def quantiles_exact(documents):
    names = {0.01: "q01", 0.5: "q50", 0.99: "q99"}
    found = P.quantiles(documents, ["lang"], "n_chars", tuple(names))
    return found.groupBy("lang").agg(*[X.scaled_round(F.max(F.when(F.col("q") == q, F.col("value"))), 4).alias(n) for q, n in names.items()])


@query("SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem GROUP BY 1")
def corr_metric(lineitem):
    return lineitem.groupBy("l_returnflag").agg(X.scaled_round(F.corr("l_quantity", "l_extendedprice"), 6).alias("r"))


EDGES = [0, 100, 500, 1000, 2000, 5000, 10**9]


@query("SELECT CAST(CASE " + " ".join(f"WHEN n_chars > {a} AND n_chars <= {b} THEN {i}" for i, (a, b) in enumerate(zip(EDGES, EDGES[1:], strict=False))) + " END AS INTEGER) AS bin, count(*) AS n FROM documents GROUP BY 1")
def hist_bins(documents):
    return documents.groupBy(P.bins(F.col("n_chars"), EDGES).alias("bin")).agg(F.count("*").alias("n"))


FLAGS = ["A", "N", "R"]


@query("SELECT l_linestatus, " + ", ".join(f"count(*) FILTER (WHERE l_returnflag = '{f}') AS \"{f}\"" for f in FLAGS) + " FROM lineitem GROUP BY 1")
def pivot_counts(lineitem):
    return P.pivot_count(lineitem, "l_linestatus", "l_returnflag", FLAGS)


@query("SELECT p_brand, p_size FROM (SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 1), (SELECT p_size FROM part GROUP BY 1 ORDER BY count(*) DESC, p_size LIMIT 1)")
def modal_row(part):
    return P.modal(part, ["p_brand", "p_size"])


@query("""
SELECT o_custkey, coalesce(l, 0) AS n_lines, n AS n_orders FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
LEFT JOIN (SELECT o_custkey, count(*) AS l FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1) USING (o_custkey)
""")
def coverage_matrix(orders, lineitem):
    lines = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey")
    return P.coverage_matrix(orders, "o_custkey", {"n_lines": lines, "n_orders": orders.select("o_custkey")})


@query("""
SELECT p_partkey, coalesce(nullif(b, ''), nullif(regexp_extract(p_brand, 'Brand#(\\d+)', 1), '')) AS brand_no, CASE WHEN nullif(b, '') IS NOT NULL THEN 'column' WHEN regexp_extract(p_brand, 'Brand#(\\d+)', 1) <> '' THEN 'label' END AS brand_source, split_part(p_brand, '#', 1) AS maker
FROM (SELECT *, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'own' || p_size END AS b FROM part)
""")
def regex_extract_backfill(part):
    own = F.nullif(F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.concat(F.lit("own"), F.col("p_size").cast("string"))), F.lit(""))
    label = F.nullif(F.regexp_extract("p_brand", r"Brand#(\d+)", 1), F.lit(""))
    return part.select("p_partkey", F.coalesce(own, label).alias("brand_no"), F.when(own.isNotNull(), "column").when(label.isNotNull(), "label").alias("brand_source"), F.split("p_brand", "#")[0].alias("maker"))


@query("SELECT count(*) FILTER (WHERE NOT regexp_full_match(c_name, 'Customer#[0-9]{9}')) AS malformed, count(*) FILTER (WHERE regexp_extract(c_name, '#0*([0-9]+)$', 1) <> CAST(c_custkey AS VARCHAR)) AS other_number, count(*) AS n FROM customer")
def regex_validate_ids(customer):
    number = F.regexp_extract("c_name", "#0*([0-9]+)$", 1)
    return customer.agg(F.count_if(~F.col("c_name").rlike("^Customer#[0-9]{9}$")).alias("malformed"), F.count_if(number != F.col("c_custkey").cast("string")).alias("other_number"), F.count("*").alias("n"))


@query("SELECT event_id, CAST(props->>'k' AS BIGINT) AS k FROM events")
def json_props_extract(events):
    return events.select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


@query("SELECT 'k' AS field, count(*) AS n, count(DISTINCT user_id) AS users FROM events WHERE json_exists(props, 'k')")
def undocumented_keys(events):
    fields = F.map_keys(F.from_json("props", "map<string,string>"))
    extra = events.select("user_id", F.explode(F.array_except(fields, F.array(F.lit("value"), F.lit("unit")))).alias("field"))
    return extra.groupBy("field").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query("SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, embedding[i] AS x FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)")
def explode_with_index(embeddings):
    return embeddings.select("vec_id", F.posexplode("embedding").alias("pos", "x"))


@query("SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier")
def union_by_name_missing(customer, supplier):
    c = customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    s = supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return c.unionByName(s, allowMissingColumns=True)


@query("""
WITH d AS (SELECT DISTINCT event_type, CAST(user_id AS VARCHAR) AS u FROM events WHERE value > 150), r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY u) AS k, count(*) OVER (PARTITION BY event_type) AS n FROM d)
SELECT event_type, string_agg(u, ', ' ORDER BY u) FILTER (WHERE k <= 12) || CASE WHEN any_value(n) > 12 THEN ' +' || (any_value(n) - 12) || ' more' ELSE '' END AS participants FROM r GROUP BY event_type
""")
def pid_preview(events):
    some = events.where("value > 150").select("event_type", F.col("user_id").cast("string").alias("u")).distinct()
    return K.preview(some, "event_type", "u").withColumnRenamed("names", "participants")


@query("SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1)")
def unique_key_check(lineitem):
    return lineitem.groupBy("l_orderkey", "l_partkey").count().where("count > 1").agg(_n(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)), "n"))


@query("SELECT count(*) AS n_rows, count(DISTINCT user_id) * 30 AS n_expected FROM (SELECT DISTINCT user_id FROM events), generate_series(1, 30)")
def row_count_grid(events):
    g = R.grid(events, START, END, "user_id")
    return g.agg(F.count("*").alias("n_rows"), (F.count_distinct("user_id") * 30).alias("n_expected"))


@query("""
SELECT 'order without customer' AS rule, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'customer without order', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
""")
def fk_check(orders, customer):
    known, used = customer.select(F.col("c_custkey").alias("o_custkey")), orders.select(F.col("o_custkey").alias("c_custkey"))
    one = orders.join(known, "o_custkey", "left_anti").agg(F.count("*").alias("n")).select(F.lit("order without customer").alias("rule"), "n")
    two = customer.join(used, "c_custkey", "left_anti").agg(F.count("*").alias("n")).select(F.lit("customer without order").alias("rule"), "n")
    return one.unionByName(two)


@query("""
WITH c AS (SELECT 'events' AS "table", 'value_out_of_range' AS rule, 'error' AS severity, count(*) FILTER (WHERE value > 300) AS n_affected, 'value over 300' AS detail FROM events
UNION ALL SELECT 'events', 'error_event', 'warn', count(*) FILTER (WHERE event_type = 'error'), 'the event is an error' FROM events UNION ALL SELECT 'events', 'rows', 'info', count(*), 'all rows' FROM events)
SELECT * FROM c WHERE n_affected > 0
""")
def dq_checks_table(events):
    found = [
        K.Check("value_out_of_range", "error", F.col("value") > 300, "value over 300"),
        K.Check("error_event", "warn", F.col("event_type") == "error", "the event is an error"),
        K.Check("never", "error", F.col("value") < 0, "negative"),
        K.Check("rows", "info", F.lit(1), "all rows", always=True),
    ]
    return K.evaluate(events, "events", found, who="user_id").drop("participants")


@query("SELECT event_id FROM events WHERE value IS NOT NULL AND (event_type IN ('view', 'click') OR event_type IS NULL) AND value BETWEEN 10 AND 20")
def null_safe_membership(events):
    keep = X.is_in(F.col("event_type"), ["view", "click"]) | F.col("event_type").isNull()
    return events.where(keep & ~X.outside(F.col("value"), 10, 20)).select("event_id")


@query("SELECT round_even(value, 0) AS even, count(*) AS n, round(sum(round(value, 1)), 1) AS away FROM events GROUP BY 1")
def rounding_rules(events):
    return events.groupBy(X.even_round(F.col("value")).alias("even")).agg(F.count("*").alias("n"), X.scaled_round(F.sum(X.scaled_round(F.col("value"), 1)), 1).alias("away"))


@query("SELECT event_id, user_id, value FROM events ORDER BY event_id LIMIT 25")
def limit_preview(events):
    return events.select("event_id", "user_id", "value").orderBy("event_id").limit(25)


@query("SELECT * FROM events ORDER BY md5('11|' || event_id), event_id LIMIT 100")
def sample_rows(events):
    """A sample of 100 rows, by a seed."""
    return P.sample(events, 100, ["event_id"], 11)


@query("SELECT n_nationkey, n_name FROM nation EXCEPT SELECT n_nationkey, n_name FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE c_acctbal > 9900")
def key_set_difference(nation, customer):
    rich = nation.join(customer.where("c_acctbal > 9900"), F.col("c_nationkey") == F.col("n_nationkey")).select("n_nationkey", "n_name")
    return nation.select("n_nationkey", "n_name").exceptAll(rich.distinct())


def _scratch(spark: SparkSession) -> str:
    import tempfile
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir isn't set: executors need a folder that they share")
        base = tempfile.mkdtemp(prefix="tidemill-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/tidemill/{uuid.uuid4().hex}"


@query("SELECT n_nationkey::VARCHAR AS n_nationkey, CASE WHEN n_nationkey % 5 <> 0 THEN n_name END AS n_name FROM nation")
def csv_roundtrip_na_tokens(nation):
    from tidemill.sources.files import read_csv

    path = _scratch(nation.sparkSession)
    marked = F.when(F.col("n_nationkey") % 5 == 0, F.when(F.col("n_nationkey") % 2 == 0, "NA").otherwise("nan")).otherwise(F.col("n_name"))
    nation.select("n_nationkey", marked.alias("n_name")).write.csv(path, header=True)
    return read_csv(nation.sparkSession, path, ["n_nationkey", "n_name"])


@query("""
SELECT CAST(ts AS DATE) AS date, count(*) AS n, CASE WHEN CAST(ts AS DATE) < DATE '2024-01-08' THEN 'first' ELSE 'second' END AS written FROM events GROUP BY ALL
""")
def parquet_dynamic_overwrite(events):
    from tidemill.sources.files import read_table
    from tidemill.sources.sinks import write_table

    spark, base = events.sparkSession, _scratch(events.sparkSession)
    counts = events.groupBy(F.to_date("ts").alias("date")).agg(F.count("*").alias("n"))
    write_table(counts.withColumn("written", F.lit("first")), base, "days", ("date",))
    write_table(counts.where("date >= DATE '2024-01-08'").withColumn("written", F.lit("second")), base, "days", ("date",))
    return read_table(spark, base, "days").select("date", "n", "written")


@query("SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1")
def overwrite_whole_table(nation):
    """A table without partitions has the last write's rows alone."""
    from tidemill.sources.files import read_table
    from tidemill.sources.sinks import write_table

    base = _scratch(nation.sparkSession)
    write_table(nation.select("n_nationkey"), base, "counts")
    write_table(nation.groupBy("n_regionkey").agg(F.count("*").alias("n")), base, "counts")
    return read_table(nation.sparkSession, base, "counts")


@query("SELECT s_suppkey, s_acctbal, 'negative_balance' AS reject_reason FROM supplier WHERE s_acctbal < 0")
def quarantine_sink(supplier):
    """Rejected rows with the reason, read back from quarantine; a table without any has no folder there."""
    from tidemill.sources.files import exists, join, read_table
    from tidemill.sources.sinks import write_quarantine

    spark, base = supplier.sparkSession, _scratch(supplier.sparkSession)
    bad = supplier.select("s_suppkey", "s_acctbal", F.when(F.col("s_acctbal") < 0, "negative_balance").alias("reject_reason")).where("reject_reason IS NOT NULL")
    if write_quarantine(bad.where("s_suppkey < 0"), base, "none") or exists(spark, join(base, "_quarantine", "none")):
        raise AssertionError("nothing was rejected, but there is a table")
    return read_table(spark, join(base, "_quarantine"), "suppliers") if write_quarantine(bad, base, "suppliers") else bad


@query("SELECT r_regionkey::VARCHAR AS r_regionkey, r_name, CASE WHEN r_regionkey <> 2 THEN 'a, \"b\"' END AS note FROM region")
def csv_sink(region):
    """A small result as one CSV file, read back with blanks as the only nulls."""
    from tidemill.sources.files import join
    from tidemill.sources.sinks import write_csv

    path = join(_scratch(region.sparkSession), "regions.csv")
    write_csv(region.select("r_regionkey", "r_name", F.when(F.col("r_regionkey") != 2, 'a, "b"').alias("note")), path)
    rows = region.sparkSession.read.csv(path, header=True, schema="r_regionkey string, r_name string, note string", escape='"')
    return rows.withColumn("note", F.nullif("note", F.lit("")))


@query("SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1998-01-01' GROUP BY 1")
def registered_views(orders):
    """A frame as a view of its name whose text dates are dates."""
    from tidemill.sources.files import register

    register({"tidemill_days": orders.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))})
    return orders.sparkSession.sql("SELECT date, count(*) AS n FROM tidemill_days WHERE date >= DATE '1998-01-01' GROUP BY date")


@query("SELECT user_id, CAST(ts AS DATE) AS date, CAST(sum(round_even(value, 0)) AS BIGINT) AS steps_total, count(*) FILTER (WHERE value > 0) AS active_minutes FROM (SELECT DISTINCT ON (user_id, date_trunc('minute', ts)) * FROM events ORDER BY user_id, date_trunc('minute', ts), event_id) GROUP BY ALL")
def batch_daily_after_dedupe(events):
    df = events.withColumn("minute", X.floor_minute(F.col("ts"))).transform(R.first_seen, ["user_id", "minute"], ["event_id"])
    return df.groupBy("user_id", F.to_date("ts").alias("date")).agg(_n(F.sum(X.even_round(F.col("value"))), "steps_total"), F.count_if(F.col("value") > 0).alias("active_minutes"))


@query("""
WITH m AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM m)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS "end", count(*) AS n FROM s GROUP BY user_id, k
""")
def streaming_sessions(events):
    """Bursts of a user's events without a gap of 6 hours, from a stream over the table of events."""
    from tidemill.streaming.events import sessions

    spark, base = events.sparkSession, _scratch(events.sparkSession)
    events.select("user_id", F.col("ts").cast("timestamp").alias("at")).write.parquet(f"{base}/in")
    stream = spark.readStream.schema("user_id long, at timestamp").parquet(f"{base}/in")
    found = sessions(stream, "user_id", "at", "6 hours")
    # Complete, not append: the table ends, and so do sessions that the watermark hasn't passed.
    written = found.writeStream.outputMode("complete").foreachBatch(lambda rows, _: rows.write.mode("overwrite").parquet(f"{base}/out"))
    written.option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.schema("user_id long, start timestamp, end timestamp, n long").parquet(f"{base}/out")
    return out.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")
