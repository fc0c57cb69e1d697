"""Registered queries: the run ledger and operations questions.

The ``events`` table is read as a run log: every event is one run of job
``job_<user_id>`` (component = event_type), starting at ``ts`` and lasting
``value`` seconds; ``error`` runs failed, with a message picked from the run's
``k`` property.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ops as O
from .catalog import Tables, register

# Fixed failure messages of the ops example.
MSG_TIMEOUT, MSG_MISSING, MSG_SCHEMA = "Connection timeout", "File not found", "Schema mismatch"


def runs(t):
    e = t.events
    k = F.get_json_object("props", "$.k").cast("int")
    failed = F.col("event_type") == "error"
    return e.select(
        F.col("event_id").alias("run_id"),
        F.concat(F.lit("job_"), F.col("user_id").cast("string")).alias("job"),
        F.col("event_type").alias("component"),
        F.col("ts").alias("start_ts"),
        F.timestamp_add("MILLISECOND", F.round(F.col("value") * 1000).cast("bigint"), F.col("ts")).alias("end_ts"),
        F.col("value").cast("decimal(18,2)").alias("duration_s"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        (k * 100).cast("bigint").alias("rows_processed"),
        F.when(~failed, F.lit(None)).when(k < 30, MSG_TIMEOUT).when(k < 60, MSG_MISSING)
         .otherwise(MSG_SCHEMA).alias("message"))


RUNS_SQL = f"""runs AS (SELECT event_id AS run_id, 'job_' || CAST(user_id AS VARCHAR) AS job, event_type AS component,
  ts AS start_ts, ts + to_milliseconds(CAST(ROUND(value * 1000) AS BIGINT)) AS end_ts,
  CAST(value AS DECIMAL(18,2)) AS duration_s,
  CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) * 100 AS BIGINT) AS rows_processed,
  CASE WHEN event_type <> 'error' THEN NULL
       WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 30 THEN '{MSG_TIMEOUT}'
       WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 60 THEN '{MSG_MISSING}'
       ELSE '{MSG_SCHEMA}' END AS message FROM events)"""


def ledger_events(t):
    """Start and end events per run, as the ledger writer appends them."""
    r = runs(t)
    trace = F.concat(F.lit("tr_"), F.col("job"), F.lit("_"), F.to_date("start_ts").cast("string"))
    start = r.select("run_id", F.col("start_ts").alias("event_ts"), F.col("component"), F.col("job").alias("entity"),
                     trace.alias("trace_id"), F.lit("RUNNING").alias("status"))
    end = r.select("run_id", F.col("end_ts").alias("event_ts"), F.lit(None).cast("string").alias("component"),
                   F.lit(None).cast("string").alias("entity"), F.lit(None).cast("string").alias("trace_id"), "status")
    return start.unionByName(end)


@register("run_fold", ops=("G6",), sql=f"""WITH {RUNS_SQL}
SELECT run_id, start_ts, end_ts, component, job AS entity,
  'tr_' || job || '_' || CAST(CAST(start_ts AS DATE) AS VARCHAR) AS trace_id, status FROM runs""")
def run_fold(spark, sf):
    return O.fold_runs(ledger_events(Tables(spark, sf)))


@register("run_latest_status", ops=("W2",), sql=f"""WITH {RUNS_SQL}
SELECT job, run_id, start_ts, status FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY job ORDER BY start_ts DESC, run_id DESC) rn FROM runs) WHERE rn = 1""")
def run_latest_status(spark, sf):
    r = runs(Tables(spark, sf)).select("job", "run_id", "start_ts", "status")
    return O.latest_per_key(r, ["job"], ["start_ts", "run_id"])


@register("last_n_runs", ops=("W3",), sql=f"""WITH {RUNS_SQL}
SELECT job, run_id, start_ts, status, recency FROM (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY job ORDER BY start_ts DESC, run_id DESC) AS BIGINT) AS recency
  FROM runs) WHERE recency <= 3""")
def last_n_runs(spark, sf):
    r = runs(Tables(spark, sf)).select("job", "run_id", "start_ts", "status")
    return O.last_n(r, ["job"], ["start_ts", "run_id"], 3)


@register("success_rate", ops=("A9",), sql=f"""WITH {RUNS_SQL}
SELECT job, CAST(COUNT(*) AS BIGINT) AS n_runs, CAST(SUM(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END) AS BIGINT) AS n_success,
  CAST(ROUND(AVG(CASE WHEN status = 'SUCCESS' THEN 1.0 ELSE 0.0 END), 6) AS DECIMAL(10,6)) AS success_rate,
  CAST(AVG(duration_s) AS DECIMAL(18,4)) AS avg_duration_s FROM runs GROUP BY job""")
def success_rate(spark, sf):
    return O.success_rate(runs(Tables(spark, sf)), "job")


@register("run_trend", ops=("A10",), sql=f"""WITH {RUNS_SQL}
SELECT CAST(start_ts AS DATE) AS day, component, CAST(COUNT(*) AS BIGINT) AS n_runs,
  CAST(COUNT(*) - SUM(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END) AS BIGINT) AS n_failed,
  CAST(ROUND(AVG(CASE WHEN status = 'SUCCESS' THEN 1.0 ELSE 0.0 END), 6) AS DECIMAL(10,6)) AS pass_rate
FROM runs GROUP BY 1, 2""")
def run_trend(spark, sf):
    return O.daily_trend(runs(Tables(spark, sf)), "start_ts", ["component"])


@register("failure_summary", ops=("A11",), sql=f"""WITH {RUNS_SQL}
SELECT message, CAST(COUNT(*) AS BIGINT) AS n_failures, MIN(start_ts) AS first_failure_ts,
  MAX(start_ts) AS last_failure_ts, CAST(COUNT(DISTINCT job) AS BIGINT) AS n_jobs
FROM runs WHERE status = 'FAILED' GROUP BY message""")
def failure_summary(spark, sf):
    r = runs(Tables(spark, sf)).where(F.col("status") == "FAILED")
    return O.failure_summary(r, "message", "start_ts", "job")


def _triage_sql() -> str:
    cat = "CASE " + " ".join(f"WHEN regexp_matches(message, '{p}') THEN '{c}'" for p, c, _ in O.TRIAGE) \
        + " ELSE 'UNKNOWN' END"
    step = "CASE " + " ".join(f"WHEN regexp_matches(message, '{p}') THEN '{s}'" for p, _, s in O.TRIAGE) \
        + " ELSE 'inspect the run log' END"
    return f"""WITH {RUNS_SQL}
SELECT run_id, job, message, {cat} AS category, {step} AS suggested_step FROM runs WHERE status = 'FAILED'"""


@register("failure_triage", ops=("G19",), sql=_triage_sql())
def failure_triage(spark, sf):
    r = runs(Tables(spark, sf)).where(F.col("status") == "FAILED").select("run_id", "job", "message")
    return O.triage(r, "message")


@register("failures_on_day", ops=("G10", "O1"), sql=f"""WITH {RUNS_SQL}
SELECT job, run_id, message, start_ts FROM runs
WHERE status = 'FAILED' AND CAST(start_ts AS DATE) = DATE '2024-01-15'""")
def failures_on_day(spark, sf):
    r = runs(Tables(spark, sf))
    return (r.where((F.col("status") == "FAILED") & (F.to_date("start_ts") == F.lit("2024-01-15").cast("date")))
            .select("job", "run_id", "message", "start_ts").orderBy(F.col("start_ts").desc()))


@register("anomaly_durations", ops=("W5",), sql=f"""WITH {RUNS_SQL},
w AS (SELECT job, run_id, start_ts, duration_s AS value,
  COALESCE(SUM(duration_s) OVER p, 0) AS s, COALESCE(SUM(CAST(duration_s * duration_s AS DECIMAL(38,4))) OVER p, 0) AS s2,
  COUNT(*) OVER p AS n FROM runs
  WINDOW p AS (PARTITION BY job ORDER BY start_ts, run_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)),
st AS (SELECT *, CASE WHEN n >= 1 THEN CAST(s AS DOUBLE) / CAST(n AS DOUBLE) END AS mean,
  SQRT(CASE WHEN n >= 2 THEN CAST(CAST(n AS DECIMAL(38,0)) * s2 - s * s AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE) END) AS sd
  FROM w)
SELECT job, run_id, start_ts, CAST(value AS DECIMAL(38,2)) AS value, CAST(ROUND(mean, 4) AS DECIMAL(38,4)) AS mean_prev,
  CAST(ROUND(sd, 4) AS DECIMAL(38,4)) AS std_prev,
  CAST(ROUND(CASE WHEN n >= 3 AND sd > 0 THEN (CAST(value AS DOUBLE) - mean) / sd END, 4) AS DECIMAL(38,4)) AS zscore,
  COALESCE(ABS(CASE WHEN n >= 3 AND sd > 0 THEN (CAST(value AS DOUBLE) - mean) / sd END) > 3.0, FALSE) AS is_anomaly
FROM st""")
def anomaly_durations(spark, sf):
    r = runs(Tables(spark, sf)).select("job", "run_id", "start_ts", "duration_s")
    out = O.anomalies(r, ["job"], ["start_ts", "run_id"], "duration_s", k=5, z=3.0, scale=2)
    return out.drop("duration_s")


@register("cost_rollup", ops=("A12",), sql=f"""WITH {RUNS_SQL}
SELECT CAST(start_ts AS DATE) AS day, component, CAST(SUM(duration_s) AS DECIMAL(38,2)) AS total_cost,
  CAST(COUNT(*) AS BIGINT) AS n_items, CAST(GROUPING(CAST(start_ts AS DATE), component) AS INTEGER) AS grouping_level
FROM runs GROUP BY ROLLUP (CAST(start_ts AS DATE), component)""")
def cost_rollup(spark, sf):
    r = runs(Tables(spark, sf)).select(F.to_date("start_ts").alias("day"), "component",
                                       F.col("duration_s").alias("cost"))
    return O.cost_rollup(r, ["day", "component"])


@register("cost_projection", ops=("A13",), sql=f"""WITH {RUNS_SQL}
SELECT component, CAST(ROUND(quantile_disc(CAST(duration_s AS DOUBLE), 0.1) * 1000.0 * 0.9, 2) AS DECIMAL(18,2)) AS low,
  CAST(ROUND(quantile_disc(CAST(duration_s AS DOUBLE), 0.5) * 1000.0, 2) AS DECIMAL(18,2)) AS expected,
  CAST(ROUND(quantile_disc(CAST(duration_s AS DOUBLE), 0.9) * 1000.0 * 1.2, 2) AS DECIMAL(18,2)) AS high
FROM runs GROUP BY component""")
def cost_projection(spark, sf):
    # The sketch is exact up to its accuracy of 10,000 rows a group.
    r = runs(Tables(spark, sf))
    return O.cost_projection(r, "component", "duration_s", volume=1000.0)


BUDGET = 250.0


@register("budget_breaches", ops=("A25",), sql=f"""WITH {RUNS_SQL},
d AS (SELECT job, CAST(start_ts AS DATE) AS day, SUM(duration_s) AS c FROM runs GROUP BY 1, 2)
SELECT job, day, CAST(c AS DECIMAL(18,2)) AS day_cost,
  CAST(SUM(c) OVER (PARTITION BY job, date_trunc('month', day) ORDER BY day ROWS UNBOUNDED PRECEDING) AS DECIMAL(38,2)) AS mtd_cost,
  CAST({BUDGET} AS DECIMAL(18,2)) AS budget,
  SUM(c) OVER (PARTITION BY job, date_trunc('month', day) ORDER BY day ROWS UNBOUNDED PRECEDING) > {BUDGET} AS breached
FROM d""")
def budget_breaches(spark, sf):
    r = runs(Tables(spark, sf))
    daily = r.groupBy("job", F.to_date("start_ts").alias("day")).agg(F.sum("duration_s").alias("cost"))
    return O.budget_breaches(daily, "job", "day", "cost", BUDGET)


SLA_AS_OF = "2024-01-31 00:00:00"


@register("sla_breaches", ops=("A21",), sql=f"""WITH {RUNS_SQL}
SELECT job, MAX(end_ts) AS last_end_ts,
  CAST(FLOOR(epoch(TIMESTAMP '{SLA_AS_OF}') - epoch(MAX(end_ts))) AS BIGINT) AS age_seconds,
  CAST(FLOOR(epoch(TIMESTAMP '{SLA_AS_OF}') - epoch(MAX(end_ts))) AS BIGINT) > 24 * 3600 AS sla_breached
FROM runs WHERE status = 'SUCCESS' GROUP BY job""")
def sla_breaches(spark, sf):
    r = runs(Tables(spark, sf)).where(F.col("status") == "SUCCESS")
    return O.sla_breaches(r, "job", "end_ts", SLA_AS_OF, 24)


@register("cycle_status", ops=("G16",), sql=f"""WITH {RUNS_SQL}
SELECT CAST(start_ts AS DATE) AS day, CAST(COUNT(*) AS BIGINT) AS n_children,
  CAST(SUM(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS n_failed,
  CASE WHEN MAX(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) = 1 THEN 'F' ELSE 'S' END AS status
FROM runs GROUP BY 1""")
def cycle_status(spark, sf):
    r = runs(Tables(spark, sf)).withColumn("day", F.to_date("start_ts"))
    return O.rollup_status(r, ["day"])


@register("rerun_candidates", ops=("G17",), sql=f"""WITH {RUNS_SQL}
SELECT job, run_id, start_ts, status FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY job ORDER BY start_ts DESC, run_id DESC) rn FROM runs)
WHERE rn = 1 AND status = 'FAILED'""")
def rerun_candidates(spark, sf):
    r = runs(Tables(spark, sf)).select("job", "run_id", "start_ts", "status")
    return O.rerun_candidates(r, "job", ["start_ts", "run_id"])


@register("throughput", ops=("A19", "A20"), sql=f"""WITH {RUNS_SQL}
SELECT job, CAST(SUM(rows_processed) AS BIGINT) AS total_rows, CAST(SUM(duration_s) AS DECIMAL(38,2)) AS total_duration_s,
  CAST(CASE WHEN SUM(duration_s) > 0 THEN ROUND(CAST(SUM(rows_processed) AS DOUBLE) / CAST(SUM(duration_s) AS DOUBLE), 4)
       END AS DECIMAL(18,4)) AS rows_per_s FROM runs GROUP BY job""")
def throughput(spark, sf):
    return O.throughput(runs(Tables(spark, sf)), "job", "rows_processed", "duration_s")


@register("trace_timeline", ops=("G9",), sql=f"""WITH {RUNS_SQL}
SELECT 'tr_' || job || '_' || CAST(CAST(start_ts AS DATE) AS VARCHAR) AS trace_id, run_id, component, start_ts, status,
  CAST(ROW_NUMBER() OVER (PARTITION BY job, CAST(start_ts AS DATE) ORDER BY start_ts, run_id) AS BIGINT) AS step
FROM runs""")
def trace_timeline(spark, sf):
    from ..operators.sequence import ordered_scan
    f = O.fold_runs(ledger_events(Tables(spark, sf)))
    return ordered_scan(f.select("trace_id", "run_id", "component", "start_ts", "status"), ["trace_id"],
                        ["start_ts", "run_id"], index_col="step")
