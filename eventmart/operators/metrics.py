"""Metric analytics over samples(metric, labels MAP<STRING,STRING>, ts, value)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.operators import scans

RATE_WINDOW_S = 300
STEP_S = 60  # distance of the times at which series are evaluated
GRAIN_S = 21600  # a series has few samples in six hours: their number is set by the scrape interval

# Topics whose counts make up the saga funnel, and the stage each one stands for.
FUNNEL_STAGES = {
    "internal.media.upload.intent": "intents",
    "public.media.upload.approved": "approved",
    "public.media.upload.confirmed": "confirmed",
    "internal.media.upload.retry": "retry",
    "public.media.expired.events": "expired",
    "internal.media.upload.dead-letter": "dead_letter",
    "internal.media.delete.retry": "delete_retry",
}


def series_of(labels: Column) -> Column:
    """A text that is equal for equal label sets."""
    return F.to_json(F.map_from_entries(F.sort_array(F.map_entries(labels))))


def match(samples: DataFrame, matchers: Mapping[str, str] | None = None, metric: str | None = None) -> DataFrame:
    """Samples of a metric whose labels match. A value starting with `~` is a pattern for the whole label value."""
    if metric is not None:
        samples = samples.filter(F.col("metric") == metric)
    for name, wanted in (matchers or {}).items():
        value = F.coalesce(F.try_element_at("labels", F.lit(name)), F.lit(""))
        samples = samples.filter(value.rlike(f"^(?:{wanted[1:]})$") if wanted.startswith("~") else value == wanted)
    return samples


def label_columns(labels: list[str]) -> list[Column]:
    return [F.try_element_at("labels", F.lit(name)).alias(name) for name in labels]


def steps_of(us: Column, lookback_s: int, step_s: int = STEP_S) -> Column:
    """The grid times (microseconds, multiples of the step) that look back on a sample: from its own time on, for less than
    `lookback_s`."""
    step = F.lit(step_s * scans.SECOND)
    first = F.ceil(us / step) * step
    last = F.ceil((us + lookback_s * scans.SECOND) / step) * step - step
    return F.when(first <= last, F.sequence(first, last, step.cast("bigint"))).otherwise(F.array().cast("array<bigint>"))


def at_steps(samples: DataFrame, lookback_s: int = RATE_WINDOW_S, step_s: int = STEP_S) -> DataFrame:
    """metric, series, ts, value: the latest sample of each series within the look-back, at every grid time."""
    points = samples.select("metric", series_of(F.col("labels")).alias("series"), F.unix_micros("ts").alias("_us"), "value")
    seen = points.withColumn("_at", F.explode(steps_of(F.col("_us"), lookback_s, step_s)))
    return (seen.groupBy("metric", "series", "_at").agg(F.max_by("value", "_us").alias("value"))
            .select("metric", "series", F.timestamp_micros("_at").alias("ts"), "value"))


def labels_of(series: Column) -> Column:
    return F.from_json(series, "map<string,string>")


def rate(samples: DataFrame, metric: str, window_s: int = RATE_WINDOW_S, matchers: Mapping[str, str] | None = None,
         grain_s: int = GRAIN_S, step_s: int = STEP_S) -> DataFrame:
    """Per-second increase of each series over the trailing window, at the multiples of `step_s`; a drop is a reset.

    All series are evaluated at the same times, whenever they were sampled, so their rates may be summed. The increase
    between the first and the last sample inside the window is divided by the time between them; one sample alone
    gives no row. Series are cut by time, with the last window of a chunk copied into the next, so a busy series is
    spread over tasks.
    """
    points = match(samples, matchers, metric).select(
        series_of(F.col("labels")).alias("series"), "value", F.unix_micros("ts").alias("_us"))
    near = scans.halo(points, "_us", back_s=window_s, grain_s=grain_s)
    previous = F.lag("value").over(scans.local_window(["series"], ["_us"]))
    grown = F.when(F.col("value") >= previous, F.col("value") - previous).otherwise(F.col("value"))
    seen = (scans.own_rows(near.withColumn("_grown", grown))
            .withColumn("_at", F.explode(steps_of(F.col("_us"), window_s, step_s))))
    span = (F.max("_us") - F.min("_us")) / F.lit(scans.SECOND)
    increase = F.sum("_grown") - F.min_by("_grown", "_us")
    return (seen.groupBy("series", "_at").agg(increase.alias("_increase"), span.alias("_span"))
            .filter(F.col("_span") > 0)
            .select(labels_of(F.col("series")).alias("labels"), "series", F.timestamp_micros("_at").alias("ts"),
                    (F.col("_increase") / F.col("_span")).alias("rate")))


def rate_by(samples: DataFrame, metric: str, labels: list[str], matchers: Mapping[str, str] | None = None,
            window_s: int = RATE_WINDOW_S) -> DataFrame:
    """Rates summed over all series with the same given labels."""
    return (rate(samples, metric, window_s, matchers).groupBy(*label_columns(labels), "ts")
            .agg(F.sum("rate").alias("rate")))


def ratio(num: DataFrame, den: DataFrame, on: list[str], value: str = "value") -> DataFrame:
    """num / den where both have the same labels and time; null when the denominator is 0."""
    bottom = den.select(*on, F.col(value).alias("_den"))
    return num.join(bottom, on).select(*on, (F.col(value) / F.nullif("_den", F.lit(0.0))).alias("ratio"))


def error_ratio(samples: DataFrame, metric: str, status_label: str, error_pattern: str = "5..",
                labels: list[str] | None = None, window_s: int = RATE_WINDOW_S) -> DataFrame:
    """Share of the rate whose status matches the pattern: one pass, not two rates joined."""
    failed = F.try_element_at("labels", F.lit(status_label)).rlike(f"^(?:{error_pattern})$")
    rates = rate(samples, metric, window_s).groupBy(*label_columns(labels or []), "ts").agg(
        F.sum(F.when(failed, F.col("rate")).otherwise(F.lit(0.0))).alias("_failed"), F.sum("rate").alias("_all"))
    return rates.select(*(labels or []), "ts", (F.col("_failed") / F.nullif("_all", F.lit(0.0))).alias("ratio"))


def bucket_rates(samples: DataFrame, metric: str, labels: list[str], window_s: int = RATE_WINDOW_S) -> DataFrame:
    return rate_by(samples, metric, [*labels, "le"], None, window_s)


def histogram_quantile(q: float | list[float], rates: DataFrame, labels: list[str]) -> DataFrame:
    """Quantile of cumulative buckets (column `le`), linear inside the bucket; one row per quantile asked for (`q`).

    The last bucket has no upper edge: a quantile there is the edge below it. A group is the buckets of one
    label set at one time, so the window is as small as the bucket list.
    """
    group = Window.partitionBy(*labels, "ts")
    by_edge = group.orderBy("_edge")
    edge = F.when(F.col("le") == "+Inf", F.lit(float("inf"))).otherwise(F.col("le").cast("double"))
    wanted = F.array(*[F.lit(float(x)) for x in (q if isinstance(q, list) else [q])])
    rank = F.col("q") * F.col("_total")
    inside = (F.col("rate") - F.col("_below")) > 0
    value = (F.when(F.col("_edge") == float("inf"), F.col("_lower"))
              .when(inside, F.col("_lower") + (F.col("_edge") - F.col("_lower"))
                    * (rank - F.col("_below")) / (F.col("rate") - F.col("_below")))
              .otherwise(F.col("_edge")))
    buckets = (rates.withColumn("_edge", edge)
                    .withColumn("_total", F.max("rate").over(group))
                    .withColumn("_below", F.coalesce(F.lag("rate").over(by_edge), F.lit(0.0)))
                    .withColumn("_lower", F.coalesce(F.lag("_edge").over(by_edge), F.lit(0.0))))
    reached = buckets.withColumn("q", F.explode(wanted)).filter((F.col("_total") > 0) & (F.col("rate") >= rank))
    return reached.groupBy(*labels, "ts", "q").agg(F.min_by(value, F.col("_edge")).alias("quantile"))


def sustained(series: DataFrame, predicate: Column, for_s: int, keys: list[str], max_gap_s: int = 300,
              grain_s: int = GRAIN_S) -> DataFrame:
    """Each point with `since` (start of the unbroken run of true points it belongs to) and `firing`.

    A point fires when its run has lasted `for_s`. A false point or a gap longer than `max_gap_s` ends a run.
    """
    points = series.withColumns({"_us": F.unix_micros("ts"), "_true": F.coalesce(predicate, F.lit(False))})
    near = scans.halo(points, "_us", back_s=max_gap_s, grain_s=grain_s)
    ordered = scans.local_window(keys, ["_us"])
    steps = scans.own_rows(near.withColumns({"_prev_us": F.lag("_us").over(ordered),
                                             "_prev_true": F.lag("_true").over(ordered)}))
    goes_on = F.coalesce(F.col("_prev_true") & (F.col("_us") - F.col("_prev_us") <= max_gap_s * scans.SECOND),
                         F.lit(False))
    starts = steps.withColumn("_start", F.when(F.col("_true") & ~goes_on, F.col("_us")))
    runs = scans.running_max(starts, keys, ["_us"], {"_since": F.col("_start")}, grain_s)
    since = F.when(F.col("_true"), F.col("_since"))
    return (runs.withColumn("since", F.timestamp_micros(since))
                .withColumn("firing", F.coalesce(F.col("_us") - since >= for_s * scans.SECOND, F.lit(False)))
                .drop("_us", "_true", "_prev_us", "_prev_true", "_start", "_since", scans.CHUNK))


def absent(samples: DataFrame, metric: str, spine: DataFrame, lookback_s: int = 300, step_s: int = 60,
           matchers: Mapping[str, str] | None = None) -> DataFrame:
    """Times of the spine (column `ts`, on multiples of `step_s`) with no sample in the time before them."""
    step = F.lit(step_s)
    at = F.unix_seconds("ts")
    first = F.ceil(at / step) * step
    last = F.ceil((at + lookback_s) / step) * step - step
    covered = (match(samples, matchers, metric).select(first.alias("_a"), last.alias("_b")).distinct()
               .select(F.explode(F.sequence("_a", "_b", step.cast("bigint"))).alias("_at")).distinct())
    return (spine.withColumn("_at", F.unix_seconds("ts")).join(covered, "_at", "left_anti")
            .select("ts", F.lit(1.0).alias("value")))


def absent_stream(samples: DataFrame, metric: str, heartbeat: DataFrame, lookback_s: int = 300, step_s: int = 60,
                  matchers: Mapping[str, str] | None = None, delay: str = "1 minute") -> DataFrame:
    """`absent` as a stream: `heartbeat` is a stream of the times (column `ts`, on multiples of `step_s`) at which to look.

    Heartbeats and the steps that samples cover meet in one aggregation by step under one watermark, so the heartbeat alone moves the
    time on and missing data shows without any sample. A heartbeat sent twice counts once. `lookback_s` is a multiple of
    `step_s`. Samples later than the delay change nothing any more.
    """
    if lookback_s % step_s:
        raise ValueError("the lookback must be a multiple of the step")
    first = F.ceil(F.unix_micros("ts") / F.lit(step_s * scans.SECOND)) * step_s
    covered = (match(samples, matchers, metric)
               .select(F.explode(F.sequence(first, first + lookback_s - step_s, F.lit(step_s).cast("bigint"))).alias("at"))
               .select(F.timestamp_seconds("at").alias("at"), F.lit(False).alias("asked"), F.lit(True).alias("covered")))
    beats = heartbeat.select(F.col("ts").alias("at"), F.lit(True).alias("asked"), F.lit(False).alias("covered"))
    # a sample covers steps up to the lookback ahead of it
    steps = (covered.unionByName(beats).withWatermark("at", f"{delay} {lookback_s} seconds")
             .groupBy(F.window("at", f"{step_s} seconds").alias("step")).agg(F.max("asked").alias("asked"), F.max("covered").alias("covered")))
    return steps.where("asked and not covered").select(F.col("step.start").alias("ts"), F.lit(1.0).alias("value"))


def spine(start: str, end: str, samples: DataFrame, step_s: int = 60) -> DataFrame:
    """Regular times between two wire times, made by the session the samples belong to."""
    spark = samples.sparkSession
    bounds = spark.range(1).select(F.unix_seconds(F.to_timestamp(F.lit(start))).alias("a"),
                                   F.unix_seconds(F.to_timestamp(F.lit(end))).alias("b"))
    steps = bounds.select(F.explode(F.sequence("a", "b", F.lit(step_s).cast("bigint"))).alias("at"))
    return steps.select(F.timestamp_seconds("at").alias("ts"))


def rollup(samples: DataFrame, interval: str = "10 seconds") -> DataFrame:
    """Count, sum and last value of each series per interval; combined before the shuffle."""
    return (samples.groupBy(F.window("ts", interval).alias("w"), "metric",
                            series_of(F.col("labels")).alias("series"))
            .agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.max_by("value", "ts").alias("last"))
            .select("metric", "series", F.col("w.start").alias("bucket"), "n", "total", "last"))


def rollup_stream(samples: DataFrame, interval: str = "10 seconds", delay: str = "1 minute") -> DataFrame:
    """`rollup` as a stream: each interval once, when the watermark has passed its end. State holds open intervals only.

    Samples that come later than the delay change nothing any more; the query's progress counts them (`late_rows`).
    """
    return rollup(samples.withWatermark("ts", delay), interval)


def saga_funnel_stream(events: DataFrame, window_s: int = 300, delay: str = "1 minute") -> DataFrame:
    """`saga_funnel` as a stream: each window once, when the watermark has passed its end."""
    return saga_funnel(events.withWatermark("ts", delay), window_s)


def late_rows(progress: list) -> int:
    """Rows that came too late for their window, summed over a streaming query's progress reports.

    Rows are counted behind the partial aggregation of their batch: late rows of one series and interval are one there.
    """
    return sum(s.numRowsDroppedByWatermark for p in progress for s in p.stateOperators)


def latest_by(samples: DataFrame, metric: str, labels: list[str], agg: str = "sum",
              matchers: Mapping[str, str] | None = None, keep: Column | None = None) -> DataFrame:
    """Sum or count over labels of each series' latest sample (`keep`: only samples with such a latest value)."""
    latest = (match(samples, matchers, metric)
              .groupBy(series_of(F.col("labels")).alias("series"), *label_columns(labels))
              .agg(F.max_by("value", "ts").alias("value")))
    if keep is not None:
        latest = latest.filter(keep)
    value = {"sum": F.sum("value"), "count": F.count("value").cast("double")}[agg]
    return latest.groupBy(*labels).agg(value.alias("value"))


def topic_status_counts(judged: DataFrame) -> DataFrame:
    """Messages by topic and status, from judged rows (topic, reason)."""
    status = F.when(F.col("reason").isNull(), F.lit("success")).otherwise(F.lit("error"))
    return judged.groupBy("topic", status.alias("status")).agg(F.count("*").alias("n"))


def error_counts(judged: DataFrame) -> DataFrame:
    """Refused messages by topic."""
    return judged.filter(F.col("reason").isNotNull()).groupBy("topic").agg(F.count("*").alias("n"))


def saga_funnel(events: DataFrame, window_s: int = 300) -> DataFrame:
    """Events (topic, ts) per window and saga stage, one column per stage."""
    stage = F.create_map(*[F.lit(x) for pair in FUNNEL_STAGES.items() for x in pair])
    staged = events.withColumn("stage", F.try_element_at(stage, F.col("topic"))).filter(F.col("stage").isNotNull())
    counts = (staged.groupBy(F.window("ts", f"{window_s} seconds").alias("w"))
              .agg(*[F.count_if(F.col("stage") == s).alias(s) for s in FUNNEL_STAGES.values()]))
    return counts.select(F.col("w.start").alias("bucket"), *FUNNEL_STAGES.values())


def consumer_lag(ends: DataFrame, commits: DataFrame) -> DataFrame:
    """Unread messages by group and topic: newest end offset minus newest committed offset, over partitions."""
    end = ends.groupBy("topic", "partition").agg(F.max_by("offset", "ts").alias("_end"))
    done = commits.groupBy("group", "topic", "partition").agg(F.max_by("offset", "ts").alias("_done"))
    behind = F.greatest(F.col("_end") - F.col("_done"), F.lit(0))
    return (done.join(end, ["topic", "partition"]).groupBy("group", "topic")
            .agg(F.sum(behind).cast("bigint").alias("lag")))


@dataclass(frozen=True)
class AlertRule:
    name: str
    kind: str  # value | rate | absent | error_ratio | quantile | used_share
    metric: str
    op: str  # > or ==
    threshold: float
    for_s: int
    matchers: Mapping[str, str] = field(default_factory=dict)
    no_data_alerts: bool = False


# The alert rules (metric, comparison, threshold, duration, what missing data means).
ALERT_RULES = [
    AlertRule("Flink Job Down", "value", "flink_jobmanager_job_uptime", "==", 0, 120, no_data_alerts=True),
    AlertRule("Postgres Connections Near Limit", "value", "pg_stat_activity_count", ">", 70, 60),
    AlertRule("Kafka Consumer Lag High", "value", "redpanda_kafka_consumer_group_lag", ">", 20, 120),
    AlertRule("Go Service Health Check Failed", "absent", "http_server_active_requests", "==", 1, 60,
              no_data_alerts=True),
    AlertRule("Go Service High Error Rate", "error_ratio", "http_server_request_duration_seconds_count",
              ">", 0.05, 300, {"http_response_status_code": "~5.."}),
    AlertRule("Go Service High Latency", "quantile", "http_server_request_duration_seconds_bucket", ">", 5, 300),
    AlertRule("Media Saga Dead-Letter Queue Growing", "rate", "kafka_consumer_messages_total", ">", 0, 120,
              {"topic": "~internal.media.*.dead-letter"}),
    AlertRule("Redpanda Disk Usage High", "used_share", "redpanda_storage_disk", ">", 0.8, 300),
    AlertRule("K8s Pod CrashLoopBackOff", "rate", "kube_pod_container_status_restarts_total", ">", 0, 180),
    AlertRule("K8s Pod Pending", "value", "kube_pod_status_phase", ">", 0, 300, {"phase": "Pending"}),
    AlertRule("Airflow Scheduler Down", "absent", "airflow_scheduler_heartbeat_total", "==", 1, 120,
              no_data_alerts=True),
    AlertRule("Airflow DAG Failure Rate", "rate", "airflow_dagrun_duration_total", ">", 0, 300, {"state": "failed"}),
]


def used_share(samples: DataFrame, metric: str) -> DataFrame:
    """1 - free / total per series at the grid times, from the gauges `<metric>_free_bytes` and `<metric>_total_bytes`."""
    gauges = at_steps(samples.filter(F.col("metric").isin(f"{metric}_free_bytes", f"{metric}_total_bytes")))
    is_free = F.col("metric") == f"{metric}_free_bytes"
    both = gauges.groupBy("series", "ts").agg(
        F.max(F.when(is_free, F.col("value"))).alias("_free"), F.max(F.when(~is_free, F.col("value"))).alias("_total"))
    return both.select("series", "ts", (1 - F.col("_free") / F.nullif("_total", F.lit(0.0))).alias("value"))


def alert_series(rule: AlertRule, samples: DataFrame, times: DataFrame) -> DataFrame:
    """The (series, ts, value) points a rule judges. Missing data adds points only where the rule says so."""
    if rule.kind == "value":
        points = at_steps(match(samples, rule.matchers, rule.metric)).select("series", "ts", "value")
    elif rule.kind == "rate":
        points = rate(samples, rule.metric, matchers=rule.matchers).select("series", "ts", F.col("rate").alias("value"))
    elif rule.kind == "absent":
        # A complete line of 0 and 1 on the spine, so that presence ends a run.
        gone = absent(samples, rule.metric, times)
        here = times.join(gone, "ts", "left_anti").withColumn("value", F.lit(0.0))
        return gone.unionByName(here).withColumn("series", F.lit("{}")).select("series", "ts", "value")
    elif rule.kind == "error_ratio":
        label, pattern = next(iter(rule.matchers.items()))
        points = error_ratio(samples, rule.metric, label, pattern[1:]).select(
            F.lit("{}").alias("series"), "ts", F.col("ratio").alias("value"))
    elif rule.kind == "quantile":
        points = histogram_quantile(0.99, bucket_rates(samples, rule.metric, []), []).select(
            F.lit("{}").alias("series"), "ts", F.col("quantile").alias("value"))
    else:
        points = used_share(samples, rule.metric)
    if rule.no_data_alerts and rule.kind != "absent":
        gaps = absent(samples, rule.metric, times).select(
            F.lit("no data").alias("series"), "ts", F.lit(float(rule.threshold)).alias("value"))
        points = points.unionByName(gaps)
    return points


def alerts(samples: DataFrame, times: DataFrame, rules: list[AlertRule] | None = None) -> DataFrame:
    """Points at which a rule fires, with the start of the run that made it fire."""
    out = None
    for rule in rules or ALERT_RULES:
        points = alert_series(rule, samples, times)
        limit = F.lit(float(rule.threshold))
        holds = F.col("value") == limit if rule.op == "==" else F.col("value") > limit
        fired = (sustained(points, holds, rule.for_s, ["series"]).filter("firing")
                 .select(F.lit(rule.name).alias("alert"), "series", "ts", "since", "value"))
        out = fired if out is None else out.unionByName(fired)
    return out
