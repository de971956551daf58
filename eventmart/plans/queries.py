"""Every operator as a query over the test tables. Each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventmart.functions import scalars as S
from eventmart.operators import (credits, governance, identity, ingest, media, metrics, notifications, olap, sagas,
                                 serving)
from eventmart.plans import jobs
from eventmart.schemas import TABLES, TOPICS, conform
from eventmart.session import BASE_CONF, shared_dir
from eventmart.sources.event_views import MOVE_SPEED, NOW, EventViews
from eventmart.sources.topics import read_topic
from eventmart.streaming import dedup, processors, sinks, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DT = "2024-01-15"
VIEWER = "u5"
SPINE = ("2024-01-01T00:00:00Z", "2024-01-31T00:00:00Z")
COUNT = "http_server_request_duration_seconds_count"
BUCKET = "http_server_request_duration_seconds_bucket"
STATUS = "http_response_status_code"


def query(plan: Callable[[EventViews], DataFrame]) -> Callable[[EventViews], DataFrame]:
    QUERIES[plan.__name__] = lambda spark, folder: plan(EventViews(spark, folder))
    return plan


def _notification_query(name: str, projection: str, view: str) -> None:
    QUERIES[name] = lambda spark, folder: notifications.notification(
        projection, getattr(EventViews(spark, folder), view)())


def _text(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as wire time, which compares the same in every engine."""
    return df.withColumns({c: S.iso_time(c) for c in columns})


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Whole numbers with gaps as text: engines hand those to clients in different types."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _rounded(column: str, digits: int = 6) -> Column:
    return F.round(F.col(column), digits)


# identity ---------------------------------------------------------------------------------------

@query
def daily_login_aggregates(v: EventViews) -> DataFrame:
    return identity.daily_login_aggregates(v.logins(), v.signups(), DT)


@query
def daily_login_aggregates_all_signups(v: EventViews) -> DataFrame:
    return identity.daily_login_aggregates(v.logins(), v.signups(), DT, dedupe_signups=False)


@query
def login_aggregates_backfill(v: EventViews) -> DataFrame:
    return identity.login_aggregates_backfill(v.logins(), v.signups())


def _unified(v: EventViews) -> DataFrame:
    return identity.unified_events(v.logins(), v.signups(), v.signouts())


@query
def unified_events(v: EventViews) -> DataFrame:
    return _unified(v)


@query
def login_echo(v: EventViews) -> DataFrame:
    return identity.echo(v.logins())


# notifications ----------------------------------------------------------------------------------

for _name, _projection, _view in [
    ("notif_login", "login", "logins"),
    ("notif_signup", "signup", "signups"),
    ("notif_signout", "signout", "signouts"),
    ("notif_credit_bonus", "credit_bonus", "signups"),
    ("notif_credit_refund", "credit_refund", "expired"),
    ("notif_upload_ready", "upload_ready", "signed"),
    ("notif_upload_rejected", "upload_rejected", "upload_rejected"),
    ("notif_upload_completed", "upload_completed", "confirmed"),
    ("notif_upload_expired", "upload_expired", "expired"),
    ("notif_upload_failed", "upload_failed", "dead_letters"),
    ("notif_download_ready", "download_ready", "download_signed"),
    ("notif_download_rejected", "download_rejected", "rejected_access"),
    ("notif_file_deleted", "file_deleted", "deletes"),
    ("notif_delete_rejected", "delete_rejected", "rejected_access"),
]:
    _notification_query(_name, _projection, _view)


@query
def notif_message(v: EventViews) -> DataFrame:
    return notifications.message_notification(v.messages())


def _log(v: EventViews) -> DataFrame:
    return notifications.notification_log(
        notifications.notification("login", v.logins()), notifications.notification("signup", v.signups()),
        notifications.notification("signout", v.signouts()), notifications.message_notification(v.messages()))


# credits ----------------------------------------------------------------------------------------

@query
def ledger_signup_bonus(v: EventViews) -> DataFrame:
    return credits.signup_bonus(v.signups())


@query
def ledger_refund(v: EventViews) -> DataFrame:
    return credits.expiry_refund(v.expired())


def _ledger(v: EventViews) -> DataFrame:
    decisions = credits.credit_check(v.upload_intents(), credits.signup_bonus(v.signups()))
    return credits.signup_bonus(v.signups()).unionByName(credits.deductions(decisions))


@query
def own_credits(v: EventViews) -> DataFrame:
    """The ledger rows of everybody who has written a message."""
    writers = v.messages().select(F.col("user_id").alias("viewer"))
    return serving.own_rows(credits.signup_bonus(v.signups()), writers)


@query
def viewer_notifications(v: EventViews) -> DataFrame:
    """The read one viewer makes: the policy as a filter over the whole log."""
    return serving.visible_to(_log(v), VIEWER)


@query
def credit_check(v: EventViews) -> DataFrame:
    return credits.credit_check(v.upload_intents(), credits.signup_bonus(v.signups()))


@query
def credit_check_incremental(v: EventViews) -> DataFrame:
    """The intents from a day on, judged on a ledger that holds the deductions of a run over those before."""
    intents, bonus = v.upload_intents(), credits.signup_bonus(v.signups())
    later = S.typed_time("request_time") >= F.lit(DT).cast("timestamp")
    before = credits.credit_check(intents.filter(~later), bonus)
    return credits.credit_check(intents.filter(later), bonus.unionByName(credits.deductions(before)))


@query
def credit_balances(v: EventViews) -> DataFrame:
    return credits.balances(_ledger(v))


@query
def credit_balance_lookup(v: EventViews) -> DataFrame:
    users = v.events().select("user_id").unionByName(v.messages().select("user_id")).distinct()
    return credits.balance_lookup(users, credits.signup_bonus(v.signups()))


@query
def credit_affordable(v: EventViews) -> DataFrame:
    return credits.affordable(v.upload_intents(), _ledger(v)).select("request_id", "user_id")


@query
def upload_approved(v: EventViews) -> DataFrame:
    return sagas.credit_branches(credits.credit_check(v.upload_intents(), credits.signup_bonus(v.signups())))["approved"]


# media ------------------------------------------------------------------------------------------

def _files(v: EventViews) -> DataFrame:
    return media.current_files(v.confirmed(), v.deletes())


@query
def media_files_insert(v: EventViews) -> DataFrame:
    return media.new_files(v.confirmed())


@query
def upload_signed(v: EventViews) -> DataFrame:
    return media.signed_from_approved(v.upload_approved())


@query
def soft_delete(v: EventViews) -> DataFrame:
    return media.soft_delete(media.new_files(v.confirmed()), v.deletes())


@query
def active_files(v: EventViews) -> DataFrame:
    return media.file_list(_files(v))


@query
def ownership_exists(v: EventViews) -> DataFrame:
    return media.owned(v.file_intents(), _files(v)).select("request_id", "user_id", "file_path")


@query
def download_outcomes(v: EventViews) -> DataFrame:
    return _as_text(media.download_outcomes(v.file_intents(), _files(v)), "expires_in")


@query
def download_events(v: EventViews) -> DataFrame:
    return media.downloaded(v.file_intents(), _files(v))


@query
def delete_outcomes(v: EventViews) -> DataFrame:
    return _as_text(media.delete_outcomes(v.delete_intents(), _files(v)), "file_size", "retry_count")


def _effects(intents: DataFrame) -> DataFrame:
    """What the outside does for an intent, drawn from the number in its request id: one in ten links and marks fail."""
    number = F.substring_index("request_id", "-", -1).cast("bigint")
    return intents.withColumns({
        "download_url": F.when(number % 10 != 3, F.concat(F.lit("https://store/"), "file_path")),
        "deleted_ok": number % 10 != 4, "removed_ok": number % 3 == 0})


def _asked(v: EventViews) -> dict[str, DataFrame]:
    columns = ["user_id", "file_path", "request_id", "request_time"]
    return {"download": v.file_intents().select(*columns), "delete": v.delete_intents().select(*columns)}


@query
def media_outcomes(v: EventViews) -> DataFrame:
    """Each intent, and a replay of all of them, against the file as the rows before it left it."""
    asked = [df.withColumn("action", F.lit(action)) for action, df in _asked(v).items()]
    intents = _effects(asked[0].unionByName(asked[1]))
    return _as_text(media.outcomes_in_order(v.confirmed(), intents.unionByName(intents)), "file_size", "retry_count")


# sagas ------------------------------------------------------------------------------------------

@query
def ttl_expired(v: EventViews) -> DataFrame:
    return sagas.expired_uploads(v.signed(), v.received())


def _moves(v: EventViews) -> DataFrame:
    return sagas.move_saga(v.received(MOVE_SPEED), v.ready())


@query
def move_saga(v: EventViews) -> DataFrame:
    return _moves(v)


@query
def move_confirmed(v: EventViews) -> DataFrame:
    return sagas.move_branches(_moves(v))["confirmed"]


@query
def upload_retry_reentry(v: EventViews) -> DataFrame:
    return sagas.reenter_retries(v.upload_retries())


@query
def upload_retry_step(v: EventViews) -> DataFrame:
    return sagas.retry_step(v.upload_retries())


@query
def delete_retry_route(v: EventViews) -> DataFrame:
    return sagas.route_delete_retries(v.delete_retries())


@query
def orphan_dead_letters(v: EventViews) -> DataFrame:
    letters = v.dead_letters().select("user_id", "permanent_path", "dead_letter_time")
    return sagas.orphan_dead_letters(letters, v.confirmed())


# OLAP and serving -------------------------------------------------------------------------------

@query
def olap_unified_dedup(v: EventViews) -> DataFrame:
    """The log replayed once more with a later version: the replay's rows win, one row per key stays."""
    first = _unified(v).withColumn("version", F.lit(1))
    again = first.withColumns({"version": F.lit(2), "email": F.upper("email")})
    typed, _ = olap.typed_events(first.unionByName(again))
    return _text(olap.replace_by_key(typed, olap.EVENT_KEY, "version"), "event_time")


@query
def visible_notifications(v: EventViews) -> DataFrame:
    return serving.visible(_log(v), v.users().select(F.col("id").alias("viewer")))


@query
def history_top20(v: EventViews) -> DataFrame:
    return serving.history(_log(v), v.users().select(F.col("id").alias("viewer")), 20)


@query
def latest_notification(v: EventViews) -> DataFrame:
    log = _log(v).select("user_id", "event_type", "event_time", "payload")
    return serving.latest_per(log, ["user_id", "event_type"], [S.micros("event_time"), "event_time", "payload"])


def _requests_and_answers(v: EventViews) -> tuple[DataFrame, DataFrame]:
    requests = v.file_intents().select(
        "request_id", "file_path", "request_time",
        F.array(F.lit("media.file_deleted"), F.lit("media.delete_rejected")).alias("types"))
    by_id = v.delete_intents().select(
        F.lit("media.delete_rejected").alias("event_type"),
        S.json_object(file_path=F.col("file_path"), reason=F.lit("not_found"),
                      request_id=F.lit(None).cast("string")).alias("payload"),
        F.col("request_time").alias("event_time"))
    by_path = notifications.notification("file_deleted", v.deletes()).drop("user_id")
    echoed = v.events("click").select(
        F.when(F.col("value") < 20, F.lit("media.file_deleted")).otherwise(F.lit("other")).alias("event_type"),
        S.json_object(request_id=F.col("request_id"), file_path=F.col("path")).alias("payload"),
        S.iso_micros(F.col("us") + F.col("k").cast("bigint") * 120_000_000).alias("event_time"))
    return requests, by_id.unionByName(by_path).unionByName(echoed)


@query
def request_outcomes(v: EventViews) -> DataFrame:
    """Delete requests (clicks) wait an hour of table time for an answer: some carry the id, others only the path."""
    return serving.match_outcomes(*_requests_and_answers(v), timeout_s=3600)


# ingest -----------------------------------------------------------------------------------------

@query
def frame_check(v: EventViews) -> DataFrame:
    return _as_text(ingest.split_frames(v.frames()).all.withColumn("body", F.decode("body", "UTF-8")), "schema_id")


@query
def json_contract(v: EventViews) -> DataFrame:
    return _as_text(ingest.parse_json(v.json_bodies(), INTENT).all, "file_size")


@query
def route_events(v: EventViews) -> DataFrame:
    return ingest.route(v.keyed_requests(), {**ingest.WEBHOOK_ROUTES, **ingest.EXTERNAL_ROUTES}).all


@query
def dispatch_topics(v: EventViews) -> DataFrame:
    handled = ["click", "purchase", "view"]
    return ingest.dispatch(v.frames().select("topic"), handled).all


@query
def require_fields(v: EventViews) -> DataFrame:
    requests = v.intent_requests().select("request_id", "file_name", "media_type")
    return ingest.require(requests, "file_name", "media_type").all


@query
def validate_intents(v: EventViews) -> DataFrame:
    judged = ingest.validate_intents(v.intent_requests(), "upload", "request_time", "request_id", True)
    return _as_text(judged.all, "file_size")


@query
def received_from_objects(v: EventViews) -> DataFrame:
    return ingest.received_from_objects(v.object_notifications(), NOW)


@query
def ready_from_objects(v: EventViews) -> DataFrame:
    return ingest.ready_from_objects(v.object_notifications(), NOW)


@query
def cdc_login(v: EventViews) -> DataFrame:
    return ingest.logins_from_changes(v.user_changes())


@query
def cdc_signup(v: EventViews) -> DataFrame:
    return ingest.signups_from_changes(v.user_changes())


@query
def cdc_signout(v: EventViews) -> DataFrame:
    return ingest.signouts_from_changes(v.session_changes(), v.users(), F.col("old.at"))


# scalar functions -------------------------------------------------------------------------------

@query
def file_size_text(v: EventViews) -> DataFrame:
    size = F.col("file_size") * (F.col("k") + 1) * (F.col("k") + 1)
    return v.events().select("event_id", size.alias("size"), S.file_size_text(size).alias("size_text"))


@query
def media_category(v: EventViews) -> DataFrame:
    return v.events().select("event_id", "media_type", S.media_category("media_type").alias("category"),
                             S.is_allowed_media_type("media_type").alias("allowed"))


@query
def notification_text(v: EventViews) -> DataFrame:
    log = notifications.notification_log(
        _log(v), *[notifications.notification(p, view) for p, view in [
            ("credit_bonus", v.signups()), ("upload_ready", v.signed()), ("upload_rejected", v.upload_rejected()),
            ("upload_completed", v.confirmed()), ("upload_expired", v.expired()), ("upload_failed", v.dead_letters()),
            ("download_ready", v.download_signed()), ("download_rejected", v.rejected_access()),
            ("file_deleted", v.deletes()), ("delete_rejected", v.rejected_access())]])
    return log.select("user_id", "event_type", "event_time",
                      S.notification_text("event_type", "payload", "event_time").alias("text"))


@query
def retry_count_int(v: EventViews) -> DataFrame:
    raw = F.when(F.col("value") < 10, F.lit("many")).otherwise(F.col("k").cast("string"))
    return v.events().select("event_id", S.retry_count_int(raw).alias("retry_count"))


# metrics ----------------------------------------------------------------------------------------

@query
def topic_status_counts(v: EventViews) -> DataFrame:
    return metrics.topic_status_counts(ingest.split_frames(v.frames()).all)


@query
def topic_errors(v: EventViews) -> DataFrame:
    return metrics.error_counts(ingest.split_frames(v.frames()).all)


@query
def metric_rollup_10s(v: EventViews) -> DataFrame:
    return (_text(metrics.rollup(v.event_gauge()), "bucket").withColumn("total", _rounded("total")))


@query
def metric_rate(v: EventViews) -> DataFrame:
    return _text(metrics.rate(v.request_counts(), COUNT), "ts").select(
        "series", "ts", _rounded("rate").alias("rate"))


@query
def metric_rate_by(v: EventViews) -> DataFrame:
    by = metrics.rate_by(v.request_counts(), COUNT, ["otel_scope_name"], {STATUS: "~2..|5.."})
    return _text(by, "ts").withColumn("rate", _rounded("rate"))


@query
def error_ratio(v: EventViews) -> DataFrame:
    ratio = metrics.error_ratio(v.request_counts(), COUNT, STATUS, labels=["otel_scope_name"])
    return _text(ratio, "ts").withColumn("ratio", _rounded("ratio"))


@query
def histogram_quantile(v: EventViews) -> DataFrame:
    rates = metrics.bucket_rates(v.request_buckets(), BUCKET, ["otel_scope_name"])
    rates = rates.withColumn("rate", _rounded("rate", 9))
    out = metrics.histogram_quantile([0.5, 0.95, 0.99], rates, ["otel_scope_name"])
    return _text(out, "ts").withColumn("quantile", _rounded("quantile"))


@query
def alert_for(v: EventViews) -> DataFrame:
    busy = metrics.rate_by(v.request_counts(), COUNT, ["otel_scope_name"])
    lasting = metrics.sustained(busy, F.col("rate") > 0, 300, ["otel_scope_name"])
    return _text(lasting, "ts", "since").select("otel_scope_name", "ts", "since", "firing")


@query
def alert_rules(v: EventViews) -> DataFrame:
    samples = (v.request_counts().unionByName(v.request_buckets()).unionByName(v.topic_counts())
               .unionByName(v.disk_gauges()))
    present = {"http_server_request_duration_seconds_count", "kafka_consumer_messages_total", "redpanda_storage_disk"}
    rules = [r for r in metrics.ALERT_RULES if r.metric in present]
    fired = metrics.alerts(samples, metrics.spine(*SPINE, samples), rules)
    return _text(fired, "ts", "since").withColumn("value", _rounded("value"))


@query
def metric_absent(v: EventViews) -> DataFrame:
    samples = v.request_counts()
    gone = metrics.absent(samples, COUNT, metrics.spine(*SPINE, samples), matchers={"otel_scope_name": "error"})
    return _text(gone, "ts")


@query
def disk_ratio(v: EventViews) -> DataFrame:
    """Free over total, both as last seen at each grid time."""
    gauges = metrics.at_steps(v.disk_gauges())
    disk = metrics.labels_of(F.col("series"))["disk"].alias("disk")
    free, total = (gauges.filter(F.col("metric") == f"redpanda_storage_disk_{part}_bytes").select(disk, "ts", "value")
                   for part in ("free", "total"))
    return _text(metrics.ratio(free, total, ["disk", "ts"]), "ts")


@query
def metric_latest(v: EventViews) -> DataFrame:
    return metrics.latest_by(v.request_counts(), COUNT, ["otel_scope_name"])


@query
def saga_funnel(v: EventViews) -> DataFrame:
    return _text(metrics.saga_funnel(v.staged_events()), "bucket")


@query
def consumer_lag(v: EventViews) -> DataFrame:
    return metrics.consumer_lag(*v.offsets())


@query
def dlq_growth(v: EventViews) -> DataFrame:
    growing = metrics.rate(v.topic_counts(), "kafka_consumer_messages_total",
                           matchers={"topic": "~internal.media.*.dead-letter"})
    lasting = metrics.sustained(growing, F.col("rate") > 0, 120, ["series"])
    return (_text(lasting, "ts", "since").filter("firing")
            .select("series", "ts", "since", _rounded("rate").alias("rate")))


# governance -------------------------------------------------------------------------------------

@query
def masked_logins(v: EventViews) -> DataFrame:
    return governance.mask_columns(identity.echo(v.logins()), {"email": "pii", "ip_address": "pii"})


@query
def contract_violations(v: EventViews) -> DataFrame:
    rules = {"type is known": F.col("event_type").isin("LOGIN", "SIGNUP")}
    return governance.violation_counts(governance.contract_violations(
        _unified(v), "internal.platform.unified.events", rules))


@query
def resolved_payloads(v: EventViews) -> DataFrame:
    """A payload per event, written with three schemas and one nobody knows, read with one."""
    number = F.col("k").cast("bigint")
    body = F.when(number % 4 == 0, S.json_object(user_id=F.col("user_id"), size=number)).otherwise(
        S.json_object(user_id=F.when(F.col("value") < 80, F.col("user_id")), size=number, time=F.col("time"), note=F.lit("n")))
    rows = v.events().select("event_id", (number % 4 + 1).alias("version"), body.alias("body"))
    schemas = {1: "user_id string, size int", 2: "user_id string, size bigint, time string, note string", 3: "user_id string, size string"}
    reading = T.StructType.fromDDL("user_id string not null, size bigint not null, time string not null, device string")
    resolved, rejected = governance.resolve_payloads(rows, "body", "version", {n: T.StructType.fromDDL(x) for n, x in schemas.items()},
                                                     reading, {"time": F.lit("")})
    both = resolved.unionByName(rejected.drop("body"), allowMissingColumns=True)
    return both.select(*[F.col(c).cast("string").alias(c) for c in ("event_id", "version", *reading.names, "reason")])


@query
def access_patterns(v: EventViews) -> DataFrame:
    out = None
    for name, rows in serving.access_patterns(_log(v)).items():
        part = rows.groupBy("event_type").agg(F.count("*").alias("n")).withColumn("target", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


# streams ----------------------------------------------------------------------------------------
# The topics are landed as files, the streaming job runs until it has caught up, and its output is read back.

LOGIN, SIGNUP = "public.identity.login.events", "public.identity.signup.events"
SIGNED, EXPIRED = "public.media.upload.signed", "public.media.expired.events"
INTENT, GOT, READY = "internal.media.upload.intent", "internal.media.upload.received", "internal.media.file.ready"
CONFIRMED = "public.media.upload.confirmed"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def _land(v: EventViews, **topics: DataFrame) -> str:
    root = shared_dir(v.spark)
    for name, rows in topics.items():
        conform(rows, name).write.mode("append").parquet(f"{root}/{name}")
    return root


def _with_end(rows: DataFrame, topic: str, time: str) -> DataFrame:
    """The rows and one more after them on a key of its own, which lets the watermark pass everything else."""
    end = rows.sparkSession.range(1).select(*[
        F.lit(NOW if f.name == time else "end" if f.dataType.simpleString() == "string" else 0).cast(f.dataType)
        .alias(f.name) for f in TOPICS[topic]])
    return conform(rows, topic).unionByName(end)


def _caught_up(stream: DataFrame, root: str) -> DataFrame:
    sinks.start(stream, sinks.append_sink(f"{root}/out"), f"{root}/checkpoint").awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/out").select(*stream.columns)


@query
def olap_job(v: EventViews) -> DataFrame:
    """The unified topic, and a replay of it with other emails, through the OLAP job: the rows ingested last stay."""
    root = _land(v, **{jobs.UNIFIED: _unified(v)})
    conform(_unified(v).withColumn("email", F.upper("email")), jobs.UNIFIED).write.mode("append").parquet(f"{root}/{jobs.UNIFIED}")
    jobs.start_olap(v.spark, root, f"{root}/table", f"{root}/checkpoints").awaitTermination()
    table = v.spark.read.parquet(f"{root}/table").select(*TOPICS[jobs.UNIFIED].names)
    return _text(table, "event_time")


@query
def stream_ttl_expired(v: EventViews) -> DataFrame:
    v.spark.conf.set(STATE_STORE, BASE_CONF[STATE_STORE])
    root = _land(v, **{SIGNED: v.signed(), GOT: _with_end(v.received(), GOT, "upload_time")})
    return _caught_up(processors.expired_uploads_stream(read_topic(v.spark, SIGNED, root),
                                                        read_topic(v.spark, GOT, root)), root)


@query
def stream_move_saga(v: EventViews) -> DataFrame:
    v.spark.conf.set(STATE_STORE, BASE_CONF[STATE_STORE])
    root = _land(v, **{GOT: v.received(MOVE_SPEED), READY: _with_end(v.ready(), READY, "upload_time")})
    return _caught_up(processors.move_saga_stream(read_topic(v.spark, GOT, root),
                                                  read_topic(v.spark, READY, root)), root)


@query
def stream_credit_check(v: EventViews) -> DataFrame:
    v.spark.conf.set(STATE_STORE, BASE_CONF[STATE_STORE])
    root = _land(v, **{INTENT: v.upload_intents(), SIGNUP: _with_end(v.signups(), SIGNUP, "signup_time")})
    bonus = credits.signup_bonus(read_topic(v.spark, SIGNUP, root))
    return _caught_up(processors.credit_check_stream(read_topic(v.spark, INTENT, root), bonus), root)


def _media_topics(v: EventViews) -> dict[str, DataFrame]:
    """The topics that the media handlers leave, after all intents and a replay of them."""
    v.spark.conf.set(STATE_STORE, BASE_CONF[STATE_STORE])
    asked = _asked(v)
    root = _land(v, **{CONFIRMED: _with_end(v.confirmed(), CONFIRMED, "upload_time"),
                       jobs.DOWNLOAD: asked["download"].unionByName(asked["download"]),
                       jobs.DELETE: asked["delete"].unionByName(asked["delete"])})
    jobs.start_media_handlers(v.spark, root, f"{root}/topics", f"{root}/checkpoints", _effects).awaitTermination()
    return {topic: v.spark.read.schema(TOPICS[topic]).parquet(f"{root}/topics/{topic}") for topic in (
        "public.media.download.signed", "public.media.download.rejected", "public.media.delete.events",
        "public.media.delete.rejected", "internal.media.delete.retry")}


def _outcome(df: DataFrame, outcome: str, time: str, columns: list[str]) -> DataFrame:
    df = df.withColumns({"outcome": F.lit(outcome), "outcome_time": F.col(time)})
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


@query
def stream_download_outcomes(v: EventViews) -> DataFrame:
    topics = _media_topics(v)
    columns = ["outcome", "user_id", "file_path", "request_id", "download_url", "reason", "outcome_time"]
    return _outcome(topics["public.media.download.signed"], "signed", "signed_time", columns).unionByName(
        _outcome(topics["public.media.download.rejected"], "download_rejected", "rejected_time", columns))


@query
def stream_delete_outcomes(v: EventViews) -> DataFrame:
    topics = _media_topics(v)
    columns = ["outcome", "user_id", "file_path", "request_id", "file_name", "media_type", "reason", "outcome_time"]
    return (_outcome(topics["public.media.delete.events"], "deleted", "delete_time", columns)
            .unionByName(_outcome(topics["public.media.delete.rejected"], "delete_rejected", "rejected_time", columns))
            .unionByName(_outcome(topics["internal.media.delete.retry"], "retry", "failed_at", columns)))


def _loop(v: EventViews, topic: str, retries: DataFrame, effects, targets: list[str], columns: list[str]) -> DataFrame:
    """What a retry loop leaves in its topics, after all retries and a replay of them. `n` is the number of a chain's rows there."""
    v.spark.conf.set(STATE_STORE, BASE_CONF[STATE_STORE])
    root, rows = shared_dir(v.spark), conform(retries, topic)
    for number in range(2):
        sinks.append_sink(f"{root}/{topic}", "first")(rows, number)
    jobs.run_retry_loop(v.spark, topic, root, f"{root}/checkpoints", effects)
    out = None
    for target in targets:
        path = f"{root}/{target}"
        part = v.spark.read.schema(TOPICS[target]).parquet(path).withColumn("topic", F.lit(target))
        part = part.select("topic", *columns, F.col("retry_count").cast("string").alias("retry_count"))
        out = part if out is None else out.unionByName(part)
    return out.distinct()


@query
def stream_delete_retry_loop(v: EventViews) -> DataFrame:
    """Removals tried again until one works or the count is at its limit; three in four attempts fail."""
    def effects(rows: DataFrame) -> DataFrame:
        number = F.substring_index("request_id", "-", -1).cast("bigint")
        return rows.withColumns({"removed_ok": (number + F.col("retry_count")) % 4 == 0, "error": F.lit("remove failed")})
    retries = v.delete_retries().withColumn("retry_count", F.col("retry_count").cast("int"))
    return _loop(v, jobs.DELETE_RETRY, retries, effects, [jobs.DELETE_RETRY, "internal.media.delete.dead-letter"], ["request_id", "file_path"])


@query
def stream_upload_retry_loop(v: EventViews) -> DataFrame:
    """Moves tried again until one works, which sends the upload back to the saga, or the count is at its limit."""
    def effects(rows: DataFrame) -> DataFrame:
        return rows.withColumn("moved_ok", (F.col("file_size") + F.col("retry_count")) % 3 == 0)
    targets = [jobs.RETRY, "internal.media.upload.received", "internal.media.upload.dead-letter"]
    return _loop(v, jobs.RETRY, v.upload_retries(), effects, targets, ["user_id", "permanent_path", "upload_time"])


def _in_parts(rows: DataFrame, root: str, order: str, run: Callable[[DataFrame], StreamingQuery], parts: int = 3) -> None:
    """The rows through a job in several batches, in the order of a column's hash: a part is landed by all tasks, then the job runs."""
    for part in range(parts):
        _land_part(rows.where(F.pmod(F.xxhash64(order), F.lit(parts)) == part), root, run)


def _land_part(rows: DataFrame, root: str, run: Callable[[DataFrame], StreamingQuery]) -> None:
    rows.write.mode("append").parquet(f"{root}/in")
    run(rows.sparkSession.readStream.schema(rows.schema).parquet(f"{root}/in")).awaitTermination()


@query
def stream_credit_balances(v: EventViews) -> DataFrame:
    """The ledger in several batches through the job that keeps the balances."""
    v.spark.conf.set(STATE_STORE, BASE_CONF[STATE_STORE])
    root = shared_dir(v.spark)
    _in_parts(_ledger(v), root, "event_time", lambda ledger: jobs.start_balances(v.spark, ledger, f"{root}/table", f"{root}/checkpoints"))
    schema = credits.balances(_ledger(v)).withColumn("version", F.lit(0).cast("bigint")).schema
    return tables.read(v.spark, f"{root}/table", schema, jobs.newest_balance).drop("version")


@query
def stream_history_top20(v: EventViews) -> DataFrame:
    """The notification log in several batches through the job that keeps the newest rows of each viewer."""
    root = shared_dir(v.spark)
    _in_parts(_log(v), root, "event_time", lambda log: jobs.start_history(v.spark, log, f"{root}/table", f"{root}/checkpoints"))
    schema = serving.audience(_log(v)).select("viewer", *serving.SHOWN).schema
    kept = tables.read(v.spark, f"{root}/table", schema, serving.newest_per_viewer)
    return serving.history_from_kept(kept, v.users().select(F.col("id").alias("viewer")))


@query
def olap_delta_job(v: EventViews) -> DataFrame:
    """As `olap_job`, into a kept table of deltas."""
    root = _land(v, **{jobs.UNIFIED: _unified(v)})
    jobs.start_olap_deltas(v.spark, root, f"{root}/table", f"{root}/checkpoints").awaitTermination()
    conform(_unified(v).withColumn("email", F.upper("email")), jobs.UNIFIED).write.mode("append").parquet(f"{root}/{jobs.UNIFIED}")
    jobs.start_olap_deltas(v.spark, root, f"{root}/table", f"{root}/checkpoints").awaitTermination()
    typed, _ = olap.typed_events(read_topic(v.spark, jobs.UNIFIED, root, streaming=False, with_order=True))
    schema = typed.withColumns({"version": F.lit(0).cast("bigint"), "event_date": F.to_date("event_time")}).schema
    table = tables.read(v.spark, f"{root}/table", schema, jobs.newest_event)
    return _text(table.select(*TOPICS[jobs.UNIFIED].names), "event_time")


def _with_last(rows: DataFrame) -> DataFrame:
    """The rows and one far behind them, which lets the watermark pass everything else."""
    last = rows.agg(*[F.max_by(c, "ts").alias(c) if c != "ts" else (F.max("ts") + F.expr("interval 30 days")).alias("ts") for c in rows.columns])
    return rows.unionByName(last)


@query
def stream_metric_rollup_10s(v: EventViews) -> DataFrame:
    root, samples = shared_dir(v.spark), v.event_gauge()
    _with_last(samples).write.parquet(f"{root}/in")
    stream = v.spark.readStream.schema(samples.schema).parquet(f"{root}/in")
    return _text(_caught_up(metrics.rollup_stream(stream), root), "bucket").withColumn("total", _rounded("total"))


@query
def stream_saga_funnel(v: EventViews) -> DataFrame:
    root, events = shared_dir(v.spark), v.staged_events()
    _with_last(events).write.parquet(f"{root}/in")
    stream = v.spark.readStream.schema(events.schema).parquet(f"{root}/in")
    return _text(_caught_up(metrics.saga_funnel_stream(stream), root), "bucket")


@query
def stream_alert_for(v: EventViews) -> DataFrame:
    """As `alert_for`, from a stream of the rates."""
    v.spark.conf.set(STATE_STORE, BASE_CONF[STATE_STORE])
    root, busy = shared_dir(v.spark), metrics.rate_by(v.request_counts(), COUNT, ["otel_scope_name"])
    busy.write.parquet(f"{root}/in")
    rates = v.spark.read.parquet(f"{root}/in")
    rates.agg(F.lit("end").alias("otel_scope_name"), (F.max("ts") + F.expr("interval 30 days")).alias("ts"),
              F.lit(0.0).alias("rate")).write.mode("append").parquet(f"{root}/in")
    stream = v.spark.readStream.schema(rates.schema).parquet(f"{root}/in")
    lasting = _caught_up(processors.sustained_stream(stream, F.col("rate") > 0, 300, ["otel_scope_name"]), root)
    return _text(lasting, "ts", "since").select("otel_scope_name", "ts", "since", "firing")


@query
def stream_metric_absent(v: EventViews) -> DataFrame:
    """As `metric_absent`, from a stream of samples and one of heartbeats."""
    v.spark.conf.set(STATE_STORE, BASE_CONF[STATE_STORE])
    root, samples = shared_dir(v.spark), v.request_counts()
    beats = metrics.spine(*SPINE, samples)
    sides = []
    for name, rows in [("samples", samples), ("beats", beats)]:
        _with_last(rows).write.parquet(f"{root}/{name}")
        sides.append(v.spark.readStream.schema(rows.schema).parquet(f"{root}/{name}"))
    gone = metrics.absent_stream(sides[0], COUNT, sides[1], matchers={"otel_scope_name": "error"})
    return _text(_caught_up(gone, root), "ts")


@query
def stream_request_outcomes(v: EventViews) -> DataFrame:
    """As `request_outcomes`; the requests are landed twice, and a last row of each side lets the watermark pass all others."""
    v.spark.conf.set(STATE_STORE, BASE_CONF[STATE_STORE])
    requests, answers = _requests_and_answers(v)
    root, sides = shared_dir(v.spark), []
    for name, rows, time in [("requests", requests.unionByName(requests), "request_time"), ("answers", answers, "event_time")]:
        last = v.spark.range(1).select(*[F.lit(NOW if f.name == time else None).cast(f.dataType).alias(f.name) for f in rows.schema])
        rows.unionByName(last).write.parquet(f"{root}/{name}")
        sides.append(v.spark.readStream.schema(rows.schema).parquet(f"{root}/{name}"))
    return _caught_up(serving.match_outcomes_stream(*sides, timeout_s=3600), root)


@query
def stream_dedup(v: EventViews) -> DataFrame:
    """The unified topic with every row twice, through the watermarked dedup."""
    root = _land(v, **{jobs.UNIFIED: _unified(v).unionByName(_unified(v))})
    stream = read_topic(v.spark, jobs.UNIFIED, root).withColumn("ts", S.typed_time("event_time"))
    return _caught_up(olap.dedup_stream(stream, olap.EVENT_KEY, "ts", "60 days").drop("ts"), root)


@query
def stream_dedup_replays(v: EventViews) -> DataFrame:
    """The unified topic in several batches, and the whole topic again as a later batch, into the table of first rows."""
    root = shared_dir(v.spark)
    write = dedup.first_rows(f"{root}/table", olap.EVENT_KEY, S.typed_time("event_time"))
    run = lambda stream: sinks.start(stream, write, f"{root}/checkpoint")
    _in_parts(_unified(v), root, "event_id", run)
    _land_part(_unified(v), root, run)
    return dedup.table(v.spark, f"{root}/table", _unified(v).schema).drop("batch", "day")


@query
def stream_ledger(v: EventViews) -> DataFrame:
    """Signups and expiries through the projection jobs; the ledger they leave."""
    root = _land(v, **{SIGNUP: v.signups(), EXPIRED: v.expired()})
    for job in jobs.start_projections(v.spark, root, f"{root}/tables", f"{root}/checkpoints", [SIGNUP, EXPIRED]):
        job.awaitTermination()
    ledger = TABLES["credit_ledger"]
    return v.spark.read.schema(ledger).parquet(f"{root}/tables/{jobs.LEDGER}").select(*ledger.names)


@query
def partition_rewrite(v: EventViews) -> DataFrame:
    """All days written, then one day written again: the other days stay, the day is not doubled."""
    target = f"{shared_dir(v.spark)}/daily"
    days = identity.login_aggregates_backfill(v.logins(), v.signups())
    sinks.overwrite_partitions(days, target)
    sinks.overwrite_partitions(identity.daily_login_aggregates(v.logins(), v.signups(), DT), target)
    return v.spark.read.schema(days.schema).parquet(target)
