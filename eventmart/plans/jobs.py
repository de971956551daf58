"""Continuous jobs: which tables and topics each source topic feeds, and the sagas between topics."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventmart.operators import credits, identity, ingest, media, notifications, olap, sagas, serving
from eventmart.sources.topics import read_topic
from eventmart.streaming import processors, sinks, tables

DOWNLOAD, DELETE = "internal.media.download.intent", "internal.media.delete.intent"
LOG, LEDGER, FILES, UNIFIED = "user_notifications", "credit_ledger", "media_files", "internal.platform.unified.events"


def _note(name: str) -> tuple[str, Callable[[DataFrame], DataFrame]]:
    return LOG, lambda df: notifications.notification_log(notifications.notification(name, df))


# What each topic's rows become: (target, shape) pairs, all written from one read of the topic.
PROJECTION_JOBS: dict[str, list[tuple[str, Callable[[DataFrame], DataFrame]]]] = {
    "public.identity.login.events": [_note("login"), (UNIFIED, partial(identity.unified_part, kind="LOGIN"))],
    "public.identity.signup.events": [_note("signup"), _note("credit_bonus"), (LEDGER, credits.signup_bonus),
                                      (UNIFIED, partial(identity.unified_part, kind="SIGNUP"))],
    "public.identity.signout.events": [_note("signout"), (UNIFIED, partial(identity.unified_part, kind="SIGNOUT"))],
    "public.user.message.events": [(LOG, notifications.message_notification)],
    "public.media.upload.confirmed": [_note("upload_completed"), (FILES, media.new_files)],
    "public.media.expired.events": [_note("upload_expired"), _note("credit_refund"), (LEDGER, credits.expiry_refund)],
    "public.media.upload.signed": [_note("upload_ready")],
    "public.media.upload.rejected": [_note("upload_rejected")],
    "public.media.download.signed": [_note("download_ready")],
    "public.media.download.rejected": [_note("download_rejected")],
    "public.media.delete.events": [_note("file_deleted")],
    "public.media.delete.rejected": [_note("delete_rejected")],
    "internal.media.upload.dead-letter": [_note("upload_failed")],
}


def projection_writer(topic: str, target: str) -> sinks.BatchWriter:
    """All projections of a topic from one persisted batch. Each part of a table is kept apart by its source."""
    jobs = PROJECTION_JOBS[topic]
    targets = {f"{i}:{table}": (None, shape) for i, (table, shape) in enumerate(jobs)}

    def writer(name: str) -> sinks.BatchWriter:
        number, table = name.split(":", 1)
        return sinks.append_sink(f"{target.rstrip('/')}/{table}", f"{topic}.{number}")

    return sinks.fan_out(targets, writer)


def start_projections(spark: SparkSession, source: str, target: str, checkpoints: str,
                      topics: list[str] | None = None, interval: str | None = None) -> list[StreamingQuery]:
    """One streaming query per source topic, each with its own checkpoint."""
    return [sinks.start(read_topic(spark, topic, source), projection_writer(topic, target),
                        f"{checkpoints.rstrip('/')}/{topic}", interval)
            for topic in topics or PROJECTION_JOBS]


def _to_topics(outcomes: Callable[[DataFrame], dict[str, DataFrame]], topics: dict[str, str], target: str
               ) -> sinks.BatchWriter:
    """Outcome branches of a wide row into their topics."""
    return sinks.fan_out({topic: (None, lambda df, n=name: outcomes(df)[n]) for name, topic in topics.items()},
                         lambda topic: sinks.append_sink(f"{target.rstrip('/')}/{topic}", "saga"))


def start_move_saga(spark: SparkSession, source: str, target: str, checkpoints: str, delay: str = processors.DELAY,
                    interval: str | None = None) -> StreamingQuery:
    wide = processors.move_saga_stream(read_topic(spark, "internal.media.upload.received", source),
                                       read_topic(spark, "internal.media.file.ready", source), delay)
    writer = _to_topics(sagas.move_branches, {"confirmed": "public.media.upload.confirmed",
                                              "retry": "internal.media.upload.retry",
                                              "dead_letter": "internal.media.upload.dead-letter"}, target)
    return sinks.start(wide, writer, f"{checkpoints.rstrip('/')}/move-saga", interval)


def start_credit_check(spark: SparkSession, source: str, target: str, checkpoints: str,
                       delay: str = processors.DELAY, interval: str | None = None) -> StreamingQuery:
    """Decisions into their topics and deductions into the ledger. Credits come from the events that cause them."""
    credit_rows = credits.signup_bonus(read_topic(spark, "public.identity.signup.events", source)).unionByName(
        credits.expiry_refund(read_topic(spark, "public.media.expired.events", source)))
    wide = processors.credit_check_stream(read_topic(spark, "internal.media.upload.intent", source), credit_rows, delay)
    branches = {"approved": "public.media.upload.approved", "rejected": "public.media.upload.rejected"}
    targets = {topic: (None, lambda df, n=name: sagas.credit_branches(df)[n]) for name, topic in branches.items()}
    targets[LEDGER] = (None, credits.deductions)
    writer = sinks.fan_out(targets, lambda t: sinks.append_sink(f"{target.rstrip('/')}/{t}", "credit-check"))
    return sinks.start(wide, writer, f"{checkpoints.rstrip('/')}/credit-check", interval)


def start_upload_ttl(spark: SparkSession, source: str, target: str, checkpoints: str,
                     delay: str = processors.DELAY, interval: str | None = None) -> StreamingQuery:
    expired = processors.expired_uploads_stream(read_topic(spark, "public.media.upload.signed", source),
                                                read_topic(spark, "internal.media.upload.received", source), delay)
    return sinks.start(expired, sinks.append_sink(f"{target.rstrip('/')}/public.media.expired.events", "upload-ttl"),
                       f"{checkpoints.rstrip('/')}/upload-ttl", interval)


def media_intents(spark: SparkSession, source: str, effects: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Download and delete intents as one stream. `effects` adds what the outside does for an intent: download_url,
    deleted_ok, removed_ok."""
    return effects(read_topic(spark, DOWNLOAD, source).withColumn("action", F.lit("download")).unionByName(
        read_topic(spark, DELETE, source).withColumn("action", F.lit("delete"))))


def start_media_handlers(spark: SparkSession, source: str, target: str, checkpoints: str, effects: Callable[[DataFrame], DataFrame],
                         delay: str = processors.DELAY, interval: str | None = None) -> StreamingQuery:
    """Download and delete intents into the topics of their outcomes, against the files as they are at that time."""
    wide = processors.media_outcomes_stream(read_topic(spark, "public.media.upload.confirmed", source),
                                            media_intents(spark, source, effects), delay)
    topics = list(media.outcome_branches(wide))
    targets = {topic: (None, lambda df, t=topic: media.outcome_branches(df)[t]) for topic in topics}
    writer = sinks.fan_out(targets, lambda topic: sinks.append_sink(f"{target.rstrip('/')}/{topic}", "media"))
    return sinks.start(wide, writer, f"{checkpoints.rstrip('/')}/media-handlers", interval)


RETRY, DELETE_RETRY = "internal.media.upload.retry", "internal.media.delete.retry"
# What names a chain of retries in each loop's topic, a retry's time, the step of one retry, and the topics of its outcomes.
RETRY_LOOPS = {
    RETRY: (["user_id", "permanent_path", "upload_time"], "retry_time", sagas.retry_step, sagas.retry_branches),
    DELETE_RETRY: (["user_id", "file_path", "request_id"], "failed_at", sagas.route_delete_retries, sagas.delete_retry_branches),
}


def start_retry_loop(spark: SparkSession, topic: str, topics: str, checkpoints: str, effects: Callable[[DataFrame], DataFrame],
                     interval: str | None = None) -> StreamingQuery:
    """The retries of a topic, whose failed attempts go back into the same topic.

    `effects` adds what an attempt brings: moved_ok or removed_ok. A failed attempt comes back with its count raised by one and
    goes to the dead letters at the limit, so a chain ends after `MAX_RETRIES` + 1 attempts. Replays of a retry are left out
    (`processors.first_attempts`). Rows go back through a folder table, as its source and batch, so a repeated batch replaces them.
    """
    keys, time, step, branches = RETRY_LOOPS[topic]
    rows = processors.first_attempts(read_topic(spark, topic, topics), keys, time)

    def writer(batch: DataFrame, batch_id: int) -> None:
        outcomes = step(effects(batch)).persist()
        try:
            for target, rows in branches(outcomes).items():
                sinks.append_sink(f"{topics.rstrip('/')}/{target}", f"loop.{topic}")(rows, batch_id)
        finally:
            outcomes.unpersist()

    return sinks.start(rows, writer, f"{checkpoints.rstrip('/')}/loop-{topic}", interval)


def run_retry_loop(spark: SparkSession, topic: str, topics: str, checkpoints: str, effects: Callable[[DataFrame], DataFrame]) -> int:
    """Runs a loop until it brings nothing new; the number of runs that did. More than the limit allows is an error."""
    for runs in range(sagas.MAX_RETRIES + 3):
        job = start_retry_loop(spark, topic, topics, checkpoints, effects)
        job.awaitTermination()
        if not sum(p.numInputRows for p in job.recentProgress):
            return runs
    raise RuntimeError(f"{topic} does not come to an end")


def start_balances(spark: SparkSession, ledger: DataFrame, table: str, checkpoints: str, interval: str | None = None) -> StreamingQuery:
    """The balance of each user as a kept table. A batch adds the balances it changed; the newest one of a user counts."""
    def writer(batch: DataFrame, batch_id: int) -> None:
        tables.keep(table, newest_balance)(batch.withColumn("version", F.lit(batch_id).cast("bigint")), batch_id)

    return sinks.start(credits.balances(ledger), writer, f"{checkpoints.rstrip('/')}/balances", interval, mode="update")


def newest_balance(rows: DataFrame) -> DataFrame:
    return olap.replace_by_key(rows, ["user_id"], "version")


def start_history(spark: SparkSession, log: DataFrame, table: str, checkpoints: str, n: int = 20,
                  interval: str | None = None) -> StreamingQuery:
    """The newest n rows of each viewer, and the newest n broadcasts once for all, as a kept table."""
    newest = partial(serving.newest_per_viewer, n=n)
    return sinks.start(serving.audience(log).select("viewer", *serving.SHOWN), tables.keep(table, newest),
                       f"{checkpoints.rstrip('/')}/history", interval)


def newest_event(rows: DataFrame) -> DataFrame:
    return olap.replace_by_key(rows, olap.EVENT_KEY, F.struct("version", "ingest_order"))


def start_olap_deltas(spark: SparkSession, source: str, table: str, checkpoints: str, interval: str | None = None,
                      compact_after: int = tables.COMPACT_AFTER) -> StreamingQuery:
    """The unified topic into a kept table, a folder for each day in every delta: a batch writes its own rows, whatever the days
    hold already. The row ingested last wins, when the table is read. Rows whose time cannot be read go to `<table>__rejected`."""
    def writer(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            typed, rejected = olap.typed_events(batch)
            rows = typed.withColumns({"version": F.lit(batch_id).cast("bigint"), "event_date": F.to_date("event_time")})
            tables.keep(table, newest_event, ["event_date"], compact_after)(rows, batch_id)
            sinks.append_sink(f"{table.rstrip('/')}__rejected", "olap")(rejected.drop("ingest_order"), batch_id)
        finally:
            batch.unpersist()

    return sinks.start(read_topic(spark, UNIFIED, source, with_order=True), writer, f"{checkpoints.rstrip('/')}/olap-deltas", interval)


def start_echo(spark: SparkSession, source: str, target: str, checkpoints: str,
               interval: str | None = None) -> StreamingQuery:
    logins = read_topic(spark, "public.identity.login.events", source)
    return sinks.topic_sink(identity.echo(logins), "internal.identity.login.echo", target,
                            f"{checkpoints.rstrip('/')}/echo", interval)


def start_olap(spark: SparkSession, source: str, table: str, checkpoints: str,
               interval: str | None = None) -> StreamingQuery:
    """The unified topic into the key-deduplicated table, one partition per day; the row ingested last wins.

    Rows of one batch are ordered by the source (see `read_topic`, `with_order`), later batches beat earlier ones. Rows
    whose time cannot be read go to `<table>__rejected`.
    """
    def writer(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            typed, rejected = olap.typed_events(batch)
            newest = olap.replace_by_key(typed, olap.EVENT_KEY, "ingest_order").drop("ingest_order")
            rows = newest.withColumns({"version": F.lit(batch_id).cast("bigint"), "event_date": F.to_date("event_time")})
            sinks.merge_by_key(table, olap.EVENT_KEY, "version", "event_date")(rows, batch_id)
            sinks.append_sink(f"{table.rstrip('/')}__rejected", "olap")(rejected.drop("ingest_order"), batch_id)
        finally:
            batch.unpersist()

    stream = read_topic(spark, UNIFIED, source, with_order=True)
    return sinks.start(stream, writer, f"{checkpoints.rstrip('/')}/olap", interval)


# The wire time and the keys of the topics whose rows are put in order; without them a row cannot be. The last two are
# the ledger's sources: a credit needs no time, since one that cannot be read counts before all others.
ORDERED_TOPICS = {
    "public.media.upload.signed": ("signed_time", "file_path"),
    "internal.media.upload.received": ("upload_time", "file_path", "permanent_path"),
    "internal.media.file.ready": ("upload_time", "file_path"),
    "internal.media.upload.intent": ("request_time", "user_id"),
    "public.media.upload.confirmed": ("upload_time", "user_id", "file_path"),
    DOWNLOAD: ("request_time", "user_id", "file_path"),
    DELETE: ("request_time", "user_id", "file_path"),
    "public.identity.signup.events": (None, "user_id"),
    "public.media.expired.events": (None, "user_id"),
}


def start_rejects(spark: SparkSession, source: str, target: str, checkpoints: str, topics: list[str] | None = None,
                  interval: str | None = None) -> list[StreamingQuery]:
    """Rows of the ordered topics without a readable time or a key, each topic into `<target>/rejected/<topic>`."""
    return [sinks.start(ingest.unreadable(read_topic(spark, topic, source), *ORDERED_TOPICS[topic]),
                        sinks.append_sink(f"{target.rstrip('/')}/rejected/{topic}", "unreadable"),
                        f"{checkpoints.rstrip('/')}/rejected-{topic}", interval)
            for topic in topics or ORDERED_TOPICS]
