"""Deadline rules over two streams, in closed form, and the routing around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.scalars import col, iso_micros, micros, retry_count_int
from eventmart.operators import scans

# Deadlines, retry limit and the dead-letter reason.
UPLOAD_TTL_S, MOVE_TIMEOUT_S, MAX_RETRIES = 900, 120, 3
MAX_RETRIES_EXCEEDED = "max retries exceeded"

GRAIN_S = 21_600  # chunk of the ordered scans: one plan for every size
RECEIVED = ["user_id", "email", "file_path", "file_name", "file_size", "media_type", "upload_time",
            "permanent_path", "retry_count"]
DELETE_FIELDS = ["user_id", "file_path", "file_name", "media_type", "file_size", "request_id"]


def expired_uploads(signed: DataFrame, received: DataFrame, ttl_s: int = UPLOAD_TTL_S,
                    grain_s: int = GRAIN_S) -> DataFrame:
    """Signed uploads whose object did not arrive in time.

    Signed events of one path that follow each other within the time limit form a chain: each moves the
    deadline, so the chain ends at its last event + `ttl_s` and gives at most one row, with the fields of that
    event. A receipt saves the chain if it comes no later than the deadline, no earlier than `ttl_s`
    before the chain's start, and after the deadline of the chain before. Rows whose time cannot be read take no part
    (see `ingest.unreadable`).
    """
    path, ttl = ["file_path"], ttl_s * scans.SECOND
    fields = ["user_id", "file_name", "request_id", "signed_time"]
    events = signed.select(*path, *fields, micros("signed_time").alias("_us")).filter("_us is not null")
    receipts = received.select(*path, micros("upload_time").alias("_us")).filter("_us is not null")
    grain_s = grain_s and max(grain_s, 2 * ttl_s)

    # Neighbours matter only within two time limits, so halo rows are enough to find chain starts and ends.
    near = scans.halo(events, "_us", back_s=2 * ttl_s, ahead_s=ttl_s, grain_s=grain_s)
    window = scans.local_window(path, ["_us", "request_id"])
    t = F.col("_us")
    starts = F.coalesce(t - F.col("_prev") > ttl, F.lit(True))
    ends = F.coalesce(F.col("_next") - t > ttl, F.lit(True))
    links = scans.own_rows(
        near.withColumns({"_prev": F.lag("_us").over(window), "_next": F.lead("_us").over(window)})
    ).withColumns({
        # the earliest receipt that still counts, known on the chain's first event
        "_from": F.when(starts, F.greatest(t - ttl, F.col("_prev") + ttl + 1)),
        "_ends": ends,
    })

    # One line per path: chain starts at their time, receipts at theirs, chain ends at the deadline.
    # On the deadline's line, the last start and the last receipt so far settle the case.
    marks = (links.filter("_from is not null").select(*path, "_us", F.lit(0).alias("_rank"), "_from")
             .unionByName(receipts.select(*path, "_us", F.lit(0).alias("_rank"), F.col("_us").alias("_seen")),
                          allowMissingColumns=True)
             .unionByName(links.filter("_ends").select(*path, (t + ttl).alias("_us"), F.lit(1).alias("_rank"),
                                                       F.struct(*fields).alias("_last")),
                          allowMissingColumns=True))
    line = scans.running_max(scans.chunked(marks, "_us", grain_s), path, ["_us", "_rank"],
                             {"_lower": F.col("_from"), "_receipt": F.col("_seen")}, grain_s)
    late = F.coalesce(F.col("_receipt") < F.col("_lower"), F.lit(True))
    return line.filter(F.col("_last").isNotNull() & late).select(
        "_last.user_id",
        *path,
        "_last.file_name",
        F.lit(0).cast("bigint").alias("file_size"),
        F.lit("").alias("media_type"),
        "_last.request_id",
        F.col("_last.signed_time").alias("request_time"),
        iso_micros("_us").alias("expired_time"),
    )


def move_saga(received: DataFrame, ready: DataFrame, timeout_s: int = MOVE_TIMEOUT_S,
              max_retries: int = MAX_RETRIES, grain_s: int = GRAIN_S) -> DataFrame:
    """Outcome of every received upload: confirmed, retry or dead_letter, as one wide row (`_type`).

    Per permanent path, received and ready rows in time order form runs: a new run starts where the kind
    repeats or more than `timeout_s` passes. Inside a run the kinds alternate and pair up two by two, so
    a row opens a pair iff it is of the kind its run started with. A paired received row is confirmed at the
    later time of the two. An unpaired one is replaced without output by a received row within the time
    limit, else it is retried, or dead-lettered once it has been retried `max_retries` times. Rows whose time cannot
    be read take no part (see `ingest.unreadable`).
    """
    path, limit = ["permanent_path"], timeout_s * scans.SECOND
    rows = (received.select(*RECEIVED, micros("upload_time").alias("_us"), F.lit(0).alias("_kind"))
            .unionByName(ready.select(F.col("file_path").alias("permanent_path"),
                                      micros("upload_time").alias("_us"), F.lit(1).alias("_kind")),
                         allowMissingColumns=True).filter("_us is not null"))

    grain_s = grain_s and max(grain_s, timeout_s)
    near = scans.halo(rows, "_us", back_s=timeout_s, ahead_s=timeout_s, grain_s=grain_s)
    order = ["_us", "_kind", "retry_count"]
    window = scans.local_window(path, order)
    t, kind = F.col("_us"), F.col("_kind")
    follows = (t - F.col("_prev._us") <= limit) & (F.col("_prev._kind") != kind)
    steps = scans.own_rows(near.withColumns({
        "_prev": F.lag(F.struct("_us", "_kind")).over(window),
        "_next": F.lead(F.struct("_us", "_kind")).over(window),
    })).withColumn("_start", F.when(~F.coalesce(follows, F.lit(False)), t * 2 + kind))

    # The latest run start so far carries its kind in the lowest bit.
    runs = scans.running_max(steps, path, order, {"_run": F.col("_start")}, grain_s)
    opens = F.col("_run") % 2 == kind
    next_in_time = F.coalesce(F.col("_next._us") - t <= limit, F.lit(False))
    next_kind = F.col("_next._kind")
    confirmed_us = (F.when(~opens, t).when(next_in_time & (next_kind != kind), F.col("_next._us")))
    replaced = next_in_time & (next_kind == kind)
    outcome = (F.when(F.col("_confirmed_us").isNotNull(), F.lit("confirmed"))
                .when(F.col("retry_count") < max_retries, F.lit("retry"))
                .otherwise(F.lit("dead_letter")))
    return (runs.filter(kind == 0)
            .withColumn("_confirmed_us", confirmed_us)
            .filter(F.col("_confirmed_us").isNotNull() | ~replaced)
            .select(outcome.alias("_type"), *RECEIVED,
                    iso_micros(F.coalesce("_confirmed_us", t + limit)).alias("outcome_time")))


def move_branches(wide: DataFrame) -> dict[str, DataFrame]:
    """The three event streams of the move saga, each with the columns of its topic."""
    time = F.col("outcome_time")
    confirmed = ["user_id", "email", F.col("permanent_path").alias("file_path"), "file_name", "file_size",
                 "media_type", "upload_time"]
    return route_outcomes(wide, "_type", {
        "confirmed": confirmed,
        "retry": [*RECEIVED, time.alias("retry_time")],
        "dead_letter": [*RECEIVED, F.lit(MAX_RETRIES_EXCEEDED).alias("failure_reason"),
                        time.alias("dead_letter_time")],
    })


def route_outcomes(wide: DataFrame, discriminator: str, columns: dict[str, list]) -> dict[str, DataFrame]:
    """One frame per outcome name, with that outcome's columns."""
    return {name: wide.filter(F.col(discriminator) == name).select(*cols) for name, cols in columns.items()}


def credit_branches(decisions: DataFrame) -> dict[str, DataFrame]:
    """Approved and rejected uploads with the columns of their topics."""
    common = ["user_id", "file_name", "media_type", "file_size", "request_id"]
    return route_outcomes(decisions, "outcome", {
        "approved": [*common, "request_time"],
        "rejected": [*common, "reason", "rejected_time"],
    })


def retry_step(retries: DataFrame, now: str | Column = "retry_time", max_retries: int = MAX_RETRIES) -> DataFrame:
    """Next step of an upload retry, by its move result (`moved_ok`).

    Moved: back into the saga with count + 1. Not moved: another retry with count + 1, and a dead letter
    at the limit, so a failing move cannot end silently.
    """
    count = retry_count_int("retry_count")
    exhausted = count >= max_retries
    step = (F.when(F.col("moved_ok"), F.lit("received"))
             .when(exhausted, F.lit("dead_letter"))
             .otherwise(F.lit("retry")))
    return retries.select(
        step.alias("outcome"),
        *[c for c in RECEIVED if c != "retry_count"],
        F.when(step == "dead_letter", count).otherwise(count + 1).alias("retry_count"),
        F.when(step == "dead_letter", F.lit(MAX_RETRIES_EXCEEDED)).alias("failure_reason"),
        F.when(step != "received", col(now)).alias("outcome_time"),
    )


def reenter_retries(retries: DataFrame) -> DataFrame:
    """Retries whose move worked, as received events with count + 1."""
    return retry_step(retries).filter(F.col("outcome") == "received").select(*RECEIVED)


def route_delete_retries(retries: DataFrame, now: str | Column = "failed_at",
                         max_retries: int = MAX_RETRIES) -> DataFrame:
    """Failed removals (`removed_ok` not true): retry with count + 1, or dead letter at the limit; successes give nothing."""
    count = retry_count_int("retry_count")
    exhausted = count >= max_retries
    reason = F.col("error") if "error" in retries.columns else F.lit("remove failed")
    return retries.filter(~F.coalesce("removed_ok", F.lit(False))).select(
        F.when(exhausted, F.lit("dead_letter")).otherwise(F.lit("retry")).alias("outcome"),
        *DELETE_FIELDS,
        F.when(exhausted, count).otherwise(count + 1).alias("retry_count"),
        F.when(exhausted, reason).alias("failure_reason"),
        col(now).alias("outcome_time"),
    )


def retry_branches(steps: DataFrame) -> dict[str, DataFrame]:
    """The rows of `retry_step` by topic, each with the columns of its topic."""
    of = route_outcomes(steps, "outcome", {
        "received": RECEIVED,
        "retry": [*RECEIVED, F.col("outcome_time").alias("retry_time")],
        "dead_letter": [*RECEIVED, "failure_reason", F.col("outcome_time").alias("dead_letter_time")]})
    return {"internal.media.upload.received": of["received"], "internal.media.upload.retry": of["retry"],
            "internal.media.upload.dead-letter": of["dead_letter"]}


def delete_retry_branches(steps: DataFrame) -> dict[str, DataFrame]:
    """The rows of `route_delete_retries` by topic, each with the columns of its topic."""
    of = route_outcomes(steps, "outcome", {
        "retry": [*DELETE_FIELDS, "retry_count", F.col("outcome_time").alias("failed_at")],
        "dead_letter": [*DELETE_FIELDS, "retry_count", "failure_reason", F.col("outcome_time").alias("dead_letter_time")]})
    return {"internal.media.delete.retry": of["retry"], "internal.media.delete.dead-letter": of["dead_letter"]}


def orphan_dead_letters(dead_letters: DataFrame, confirmed: DataFrame) -> DataFrame:
    """Dead letters never followed by a success on the same permanent path."""
    latest = confirmed.groupBy("file_path").agg(F.max(micros("upload_time")).alias("_ok"))
    latest = latest.withColumnRenamed("file_path", "permanent_path")
    return (scans.lookup(dead_letters, latest, ["permanent_path"])
            .filter(F.col("_ok").isNull() | (F.col("_ok") <= micros("dead_letter_time")))
            .drop("_ok"))
