"""Serving reads: who sees what, histories, latest rows, and matching requests to their outcomes."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions.scalars import micros
from eventmart.operators import scans

EVERYONE = "*"
MESSAGE = "user.message"


def visible_to(notifications: DataFrame, viewer: str | Column) -> DataFrame:
    """The rows one viewer may read: their own, broadcast messages, and messages sent to them."""
    viewer = F.lit(viewer) if isinstance(viewer, str) else viewer
    message = F.col("event_type") == MESSAGE
    return notifications.filter((F.col("user_id") == viewer)
                                | (message & (F.col("visibility") == "broadcast"))
                                | (message & F.col("recipient_id").eqNullSafe(viewer)))


def is_public() -> Column:
    return (F.col("event_type") == MESSAGE) & F.coalesce(F.col("visibility") == "broadcast", F.lit(False))


def audience(notifications: DataFrame) -> DataFrame:
    """Every row once per reader group: owner and recipient by name, or everyone (`*`) for a broadcast message.

    No join and no shuffle; a row becomes at most two. What a viewer sees is the rows under their name plus
    the rows under `*`, so the product of viewers and broadcasts is never written out.
    """
    public = notifications.filter(is_public()).withColumn("viewer", F.lit(EVERYONE))
    return _private(notifications).unionByName(public)


def _private(notifications: DataFrame) -> DataFrame:
    recipient = F.when(F.col("event_type") == MESSAGE, F.col("recipient_id"))
    viewers = F.array_distinct(F.array_compact(F.array(F.col("user_id"), recipient)))
    return notifications.filter(~is_public()).withColumn("viewer", F.explode(viewers))


def visible(notifications: DataFrame, viewers: DataFrame) -> DataFrame:
    """Readable rows of all given viewers (column `viewer`), broadcasts once under `*`."""
    private = scans.lookup(_private(notifications), viewers.select("viewer").distinct(), ["viewer"], "left_semi")
    return private.unionByName(notifications.filter(is_public()).withColumn("viewer", F.lit(EVERYONE)))


def own_rows(df: DataFrame, viewer: str | DataFrame) -> DataFrame:
    """Rows of one viewer, or of all viewers of a table (column `viewer`)."""
    if isinstance(viewer, str):
        return df.filter(F.col("user_id") == viewer)
    return scans.lookup(df, viewer.select(F.col("viewer").alias("user_id")).distinct(), ["user_id"], "left_semi")


SHOWN = ["event_type", "payload", "event_time", "user_id"]


def newest_per_viewer(rows: DataFrame, n: int = 20) -> DataFrame:
    """The newest `n` rows (viewer, and what a history shows) of each viewer. Of results of this it gives the same as of all rows."""
    newest = [F.desc(micros("event_time")), F.desc("event_time"), F.desc("event_type"), F.desc("payload"), F.desc("user_id")]
    ranked = rows.select("viewer", *SHOWN).withColumn("_rank", F.row_number().over(Window.partitionBy("viewer").orderBy(*newest)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def history_from_kept(kept: DataFrame, viewers: DataFrame, n: int = 20) -> DataFrame:
    """`history` from a kept table of `newest_per_viewer` of the `audience` rows: at most n rows of a viewer, and n for all."""
    wanted = viewers.select("viewer").distinct()
    own = scans.lookup(kept.filter(F.col("viewer") != EVERYONE), wanted, ["viewer"], "left_semi")
    shared = kept.filter(F.col("viewer") == EVERYONE).agg(F.collect_list(F.struct(*SHOWN)).alias("rows"))
    shown = newest_per_viewer(own.unionByName(wanted.select("viewer", F.inline(shared.scalar()))), n)
    window = Window.partitionBy("viewer")
    oldest = [micros("event_time"), F.col("event_time"), F.col("event_type"), F.col("payload"), F.col("user_id")]
    return shown.withColumn("position", F.row_number().over(window.orderBy(*oldest)))


def history(notifications: DataFrame, viewers: DataFrame, n: int = 20) -> DataFrame:
    """Per viewer the newest `n` readable rows, numbered in display order (1 = oldest shown).

    The newest n of all rows are among the newest n private ones and the newest n broadcasts. Private rows are
    ranked first, which leaves each task at most n rows of a viewer to send. Broadcasts are the same for
    everyone: their newest n are found once and handed to each viewer as one small array.
    """
    shown = ["event_type", "payload", "event_time", "user_id"]
    newest = [F.desc(micros("event_time")), F.desc("event_time"), F.desc("event_type"), F.desc("payload"), F.desc("user_id")]

    def top(df: DataFrame) -> DataFrame:
        ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy("viewer").orderBy(*newest)))
        return ranked.filter(F.col("_rank") <= n)

    wanted = viewers.select("viewer").distinct()
    private = top(_private(notifications).select("viewer", *shown)).drop("_rank").join(wanted, "viewer", "left_semi")
    broadcasts = notifications.filter(is_public()).select(*shown).orderBy(*newest).limit(n)
    shared = broadcasts.agg(F.collect_list(F.struct(*shown)).alias("rows"))
    given = wanted.select("viewer", F.inline(shared.scalar()))
    of_viewer = F.count("*").over(Window.partitionBy("viewer"))
    return (top(private.unionByName(given))
            .withColumn("position", (of_viewer - F.col("_rank") + 1).cast("int"))
            .drop("_rank"))


def latest_per(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The latest row of each key: an aggregation, combined before the shuffle. Wire times in `order` should be typed."""
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_row"))
              .select(*keys, *[F.col(f"_row.{c}") for c in rest]))


def match_outcomes(requests: DataFrame, notifications: DataFrame, timeout_s: int = 30,
                   grain_s: int | None = None) -> DataFrame:
    """For each request the first notification that answers it, or `timeout`.

    `requests`: request_id, file_path (may be null), types (accepted event types), request_time. A notification
    answers by its payload's request_id, or else by its file_path; an answer by request_id is preferred.
    Requests and notifications meet on (key, event type, time chunk) in one sorted pass from late to
    early, in which a request reads the nearest later notification: no pairs are formed. Chunks are always cut,
    since a notification only has to be copied into the chunk before its own when it is within the timeout of it.

    Every request has a row: one without a key, an accepted type or a readable time is answered by nothing.
    """
    grain_s = grain_s or max(600, 4 * timeout_s)
    ids = F.from_json("payload", "request_id string, file_path string")

    def by_key(df: DataFrame, request_id: Column, file_path: Column) -> DataFrame:
        entries = F.array(F.struct(F.lit(0).alias("by"), request_id.alias("key")),
                          F.struct(F.lit(1).alias("by"), file_path.alias("key")))
        return df.select("*", F.inline(entries)).filter("key is not null and key <> ''")

    asked = by_key(requests.select("*", F.explode("types").alias("event_type"), micros("request_time").alias("_us"),
                                   F.lit(0).alias("_side")), F.col("request_id"), F.col("file_path"))
    answers = by_key(notifications.select("event_type", "payload", "event_time", ids.alias("_ids"),
                                          micros("event_time").alias("_us"), F.lit(1).alias("_side")),
                     F.col("_ids.request_id"), F.col("_ids.file_path"))
    key = ["by", "key", "event_type"]
    asked = asked.select(*key, "_us", "_side", F.struct("request_id", "request_time").alias("_request"))
    answers = answers.select(*key, "_us", "_side", F.struct("_us", "event_time", "payload").alias("_answer"))
    near = (scans.halo(asked, "_us", grain_s=grain_s)
            .unionByName(scans.halo(answers, "_us", ahead_s=timeout_s, grain_s=grain_s), allowMissingColumns=True))
    late_first = scans.so_far(scans.local_window(key, [F.desc("_us"), F.desc("_side"), F.desc("_answer.payload")]))
    nearest = F.last("_answer", ignorenulls=True).over(late_first)
    seen = scans.own_rows(near.withColumn("_nearest", nearest)).filter(F.col("_side") == 0)
    hit = F.col("_nearest._us") - F.col("_us") <= timeout_s * scans.SECOND
    best = F.min(F.when(hit, F.struct("by", F.col("_nearest._us").alias("answered_us"), "event_type",
                                      "_nearest.event_time", F.col("_us").alias("asked_us"))))
    answered = seen.groupBy("_request").agg(best.alias("_best"))
    every = requests.select(F.struct("request_id", "request_time").alias("_request")).distinct()
    answered = every.join(answered.withColumnRenamed("_request", "_asked"), F.col("_request").eqNullSafe(F.col("_asked")), "left")
    return answered.select(
        "_request.request_id", "_request.request_time",
        F.coalesce("_best.event_type", F.lit("timeout")).alias("outcome"),
        F.col("_best.event_time").alias("outcome_time"),
        F.when(F.col("_best.by") == 0, F.lit("request_id"))
         .when(F.col("_best.by") == 1, F.lit("file_path")).alias("matched_by"),
        ((F.col("_best.answered_us") - F.col("_best.asked_us")) / scans.SECOND).alias("latency_s"),
    )


def match_outcomes_stream(requests: DataFrame, notifications: DataFrame, timeout_s: int = 30, delay: str = "10 minutes") -> DataFrame:
    """`match_outcomes` as a stream, in the same rows, for any arrival order within the watermark's delay.

    A request waits under each of its keys and accepted types in an outer join over the timeout's time range, then its best
    answer is taken once the watermark has passed its time and the timeout. State is bounded by the delay and the timeout. As in
    the batch form keys are cut by time chunk, and an answer is copied into the chunk before its own when it is within the
    timeout of it: a request is held against the answers of its key in one chunk, whatever a batch or the state holds of it. The same request sent twice, with one time, has one row. Rows later than the
    watermark are dropped. A request without a readable time has no place on the time line: it is a timeout as it arrives.
    """
    grain_s = max(600, 4 * timeout_s)
    ids = F.from_json("payload", "request_id string, file_path string")
    times = {"_us": micros("request_time"), "asked": F.timestamp_micros(micros("request_time"))}
    typed = requests.select("request_id", "request_time", "file_path", "types").withColumns(times)

    def entries(request_id: str, file_path: str) -> Column:
        keys = [F.struct(F.lit(by).alias("by"), F.when(F.col(c) != "", F.col(c)).alias("key")) for by, c in enumerate([request_id, file_path])]
        return F.inline(F.array(*keys))

    waiting = (typed.where("_us is not null").withWatermark("asked", delay)
               .select("request_id", "request_time", "_us", "asked", "file_path", F.explode_outer("types").alias("event_type"))
               .select("request_id", "request_time", "_us", "asked", "event_type", entries("request_id", "file_path")))
    answers = (notifications.select("event_type", "payload", "event_time", micros("event_time").alias("answer_us"), ids.alias("_ids"))
               .where("answer_us is not null").withColumn("answered", F.timestamp_micros("answer_us")).withWatermark("answered", delay)
               .select("event_type", "payload", "event_time", "answer_us", "answered", entries("_ids.request_id", "_ids.file_path"))
               .where("key is not null"))
    waiting = scans.chunked(waiting, "_us", grain_s)
    answers = scans.halo(answers, "answer_us", ahead_s=timeout_s, grain_s=grain_s).drop(scans.OWN)
    q, n = waiting.alias("q"), answers.alias("n")
    same = [F.col(f"q.{c}") == F.col(f"n.{c}") for c in ("by", "key", "event_type", scans.CHUNK)]
    in_time = F.col("n.answered").between(F.col("q.asked"), F.col("q.asked") + F.expr(f"interval {timeout_s} seconds"))
    met = q.join(n, reduce(and_, same) & in_time, "left").select(
        "q.request_id", "q.request_time", "q._us", "q.asked",
        F.when(F.col("n.answer_us").isNotNull(), F.struct("q.by", "n.answer_us", "n.event_type", "n.payload", "n.event_time")).alias("hit"))
    best = met.groupBy("request_id", "request_time", "_us", "asked").agg(F.min("hit").alias("best"))
    unplaced = (typed.where("_us is null")
                .select("request_id", "request_time", "_us", F.lit(None).cast(met.schema["hit"].dataType).alias("best")))
    every = best.select("request_id", "request_time", "_us", "best").unionByName(unplaced)
    return every.select(
        "request_id", "request_time", F.coalesce("best.event_type", F.lit("timeout")).alias("outcome"), F.col("best.event_time").alias("outcome_time"),
        F.when(F.col("best.by") == 0, F.lit("request_id")).when(F.col("best.by") == 1, F.lit("file_path")).alias("matched_by"),
        ((F.col("best.answer_us") - F.col("_us")) / scans.SECOND).alias("latency_s"))


def access_patterns(notifications: DataFrame) -> dict[str, DataFrame]:
    """The log as three tables, one per way of reading it: by owner, by recipient, and for everyone."""
    message = F.col("event_type") == MESSAGE
    return {
        "by_owner": notifications,
        "by_recipient": notifications.filter(message & F.col("recipient_id").isNotNull()),
        "broadcast": notifications.filter(message & (F.col("visibility") == "broadcast")),
    }
