"""Media domain: files, ownership lookups, outcomes of download and delete intents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.scalars import col, micros, non_empty, null_string
from eventmart.operators import scans
from eventmart.operators.scans import lookup

# Statuses, reasons and how long signed links live.
ACTIVE, DELETED = "active", "deleted"
NOT_FOUND, INTERNAL_ERROR = "not_found", "internal_error"
UPLOAD_EXPIRES_IN, DOWNLOAD_EXPIRES_IN = 900, 3600

OWNER = ["user_id", "file_path"]
METADATA = ["file_name", "media_type", "file_size"]


def new_files(confirmed: DataFrame) -> DataFrame:
    return confirmed.select("user_id", "file_name", "file_path", "file_size", "media_type",
                            F.lit(ACTIVE).alias("status"), "upload_time")


def soft_delete(files: DataFrame, deletes: DataFrame, only_active: bool = True) -> DataFrame:
    """Files with `status` set to deleted by a later delete of the same owner and path, and whether that changed them.

    Deletes are first reduced to the newest per path, so the join adds no rows however often a path is deleted.
    With `only_active=False` a file already deleted counts as changed again.
    """
    newest = deletes.groupBy(*OWNER).agg(F.max(micros("delete_time")).alias("_deleted"))
    hit = F.coalesce(F.col("_deleted") >= micros("upload_time"), F.lit(False))
    if only_active:
        hit = hit & (F.col("status") == ACTIVE)
    return (lookup(files, newest, OWNER)
                 .withColumn("changed", hit)
                 .withColumn("status", F.when(F.col("changed"), F.lit(DELETED)).otherwise(F.col("status")))
                 .drop("_deleted"))


def current_files(confirmed: DataFrame, deletes: DataFrame) -> DataFrame:
    """The file table as the two event streams leave it."""
    return soft_delete(new_files(confirmed), deletes).drop("changed")


def active_files(files: DataFrame, viewer: str | None = None) -> DataFrame:
    """Active files, of one owner if a viewer is given. Sort by upload_time descending to show them."""
    mine = files.filter(F.col("status") == ACTIVE)
    return mine if viewer is None else mine.filter(F.col("user_id") == viewer)


def file_list(files: DataFrame, viewer: str | None = None) -> DataFrame:
    """Newest first: a range sort, so it stays spread over tasks."""
    return active_files(files, viewer).orderBy(F.desc(micros("upload_time")), F.desc("upload_time"), "file_path")


def owned(intents: DataFrame, files: DataFrame) -> DataFrame:
    """Intents on a file that exists, is active and belongs to who asks."""
    return intents.join(active_files(files).select(*OWNER), OWNER, "left_semi")


def _with_metadata(intents: DataFrame, files: DataFrame) -> DataFrame:
    """Intents with the newest active file of the path, if any. One file row per path, so intents never multiply."""
    newest = (active_files(files).groupBy(*OWNER)
              .agg(F.max_by(F.struct(*METADATA), micros("upload_time")).alias("_file")))
    return lookup(intents, newest, OWNER)


def download_outcomes(intents: DataFrame, files: DataFrame, now: str | Column = "request_time",
                      expires_in: int = DOWNLOAD_EXPIRES_IN) -> DataFrame:
    """Each download intent signed or refused. The link itself is an input column (null: signing failed)."""
    url = F.col("download_url") if "download_url" in intents.columns else null_string()
    found = F.col("_file").isNotNull()
    signed = found & F.col("_url").isNotNull()
    return _with_metadata(intents.withColumn("_url", url), files).select(
        F.when(signed, F.lit("signed")).otherwise(F.lit("rejected")).alias("outcome"),
        *OWNER, "request_id",
        F.when(signed, F.col("_url")).alias("download_url"),
        F.when(signed, F.lit(expires_in)).alias("expires_in"),
        F.when(~found, F.lit(NOT_FOUND)).when(~signed, F.lit(INTERNAL_ERROR)).alias("reason"),
        col(now).alias("outcome_time"),
    )


def downloaded(intents: DataFrame, files: DataFrame, now: str | Column = "request_time") -> DataFrame:
    """Download events of the intents that found their file."""
    return (_with_metadata(intents, files).filter(F.col("_file").isNotNull())
            .select(*OWNER, "_file.file_name", "_file.media_type", col(now).alias("download_time")))


def delete_outcomes(intents: DataFrame, files: DataFrame, now: str | Column = "request_time") -> DataFrame:
    """Outcomes of delete intents, whose results come as columns `deleted_ok` and `removed_ok`.

    No active file: refused, not_found. Row not marked: refused, internal_error. Otherwise the file is
    deleted, and a failed removal of the object adds a retry row with count 0. A null result counts as failed.
    """
    found, marked = F.col("_file").isNotNull(), F.coalesce("deleted_ok", F.lit(False))
    outcomes = (F.when(~found | ~marked, F.array(F.lit("rejected")))
                 .when(~F.coalesce("removed_ok", F.lit(False)), F.array(F.lit("deleted"), F.lit("retry")))
                 .otherwise(F.array(F.lit("deleted"))))
    out = F.col("outcome")
    rejected = out == "rejected"
    return _with_metadata(intents, files).withColumn("outcome", F.explode(outcomes)).select(
        "outcome", *OWNER, "request_id",
        *[F.when(~rejected, F.col(f"_file.{m}")).alias(m) for m in METADATA],
        F.when(rejected, F.when(found, F.lit(INTERNAL_ERROR)).otherwise(F.lit(NOT_FOUND))).alias("reason"),
        F.when(out == "retry", F.lit(0)).alias("retry_count"),
        col(now).alias("outcome_time"),
    )


OUTCOME = ["outcome", *OWNER, "request_id", *METADATA, "download_url", "reason", "retry_count", "outcome_time"]
DAY_S = 86_400


def intent_kind() -> Column:
    """The place of an intent among rows of the same time: after confirmations (0), deletes (1) before downloads (2)."""
    return F.when(F.col("action") == "delete", 1).when(F.col("action") == "download", 2)


def outcomes_in_order(confirmed: DataFrame, intents: DataFrame, grain_s: int = DAY_S) -> DataFrame:
    """Outcomes of download and delete intents, each against the file as the rows before it in time left it.

    intents: action (download or delete), user_id, file_path, request_id, request_time, and the results of their effects:
    download_url (null: signing failed), deleted_ok, removed_ok (null: failed). A confirmation makes a file active, and a
    delete that could mark it takes it away until the next one. Outcomes: signed, download_rejected, deleted, delete_rejected,
    retry (beside deleted, where the object could not be removed). A request that comes again is answered once, at its first
    time. Rows without an owner, a path or a readable time, and other actions, have no outcome.
    """
    timed = intents.select("*", micros("request_time").alias("us"), intent_kind().alias("kind"))
    timed = timed.where("us is not null and kind is not null and user_id is not null and file_path is not null")
    effects = F.struct("us", "request_time", "download_url", "deleted_ok", "removed_ok")
    named = timed.where("request_id is not null").groupBy(*OWNER, "kind", "request_id").agg(F.min(effects).alias("_ask"))
    asked = named.unionByName(timed.where("request_id is null").select(*OWNER, "kind", "request_id", effects.alias("_ask")))
    id_ = F.coalesce("request_id", F.lit(""))
    # a delete is two rows: it asks, and then it marks
    marks = F.when((F.col("kind") == 1) & F.coalesce("_ask.deleted_ok", F.lit(False)), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    asked = asked.select(*OWNER, F.col("_ask.us").alias("us"), "kind", id_.alias("id"), F.explode(marks).alias("part"), "request_id", "_ask")
    files = confirmed.select(*OWNER, micros("upload_time").alias("us"), F.lit(0).alias("kind"), F.lit("").alias("id"), F.lit(0).alias("part"),
                             F.struct(*METADATA).alias("_file")).where("us is not null and user_id is not null and file_path is not null")
    rows = scans.chunked(files.unionByName(asked, allowMissingColumns=True), "us", grain_s)
    changes = (F.col("kind") == 0) | (F.col("part") == 1)
    step = F.when(changes, F.struct("us", "kind", "id", "part", (F.col("kind") == 0).alias("active"), "_file"))
    known = scans.running_max(rows, OWNER, ["us", "kind", "id", "part", "_file"], {"_last": step}, grain_s)
    found, marked = F.coalesce("_last.active", F.lit(False)), F.coalesce("_ask.deleted_ok", F.lit(False))
    signed = found & F.col("_ask.download_url").isNotNull()
    outcomes = (F.when(F.col("kind") == 2, F.when(signed, F.array(F.lit("signed"))).otherwise(F.array(F.lit("download_rejected"))))
                 .when(~found | ~marked, F.array(F.lit("delete_rejected")))
                 .when(~F.coalesce("_ask.removed_ok", F.lit(False)), F.array(F.lit("deleted"), F.lit("retry")))
                 .otherwise(F.array(F.lit("deleted"))))
    out = known.where("kind > 0 and part = 0").withColumn("outcome", F.explode(outcomes))
    refused = F.col("outcome").isin("download_rejected", "delete_rejected")
    return out.select(
        "outcome", *OWNER, "request_id",
        *[F.when(~refused, F.col(f"_last._file.{m}")).alias(m) for m in METADATA],
        F.when(F.col("outcome") == "signed", F.col("_ask.download_url")).alias("download_url"),
        F.when(refused, F.when(found, F.lit(INTERNAL_ERROR)).otherwise(F.lit(NOT_FOUND))).alias("reason"),
        F.when(F.col("outcome") == "retry", F.lit(0)).alias("retry_count"),
        F.col("_ask.request_time").alias("outcome_time"))


def outcome_branches(wide: DataFrame, expires_in: int = DOWNLOAD_EXPIRES_IN) -> dict[str, DataFrame]:
    """The rows of `outcomes_in_order` by topic, each with the columns of its topic."""
    of = lambda name, *columns: wide.filter(F.col("outcome") == name).select(*OWNER, *columns)
    time = F.col("outcome_time")
    refused = ["request_id", "reason", time.alias("rejected_time")]
    return {
        "public.media.download.signed": of("signed", "download_url", F.lit(expires_in).alias("expires_in"), "request_id", time.alias("signed_time")),
        "public.media.download.events": of("signed", "file_name", "media_type", time.alias("download_time")),
        "public.media.download.rejected": of("download_rejected", *refused),
        "public.media.delete.events": of("deleted", *METADATA, time.alias("delete_time")),
        "public.media.delete.rejected": of("delete_rejected", *refused),
        "internal.media.delete.retry": of("retry", *METADATA, "request_id", "retry_count", time.alias("failed_at")),
    }


def signed_from_approved(approved: DataFrame, now: str | Column = "request_time",
                         file_id: str | Column = "request_id", expires_in: int = UPLOAD_EXPIRES_IN) -> DataFrame:
    """Approved uploads with their staging path and link. The link is an input column, null if there is none."""
    url = non_empty("upload_url") if "upload_url" in approved.columns else null_string()
    return approved.select(
        "user_id",
        F.concat_ws("/", F.lit("uploads"), "user_id", col(file_id), "file_name").alias("file_path"),
        "file_name",
        url.alias("upload_url"),
        F.lit(expires_in).alias("expires_in"),
        "request_id",
        col(now).alias("signed_time"),
    )
