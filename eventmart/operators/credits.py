"""Credit ledger: signed deltas, balances, and the order-exact credit check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions.scalars import iso_micros, micros
from eventmart.operators import scans
from eventmart.operators.scans import lookup

# Ledger event types, texts and amounts.
SIGNUP_BONUS = ("credit.signup_bonus", "Welcome bonus: 2 credits", 2)
UPLOAD_REFUND = ("credit.upload_refunded", "Refund: upload expired for ", 1)
UPLOAD_DEDUCTION = ("credit.upload_deducted", "Upload: ", -1)
GRAIN_S = 86_400  # chunk of the walk: one plan for every size
BEFORE_ALL_US = -62_135_596_800_000_000  # the year 1
INSUFFICIENT = "insufficient_credits"
INTERNAL_ERROR = "internal_error"


def _ledger(df: DataFrame, kind: tuple, description, time: str) -> DataFrame:
    return df.select(
        "user_id",
        F.lit(kind[2]).alias("amount"),
        F.lit(kind[0]).alias("event_type"),
        description.alias("description"),
        F.col(time).alias("event_time"),
    )


def signup_bonus(signups: DataFrame) -> DataFrame:
    return _ledger(signups, SIGNUP_BONUS, F.lit(SIGNUP_BONUS[1]), "signup_time")


def expiry_refund(expired: DataFrame) -> DataFrame:
    return _ledger(expired, UPLOAD_REFUND, F.concat(F.lit(UPLOAD_REFUND[1]), "file_name"), "expired_time")


def deductions(decisions: DataFrame) -> DataFrame:
    """The ledger rows the credit check itself appends: one per approved intent."""
    approved = decisions.filter(F.col("outcome") == "approved")
    return _ledger(approved, UPLOAD_DEDUCTION, F.concat(F.lit(UPLOAD_DEDUCTION[1]), "file_name"), "request_time")


def balances(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("user_id").agg(F.coalesce(F.sum("amount"), F.lit(0)).cast("bigint").alias("balance"))


def balance_lookup(users: DataFrame, ledger: DataFrame) -> DataFrame:
    """Every asked user's balance, 0 for one without ledger rows, and whether that blocks an upload."""
    balance = F.coalesce("balance", F.lit(0).cast("bigint"))
    return (users.join(balances(ledger), "user_id", "left")
                 .withColumns({"balance": balance, "blocked": balance <= 0}))


def affordable(intents: DataFrame, ledger: DataFrame) -> DataFrame:
    """Intents of users whose balance is at least 1 as the ledger stands, each judged by itself.

    The one-shot form of the check: unlike `credit_check`, earlier intents of the same run do not count.
    """
    enough = balances(ledger).filter(F.col("balance") >= 1).select("user_id")
    return lookup(intents, enough, ["user_id"], "left_semi")


def credit_check(intents: DataFrame, ledger: DataFrame, grain_s: int = GRAIN_S) -> DataFrame:
    """Approve an upload intent iff the user's balance is at least 1 when its turn comes; then take 1.

    Per user, in order of (time, ledger rows before intents, request id), every ledger row adds its amount and intents
    take 1. A debit never takes a balance below 0, and a refused intent leaves it at 0, so the balance is a running
    sum reflected at zero: balance = S - least(0, lowest S so far). Both S and its lowest point are scanned in two levels:
    within a time chunk of `grain_s`, then over the chunks' totals.

    The ledger may hold the deductions of earlier runs. One that belongs to an intent of this input (same user, time and
    file name) is left out, since that intent is judged again. An intent whose time cannot be read is refused with an
    internal error; a ledger row whose time cannot be read counts before all others, so no credit is lost.
    """
    keys, order = ["user_id"], ["_us", "_kind", "request_id"]
    detail = ["file_name", "media_type", "file_size", "request_time"]
    credits = _other_rows(ledger, intents).select(
        "user_id", F.coalesce(micros("event_time"), F.lit(BEFORE_ALL_US)).alias("_us"), F.lit(0).alias("_kind"),
        F.col("amount").cast("bigint").alias("_x"), F.lit("").alias("request_id"))
    taken = F.when(F.col("_us").isNull(), F.lit(0)).otherwise(F.lit(UPLOAD_DEDUCTION[2])).cast("bigint")
    asked = intents.withColumn("_us", micros("request_time")).select(
        "user_id", "_us", F.lit(1).alias("_kind"), taken.alias("_x"), "request_id", *detail)
    rows = asked.unionByName(credits, allowMissingColumns=True)
    walk = scans.chunked(rows, "_us", grain_s)

    # S and its lowest earlier point, counted from the start of the chunk.
    window = scans.local_window(keys, order)
    steps = (walk.withColumn("_s", F.sum("_x").over(scans.so_far(window)))
                 .withColumn("_low", F.min("_s").over(scans.before(window))))

    # What earlier chunks add: the sum on entry, and the lowest point reached before entry.
    asked_steps, entry, floor = steps.filter(F.col("_kind") == 1), F.lit(0), F.lit(None).cast("bigint")
    if grain_s:
        asked_steps, entry, floor = _with_entry(asked_steps, steps, keys), F.col("_entry"), F.col("_floor")
    lowest = F.least(F.lit(0), floor, entry + F.col("_low"))
    readable = F.col("_us").isNotNull()
    approved = readable & (entry + F.col("_s") - F.col("_x") - lowest >= 1)
    reason = F.when(readable, F.lit(INSUFFICIENT)).otherwise(F.lit(INTERNAL_ERROR))

    def text(yes, no):
        return F.when(F.col("_ok"), yes).otherwise(no)

    return asked_steps.withColumns({"_ok": F.coalesce(approved, F.lit(False)), "_reason": reason}).select(
        text(F.lit("approved"), F.lit("rejected")).alias("outcome"),
        "user_id", "file_name", "media_type", "file_size", "request_id",
        text(F.col("request_time"), F.lit("")).alias("request_time"),
        text(F.lit(""), F.col("_reason")).alias("reason"),
        text(F.lit(""), F.coalesce(iso_micros("_us"), F.col("request_time"))).alias("rejected_time"),
        text(F.lit(UPLOAD_DEDUCTION[2]), F.lit(0)).alias("ledger_delta"),
    )


def _other_rows(ledger: DataFrame, intents: DataFrame) -> DataFrame:
    """Ledger rows that are not the deduction of one of the intents."""
    if "description" not in ledger.columns:
        return ledger
    own = intents.select("user_id", F.col("request_time").alias("event_time"),
                         F.concat(F.lit(UPLOAD_DEDUCTION[1]), "file_name").alias("description"),
                         F.lit(UPLOAD_DEDUCTION[0]).alias("event_type")).distinct()
    return ledger.join(own, ["user_id", "event_time", "description", "event_type"], "left_anti")


def _with_entry(rows: DataFrame, steps: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the state their chunk starts from, out of one reduced row per (key, chunk)."""
    scan = scans.chunk_scan(keys)
    totals = steps.groupBy(*keys, scans.CHUNK).agg(F.sum("_x").alias("_t"), F.min("_s").alias("_m"))
    entry = (totals.withColumn("_entry", F.coalesce(F.sum("_t").over(scan), F.lit(0)))
                   .withColumn("_floor", F.min(F.col("_entry") + F.col("_m")).over(scan))
                   .select(*keys, scans.CHUNK, "_entry", "_floor"))
    return rows.join(entry, [*keys, scans.CHUNK], "left")
