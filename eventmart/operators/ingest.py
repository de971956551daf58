"""Ingress: frames, JSON contracts, routing, validation, object notifications and row changes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.scalars import (col, host_of, is_allowed_media_type, json_object, micros, non_empty,
                                         null_string, url_decoded)
from eventmart.operators.scans import lookup
from eventmart.schemas import FIELD_DEFAULTS, OBJECT_NOTIFICATION, TOPICS

# Limits, routes and reasons.
MAX_BODY_BYTES = 1048576
FRAME_HEADER_BYTES = 5
WEBHOOK_ROUTES = {
    "login": "public.identity.login.events",
    "signup": "public.identity.signup.events",
    "signout": "public.identity.signout.events",
}
EXTERNAL_ROUTES = {"message": "public.user.message.events"}
DEFAULT_MEDIA_TYPE = "application/octet-stream"
INTENT_FIELDS = {
    "upload": ["file_name", "media_type", "file_size"],
    "download": ["file_path"],
    "delete": ["file_path"],
}


class Judged:
    """Rows with the reason to refuse them. Unpacks into (accepted, rejected); `all` is both in one pass.

    In `all` a row has only the columns of its side, and `reason` is null for an accepted one.
    """

    def __init__(self, df: DataFrame, reason: Column, keep: list, reject: list):
        judged = df.withColumn("reason", reason)
        ok = F.col("reason").isNull()
        kept, refused = judged.select(*keep).columns, judged.select(*reject).columns
        self.accepted = judged.filter(ok).select(*keep)
        self.rejected = judged.filter(~ok).select(*reject, "reason")
        of_kept = {name: c if isinstance(c, Column) else F.col(c) for name, c in zip(kept, keep)}
        self.all = judged.select(
            *[c.alias(n) if n in refused else F.when(ok, c).alias(n) for n, c in of_kept.items()],
            *[F.when(~ok, F.col(n)).alias(n) for n in refused if n not in kept], "reason")

    def __iter__(self):
        return iter((self.accepted, self.rejected))


def split_frames(records: DataFrame) -> Judged:
    """Wire frames (topic, value BINARY) into (topic, schema_id, body) and refused ones (topic, reason)."""
    value = F.col("value")
    reason = (F.when(value.isNull() | (F.octet_length(value) < FRAME_HEADER_BYTES), F.lit("too_short"))
               .when(F.hex(F.substring(value, 1, 1)) != "00", F.lit("bad_magic_byte")))
    schema_id = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint").alias("schema_id")
    body = F.substring(value, F.lit(FRAME_HEADER_BYTES + 1), F.octet_length(value)).alias("body")
    return Judged(records, reason, ["topic", schema_id, body], ["topic"])


# Kinds of JSON value each declared type takes.
_KINDS = {"string": "STRING", "bigint": "BIGINT", "int": "BIGINT"}


def parse_json(records: DataFrame, topic: str, max_bytes: int = MAX_BODY_BYTES) -> Judged:
    """JSON bodies (column `value`) of one topic, typed by its contract, and refused ones (value, reason).

    Every field is first read as a variant, which keeps the kind it was written with: a number where text is
    declared is a violation, and integers stay exact. Keys the contract does not know are ignored.
    """
    schema, size = TOPICS[topic], F.octet_length("value")
    raw = T.StructType([T.StructField(f.name, T.VariantType()) for f in schema]).add("_broken", T.StringType())
    # Only objects are bodies; the parser by itself would also take an array of one object.
    is_object = F.col("value").rlike(r"^\s*\{")
    body = F.from_json(F.when((size <= max_bytes) & is_object, F.col("value")), raw,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    # Inlining one element is the way to have the optimizer parse once instead of once per use.
    others = [c for c in records.columns if c != "value" and c not in schema.names]
    parsed = records.select(*others, "value", F.inline(F.array(body)))

    def default(f: T.StructField):
        return FIELD_DEFAULTS.get((topic, f.name))

    def fits(f: T.StructField) -> Column:
        kind = F.schema_of_variant(f.name)
        optional = f.nullable or default(f) is not None
        return F.coalesce(kind == _KINDS[f.dataType.simpleString()], F.lit(optional)) | (
            F.lit(f.nullable) & (kind == "VOID"))

    def value_of(f: T.StructField) -> Column:
        value = F.try_variant_get(f.name, "$", f.dataType.simpleString())
        return (value if default(f) is None else F.coalesce(value, F.lit(default(f)))).alias(f.name)

    conforms = fits(schema[0])
    for f in schema[1:]:
        conforms = conforms & fits(f)
    reason = (F.when(F.col("value").isNull(), F.lit("invalid_json"))
               .when(size > max_bytes, F.lit("payload_too_large"))
               .when(~is_object | F.col("_broken").isNotNull(), F.lit("invalid_json"))
               .when(~conforms, F.lit("schema_violation")))
    return Judged(parsed, reason, [*others, *[value_of(f) for f in schema]], [*others, "value"])


def route(records: DataFrame, routes: Mapping[str, str] = WEBHOOK_ROUTES) -> Judged:
    """Records (route_key, ...) to topics by an allow-list; keys are matched in lower case, others refused."""
    table = F.create_map(*[F.lit(x) for pair in routes.items() for x in pair])
    routed = records.withColumn("topic", F.try_element_at(table, F.lower(F.col("route_key"))))
    reason = F.when(F.col("topic").isNull(), F.lit("forbidden"))
    return Judged(routed, reason, [*records.columns, "topic"], records.columns)


def dispatch(records: DataFrame, handled: list[str]) -> Judged:
    """Records (topic, ...) with a handler, and those of unknown topics."""
    known = F.coalesce(F.col("topic").isin(handled), F.lit(False))
    return Judged(records, F.when(~known, F.lit("unknown_topic")), records.columns, records.columns)


def require(df: DataFrame, *columns: str) -> Judged:
    """Rows with text in all the given columns, and the others with the first column that lacks it."""
    reason = F.coalesce(*[F.when(non_empty(c).isNull(), F.lit(f"missing {c}")) for c in columns])
    return Judged(df, reason, df.columns, df.columns)


def validate_intents(requests: DataFrame, kind: str, now: str | Column, request_id: str | Column | None = None,
                     check_media_type: bool = False) -> Judged:
    """Requests (user_id, fields of the kind) into intents of the kind's topic, and refused ones.

    `user_id` is the authenticated one and always wins; request id and time are set here, not by the caller. Without
    `request_id` the id is made from the request and its time, so that a recomputed task gives the same one.
    The media-type allow-list is the rule of the direct upload path.
    """
    fields, topic = INTENT_FIELDS[kind], f"internal.media.{kind}.intent"
    if request_id is None:
        request_id = F.sha2(json_object(kind=F.lit(kind), user_id=F.col("user_id"), at=col(now),
                                        **{f: F.col(f) for f in fields}), 256)
    reason = F.coalesce(*[
        F.when(~F.coalesce(F.col(f) > 0, F.lit(False)) if f == "file_size" else non_empty(f).isNull(),
               F.lit(f"invalid {f}"))
        for f in fields])
    if check_media_type and kind == "upload":
        reason = F.coalesce(reason, F.when(~is_allowed_media_type("media_type"), F.lit("media_type not allowed")))
    stamped = requests.withColumns({"topic": F.lit(topic), "request_id": col(request_id), "request_time": col(now)})
    return Judged(stamped, reason, ["topic", *TOPICS[topic].names], ["request_id"])


def _object_records(notifications: DataFrame) -> DataFrame:
    """Every record of every notification (column `body`, JSON), its key decoded."""
    record = F.explode(F.from_json("body", OBJECT_NOTIFICATION)["Records"]).alias("r")
    decoded = notifications.select(record).select("r", F.explode(F.array(url_decoded("r.s3.object.key"))).alias("key"))
    return decoded.select(
        "key", F.col("r.eventTime").alias("event_time"),
        F.col("r.s3.object.size").alias("size"), F.col("r.s3.object.contentType").alias("content_type"),
        F.col("r.s3.object.userMetadata").alias("meta"))


def received_from_objects(notifications: DataFrame, now: str) -> DataFrame:
    """Objects that arrived under `uploads/<user>/<id>/.../<name>`, as received events."""
    parts = F.split("key", "/")
    email = F.coalesce(F.try_element_at("meta", F.lit("email")), F.try_element_at("meta", F.lit("X-Amz-Meta-Email")),
                       F.lit(""))
    staged = _object_records(notifications).filter((F.size(parts) >= 4) & (parts[0] == "uploads"))
    return staged.select(
        parts[1].alias("user_id"),
        email.alias("email"),
        F.col("key").alias("file_path"),
        F.element_at(parts, -1).alias("file_name"),
        F.coalesce("size", F.lit(0)).alias("file_size"),
        F.coalesce(non_empty("content_type"), F.lit(DEFAULT_MEDIA_TYPE)).alias("media_type"),
        F.coalesce(non_empty("event_time"), F.lit(now)).alias("upload_time"),
        F.regexp_replace("key", "^uploads/", "files/").alias("permanent_path"),
        F.lit(0).alias("retry_count"),
    )


def ready_from_objects(notifications: DataFrame, now: str) -> DataFrame:
    """Objects that reached permanent storage, as ready events."""
    return _object_records(notifications).filter(F.col("key").startswith("files/")).select(
        F.col("key").alias("file_path"),
        F.coalesce("size", F.lit(0)).alias("file_size"),
        F.coalesce(non_empty("event_time"), F.lit(now)).alias("upload_time"),
    )


def logins_from_changes(changes: DataFrame) -> DataFrame:
    """User-row updates (op, old, new as structs) that changed the last sign-in, as login events."""
    def meta(name: str) -> Column:
        return F.get_json_object("new.raw_user_meta_data", f"$.{name}").alias(name)

    moved = ~F.col("old.last_sign_in_at").eqNullSafe(F.col("new.last_sign_in_at"))
    return changes.filter((F.col("op") == "update") & moved).select(
        F.col("new.id").alias("user_id"), "new.email", F.col("new.last_sign_in_at").alias("login_time"),
        meta("device_id"), meta("user_agent"), meta("ip_address"))


def signups_from_changes(changes: DataFrame) -> DataFrame:
    """User-row inserts, as signup events."""
    return changes.filter(F.col("op") == "insert").select(
        F.col("new.id").alias("user_id"), "new.email", F.col("new.created_at").alias("signup_time"))


def signouts_from_changes(changes: DataFrame, users: DataFrame, now: str | Column) -> DataFrame:
    """Session-row deletes, as signout events; the e-mail comes from the user table (id, email)."""
    gone = changes.filter(F.col("op") == "delete").select(
        F.col("old.user_id").alias("user_id"), col(now).alias("signout_time"),
        F.col("old.user_agent").alias("user_agent"), host_of("old.ip").alias("ip_address"))
    emails = users.select(F.col("id").alias("user_id"), "email")
    return lookup(gone, emails, ["user_id"]).select(
        "user_id", "email", "signout_time", null_string().alias("device_id"), "user_agent", "ip_address")


def unreadable(rows: DataFrame, time: str | None, *keys: str) -> DataFrame:
    """Rows whose wire time cannot be read, or that lack one of the keys, with the reason.

    Rules that work in time order leave exactly these out. Without a `time`, only the keys count.
    """
    bad_time = F.lit(False) if time is None else micros(time).isNull()
    no_key = F.exists(F.array(*[F.col(k).isNull() for k in keys]), lambda x: x) if keys else F.lit(False)
    return (rows.filter(bad_time | no_key)
            .withColumn("reason", F.when(bad_time, F.lit("bad_time")).otherwise(F.lit("no_key"))))
