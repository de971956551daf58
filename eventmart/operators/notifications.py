"""Events to notification rows (user_id, event_type, payload, event_time)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions.scalars import json_object, non_empty, null_string


@dataclass(frozen=True)
class Projection:
    topic: str
    event_type: str
    payload: tuple  # column names, or (key, constant) pairs
    time: str


# Event type, payload keys in order and constants of every notification.
PROJECTIONS = {
    "login": Projection("public.identity.login.events", "identity.login",
                        ("email", "device_id", "user_agent", "ip_address"), "login_time"),
    "signup": Projection("public.identity.signup.events", "identity.signup",
                         ("email",), "signup_time"),
    "signout": Projection("public.identity.signout.events", "identity.signout",
                          ("email", "device_id", "user_agent", "ip_address"), "signout_time"),
    "credit_bonus": Projection("public.identity.signup.events", "credit.balance_changed",
                               (("amount", 2), ("reason", "signup_bonus")), "signup_time"),
    "credit_refund": Projection("public.media.expired.events", "credit.balance_changed",
                                (("amount", 1), ("reason", "upload_expired"), "file_name"), "expired_time"),
    "upload_ready": Projection("public.media.upload.signed", "media.upload_ready",
                               ("upload_url", "file_path", "expires_in", "request_id"), "signed_time"),
    "upload_rejected": Projection("public.media.upload.rejected", "media.upload_rejected",
                                  ("reason", "request_id", "file_name"), "rejected_time"),
    "upload_completed": Projection("public.media.upload.confirmed", "media.upload_completed",
                                   ("file_path", "file_name", "file_size", "media_type"), "upload_time"),
    "upload_expired": Projection("public.media.expired.events", "media.upload_expired",
                                 ("file_path", "file_name", ("amount_refunded", 1), "request_id"),
                                 "expired_time"),
    "download_ready": Projection("public.media.download.signed", "media.download_ready",
                                 ("download_url", "file_path", "expires_in", "request_id"), "signed_time"),
    "download_rejected": Projection("public.media.download.rejected", "media.download_rejected",
                                    ("file_path", "reason", "request_id"), "rejected_time"),
    "file_deleted": Projection("public.media.delete.events", "media.file_deleted",
                               ("file_path", "file_name"), "delete_time"),
    "delete_rejected": Projection("public.media.delete.rejected", "media.delete_rejected",
                                  ("file_path", "reason", "request_id"), "rejected_time"),
    "upload_failed": Projection("internal.media.upload.dead-letter", "media.upload_failed",
                                ("file_name", "failure_reason", "retry_count"), "dead_letter_time"),
}


def notification(name: str, events: DataFrame) -> DataFrame:
    """The notification rows of one projection."""
    p = PROJECTIONS[name]
    fields = dict((f, F.col(f)) if isinstance(f, str) else (f[0], F.lit(f[1])) for f in p.payload)
    return events.select(
        "user_id",
        F.lit(p.event_type).alias("event_type"),
        json_object(**fields).alias("payload"),
        F.col(p.time).alias("event_time"),
    )


def message_notification(messages: DataFrame) -> DataFrame:
    """User messages; an empty visibility means everyone, an empty recipient means nobody in particular."""
    return messages.select(
        "user_id",
        F.lit("user.message").alias("event_type"),
        json_object(email=F.col("email"), message=F.col("message")).alias("payload"),
        F.col("timestamp").alias("event_time"),
        F.coalesce(non_empty("visibility"), F.lit("broadcast")).alias("visibility"),
        non_empty("recipient_id").alias("recipient_id"),
    )


def notification_log(*parts: DataFrame) -> DataFrame:
    """All notifications in the shape of the log table: projections without their own visibility get the default."""
    out = None
    for part in parts:
        if "visibility" not in part.columns:
            part = part.withColumns({"visibility": F.lit("broadcast"), "recipient_id": null_string()})
        out = part if out is None else out.unionByName(part)
    return out
