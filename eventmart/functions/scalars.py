"""Scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Units, media categories and the media types accepted for upload.
SIZE_UNITS = ["B", "KB", "MB", "GB", "TB"]
MEDIA_CATEGORIES = ["image", "video", "audio"]
ALLOWED_MEDIA_TYPES = [
    "image/jpeg", "image/png", "image/gif", "image/webp",
    "video/mp4", "video/webm",
    "audio/mpeg", "audio/wav", "audio/ogg",
]


def col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def null_string() -> Column:
    return F.lit(None).cast("string")


def non_empty(value: str | Column) -> Column:
    """The value, or null when it is the empty string."""
    return F.nullif(col(value), F.lit(""))


def json_object(**fields: Column) -> Column:
    """JSON text with the keys in the given order; nulls are kept, numbers stay numbers."""
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]),
                     {"ignoreNullFields": "false"})


def typed_time(value: str | Column) -> Column:
    """Wire time (ISO-8601 text) as a timestamp; null when it cannot be read."""
    return F.try_to_timestamp(col(value))


def millis(value: Column) -> Column:
    return F.date_trunc("MILLISECOND", value)


def micros(value: str | Column) -> Column:
    """Wire time as microseconds since the epoch: what windows and interval rules compute on."""
    return F.unix_micros(typed_time(value))


def iso_time(value: str | Column) -> Column:
    return F.date_format(col(value), ISO_MICROS)


def iso_seconds(value: str | Column) -> Column:
    return F.date_format(col(value), ISO_SECONDS)


def iso_micros(value: str | Column) -> Column:
    """Microseconds since the epoch back to wire time."""
    return iso_time(F.timestamp_micros(col(value)))


def url_decoded(value: str | Column) -> Column:
    """Percent-decoding; text that is not valid encoding is kept as it is."""
    return F.coalesce(F.try_url_decode(col(value)), col(value))


def file_size_text(size: str | Column) -> Column:
    """Bytes for people: one decimal at most, B up to TB."""
    size = col(size).cast("long")
    text = None
    for power in range(len(SIZE_UNITS) - 1, -1, -1):
        scaled = F.round(size / F.lit(float(1024 ** power)), 1).cast("decimal(20,1)").cast("string")
        shown = F.concat(F.regexp_replace(scaled, r"\.0$", ""), F.lit(" " + SIZE_UNITS[power]))
        threshold = size >= F.lit(1024 ** power)
        text = F.when(threshold, shown) if text is None else text.when(threshold, shown)
    return F.when(size <= 0, F.lit("0 B")).otherwise(text)


def media_category(media_type: str | Column) -> Column:
    kind = F.split_part(col(media_type), F.lit("/"), F.lit(1))
    return F.when(kind.isin(MEDIA_CATEGORIES), kind).otherwise(F.lit("unknown"))


def is_allowed_media_type(media_type: str | Column) -> Column:
    return F.coalesce(col(media_type).isin(ALLOWED_MEDIA_TYPES), F.lit(False))


def retry_count_int(value: str | Column) -> Column:
    """A count that may arrive as number or text; anything else counts as 0."""
    return F.coalesce(col(value).try_cast("double").try_cast("int"), F.lit(0))


def host_of(address: str | Column) -> Column:
    """The host of an address that may carry a netmask."""
    return F.split_part(col(address), F.lit("/"), F.lit(1))


# The sentence shown for each event type. {x} is a payload field ("" when absent),
# {x!} shows "unknown" when absent, {event_time} the row's time, {sender} the e-mail up to "@".
NOTIFICATION_TEXT = {
    "identity.login": "🚀 Flink mapped Login: {event_time}",
    "identity.signup": "🎉 Flink mapped Signup: {event_time}",
    "identity.signout": "👋 Flink mapped Signout: {event_time}",
    "user.message": "💬 {sender}: {message}",
    "media.upload_ready": "📤 Upload ready: {file_path}",
    "media.upload_rejected": "❌ Upload rejected: {reason}",
    "media.upload_completed": "✅ Upload complete: {file_name}",
    "media.upload_expired": "⏰ Upload expired: {file_path}",
    "media.upload_failed": "❌ Upload failed: {failure_reason!}",
    "media.download_ready": "📥 Download ready: {file_path}",
    "media.download_rejected": "❌ Download rejected: {reason}",
    "media.file_deleted": "🗑️ File deleted: {file_name}",
    "media.delete_rejected": "❌ Delete rejected: {reason}",
}
NOTIFICATION_TEXT_DEFAULT = "📌 {event_type}: {event_time}"


def notification_text(event_type: str | Column, payload: str | Column, event_time: str | Column) -> Column:
    """The history line of a notification. The payload is parsed once, with the fields the texts use."""
    event_type = col(event_type)
    body = F.from_json(F.coalesce(non_empty(payload), F.lit("{}")),
                       "email string, message string, file_path string, file_name string, "
                       "reason string, failure_reason string")

    def part(name: str) -> Column:
        if name == "event_type":
            return event_type
        if name == "event_time":
            return col(event_time)
        if name == "sender":
            return F.coalesce(F.split_part(body["email"], F.lit("@"), F.lit(1)), F.lit(""))
        if name.endswith("!"):
            return F.coalesce(non_empty(body[name[:-1]]), F.lit("unknown"))
        return F.coalesce(body[name], F.lit(""))

    def render(template: str) -> Column:
        pieces = []
        for i, piece in enumerate(template.replace("}", "{").split("{")):
            if piece:
                pieces.append(part(piece) if i % 2 else F.lit(piece))
        return F.concat(*pieces)

    text = None
    for name, template in NOTIFICATION_TEXT.items():
        text = (F if text is None else text).when(event_type == name, render(template))
    return text.otherwise(render(NOTIFICATION_TEXT_DEFAULT))
