"""One declared schema per topic and table. Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Topic names, field names, field order and nullability of the wire contract.
# "S" string, "L" long, "I" int; a trailing "?" marks a nullable field.
TOPIC_FIELDS = {
    "public.identity.login.events":
        "user_id:S email:S login_time:S device_id:S? user_agent:S? ip_address:S?",
    "public.identity.signup.events": "user_id:S email:S signup_time:S",
    "public.identity.signout.events":
        "user_id:S email:S? signout_time:S device_id:S? user_agent:S? ip_address:S?",
    "public.user.message.events":
        "user_id:S email:S message:S timestamp:S visibility:S recipient_id:S?",
    "public.media.upload.events":
        "user_id:S email:S file_path:S file_name:S file_size:L media_type:S upload_time:S",
    "public.media.upload.approved":
        "user_id:S file_name:S media_type:S file_size:L request_id:S request_time:S",
    "public.media.upload.rejected":
        "user_id:S file_name:S media_type:S file_size:L request_id:S reason:S rejected_time:S",
    "public.media.upload.signed":
        "user_id:S file_path:S file_name:S upload_url:S expires_in:I request_id:S signed_time:S",
    "public.media.upload.confirmed":
        "user_id:S email:S file_path:S file_name:S file_size:L media_type:S upload_time:S",
    "public.media.expired.events":
        "user_id:S file_path:S file_name:S file_size:L media_type:S request_id:S request_time:S expired_time:S",
    "public.media.download.events": "user_id:S file_path:S file_name:S media_type:S download_time:S",
    "public.media.download.signed":
        "user_id:S file_path:S download_url:S expires_in:I request_id:S signed_time:S",
    "public.media.download.rejected": "user_id:S file_path:S request_id:S reason:S rejected_time:S",
    "public.media.delete.events":
        "user_id:S file_path:S file_name:S media_type:S file_size:L delete_time:S",
    "public.media.delete.rejected": "user_id:S file_path:S request_id:S reason:S rejected_time:S",
    "internal.media.upload.intent":
        "user_id:S file_name:S media_type:S file_size:L request_id:S request_time:S",
    "internal.media.download.intent": "user_id:S file_path:S request_id:S request_time:S",
    "internal.media.delete.intent": "user_id:S file_path:S request_id:S request_time:S",
    "internal.media.upload.received":
        "user_id:S email:S file_path:S file_name:S file_size:L media_type:S upload_time:S "
        "permanent_path:S retry_count:I",
    "internal.media.file.ready": "file_path:S file_size:L upload_time:S",
    "internal.media.upload.retry":
        "user_id:S email:S file_path:S file_name:S file_size:L media_type:S upload_time:S "
        "permanent_path:S retry_count:I retry_time:S",
    "internal.media.upload.dead-letter":
        "user_id:S email:S file_path:S file_name:S file_size:L media_type:S upload_time:S "
        "permanent_path:S retry_count:I failure_reason:S dead_letter_time:S",
    "internal.media.delete.retry":
        "user_id:S file_path:S file_name:S media_type:S file_size:L request_id:S retry_count:I failed_at:S",
    "internal.media.delete.dead-letter":
        "user_id:S file_path:S file_name:S media_type:S file_size:L request_id:S retry_count:I "
        "failure_reason:S dead_letter_time:S",
    "internal.platform.unified.events":
        "event_id:S event_time:S event_type:S user_id:S email:S device_id:S? user_agent:S? ip_address:S?",
    "internal.identity.login.echo":
        "user_id:S email:S login_time:S device_id:S? user_agent:S? ip_address:S?",
}

TABLE_FIELDS = {
    "user_notifications":
        "user_id:S event_type:S payload:S event_time:S visibility:S recipient_id:S?",
    "credit_ledger": "user_id:S amount:I event_type:S description:S event_time:S",
    "media_files":
        "user_id:S file_name:S file_path:S file_size:L media_type:S status:S upload_time:S",
}

# Defaults the wire contract gives to absent fields.
FIELD_DEFAULTS = {
    ("public.user.message.events", "visibility"): "broadcast",
    ("internal.media.upload.received", "retry_count"): 0,
}

_TYPES = {"S": T.StringType(), "L": T.LongType(), "I": T.IntegerType()}


def _struct(fields: str) -> T.StructType:
    out = T.StructType()
    for item in fields.split():
        name, kind = item.split(":")
        out.add(name, _TYPES[kind[0]], kind.endswith("?"))
    return out


TOPICS: dict[str, T.StructType] = {name: _struct(spec) for name, spec in TOPIC_FIELDS.items()}
TABLES: dict[str, T.StructType] = {name: _struct(spec) for name, spec in TABLE_FIELDS.items()}

# Object-store notification body, as both object webhooks receive it.
OBJECT_NOTIFICATION = T.StructType().add("Records", T.ArrayType(
    T.StructType()
    .add("eventTime", T.StringType())
    .add("s3", T.StructType()
         .add("bucket", T.StructType().add("name", T.StringType()))
         .add("object", T.StructType()
              .add("key", T.StringType())
              .add("size", T.LongType())
              .add("contentType", T.StringType())
              .add("userMetadata", T.MapType(T.StringType(), T.StringType()))))))


def topic_schema(topic: str, nullable: bool = True) -> T.StructType:
    """Schema of a topic; as a source every column is nullable, as an encode contract it is strict."""
    schema = TOPICS[topic]
    if not nullable:
        return schema
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def conform(df, topic: str):
    """Columns of the topic, in its order and types."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in TOPICS[topic]])
