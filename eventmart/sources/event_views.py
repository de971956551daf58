"""The test tables `events` and `conversations` seen as the platform's topics.

Every event type plays topics that are joined with each other, so all operators meet real arrival patterns:
repeated keys, early and late partners, and keys without partner. Nothing is sampled or left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.scalars import ISO_MICROS, iso_micros
from eventmart.operators.metrics import FUNNEL_STAGES
from eventmart.session import use_utc

BASE_US = 1704067200000000  # 2024-01-01, the first day of the table
TTL_SPEED, MOVE_SPEED = 300, 3000  # how much faster than in the table the saga streams run
MEDIA_TYPES = ["image/jpeg", "image/png", "image/gif", "image/webp", "video/mp4", "video/webm", "audio/mpeg",
               "audio/wav", "audio/ogg", "application/pdf", "text/plain", "image/bmp"]
NOW = "2024-02-01T00:00:00Z"
SCHEMAS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "conversations": "conv_id long, turn long, role string, text string",
}


class EventViews:
    """Topic-shaped views over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = use_utc(spark), folder
        self._events = None

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def events(self, kind: str | None = None) -> DataFrame:
        if self._events is None:
            self._events = self._typed(self.read("events"))
        return self._events if kind is None else self._events.filter(F.col("event_type") == kind)

    @staticmethod
    def _typed(rows: DataFrame) -> DataFrame:
        uid = F.concat(F.lit("u"), "user_id")
        k = F.get_json_object("props", "$.k").cast("int")
        return rows.select(
            "event_id", "ts", uid.alias("user_id"), "event_type", "value", k.alias("k"),
            F.concat(F.lit("user"), "user_id", F.lit("@example.com")).alias("email"),
            F.date_format("ts", ISO_MICROS).alias("time"),
            F.concat(F.lit("req-"), "event_id").alias("request_id"),
            F.concat(F.lit("f"), k, F.lit(".png")).alias("file_name"),
            F.element_at(F.array(*[F.lit(m) for m in MEDIA_TYPES]), k % len(MEDIA_TYPES) + 1).alias("media_type"),
            F.round(F.col("value") * 1000).cast("bigint").alias("file_size"),
            F.concat_ws("/", F.lit("files"), uid, F.floor(k / 10), F.lit("f.png")).alias("path"),
            F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
        )

    # identity

    def logins(self) -> DataFrame:
        return self.events("view").select(
            "user_id", "email", F.col("time").alias("login_time"),
            F.when(F.col("value") < 50, F.concat(F.lit("device-"), "k")).alias("device_id"),
            F.concat(F.lit("agent/"), "k").alias("user_agent"), F.concat(F.lit("10.0.0."), "k").alias("ip_address"),
            F.col("ts").alias("login_ts"))

    def signups(self) -> DataFrame:
        return self.events("signup").select("user_id", "email", F.col("time").alias("signup_time"))

    def signouts(self) -> DataFrame:
        return self.events("error").select(
            "user_id", F.when(F.col("value") < 100, F.col("email")).alias("email"),
            F.col("time").alias("signout_time"), F.lit(None).cast("string").alias("device_id"),
            F.concat(F.lit("agent/"), "k").alias("user_agent"), F.concat(F.lit("10.0.0."), "k").alias("ip_address"))

    def messages(self) -> DataFrame:
        role = F.col("role")
        at = F.lit(BASE_US) + F.col("conv_id") * 60_000_000 + F.col("turn") * 1_000_000
        return self.read("conversations").select(
            F.concat(F.lit("u"), "conv_id").alias("user_id"),
            F.concat(F.lit("user"), "conv_id", F.lit("@example.com")).alias("email"),
            F.col("text").alias("message"), iso_micros(at).alias("timestamp"),
            F.when(role == "assistant", F.lit("direct")).when(role == "user", F.lit("")).otherwise(
                F.lit("broadcast")).alias("visibility"),
            F.when(role == "assistant", F.concat(F.lit("u"), F.col("conv_id") + 1))
             .when(role == "user", F.lit("")).alias("recipient_id"))

    # uploads

    def upload_intents(self) -> DataFrame:
        return self.events("click").select("user_id", "file_name", "media_type", "file_size", "request_id",
                                           F.col("time").alias("request_time"))

    def upload_approved(self) -> DataFrame:
        return self.upload_intents()

    def upload_rejected(self) -> DataFrame:
        return self.events("click").select(
            "user_id", "file_name", "media_type", "file_size", "request_id",
            F.lit("insufficient_credits").alias("reason"), F.col("time").alias("rejected_time"))

    def _saga(self, kind: str, speed: int, root: str) -> DataFrame:
        us = F.lit(BASE_US) + F.floor((F.col("us") - BASE_US) / speed)
        path = F.concat_ws("/", F.lit(root), "user_id", F.floor(F.col("k") / 50), F.lit("f.png"))
        return self.events(kind).withColumns({"saga_time": iso_micros(us), "path": path})

    def signed(self) -> DataFrame:
        return self._saga("click", TTL_SPEED, "uploads").select(
            "user_id", F.col("path").alias("file_path"), "file_name",
            F.concat(F.lit("https://store/"), "path").alias("upload_url"), F.lit(900).alias("expires_in"),
            "request_id", F.col("saga_time").alias("signed_time"))

    def received(self, speed: int = TTL_SPEED) -> DataFrame:
        return self._saga("purchase", speed, "uploads").select(
            "user_id", "email", F.col("path").alias("file_path"), "file_name", "file_size", "media_type",
            F.col("saga_time").alias("upload_time"),
            F.regexp_replace("path", "^uploads/", "files/").alias("permanent_path"),
            F.floor(F.col("k") / 20).cast("int").alias("retry_count"))

    def ready(self) -> DataFrame:
        return self._saga("view", MOVE_SPEED, "files").select(
            F.col("path").alias("file_path"), "file_size", F.col("saga_time").alias("upload_time"))

    def expired(self) -> DataFrame:
        return self.events("click").select(
            "user_id", F.col("path").alias("file_path"), "file_name", F.lit(0).cast("bigint").alias("file_size"),
            F.lit("").alias("media_type"), "request_id", F.col("time").alias("request_time"),
            F.col("time").alias("expired_time"))

    def dead_letters(self) -> DataFrame:
        return self.events("error").select(
            "user_id", "email", F.regexp_replace("path", "^files/", "uploads/").alias("file_path"), "file_name",
            "file_size", "media_type", F.col("time").alias("upload_time"), F.col("path").alias("permanent_path"),
            F.lit(3).alias("retry_count"), F.lit("max retries exceeded").alias("failure_reason"),
            F.col("time").alias("dead_letter_time"))

    def upload_retries(self) -> DataFrame:
        """Retries with the result of their move: small values moved, larger ones failed."""
        return self.events("click").select(
            "user_id", "email", F.regexp_replace("path", "^files/", "uploads/").alias("file_path"), "file_name",
            "file_size", "media_type", F.col("time").alias("upload_time"), F.col("path").alias("permanent_path"),
            F.floor(F.col("k") / 20).cast("int").alias("retry_count"), F.col("time").alias("retry_time"),
            (F.col("value") < 50).alias("moved_ok"))

    # files

    def confirmed(self) -> DataFrame:
        return self.events("purchase").select(
            "user_id", "email", F.col("path").alias("file_path"), "file_name", "file_size", "media_type",
            F.col("time").alias("upload_time"))

    def deletes(self) -> DataFrame:
        return self.events("error").select(
            "user_id", F.col("path").alias("file_path"), "file_name", "media_type", "file_size",
            F.col("time").alias("delete_time"))

    def file_intents(self) -> DataFrame:
        """Download intents: a click asks for the path it names, whether or not there is such a file."""
        return self.events("click").select(
            "user_id", F.col("path").alias("file_path"), "request_id", F.col("time").alias("request_time"),
            F.when(F.col("value") < 100, F.concat(F.lit("https://store/"), "path")).alias("download_url"))

    def delete_intents(self) -> DataFrame:
        return self.events("view").select(
            "user_id", F.col("path").alias("file_path"), "request_id", F.col("time").alias("request_time"),
            (F.col("value") < 120).alias("deleted_ok"), (F.col("value") < 40).alias("removed_ok"))

    def download_signed(self) -> DataFrame:
        return self.events("view").select(
            "user_id", F.col("path").alias("file_path"), F.concat(F.lit("https://store/"), "path").alias("download_url"),
            F.lit(3600).alias("expires_in"), "request_id", F.col("time").alias("signed_time"))

    def rejected_access(self) -> DataFrame:
        return self.events("view").select(
            "user_id", F.col("path").alias("file_path"), "request_id", F.lit("not_found").alias("reason"),
            F.col("time").alias("rejected_time"))

    def delete_retries(self) -> DataFrame:
        return self.events("error").select(
            "user_id", F.col("path").alias("file_path"), "file_name", "media_type", "file_size", "request_id",
            F.concat(F.floor(F.col("k") / 20)).alias("retry_count"), F.col("time").alias("failed_at"),
            (F.col("value") < 30).alias("removed_ok"))

    # raw ingress

    def frames(self) -> DataFrame:
        """A framed body per event: whole, cut before the header ends, or with a wrong first byte."""
        body = F.encode(F.concat(F.lit("b"), "event_id"), "UTF-8")
        head = F.to_binary(F.concat(F.when(F.col("event_type") == "error", F.lit("01")).otherwise(F.lit("00")),
                                    F.lpad(F.hex("k"), 8, "0")), F.lit("hex"))
        whole = F.concat(head, body)
        return self.events().select(
            F.col("event_type").alias("topic"),
            F.when(F.col("event_type") == "purchase", F.substring(whole, 1, 4)).otherwise(whole).alias("value"))

    def json_bodies(self) -> DataFrame:
        """Upload-intent bodies, well-formed for most events, and with one kind of fault per other event type."""
        time, kind = F.col("time"), F.col("event_type")
        fields = [F.lit('{"user_id":"'), F.col("user_id"), F.lit('","file_name":"'), F.col("file_name"),
                  F.lit('","media_type":"'), F.col("media_type"), F.lit('","request_id":"'), F.col("request_id")]
        size = F.col("file_size").cast("string")
        whole = F.concat(*fields, F.lit('","request_time":"'), time, F.lit('","file_size":'), size, F.lit("}"))
        value = (F.when(kind == "error", F.concat(F.lit('{"user_id":"'), F.col("user_id")))
                  .when(kind == "view", F.concat(*fields, F.lit('","request_time":"'), time, F.lit('","file_size":"'),
                                                 size, F.lit('"}')))
                  .when(kind == "purchase", F.concat(*fields, F.lit('","file_size":'), size, F.lit("}")))
                  .otherwise(whole))
        return self.events().select(F.col("event_id").cast("string").alias("record_id"), value.alias("value"))

    def keyed_requests(self) -> DataFrame:
        """Requests under a route key; upper case must not matter, unknown keys are refused."""
        names = F.create_map(*[F.lit(x) for x in ("view", "Login", "signup", "signup", "error", "SIGNOUT",
                                                  "click", "click", "purchase", "../admin")])
        return self.events().select(names[F.col("event_type")].alias("route_key"),
                                    F.col("request_id").alias("value"))

    def intent_requests(self) -> DataFrame:
        """Upload requests; small values lack a name, a type or a size."""
        value = F.col("value")
        return self.events("click").select(
            "user_id", "request_id",
            F.when(value >= 5, F.col("file_name")).otherwise(F.lit("")).alias("file_name"),
            F.when(value >= 10, F.col("media_type")).alias("media_type"),
            F.when(value >= 15, F.col("file_size")).otherwise(F.lit(0)).alias("file_size"),
            F.col("time").alias("request_time"))

    def object_notifications(self) -> DataFrame:
        """Object-store notifications: arrivals under uploads/ and files/, and objects elsewhere; keys percent-encoded."""
        kind = F.col("event_type")
        root = F.when(kind == "purchase", F.lit("uploads")).when(kind == "view", F.lit("files")).otherwise(F.lit("other"))
        key = F.url_encode(F.concat_ws("/", root, "user_id", "event_id", F.concat(F.lit("a b+"), "file_name")))
        meta = F.when(F.col("value") < 100, F.concat(F.lit('{"email":"'), "email", F.lit('"}'))).otherwise(
            F.concat(F.lit('{"X-Amz-Meta-Email":"'), "email", F.lit('"}')))
        content = F.when(F.col("value") < 20, F.lit("")).otherwise(F.col("media_type"))
        body = F.concat(F.lit('{"Records":[{"eventTime":"'), "time",
                        F.lit('","s3":{"bucket":{"name":"media"},"object":{"key":"'), key, F.lit('","size":'),
                        F.col("file_size").cast("string"), F.lit(',"contentType":"'), content,
                        F.lit('","userMetadata":'), meta, F.lit("}}}]}"))
        return self.events().select(body.alias("body"))

    def user_changes(self) -> DataFrame:
        """Changes of the user table: signups insert, views update (large values without a new sign-in)."""
        meta = F.concat(F.lit('{"device_id":"device-'), "k", F.lit('","user_agent":"agent/'), "k", F.lit('"}'))
        inserted = F.col("event_type") == "signup"
        row = [F.col("user_id").alias("id"), F.col("email").alias("email"), meta.alias("raw_user_meta_data"),
               F.col("time").alias("created_at")]
        old = F.struct(*row, F.when(F.col("value") >= 100, F.col("time")).alias("last_sign_in_at"))
        new = F.struct(*row, F.when(~inserted, F.col("time")).alias("last_sign_in_at"))
        return self.events().filter(F.col("event_type").isin("signup", "view")).select(
            F.when(inserted, F.lit("insert")).otherwise(F.lit("update")).alias("op"),
            F.when(~inserted, old).alias("old"), new.alias("new"))

    def session_changes(self) -> DataFrame:
        return self.events("error").select(
            F.lit("delete").alias("op"),
            F.struct(F.col("user_id").alias("user_id"), F.concat(F.lit("agent/"), "k").alias("user_agent"),
                     F.concat(F.lit("10.0.0."), "k", F.lit("/32")).alias("ip"), F.col("time").alias("at")).alias("old"))

    def users(self) -> DataFrame:
        """Users who signed up, once each."""
        return self.signups().groupBy(F.col("user_id").alias("id")).agg(F.min("email").alias("email"))

    # metrics

    def _per_minute(self, *labels) -> DataFrame:
        return (self.events().groupBy(*labels, F.date_trunc("minute", F.col("ts").cast("timestamp")).alias("minute"))
                .agg(F.count("*").alias("n"), F.sum("value").alias("v")))

    @staticmethod
    def _counter(counts: DataFrame, keys: list[str], value: str):
        """A counter that restarts each day; a day of one series has at most 1440 minutes."""
        from pyspark.sql import Window
        day = F.to_date("minute")
        w = Window.partitionBy(*keys, day).orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)
        return counts.withColumn("total", F.sum(value).over(w).cast("double"))

    @staticmethod
    def _sample(metric: str, labels: dict, value):
        pairs = [x for name, v in labels.items() for x in (F.lit(name), v)]
        return [F.lit(metric).alias("metric"), F.create_map(*pairs).alias("labels"), F.col("minute").alias("ts"),
                value.alias("value")]

    def request_counts(self) -> DataFrame:
        """Request counters by service (event type) and status; large values are failures."""
        status = F.when(F.col("value") >= 100, F.lit("503")).otherwise(F.lit("200")).alias("status")
        counts = self._counter(self._per_minute("event_type", status), ["event_type", "status"], "n")
        return counts.select(*self._sample(
            "http_server_request_duration_seconds_count",
            {"otel_scope_name": F.col("event_type"), "http_response_status_code": F.col("status")}, F.col("total")))

    def request_buckets(self) -> DataFrame:
        """Cumulative duration buckets; a value of 100 counts as 10 seconds."""
        edges = {"1": 10.0, "2.5": 25.0, "5": 50.0, "10": 100.0, "25": 250.0}
        minute = F.date_trunc("minute", F.col("ts").cast("timestamp")).alias("minute")
        counts = self.events().groupBy("event_type", minute).agg(
            *[F.count_if(F.col("value") <= v).alias(le) for le, v in edges.items()], F.count("*").alias("+Inf"))
        tall = counts.unpivot(["event_type", "minute"], [f"`{c}`" for c in [*edges, "+Inf"]], "le", "n")
        return self._counter(tall, ["event_type", "le"], "n").select(*self._sample(
            "http_server_request_duration_seconds_bucket",
            {"otel_scope_name": F.col("event_type"), "le": F.col("le")}, F.col("total")))

    def topic_counts(self) -> DataFrame:
        """Message counters by topic: errors play dead letters."""
        topic = F.when(F.col("event_type") == "error", F.lit("internal.media.upload.dead-letter")).otherwise(
            F.concat(F.lit("public.media."), "event_type")).alias("topic")
        counts = self._counter(self._per_minute(topic), ["topic"], "n")
        return counts.select(*self._sample("kafka_consumer_messages_total", {"topic": F.col("topic")}, F.col("total")))

    def disk_gauges(self) -> DataFrame:
        """Free and total bytes per event type and minute: the mean value is the share in use."""
        counts = self._per_minute("event_type")
        free = F.greatest(F.lit(0.0), F.lit(100.0) - F.floor(F.col("v") / F.col("n")))
        labels = {"disk": F.col("event_type")}
        return counts.select(*self._sample("redpanda_storage_disk_free_bytes", labels, free)).unionByName(
            counts.select(*self._sample("redpanda_storage_disk_total_bytes", labels, F.lit(100.0))))

    def event_gauge(self) -> DataFrame:
        """Every event as one sample of a gauge."""
        return self.events().select(
            F.lit("event_value").alias("metric"), F.create_map(F.lit("kind"), F.col("event_type")).alias("labels"),
            F.col("ts").cast("timestamp").alias("ts"), "value")

    def staged_events(self) -> DataFrame:
        """Each event as a message of one of the funnel's topics."""
        topics = F.array(*[F.lit(t) for t in [*FUNNEL_STAGES, "public.identity.login.events"]])
        return self.events().select(F.element_at(topics, F.floor(F.col("k") / 13).cast("int") + 1).alias("topic"),
                                    F.col("ts").cast("timestamp").alias("ts"))

    def offsets(self) -> tuple[DataFrame, DataFrame]:
        """Log ends from every event and commits from clicks: partition by decade of k, offsets grow with the id."""
        e = self.events()
        place = [F.lit("events").alias("topic"), F.floor(F.col("k") / 10).cast("int").alias("partition")]
        ends = e.select(*place, F.col("event_id").alias("offset"), "ts")
        commits = e.filter(F.col("event_type") == "click").select(
            F.lit("indexer").alias("group"), *place, F.col("event_id").alias("offset"), "ts")
        return ends, commits
