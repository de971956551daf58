"""Operators on small hand-made rows."""

import json

import oracle
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions import scalars as S
from eventmart.operators import credits, governance, identity, ingest, media, metrics, notifications, olap, sagas, serving
from eventmart.plans import cli
from eventmart.plans.queries import QUERIES
from eventmart.schemas import OBJECT_NOTIFICATION, TOPICS


def topic(spark, name, *rows):
    return spark.createDataFrame(list(rows), TOPICS[name])


def tuples(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def one(spark, column):
    return spark.range(1).select(column.alias("c")).collect()[0][0]


# identity

LOGINS = [("user-1", "2024-01-15T10:30:00Z", "alice@example.com"), ("user-1", "2024-01-15T14:00:00Z", "alice@example.com"),
          ("user-2", "2024-01-15T09:00:00Z", "bob@example.com"), ("user-3", "2024-01-14T23:59:00Z", "charlie@example.com")]
SIGNUPS = [("user-1", "2024-01-10T08:00:00Z", "alice@example.com"), ("user-3", "2024-01-12T12:00:00Z", "charlie@example.com")]
LOGIN_SCHEMA, SIGNUP_SCHEMA = "user_id string, login_time string, email string", "user_id string, signup_time string, email string"


@pytest.fixture
def identities(spark):
    return spark.createDataFrame(LOGINS, LOGIN_SCHEMA), spark.createDataFrame(SIGNUPS, SIGNUP_SCHEMA)


def test_daily_login_aggregates(spark, identities):
    out = identity.daily_login_aggregates(*identities, "2024-01-15")
    assert out.columns == ["user_id", "login_count", "signup_date", "email", "dt"]
    assert dict(out.dtypes)["login_count"] == "int"
    assert tuples(out) == [("user-1", 2, "2024-01-10", "alice@example.com", "2024-01-15"),
                           ("user-2", 1, None, "bob@example.com", "2024-01-15")]
    assert identity.daily_login_aggregates(*identities, "2024-01-01").count() == 0
    assert identity.daily_login_aggregates(identities[0].limit(0), identities[1], "2024-01-15").count() == 0


def test_repeated_signups_fan_out_only_when_asked(spark, identities):
    signups = identities[1].unionByName(identities[1])
    assert identity.daily_login_aggregates(identities[0], signups, "2024-01-15").count() == 2
    assert identity.daily_login_aggregates(identities[0], signups, "2024-01-15", dedupe_signups=False).count() == 3


def test_cli_rewrites_one_day(spark, identities, tmp_path):
    places = [f"{tmp_path}/{n}" for n in ("logins", "signups", "out")]
    for df, place in zip(identities, places):
        df.write.parquet(place)
    cli.backfill_logins(spark, *places)
    cli.daily_logins(spark, *places, "2024-01-15")
    assert spark.read.parquet(places[2]).count() == 3


def test_cli_reads_its_arguments(spark, identities, tmp_path):
    places = [f"{tmp_path}/{n}" for n in ("logins", "signups", "out")]
    for df, place in zip(identities, places):
        df.write.parquet(place)
    tables = [x for pair in zip(("--login-table", "--signup-table", "--output-table"), places) for x in pair]
    cli.main(["daily-logins", *tables, "--dt", "2024-01-15"])
    assert spark.read.parquet(places[2]).count() == 2
    source = f"{tmp_path}/topics"
    identities[0].withColumns({c: F.lit(None).cast("string") for c in ("device_id", "user_agent", "ip_address")}).select(
        TOPICS["public.identity.login.events"].names).write.parquet(f"{source}/public.identity.login.events")
    cli.main(["echo", "--source", source, "--target", f"{tmp_path}/t", "--checkpoints", f"{tmp_path}/c"])
    assert spark.read.parquet(f"{tmp_path}/t/internal.identity.login.echo").count() == 4


# notifications

def test_payload_keeps_nulls_and_order(spark):
    logins = topic(spark, "public.identity.login.events", ("u", "e", "t", None, "agent", None))
    row = notifications.notification("login", logins).collect()[0]
    assert row.payload == '{"email":"e","device_id":null,"user_agent":"agent","ip_address":null}'
    assert (row.event_type, row.event_time) == ("identity.login", "t")


def test_credit_payloads(spark):
    signups = topic(spark, "public.identity.signup.events", ("u", "e", "t"))
    assert notifications.notification("credit_bonus", signups).collect()[0].payload == '{"amount":2,"reason":"signup_bonus"}'


def test_message_defaults(spark):
    messages = topic(spark, "public.user.message.events", ("u", "e", "hi", "t", "", ""), ("u", "e", "hi", "t", "direct", "v"))
    assert tuples(notifications.message_notification(messages), "visibility", "recipient_id") == [
        ("broadcast", None), ("direct", "v")]


# credits

def at(n):
    return f"2024-01-01T00:00:{n:02d}Z"


def intents(spark, *times):
    return topic(spark, "internal.media.upload.intent",
                 *[("u", f"f{n}", "image/png", 1, f"r{n}", at(n)) for n in times])


@pytest.mark.parametrize(("signup", "asked", "expired", "expected"), [
    (True, [1], [], ["approved"]),
    (True, [1, 2, 3], [], ["approved", "approved", "rejected"]),
    (False, [1], [], ["rejected"]),
    (True, [1, 2, 5], [4], ["approved", "approved", "approved"]),
])
def test_credit_cases(spark, signup, asked, expired, expected):
    signups = topic(spark, "public.identity.signup.events", *([("u", "e", at(0))] if signup else []))
    gone = topic(spark, "public.media.expired.events",
                 *[("u", "p", "f", 0, "", "r", at(n), at(n)) for n in expired])
    ledger = credits.signup_bonus(signups).unionByName(credits.expiry_refund(gone))
    out = credits.credit_check(intents(spark, *asked), ledger)
    assert [r.outcome for r in out.orderBy("request_id").collect()] == expected
    balance = credits.balances(ledger.unionByName(credits.deductions(out))).collect()
    left = 2 * signup + len(expired) - expected.count("approved")
    assert [r.balance for r in balance] == ([left] if ledger.count() else [])


def test_balance_lookup_defaults_to_zero(spark):
    ledger = credits.signup_bonus(topic(spark, "public.identity.signup.events", ("u", "e", "t")))
    users = spark.createDataFrame([("u",), ("v",)], "user_id string")
    assert tuples(credits.balance_lookup(users, ledger)) == [("u", 2, False), ("v", 0, True)]


# media

FILES = [("u", "e", "files/u/1/a.png", "a.png", 10, "image/png", "2024-01-01T00:00:00Z"),
         ("v", "e", "files/v/2/b.png", "b.png", 20, "image/png", "2024-01-02T00:00:00Z")]


@pytest.fixture
def files(spark):
    deletes = topic(spark, "public.media.delete.events",
                    ("v", "files/v/2/b.png", "b.png", "image/png", 20, "2024-01-03T00:00:00Z"),
                    ("u", "files/u/1/a.png", "a.png", "image/png", 20, "2023-12-31T00:00:00Z"))
    return media.current_files(topic(spark, "public.media.upload.confirmed", *FILES), deletes)


def test_deleted_file_stays_and_is_hidden(files):
    assert tuples(files, "user_id", "status") == [("u", "active"), ("v", "deleted")]
    assert [r.user_id for r in media.file_list(files).collect()] == ["u"]
    assert media.active_files(files, "v").count() == 0


def test_download_and_delete_outcomes(spark, files):
    asked = spark.createDataFrame(
        [("u", "files/u/1/a.png", "r1", "t", "url", True, False), ("v", "files/v/2/b.png", "r2", "t", "url", True, True),
         ("v", "files/u/1/a.png", "r3", "t", "url", True, True), ("u", "files/u/1/a.png", "r4", "t", None, False, True)],
        "user_id string, file_path string, request_id string, request_time string, download_url string, "
        "deleted_ok boolean, removed_ok boolean")
    assert tuples(media.download_outcomes(asked, files), "request_id", "outcome", "reason") == [
        ("r1", "signed", None), ("r2", "rejected", "not_found"), ("r3", "rejected", "not_found"),
        ("r4", "rejected", "internal_error")]
    assert tuples(media.delete_outcomes(asked, files), "request_id", "outcome", "reason", "retry_count") == [
        ("r1", "deleted", None, None), ("r1", "retry", None, 0), ("r2", "rejected", "not_found", None),
        ("r3", "rejected", "not_found", None), ("r4", "rejected", "internal_error", None)]
    assert tuples(media.owned(asked, files), "request_id") == [("r1",), ("r4",)]


def test_a_path_stored_twice_does_not_double_its_intents(spark, files):
    asked = spark.createDataFrame([("u", "files/u/1/a.png", "r1", "t")],
                                  "user_id string, file_path string, request_id string, request_time string")
    assert media.download_outcomes(asked, files.unionByName(files)).count() == 1


# sagas

RECEIVED = ("user-abc", "user@example.com", "uploads/user-abc/uuid-1/photo.jpg", "photo.jpg", 204800, "image/jpeg",
            "2026-02-26T10:00:00+00:00", "files/user-abc/uuid-1/photo.jpg")


def received(spark, count=0, time=RECEIVED[6]):
    return topic(spark, "internal.media.upload.received", (*RECEIVED[:6], time, RECEIVED[7], count))


def ready(spark, *times):
    return topic(spark, "internal.media.file.ready", *[(RECEIVED[7], 204800, t) for t in times])


@pytest.mark.parametrize("time", ["2026-02-26T10:00:05+00:00", "2026-02-26T09:59:05+00:00", "2026-02-26T10:02:00+00:00"])
def test_move_confirmed_in_both_orders(spark, time):
    out = sagas.move_branches(sagas.move_saga(received(spark), ready(spark, time)))
    assert tuples(out["confirmed"], "file_path", "file_size") == [(RECEIVED[7], 204800)]
    assert out["retry"].count() == out["dead_letter"].count() == 0


@pytest.mark.parametrize(("count", "kind"), [(0, "retry"), (2, "retry"), (3, "dead_letter"), (4, "dead_letter")])
@pytest.mark.parametrize("times", [[], ["2026-02-26T10:02:00.000001+00:00"]])
def test_move_without_ready(spark, count, kind, times):
    out = sagas.move_branches(sagas.move_saga(received(spark, count), ready(spark, *times)))
    row = out[kind].collect()[0]
    assert (row.retry_count, row.permanent_path, row.email) == (count, RECEIVED[7], RECEIVED[1])
    if kind == "dead_letter":
        assert row.failure_reason == "max retries exceeded"
    assert sum(df.count() for df in out.values()) == 1


@pytest.mark.parametrize(("receipts", "expired"), [([], 1), (["2026-02-25T10:05:00+00:00"], 0),
                                                  (["2026-02-25T09:50:00+00:00"], 0),
                                                  (["2026-02-25T10:15:01+00:00"], 1)])
def test_upload_ttl(spark, receipts, expired):
    signed = topic(spark, "public.media.upload.signed", ("user-abc", RECEIVED[2], "photo.jpg", "https://x", 900, "req-xyz",
                                                        "2026-02-25T10:00:00+00:00"))
    got = topic(spark, "internal.media.upload.received", *[(*RECEIVED[:6], t, RECEIVED[7], 0) for t in receipts])
    out = sagas.expired_uploads(signed, got).collect()
    assert len(out) == expired
    for r in out:
        assert (r.file_size, r.media_type, r.request_time) == (0, "", "2026-02-25T10:00:00+00:00")
        assert r.expired_time == "2026-02-25T10:15:00.000000Z"


def test_upload_signed_again_moves_the_deadline(spark):
    times = ["2026-02-25T10:00:00Z", "2026-02-25T10:10:00Z"]
    signed = topic(spark, "public.media.upload.signed",
                   *[("u", "p", "f", "url", 900, f"r{i}", t) for i, t in enumerate(times)])
    out = sagas.expired_uploads(signed, topic(spark, "internal.media.upload.received"))
    assert tuples(out, "request_id", "expired_time") == [("r1", "2026-02-25T10:25:00.000000Z")]


@pytest.mark.parametrize(("count", "outcome", "after"), [("0", "retry", 1), ("2", "retry", 3), ("3", "dead_letter", 3)])
def test_delete_retries(spark, count, outcome, after):
    rows = spark.createDataFrame([("u", "p", "f", "t", 1, "r", count, "now", False), ("u", "p", "f", "t", 1, "ok", count, "now", True)],
                                 "user_id string, file_path string, file_name string, media_type string, file_size long, "
                                 "request_id string, retry_count string, failed_at string, removed_ok boolean")
    assert tuples(sagas.route_delete_retries(rows), "request_id", "outcome", "retry_count") == [("r", outcome, after)]


def test_failed_moves_end_in_a_dead_letter(spark):
    retries = topic(spark, "internal.media.upload.retry", *[(*RECEIVED, n, "t") for n in (0, 3)])
    steps = sagas.retry_step(retries.withColumn("moved_ok", F.lit(False)))
    assert tuples(steps, "outcome", "retry_count") == [("dead_letter", 3), ("retry", 1)]
    again = sagas.reenter_retries(retries.withColumn("moved_ok", F.lit(True)))
    assert tuples(again, "retry_count") == [(1,), (4,)]


# serving

def log(spark):
    return spark.createDataFrame(
        [("A", "identity.signup", "{}", "1", "broadcast", None), ("A", "user.message", '{"m":1}', "2", "direct", "A"),
         ("A", "user.message", '{"m":2}', "3", "broadcast", None), ("A", "user.message", '{"m":3}', "4", "direct", "B"),
         ("A", "identity.login", "{}", "5", "broadcast", "B")],
        "user_id string, event_type string, payload string, event_time string, visibility string, recipient_id string")


def test_visibility(spark):
    rows = log(spark)
    assert tuples(serving.visible_to(rows, "A"), "event_time") == [("1",), ("2",), ("3",), ("4",), ("5",)]
    assert tuples(serving.visible_to(rows, "B"), "event_time") == [("3",), ("4",)]
    viewers = spark.createDataFrame([("A",), ("B",), ("C",)], "viewer string")
    assert tuples(serving.visible(rows, viewers), "viewer", "event_time") == [
        ("*", "3"), ("A", "1"), ("A", "2"), ("A", "4"), ("A", "5"), ("B", "4")]
    assert tuples(serving.history(rows, viewers, 2), "viewer", "event_time", "position") == [
        ("A", "4", 1), ("A", "5", 2), ("B", "3", 1), ("B", "4", 2), ("C", "3", 1)]


def test_latest_and_replace_by_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "k string, v int, p string")
    assert tuples(serving.latest_per(df, ["k"], ["v"])) == [("a", 2, "y"), ("b", 1, None)]
    assert tuples(olap.replace_by_key(df, ["k"], "v"), "k", "p") == [("a", "y"), ("b", None)]


def test_unreadable_event_times_go_to_the_reject_output(spark):
    rows = topic(spark, "internal.platform.unified.events",
                 ("1", "2024-01-01T00:00:00.123456Z", "LOGIN", "u", "e", None, None, None),
                 ("2", "yesterday", "LOGIN", "u", "e", None, None, None))
    typed, rejected = olap.typed_events(rows)
    assert [str(r.event_time) for r in typed.collect()] == ["2024-01-01 00:00:00.123000"]
    assert tuples(rejected, "event_id", "reason") == [("2", "bad_event_time")]


# ingest

def test_frames(spark):
    frames = [b"\x00\x00\x00\x01\x02body", b"\x00\x00\x00", b"\x01\x00\x00\x00\x01x", b"\x00\xff\xff\xff\xff", None]
    good, bad = ingest.split_frames(spark.createDataFrame([("t", bytearray(f) if f is not None else None) for f in frames],
                                                          "topic string, value binary"))
    assert [(r.schema_id, bytes(r.body)) for r in good.collect()] == [(258, b"body"), (4294967295, b"")]
    assert tuples(bad, "reason") == [("bad_magic_byte",), ("too_short",), ("too_short",)]


@pytest.mark.parametrize(("body", "reason"), [
    ({}, None), ({"extra": 1}, None), ({"visibility": None}, "schema_violation"), ({"message": 5}, "schema_violation"),
    ({"recipient_id": None}, None), ({"recipient_id": 7}, "schema_violation"), ({"user_id": None}, "schema_violation"),
    ("[1]", "invalid_json"), ('[{"user_id":"u","email":"e","message":"m","timestamp":"t"}]', "invalid_json"), ("{", "invalid_json"), ("x" * 2_000_000, "payload_too_large"), (None, "invalid_json"),
])
def test_json_contract(spark, body, reason):
    if isinstance(body, dict):
        body = json.dumps({"user_id": "u", "email": "e", "message": "m", "timestamp": "t", **body})
    records = spark.createDataFrame([("k", body)], "record string, value string")
    good, bad = ingest.parse_json(records, "public.user.message.events")
    assert [r.reason for r in bad.collect()] == ([reason] if reason else [])
    assert [(r.record, r.visibility) for r in good.collect()] == ([] if reason else [("k", "broadcast")])


def test_json_numbers_stay_exact(spark):
    base = {"user_id": "u", "file_name": "f", "media_type": "m", "request_id": "r", "request_time": "t"}
    bodies = [json.dumps({**base, "file_size": n}) for n in (9007199254740993, 1.5, "1")]
    good, bad = ingest.parse_json(spark.createDataFrame([(b,) for b in bodies], "value string"), "internal.media.upload.intent")
    assert [r.file_size for r in good.collect()] == [9007199254740993]
    assert bad.count() == 2


def test_routes(spark):
    good, bad = ingest.route(spark.createDataFrame([("LOGIN",), ("message",), (None,)], "route_key string"))
    assert tuples(good, "topic") == [("public.identity.login.events",)]
    assert bad.count() == 2


def test_intents(spark):
    rows = spark.createDataFrame([("u", "r1", "f", "image/png", 1), ("u", "r2", "", "image/png", 1), ("u", "r3", "f", None, 1),
                                  ("u", "r4", "f", "image/png", 0), ("u", "r5", "f", "text/plain", 1)],
                                 "user_id string, request_id string, file_name string, media_type string, file_size long")
    good, bad = ingest.validate_intents(rows, "upload", F.lit("now"), "request_id", check_media_type=True)
    assert tuples(good, "request_id", "topic", "request_time") == [("r1", "internal.media.upload.intent", "now")]
    assert tuples(bad) == [("r2", "invalid file_name"), ("r3", "invalid media_type"), ("r4", "invalid file_size"),
                           ("r5", "media_type not allowed")]
    paths = spark.createDataFrame([("u", "r", "")], "user_id string, request_id string, file_path string")
    assert ingest.validate_intents(paths, "delete", F.lit("now")).rejected.count() == 1
    made = [ingest.validate_intents(rows, "upload", F.lit(t)).accepted.select("request_id").first()[0] for t in "aab"]
    assert made[0] == made[1] != made[2] and len(made[0]) == 64


def test_object_notifications(spark):
    def record(key, size=204800, kind="image/jpeg", meta=None, time="2026-02-26T10:00:00Z"):
        return {"eventTime": time, "s3": {"bucket": {"name": "media"}, "object": {
            "key": key, "size": size, "contentType": kind, "userMetadata": meta or {}}}}

    body = json.dumps({"Records": [
        record("uploads/user-123/uuid-1/photo.jpg", meta={"X-Amz-Meta-Email": "other", "email": "user@example.com"}),
        record("other/file.txt"), record("uploads/short"), record("files/user-123/uuid-1/photo.jpg"),
        record("uploads%2Fu1%2Fid%2Fa+b.png", kind="", time=""), record("uploads/u/i/100%.png")]})
    df = spark.createDataFrame([(body,)], "body string")
    out = ingest.received_from_objects(df, "now")
    assert tuples(out, "user_id", "email", "file_path", "file_name", "media_type", "upload_time", "permanent_path", "retry_count") == [
        ("u", "", "uploads/u/i/100%.png", "100%.png", "image/jpeg", "2026-02-26T10:00:00Z", "files/u/i/100%.png", 0),
        ("u1", "", "uploads/u1/id/a b.png", "a b.png", "application/octet-stream", "now", "files/u1/id/a b.png", 0),
        ("user-123", "user@example.com", "uploads/user-123/uuid-1/photo.jpg", "photo.jpg", "image/jpeg",
         "2026-02-26T10:00:00Z", "files/user-123/uuid-1/photo.jpg", 0)]
    assert tuples(ingest.ready_from_objects(df, "now"), "file_path") == [("files/user-123/uuid-1/photo.jpg",)]
    assert OBJECT_NOTIFICATION.simpleString().startswith("struct<Records:array<")


def test_row_changes(spark):
    row = "struct<id:string,email:string,last_sign_in_at:string,raw_user_meta_data:string,created_at:string>"
    changes = spark.createDataFrame([
        ("update", ("u", "e", None, "{}", "c"), ("u", "e", "t", '{"device_id":"d"}', "c")),
        ("update", ("u", "e", "t", "{}", "c"), ("u", "e2", "t", "{}", "c")),
        ("insert", None, ("v", "e", None, None, "c"))], f"op string, old {row}, new {row}")
    assert tuples(ingest.logins_from_changes(changes)) == [("u", "e", "t", "d", None, None)]
    assert tuples(ingest.signups_from_changes(changes)) == [("v", "e", "c")]
    gone = spark.createDataFrame([("delete", ("u", "agent", "10.0.0.1/32")), ("delete", ("x", None, None))],
                                 "op string, old struct<user_id:string,user_agent:string,ip:string>")
    users = spark.createDataFrame([("u", "e")], "id string, email string")
    assert tuples(ingest.signouts_from_changes(gone, users, F.lit("now"))) == [
        ("u", "e", "now", None, "agent", "10.0.0.1"), ("x", None, "now", None, None, None)]


# scalars

@pytest.mark.parametrize(("size", "text"), [
    (0, "0 B"), (-1, "0 B"), (1, "1 B"), (512, "512 B"), (1023, "1023 B"), (1024, "1 KB"), (1536, "1.5 KB"),
    (1024 ** 2, "1 MB"), (1024 ** 3, "1 GB"), (1024 ** 4, "1 TB"), (3 * 1024 ** 5, "3072 TB"), (1280, "1.3 KB")])
def test_file_size_text(spark, size, text):
    assert one(spark, S.file_size_text(F.lit(size))) == text


@pytest.mark.parametrize(("media_type", "category"), [
    ("image/bmp", "image"), ("video/avi", "video"), ("audio/flac", "audio"), ("application/pdf", "unknown"),
    ("text/plain", "unknown"), ("", "unknown"), (None, "unknown")])
def test_media_category(spark, media_type, category):
    assert one(spark, S.media_category(F.lit(media_type).cast("string"))) == category


@pytest.mark.parametrize(("kind", "payload", "text"), [
    ("identity.login", None, "🚀 Flink mapped Login: now"),
    ("user.message", '{"email":"ann@x.org","message":"hi"}', "💬 ann: hi"),
    ("user.message", "{}", "💬 : "),
    ("media.upload_failed", "{}", "❌ Upload failed: unknown"),
    ("media.upload_failed", '{"failure_reason":"max"}', "❌ Upload failed: max"),
    ("credit.balance_changed", "{}", "📌 credit.balance_changed: now")])
def test_notification_text(spark, kind, payload, text):
    assert one(spark, S.notification_text(F.lit(kind), F.lit(payload).cast("string"), F.lit("now"))) == text


@pytest.mark.parametrize(("raw", "count"), [("2", 2), ("2.0", 2), ("many", 0), ("", 0), (None, 0)])
def test_retry_count(spark, raw, count):
    assert one(spark, S.retry_count_int(F.lit(raw).cast("string"))) == count


# metrics

def samples(spark, *rows):
    return spark.createDataFrame(list(rows), "metric string, labels map<string,string>, t string, value double").select(
        "metric", "labels", F.to_timestamp("t").alias("ts"), "value")


def minute(n):
    return f"2024-01-01T00:{n:02d}:00Z"


def test_patterns_match_whole_label_values(spark):
    rows = samples(spark, *[("m", {"topic": t}, minute(0), 1.0) for t in
                            ("internal.media.upload.dead-letter", "x.internal.media.upload.dead-letter", "other")])
    assert metrics.match(rows, {"topic": "~internal.media.*.dead-letter"}).count() == 1
    assert metrics.match(rows, {"missing": ""}).count() == 3


def test_quantile_beyond_the_last_edge_is_the_edge_below(spark):
    rates = spark.createDataFrame([("1", 1.0), ("5", 2.0), ("+Inf", 4.0)], "le string, rate double").withColumn("ts", F.lit(0))
    out = metrics.histogram_quantile([0.25, 0.5, 0.9], rates, [])
    assert tuples(out, "q", "quantile") == [(0.25, 1.0), (0.5, 5.0), (0.9, 5.0)]


def test_every_alert_rule_can_fire(spark):
    spine = metrics.spine("2024-01-01T00:00:00Z", "2024-01-01T00:20:00Z", spark.range(1))
    ups = []
    for n in range(21):
        for metric, labels, value in [
            ("flink_jobmanager_job_uptime", {}, 0), ("pg_stat_activity_count", {}, 71),
            ("redpanda_kafka_consumer_group_lag", {"group": "g"}, 21),
            ("http_server_request_duration_seconds_count", {"http_response_status_code": "500"}, n),
            ("http_server_request_duration_seconds_count", {"http_response_status_code": "200"}, n),
            ("http_server_request_duration_seconds_bucket", {"le": "1"}, 0),
            ("http_server_request_duration_seconds_bucket", {"le": "10"}, n),
            ("http_server_request_duration_seconds_bucket", {"le": "+Inf"}, n),
            ("kafka_consumer_messages_total", {"topic": "internal.media.upload.dead-letter"}, n),
            ("redpanda_storage_disk_free_bytes", {}, 10), ("redpanda_storage_disk_total_bytes", {}, 100),
            ("kube_pod_container_status_restarts_total", {"pod": "p"}, n),
            ("kube_pod_status_phase", {"phase": "Pending"}, 1),
            ("airflow_dagrun_duration_total", {"state": "failed"}, n),
        ]:
            ups.append((metric, labels, minute(n), float(value)))
    out = metrics.alerts(samples(spark, *ups), spine)
    assert {r.alert for r in out.select("alert").distinct().collect()} == {r.name for r in metrics.ALERT_RULES}


def test_latest_by_and_lag(spark):
    rows = samples(spark, ("up", {"p": "1", "phase": "Running"}, minute(0), 1.0), ("up", {"p": "1", "phase": "Running"}, minute(1), 0.0),
                   ("up", {"p": "2", "phase": "Running"}, minute(1), 1.0))
    assert tuples(metrics.latest_by(rows, "up", ["phase"], "count", keep=F.col("value") == 1)) == [("Running", 1.0)]
    ends = spark.createDataFrame([("t", 0, 10, 1), ("t", 0, 12, 2), ("t", 1, 5, 1)], "topic string, partition int, offset long, ts int")
    done = spark.createDataFrame([("g", "t", 0, 7, 1), ("g", "t", 1, 5, 1)], "group string, topic string, partition int, offset long, ts int")
    assert tuples(metrics.consumer_lag(ends, done)) == [("g", "t", 5)]


# governance

def test_masking_and_contract(spark):
    logins = topic(spark, "public.identity.login.events", ("u", "e", "t", None, None, None))
    masked = governance.mask_columns(logins, {"email": "pii", "device_id": "pii"}).collect()[0]
    assert len(masked.email) == 64 and masked.device_id is None and masked.user_id == "u"
    broken = logins.withColumn("email", F.lit(None).cast("string"))
    found = governance.contract_violations(broken, "public.identity.login.events", {"has agent": F.col("user_agent") != ""}, ["user_id"])
    assert tuples(found) == [("email is null", "u"), ("has agent", "u")]


# plans

def test_filters_and_columns_reach_the_scan(spark, folder):
    text = oracle.plan(QUERIES["daily_login_aggregates"](spark, folder))
    assert "EqualTo(event_type,view)" in text and "GreaterThanOrEqual(ts," in text and "LessThan(ts," in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_schema_changes_and_the_rows_read_with_another_schema(spark):
    from eventmart.operators.governance import resolve_payloads, schema_changes
    ddl = T.StructType.fromDDL
    old = ddl("a int, b string, c double, gone string, n struct<x: int>")
    new = ddl("b binary, a bigint not null, c int, d string, e string not null, f string not null, n struct<x: bigint>")
    changes = schema_changes(old, new, {"f": F.lit("?")}, tags={"d": "none", "e": "pii"})
    assert {(f, c) for f, c, breaks in changes if breaks} == {
        ("c", "double is no int"), ("e", "new: missing"), ("f", "new: no tag"), ("n", "struct<x:int> is no struct<x:bigint>")}
    assert {(f, c) for f, c, breaks in changes if not breaks} == {
        ("b", "string as binary"), ("a", "int as bigint"), ("a", "nulls are rejected"), ("d", "new: null"), ("f", "new: default"), ("gone", "dropped")}
    assert schema_changes(old, old) == []
    rows = spark.createDataFrame([
        (1, 1, '{"a":5,"b":"x"}'), (2, 2, '{"b":7,"a":9000000000,"z":"y"}'), (3, 1, '{"b":"x"}'), (4, 3, '{"a":1}'), (5, None, '{"a":1}'),
        (6, 1, None), (7, 1, "not json"), (8, 1, ""), (9, 2, "[1]"), (10, 4, '{"a":"1"}'), (1, 1, '{"a":5,"b":"x"}'), (11, 1, '{"a":"words"}')],
        "id int, version int, body string")
    schemas = {1: ddl("a int, b string"), 2: ddl("a bigint, b string, z string"), 4: ddl("a string")}
    reading = ddl("a bigint not null, b string, z string")
    resolved, rejected = resolve_payloads(rows, "body", "version", schemas, reading, {"z": F.lit("none")})
    assert sorted(map(tuple, resolved.collect())) == [(1, 1, 5, "x", "none"), (1, 1, 5, "x", "none"), (2, 2, 9000000000, "7", "y")]
    assert {r.id: r.reason for r in rejected.collect()} == {
        3: "a is null", 4: "unknown version", 5: "unknown version", 6: "not an object", 7: "not an object", 8: "not an object", 9: "not an object",
        10: "a: string is no bigint", 11: "a is null"}
    with pytest.raises(ValueError):
        resolve_payloads(rows.withColumn("z", F.lit(1)), "body", "version", schemas, reading)
    assert resolve_payloads(rows.limit(0), "body", "version", schemas, reading)[0].count() == 0
