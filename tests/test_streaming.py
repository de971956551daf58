"""Streams give what the closed batch forms give on the same rows, and sinks can be repeated."""

import pytest
from pyspark.sql import functions as F

from eventmart.operators import credits, identity, sagas
from eventmart.plans import jobs
from eventmart.schemas import TOPICS, conform
from eventmart.sources.event_views import MOVE_SPEED, EventViews
from eventmart.sources.topics import read_topic
from eventmart.streaming import processors, sinks

FAR = "2030-01-01T00:00:00.000000Z"


def put(df, topic, root, files=3):
    """Rows of a topic into its folder, shuffled over a few files."""
    conform(df, topic).repartition(files).write.mode("append").parquet(f"{root}/{topic}")


def run(stream, root, name="out"):
    q = sinks.start(stream, lambda df, i: df.write.mode("append").parquet(f"{root}/{name}"), f"{root}/cp-{name}")
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/{name}")


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def marker(spark, topic, time_column, **values):
    """A last row far in the future, on a key of its own: it moves the watermark past everything else."""
    schema = TOPICS[topic]
    base = {f.name: "end" if f.dataType.simpleString() == "string" else 0 for f in schema}
    return spark.createDataFrame([{**base, time_column: FAR, **values}], schema)


def test_upload_ttl_stream_equals_batch(spark, folder, tmp_path):
    v, root = EventViews(spark, folder), str(tmp_path)
    put(v.signed(), "public.media.upload.signed", root)
    put(v.received(), "internal.media.upload.received", root)
    put(marker(spark, "internal.media.upload.received", "upload_time"), "internal.media.upload.received", root, 1)
    stream = processors.expired_uploads_stream(read_topic(spark, "public.media.upload.signed", root),
                                               read_topic(spark, "internal.media.upload.received", root))
    expected = sagas.expired_uploads(v.signed(), v.received())
    assert rows(expected)
    assert rows(run(stream, root)) == rows(expected)


def test_move_saga_stream_equals_batch(spark, folder, tmp_path):
    v, root = EventViews(spark, folder), str(tmp_path)
    put(v.received(MOVE_SPEED), "internal.media.upload.received", root)
    put(v.ready(), "internal.media.file.ready", root)
    put(marker(spark, "internal.media.file.ready", "upload_time"), "internal.media.file.ready", root, 1)
    stream = processors.move_saga_stream(read_topic(spark, "internal.media.upload.received", root),
                                         read_topic(spark, "internal.media.file.ready", root))
    expected = sagas.move_saga(v.received(MOVE_SPEED), v.ready())
    assert {r[0] for r in expected.select("_type").distinct().collect()} == {"confirmed", "retry", "dead_letter"}
    assert rows(run(stream, root)) == rows(expected)


def test_credit_check_stream_equals_batch(spark, folder, tmp_path):
    v, root = EventViews(spark, folder), str(tmp_path)
    put(v.signups(), "public.identity.signup.events", root)
    put(v.upload_intents(), "internal.media.upload.intent", root)
    put(marker(spark, "public.identity.signup.events", "signup_time"), "public.identity.signup.events", root, 1)
    stream = processors.credit_check_stream(
        read_topic(spark, "internal.media.upload.intent", root),
        credits.signup_bonus(read_topic(spark, "public.identity.signup.events", root)))
    expected = credits.credit_check(v.upload_intents(), credits.signup_bonus(v.signups()))
    assert {r[0] for r in expected.select("outcome").distinct().collect()} == {"approved", "rejected"}
    assert rows(run(stream, root)) == rows(expected)


def test_late_intent_still_gets_a_decision(spark, tmp_path):
    root, topic = str(tmp_path), "internal.media.upload.intent"
    ledger = "public.identity.signup.events"
    put(marker(spark, ledger, "signup_time", user_id="u1"), ledger, root, 1)

    def once():
        return run(processors.credit_check_stream(read_topic(spark, topic, root), credits.signup_bonus(
            read_topic(spark, ledger, root))), root)

    put(marker(spark, topic, "request_time", request_id="r1"), topic, root, 1)
    once()
    put(marker(spark, topic, "request_time", request_id="late", user_id="u2",
               request_time="2024-01-01T00:00:00.000000Z"), topic, root, 1)
    out = once()
    assert [r.reason for r in out.filter("request_id = 'late'").collect()] == ["insufficient_credits"]


def test_unreadable_times_and_missing_keys_do_not_vanish(spark, tmp_path):
    root, intent, signup = str(tmp_path), "internal.media.upload.intent", "public.identity.signup.events"
    none = F.lit(None).cast("string")
    made = [marker(spark, signup, "signup_time", user_id="u1", signup_time="soon"),
            marker(spark, signup, "signup_time").withColumn("user_id", none),
            marker(spark, intent, "request_time", request_id="r1", user_id="u1", request_time="2024-01-01T00:00:00.000000Z"),
            marker(spark, intent, "request_time", request_id="r2", user_id="u2", request_time="yesterday"),
            marker(spark, intent, "request_time", request_id="r3", user_id="u1").withColumn("request_time", none),
            marker(spark, signup, "signup_time")]
    signups, intents = made[0].union(made[1]).union(made[5]), made[2].union(made[3]).union(made[4])
    put(signups, signup, root, 1)
    put(intents, intent, root, 1)
    stream = processors.credit_check_stream(read_topic(spark, intent, root), credits.signup_bonus(read_topic(spark, signup, root)))
    expected = credits.credit_check(intents, credits.signup_bonus(signups))
    got = rows(run(stream, root))
    assert got == rows(expected) and len(got) == 3
    put(marker(spark, intent, "request_time", request_id="r4").withColumn("user_id", none), intent, root, 1)
    for q in jobs.start_rejects(spark, root, f"{root}/out", f"{root}/cp", [intent, signup]):
        q.awaitTermination()
    found = {t: sorted(r.reason for r in spark.read.parquet(f"{root}/out/rejected/{t}").collect()) for t in (intent, signup)}
    assert found == {intent: ["bad_time", "bad_time", "no_key"], signup: ["no_key"]}


def test_dedup_stream_absorbs_a_replay(spark, folder, tmp_path):
    from eventmart.operators import olap
    v, root = EventViews(spark, folder), str(tmp_path)
    log = identity.unified_events(v.logins(), v.signups(), v.signouts())
    put(log.unionByName(log), jobs.UNIFIED, root)
    stream = read_topic(spark, jobs.UNIFIED, root).withColumn("ts", F.to_timestamp("event_time"))
    out = run(olap.dedup_stream(stream, olap.EVENT_KEY, "ts", "60 days"), root).drop("ts")
    assert rows(out) == rows(log)


def test_projection_jobs_feed_all_tables(spark, folder, tmp_path):
    v, root = EventViews(spark, folder), str(tmp_path)
    put(v.signups(), "public.identity.signup.events", root)
    put(v.expired(), "public.media.expired.events", root)
    put(v.confirmed(), "public.media.upload.confirmed", root)
    topics = ["public.identity.signup.events", "public.media.expired.events", "public.media.upload.confirmed"]
    for q in jobs.start_projections(spark, root, f"{root}/out", f"{root}/cp", topics):
        q.awaitTermination()
    ledger = spark.read.parquet(f"{root}/out/{jobs.LEDGER}")
    signups, expired, confirmed = v.signups().count(), v.expired().count(), v.confirmed().count()
    assert ledger.count() == signups + expired
    assert spark.read.parquet(f"{root}/out/{jobs.FILES}").count() == confirmed
    log = spark.read.parquet(f"{root}/out/{jobs.LOG}")
    assert {r[0]: r[1] for r in log.groupBy("event_type").count().collect()} == {
        "identity.signup": signups, "credit.balance_changed": signups + expired, "media.upload_expired": expired,
        "media.upload_completed": confirmed}


def test_repeated_batch_replaces_itself(spark, tmp_path):
    target = f"{tmp_path}/t"
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    write = sinks.append_sink(target, "topic")
    for batch_id in (0, 1, 1):
        write(df, batch_id)
    out = spark.read.parquet(target)
    assert out.count() == 4
    assert out.select("row_id").distinct().count() == 2


def test_fan_out_writes_every_branch(spark, tmp_path):
    df = spark.range(10)
    sinks.fan_out({"even": (F.col("id") % 2 == 0, ["id"]), "odd": (F.col("id") % 2 == 1, [F.col("id").alias("n")])},
                  lambda t: sinks.append_sink(f"{tmp_path}/{t}"))(df, 0)
    assert spark.read.parquet(f"{tmp_path}/even").count() == 5
    assert spark.read.parquet(f"{tmp_path}/odd").agg(F.sum("n")).collect()[0][0] == 25


def test_topic_to_lake_and_echo(spark, folder, tmp_path):
    v, root = EventViews(spark, folder), str(tmp_path)
    topic = "public.identity.login.events"
    put(v.logins(), topic, root)
    sinks.materialise_topic(read_topic(spark, topic, root, with_proctime=True), f"{root}/lake",
                            f"{root}/cp1", "login_time").awaitTermination()
    lake = spark.read.parquet(f"{root}/lake")
    assert lake.filter("proctime is not null and login_ts is not null").count() == v.logins().count()
    daily = identity.daily_login_aggregates(lake, v.signups(), "2024-01-15")
    assert rows(daily) == rows(identity.daily_login_aggregates(v.logins(), v.signups(), "2024-01-15"))
    text = daily._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in text
    jobs.start_echo(spark, root, root, f"{root}/cp2").awaitTermination()
    echoed = read_topic(spark, "internal.identity.login.echo", root, streaming=False)
    assert rows(echoed) == rows(identity.echo(v.logins()))


def test_olap_table_keeps_last_version_per_key(spark, folder, tmp_path):
    v, root = EventViews(spark, folder), str(tmp_path)
    log = identity.unified_events(v.logins(), v.signups(), v.signouts())

    def run_once():
        jobs.start_olap(spark, root, f"{root}/table", f"{root}/cp").awaitTermination()

    put(log, jobs.UNIFIED, root)
    run_once()
    put(log.withColumn("email", F.upper("email")), jobs.UNIFIED, root)
    run_once()
    out = spark.read.parquet(f"{root}/table")
    assert out.count() == log.count()
    assert out.filter(F.col("email") != F.upper("email")).count() == 0


def test_merge_publishes_the_finished_side_folder_after_a_crash(spark, tmp_path):
    target = f"{tmp_path}/t"
    df = spark.createDataFrame([("a", 1, "d1"), ("b", 1, "d1")], "k string, version int, d string")
    write = sinks.merge_by_key(target, ["k"], "version", "d")
    write(df, 0)
    side = spark.createDataFrame([("a", 2, "d1"), ("b", 1, "d1")], df.schema)
    side.write.parquet(f"{target}__next/1")
    write(spark.createDataFrame([("a", 2, "d1")], df.schema), 1)
    assert sorted(map(tuple, spark.read.parquet(target).select("k", "version").collect())) == [("a", 2), ("b", 1)]


def test_overwrite_partitions_replaces_only_the_touched_one(spark, tmp_path):
    target = f"{tmp_path}/t"
    sinks.overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "n int, dt string"), target)
    sinks.overwrite_partitions(spark.createDataFrame([(3, "b")], "n int, dt string"), target)
    assert sorted(map(tuple, spark.read.parquet(target).select("n", "dt").collect())) == [(1, "a"), (3, "b")]


@pytest.mark.parametrize("start", [jobs.start_move_saga, jobs.start_upload_ttl, jobs.start_credit_check])
def test_saga_jobs_write_their_topics(spark, folder, tmp_path, start):
    v, root = EventViews(spark, folder), str(tmp_path)
    put(v.received(MOVE_SPEED), "internal.media.upload.received", root)
    put(v.ready(), "internal.media.file.ready", root)
    put(v.signed(), "public.media.upload.signed", root)
    put(v.signups(), "public.identity.signup.events", root)
    put(v.upload_intents(), "internal.media.upload.intent", root)
    put(v.expired().limit(0), "public.media.expired.events", root)  # no refunds, so that some intents are refused
    for topic, column in [("internal.media.upload.received", "upload_time"),
                          ("internal.media.upload.intent", "request_time")]:
        put(marker(spark, topic, column), topic, root, 1)
    start(spark, root, f"{root}/out", f"{root}/cp").awaitTermination()
    written = {jobs.start_move_saga: ["public.media.upload.confirmed", "internal.media.upload.retry",
                                      "internal.media.upload.dead-letter"],
               jobs.start_upload_ttl: ["public.media.expired.events"],
               jobs.start_credit_check: ["public.media.upload.approved", "public.media.upload.rejected", jobs.LEDGER]}
    for topic in written[start]:
        out = spark.read.parquet(f"{root}/out/{topic}")
        assert out.count() > 0
        if topic in TOPICS:
            assert set(TOPICS[topic].names) <= set(out.columns)


def asked(spark, rows):
    """Intents: action, path, request id, second of a day, and what the outside does."""
    out = [("u" if p else None, p, r, None if t is None else f"2024-01-01T00:{t // 60:02d}:{t % 60:02d}.000000Z", a, url, marked, gone)
           for a, p, r, t, url, marked, gone in rows]
    return spark.createDataFrame(out, "user_id string, file_path string, request_id string, request_time string, action string, "
                                      "download_url string, deleted_ok boolean, removed_ok boolean")


def stored(spark, rows):
    return spark.createDataFrame([("u", "e", p, n, 5, "m", f"2024-01-01T00:{t // 60:02d}:{t % 60:02d}.000000Z") for p, n, t in rows],
                                 TOPICS["public.media.upload.confirmed"])


def test_media_outcomes_follow_the_file(spark):
    from eventmart.operators import media
    files = stored(spark, [("a", "first", 10), ("a", "second", 300), ("b", "late", 900), ("a", "first", 10)])
    intents = [("download", "a", "r1", 5, "l", None, None), ("download", "a", "r2", 10, "l", None, None),
               ("download", "a", "r3", 20, None, None, None), ("delete", "a", "r4", 30, None, None, None),
               ("delete", "a", "r5", 40, None, True, None), ("delete", "a", "r6", 40, None, True, True),
               ("delete", "a", "r5", 310, None, True, True), ("download", "a", "r7", 40, "l", None, None),
               ("download", "a", "r8", 300, "l", None, None), ("delete", "a", "r9", 400, None, True, True),
               ("delete", "b", "r10", 899, None, True, True), ("download", "b", "r11", 3000, "l", None, None),
               ("download", "b", "r12", None, "l", None, None), ("download", None, "r13", 5, "l", None, None),
               ("rename", "b", "r14", 5, "l", None, None), ("download", "b", None, 950, "l", None, None)]
    want = {("r1", "download_rejected", "not_found", None), ("r2", "signed", None, "first"),
            ("r3", "download_rejected", "internal_error", None), ("r4", "delete_rejected", "internal_error", None),
            ("r5", "deleted", None, "first"), ("r5", "retry", None, "first"), ("r6", "delete_rejected", "not_found", None),
            ("r7", "download_rejected", "not_found", None), ("r8", "signed", None, "second"), ("r9", "deleted", None, "second"),
            ("r10", "delete_rejected", "not_found", None), ("r11", "signed", None, "late"), (None, "signed", None, "late")}
    for grain in (0, 60, 86_400):
        got = media.outcomes_in_order(files, asked(spark, intents + intents[:10]), grain).collect()
        assert {(r.request_id, r.outcome, r.reason, r.file_name) for r in got} == want and len(got) == len(want)
    assert media.outcomes_in_order(files.limit(0), asked(spark, [])).count() == 0


def test_media_stream_equals_batch_with_replays(spark, tmp_path):
    """Rows in any order inside the delay, a replay in a later run, and one after its answer is forgotten."""
    import random

    from eventmart.operators import media
    draw, root = random.Random(9), str(tmp_path)
    files = stored(spark, [(p, f"n{t}", t) for p in "abc" for t in draw.sample(range(600), 4)])
    rows = [(draw.choice(["delete", "download", "download"]), draw.choice("abcd"), f"r{k}", draw.randrange(700), draw.choice(["l", None]),
             draw.random() < 0.7, draw.random() < 0.5) for k in range(80)]
    intents = asked(spark, rows)
    schema = intents.schema

    def stream():
        return processors.media_outcomes_stream(read_topic(spark, "public.media.upload.confirmed", root),
                                                spark.readStream.schema(schema).parquet(f"{root}/intents"), remember_s=7200)
    put(files, "public.media.upload.confirmed", root)
    intents.repartition(4).write.mode("append").parquet(f"{root}/intents")
    end = asked(spark, [("download", "end", "end", 3500, None, None, None)])
    end.write.mode("append").parquet(f"{root}/intents")
    once = rows_of(run(stream(), root))
    expected = rows_of(media.outcomes_in_order(files, intents))
    assert once == expected and {r.outcome for r in media.outcomes_in_order(files, intents).collect()} == {
        "signed", "download_rejected", "deleted", "delete_rejected", "retry"}
    put(files, "public.media.upload.confirmed", root, 1)  # replays of both sides change nothing
    intents.write.mode("append").parquet(f"{root}/intents")
    assert rows_of(run(stream(), root)) == expected


def rows_of(df):
    return [r for r in rows(df.where("file_path <> 'end'"))]


def test_a_key_with_many_waiting_rows_runs_only_what_is_due(spark, tmp_path):
    """What is due comes out while later minutes wait; nothing is lost when they end."""
    root = str(tmp_path)
    files = stored(spark, [("a", "n", 0)])
    rows = [("download", "a", f"r{k}", k, "l", None, None) for k in range(3000)]
    schema = asked(spark, rows[:1]).schema

    def stream():
        return processors.media_outcomes_stream(read_topic(spark, "public.media.upload.confirmed", root),
                                                spark.readStream.schema(schema).parquet(f"{root}/intents"), delay="10 minutes")
    put(files, "public.media.upload.confirmed", root, 1)
    asked(spark, rows).write.mode("append").parquet(f"{root}/intents")
    first = {r.request_id for r in run(stream(), root).collect()}
    assert 2000 < len(first) < 2500 and first == {f"r{k}" for k in range(len(first))}
    asked(spark, [("download", "end", "end", 3599, None, None, None)]).write.mode("append").parquet(f"{root}/intents")
    assert len({r.request_id for r in run(stream(), root).collect()}) > len(first)
