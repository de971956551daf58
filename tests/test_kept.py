"""Kept tables: deltas, repeats, compaction and readers; retry loops; windows as streams."""

import pytest
from pyspark.sql import functions as F

from eventmart.operators import metrics, olap, sagas, serving
from eventmart.plans import jobs
from eventmart.schemas import TOPICS
from eventmart.streaming import dedup, sinks, tables

SCHEMA = "key string, value long, version long"


def newest(rows):
    return olap.replace_by_key(rows, ["key"], "version")


def batch(spark, rows, version):
    return spark.createDataFrame([(k, v, version) for k, v in rows], SCHEMA)


def content(spark, target):
    schema = spark.createDataFrame([], SCHEMA).schema
    return {r.key: r.value for r in tables.read(spark, target, schema, newest).collect()}


def names(target):
    import os
    return sorted(n for n in os.listdir(target) if n.startswith(("base-", "delta-")))


def test_kept_table_writes_deltas_and_compacts(spark, tmp_path):
    target, write = str(tmp_path / "t"), tables.keep(str(tmp_path / "t"), newest, compact_after=3)
    assert content(spark, target) == {}
    write(batch(spark, [(f"k{k}", k) for k in range(500)], 0), 0)
    write(batch(spark, [("k1", 100), ("k1", 100)], 1), 1)
    assert names(target) == ["delta-0", "delta-1"]
    assert spark.read.parquet(f"{target}/delta-1").count() == 1  # the batch, reduced, and nothing of the table
    write(batch(spark, [("k1", 999)], 1), 1)  # a repeat of what is published changes nothing
    assert content(spark, target)["k1"] == 100
    newest(batch(spark, [("k2", 7)], 2)).write.parquet(f"{target}/delta-2")  # a crash before publishing
    assert content(spark, target)["k2"] == 2
    write(batch(spark, [("k2", 200)], 2), 2)
    write(batch(spark, [("k3", 300)], 3), 3)
    assert "base-3" in names(target) and content(spark, target) == {f"k{k}": k for k in range(500)} | {"k1": 100, "k2": 200, "k3": 300}
    write(batch(spark, [("k3", 301)], 4), 4)
    before = content(spark, target)
    assert tables.vacuum(spark, target, keep_pointers=1) and names(target) == ["base-3", "delta-4"]
    assert content(spark, target) == before


def test_a_pointer_that_is_not_whole_is_not_read(spark, tmp_path):
    target = str(tmp_path / "t")
    tables.keep(target, newest)(batch(spark, [("a", 1)], 0), 0)
    (tmp_path / "t" / "_pointer-000000000009").write_text('{"last": 9, "base": null, "del')
    assert content(spark, target) == {"a": 1}


def test_newest_per_viewer_of_parts_is_that_of_the_whole(spark):
    rows = spark.createDataFrame([(v, "e", str(k % 7), f"2024-01-01T00:00:{k % 60:02d}Z", "u") for k in range(300) for v in "ab*"],
                                 "viewer string, event_type string, payload string, event_time string, user_id string")
    parts = [rows.where(F.pmod(F.hash("event_time"), F.lit(3)) == p) for p in range(3)]
    joined = serving.newest_per_viewer(parts[0], 5).unionByName(serving.newest_per_viewer(parts[1], 5)).unionByName(
        serving.newest_per_viewer(parts[2], 5))
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(serving.newest_per_viewer(joined, 5)) == key(serving.newest_per_viewer(rows, 5))


@pytest.mark.parametrize("works_at,want", [(0, [0]), (2, [0, 1, 2]), (9, [0, 1, 2, 3])])
def test_delete_retries_end(spark, tmp_path, works_at, want):
    topic, root = jobs.DELETE_RETRY, str(tmp_path)
    rows = spark.createDataFrame([("u", "p", "n", "m", 1, "r1", 0, "2024-01-01T00:00:00Z")], TOPICS[topic])
    sinks.append_sink(f"{root}/{topic}", "first")(rows, 0)
    sinks.append_sink(f"{root}/{topic}", "first")(rows, 1)  # a replay
    runs = jobs.run_retry_loop(spark, topic, root, f"{root}/cp",
                               lambda df: df.withColumns({"removed_ok": F.col("retry_count") >= works_at, "error": F.lit("no")}))
    assert runs == len(want)
    counts = sorted(r.retry_count for r in spark.read.parquet(f"{root}/{topic}").select("retry_count", "request_id").distinct().collect())
    dead = spark.read.schema(TOPICS["internal.media.delete.dead-letter"]).parquet(f"{root}/internal.media.delete.dead-letter").collect()
    assert counts == want and len(dead) == (works_at > sagas.MAX_RETRIES)


def test_late_samples_are_counted(spark, tmp_path):
    root, schema = str(tmp_path), "metric string, labels map<string,string>, ts timestamp, value double"

    def put(times):
        rows = spark.createDataFrame([("m", {"a": "b"}, t, 1.0) for t in times], "metric string, labels map<string,string>, ts string, value double")
        rows.withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(f"{root}/in")

    def once():
        stream = metrics.rollup_stream(spark.readStream.schema(schema).parquet(f"{root}/in"))
        job = sinks.start(stream, lambda df, i: df.write.mode("append").parquet(f"{root}/out"), f"{root}/cp")
        job.awaitTermination()
        return metrics.late_rows(job.recentProgress)
    put(["2024-01-01T00:00:01Z", "2024-01-01T00:00:05Z", "2024-01-01T01:00:00Z"])
    assert once() == 0
    put(["2024-01-01T00:00:07Z", "2024-01-01T02:00:00Z"])
    assert once() == 1
    got = sorted((r.bucket.strftime("%H:%M:%S"), r.n) for r in spark.read.parquet(f"{root}/out").collect())
    assert got == [("00:00:00", 2), ("01:00:00", 1)]


def test_outcomes_as_a_stream_equal_the_batch_form_in_any_order(spark, tmp_path):
    import random
    rng, second = random.Random(5), lambda t: f"2024-01-01T00:{t // 60:02d}:{t % 60:02d}.000000Z"
    asked = "request_id string, file_path string, types array<string>, request_time string"
    told = "event_type string, payload string, event_time string"
    types = ["done", "refused"]
    requests = [(f"r{k}", f"/p{rng.randrange(6)}", types[: 1 + k % 2], second(rng.randrange(500))) for k in range(60)]
    requests += [("no-path", None, types, second(5)), ("", "/p1", types, second(7)), (None, "/p2", types, second(9)), ("none", "", types, second(9)),
                 ("no-types", "/p1", [], second(5)), ("bad-time", "/p1", types, "yesterday")]
    answers = []
    for k in range(200):
        fields = [f'"request_id":"r{rng.randrange(60)}"' if rng.random() < 0.4 else '"request_id":""', f'"file_path":"/p{rng.randrange(6)}"']
        answers.append((rng.choice(types + ["other"]), "{" + ",".join(fields[: rng.choice([1, 2])]) + "}", second(rng.randrange(540))))
    answers += [("done", None, second(5)), ("done", "not json", second(5)), ("done", '{"file_path":"/p1"}', "never"), (None, '{"file_path":"/p1"}', second(8))]
    batch_form = serving.match_outcomes(spark.createDataFrame(requests, asked), spark.createDataFrame(answers, told))
    sides = []
    for name, rows, schema, last in [("q", requests + requests[:9], asked, ("end", None, [], "2024-02-01T00:00:00.000000Z")),
                                     ("n", answers, told, ("end", "{}", "2024-02-01T00:00:00.000000Z"))]:
        rng.shuffle(rows)
        for part in range(3):  # a file to a micro-batch
            spark.createDataFrame(rows[part::3], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
        spark.createDataFrame([last], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
        sides.append(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}"))
    stream = serving.match_outcomes_stream(*sides)
    sinks.start(stream, sinks.append_sink(f"{tmp_path}/out"), f"{tmp_path}/checkpoint").awaitTermination()
    got = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").select(*batch_form.columns).collect()
    assert sorted(map(str, got)) == sorted(map(str, batch_form.collect()))
    assert {r.matched_by for r in got} == {"request_id", "file_path", None}


def test_a_request_of_a_hot_key_is_held_against_one_time_chunk(spark, tmp_path):
    """Three hundred days of one path, with an answer each: the join's keys name the chunk, so that state of one key is cut by time."""
    day = lambda k, s: f"2023-{1 + k // 28:02d}-{1 + k % 28:02d}T23:59:{s:02d}.000000Z"
    asked, told = "request_id string, file_path string, types array<string>, request_time string", "event_type string, payload string, event_time string"
    requests = [(f"r{k}", "/hot", ["done"], day(k, 50)) for k in range(300)]
    answers = [("done", '{"file_path":"/hot"}', day(k, 55)) for k in range(300)]
    answers = [(t, p, e if k % 2 else e.replace("T23:59:55", "T23:59:40")) for k, (t, p, e) in enumerate(answers)]  # even days: too early
    sides = []
    for name, rows, schema, last in [("q", requests, asked, ("end", None, [], "2024-02-01T00:00:00.000000Z")),
                                     ("n", answers, told, ("end", "{}", "2024-02-01T00:00:00.000000Z"))]:
        spark.createDataFrame([*rows, last], schema).coalesce(1).write.parquet(f"{tmp_path}/{name}")
        sides.append(spark.readStream.schema(schema).parquet(f"{tmp_path}/{name}"))
    stream = serving.match_outcomes_stream(*sides)
    job = sinks.start(stream, sinks.append_sink(f"{tmp_path}/out"), f"{tmp_path}/checkpoint")
    job.awaitTermination()
    got = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out").where("request_id <> 'end'").collect()
    assert {r.request_id: r.outcome for r in got} == {f"r{k}": "done" if k % 2 else "timeout" for k in range(300)} and len(got) == 300
    joins = [line for line in job._jsq.explainInternal(False).split("\n") if "StreamingSymmetricHashJoin" in line]
    assert joins and all(line.split("],")[0].count("_chunk") == 1 and line.count("_chunk") >= 2 for line in joins)


@pytest.mark.parametrize("bits", [8, dedup.BITS])
def test_replays_of_any_age_are_left_out(spark, tmp_path, bits):
    schema, target = "key string, number int, time string", str(tmp_path / "t")
    first = [("a", 1, "2024-01-01T10:00:00Z"), ("a", 1, "2024-01-01T10:00:00Z"), ("b", 2, "2024-01-02T10:00:00Z"),
             (None, 3, "2024-01-02T11:00:00Z"), ("c", 4, None), ("d", 5, "never")]
    later = [("a", 1, "2024-01-01T10:00:00Z"), (None, 3, "2024-01-02T11:00:00Z"), ("c", 4, None), ("d", 5, "never"), ("e", 6, "2024-01-01T12:00:00Z")]
    later += [(f"k{k}", k, "2024-01-02T10:00:00Z") for k in range(300)]
    write = dedup.first_rows(target, ["key", "time"], "time", bits)
    content = lambda: sorted(map(str, dedup.table(spark, target, spark.createDataFrame([], schema).schema).drop("day").collect()))
    write(spark.createDataFrame(first, schema), 0)
    write(spark.createDataFrame(later, schema), 1)
    once = content()
    expected = {(k, n, t, 0) for k, n, t in first} | {(k, n, t, 1) for k, n, t in later if (k, n, t) not in first}
    assert len(once) == len(expected)
    got = {tuple(r) for r in dedup.table(spark, target, spark.createDataFrame([], schema).schema).drop("day").collect()}
    assert got == expected
    write(spark.createDataFrame(later, schema), 1)  # the batch repeated
    assert content() == once
    write(spark.createDataFrame([], schema), 2)
    write(spark.createDataFrame(first + later, schema), 3)
    assert content() == once


def test_lasting_points_and_missing_data_as_streams_equal_the_batch_forms(spark, tmp_path):
    import random
    from datetime import datetime, timedelta

    from eventmart.streaming import processors
    rng, begin = random.Random(9), datetime(2024, 1, 1)
    at = lambda s: begin + timedelta(seconds=s)
    schema = "series string, ts timestamp, value double"
    points = [(f"s{k % 4}", at(t), rng.choice([0.0, 1.0, 1.0, 1.0, None])) for k, t in enumerate(rng.sample(range(7200), 900)) if not 2000 < t < 2600]
    points += [(None, at(t), 1.0) for t in range(0, 600, 50)]
    series = spark.createDataFrame(points, schema)
    expected = metrics.sustained(series, F.col("value") > 0, 120, ["series"], 90).select("series", "ts", "since", "firing")

    def stream(name, rows, end, parts=4):
        shuffled = list(rows)
        rng.shuffle(shuffled)
        shuffled.sort(key=lambda r: next(x for x in r if isinstance(x, datetime)))
        for part in range(parts):  # files in order of time, their rows in any
            whole = spark.createDataFrame(shuffled[part * len(rows) // parts:(part + 1) * len(rows) // parts], end[1])
            whole.orderBy(F.rand(3)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
        spark.createDataFrame([end[0]], end[1]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
        return spark.readStream.schema(end[1]).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}")

    def caught_up(rows, name):
        sinks.start(rows, sinks.append_sink(f"{tmp_path}/{name}"), f"{tmp_path}/{name}-checkpoint").awaitTermination()
        return spark.read.schema(rows.schema).parquet(f"{tmp_path}/{name}").select(*rows.columns)

    lasting = processors.sustained_stream(stream("points", points, (("end", at(90_000), 0.0), schema)), F.col("value") > 0, 120, ["series"], 90, "2 hours")
    assert sorted(map(str, caught_up(lasting, "lasting").collect())) == sorted(map(str, expected.collect()))

    labelled = "metric string, ts timestamp, labels map<string,string>, value double"
    samples = [("up", at(t), {"job": "a"}, 1.0) for t in [0, 1, 61, 600, 1233, 1800, 1800, 3599]] + [("up", at(900), {"job": "b"}, 1.0), ("other", at(910), {"job": "a"}, 1.0)]
    beats = [(at(60 * k),) for k in range(80)]
    gone = metrics.absent(spark.createDataFrame(samples, labelled), "up", spark.createDataFrame(beats, "ts timestamp"), matchers={"job": "a"})
    looked = stream("beats", beats + beats[:4], ((at(90_000),), "ts timestamp"), 2)
    seen = stream("samples", samples, (("other", at(3600), {"job": "a"}, 1.0), labelled), 2)
    found = metrics.absent_stream(seen, "up", looked, matchers={"job": "a"}, delay="2 hours")
    assert sorted(map(str, caught_up(found, "gone").collect())) == sorted(map(str, gone.collect()))
    assert 40 < gone.count() < 80
    never = caught_up(metrics.absent_stream(seen, "down", looked, delay="2 hours"), "never")  # no sample at all
    assert sorted(r.ts for r in never.collect()) == [t for t, in beats]
    with pytest.raises(ValueError):
        metrics.absent_stream(series, "up", series, lookback_s=90)


@pytest.mark.parametrize("name, batches", [("stream_dedup_replays", 4), ("stream_history_top20", 3), ("stream_credit_balances", 3)])
def test_parts_are_landed_by_several_tasks(spark, folder, tmp_path, monkeypatch, name, batches):
    """Each part is a batch, and no task writes or reads all of it."""
    from eventmart.plans import queries
    monkeypatch.setattr(queries, "shared_dir", lambda spark: str(tmp_path))
    assert queries.QUERIES[name](spark, folder).count() > 0
    assert len(list(tmp_path.glob("in/*.parquet"))) >= 2 * batches
    assert len(list(tmp_path.glob("checkpoint*/**/commits/[0-9]*"))) == batches
