"""The closed forms against the row-by-row rules, on random rows cut at many chunk borders, with one hot key."""

import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from eventmart.operators import credits, ingest, metrics, sagas, scans, serving
from eventmart.schemas import TOPICS
from eventmart.streaming.rules import CreditCheck, MoveSaga, UploadTtl

START = 1_704_067_200_000_000
SECOND = 1_000_000


def iso(us):
    t = datetime.fromtimestamp(us // SECOND, timezone.utc)
    return f"{t:%Y-%m-%dT%H:%M:%S}.{us % SECOND:06d}Z"


def random_rows(rng, keys, n, span_s):
    """(key, us, kind): a third of all rows on one key; times on whole seconds, so borders and ties are met."""
    for _ in range(n):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(keys)}"
        yield key, START + rng.randrange(span_s) * SECOND, rng.randrange(2)


def run_rule(rule, rows):
    """Each key's rows in order through the rule, then the end of time."""
    out, by_key = [], {}
    for row in rows:
        by_key.setdefault(row["key"], []).append(row)
    for key, mine in by_key.items():
        state, results = {}, []
        for row in sorted(mine, key=rule.order):
            results += rule.step(state, row)
        results += rule.settle(state, 1 << 60)
        out += [{"key": key, **r} for r in results]
    return out


def unique_times(rows):
    """Drop rows that share key and time with an earlier one: the rules leave their order open."""
    return list({(r[0], r[1]): r for r in rows}.values())


@pytest.mark.parametrize("grain_s", [None, 1800, 5400])
def test_upload_ttl(spark, grain_s):
    rows = unique_times(random_rows(random.Random(1), 40, 700, 40_000))
    rows = [r for r in rows if r[0] != "hot" or r[1] % 3 or r[2] == 0]
    signed = [(k, us, f"req-{i}") for i, (k, us, kind) in enumerate(rows) if kind == 0]
    received = [(k, us) for k, us, kind in rows if kind == 1 and us // SECOND % 5 < 2]
    expected = run_rule(UploadTtl(), [
        *[{"key": k, "us": us, "kind": 0, "user_id": "u", "file_name": "f", "request_id": r, "signed_time": iso(us)}
          for k, us, r in signed],
        *[{"key": k, "us": us, "kind": 1, "request_id": None} for k, us in received]])
    signed_df = spark.createDataFrame([("u", k, "f", "url", 900, r, iso(us)) for k, us, r in signed],
                                      TOPICS["public.media.upload.signed"])
    received_df = spark.createDataFrame([("u", "e", k, "f", 1, "t", iso(us), k, 0) for k, us in received],
                                        TOPICS["internal.media.upload.received"])
    out = sagas.expired_uploads(signed_df.orderBy("request_id"), received_df, grain_s=grain_s)
    got = sorted((r.file_path, r.request_id, r.request_time, r.expired_time) for r in out.collect())
    assert len(got) > 50
    assert got == sorted((r["key"], r["request_id"], r["signed_time"], iso(r["outcome_us"])) for r in expected)


@pytest.mark.parametrize("grain_s", [None, 120, 1000])
def test_move_saga(spark, grain_s):
    rows = unique_times(random_rows(random.Random(2), 40, 1500, 20_000))
    received = [(k, us, i % 5) for i, (k, us, kind) in enumerate(rows) if kind == 0]
    ready = [(k, us) for k, us, kind in rows if kind == 1]
    blank = dict.fromkeys(MoveSaga.fields)
    expected = run_rule(MoveSaga(), [
        *[{**blank, "key": k, "us": us, "kind": 0, "upload_time": iso(us), "retry_count": n} for k, us, n in received],
        *[{**blank, "key": k, "us": us, "kind": 1} for k, us in ready]])
    received_df = spark.createDataFrame([("u", "e", "p", "f", 1, "t", iso(us), k, n) for k, us, n in received],
                                        TOPICS["internal.media.upload.received"])
    ready_df = spark.createDataFrame([(k, 1, iso(us)) for k, us in ready], TOPICS["internal.media.file.ready"])
    out = sagas.move_saga(received_df.repartition(5), ready_df, grain_s=grain_s)
    got = sorted((r.permanent_path, r._type, r.upload_time, r.retry_count, r.outcome_time) for r in out.collect())
    assert {r[1] for r in got} == {"confirmed", "retry", "dead_letter"}
    assert got == sorted((r["key"], r["_type"], r["upload_time"], r["retry_count"], iso(r["outcome_us"]))
                         for r in expected)


@pytest.mark.parametrize("grain_s", [None, 60, 3600])
def test_credit_check(spark, grain_s):
    rows = list(random_rows(random.Random(3), 30, 1500, 50_000))
    asked = [(k, us, f"r{i:05d}") for i, (k, us, kind) in enumerate(rows) if kind == 0 or us // SECOND % 2]
    added = [(k, us, 1 + us // SECOND % 2) for k, us, kind in rows if kind == 1 and us // SECOND % 2 == 0]
    blank = dict.fromkeys(CreditCheck.fields)
    expected = run_rule(CreditCheck(), [
        *[{**blank, "key": k, "us": us, "kind": 1, "request_id": r} for k, us, r in asked],
        *[{**blank, "key": k, "us": us, "kind": 0, "amount": n} for k, us, n in added]])
    intents = spark.createDataFrame([(k, "f", "t", 1, r, iso(us)) for k, us, r in asked],
                                    TOPICS["internal.media.upload.intent"])
    ledger = spark.createDataFrame([(k, n, "credit.signup_bonus", "", iso(us)) for k, us, n in added],
                                   "user_id string, amount int, event_type string, description string, event_time string")
    out = credits.credit_check(intents.repartition(3), ledger, grain_s)
    got = sorted((r.user_id, r.request_id, r.outcome) for r in out.collect())
    assert {r[2] for r in got} == {"approved", "rejected"}
    assert got == sorted((r["key"], r["request_id"], r["outcome"]) for r in expected)


LEDGER = "user_id string, amount int, event_type string, description string, event_time string"


def test_credit_check_refuses_unreadable_times_and_floors_debits(spark):
    intents = spark.createDataFrame([("u", "f", "t", 1, "r", "soon")], TOPICS["internal.media.upload.intent"])
    assert [r.reason for r in credits.credit_check(intents, spark.createDataFrame([], LEDGER)).collect()] == ["internal_error"]
    ledger = spark.createDataFrame([("u", -5, "fee", "", iso(START)), ("u", 1, "gift", "", iso(START + 1))], LEDGER)
    good = spark.createDataFrame([("u", "f", "t", 1, "r", iso(START + 2))], TOPICS["internal.media.upload.intent"])
    assert [r.outcome for r in credits.credit_check(good, ledger).collect()] == ["approved"]


def test_credit_check_counts_deductions_of_earlier_runs(spark):
    def intent(name, second):
        return ("u", name, "t", 1, name, iso(START + second * SECOND))

    first = spark.createDataFrame([intent("a", 1), intent("b", 2)], TOPICS["internal.media.upload.intent"])
    bonus = spark.createDataFrame([("u", 2, "credit.signup_bonus", "Welcome bonus: 2 credits", iso(START))], LEDGER)
    ledger = bonus.unionByName(credits.deductions(credits.credit_check(first, bonus)))
    assert [r.balance for r in credits.balances(ledger).collect()] == [0]
    later = spark.createDataFrame([intent("c", 10)], TOPICS["internal.media.upload.intent"])
    assert [r.outcome for r in credits.credit_check(later, ledger).collect()] == ["rejected"]
    refund = spark.createDataFrame([("u", 1, "credit.upload_refunded", "Refund: upload expired for a", iso(START + 5 * SECOND))], LEDGER)
    assert [r.outcome for r in credits.credit_check(later, ledger.unionByName(refund)).collect()] == ["approved"]
    # the same intents judged again: their own deductions do not count against them
    again = credits.credit_check(first, ledger).collect()
    assert [r.outcome for r in again] == ["approved", "approved"]


@pytest.mark.parametrize("grain_s", [None, 3600])
def test_unreadable_times_take_no_part_at_any_chunk(spark, grain_s):
    rows = [("u", "e", "p", "f", 1, "t", time, "path", 0) for time in (iso(START), "not a time", None)]
    received = spark.createDataFrame(rows, "user_id string, email string, file_path string, file_name string, file_size long, "
                                           "media_type string, upload_time string, permanent_path string, retry_count int")
    ready = spark.createDataFrame([("path", "later")], "file_path string, upload_time string")
    assert [r._type for r in sagas.move_saga(received, ready, grain_s=grain_s).collect()] == ["retry"]
    rejected = ingest.unreadable(received, "upload_time").collect()
    assert len(rejected) == 2 and {r.reason for r in rejected} == {"bad_time"}


def test_requests_without_a_key_time_out(spark):
    requests = spark.createDataFrame(
        [("r1", None, ["done"], iso(START)), (None, None, ["done"], iso(START)), ("r2", "p", [], iso(START)), ("r3", "p", ["done"], "soon")],
        "request_id string, file_path string, types array<string>, request_time string")
    answers = spark.createDataFrame([("done", '{"request_id": "r1"}', iso(START + SECOND))], "event_type string, payload string, event_time string")
    got = {(r.request_id, r.outcome) for r in serving.match_outcomes(requests, answers).collect()}
    assert got == {("r1", "done"), (None, "timeout"), ("r2", "timeout"), ("r3", "timeout")}


def test_null_results_count_as_failed(spark):
    retries = spark.createDataFrame([("u", "p", "n", "t", 1, "r", k, ok, iso(START)) for k, ok in ((0, None), (0, True), (1, False))],
                                    "user_id string, file_path string, file_name string, media_type string, file_size long, "
                                    "request_id string, retry_count int, removed_ok boolean, failed_at string")
    assert sorted(r.retry_count for r in sagas.route_delete_retries(retries).collect()) == [1, 2]


@pytest.mark.parametrize("grain_s", [None, 600])
def test_match_outcomes(spark, grain_s):
    rng = random.Random(4)
    requests = [(f"r{i}", rng.choice(["p1", "p2", None]), START + rng.randrange(20_000) * SECOND) for i in range(300)]
    answers = [(rng.choice(["ok", "no", "other"]), rng.choice([None, f"r{rng.randrange(300)}"]),
                rng.choice([None, "p1", "p2"]), START + rng.randrange(20_000) * SECOND) for _ in range(500)]
    expected = []
    for rid, path, us in requests:
        hits = [(by, t) for kind, arid, apath, t in answers if kind in ("ok", "no") and us <= t <= us + 600 * SECOND
                for by, match in ((0, arid == rid), (1, path is not None and apath == path)) if match]
        expected.append((rid, *((lambda h: (h[0], (h[1] - us) / SECOND))(min(hits)) if hits else (None, None))))
    req = spark.createDataFrame([(r, p, ["ok", "no"], iso(us)) for r, p, us in requests],
                                "request_id string, file_path string, types array<string>, request_time string")
    import json
    ans = spark.createDataFrame(
        [(k, json.dumps({"request_id": r, "file_path": p}), iso(us)) for k, r, p, us in answers],
        "event_type string, payload string, event_time string")
    out = serving.match_outcomes(req, ans, 600, grain_s)
    by = {"request_id": 0, "file_path": 1, None: None}
    got = sorted(((r.request_id, by[r.matched_by], r.latency_s) for r in out.collect()), key=str)
    assert got == sorted(expected, key=str)


@pytest.mark.parametrize("grain_s", [0, 300])
def test_rate_and_sustained(spark, grain_s):
    rng = random.Random(5)
    points, total = {}, {"a": 0.0, "b": 0.0}
    for t in range(0, 7200, 15):
        for name in total:
            total[name] = 0.0 if rng.random() < 0.02 else total[name] + rng.choice([0, 0, 0, 3])
            if rng.random() < 0.9:
                points[name, t] = total[name]
    df = spark.createDataFrame([("m", {"s": n, "x": "1"}, datetime.fromtimestamp(START // SECOND + t, timezone.utc), v)
                                for (n, t), v in points.items()], "metric string, labels map<string,string>, ts timestamp, value double")
    expected = {}
    for n in total:
        for t in range(0, 7200 + 300, 60):
            inside = [(u, points[n, u]) for u in range(max(0, t - 299), t + 1) if (n, u) in points]
            if len(inside) > 1:
                grown = sum(b - a if b >= a else b for (_, a), (_, b) in zip(inside, inside[1:]))
                expected[n, t] = grown / (inside[-1][0] - inside[0][0])
    out = metrics.rate(df, "m", grain_s=grain_s)
    got = {(r.labels["s"], int(r.ts.replace(tzinfo=timezone.utc).timestamp()) - START // SECOND): r.rate
           for r in out.collect()}
    assert got == pytest.approx(expected)

    firing = {}
    for n in total:
        since = last = None
        for t in sorted(u for m, u in expected if m == n):
            if expected[n, t] <= 0.03:
                since = None
            elif since is None or t - last > 60:
                since = t
            firing[n, t] = since is not None and t - since >= 120
            last = t
    held = metrics.sustained(out, out["rate"] > 0.03, 120, ["series"], max_gap_s=60, grain_s=grain_s)
    got = {(r.labels["s"], int(r.ts.replace(tzinfo=timezone.utc).timestamp()) - START // SECOND): r.firing
           for r in held.collect()}
    assert got == firing and len(set(firing.values())) == 2


def test_series_sampled_at_other_times_are_summed_at_the_same_ones(spark):
    """Two counters of one service, 15 s apart, with an error in a hundred requests; free and total 15 s apart."""
    def at(second):
        return datetime.fromtimestamp(START // SECOND + second, timezone.utc)

    rows = []
    for n in range(40):
        rows += [("c", {"code": "200"}, at(60 * n), 99.0 * n), ("c", {"code": "500"}, at(60 * n + 15), 1.0 * n),
                 ("d_free_bytes", {"disk": "a"}, at(60 * n + 5), 25.0), ("d_total_bytes", {"disk": "a"}, at(60 * n + 20), 100.0)]
    df = spark.createDataFrame(rows, "metric string, labels map<string,string>, ts timestamp, value double")
    ratios = [r.ratio for r in metrics.error_ratio(df, "c", "code").orderBy("ts").collect()]
    assert ratios[2:-5] == pytest.approx([0.01] * len(ratios[2:-5])) and len(ratios) > 35
    assert {r.rate for r in metrics.rate(df, "c", matchers={"code": "200"}).collect()} == {1.65}
    shares = [r.value for r in metrics.used_share(df, "d").orderBy("ts").collect()]
    assert shares[1:-1] == [0.75] * len(shares[1:-1])


def test_lookup_lets_a_hot_key_be_split(spark):
    """With the thresholds scaled down to the test's size, the join splits the hot key's partition."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, value in conf.items():
        spark.conf.set(k, value)
    try:
        rows = spark.range(0, 300_000, 1, 16).selectExpr(
            "if(id % 3 = 0, 'hot', concat('k', id % 1000)) as key", "uuid() as payload")
        table = spark.range(2000).selectExpr("if(id = 0, 'hot', concat('k', id)) as key", "id").groupBy("key").agg(
            F.max("id").alias("newest"))
        joined = scans.lookup(rows, table, ["key"])
        joined.write.format("noop").mode("overwrite").save()
        assert joined.count() == 300_000
        counted = joined.groupBy().agg(F.count("newest"))
        assert counted.collect()[0][0] > 0
        frame = joined.select("key", "newest")
        frame.collect()
        assert "skew=true" in frame._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, value in before.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)
