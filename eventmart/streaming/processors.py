"""The stateful rules as streams. Rows wait in state until the watermark has passed them, then run in time order.

Rows of one key may arrive in any order inside the watermark's delay and from different micro-batches; results depend
on their times only, so a stream gives what the closed batch forms give on the same rows. Every bucket of keys with
something waiting has a timer, for the next row, deadline or orphan, so no state of theirs stays for good.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterator

from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, GroupedData, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventmart.functions.scalars import iso_micros, micros
from eventmart.operators import media
from eventmart.operators.credits import BEFORE_ALL_US, INTERNAL_ERROR
from eventmart.operators.media import METADATA, OWNER
from eventmart.operators.sagas import RECEIVED
from eventmart.streaming import rules
from eventmart.streaming.rules import CreditCheck, FileStore, Lasting, MoveSaga, UploadTtl

DELAY = "10 minutes"

# Executors need not have this package installed: the few lines they run travel with the query.
for _module in (rules, sys.modules[__name__]):
    register_pickle_by_value(_module)


MINUTE_US = 60_000_000
BUCKETS = 4096  # groups of keys; fixed for the life of a checkpoint
SHORTER, PART = 16, 4096  # how much shorter nearer entries of what waits are, and the most items of one part
ROW, WAKE, FORGET = range(3)  # what an item asks for: a row to run, a deadline to look at, a request to forget


def _of(name: str, kind: T.DataType) -> T.StructType:
    """A schema of one column. State schemas are made on executors too, where no session can read text."""
    return T.StructType([T.StructField(name, kind)])


class Waiting:
    """What a bucket of keys has to do later: items, each a tuple that starts with its time, in entries of a state map.

    The nearer the time an entry spans is to the present, the shorter it is: one unit up to 16 units ahead, 16 units up to 256
    ahead, and so on. When the first item of an entry is due, the entry is read, and its other items go to shorter ones, so an
    item moves a few times at most and a wake-up does not touch what waits for much later. An entry has parts of a bounded size.
    """

    def __init__(self, handle: StatefulProcessorHandle):
        place = T.StructType([T.StructField("start", T.LongType()), T.StructField("width", T.LongType()), T.StructField("part", T.LongType())])
        self.handle = handle
        self.entries = handle.getMapState("waiting", place, _of("items", T.BinaryType()))
        self.places = handle.getValueState("places", _of("places", T.BinaryType()))

    def open(self) -> None:
        """Reads, for the key at hand, where its items are: the first time, the parts and the size of the last part of each entry."""
        saved = self.places.get()
        self.of, self.wake = ({}, None) if saved is None else pickle.loads(bytes(saved[0]))

    def add(self, items: list[tuple], now: int) -> None:
        dealt: dict[tuple, list] = {}
        for item in items:
            width, ahead = 1, item[0] - now
            while ahead >= width * SHORTER:
                width *= SHORTER
            dealt.setdefault((item[0] // width * width, width), []).append(item)
        for place, rows in dealt.items():
            first, parts, last = self.of.get(place, (rows[0][0], 0, 0))
            first = min(first, *(r[0] for r in rows)) if len(rows) > 1 else min(first, rows[0][0])
            if 0 < last < PART:
                parts -= 1
                rows = self._read(place, parts) + rows
            for i in range(0, len(rows), PART):
                self.entries.updateValue((*place, parts), (pickle.dumps(rows[i:i + PART]),))
                parts, last = parts + 1, len(rows[i:i + PART])
            self.of[place] = first, parts, last

    def _read(self, place: tuple, part: int) -> list[tuple]:
        return pickle.loads(bytes(self.entries.getValue((*place, part))[0]))

    def take(self, now: int) -> list[tuple]:
        """The items before `now`, which go."""
        due, later = [], []
        for place in [p for p, (first, *_) in self.of.items() if first < now]:
            for part in range(self.of.pop(place)[1]):
                for item in self._read(place, part):
                    (due if item[0] < now else later).append(item)
                self.entries.removeKey((*place, part))
        self.add(later, now)
        return due

    def close(self, wake_ms: Callable[[int], int], fired_ms: int | None = None) -> None:
        """Writes where the items are, and sets a timer for the first of them. `wake_ms`: when a time is due."""
        if self.wake is not None and self.wake == fired_ms:
            self.wake = None
        first = min((f for f, *_ in self.of.values()), default=None)
        if first is None:
            self.places.clear()
            return
        wake = wake_ms(first)
        if self.wake is None or wake < self.wake:
            self.handle.registerTimer(wake)
            self.wake = wake
        self.places.update((pickle.dumps((self.of, self.wake)),))


class OrderedProcessor(StatefulProcessor):
    """Runs a rule over each key's rows in time order, once the watermark makes the order final.

    A bucket of keys is one group, so that what a group costs is paid once for many keys. A minute runs as a whole when the
    watermark has passed it, and a timer reads what is due and leaves what waits for later (`Waiting`). Each key has its
    own state, of which only those of keys with something due are read. Deadlines are looked at up to the last minute that
    has ended, since rows of a minute that has not may still come before them.

    A rule with `once` (columns that name a request) handles each request once: what it has answered is remembered for
    `remember_us` of event time, and a replay within that time gives nothing.
    """

    def __init__(self, rule, row_schema: T.StructType, output: list[str]):
        self.rule, self.output = rule, output
        self.names = [n for n in row_schema.names if n != "key"]
        self.state_schema = T.StructType.fromDDL(rule.state)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = Waiting(handle)
        self.states = handle.getMapState("states", _of("key", T.StringType()), self.state_schema)
        self.once = getattr(self.rule, "once", ())
        if self.once:
            request = T.StructType([T.StructField("key", T.StringType()), T.StructField("request", T.StringType())])
            self.answered = handle.getMapState("answered", request, _of("us", T.LongType()))

    @staticmethod
    def _ended(timerValues) -> int:
        """The first minute that has not."""
        return timerValues.getCurrentWatermarkInMs() * 1000 // MINUTE_US

    @staticmethod
    def _after(minute: int) -> int:
        return (minute + 1) * MINUTE_US // 1000

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        items = [(row["us"] // MINUTE_US, ROW, row["key"], tuple(row[n] for n in self.names)) for row in rows]
        self.waiting.open()
        self.waiting.add(items, self._ended(timerValues))
        self.waiting.close(self._after)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        ended = self._ended(timerValues)
        self.waiting.open()
        rows: dict[str, list] = {}
        forgotten, later, out = [], [], []
        for _, kind, of, what in self.waiting.take(ended):
            if kind == FORGET:
                forgotten.append((of, what))
            else:
                rows.setdefault(of, []).extend([what] if kind == ROW else [])
        for of, values in rows.items():
            for r in self._run(of, values, ended, later):
                out.append(Row(**{n: (of if n == "key" else r[n]) for n in self.output}))
        for request in forgotten:
            self.answered.removeKey(request)
        self.waiting.add(later, ended)
        self.waiting.close(self._after, expiredTimerInfo.getExpiryTimeInMs())
        return iter(out)

    def _run(self, key: str, values: list[tuple], ended: int, later: list[tuple]) -> list[dict]:
        """One key's rows that are due, and its deadlines."""
        rule, fields = self.rule, self.state_schema.names
        saved = self.states.getValue((key,))
        state = {} if saved is None else {n: saved[i] for i, n in enumerate(fields) if saved[i] is not None}
        out, requests = [], set()
        for row in sorted((dict(zip(self.names, v)) for v in values), key=rule.order):
            if not self.once or self._first_time(key, row, ended, requests, later):
                out += rule.step(state, row)
        out += rule.settle(state, ended * MINUTE_US)
        if state:
            self.states.updateValue((key,), tuple(state.get(n) for n in fields))
            wake = rule.wake_at(state)
            if wake is not None:
                later.append((wake // MINUTE_US, WAKE, key, None))
        elif saved is not None:
            self.states.removeKey((key,))
        return out

    def _first_time(self, key: str, row: dict, ended: int, requests: set[str], later: list[tuple]) -> bool:
        if any(row[c] is None for c in self.once):
            return True
        request = "/".join(str(row[c]) for c in self.once)
        if request in requests:
            return False
        requests.add(request)
        if self.answered.containsKey((key, request)):
            return False
        self.answered.updateValue((key, request), (row["us"],))
        later.append((ended + self.rule.remember_us // MINUTE_US, FORGET, key, request))
        return True

    def close(self) -> None:
        pass


def _run(rows: DataFrame, rule, output: str, delay: str) -> DataFrame:
    """`rows`: key, us and the rule's columns. The watermark runs on the row time of both inputs together.

    The time column itself stays behind: without it a row later than the watermark is not dropped but runs
    when it arrives, after the rows already settled. Rows without a readable time or without a key have no place in
    the order; `jobs.start_rejects` writes them to a table of their own.
    """
    rows = rows.filter("us is not null and key is not null")
    timed = rows.withColumn("ts", F.timestamp_micros("us")).withWatermark("ts", delay).drop("ts")
    out = T.StructType.fromDDL(output)
    return _bucketed(timed, "key").transformWithState(
        OrderedProcessor(rule, rows.schema, out.names), out, outputMode="append", timeMode="eventtime")


def _bucketed(rows: DataFrame, key: str) -> GroupedData:
    return rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")).groupBy("_bucket")


def expired_uploads_stream(signed: DataFrame, received: DataFrame, delay: str = DELAY, **limits) -> DataFrame:
    """Signed uploads whose object did not arrive in time, as a stream."""
    rows = (signed.select(F.col("file_path").alias("key"), micros("signed_time").alias("us"), F.lit(0).alias("kind"),
                          "user_id", "file_name", "request_id", "signed_time")
            .unionByName(received.select(F.col("file_path").alias("key"), micros("upload_time").alias("us"),
                                         F.lit(1).alias("kind")), allowMissingColumns=True))
    out = _run(rows, UploadTtl(**limits), "key string, user_id string, file_name string, request_id string, "
                                          "signed_time string, outcome_us long", delay)
    return out.select("user_id", F.col("key").alias("file_path"), "file_name",
                      F.lit(0).cast("bigint").alias("file_size"), F.lit("").alias("media_type"), "request_id",
                      F.col("signed_time").alias("request_time"), iso_micros("outcome_us").alias("expired_time"))


def move_saga_stream(received: DataFrame, ready: DataFrame, delay: str = DELAY, **limits) -> DataFrame:
    """Outcomes of received uploads as a stream, in the same wide rows as the batch form."""
    rows = (received.select(F.col("permanent_path").alias("key"), micros("upload_time").alias("us"),
                            F.lit(0).alias("kind"), *MoveSaga.fields)
            .unionByName(ready.select(F.col("file_path").alias("key"), micros("upload_time").alias("us"),
                                      F.lit(1).alias("kind")), allowMissingColumns=True))
    out = _run(rows, MoveSaga(**limits), "_type string, key string, user_id string, email string, file_path string, "
               "file_name string, file_size long, media_type string, upload_time string, retry_count int, "
               "outcome_us long", delay)
    return (out.withColumnRenamed("key", "permanent_path")
            .select("_type", *RECEIVED, iso_micros("outcome_us").alias("outcome_time")))


def credit_check_stream(intents: DataFrame, ledger: DataFrame, delay: str = DELAY) -> DataFrame:
    """Decisions on upload intents as a stream; each user's balance is kept in state.

    `ledger` holds credits and the deductions of earlier runs, not those of the intents of this stream. As in the batch
    form, a ledger row without a readable time counts before all others, and such an intent is refused as it arrives.
    """
    rows = (intents.select(F.col("user_id").alias("key"), micros("request_time").alias("us"), F.lit(1).alias("kind"),
                           F.lit(None).cast("int").alias("amount"), *CreditCheck.fields)
            .unionByName(ledger.select(
                F.col("user_id").alias("key"), F.coalesce(micros("event_time"), F.lit(BEFORE_ALL_US)).alias("us"),
                F.lit(0).alias("kind"), "amount"), allowMissingColumns=True))
    out = _run(rows, CreditCheck(), "key string, outcome string, file_name string, media_type string, file_size long, "
               "request_id string, request_time string, reason string, outcome_us long, ledger_delta int", delay)
    approved = F.col("outcome") == "approved"
    decided = out.select("outcome", F.col("key").alias("user_id"), "file_name", "media_type", "file_size", "request_id",
                         F.when(approved, F.col("request_time")).otherwise(F.lit("")).alias("request_time"), "reason",
                         F.when(approved, F.lit("")).otherwise(iso_micros("outcome_us")).alias("rejected_time"),
                         "ledger_delta")
    refused = intents.filter(micros("request_time").isNull()).select(
        F.lit("rejected").alias("outcome"), "user_id", "file_name", "media_type", "file_size", "request_id",
        F.lit("").alias("request_time"), F.lit(INTERNAL_ERROR).alias("reason"),
        F.col("request_time").alias("rejected_time"), F.lit(0).alias("ledger_delta"))
    return decided.unionByName(refused)


def media_outcomes_stream(confirmed: DataFrame, intents: DataFrame, delay: str = DELAY, **limits) -> DataFrame:
    """Outcomes of download and delete intents as a stream, in the wide rows of `media.outcomes_in_order`.

    Each file of an owner is a key whose state is the file as the confirmations and deletes before an intent left it.
    """
    key = F.to_json(F.struct(*OWNER))
    whole = F.col("user_id").isNotNull() & F.col("file_path").isNotNull()
    rows = (confirmed.select(F.when(whole, key).alias("key"), micros("upload_time").alias("us"), F.lit(0).alias("kind"), *METADATA)
            .unionByName(intents.select(
                F.when(whole, key).alias("key"), micros("request_time").alias("us"), media.intent_kind().alias("kind"), "request_id",
                "request_time", "download_url", "deleted_ok", "removed_ok"), allowMissingColumns=True))
    out = _run(rows, FileStore(**limits), "key string, outcome string, request_id string, file_name string, media_type string, "
               "file_size long, download_url string, reason string, retry_count int, outcome_time string", delay)
    owner = F.from_json("key", "user_id string, file_path string")
    return out.withColumn("_owner", owner).select("outcome", *[F.col(f"_owner.{c}").alias(c) for c in OWNER], *media.OUTCOME[3:])


def sustained_stream(series: DataFrame, predicate: Column, for_s: int, keys: list[str], max_gap_s: int = 300, delay: str = DELAY) -> DataFrame:
    """`metrics.sustained` as a stream: the keys, `ts`, `since` and `firing` of each point. Points without a time give nothing.

    A series keeps the start and the end of its run, and nothing once its points stop holding or coming.
    """
    rows = series.select(F.to_json(F.struct(*keys)).alias("key"), F.unix_micros("ts").alias("us"), F.coalesce(predicate, F.lit(False)).alias("holds"))
    out = _run(rows, Lasting(for_s, max_gap_s), "key string, us long, since long, firing boolean", delay)
    of = F.from_json("key", series.select(*keys).schema)
    return (out.withColumn("_of", of).select(*[F.col("_of")[k].alias(k) for k in keys], F.timestamp_micros("us").alias("ts"),
                                             F.timestamp_micros("since").alias("since"), "firing"))


class FirstAttempts(StatefulProcessor):
    """Lets a row of a chain through if its count is above all counts that came before. A bucket of chains is one group."""

    def __init__(self, names: list[str], count: str, ttl_ms: int):
        self.names, self.count, self.ttl_ms = names, count, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = Waiting(handle)
        seen = T.StructType([T.StructField("count", T.IntegerType()), T.StructField("until", T.LongType())])
        self.seen = handle.getMapState("seen", _of("chain", T.StringType()), seen)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        chains: dict[str, list[Row]] = {}
        for row in rows:
            chains.setdefault(row["_chain"], []).append(row)
        out, later = [], []
        for chain, attempts in chains.items():
            seen, until = self.seen.getValue((chain,)) or (None, 0)
            before = seen
            for row in sorted(attempts, key=lambda r: r[self.count]):
                if seen is None or row[self.count] > seen:
                    seen, until = row[self.count], max(until, row["_us"] // 1000 + self.ttl_ms)
                    out.append(Row(**{n: row[n] for n in self.names}))
            if seen != before:
                self.seen.updateValue((chain,), (seen, until))
                later.append((until, chain))
        if later:
            self.waiting.open()
            self.waiting.add(later, timerValues.getCurrentWatermarkInMs() + 1)
            self.waiting.close(lambda until: until)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() + 1
        self.waiting.open()
        for chain in {chain for _, chain in self.waiting.take(now)}:
            seen = self.seen.getValue((chain,))
            if seen is not None and seen[1] < now:
                self.seen.removeKey((chain,))
        self.waiting.close(lambda until: until, expiredTimerInfo.getExpiryTimeInMs())
        return iter(())

    def close(self) -> None:
        pass


def first_attempts(rows: DataFrame, keys: list[str], time: str, count: str = "retry_count", ttl_s: int = 7 * 86_400) -> DataFrame:
    """The rows without replays: of a chain of retries (its `keys`), each count once, and never one that is not above the last.

    Since counts only rise and end at a limit, a loop that feeds its own rows back through this ends. A chain is forgotten when
    the watermark is `ttl_s` past the `time` of its last row; without a readable time, that is at once. Rows without a count
    have count 0.
    """
    rows = rows.withColumn(count, F.coalesce(F.col(count), F.lit(0)))
    out = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    timed = rows.withColumns({"_chain": F.to_json(F.struct(*keys)), "_us": F.coalesce(micros(time), F.lit(0).cast("bigint"))})
    timed = timed.withColumn("_ts", F.timestamp_micros("_us")).withWatermark("_ts", DELAY).drop("_ts")
    return _bucketed(timed, "_chain").transformWithState(
        FirstAttempts(rows.columns, count, ttl_s * 1000), out, outputMode="append", timeMode="eventtime")
