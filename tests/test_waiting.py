"""What the stateful processors read and write, counted on state that lies in plain dicts."""

import pickle
import random
from types import SimpleNamespace

from pyspark.sql import Row
from pyspark.sql import types as T

from eventmart.streaming import processors
from eventmart.streaming.processors import FirstAttempts, OrderedProcessor, Waiting
from eventmart.streaming.rules import CreditCheck, FileStore

MINUTE = processors.MINUTE_US


class Handle:
    """State of one group; `calls` and `size` are the calls and the bytes written to it."""

    def __init__(self):
        self.calls, self.size, self.timers, self.maps = 0, 0, set(), {}

    def _call(self, result=None, written=()):
        self.calls, self.size = self.calls + 1, self.size + sum(len(pickle.dumps(w)) for w in written)
        return result

    def registerTimer(self, ms):
        self._call()
        self.timers.add(ms)

    def getMapState(self, name, key, value):
        held = self.maps.setdefault(name, {})
        return SimpleNamespace(
            getValue=lambda k: self._call(held.get(k)), containsKey=lambda k: self._call(k in held),
            updateValue=lambda k, v: self._call(held.__setitem__(k, v), [k, v]), removeKey=lambda k: self._call(held.pop(k, None)))

    def getValueState(self, name, value):
        held = self.maps.setdefault(name, {})
        return SimpleNamespace(get=lambda: self._call(held.get(0)), exists=lambda: self._call(0 in held),
                               update=lambda v: self._call(held.__setitem__(0, v), [v]), clear=lambda: self._call(held.pop(0, None)))


def at(ms):
    return SimpleNamespace(getCurrentWatermarkInMs=lambda: ms, getCurrentProcessingTimeInMs=lambda: 0)


def fire(processor, handle, group, ms):
    out, timers = [], sorted(t for t in handle.timers if t <= ms)
    for t in timers:
        out += processor.handleExpiredTimer(group, at(ms), SimpleNamespace(getExpiryTimeInMs=lambda t=t: t))
        handle.timers.discard(t)
    return out


def drive(rule, names, batches, output):
    """Batches of (rows, watermark in ms afterwards) of the key k through a processor."""
    kinds = {"us": T.LongType(), "kind": T.IntegerType()}
    schema = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names])
    processor, handle, out, now = OrderedProcessor(rule, schema, output), Handle(), [], 0
    processor.init(handle)
    for rows, ms in batches:
        out += processor.handleInputRows(("k",), iter([Row(key="k", **r) for r in rows]), at(now))
        out += fire(processor, handle, ("k",), now)
        now = ms
        out += fire(processor, handle, ("k",), now)
    return out, handle


def asks(n):
    names = ["us", "kind", "request_id", "request_time", "download_url", "deleted_ok", "removed_ok", *FileStore.metadata]
    rows = [dict.fromkeys(names) | {"us": i * 7 * MINUTE, "kind": 2, "request_id": f"r{i}"} for i in range(n)]
    return names, rows


def test_state_written_for_requests_grows_as_the_requests(spark):
    size = {}
    for n in (400, 1600):
        names, rows = asks(n)
        out, handle = drive(FileStore(), names, [(rows + rows, 10 ** 9), (rows[:n // 2], 10 ** 9)], ["key", "request_id"])
        assert sorted(r.request_id for r in out) == sorted(f"r{i}" for i in range(n)) and {r.key for r in out} == {"k"}
        size[n] = handle.size
    assert size[1600] < 5 * size[400]


def test_calls_to_state_follow_the_keys_and_not_the_minutes(spark):
    names = ["us", "kind", "amount", *CreditCheck.fields]
    rows = [dict.fromkeys(names) | {"us": i * MINUTE, "kind": 1, "request_id": f"r{i}"} for i in range(2000)]
    out, handle = drive(CreditCheck(), names, [(rows, 10 ** 9)], ["key", "request_id"])
    assert [r.request_id for r in out] == [f"r{i}" for i in range(2000)]
    assert handle.calls < 200 and not handle.timers and not handle.maps["waiting"]


def test_a_chain_costs_a_few_calls_and_is_forgotten():
    handle, processor = Handle(), FirstAttempts(["id", "n"], "n", 1000)
    processor.init(handle)
    rows = [Row(id=i, n=n, _chain=f"c{i}", _us=i * 1000) for n in (2, 0, 1, 1) for i in range(500)]
    out = list(processor.handleInputRows((1,), iter(rows), at(0)))
    assert sorted((r.id, r.n) for r in out) == [(i, n) for i in range(500) for n in (0, 1, 2)]
    assert handle.calls < 2 * 500 + 10
    fire(processor, handle, (1,), 1249)
    assert len(handle.maps["seen"]) == 250
    out = list(processor.handleInputRows((1,), iter(rows), at(1249)))
    assert {r.id for r in out} == set(range(250))
    fire(processor, handle, (1,), 5000)
    assert not handle.maps["seen"] and not handle.timers and not handle.maps["waiting"]


def test_items_come_when_they_are_due_and_move_a_few_times(monkeypatch):
    monkeypatch.setattr(processors, "PART", 50)
    draw, handle, now = random.Random(3), Handle(), -5
    waiting, held, written = Waiting(handle), [], 0
    for _ in range(150):
        items = [(now + draw.choice([draw.randrange(-20, 40), draw.randrange(5000)]), draw.random()) for _ in range(draw.randrange(40))]
        held += items
        waiting.open()
        waiting.add(items, now)
        waiting.close(lambda t: t)
        now += draw.choice([0, 1, 1, 30, 200])
        waiting.open()
        got = waiting.take(now)
        waiting.close(lambda t: t, min(handle.timers, default=None))
        assert sorted(got) == sorted(i for i in held if i[0] < now)
        held = [i for i in held if i[0] >= now]
        assert not held or min(handle.timers) <= min(held)[0]
        handle.timers = {t for t in handle.timers if t >= now}
    assert sum(len(pickle.loads(v[0])) for v in handle.maps["waiting"].values()) == len(held)
    assert all(len(pickle.loads(v[0])) <= 50 for v in handle.maps["waiting"].values())
