"""The trie of conversations' prefixes, by truncation peeling.

1. Conversations are rebuilt block by block and become paths: the key of each of their prefixes (a digest chained from turn
   to turn) and the words of each turn. Texts go no further. Paths that are equal become one class with its members' number.
2. Peeling starts at the greatest depth. Classes that end there meet the nodes that are left from the depth below, those with
   the same key are one node, its last turn is stripped, and so on up to the root. A node's number of members, children, leaves and
   saved words come from what it is made of, so nodes are found and summed in one pass.
3. A node with more than `LIGHT` turns of more than `FEW` classes under it is heavy. Subtrees right below heavy nodes are light: whole ones are dealt
   to tasks, about `TASK_TURNS` turns each, and peeled there. What comes out of their tops is peeled through the
   heavy nodes by groupings of the whole table, a round for each heavy depth. So no task holds what a common first turn or a
   common conversation leads to, and the number of rounds follows the depth of what many share, not that of the longest.
4. The digest of a node's ended conversations is made of runs of sorted ids, which are joined to texts where they lie. Only
   the texts of a class meet in one task, one after the other.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.tables import settle

BLOCK, SHARED = 20, 4  # ids that share a first conversation, and the number its shared turns stay below
LIGHT, FEW = 2_048, 32
TASK_TURNS = 16_384
RUN_IDS = 65_536  # ids that are joined to one text
ROOT = b"\0" * 16
_NOBODY = hashlib.sha256(b"").hexdigest()
_PATH = "conv_id bigint, last binary, n bigint, keys binary, words binary"


def _turns(conversations: DataFrame) -> DataFrame:
    """block, conv_id, turn, digest (of role and text), words."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    words = F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")).cast("long")
    conv = F.col("conv_id").cast("long")
    return conversations.where("conv_id is not null").select(
        (conv - conv % BLOCK).alias("block"), conv.alias("conv_id"), "turn",
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        words.alias("words"))


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths of the rebuilt conversations. The rows of a block come together, its first conversation's before the others'."""
    block = conv = first_turns = None
    out: list[tuple] = []

    def begin():
        nonlocal taken, position, key, keys, words
        taken = zlib.crc32(str(conv).encode()) % SHARED
        position, key, keys, words = 0, ROOT, [], []
        if conv != block:
            for turn in first_turns[:taken]:
                add(*turn)

    def add(digest: bytes, n_words: int):
        nonlocal key
        key = hashlib.blake2b(digest, digest_size=16, key=key).digest()
        keys.append(key)
        words.append(n_words)

    def end():
        out.append((conv, key, len(keys), b"".join(keys), np.array(words, "<i8").tobytes()))

    taken, position, key, keys, words = 0, 0, ROOT, [], []
    names = [c.split(" ")[0] for c in _PATH.split(", ")]
    types = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for batch in batches:
        for b, c, digest, n_words in zip(*(batch.column(x).to_pylist() for x in ("block", "conv_id", "digest", "words"))):
            if c != conv:
                if conv is not None:
                    end()
                if b != block:
                    block, first_turns = b, []
                conv = c
                begin()
            position += 1
            if c == block and position < SHARED:
                first_turns.append((digest, n_words))
            if c == block or position > taken:
                add(digest, n_words)
        if out:
            yield flush()
    if conv is not None:
        end()
        yield flush()


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """conv_id, last (the key of the whole path), n (its turns), keys (of its prefixes, 16 bytes each), words (of its turns, 8
    bytes each): a row for each rebuilt conversation."""
    turns = _turns(conversations).repartition("block").withColumn("later", F.col("conv_id") != F.col("block"))
    ordered = turns.sortWithinPartitions("block", "later", "conv_id", F.col("turn").asc_nulls_first(), "digest")
    return ordered.select("block", "conv_id", "digest", "words").mapInArrow(_rebuild, _PATH)


def _join_ids(run_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """last, first, ids (joined): runs of sorted ids of a class."""
        last, ids = None, []

        def made():
            return pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([ids[0]], pa.int64()),
                                               pa.array([",".join(map(str, ids))])], names=["last", "first", "ids"])
        for batch in batches:
            for k, c in zip(batch.column("last").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (k != last or len(ids) == run_ids):
                    yield made()
                    ids = []
                last = k
                ids.append(c)
        if ids:
            yield made()
    return run


def _digest_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last = state = None
    for batch in batches:
        done = []
        for k, ids in zip(batch.column("last").to_pylist(), batch.column("ids").to_pylist()):
            if k == last:
                state.update(b",")
            else:
                if state is not None:
                    done.append((last, state.hexdigest()))
                last, state = k, hashlib.sha256()
            state.update(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["last", "ends"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([state.hexdigest()])], names=["last", "ends"])


def end_digests(paths: DataFrame, run_ids: int = RUN_IDS) -> DataFrame:
    """last, ends: SHA-256 of the ids of the conversations with that path, in order, joined by commas.

    The ids of a path are sorted over many tasks and joined to runs there. One task sees the runs of a path as a stream."""
    ids = paths.select("last", "conv_id").repartitionByRange("last", "conv_id").sortWithinPartitions("last", "conv_id")
    runs = ids.mapInArrow(_join_ids(run_ids), "last binary, first bigint, ids string")
    return runs.repartition("last").sortWithinPartitions("last", "first").mapInArrow(_digest_runs, "last binary, ends string")


def _numbers(blobs: pa.Array, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(blobs.to_pylist()), dtype)


def _each_node(deepest: int | None):
    """The nodes on the paths of classes, with the turns from there on: last, key, parent, depth, words, turns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy()
            keys, words = batch.column("keys").to_pylist(), batch.column("words").to_pylist()
            upto = n if deepest is None else np.minimum(n, deepest)
            size = int(upto.sum())
            if not size:
                continue
            own = np.repeat(np.arange(len(n)), upto)
            depth = np.arange(size) - np.repeat(np.cumsum(upto) - upto, upto) + 1
            at = np.frombuffer(b"".join(k[:16 * u] for k, u in zip(keys, upto.tolist())), "V16")
            before = np.frombuffer(b"".join((ROOT + k)[:16 * u] for k, u in zip(keys, upto.tolist())), "V16")
            fixed = lambda a: pa.Array.from_buffers(pa.binary(16), size, [None, pa.py_buffer(a)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("last").take(pa.array(own)), fixed(at), fixed(before), pa.array(depth),
                 pa.array(np.frombuffer(b"".join(w[:8 * u] for w, u in zip(words, upto.tolist())), "<i8")),
                 pa.array(n[own] - depth + 1)], names=["last", "key", "parent", "depth", "words", "turns"])
    return run


_NODE = "last binary, key binary, parent binary, depth bigint, words bigint, turns bigint"
_PEELED = ("conv_id bigint, depth bigint, parent_conv_id bigint, top_of binary, n_convs bigint, n_children bigint, "
           "n_leaves bigint, saved_tokens bigint, ends string")


def peel(table: pa.Table) -> pa.Table:
    """The nodes of whole subtrees, from classes: last, n, keys, words, n_convs, conv_id, ends, above (the depth of the heavy
    node over the class's subtree). A subtree's top has no parent_conv_id yet, but its heavy parent's key in top_of."""
    n, above, members, first = (table.column(c).to_numpy() for c in ("n", "above", "n_convs", "conv_id"))
    keys = _numbers(table.column("keys"), "<u8").reshape(-1, 2)
    words = _numbers(table.column("words"), "<i8")
    offset = np.cumsum(n) - n
    # nodes that are left from the depth below: a class on whose path each lies, and the node's figures
    path = conv = convs = children = leaves = saved = ended = np.zeros(0, np.int64)
    out: list[tuple[np.ndarray, ...]] = []  # conv, depth, parent, class for top_of, convs, children, leaves, saved, class that ends
    for depth in range(int(n.max(initial=0)), int(above.min(initial=0)), -1):
        ends = np.flatnonzero(n == depth)
        paths = np.concatenate((path, ends))
        if not len(paths):
            continue
        key = keys[offset[paths] + depth - 1]
        order = np.lexsort((key[:, 1], key[:, 0]))
        new = np.ones(len(order), bool)
        new[1:] = (key[order[1:]] != key[order[:-1]]).any(axis=1)
        node = np.empty(len(order), np.int64)
        node[order] = np.cumsum(new) - 1
        size = int(new.sum())
        below, here = node[:len(path)], node[len(path):]
        smallest = np.full(size, np.iinfo(np.int64).max)
        np.minimum.at(smallest, node, np.concatenate((conv, first[ends])))
        if len(path):
            out.append((conv, np.full(len(path), depth + 1), smallest[below], np.full(len(path), -1), convs, children, leaves, saved, ended))
        summed = lambda of, values: np.bincount(of, values, size).astype(np.int64)  # noqa: E731, B023
        number = summed(below, convs) + summed(here, members[ends])
        n_children = np.bincount(below, minlength=size)
        n_leaves = np.where(n_children == 0, 1, summed(below, leaves))
        on = paths[order[new]]
        n_saved = summed(below, saved) + (number - 1) * words[offset[on] + depth - 1]
        end_of = np.full(size, -1)
        end_of[here] = ends
        top = above[on] + 1 == depth
        if top.any():
            out.append((smallest[top], np.full(int(top.sum()), depth), np.full(int(top.sum()), -1), on[top], number[top],
                        n_children[top], n_leaves[top], n_saved[top], end_of[top]))
        path, conv, convs, children, leaves, saved, ended = (
            a[~top] for a in (on, smallest, number, n_children, n_leaves, n_saved, end_of))
    conv, depth, parent, top_of, convs, children, leaves, saved, ended = (
        np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out) if out else [()] * 9))
    top_key = [None if k < 0 else ROOT if above[k] == 0 else keys[offset[k] + above[k] - 1].tobytes() for k in top_of.tolist()]
    ends_text = table.column("ends").take(pa.array(ended, pa.int64(), mask=ended < 0)).fill_null(_NOBODY)
    return pa.table({
        "conv_id": pa.array(conv, pa.int64()), "depth": pa.array(depth, pa.int64()),
        "parent_conv_id": pa.array(parent, pa.int64(), mask=top_of >= 0), "top_of": pa.array(top_key, pa.binary()),
        "n_convs": pa.array(convs, pa.int64()), "n_children": pa.array(children, pa.int64()),
        "n_leaves": pa.array(leaves, pa.int64()), "saved_tokens": pa.array(saved, pa.int64()), "ends": ends_text})


def _peel_groups(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    return peel(table)


def prefix_nodes(paths: DataFrame, light: int = LIGHT, task_turns: int = TASK_TURNS, few: int = FEW) -> DataFrame:
    """The nodes of the trie of `rebuilt_paths`: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. The result is the same for all light, task_turns and few."""
    paths = settle(paths)
    classes = paths.groupBy("last").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"),
                                        F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("words").alias("words"))
    classes = settle(classes.join(end_digests(paths), "last"))
    # heavy nodes, and the depth of the last one on each class's path
    heavy = (classes.select("last", "n", "keys", "words").mapInArrow(_each_node(None), _NODE).groupBy("key")
             .agg(F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("words").alias("words"),
                  F.sum("turns").alias("turns"), F.count(F.lit(1)).alias("n_classes"))
             .where((F.col("turns") > light) & (F.col("n_classes") > few)).select("key", "parent", "depth", "words"))
    heavy = settle(heavy)
    deepest = heavy.agg(F.max("depth")).first()[0] or 0
    classes = classes.withColumn("above", F.lit(0).cast("long"))
    if deepest:
        under = (classes.select("last", "n", "keys", "words").mapInArrow(_each_node(deepest), _NODE)
                 .join(heavy.select("key"), "key").groupBy("last").agg(F.max("depth").alias("_above")))
        classes = settle(classes.join(under, "last", "left").withColumn("above", F.coalesce("_above", "above")).drop("_above"))
    turns = classes.agg(F.sum(F.col("n") - F.col("above"))).first()[0] or 0
    tasks = 1 + turns // task_turns
    subtree = F.substring("keys", (16 * F.col("above") + 1).cast("int"), F.lit(16))
    peeled = settle(classes.where("n > above").withColumn("task", F.pmod(F.xxhash64(subtree), F.lit(tasks)))
                    .groupBy("task").applyInArrow(_peel_groups, _PEELED))
    inner, tops = peeled.where("top_of is null").drop("top_of"), peeled.where("top_of is not null")
    heavy = heavy.union(heavy.sparkSession.range(1).select(F.lit(ROOT), F.lit(None).cast("binary"), F.lit(0).cast("long"), F.lit(0).cast("long")))
    ending = classes.where("n = above").select(
        F.col("last").alias("key"), "n", "conv_id", "n_convs", F.lit(0).alias("child"), F.lit(0).cast("long").alias("leaves"),
        F.lit(0).cast("long").alias("saved"), "ends")
    done: list[DataFrame] = []
    for depth in range(deepest, -1, -1):
        child = lambda df: df.select(
            F.col("top_of").alias("key"), "conv_id", "n_convs", F.lit(1).alias("child"), F.col("n_leaves").alias("leaves"),
            F.col("saved_tokens").alias("saved"), F.lit(None).cast("string").alias("ends"))
        parts = ending.where(F.col("n") == depth).drop("n").union(child(tops.where(F.col("depth") == depth + 1)))
        if done:
            parts = parts.union(child(done[-1]))
        sums = parts.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
                                        F.sum("child").alias("n_children"), F.sum("leaves").alias("leaves"),
                                        F.sum("saved").alias("saved"), F.max("ends").alias("ends"))
        done.append(settle(heavy.where(F.col("depth") == depth).join(sums, "key").select(
            "key", "conv_id", "depth", F.col("parent").alias("top_of"), "n_convs", "n_children",
            F.when(F.col("n_children") == 0, 1).otherwise(F.col("leaves")).cast("long").alias("n_leaves"),
            (F.col("saved") + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
            F.coalesce("ends", F.lit(_NOBODY)).alias("ends"))))
    root = done[-1].first()
    rest = tops.drop("parent_conv_id")
    for level in done[:-1]:
        rest = rest.unionByName(level.drop("key"))
    at_root = F.col("top_of") == F.lit(ROOT)  # most tops hang there: no join for them
    named = rest.where(at_root).withColumn("parent_conv_id", F.lit(root and root.conv_id).cast("long")).drop("top_of")
    for k, level in enumerate(done[:-1]):
        parents = level.select(F.col("key").alias("top_of"), F.col("conv_id").alias("parent_conv_id"))
        named = named.unionByName(rest.where(~at_root & (F.col("depth") == deepest - k + 1)).join(parents, "top_of").drop("top_of"))
    named = named.unionByName(done[-1].drop("key", "top_of").withColumn("parent_conv_id", F.lit(None).cast("long")))
    return inner.unionByName(named).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, light: int = LIGHT, task_turns: int = TASK_TURNS, few: int = FEW) -> DataFrame:
    """conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: a row
    for each distinct sequence of first turns of the rebuilt conversations, from the root without a turn.

    conversations: conv_id, turn, role, text; other columns are ignored, whatever their names. Turns are in the order of
    turn, nulls first. Turns that tie go by the SHA-256 of their role and text; repeated rows are turns of their own. A null
    role or text counts as empty. Rows without a conv_id take no part. A conversation of which nothing is left ends at the
    root. An empty table gives no rows, not even a root. A conversation's keys lie in one row, 24 bytes a turn.
    """
    return prefix_nodes(rebuilt_paths(conversations), light, task_turns, few)
