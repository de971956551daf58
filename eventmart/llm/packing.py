"""Packing of documents into training sequences by first-fit decreasing, in randomised groups of documents.

Groups hold about `group_docs` documents each, and GROUP_BYTES at most on average, drawn by a hash of the document and its
place, so a group's content does not depend on source or order, and one task sees one group only. A lost task draws the same
groups again where its input comes in the same order, as from files. Inside a group:

* A document's full stretches of `length` tokens become sequences of their own; its rest is an item.
* Items go, longest first, into the first sequence with room for them. A tournament tree over the sequences' free room
  finds that one in the logarithm of their number of steps.
* Sequences that stay open are then filled up with tokens of the last ones, cutting items where needed, and the single one
  that remains short is cut into powers of two, which are not padded. So no padding is left.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

LENGTH = 1024
GROUP_DOCS = 1024
GROUP_BYTES = 1 << 23  # of a group's texts, on average at most
END = 0  # the id after each document

_encoders: dict[str, tuple] = {}


def _bytes_of() -> dict[str, int]:
    """The printable character that a byte-level vocabulary writes for each byte, and that byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


# Fixed value: how the byte-level pre-tokenizer splits a text.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteEncoder:
    """Token ids of a byte-level vocabulary file (JSON), as the tokenizers library gives them.

    The merges run in tiktoken, which is four times as fast with the same vocabulary. Texts that hold a special
    token's string go to the tokenizers library itself, as do those on which tiktoken's pattern gives up (a run of a million
    blanks), and everything if the file has another layout.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        self.whole = Tokenizer.from_file(path)
        self.special = [t["content"] for t in layout.get("added_tokens") or []]
        pre, model = layout.get("pre_tokenizer") or {}, layout["model"]
        byte = _bytes_of()
        self.fast = None
        if (pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                and layout.get("normalizer") is None and model["type"] == "BPE" and not model.get("ignore_merges")):
            ranks = {bytes(byte[c] for c in token): n for token, n in model["vocab"].items() if token not in self.special}
            order = [ranks[bytes(byte[c] for c in "".join(m if isinstance(m, list) else m.split(" ")))] for m in model["merges"]]
            if order == sorted(order) and len(ranks) >= 256:
                self.fast = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4")
        except ValueError:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")


def encoder(path: str) -> ByteEncoder:
    if path not in _encoders:
        _encoders[path] = ByteEncoder(path)
    return _encoders[path]


class Tournament:
    """Free room of sequences in a complete binary tree whose inner nodes hold the larger of their two children."""

    def __init__(self, n: int, room: int) -> None:
        self.leaves = 1 << max(0, n - 1).bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.tree[self.leaves:self.leaves + n] = [room] * n
        for k in range(self.leaves - 1, 0, -1):
            self.tree[k] = max(self.tree[2 * k], self.tree[2 * k + 1])

    def first(self, size: int) -> int:
        """The first sequence with room for `size`; there must be one."""
        k, tree = 1, self.tree
        while k < self.leaves:
            k *= 2
            if tree[k] < size:
                k += 1
        return k - self.leaves

    def take(self, sequence: int, size: int) -> None:
        k = self.leaves + sequence
        self.tree[k] -= size
        while k > 1:
            k //= 2
            self.tree[k] = max(self.tree[2 * k], self.tree[2 * k + 1])


def first_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Sequences of item numbers; sizes are from 1 to length."""
    tree, out = Tournament(len(sizes), length), [[] for _ in sizes]
    for item in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        at = tree.first(sizes[item])
        tree.take(at, sizes[item])
        out[at].append(item)
    return [s for s in out if s]


def pack(lengths: list[int], length: int = LENGTH) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document number, start, size) that hold every token of the documents once.

    All are of `length`, but for a few at the end whose sizes are powers of two.
    """
    full, items = [], []
    for doc, n in enumerate(lengths):
        cut = n - n % length
        full += [[(doc, at, length)] for at in range(0, cut, length)]
        if n > cut:
            items.append((doc, cut, n - cut))
    packed = [[items[k] for k in s] for s in first_fit_decreasing([i[2] for i in items], length)]
    size = lambda s: sum(p[2] for p in s)
    done = full + [s for s in packed if size(s) == length]
    short = sorted((s for s in packed if size(s) < length), key=size, reverse=True)
    # fill the fullest of the open sequences with tokens of the emptiest
    filling = []
    while short:
        filling, short = short[0], short[1:]
        room = length - size(filling)
        while room and short:
            doc, at, n = short[-1].pop()
            take = min(n, room)
            filling.append((doc, at + n - take, take))
            room -= take
            if n > take:
                short[-1].append((doc, at, n - take))
            if not short[-1]:
                short.pop()
        if room == 0:
            done.append(filling)
            filling = []
    if filling:  # the one that is left: cut into sequences of powers of two
        left = size(filling)
        while left:
            part, own = 1 << (left.bit_length() - 1), []
            left -= part
            while part:
                doc, at, n = filling.pop(0)
                take = min(n, part)
                own.append((doc, at, take))
                part -= take
                if n > take:
                    filling.insert(0, (doc, at + take, n - take))
            done.append(own)
    return done


_PIECE = pa.schema([("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
                    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])


def _pack_group(path: str, length: int, with_ids: bool):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        encode, rows, tokens = encoder(path).ids, [], []
        for chunk in table.column("text").chunks:
            for text in chunk:
                tokens.append(np.append(encode(text.as_py() or ""), np.array([END], "<u4")).astype("<u4"))
        sequences = pack([len(t) for t in tokens], length)
        docs = []
        for number, sequence in enumerate(sequences):
            offset = 0
            for doc, at, n in sequence:
                ids = tokens[doc][at:at + n].tobytes()
                docs.append(doc)
                rows.append((at, n, zlib.crc32(ids), len(tokens[doc]), (key[0].as_py() << 32) + number, offset, ids if with_ids else None))
                offset += n
        out = pa.Table.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_PIECE)], schema=_PIECE)
        return out.add_column(0, "doc_id", table.column("doc_id").take(pa.array(docs, pa.int64())))
    return run


def pack_documents(documents: DataFrame, tokenizer: str, length: int = LENGTH, group_docs: int = GROUP_DOCS,
                   with_ids: bool = False) -> DataFrame:
    """Pieces of all documents (doc_id, text; other columns are ignored): doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, ids (the token ids, little-endian unsigned 32-bit, if `with_ids`; else null).

    A document is its token ids and then id 0; a null text counts as empty, so every row has at least one token.
    Repeated rows are packed each. An empty table gives no pieces. Sequence ids are unique, not gapless.
    """
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n_docs, n_bytes = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    groups = max(1, -(-n_docs // group_docs), -(-(n_bytes or 0) // GROUP_BYTES))
    # a row's place spreads rows that are equal, or have no id
    drawn = docs.withColumn("draw", F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id(), F.lit(17)), F.lit(groups)))
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return drawn.groupBy("draw").applyInArrow(
        _pack_group(tokenizer, length, with_ids),
        f"doc_id {doc_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
        "offset bigint, ids binary")
