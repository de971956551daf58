"""Sharding by a minimax contiguous partition of groups of equal texts. Built-in functions only.

Groups are ordered by their digest. Every shard takes a contiguous run of groups, and the largest shard is as small as
that allows. Its size, the capacity, is found by binary search: a capacity is feasible if shards that are filled greedily,
in order, suffice for all groups.

The search never sees all groups. It works on cells, at most `CELLS` of them, each the groups of one stretch of the
running total. A capacity found with cuts at the cells' borders only is feasible, and so an upper bound. One found as if a
cell could be cut anywhere is a lower bound. All cuts of capacities in between lie in a few cells, which the next round
divides further, until the bounds meet.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.tables import settle

SHARDS = 16
CELLS = 4096
_BUCKETS = 1024  # stretches of the digest order that are summed apart
_SALTS = 64  # parts of a group of equal texts that are numbered apart


class Cells:
    """Disjoint stretches [start, end) of the running total, in order. `whole` ones are single groups; others may be cut at
    their end and, as far as is known, anywhere inside."""

    def __init__(self, rows: list[tuple[int, int, bool]]) -> None:
        self.start = [r[0] for r in rows]
        self.end = [r[1] for r in rows]
        self.whole = [r[2] for r in rows]

    def cut(self, limit: int, hopeful: bool) -> int:
        """The last place up to `limit` where a shard may end."""
        k = bisect.bisect_right(self.end, limit)
        if hopeful and k < len(self.end) and not self.whole[k] and self.start[k] < limit:
            return limit
        return self.end[k - 1] if k else 0

    def cuts(self, capacity: int, shards: int, total: int, hopeful: bool) -> list[int]:
        """Ends of greedily filled shards. The shards suffice if the last one is the total."""
        out, at = [], 0
        for _ in range(shards):
            at = min(total, max(at, self.cut(at + capacity, hopeful)))
            out.append(at)
        return out

    def least(self, shards: int, total: int, hopeful: bool, low: int, high: int) -> int:
        """The smallest feasible capacity from low to high."""
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, total, hopeful)[-1] == total:
                high = middle
            else:
                low = middle + 1
        return low


def _read_cells(groups: DataFrame, width: int, stretches: list[tuple[int, int]]) -> list[tuple[int, int, bool]]:
    inside = F.lit(False)
    for low, high in stretches:
        inside |= (F.col("group_start") >= low) & (F.col("group_end") <= high)
    cell = F.floor(F.col("group_start") / F.lit(width)).cast("long")
    cells = (groups.where(inside).groupBy(cell.alias("cell"))
             .agg(F.min("group_start").alias("s"), F.max("group_end").alias("e"), F.count(F.lit(1)).alias("n")))
    return sorted((r.s, r.e, r.n == 1) for r in cells.collect())


def smallest_capacity(groups: DataFrame, shards: int, total: int, largest: int, cells: int = CELLS) -> tuple[int, list[int]]:
    """The minimax capacity, and the ends of the shards that are filled greedily up to it.

    groups: group_start, group_end, its stretch of the running total. About `cells` rows are read at a time.
    """
    width = max(1, -(-total // cells))
    known = Cells(_read_cells(groups, width, [(0, total)]))
    low, high = max(largest, -(-total // shards)), total
    while True:
        low = known.least(shards, total, True, low, high)
        high = known.least(shards, total, False, low, high)
        first, last = known.cuts(low, shards, total, False), known.cuts(high, shards, total, True)
        if low == high and first == last:
            return low, last
        # the cuts of all capacities from low to high lie between these places
        unsure = [(a, b) for a, b in zip(first, last) if a < b]
        opened = [any(known.start[k] < b and known.end[k] > a for a, b in unsure) for k in range(len(known.start))]
        stretches: list[tuple[int, int]] = []
        for k, o in enumerate(opened):
            if o and k and opened[k - 1]:
                stretches[-1] = (stretches[-1][0], known.end[k])
            elif o:
                stretches.append((known.start[k], known.end[k]))
        width = max(1, min(width // 2, sum(e - s for s, e in stretches) // cells))
        kept = [(s, e, w) for s, e, w, o in zip(known.start, known.end, known.whole, opened) if not o]
        known = Cells(sorted(kept + _read_cells(groups, width, stretches)))


def shard_documents(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null) for every row of documents.

    documents: doc_id, text; other columns are ignored, whatever their names. Size is the text's UTF-8 bytes plus 1; a
    null text counts as empty. Rows with equal texts stay together. Slots count a shard's rows in digest order from 0. A
    shard may stay empty where groups are few. Repeated rows get a slot each; an empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                            F.sha2(text, 256).alias("digest"))
    rows = settle(rows.withColumn("digest", F.unhex("digest"))
                  .withColumn("salt", F.coalesce(F.pmod(F.col("doc_id").cast("long"), F.lit(_SALTS)), F.lit(0)).cast("int")))
    part = rows.groupBy("digest", "salt").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("n_bytes"))
    parts = settle(part.withColumn("bucket", F.conv(F.hex(F.substring("digest", 1, 2)), 16, 10).cast("int") % 65536 / (65536 // _BUCKETS))
                   .withColumn("bucket", F.floor("bucket").cast("int")))
    sums = parts.groupBy("bucket").agg(F.sum("n_rows").alias("b_rows"), F.sum("n_bytes").alias("b_bytes"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # over _BUCKETS rows at most
    sums = sums.select("bucket", F.coalesce(F.sum("b_rows").over(before), F.lit(0)).alias("b_rows"),
                       F.coalesce(F.sum("b_bytes").over(before), F.lit(0)).alias("b_bytes"))
    inside = Window.partitionBy("bucket").orderBy("digest", "salt").rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy("bucket", "digest")
    placed = settle(parts.join(sums, "bucket")
                    .withColumn("row_start", F.col("b_rows") + F.coalesce(F.sum("n_rows").over(inside), F.lit(0)))
                    .withColumn("byte_start", F.col("b_bytes") + F.coalesce(F.sum("n_bytes").over(inside), F.lit(0)))
                    .withColumn("group_start", F.min("byte_start").over(group))
                    .withColumn("group_end", F.col("group_start") + F.sum("n_bytes").over(group))
                    .select("digest", "salt", "row_start", "byte_start", "group_start", "group_end"))
    groups = placed.where("byte_start = group_start").select("group_start", "group_end")
    total, largest = groups.agg(F.max("group_end"), F.max(F.col("group_end") - F.col("group_start"))).first()
    ends = [] if total is None else smallest_capacity(groups, shards, total, largest)[1]
    shard = F.lit(0)
    for e in ends[:-1]:
        shard += (F.col("group_start") >= e).cast("int")
    placed = placed.withColumn("shard", shard)
    first = settle(placed.groupBy("shard").agg(F.min("row_start").alias("first_row")))
    placed = placed.join(F.broadcast(first), "shard").select("digest", "salt", "shard", (F.col("row_start") - F.col("first_row")).alias("slot_start"))
    number = F.row_number().over(Window.partitionBy("digest", "salt").orderBy("doc_id")) - 1
    return (rows.withColumn("number", number).join(placed, ["digest", "salt"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                    (F.col("slot_start") + F.col("number")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
