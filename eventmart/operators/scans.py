"""Ordered work per key that never puts a hot key's rows into one task.

A key may hold a third of all rows, so rows are cut by (key, time chunk) at every size of the input: there is one plan, and
the chunk is a documented length. Two devices bring back what a chunk cannot see:

* `halo` — when a rule looks back or ahead by a bounded time, rows near a chunk's edge are also copied
  into the neighbour chunk. One shuffle, one sort, no join.
* `running_max` — when a rule looks back without bound, each chunk is first reduced to one row
  (map-side combined), the reduced rows are scanned per key, and the result is carried into the chunks.
  The scan over a key sees one row per chunk: its size is bounded by the calendar, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "_chunk"
OWN = "_own"
SECOND = 1_000_000
WHOLE = 0  # grain of a key that is not cut


def chunk_of(us: Column, grain_s: int) -> Column:
    return F.floor(us / F.lit(grain_s * SECOND)) if grain_s else F.lit(0).cast("bigint")


def chunked(df: DataFrame, us: str, grain_s: int) -> DataFrame:
    return df.withColumn(CHUNK, chunk_of(F.col(us), grain_s))


def halo(df: DataFrame, us: str, back_s: int = 0, ahead_s: int = 0, grain_s: int = WHOLE) -> DataFrame:
    """Put every row into its chunk and into the chunks whose rows may look at it.

    `back_s`: rows look back this far, so a row is also needed by chunks up to `back_s` later;
    `ahead_s`: rows look ahead this far. `_own` is true on the one copy that is the row itself;
    callers filter on it after the window.
    """
    if not grain_s:
        back_s = ahead_s = 0
    elif max(back_s, ahead_s) > grain_s:
        raise ValueError("a chunk must be at least as long as the time the rule looks across")
    t = F.col(us)
    if not back_s and not ahead_s:
        return df.withColumns({CHUNK: chunk_of(t, grain_s), OWN: F.lit(True)})
    first = chunk_of(t - ahead_s * SECOND, grain_s)
    last = chunk_of(t + back_s * SECOND, grain_s)
    return (df.withColumn(CHUNK, F.explode(F.sequence(first, last)))
              .withColumn(OWN, F.col(CHUNK) == chunk_of(t, grain_s)))


def own_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(OWN)).drop(OWN)


def local_window(keys: list[str], order: list) -> Window:
    return Window.partitionBy(*keys, CHUNK).orderBy(*order)


def so_far(window: Window) -> Window:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before(window: Window) -> Window:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def chunk_scan(keys: list[str]) -> Window:
    """Over the reduced rows only: everything in earlier chunks of the key."""
    return before(Window.partitionBy(*keys).orderBy(CHUNK))


def running_max(df: DataFrame, keys: list[str], order: list, values: dict[str, Column], grain_s: int) -> DataFrame:
    """Add, per key in `order`, the maximum of each value up to and including the row.

    `df` must carry `_chunk` of the grain, and `order` must start with the time the chunk was taken from.
    """
    window = so_far(local_window(keys, order))
    if not grain_s:
        return df.withColumns({n: F.max(v).over(window) for n, v in values.items()})
    totals = df.groupBy(*keys, CHUNK).agg(*[F.max(v).alias(f"_{n}") for n, v in values.items()])
    carried = totals.select(*keys, CHUNK, *[F.max(f"_{n}").over(chunk_scan(keys)).alias(f"_{n}") for n in values])
    return (df.withColumns({n: F.max(v).over(window) for n, v in values.items()})
              .join(carried, [*keys, CHUNK], "left")
              .withColumns({n: F.greatest(F.col(n), F.col(f"_{n}")) for n in values})
              .drop(*[f"_{n}" for n in values]))


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Left (or left semi) join of many rows to a table of one row per key, in a form the engine can rebalance.

    The tables come out of an aggregation on the same keys. Joining on the keys alone would reuse that
    aggregation's exchange, and adaptive execution only splits a hot key's rows when both inputs of the join
    have an exchange of their own. The extra join column costs one more exchange of the reduced side.
    """
    spread = F.xxhash64(*keys)
    return (rows.withColumn("_spread", spread)
                .join(table.withColumn("_spread", spread), ["_spread", *keys], how)
                .drop("_spread"))
