"""Runs a query and its reference SQL on the same tables and compares columns, rows, kinds and values."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402

_KINDS = {T.StringType: "text", T.LongType: "int64", T.IntegerType: "int32", T.DoubleType: "double",
          T.BooleanType: "bool"}
_SQL_KINDS = {"VARCHAR": "text", "BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "double", "BOOLEAN": "bool"}


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return "\0" if v is None else str(v)


def plan(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def compare(spark, con, name: str, folder: str, look=None) -> tuple[list[str], int, float, float]:
    """Differences found, row count, seconds in each engine. `look` gets the query's plan."""
    t0 = time.time()
    df = entry.queries()[name](spark, folder)
    if look is not None:
        look(plan(df))
    kinds = {f.name: _KINDS.get(type(f.dataType), str(f.dataType)) for f in df.schema}
    mine = [r.asDict() for r in df.collect()]
    t1 = time.time()
    rel = con.sql(entry.oracle_sql()[name])
    theirs = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    t2 = time.time()
    problems = []
    if sorted(kinds) != sorted(rel.columns):
        return [f"columns {sorted(kinds)} / {sorted(rel.columns)}"], len(mine), t1 - t0, t2 - t1
    for c, t in zip(rel.columns, rel.types):
        kind = _SQL_KINDS.get(str(t), str(t))
        if kind != kinds[c] and str(t) != '"NULL"':
            problems.append(f"kind of {c}: {kinds[c]} / {t}")
    cols = sorted(kinds)
    a = sorted(tuple(_cell(r[c]) for c in cols) for r in mine)
    b = sorted(tuple(_cell(r[c]) for c in cols) for r in theirs)
    if len(a) != len(b):
        problems.append(f"rows {len(a)} / {len(b)}")
    if a != b:
        sa, sb = set(a), set(b)
        problems.append(f"values differ, e.g. {cols}: {sorted(sa - sb)[:2]} / {sorted(sb - sa)[:2]}")
    return problems, len(a), t1 - t0, t2 - t1


def main() -> None:
    from pyspark.sql import SparkSession
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(entry.queries())
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    print("without SQL:", sorted(set(entry.queries()) - set(entry.oracle_sql())))
    for name in names:
        try:
            problems, rows, s, d = compare(spark, con, name, folder)
        except Exception as e:  # noqa: BLE001 - a report over all queries
            problems, rows, s, d = [f"{type(e).__name__}: {str(e)[:600]}"], 0, 0, 0
        bad += bool(problems)
        print(f"{'BAD ' if problems else 'ok  '}{name}: {rows} rows, {s:.2f}s / {d:.2f}s", *problems, sep="\n      " if problems else "")
    print("bad:", bad, "of", len(names))


if __name__ == "__main__":
    main()
