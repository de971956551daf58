"""Masking of tagged columns and contract checks before a table is published."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.schemas import TOPICS


# The types a written field may be read as, besides its own.
PROMOTIONS = {
    "int": ("bigint", "float", "double"),
    "bigint": ("float", "double"),
    "float": ("double",),
    "string": ("binary",),
    "binary": ("string",),
}


def mask_columns(df: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """Columns tagged `pii` as SHA-256 text; equal values stay equal, nulls stay null."""
    return df.withColumns({c: F.sha2(F.col(c).cast("string"), 256) for c, tag in tags.items()
                           if tag == "pii" and c in df.columns})


def contract_violations(df: DataFrame, topic: str, rules: Mapping[str, Column] | None = None,
                        key: list[str] | None = None) -> DataFrame:
    """One row per broken rule and input row: (rule, key columns). Non-null columns of the topic are rules by themselves."""
    checks = {f"{f.name} is null": F.col(f.name).isNotNull() for f in TOPICS[topic] if not f.nullable}
    checks.update(rules or {})
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name))
                                       for name, ok in checks.items()]))
    return df.select(F.explode(broken).alias("rule"), *(key or []))


def violation_counts(violations: DataFrame) -> DataFrame:
    return violations.groupBy("rule").agg(F.count("*").alias("n"))


def schema_changes(written: T.StructType, reading: T.StructType, defaults: Mapping[str, Column] | None = None,
                   tags: Mapping[str, str] | None = None) -> list[tuple[str, str, bool]]:
    """(field, change, breaking) of each field in which rows of the written schema differ from the one they are read with.

    Fields go by name, in any order. Breaking are a type that is not promoted, a required field that was not written and has no
    default, and a new field without a tag where `tags` are given (data that nobody has looked at may be personal). Nested
    types are equal or breaking. Dropped, defaulted and promoted fields and nulls where none are read do not break: rows that
    hold such a null are rejected one by one.
    """
    old, new = ({f.name: f for f in schema} for schema in (written, reading))
    out = []
    for name, field in new.items():
        if name not in old:
            filled = "default" if name in (defaults or {}) else "null" if field.nullable else "missing"
            out.append((name, f"new: {filled}", filled == "missing"))
            if tags is not None and name not in tags:
                out.append((name, "new: no tag", True))
            continue
        was, now = old[name].dataType.simpleString(), field.dataType.simpleString()
        if was != now:
            fits = now in PROMOTIONS.get(was, ())
            out.append((name, f"{was} as {now}" if fits else f"{was} is no {now}", not fits))
        if old[name].nullable and not field.nullable:
            out.append((name, "nulls are rejected", False))
    return out + [(name, "dropped", False) for name in old if name not in new]


def resolve_payloads(rows: DataFrame, payload: str, version: str, schemas: Mapping[int, T.StructType], reading: T.StructType,
                     defaults: Mapping[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """JSON payloads of several schema versions read with one schema, and the rows that cannot be.

    The first result has the rows' other columns and the fields read. The second has the rows as they are, with `reason`: the
    version is unknown (or null), its schema breaks (see `schema_changes`), the payload is not an object, or a required
    field is null. Every row is in exactly one of them; a name that is both a column and a field read is an error. All
    versions are read in one pass.
    """
    clash = sorted({f.name for f in reading} & ({*rows.columns} - {payload}))
    if clash:
        raise ValueError(f"columns and fields share names: {', '.join(clash)}")
    defaults = defaults or {}
    read, broken = F.lit(None).cast(T.StructType([T.StructField(f.name, f.dataType) for f in reading])), F.lit("unknown version")
    for number, written in schemas.items():
        here = F.col(version) == number
        breaking = [f"{name}: {change}" for name, change, breaks in schema_changes(written, reading, defaults) if breaks]
        broken = F.when(here, F.lit("; ".join(breaking) if breaking else None).cast("string")).otherwise(broken)
        if not breaking:
            parsed = F.from_json(F.col(payload), written)
            fields = F.struct(*[(parsed[f.name] if f.name in written.names else defaults.get(f.name, F.lit(None)))
                                .cast(f.dataType).alias(f.name) for f in reading])
            read = F.when(here & parsed.isNotNull() & F.ltrim(payload).startswith("{"), fields).otherwise(read)
    judged = rows.withColumns({"_read": read, "_broken": broken})
    lacking = [F.when(F.col("_read")[f.name].isNull(), F.lit(f"{f.name} is null")) for f in reading if not f.nullable]
    reason = F.coalesce("_broken", F.when(F.col("_read").isNull(), F.lit("not an object")), *lacking)
    judged = judged.withColumn("reason", reason)
    kept = [c for c in rows.columns if c != payload]
    resolved = judged.where("reason is null").select(*kept, *[F.col("_read")[f.name].alias(f.name) for f in reading])
    return resolved, judged.where("reason is not null").select(*rows.columns, "reason")
