"""Identity domain: echo, the unified event log and daily login aggregates."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.scalars import null_string, typed_time
from eventmart.schemas import conform

# The log's type names and the time column each source topic carries.
UNIFIED_TYPES = {"LOGIN": "login_time", "SIGNUP": "signup_time", "SIGNOUT": "signout_time"}


def echo(logins: DataFrame) -> DataFrame:
    """Logins, column for column."""
    return conform(logins, "internal.identity.login.echo")


def unified_part(events: DataFrame, kind: str) -> DataFrame:
    """One identity topic in the shape of the log. Only logins keep device, agent and address."""
    time = F.col(UNIFIED_TYPES[kind])

    def device_field(name: str) -> Column:
        return F.col(name) if kind == "LOGIN" else null_string()

    return events.select(
        F.concat("user_id", F.lit("_"), time).alias("event_id"),
        time.alias("event_time"),
        F.lit(kind).alias("event_type"),
        "user_id",
        "email",
        *[device_field(n).alias(n) for n in ("device_id", "user_agent", "ip_address")],
    )


def unified_events(logins: DataFrame, signups: DataFrame, signouts: DataFrame) -> DataFrame:
    """One log of the three identity topics."""
    return (unified_part(logins, "LOGIN").unionByName(unified_part(signups, "SIGNUP"))
            .unionByName(unified_part(signouts, "SIGNOUT")))


def _login_ts(logins: DataFrame) -> Column:
    """The typed time written at ingest where there is one (prunes files), else the parsed wire time."""
    return F.col("login_ts") if "login_ts" in logins.columns else typed_time("login_time")


def on_date(df: DataFrame, ts: Column, dt: str) -> DataFrame:
    """Rows of one UTC day, as a range on the time itself so that the scan can skip files.

    A table partitioned by day (`event_date`) is also filtered by it, and only that partition is opened.
    """
    start = date.fromisoformat(dt)
    if "event_date" in df.columns:
        df = df.filter(F.col("event_date") == F.lit(start))
    kind = dict(df.select(ts.alias("t")).dtypes)["t"]
    bounds = [F.lit(d.isoformat()).cast(kind) for d in (start, start + timedelta(days=1))]
    return df.filter((ts >= bounds[0]) & (ts < bounds[1]))


def _signup_dates(signups: DataFrame, dedupe: bool) -> DataFrame:
    day = F.to_date(typed_time("signup_time"))
    if dedupe:
        signups, day = signups.groupBy("user_id").agg(F.min(day).alias("_day")), F.col("_day")
    return signups.select("user_id", F.date_format(day, "yyyy-MM-dd").alias("signup_date"))


def _aggregate_logins(logins: DataFrame, *keys) -> DataFrame:
    return logins.groupBy(*keys).agg(
        F.count("*").cast("int").alias("login_count"),
        F.min_by("email", F.struct(_login_ts(logins), "login_time")).alias("email"),
    )


def daily_login_aggregates(logins: DataFrame, signups: DataFrame, dt: str,
                           dedupe_signups: bool = True) -> DataFrame:
    """One row per user who logged in on `dt`: how often, and the day they signed up (null if never).

    Logins are reduced to one row per user before the join, so a busy user costs one row there.
    `dedupe_signups=False` joins every signup of a user, and then repeats the user's row.
    """
    daily = _aggregate_logins(on_date(logins, _login_ts(logins), dt), "user_id")
    return (daily.join(_signup_dates(signups, dedupe_signups), "user_id", "left")
                 .select("user_id", "login_count", "signup_date", "email", F.lit(dt).alias("dt")))


def login_aggregates_backfill(logins: DataFrame, signups: DataFrame) -> DataFrame:
    """The daily aggregate of every day at once, to rewrite many `dt` partitions in one job."""
    dt = F.date_format(F.to_date(_login_ts(logins)), "yyyy-MM-dd").alias("dt")
    return (_aggregate_logins(logins, "user_id", dt)
            .join(_signup_dates(signups, True), "user_id", "left")
            .select("user_id", "login_count", "signup_date", "email", "dt"))
