"""URL filter rules by a sort-merge range join. Built-in functions only.

1. A rule (host, path) becomes a prefix of canonical keys: the host's labels in reverse, each closed by a dot, then the
   path. A rule covers the interval of keys that start with its prefix, and such intervals are nested or disjoint. A
   page has a key for its host and one for each parent domain, since a rule also holds for subdomains.
2. Page keys are dealt out by ranges of the key, so a host with any share of the pages, and even a URL that repeats, is
   spread over tasks. Rules go to the ranges that their intervals meet.
3. In each range, interval starts, interval ends and page keys are sorted together. A sweep carries the stack of rules
   that are active: a start puts its rule on top of the rules around it, an end leaves those around it.
4. Of a page's keys, the rule with the longest host and path wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.llm.tables import settle

# The rules of the contract.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
DEFAULT = "allow"  # for pages that no rule fits
_BEGIN, _END, _PAGE = 1, 0, 2  # order of events at the same key: ends, starts, pages


def rule_table(spark: SparkSession, rules=None) -> DataFrame:
    return spark.createDataFrame(RULES if rules is None else rules, "host string, path string, verdict string")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: str) -> tuple[Column, Column]:
    """Host and path of a URL column; both empty without `://`."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.col(url).substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*(/[^?#]*)", 1)
    return ascii_lower(host), path


def _key(labels: Column, path: Column) -> Column:
    """Labels from the last to the first, each with a dot, and the path."""
    return F.concat(F.concat_ws("", F.transform(F.reverse(labels), lambda x: F.concat(x, F.lit(".")))), path)


def _after(prefix: Column) -> Column:
    """A key that sorts behind all keys that start with the prefix: U+10FFFF is the last character there is."""
    return F.concat(prefix, F.lit("\U0010ffff"))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """rule number independent rows: low, high, stack - the rules around and including it, innermost first."""
    host = ascii_lower(F.coalesce("host", F.lit("")))
    path = F.coalesce("path", F.lit(""))
    keyed = (rules.select(host.alias("host"), path.alias("path"), "verdict")
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # of equal rules, "block" beats "allow"
             .withColumn("low", _key(F.split("host", r"\."), F.col("path"))))
    size = F.length("low")
    prefixes = keyed.select("low", F.explode(F.transform(F.sequence(F.lit(0), size), lambda k: F.substring(F.col("low"), F.lit(1), k))).alias("outer"))
    outer = keyed.select(F.col("low").alias("outer"), F.struct(
        (F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
        F.concat("host", "path").alias("rule"), "verdict", F.length("low").alias("depth")).alias("entry"))
    stack = (prefixes.join(outer, "outer").groupBy("low")
             .agg(F.reverse(F.array_sort(F.collect_list(F.struct("entry.depth", "entry")))).alias("stack")))
    return stack.select("low", _after(F.col("low")).alias("high"), F.transform("stack", lambda s: s["entry"]).alias("stack"))


def judge(pages: DataFrame, rules: DataFrame | None = None, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of pages (page_id, url; other columns are ignored).

    A null url, or one without `://`, has an empty host and path; only a rule with an empty host can fit it. A page that no
    rule fits has a null rule and the default verdict. Ties between rules of the same length go to the longer host.
    Repeated rows get a row each; an empty table of pages gives no rows, and without rules all get the default.
    """
    spark = pages.sparkSession
    rules = rule_table(spark) if rules is None else rules
    host, path = url_parts("url")
    rows = settle(pages.select("page_id", host.alias("host"), path.alias("path"))
                  .withColumn("row", F.monotonically_increasing_id()))
    labels = F.split("host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.slice(labels, k, F.size(labels)))
    keys = rows.select("row", F.explode(F.transform(tails, lambda t: _key(t, F.col("path")))).alias("key"))
    # the ranges: sampled by Spark, then kept, so that a lost executor cannot move a border
    dealt = settle(keys.repartitionByRange("key", "row").withColumn("range", F.spark_partition_id()))
    borders = [r[0] for r in dealt.groupBy("range").agg(F.min("key").alias("first")).sort("range").select("first").collect()]
    if not borders:
        return _result(rows.withColumn("entry", F.lit(None).cast("struct<size:int,host_size:int,rule:string,verdict:string,depth:int>")), default)
    numbers = [r[0] for r in dealt.select("range").distinct().sort("range").collect()]
    first = F.lit(borders[1:]).cast("array<string>") if len(borders) > 1 else F.array().cast("array<string>")
    before = lambda key: F.size(F.filter(first, lambda b: b < key))
    upto = lambda key: F.size(F.filter(first, lambda b: b <= key))
    stacks = rule_stacks(rules)
    ordinal = F.create_map(*[F.lit(x) for pair in zip(numbers, range(len(numbers))) for x in pair])
    # a key that repeats may fill many ranges, all but the first of them with it as their border: an interval goes to each
    # range from the first that can hold its low key
    spread = stacks.withColumn("part", F.explode(F.sequence(before(F.col("low")), upto(F.col("high")))))
    starts = spread.select("part", F.col("low").alias("key"), F.lit(_BEGIN).alias("kind"), F.size("stack").alias("depth"), "stack")
    ends = spread.select("part", F.col("high").alias("key"), F.lit(_END).alias("kind"), (-F.size("stack")).alias("depth"),
                         F.slice("stack", 2, F.size("stack")).alias("stack"))
    asked = dealt.select(ordinal[F.col("range")].alias("part"), "key", F.lit(_PAGE).alias("kind"), F.lit(0).alias("depth"),
                         F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"), "row")
    events = starts.unionByName(ends).withColumn("row", F.lit(None).cast("long")).unionByName(asked)
    sweep = Window.partitionBy("part").orderBy("key", "kind", "depth").rowsBetween(Window.unboundedPreceding, 0)
    active = events.withColumn("active", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 2")
    best = (active.where(F.size("active") > 0)
            .select("row", F.explode("active").alias("entry"))
            .groupBy("row").agg(F.max("entry").alias("entry")))
    return _result(rows.join(best, "row", "left"), default)


def _result(rows: DataFrame, default: str) -> DataFrame:
    return rows.select("page_id", "host", "path", F.col("entry.rule").alias("rule"),
                       F.coalesce("entry.verdict", F.lit(default)).alias("verdict"))
