"""URL filters that follow dated lists, with DataFrame functions only.

A list is a history: from a day on, a key (a host, a parent domain, or a host with a path) is blocked, allowed, or no
longer listed. Histories become validity intervals, unchanged entries merged. A capture looks up all its keys - the
host, its parents, its path prefixes - among the intervals that were valid on the day of its fetch; the longest key
decides, and block beats allow on one key.

The as-of join is an equality join: intervals are cut into periods of ``PERIOD`` days up to the last fetch, captures
know their period. Captures are reduced to distinct (url, day) pairs first, so a page fetched again and again is
looked up once; a host that owns a third of all captures is spread by url and day in the last joins and split by the
adaptive skew join in the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from readframe.llm.common import fresh, stored

PERIOD = 64
BROADCAST_ROWS = 100_000
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PATH = r"^[^:]+://[^/?#]*([^?#]*)"


def keys(url: Column) -> Column:
    """The keys that can match a URL: parent domains, host, and host with each path prefix; none for other text."""
    host = F.lower(F.regexp_extract(url, HOST, 1))
    labels = F.array_remove(F.split(host, "[.]"), "")
    parts = F.array_remove(F.split(F.regexp_extract(url, PATH, 1), "/"), "")
    domains = F.transform(labels, lambda x, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    paths = F.transform(parts, lambda x, i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i + 1), "/")))
    return F.when(host != "", F.array_distinct(F.concat(domains, paths))).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """``list, key, verdict, since, until`` from ``list, key, verdict, day``; a null verdict ends a listing.

    Of several entries of a list and key on one day, block comes before allow and allow before the end. An interval
    ends the day before ``until``; the last one has a null ``until``. Null keys and days are left out.
    """
    rows = entries.dropna(subset=["list", "key", "day"])
    order = F.when(F.col("verdict") == "block", 2).when(F.col("verdict") == "allow", 1).otherwise(0)
    daily = rows.groupBy("list", "key", "day").agg(F.max_by("verdict", order).alias("verdict"))
    along = Window.partitionBy("list", "key").orderBy("day")
    changed = daily.withColumn("prior", F.lag("verdict").over(along)).filter(~F.col("verdict").eqNullSafe(F.col("prior")))
    spans = changed.withColumn("until", F.lead("day").over(along)).withColumnRenamed("day", "since")
    return spans.filter("verdict IN ('block', 'allow')").select("list", "key", "verdict", "since", "until")


def evaluate(captures: DataFrame, entries: DataFrame, url_col: str = "url", day_col: str = "day") -> DataFrame:
    """``captures`` with ``_verdict`` (block, allow or none), ``_key`` and ``_list`` (null for none).

    Where ``captures`` has columns of these names, the new ones get one more underscore.

    Every row stays, repeated ones included; a null url or day is ``none``. Days are whole numbers. Of lists that give
    the same verdict on the same key, the first by name is reported.
    """
    looked = captures.select(F.col(url_col).alias("_url"), F.col(day_col).cast("bigint").alias("_day")).dropna().distinct()
    looked = stored(looked, "looked")
    last = looked.agg(F.max("_day")).first()[0]
    spans = intervals(entries.select("list", "key", F.col("verdict"), F.col("day").cast("bigint").alias("day")))
    period = lambda day: F.floor(day / F.lit(PERIOD)).cast("bigint")
    until = F.least(F.coalesce(F.col("until") - 1, F.lit(last)), F.lit(last)).cast("bigint")
    cut = spans.filter(F.col("since") <= F.lit(last)).withColumn("_period", F.explode(F.sequence(period(F.col("since")), period(until))))
    cut = stored(cut, "intervals")
    asked = looked.withColumn("key", F.explode(keys(F.col("_url")))).withColumn("_period", period(F.col("_day")))
    small = cut.count() <= BROADCAST_ROWS
    valid = asked.join(F.broadcast(cut) if small else cut, ["key", "_period"]).filter(
        "since <= _day AND (until IS NULL OR _day < until)"
    )
    # The longest key, block before allow; then the first list by name.
    rank = F.struct(F.length("key"), "key", F.col("verdict") == "block")
    found = valid.groupBy("_url", "_day", "key", "verdict").agg(F.min("list").alias("list"))
    found = found.groupBy("_url", "_day").agg(F.max_by(F.struct("verdict", "key", "list"), rank).alias("_f"))
    # The row in one column, so that no name of it meets another.
    rows = captures.select(F.struct("*").alias("row"), F.col(url_col).alias("_url"), F.col(day_col).cast("bigint").alias("_day"))
    told = rows.join(found, ["_url", "_day"], "left")
    names = {n: fresh(captures, n) for n in ("_verdict", "_key", "_list")}
    return told.select(
        "row.*",
        F.coalesce("_f.verdict", F.lit("none")).alias(names["_verdict"]),
        F.col("_f.key").alias(names["_key"]),
        F.col("_f.list").alias(names["_list"]),
    )
