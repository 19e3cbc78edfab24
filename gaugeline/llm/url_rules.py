"""URL rules as a sort-merge range join, DataFrame functions only.

Written with its labels reversed, a host is a prefix of all its subdomains, so a rule is an
interval of sorted keys, and intervals are nested or apart. One sorted sweep over the ends of the
intervals and the keys to be judged keeps the stack of intervals that are open: the running sum of
openings and closings is its height, and the entry at a height is the last one opened there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes that no UTF-8 text has: after every key that a prefix has, and between host and path.
_AFTER, _BETWEEN = b"\xff", b"\xfe"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def _host_key(host: Column) -> Column:
    """Labels from the last to the first, each followed by a dot; bytes, which sort by code point."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")).cast("binary")


def open_intervals(points: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(key, stack): for each distinct binary ``key`` of ``points`` all ``prefix`` values of
    ``prefixes`` that it begins with, shortest first. Keys that have none are left out.

    Events are range-partitioned, so a partition is a stretch of the sorted order of bounded size;
    what was open at its beginning comes from one row per partition before it.
    """
    events = (
        points.select("key", F.lit(1).alias("kind"), F.lit(0).alias("step")).distinct()
        .unionByName(prefixes.select(F.col("prefix").alias("key"), F.lit(0).alias("kind"), F.lit(1).alias("step")).distinct())
        .unionByName(
            prefixes.select(F.concat("prefix", F.lit(_AFTER)).alias("key"), F.lit(2).alias("kind"), F.lit(-1).alias("step")).distinct()
        )
    )
    swept = written(events.repartitionByRange("key", "kind").withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = swept.groupBy("part").agg(F.sum("step").alias("net"))
    heights = parts.select("part", F.coalesce(F.sum("net").over(before), F.lit(0)).alias("open"))
    order = Window.partitionBy("part").orderBy("key", "kind")
    levelled = swept.join(F.broadcast(heights), "part").withColumn("height", F.col("open") + F.sum("step").over(order))
    deepest = levelled.where("kind = 0").agg(F.max("height")).first()[0] or 0
    if not deepest:
        return levelled.where("false").select("key", F.array("key").alias("stack"))
    opened = {f"at{j}": F.when((F.col("kind") == 0) & (F.col("height") == j), F.col("key")) for j in range(1, deepest + 1)}
    shown = {f"at{j}": F.last(f"at{j}", ignorenulls=True).over(order) for j in range(1, deepest + 1)}
    marked = levelled.withColumns(opened)
    # What was opened last at a height is the greatest key opened there.
    lasts = marked.groupBy("part").agg(*[F.max(c).alias(c) for c in opened])
    carried = lasts.select("part", *[F.last(c, ignorenulls=True).over(before).alias(f"from_{c}") for c in opened])
    stack = F.slice(F.array(*[F.coalesce(c, f"from_{c}") for c in opened]), F.lit(1), F.col("height").cast("int"))
    return (
        marked.withColumns(shown).where("kind = 1 and height > 0")
        .join(F.broadcast(carried), "part")
        .select("key", stack.alias("stack"))
    )


def judge(
    pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """page_id, host, path, rule, verdict of each row of ``pages``.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains, if the path of
    the url begins with the rule's. The longest fitting rule wins, by characters of host and path
    together, then by those of the host; without one the verdict is ``default`` and the rule null. Of rules with the same host and path,
    ``block`` wins. Null host or path of a rule count as empty, an empty host fits all; a rule
    with a null verdict is left out. A null url, or one without ``://``, has empty host and path.
    Repeated rows are judged each; no rules: all default; no pages: no rows.
    """
    listed = rules.where("verdict is not null").select(
        F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER).alias("rule_host"),
        F.coalesce("path", F.lit("")).alias("rule_path"),
        "verdict",
    )
    known = listed.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict")).withColumns({
        "prefix": F.when(F.col("rule_host") == "", F.lit(b"")).otherwise(_host_key(F.col("rule_host"))),
        "rule": F.concat("rule_host", "rule_path"),
    }).withColumn("rule_key", F.concat("prefix", F.lit(_BETWEEN), F.col("rule_path").cast("binary")))
    seen = pages.select(
        F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    )
    targets = seen.select("host", "path").distinct().withColumn("key", _host_key(F.col("host")))
    hosts = open_intervals(targets.select("key"), known.select("prefix"))
    asked = targets.join(hosts, "key").select("host", "path", F.explode("stack").alias("prefix"))
    asked = asked.withColumn("key", F.concat("prefix", F.lit(_BETWEEN), F.col("path").cast("binary")))
    paths = open_intervals(asked.select("key"), known.select(F.col("rule_key").alias("prefix")))
    innermost = paths.select("key", F.element_at("stack", -1).alias("rule_key"))
    fitting = asked.join(innermost, "key").join(known.select("rule_key", "rule", "verdict", "rule_host"), "rule_key")
    longest = F.struct(F.length("rule"), F.length("rule_host"))
    best = fitting.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), longest).alias("best"))
    return seen.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
