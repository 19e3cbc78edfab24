"""JSON batch files, one message per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_PLACE = ["file", "block", "row"]


def read_json_batch(spark: SparkSession, path: str | list[str], array: bool) -> DataFrame:
    """Messages of JSON files as text in column ``value``, ready for ``conform``.

    ``array=True``: each file is one JSON array, of any size: it is read in splits, by many tasks.
    ``array=False``: each line is one object. The wrong flag raises, as does an array that is torn or
    followed by something; no rows are dropped. What stands between the objects of an array, such as
    numbers, is passed on as a message, for ``conform`` to reject. An empty file has no messages.
    """
    if array:
        return _elements(spark, path)

    lines = spark.read.text(path)
    text = F.btrim("value", F.lit(" \t\r\n"))
    checked = F.when(
        F.startswith(text, F.lit("[")), _fail("line starts a JSON array; read it with array=True")
    ).otherwise(F.col("value"))
    return lines.filter(text != "").select(checked.alias("value"))


def _fail(message: str | Column) -> Column:
    return F.raise_error(F.lit(message) if isinstance(message, str) else message)


def _with_sums(rows: DataFrame, **sums: Column) -> DataFrame:
    """``rows`` with the sums of some columns over all rows of the file before each.

    A split of a file is one window group; what came in earlier splits is one row a split.
    """
    rows = rows.withColumns({f"_{name}": value for name, value in sums.items()})
    totals = rows.groupBy("file", "block").agg(*[F.sum(f"_{n}").alias(n) for n in sums])
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("file", "block", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_from_{n}") for n in sums])
    own = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumns({f"_to_{n}": F.coalesce(F.sum(f"_{n}").over(own), F.lit(0)) for n in sums})
    joined = local.join(offsets, ["file", "block"])
    return joined.select(*[c for c in rows.columns if c[1:] not in sums], *[(F.col(f"_from_{n}") + F.col(f"_to_{n}")).alias(n) for n in sums])


def _count(text: Column, sign: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))).cast("long")


def _elements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The objects of array files.

    A file is cut after each closing brace, wherever its splits lie. A brace ends an element if it is
    outside of strings, which the number of quotes before it tells, and closes what was opened. Pieces
    of an element that has inner objects, or braces in its texts, are put together again.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), "value",
    )
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    quoted = _with_sums(pieces.withColumn("bare", bare), quotes=_count(F.col("bare"), '"'), pieces=F.lit(1).cast("long"))
    inside, ends_inside = F.col("quotes") % 2 == 1, (F.col("quotes") + _count(F.col("bare"), '"')) % 2 == 1
    outside = F.regexp_replace(F.concat(F.when(inside, F.lit('"')).otherwise(F.lit("")), "bare"), '"[^"]*("|$)', "")
    known = quoted.select(*_PLACE, "value", "pieces", inside.alias("inside"), ends_inside.alias("ends_inside"), outside.alias("outside"))
    known = known.withColumn("opened", _count(F.col("outside"), "{"))
    depth = F.col("opened") - F.when(F.col("ends_inside"), 0).otherwise(1)
    nested = _with_sums(known.withColumn("step", depth), depth=F.col("step"))
    begins = ~F.col("inside") & (F.col("depth") == 0)
    ends = ~F.col("ends_inside") & (F.col("depth") + F.col("step") == 0)
    marked = nested.withColumns({"begins": begins, "ends": ends})

    # The last piece of a file is what follows the last brace.
    whole = marked.groupBy("file").agg(F.count(F.lit(1)).alias("of_file"))
    marked = marked.join(whole, "file").withColumn("is_last", F.col("pieces") + 1 == F.col("of_file"))
    lead = F.when(F.col("is_last"), F.col("value")).otherwise(F.substring_index("value", "{", 1))
    lead = F.when(F.col("begins"), F.regexp_replace(lead, r"^\s+|\s+$", ""))
    marked = marked.withColumn("lead", lead).withColumn("is_first", F.col("pieces") == 0)
    opening = F.when(F.col("is_first"), F.lit("[")).otherwise(F.lit(","))
    closed = F.col("lead").rlike(r"(?s)^\[.*\]$") | (~F.col("is_first") & F.col("lead").rlike(r"(?s)^(,.*)?\]$"))
    sound = F.when(F.col("is_last"), F.col("begins") & closed).when(F.col("begins"), F.startswith("lead", opening)).otherwise(F.lit(True))
    what = F.when(F.col("is_first") & ~F.startswith("lead", F.lit("[")), "file is not a JSON array: ").otherwise("file is not a well-formed JSON array: ")
    checked = marked.withColumn("value", F.when(F.coalesce(sound, F.lit(False)), F.col("value")).otherwise(_fail(F.concat(what, "file"))))

    # Anything but an object, between the commas and brackets.
    between = F.regexp_replace("lead", r"(?s)^[\[,]?\s*(.*?)\s*[\],]?$", "$1")
    others = checked.filter("begins OR is_last").select(F.when(F.col("value").isNotNull(), between).alias("value")).filter("value != ''")

    body = F.when(F.col("begins"), F.concat(F.lit("{"), F.substr("value", F.locate("{", F.col("value")) + 1))).otherwise(F.col("value"))
    text = checked.filter("NOT is_last").select(*_PLACE, "begins", "ends", F.concat(body, F.lit("}")).alias("value"))
    single = text.filter("begins AND ends").select("value")
    parts = _with_sums(text.filter("NOT (begins AND ends)"), elements=F.col("ends").cast("long"))
    joined = parts.groupBy("file", "elements").agg(F.array_sort(F.collect_list(F.struct("block", "row", "value"))).alias("parts"))
    return single.unionByName(joined.select(F.array_join("parts.value", "").alias("value"))).unionByName(others)
