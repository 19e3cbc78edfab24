"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import SparkRuntimeException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline import operators as ops
from gaugeline.functions import MEASURES, time_range, with_avg
from gaugeline.plans import catalog, gates, raw, rollups, watermark
from gaugeline.plans import dimension as dims
from gaugeline.plans.ingest import ingest_all, ingest_increment, load_json
from gaugeline.operators.rollup import STREAM_KEYS
from gaugeline.plans.rollups import Rollup
from gaugeline.schemas import READING_COLS, WATERMARK_FLOOR
from gaugeline.session import configure, create_lake, shared_root, unique
from gaugeline.sources.conform import parse
from gaugeline.sources import conform, read_day, read_increment, read_json_batch, read_stream
from gaugeline.streaming import (
    History,
    StreamJob,
    compact_stream_rollup,
    create_quarantine,
    rollup_batches,
    stream_dim,
    stream_raw,
    stream_rollup,
    stream_rollup_bounded,
)

from . import views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

DAY = "2024-01-05"
DIGITS = {"value_sum": 4, "value_avg": 10, "avg_per_reading": 10}
NOW = "2024-01-30 23:30:00"
AT_ONCE = {"availableNow": True}


def query(fn: Query) -> Query:
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(fn(configure(spark), sf_dir))

    QUERIES[fn.__name__] = configured
    return configured


def shown(df: DataFrame) -> DataFrame:
    """Zone-less times, and sums rounded: their last digits depend on the order of addition."""

    def one(f: T.StructField):
        if isinstance(f.dataType, T.TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        return F.round(f.name, DIGITS[f.name]).alias(f.name) if f.name in DIGITS else F.col(f.name)

    return df.select(*[one(f) for f in df.schema.fields])


def stale(readings: DataFrame) -> DataFrame:
    """What an earlier load had: the same readings with other values."""
    return readings.withColumn("value", F.col("value") * 2)


def raw_table(spark: SparkSession, rows: DataFrame | None = None, label: str = "first", buckets: int = 0) -> str:
    table = f"{create_lake(spark)}.raw"
    raw.create_raw(spark, table, buckets)
    if rows is not None:
        raw.load_batch(spark, table, rows, label)
    return table


def rows_of(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).select(*READING_COLS)


def quarantine(spark: SparkSession, table: str) -> str:
    create_quarantine(spark, f"{table}_bad")
    return f"{table}_bad"


def budget(spark: SparkSession, sf_dir: str) -> int:
    """As many malformed messages as there are."""
    return conform(views.messages(spark, sf_dir))[1].count()


# --- sources -----------------------------------------------------------------------------------


@query
def increment_after_watermark(spark, sf_dir):
    return read_increment(views.readings(spark, sf_dir), "2024-01-11 00:00:00").rows


@query
def increment_ties(spark, sf_dir):
    """A source with heavy ties, read to its end in increments of about a third."""
    src = views.line_readings(spark, sf_dir)
    limit = -(-src.count() // 3)
    low, parts = WATERMARK_FLOOR, []
    while (step := read_increment(src, low, limit)).high is not None:
        parts.append(step.rows.withColumn("batch", F.lit(len(parts) + 1)))
        low = step.high
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def day_slice(spark, sf_dir):
    return read_day(views.readings(spark, sf_dir), DAY)


@query
def json_conform(spark, sf_dir):
    good, _ = conform(views.messages(spark, sf_dir))
    return good.select(*READING_COLS)


@query
def json_rejects(spark, sf_dir):
    _, bad = conform(views.messages(spark, sf_dir))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def json_batch_lines(spark, sf_dir):
    folder = f"{shared_root(spark)}/{unique('json_')}"
    views.messages(spark, sf_dir).select("value").write.text(folder)
    good, _ = conform(read_json_batch(spark, folder, array=False))
    return good.select(*READING_COLS)


@query
def json_load(spark, sf_dir):
    """Batch files loaded, then the same messages sent again in other files."""
    folder = f"{shared_root(spark)}/{unique('json_')}"
    sent = views.messages(spark, sf_dir).select("value")
    sent.write.text(f"{folder}/a")
    sent.repartition("value").write.text(f"{folder}/b")
    table = raw_table(spark)
    for part in ("a", "b"):
        load_json(spark, table, f"{folder}/{part}", False, "json", budget(spark, sf_dir), quarantine(spark, table))
    return rows_of(spark, table)


@query
def json_resend_after_compact(spark, sf_dir):
    """The same messages again, after the days they went to were compacted."""
    folder = f"{shared_root(spark)}/{unique('json_')}"
    views.messages(spark, sf_dir).select("value").write.text(folder)
    table = raw_table(spark, views.readings(spark, sf_dir).filter("event_time < '2024-01-02'"))
    spent = budget(spark, sf_dir), quarantine(spark, table)
    for _ in range(2):
        load_json(spark, table, folder, False, "json", *spent)
        raw.compact(spark, table, "2024-01-01", "2024-02-01")
    return rows_of(spark, table)


@query
def json_batch_array(spark, sf_dir):
    """Files that are one JSON array each, as many as there are thousands of messages; instead of a message cut
    off, which would break its array, stands a number."""
    folder = f"{shared_root(spark)}/{unique('json_')}"
    sent = views.messages(spark, sf_dir)
    element = F.when(F.col("value").endswith("}"), F.col("value")).otherwise(F.col("event_id").cast("string"))
    arrays = sent.groupBy(F.expr("event_id DIV 1000")).agg(F.concat_ws(",\n", F.collect_list(element)).alias("all"))
    whole = arrays.select(F.concat(F.lit("["), "all", F.lit("]")).alias("value"))
    whole.write.option("maxRecordsPerFile", 1).text(folder)
    good, _ = conform(read_json_batch(spark, folder, array=True))
    return good.select(*READING_COLS)


# --- loads and table maintenance ---------------------------------------------------------------


@query
def increment_resume_no_dup(spark, sf_dir):
    """A load whose watermark was lost in a crash, retried after the source has grown."""
    src = views.readings(spark, sf_dir)
    table = raw_table(spark)
    control = f"{table}_control"
    watermark.create_control(spark, control)
    early = time_range(src, end="2024-01-10")
    ingest_increment(spark, early, table, control, "readings", limit=None)
    watermark.set_watermark(spark, control, "readings", WATERMARK_FLOOR)
    ingest_all(spark, src, table, control, "readings", limit=-(-src.count() // 2))
    return rows_of(spark, table)


@query
def load_resend_fails(spark, sf_dir):
    """A load, and the same label again with a row that breaks the schema: nothing has changed."""
    src = views.readings(spark, sf_dir)
    table = raw_table(spark, src)
    torn = src.withColumn("device_id", F.when(F.col("event_time") < "2024-01-20", F.col("device_id")))
    try:
        raw.load_batch(spark, table, torn, "first")
    except SparkRuntimeException as error:
        if "device_id missing" not in str(error):
            raise
    return rows_of(spark, table)


@query
def watermark_advance(spark, sf_dir):
    src = views.readings(spark, sf_dir)
    table = raw_table(spark)
    control = f"{table}_control"
    watermark.create_control(spark, control)
    ingest_all(spark, src, table, control, "readings", limit=-(-src.count() // 2))
    ingest_all(spark, time_range(src, end=DAY), table, control, "other.job", limit=None)
    return spark.table(control).select("job_key", "watermark")


@query
def backfill_replaces_day(spark, sf_dir):
    src = views.readings(spark, sf_dir)
    table = raw_table(spark, stale(src))
    raw.overwrite_day(spark, table, read_day(src, DAY), DAY)
    return rows_of(spark, table)


@query
def backfill_empty_day(spark, sf_dir):
    src = views.readings(spark, sf_dir)
    table = raw_table(spark, src)
    raw.overwrite_day(spark, table, src.filter(F.lit(False)), DAY)
    return rows_of(spark, table)


@query
def backfill_range(spark, sf_dir):
    src = views.readings(spark, sf_dir)
    table = raw_table(spark, stale(src))
    raw.backfill(spark, table, src, "2024-01-10", "2024-01-20", upto="2024-01-18 12:00:00")
    return rows_of(spark, table)


@query
def day_swap(spark, sf_dir):
    src = views.readings(spark, sf_dir)
    table = raw_table(spark)
    raw.backfill(spark, table, stale(src), "2024-01-01", "2024-02-01")
    raw.swap_day(spark, table, read_day(src, DAY), DAY)
    return rows_of(spark, table)


@query
def retention(spark, sf_dir):
    table = raw_table(spark, views.readings(spark, sf_dir))
    raw.expire(spark, table, as_of="2024-04-10")
    return rows_of(spark, table)


@query
def rollup_retention(spark, sf_dir):
    """Minute partials of the newest days, by the catalog alone."""
    spec = Rollup(f"{create_lake(spark)}.agg_minute", "minute")
    rollups.create_agg(spark, spec)
    rollups.load_agg(spark, spec, views.readings(spark, sf_dir), "first")
    rollups.expire_agg(spark, spec, as_of="2024-02-05", keep=20)
    return rollups.read_agg(spark, spec).drop(spec.slot)


@query
def device_lookup(spark, sf_dir):
    """Key filter on a table without buckets, where Bloom filters of row groups leave most unread."""
    table = raw_table(spark, views.readings(spark, sf_dir))
    return spark.table(table).filter("device_id = 7").select(*READING_COLS)


@query
def compact_days(spark, sf_dir):
    src = views.readings(spark, sf_dir)
    table = raw_table(spark)
    raw.load_batch(spark, table, src.filter(F.minute("event_time") < 20), "a", done=True)
    raw.load_batch(spark, table, src.filter(F.minute("event_time") >= 20), "b", done=True)
    raw.compact(spark, table, "2024-01-01", "2024-02-01")
    return rows_of(spark, table)


@query
def device_history(spark, sf_dir):
    """Key filter on the sorted and bucketed table."""
    table = raw_table(spark, views.readings(spark, sf_dir), buckets=16)
    return time_range(spark.table(table), "2024-01-03", "2024-01-28").filter("device_id = 7").select(*READING_COLS)


# --- rollups -----------------------------------------------------------------------------------


@query
def rollup_minute(spark, sf_dir):
    return ops.rollup(views.readings(spark, sf_dir), "minute")


@query
def rollup_hourly(spark, sf_dir):
    return ops.rollup(views.readings(spark, sf_dir), "hour")


@query
def rollup_daily(spark, sf_dir):
    return ops.rollup_up(ops.rollup(views.readings(spark, sf_dir), "hour"), "day")


@query
def rollup_avg(spark, sf_dir):
    return with_avg(ops.rollup(views.readings(spark, sf_dir), "hour"))


def hourly_table(spark: SparkSession, measures=MEASURES, complete: bool = False) -> Rollup:
    spec = Rollup(f"{create_lake(spark)}.agg_hourly", "hour", measures=measures, complete=complete)
    rollups.create_agg(spark, spec)
    return spec


def refreshed(spark: SparkSession, table: str, spec: Rollup, days=None, **dimension) -> Rollup:
    """The rollup made from the table, by default for all its days."""
    rollups.create_agg(spark, spec)
    days = days or raw.days_of_label(spark, table, "first")
    rollups.refresh_rollup(spark, spec, raw.readings_of(spark, table), days, source=table, **dimension)
    return spec


@query
def rollup_merge_partials(spark, sf_dir):
    """Two loads that share every hour, the first of them retried."""
    src = views.readings(spark, sf_dir)
    spec = hourly_table(spark)
    first = src.filter(F.minute("event_time") < 30)
    rollups.load_agg(spark, spec, first, "a")
    rollups.load_agg(spark, spec, src.filter(F.minute("event_time") >= 30), "b")
    rollups.load_agg(spark, spec, first, "a")
    return rollups.read_agg(spark, spec).drop(spec.slot)


@query
def mv_hourly_refresh(spark, sf_dir):
    """A view without the minimum, refreshed for the day that changed under it."""
    src = views.readings(spark, sf_dir)
    table = raw_table(spark, src)
    spec = hourly_table(spark, ("reading_cnt", "value_sum", "value_max"))
    rollups.refresh_rollup(spark, spec, raw.readings_of(spark, table), raw.days_of_label(spark, table, "first"))
    raw.overwrite_day(spark, table, stale(read_day(src, DAY)), DAY)
    rollups.rebuild_agg(spark, spec, raw.readings_of(spark, table), DAY)
    return rollups.read_agg(spark, spec).drop(spec.slot)


@query
def rollup_routed_daily(spark, sf_dir):
    table = raw_table(spark, views.readings(spark, sf_dir))
    spec = refreshed(spark, table, Rollup(f"{table}_hourly", "hour"))
    return rollups.rollup_query(
        spark, raw.readings_of(spark, table), [spec], "day", ["metric"], [*MEASURES, "value_avg"],
        "2024-01-01", "2024-02-01", source=table,
    )


@query
def rollup_routed_stale(spark, sf_dir):
    """A rollup that holds the first days only, one of them overwritten since: the rest comes from
    the readings."""
    src = views.readings(spark, sf_dir)
    table = raw_table(spark, src)
    spec = refreshed(spark, table, Rollup(f"{table}_hourly", "hour"), [f"2024-01-{d:02d}" for d in range(1, 11)])
    raw.overwrite_day(spark, table, stale(read_day(src, DAY)), DAY)
    return rollups.rollup_query(
        spark, raw.readings_of(spark, table), [spec], "day", ["metric"], ["reading_cnt", "value_sum"],
        "2024-01-01", "2024-02-01", source=table,
    )


@query
def rollup_routed_filtered(spark, sf_dir):
    """One metric, some devices."""
    table = raw_table(spark, views.readings(spark, sf_dir))
    spec = refreshed(spark, table, Rollup(f"{table}_hourly", "hour"))
    return rollups.rollup_query(
        spark, raw.readings_of(spark, table), [spec], "day", ["device_id"], ["reading_cnt", "value_sum"],
        "2024-01-03", "2024-01-28", where={"metric": ["click"], "device_id": list(range(40))}, source=table,
    )


@query
def rollup_routed_split(spark, sf_dir):
    """Whole days from the daily rollup, the hours at both ends from the hourly one, the rest of
    them from the readings."""
    table = raw_table(spark, views.readings(spark, sf_dir))
    specs = [refreshed(spark, table, Rollup(f"{table}_{grain}", grain, ("metric",))) for grain in ("hour", "day")]
    return rollups.rollup_query(
        spark, raw.readings_of(spark, table), specs, None, ["metric"], [*MEASURES, "value_avg"],
        "2024-01-03 10:30:00", "2024-01-28 09:17:00", source=table,
    )


@query
def rollup_routed_slice(spark, sf_dir):
    """A range off the hour, so that only the minute rollup can answer it."""
    src = views.readings(spark, sf_dir)
    hourly = hourly_table(spark, complete=True)
    minute = Rollup(f"{hourly.table}_minute", "minute", complete=True)
    rollups.create_agg(spark, minute)
    for spec in (hourly, minute):
        rollups.load_agg(spark, spec, src, "a")
    return rollups.rollup_query(
        spark, src, [hourly, minute], "hour", ["device_id"], ["reading_cnt", "value_sum"],
        "2024-01-03 10:30:00", "2024-01-28 09:17:00",
    )


# --- dimension and joins -----------------------------------------------------------------------

CHANGED_DEVICE = T.StructType(
    [
        T.StructField("device_id", T.LongType(), False),
        T.StructField("site_code", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("seq", T.LongType()),
    ]
)


@query
def dim_upsert_delete(spark, sf_dir):
    """Changes that arrive newest first, with the first batch sent again at the end."""
    changes = views.device_changes(spark, sf_dir)
    table = f"{create_lake(spark)}.dim"
    dims.create_dim(spark, table, CHANGED_DEVICE)
    order = ("updated_at", "seq")
    newer = changes.filter("updated_at >= timestamp '1995-01-01'")
    for batch in (newer, changes.filter("updated_at < timestamp '1995-01-01'"), newer):
        dims.upsert(spark, table, batch, order=order)
    return dims.read_dim(spark, table)


@query
def dim_upsert_rejects(spark, sf_dir):
    """Changes of which some cannot be applied, twice: reasons, and how many devices are served."""
    seq = F.col("seq")
    torn = views.device_changes(spark, sf_dir).withColumns(
        {
            "device_id": F.when(seq % 50 != 0, F.col("device_id")),
            "__op": F.when(seq % 50 == 1, 2).when(seq % 50 != 2, F.col("__op")),
            "site_code": F.when(seq % 50 == 3, F.repeat(F.lit("s"), F.lit(33))).otherwise(F.col("site_code")),
        }
    )
    table = f"{create_lake(spark)}.dim"
    dims.create_dim(spark, table, CHANGED_DEVICE)
    bad = quarantine(spark, table)
    for _ in range(2):
        dims.upsert(spark, table, torn, order=("updated_at", "seq"), quarantine=bad)
    reasons = spark.table(bad).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return reasons.unionByName(dims.read_dim(spark, table).agg(F.lit("served").alias("reason"), F.count(F.lit(1)).alias("n")))


@query
def dim_stream_upsert(spark, sf_dir):
    """The change feed as a stream, newest changes first and a part of them twice, some malformed."""
    folder = f"{shared_root(spark)}/{unique('feed_')}"
    changes = views.device_changes(spark, sf_dir)
    table = f"{create_lake(spark)}.dim"
    dims.create_dim(spark, table, CHANGED_DEVICE)
    bad = quarantine(spark, table)
    schema = T.StructType([*CHANGED_DEVICE.fields, T.StructField("__op", T.IntegerType(), False)])
    newer, older = changes.filter("updated_at >= timestamp '1995-01-01'"), changes.filter("updated_at < timestamp '1995-01-01'")
    torn = changes.filter("seq % 50 = 0").withColumn("device_id", F.lit(None).cast("long"))
    errors = torn.count()
    for part in (newer, older.unionByName(torn), newer):
        # Files of a part come at once, so that it is a micro-batch of its own.
        part.select(F.to_json(F.struct(*changes.columns)).alias("value")).write.mode("append").text(f"{folder}/messages")
        feed = read_stream(spark, "text", {"path": f"{folder}/messages", "maxFilesPerTrigger": "1000000"})
        stream = stream_dim(
            spark, feed, table, "feed", f"{folder}/checkpoint", ("updated_at", "seq"), schema, errors, bad, AT_ONCE
        )
        run(stream)
    rejects = spark.table(bad).agg(F.lit("rejects").alias("site_code"), F.count(F.lit(1)).alias("device_id"))
    return dims.read_dim(spark, table).unionByName(rejects, allowMissingColumns=True)


@query
def fact_dim_join(spark, sf_dir):
    return ops.with_device(views.readings(spark, sf_dir), views.device(spark, sf_dir))


@query
def fact_dim_bucketed(spark, sf_dir):
    """Both tables bucketed on the device: no shuffle, hot devices joined apart."""
    fact = raw_table(spark, views.readings(spark, sf_dir), buckets=16)
    dim = f"{fact}_dim"
    dims.create_dim(spark, dim)
    dims.upsert(spark, dim, views.device(spark, sf_dir))
    joined = ops.colocated_join(raw.readings_of(spark, fact), dims.read_dim(spark, dim))
    return joined.select(*READING_COLS, "device_name", "site_code", "is_active")


@query
def fact_dim_hot(spark, sf_dir):
    """As before, where one device has a third of all rows and the tables have 32 buckets."""
    hot = F.when(F.minute("event_time") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("device_id"))
    fact = raw_table(spark, views.readings(spark, sf_dir).withColumn("device_id", hot), buckets=32)
    dim = f"{fact}_dim"
    dims.create_dim(spark, dim, buckets=32)
    dims.upsert(spark, dim, views.device(spark, sf_dir))
    joined = ops.colocated_join(raw.readings_of(spark, fact), dims.read_dim(spark, dim), buckets=catalog.bucket_count(spark, fact))
    return joined.select(*READING_COLS, "site_code")


def active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension that does not know every device."""
    return views.device(spark, sf_dir).filter("is_active")


@query
def denormalized_rollup(spark, sf_dir):
    return ops.enriched_rollup(views.readings(spark, sf_dir), active(spark, sf_dir), "minute")


@query
def denormalized_readings(spark, sf_dir):
    return ops.enrich(views.readings(spark, sf_dir), active(spark, sf_dir))


@query
def site_metric_groupby(spark, sf_dir):
    return ops.groupby_dims(
        views.readings(spark, sf_dir), [(views.device(spark, sf_dir), "device_id")], ["site_code", "metric"]
    )


@query
def region_metric_groupby(spark, sf_dir):
    """Two dimensions, the second joined on a column of the first."""
    chain = [(views.device(spark, sf_dir), "device_id"), (views.site(spark, sf_dir), "site_code")]
    return ops.groupby_dims(views.readings(spark, sf_dir), chain, ["region", "is_active", "metric"])


# --- reports -----------------------------------------------------------------------------------


@query
def site_topn(spark, sf_dir):
    return ops.site_topn(views.readings(spark, sf_dir), views.device(spark, sf_dir), "purchase", 3)


def site_table(spark: SparkSession, sf_dir: str) -> Rollup:
    """Readings with their site, folded per day and stored."""
    spec = Rollup(f"{create_lake(spark)}.agg_site", "day", STREAM_KEYS, complete=True)
    rollups.create_agg(spark, spec)
    rollups.load_agg(spark, spec, views.readings(spark, sf_dir), "a", views.device(spark, sf_dir))
    return spec


@query
def site_topn_stored(spark, sf_dir):
    """Precomputed per site, device, metric and day; ranked when read."""
    return ops.site_topn(spark.table(site_table(spark, sf_dir).table), None, "purchase", 3)


@query
def site_groupby_routed(spark, sf_dir):
    """A join query answered without the join, by the rollup that holds the site."""
    return rollups.rollup_query(
        spark, views.readings(spark, sf_dir), [site_table(spark, sf_dir)], None,
        ["site_code", "metric"], ["reading_cnt", "value_sum", "value_max"], "2024-01-03", "2024-01-28",
    )


@query
def site_groupby_off_border(spark, sf_dir):
    """From half past ten: the daily rollup with the site gives the whole days, the readings and the
    dimension the rest of the first."""
    table = raw_table(spark, views.readings(spark, sf_dir))
    dim = f"{table}_dim"
    dims.create_dim(spark, dim)
    dims.upsert(spark, dim, views.device(spark, sf_dir))
    device = dims.read_dim(spark, dim)
    spec = Rollup(f"{table}_site", "day", ("site_code", "metric"))
    refreshed(spark, table, spec, dim=device, dim_table=dim)
    return rollups.rollup_query(
        spark, raw.readings_of(spark, table), [spec], None, ["site_code", "metric"],
        ["reading_cnt", "value_sum", "value_max"], "2024-01-03 10:30:00", "2024-01-28",
        source=table, dim=device, dim_table=dim,
    )


@query
def topn_tiny_values(spark, sf_dir):
    """Ranks of sums far below one."""
    tiny = views.readings(spark, sf_dir).withColumn("value", F.col("value") / 1e9)
    ranked = ops.topn(tiny, "device_id", "view", 10, "2024-01-03", "2024-01-28")
    return ranked.withColumn("value_sum", F.col("value_sum") * 1e9)


@query
def topn_devices(spark, sf_dir):
    return ops.topn(views.readings(spark, sf_dir), "device_id", "view", 10, "2024-01-03", "2024-01-28")


@query
def timeseries_hourly(spark, sf_dir):
    return ops.timeseries(
        views.readings(spark, sf_dir), "hour", "2024-01-03", "2024-01-28", F.col("metric") == "click"
    )


@query
def groupby_dims(spark, sf_dir):
    rows = time_range(views.readings(spark, sf_dir), "2024-01-03", "2024-01-28")
    return ops.groupby_dims(rows, [], ["device_id", "metric"])


@query
def dq_report(spark, sf_dir):
    report = ops.run_gates(views.readings(spark, sf_dir), gates.daily_gates(NOW))
    return report.withColumn("observed", F.round("observed", 6))


@query
def dq_table_report(spark, sf_dir):
    """The same gates on the stored table, which read its newest day only."""
    table = raw_table(spark, views.readings(spark, sf_dir))
    return gates.report(spark, table, NOW).withColumn("observed", F.round("observed", 6))


def sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of which few enough have lost their value."""
    readings = views.readings(spark, sf_dir)
    return readings.withColumn("value", F.coalesce("value", F.when(F.minute("event_time") % 2 == 0, 0.0)))


@query
def published_after_gates(spark, sf_dir):
    """A whole run: increments into the raw table, the gates, and only then the rollup."""
    src = sound(spark, sf_dir)
    table = raw_table(spark)
    watermark.create_control(spark, f"{table}_control")
    passed = ingest_all(spark, src, table, f"{table}_control", "readings", limit=-(-src.count() // 2))
    spec = hourly_table(spark)
    stored = raw.readings_of(spark, table)
    days = {spec["event_date"] for spec in catalog.partitions(spark, table)}
    gates.publish_if_sound(
        spark, table, lambda: rollups.refresh_rollup(spark, spec, stored, days, source=table), passed[-1]
    )
    return rollups.rollup_query(
        spark, stored, [spec], "day", ["device_id"], ["reading_cnt", "value_max"], "2024-01-01", "2024-02-01", source=table
    )


@query
def load_gated(spark, sf_dir):
    """Loads whose own rows are measured while they are written: days with too many lost values, or with
    none that are new enough, leave nothing."""
    src = views.readings(spark, sf_dir)
    lost = F.col("event_time") >= "2024-01-10"
    src = src.withColumn("value", F.when(~lost | (F.minute("event_time") % 2 == 0), F.coalesce("value", F.lit(0.0))))
    table = raw_table(spark)
    checks = [ops.RowCount(1), ops.NullRatio("value", 0.05), ops.Fresh("event_time", 24 * 60, "2024-01-20")]
    for first, last in (("2024-01-01", "2024-01-05"), ("2024-01-12", "2024-01-20"), ("2024-02-10", "2024-02-11")):
        part = time_range(src, first, last)
        kept = [checks[:2], checks, checks][("2024-01-01", "2024-01-12", "2024-02-10").index(first)]
        try:
            gates.load_if_sound(spark, table, part, f"from-{first}", kept)
        except ops.DataQualityError:
            if raw.days_of_label(spark, table, f"from-{first}"):
                raise AssertionError("a refused load left something") from None
    return rows_of(spark, table)


@query
def ingested_at_filled(spark, sf_dir):
    """Rows of two loads by label, and how many of them have no load time or another one than was given."""
    src = views.readings(spark, sf_dir)
    table = raw_table(spark)
    for label, first, last in (("early", "2024-01-01", "2024-01-10"), ("late", "2024-01-10", None)):
        raw.load_batch(spark, table, time_range(src, first, last), label, "2024-02-03 04:05:06" if label == "late" else None)
    given = F.col("ingested_at") == F.lit("2024-02-03 04:05:06").cast("timestamp")
    return spark.table(table).groupBy("load_label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("ingested_at").isNull()).alias("missing"), F.count_if(given).alias("as_given")
    )


@query
def blocked_by_gates(spark, sf_dir):
    """Too many readings of the last day have lost their value: the rollup stays as it was."""
    src = views.readings(spark, sf_dir)
    src = src.withColumn("value", F.when(F.col("event_time") < "2024-01-30", F.col("value")))
    table = raw_table(spark, time_range(src, end="2024-01-20"))
    spec = refreshed(spark, table, Rollup(f"{table}_hourly", "hour"))
    raw.load_batch(spark, table, time_range(src, "2024-01-20"), "second")
    stored = raw.readings_of(spark, table)
    try:
        gates.publish_if_sound(
            spark, table, lambda: rollups.refresh_rollup(spark, spec, stored, raw.days_of_label(spark, table, "second"), source=table), NOW
        )
    except ops.DataQualityError:
        pass
    return rollups.read_agg(spark, spec).drop(spec.slot)


# --- streams -----------------------------------------------------------------------------------


def topic(spark: SparkSession, sf_dir: str, files_at_once: int = 2, sound: bool = False) -> tuple[DataFrame, str]:
    """The messages, or the sound ones, as a stream, and a folder for its checkpoint. Files hold a fifth of
    them at most."""
    folder = f"{shared_root(spark)}/{unique('topic_')}"
    sent = views.messages(spark, sf_dir)
    if sound:
        sent = parse(sent).filter("reason IS NULL").select(F.xxhash64("payload").alias("event_id"), F.col("payload").alias("value"))
    ordered = sent.repartitionByRange("event_id").sortWithinPartitions("event_id").select("value")
    ordered.write.option("maxRecordsPerFile", -(-sent.count() // 5)).text(f"{folder}/messages")
    source = read_stream(spark, "text", {"path": f"{folder}/messages", "maxFilesPerTrigger": str(files_at_once)})
    return source, f"{folder}/checkpoint"


def run(stream) -> None:
    stream.awaitTermination()


@query
def stream_raw_readings(spark, sf_dir):
    source, checkpoint = topic(spark, sf_dir)
    table = raw_table(spark)
    spent = budget(spark, sf_dir), quarantine(spark, table)
    run(stream_raw(spark, source, table, "raw", checkpoint, *spent, trigger=AT_ONCE))
    return rows_of(spark, table)


@query
def stream_replay_after_compact(spark, sf_dir):
    """The last micro-batch again, as after a crash before its commit, with a compaction in between."""
    source, checkpoint = topic(spark, sf_dir)
    table = raw_table(spark)
    spent = budget(spark, sf_dir), quarantine(spark, table)
    query = stream_raw(spark, source, table, "raw", checkpoint, *spent, trigger=AT_ONCE)
    run(query)
    last = max(p["batchId"] for p in query.recentProgress)
    raw.compact(spark, table, "2024-01-01", "2024-02-01")
    catalog.remove_folder(spark, f"{checkpoint}/commits/{last}")
    run(stream_raw(spark, source, table, "raw", checkpoint, *spent, trigger=AT_ONCE))
    return rows_of(spark, table)


@query
def stream_budget_raised(spark, sf_dir):
    """Stopped by the first malformed messages, then started again with a budget for them."""
    source, checkpoint = topic(spark, sf_dir)
    table = raw_table(spark)
    spent = budget(spark, sf_dir), quarantine(spark, table)
    try:
        run(stream_raw(spark, source, table, "raw", checkpoint, 0, spent[1], AT_ONCE))
    except StreamingQueryException as error:
        if "malformed messages, limit 0" not in str(error):
            raise
    if spark.table(table).count() or spark.table(spent[1]).count():
        raise AssertionError("a batch over the budget left something")
    run(stream_raw(spark, source, table, "raw", checkpoint, *spent, trigger=AT_ONCE))
    return rows_of(spark, table)


@query
def stream_rollup_minute(spark, sf_dir):
    """Folded per micro-batch, then all but the newest micro-batch merged hour by hour."""
    source, checkpoint = topic(spark, sf_dir)
    spec = Rollup(f"{create_lake(spark)}.agg_minute", "minute", STREAM_KEYS)
    rollups.create_agg(spark, spec)
    spent = budget(spark, sf_dir), quarantine(spark, spec.table)
    run(stream_rollup(spark, source, spec, "minute", checkpoint, active(spark, sf_dir), *spent, trigger=AT_ONCE))
    compact_stream_rollup(spark, spec)
    return rollups.read_agg(spark, spec).drop(spec.slot)


@query
def stream_rollup_versioned(spark, sf_dir):
    """The dimension changes between micro-batches, and again before the second one is replayed: its
    rows have the sites of the version it began with, the third's those of the newest."""
    folder = f"{shared_root(spark)}/{unique('topic_')}"
    spec = Rollup(f"{create_lake(spark)}.agg_minute", "minute", STREAM_KEYS)
    rollups.create_agg(spark, spec)
    dim = f"{spec.table}_dim"
    dims.create_dim(spark, dim, CHANGED_DEVICE)
    devices = views.device(spark, sf_dir).select("device_id", "site_code")

    def moved(version: int) -> None:
        site = F.when(F.col("device_id") % (version + 1) == 0, F.concat("site_code", F.lit(f"-{version}"))).otherwise(F.col("site_code"))
        stamp = F.lit(f"2024-01-0{version + 1}").cast("timestamp")
        dims.upsert(spark, dim, devices.select("device_id", site.alias("site_code"), stamp.alias("updated_at"), F.lit(version).cast("long").alias("seq")))

    batches = rollup_batches(spark, spec, "minute", dim, budget(spark, sf_dir), quarantine(spark, spec.table))
    deaths = ["after the load of micro-batch 1"]

    def dying(batch: DataFrame, batch_id: int) -> None:
        batches(batch, batch_id)
        if batch_id == 1 and deaths:
            raise RuntimeError(deaths.pop())

    def go_on() -> None:
        source = read_stream(spark, "text", {"path": f"{folder}/messages", "maxFilesPerTrigger": "1000000"})
        stream = source.writeStream.foreachBatch(dying).option("checkpointLocation", f"{folder}/checkpoint").trigger(**AT_ONCE)
        run(stream.start())

    sent = views.messages(spark, sf_dir)
    for part in range(3):
        moved(part)
        sent.filter(F.col("event_id") % 3 == part).select("value").write.mode("append").text(f"{folder}/messages")
        try:
            go_on()
        except StreamingQueryException as error:
            if "after the load" not in str(error):
                raise
            moved(2)
            go_on()
    return rollups.read_agg(spark, spec).drop(spec.slot)


@query
def stream_rollup_windowed(spark, sf_dir):
    source, checkpoint = topic(spark, sf_dir, files_at_once=1_000_000)
    out = f"{checkpoint}_out"
    bad = quarantine(spark, f"{create_lake(spark)}.windowed")
    for query in stream_rollup_bounded(
        spark, source, out, "windowed", checkpoint, bad, "10 minutes", active(spark, sf_dir), budget(spark, sf_dir), AT_ONCE
    ):
        run(query)
    return spark.read.parquet(out)


@query
def stream_history(spark, sf_dir):
    """The history of a stream that is paused after its first files and resumed: all messages, no micro-batch
    above the row limit, none missing, two runs. Sound messages: Spark counts those twice that are read again."""
    source, checkpoint = topic(spark, sf_dir, sound=True)
    table = raw_table(spark)
    spent = 0, None
    history = History(spark, f"{table}_history")
    spark.streams.addListener(history)
    try:
        job = StreamJob(lambda: stream_raw(spark, source, table, "raw", checkpoint, *spent, trigger={"processingTime": "0 seconds"}))
        stream = job.resume()
        while stream.isActive and not stream.lastProgress:
            stream.awaitTermination(1)
        job.pause()
        history.settle(stream)
        stream = stream_raw(spark, source, table, "raw", checkpoint, *spent, trigger=AT_ONCE)
        run(stream)
        history.settle(stream)
    finally:
        spark.streams.removeListener(history)
    limit = 2 * -(-conform(views.messages(spark, sf_dir))[0].count() // 5)
    return history.read().agg(
        F.sum("input_rows").alias("n"), F.count_if(F.col("input_rows") > limit).alias("over_limit"),
        (F.max("batch_id") + 1 - F.count(F.lit(1))).alias("missing"), (F.count_distinct("run_id") <= 2).alias("two_runs"),
    )


@query
def stream_quarantine(spark, sf_dir):
    source, checkpoint = topic(spark, sf_dir)
    table = raw_table(spark)
    bad = quarantine(spark, table)
    run(stream_raw(spark, source, table, "raw", checkpoint, budget(spark, sf_dir), bad, trigger=AT_ONCE))
    return spark.table(bad).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
