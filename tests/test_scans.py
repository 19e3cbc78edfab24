"""What reaches the scan."""

import pytest
from pyspark.sql import functions as F

from gaugeline.functions import bucket, time_range, today
from gaugeline.plans import raw
from gaugeline.session import SETTINGS, shared_root
from gaugeline.sources import read_day
from helpers import plan, raw_table, readings
from workload import views

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def month(spark):
    table = raw_table(spark, 4)
    rows = [(f"2024-01-{d:02d} {h:02d}:00:00", h, "m", 1.0) for d in range(1, 31) for h in (0, 23)]
    raw.load_batch(spark, table, readings(spark, rows), "l")
    return table


def days_read(df) -> set[str]:
    return {f.split("event_date=")[1][:10] for f in df.inputFiles()}


def test_a_time_range_reads_only_its_days(spark, month):
    df = time_range(spark.table(month), "2024-01-10", "2024-01-11")
    assert df.count() == 2
    text = plan(df)
    partition = next(line for line in text.splitlines() if "PartitionFilters" in line)
    assert "2024-01-10" in partition and "event_date" in partition
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters"))
    assert "GreaterThanOrEqual(event_time" in pushed and "LessThan(event_time" in pushed
    assert days_read(time_range(spark.table(month), "2024-01-10 12:00:00", "2024-01-12 00:00:01")) >= {"2024-01-10"}


def test_a_range_that_ends_at_midnight_leaves_that_day_out(spark, month):
    text = plan(time_range(spark.table(month), "2024-01-10", "2024-01-11"))
    assert "2024-01-11" not in next(x for x in text.splitlines() if "PartitionFilters" in x)


def test_key_filter_and_columns_reach_the_scan(spark, month):
    df = time_range(spark.table(month), "2024-01-10").filter("device_id = 23").select("value")
    text = plan(df)
    assert "EqualTo(device_id,23)" in text
    schema = next(x for x in text.splitlines() if x.startswith("ReadSchema"))
    assert "metric" not in schema and "ingested_at" not in schema


def test_the_source_sees_the_day_filter(spark):
    text = plan(read_day(views.readings(spark, SF), "2024-01-05"))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "props" not in next(x for x in text.splitlines() if x.startswith("ReadSchema"))


def test_today_filter_is_pushed(spark, month):
    text = plan(spark.table(month).filter(today("2024-01-10 12:00:00")))
    assert "GreaterThanOrEqual(event_time,2024-01-10" in text


def test_bucket_rejects_other_grains():
    with pytest.raises(ValueError):
        bucket("event_time", "week")


def test_no_plan_has_a_cross_join_or_python(spark):
    import __spark_entry__ as entry

    lazy = ["rollup_minute", "rollup_daily", "site_topn", "region_metric_groupby", "denormalized_rollup",
            "dq_report", "json_conform", "topn_devices", "fact_dim_join", "timeseries_hourly"]
    for name in lazy:
        text = plan(entry.queries()[name](spark, SF))
        assert "Cartesian" not in text and "NestedLoop" not in text and "Python" not in text, name


def test_the_shared_folder_is_the_cluster_s(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert all(spark.conf.get(k) == v for k, v in SETTINGS.items())


def test_hot_metric_reaches_the_shuffle_presummed(spark):
    df = readings(spark, [("2024-01-01 00:00:00", 1, "m", 1.0)]).groupBy("device_id").agg(F.sum("value"))
    assert "partial_sum" in plan(df)


def test_a_device_is_found_without_buckets(spark):
    """Row groups hold all times of a while, and a range of devices that says nothing."""
    table = raw_table(spark)
    spark.conf.set("parquet.block.size", "60000")
    try:
        rows = spark.range(60_000).select(
            F.timestamp_seconds(1_704_070_800 + F.col("id")).alias("event_time"),
            F.xxhash64("id").alias("device_id"), F.lit("m").alias("metric"), F.rand(1).alias("value"),
        )
        raw.load_batch(spark, table, rows.coalesce(1), "l")
    finally:
        spark.conf.unset("parquet.block.size")
    wanted = spark.range(1).select(F.xxhash64(F.lit(31_000).cast("long")).alias("d")).first().d
    found = spark.table(table).filter(F.col("device_id") == wanted)
    assert [r.device_id for r in found.collect()] == [wanted]
    leaf = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert 0 < leaf.metrics().apply("numOutputRows").value() < 20_000
