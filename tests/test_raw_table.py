import glob
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from gaugeline.functions import days_between
from gaugeline.plans import catalog, raw
from helpers import content, empty, raw_table, readings, rows_of, timed_rows

D1, D2, D3 = "2024-01-01", "2024-01-02", "2024-01-03"


def two_days(spark):
    return readings(spark, timed_rows(D1, 20) + timed_rows(D2, 20))


def test_empty_source_leaves_an_empty_day(spark):
    table = raw_table(spark)
    raw.load_batch(spark, table, two_days(spark), "l")
    assert raw.overwrite_day(spark, table, empty(spark), D1) == 0
    assert content(spark, table) == rows_of(readings(spark, timed_rows(D2, 20)))


@pytest.mark.parametrize("buckets", [0, 4])
def test_backfill_twice(spark, buckets):
    table = raw_table(spark, buckets)
    raw.load_batch(spark, table, two_days(spark), "l")
    src = readings(spark, timed_rows(D1, 7) + timed_rows(D2, 9) + timed_rows(D3, 5))
    for _ in range(2):
        assert raw.backfill(spark, table, src, D1, D3) == 16
        assert content(spark, table) == rows_of(src.filter(F.col("event_time") < D3))


def test_row_of_another_day_is_rejected(spark):
    table = raw_table(spark)
    raw.load_batch(spark, table, two_days(spark), "l")
    before = content(spark, table)
    for replace in (raw.overwrite_day, raw.swap_day):
        with pytest.raises(Exception, match="row outside 2024-01-01"):
            replace(spark, table, two_days(spark), D1)
        assert content(spark, table) == before


def test_rows_that_break_the_schema_fail_the_load(spark):
    table = raw_table(spark)
    for row, why in [((f"{D1} 00:00:00", None, "m", 1.0), "device_id missing"),
                     ((None, 1, "m", 1.0), "event_time missing"),
                     ((f"{D1} 00:00:00", 1, "m" * 65, 1.0), "metric too long")]:
        with pytest.raises(Exception, match=why):
            raw.load_batch(spark, table, readings(spark, [row]), "l")
    assert content(spark, table) == []
    raw.load_batch(spark, table, readings(spark, [(f"{D1} 00:00:00", 1, "m" * 64, None)]), "l")
    assert spark.table(table).count() == 1


def test_ingested_at_is_filled(spark):
    table = raw_table(spark)
    raw.load_batch(spark, table, two_days(spark), "l", as_of="2024-02-01 10:00:00")
    stamps = spark.table(table).select(F.col("ingested_at").cast("string")).distinct().collect()
    assert [r[0] for r in stamps] == ["2024-02-01 10:00:00"]


@pytest.mark.parametrize("repair", ["backfill", "compact"])
def test_day_rewritten_between_crash_and_retry(spark, repair):
    """An unfinished load above the watermark; its day is rewritten before the retry."""
    table = raw_table(spark)
    src = two_days(spark)
    mark = f"{D1} 00:09:00"
    done = src.filter(F.col("event_time") <= mark)
    open_ = src.filter(F.col("event_time") > mark)
    raw.load_batch(spark, table, done, "done")
    raw.load_batch(spark, table, open_, "open")
    if repair == "backfill":
        raw.backfill(spark, table, src, D1, D2, upto=mark)
    else:
        assert raw.compact_day(spark, table, D1, upto=mark)
    raw.load_batch(spark, table, open_, "open")
    assert content(spark, table) == rows_of(src)


def test_compaction_folds_labels_and_keeps_rows(spark):
    table = raw_table(spark)
    src = two_days(spark)
    for i in range(3):
        raw.load_batch(spark, table, src.filter(F.minute("event_time") % 3 == i), f"l{i}", done=True)
    assert len(catalog.partitions(spark, table)) == 6
    assert raw.compact(spark, table, D1, D3) == [D1, D2]
    assert len(catalog.partitions(spark, table)) == 2
    assert content(spark, table) == rows_of(src)
    assert raw.compact(spark, table, D1, D3) == []


def test_swap_is_finished_after_the_driver_died(spark, monkeypatch):
    table = raw_table(spark)
    raw.load_batch(spark, table, two_days(spark), "l")
    fresh = readings(spark, timed_rows(D1, 5, device=9))
    real = catalog.add_partitions

    def die(*args):
        raise RuntimeError("died between drop and add")

    monkeypatch.setattr(catalog, "add_partitions", die)
    with pytest.raises(RuntimeError):
        raw.overwrite_day(spark, table, fresh, D1)
    monkeypatch.setattr(catalog, "add_partitions", real)
    # Any later change of the table completes the swap first.
    raw.load_batch(spark, table, readings(spark, timed_rows(D3, 2)), "next")
    kept = readings(spark, timed_rows(D1, 5, device=9) + timed_rows(D2, 20) + timed_rows(D3, 2))
    assert content(spark, table) == rows_of(kept)


def test_failed_write_changes_nothing(spark):
    table = raw_table(spark)
    raw.load_batch(spark, table, two_days(spark), "l")
    before = content(spark, table)
    broken = two_days(spark).withColumn("value", F.raise_error(F.lit("boom")).cast("double"))
    with pytest.raises(Exception, match="boom"):
        raw.backfill(spark, table, broken, D1, D3)
    assert content(spark, table) == before


def test_swap_day_keeps_readers_whole(spark):
    table = raw_table(spark)
    raw.backfill(spark, table, two_days(spark), D1, D3)
    old = raw.swap_day(spark, table, readings(spark, timed_rows(D1, 3)), D1)
    assert spark.read.parquet(old).count() == 20  # a reader under way still finds its files
    assert spark.table(table).filter(F.col("event_date") == D1).count() == 3
    catalog.remove_folder(spark, old)
    assert spark.table(table).count() == 23
    assert len(catalog.partitions(spark, table)) == 2


def test_retention_edge(spark):
    table = raw_table(spark)
    days = days_between("2024-01-01", "2024-04-05")  # as_of - 91 ... as_of + 1 and beyond
    as_of = "2024-04-01"
    raw.load_batch(spark, table, readings(spark, [(f"{d} 12:00:00", 1, "m", 1.0) for d in days]), "l")
    gone = raw.expire(spark, table, as_of, keep=90)
    assert gone == ["2024-01-01", "2024-01-02"]
    left = {str(r[0]) for r in spark.table(table).select("event_date").collect()}
    assert min(left) == "2024-01-03" and max(left) == "2024-04-04"


def test_hot_device_is_split_over_several_tasks(spark):
    """A device with a third of all rows must not be written by one task."""
    table = raw_table(spark, 4)
    rows = spark.range(60_000).select(
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=F.col("id") % 86400)).alias("event_time"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("bigint").alias("device_id"),
        F.lit("m").alias("metric"),
        F.rand(1).alias("value"),
    ).repartition(8)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "64k")
    spark.conf.set("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
    try:
        raw.load_batch(spark, table, rows, "l")
    finally:
        spark.conf.unset(key)
    root = catalog.table_location(spark, table).removeprefix("file:")
    files = glob.glob(f"{root}/event_date=2024-01-01/load_label=l/*.parquet")
    hot = spark.range(1).select(F.pmod(F.hash(F.lit(1).cast("bigint")), F.lit(4))).first()[0]
    assert sum(f"_{hot:05d}." in f for f in files) > 3
    assert spark.table(table).count() == 60_000


@pytest.mark.parametrize("gather", [True, False])
def test_rows_are_sorted_inside_files(spark, gather):
    import pyarrow.parquet as pq

    table = raw_table(spark)
    raw.load_batch(spark, table, two_days(spark).orderBy(F.rand(3)), "l", gather=gather)
    root = catalog.table_location(spark, table).removeprefix("file:")
    files = glob.glob(f"{root}/event_date=*/load_label=l/*.parquet")
    assert files
    for path in files:
        times = pq.ParquetFile(path).read().column("event_time").to_pylist()
        assert times == sorted(times)


def test_buckets_grow_with_the_volume():
    assert raw.buckets_for(1e9) == 16
    assert raw.buckets_for(1.1e12) == 4096


def test_a_failing_resend_keeps_the_first_load(spark, monkeypatch):
    table = raw_table(spark)
    raw.load_batch(spark, table, two_days(spark), "l")
    before = content(spark, table)
    bad = two_days(spark).union(readings(spark, [(f"{D3} 00:00:00", None, "m", 1.0)]))
    with pytest.raises(Exception, match="device_id missing"):
        raw.load_batch(spark, table, bad, "l")
    assert content(spark, table) == before


@pytest.mark.parametrize("step", ["stage", "drop_partitions", "move_partitions", "add_partitions", "remove_folder"])
@pytest.mark.parametrize("after", [False, True])
def test_a_resend_that_dies_leaves_one_of_both_loads(spark, monkeypatch, step, after):
    table = raw_table(spark)
    first, second = two_days(spark), readings(spark, timed_rows(D2, 4, device=7) + timed_rows(D3, 5, device=7))
    raw.load_batch(spark, table, first, "l")
    real = getattr(catalog, step)

    def die(*args):
        if after:
            real(*args)
        raise RuntimeError("died")

    with monkeypatch.context() as m:
        m.setattr(catalog, step, die)
        with pytest.raises(RuntimeError, match="died"):
            raw.load_batch(spark, table, second, "l")
    catalog.finish_swap(spark, table)
    expected = first if step == "stage" else second
    assert content(spark, table) == rows_of(expected)
    raw.load_batch(spark, table, second, "l")
    assert content(spark, table) == rows_of(second)


def test_a_finished_load_is_not_repeated(spark):
    table = raw_table(spark)
    raw.load_batch(spark, table, two_days(spark), "l", done=True)
    raw.compact(spark, table, D1, D3)
    raw.load_batch(spark, table, two_days(spark), "l", done=True)
    assert content(spark, table) == rows_of(two_days(spark))


def test_compaction_leaves_open_loads(spark):
    table = raw_table(spark)
    for label in ("a", "b"):
        raw.load_batch(spark, table, readings(spark, timed_rows(D1, 5, device=ord(label))), label, done=True)
    raw.load_batch(spark, table, readings(spark, timed_rows(D1, 5)), "open")
    assert raw.compact_day(spark, table, D1)
    raw.load_batch(spark, table, readings(spark, timed_rows(D1, 6)), "open")
    assert spark.table(table).count() == 16
    assert {s["load_label"] == "open" for s in catalog.partitions(spark, table)} == {True, False}


def test_clean_up_spares_what_tables_use(spark, monkeypatch):
    """Folders of dead jobs and of replaced versions go; what a table or partition points to stays."""
    table = raw_table(spark)
    database = table.split(".")[0]
    raw.backfill(spark, table, two_days(spark), D1, D3)
    raw.swap_day(spark, table, readings(spark, timed_rows(D1, 3)), D1)
    raw.load_batch(spark, table, readings(spark, timed_rows(D3, 4)), "l")
    raw.load_batch(spark, table, readings(spark, timed_rows(D3, 5)), "l")
    with monkeypatch.context() as m:
        m.setattr(catalog, "_noted_swap", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            raw.backfill(spark, table, two_days(spark), D1, D3)
    before = content(spark, table)
    assert catalog.clean_staged(spark, database, timedelta(hours=1)) == []
    assert catalog.clean_staged(spark, database, timedelta(seconds=-60))
    spark.catalog.refreshTable(table)
    assert content(spark, table) == before and len(before) == 28
    assert catalog.clean_staged(spark, database, timedelta(seconds=-60)) == []
