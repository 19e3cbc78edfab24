import pytest
from pyspark.sql import functions as F

from gaugeline.functions import today
from gaugeline.operators import (
    DataQualityError, Fresh, NullRatio, RowCount, enforce, fresh, null_ratio_below, publish, row_count_at_least,
    run_gates,
)
from gaugeline.plans import gates, raw
from helpers import empty, executed, plan, raw_table, readings

NOW = "2024-01-02 12:00:00"


def values(spark, nulls, total, day="2024-01-02"):
    rows = [(f"{day} 00:00:00", i, "m", None if i < nulls else 1.0) for i in range(total)]
    return readings(spark, rows)


def test_row_count(spark):
    assert row_count_at_least(values(spark, 0, 3), 3) == 3
    assert row_count_at_least(empty(spark), 0) == 0
    with pytest.raises(DataQualityError, match=r"row_count=0.0000, limit 1"):
        row_count_at_least(values(spark, 0, 3, "2024-01-01"), 1, today(NOW))


def test_today_has_no_upper_bound(spark):
    df = values(spark, 0, 2, "2024-01-02").union(values(spark, 0, 3, "2024-01-09"))
    assert row_count_at_least(df, 1, today(NOW)) == 5


def test_null_ratio_at_the_limit_passes(spark):
    assert null_ratio_below(values(spark, 1, 20), "value", 0.05) == 0.05
    with pytest.raises(DataQualityError, match="null_ratio=0.1000, limit 0.05"):
        null_ratio_below(values(spark, 2, 20), "value", 0.05)
    with pytest.raises(DataQualityError, match="no rows"):
        null_ratio_below(empty(spark), "value", 1.0)


@pytest.mark.parametrize(
    "newest, lag", [("10:59:01", 60), ("11:00:00", 60), ("10:59:00", None), ("13:00:00", -60), ("12:00:59", 0)]
)
def test_lag_counts_whole_minutes(spark, newest, lag):
    df = readings(spark, [(f"2024-01-02 {newest}", 1, "m", 1.0), ("2024-01-01 00:00:00", 1, "m", 1.0)])
    if lag is None:
        with pytest.raises(DataQualityError, match="freshness=61"):
            fresh(df, max_lag_minutes=60, as_of=NOW)
    else:
        assert fresh(df, max_lag_minutes=60, as_of=NOW) == lag


def test_no_rows_are_not_fresh(spark):
    with pytest.raises(DataQualityError, match="undefined"):
        fresh(empty(spark), as_of=NOW)


def test_or_in_a_predicate(spark):
    rows = [("2024-01-02 00:00:00", i, "ab"[i % 2], None if i < 3 else 1.0) for i in range(10)]
    df = readings(spark, rows)
    expected = df.filter("metric = 'a' OR device_id = 1")
    ratio = expected.filter("value IS NULL").count() / expected.count()
    assert null_ratio_below(df, "value", 1.0, "metric = 'a' OR device_id = 1") == ratio
    assert null_ratio_below(df, "value", 1.0, (F.col("metric") == "a") | (F.col("device_id") == 1)) == ratio


def test_all_failures_are_told_and_nothing_is_published(spark):
    done = []
    gates = [RowCount(1, today(NOW)), NullRatio("value", 0.05, today(NOW)), Fresh(as_of=NOW)]
    with pytest.raises(DataQualityError) as err:
        publish(values(spark, 0, 5, "2024-01-01"), gates, lambda: done.append(1), "readings")
    assert all(word in str(err.value) for word in ("readings", "row_count", "null_ratio", "freshness"))
    assert done == []
    good = values(spark, 0, 5).union(readings(spark, [(NOW, 1, "m", 1.0)]))
    assert publish(good, gates, lambda: "published") == "published"
    assert enforce(good, gates) == {"row_count": 6, "null_ratio": 0.0, "freshness": 0}


def test_all_gates_share_one_scan(spark):
    gates = [RowCount(1, today(NOW)), NullRatio("value", 0.05), NullRatio("metric", 0.0, name="b"), Fresh(as_of=NOW)]
    path = spark.conf.get("spark.checkpoint.dir") + "/gates"
    values(spark, 1, 50).write.mode("overwrite").parquet(path)
    assert executed(run_gates(spark.read.parquet(path), gates)).count("FileScan") <= 2  # initial and final plan


@pytest.mark.parametrize("as_of", ["2024-01-03 00:30:00", "2024-01-05 12:00:00", "2024-01-01 08:00:00"])
def test_newest_days_give_the_same_report(spark, as_of):
    table = raw_table(spark)
    rows = [(f"2024-01-0{d} {h:02d}:00:00", h, "m", None if h % 9 == 0 else 1.0) for d in (1, 2, 3) for h in range(24)]
    raw.load_batch(spark, table, readings(spark, rows), "l")
    whole = run_gates(spark.table(table), gates.daily_gates(as_of)).collect()
    assert gates.report(spark, table, as_of).collect() == whole
    newest = gates.newest_rows(spark, table, "2024-01-03 00:30:00")
    assert {f.split("event_date=")[1][:10] for f in newest.inputFiles()} >= {"2024-01-03"}
    assert "2024-01-03" in next(x for x in plan(newest).splitlines() if "PartitionFilters" in x)


def test_an_empty_table_fails_all_gates(spark):
    table = raw_table(spark)
    assert [r.passed for r in gates.report(spark, table, NOW).collect()] == [False, False, False]
    with pytest.raises(DataQualityError):
        gates.publish_if_sound(spark, table, lambda: None, NOW)
