from datetime import timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from gaugeline.functions.times import as_datetime, as_text
from gaugeline.plans import raw, watermark
from gaugeline.plans import ingest as plan
from gaugeline.plans.ingest import ingest_all, ingest_increment
from gaugeline.sources import increment_cutoff, read_increment
from gaugeline.sources import readings as source
from helpers import at, content, lake, raw_table, readings, rows_of
from helpers import plan as plan_text

FLOOR = "1970-01-01"


def control_table(spark) -> str:
    table = f"{lake(spark)}.control"
    watermark.create_control(spark, table)
    return table


def test_ties_at_limit(spark):
    rows = [(f"2024-01-01 00:00:0{s}", i, "m", 1.0) for i, s in enumerate([1, 2, 3, 3, 4])]
    src = readings(spark, rows)
    first = read_increment(src, FLOOR, 3)
    assert first.rows.count() == 4
    second = read_increment(src, first.high, 3)
    assert second.rows.count() == 1
    assert read_increment(src, second.high, 3).high is None
    assert rows_of(first.rows.union(second.rows)) == rows_of(src)


@pytest.mark.parametrize("gap", [0, 30, 90])
@pytest.mark.parametrize("seed", [1, 2])
def test_cutoff_is_the_nth_oldest(spark, gap, seed):
    """Times before and after 1970, many close together, some after a gap of days."""
    rng = Random(seed)
    base = at("1969-12-31 23:59:50")
    spans = [3 * 86400 * 10**6, 90 * 10**6, 200_000, 20]
    times = sorted(
        base + timedelta(days=rng.choice((0, gap)), microseconds=rng.randrange(rng.choice(spans)))
        for _ in range(300)
    )
    df = spark.createDataFrame([(as_text(t),) for t in times], "t string")
    df = df.select(F.col("t").cast("timestamp").alias("event_time"))
    low = times[40]
    above = [t for t in times if t > low]
    for limit in (1, 2, 57, len(above), len(above) + 5, None):
        expected = above[min(limit or len(above), len(above)) - 1]
        assert increment_cutoff(df, low, limit) == as_text(expected)
    assert increment_cutoff(df, times[-1], 5) is None


def test_steady_state_takes_one_count(spark, monkeypatch):
    """Where no more than the limit is left, one count is the only job before the read."""
    src = readings(spark, [(f"2024-01-0{d} 00:00:0{s}", 1, "m", 1.0) for d in (1, 2, 3) for s in range(1, 6)])
    seen = []
    real = source._bucket_of_nth
    monkeypatch.setattr(source, "_bucket_of_nth", lambda df, *a: seen.append(plan_text(df)) or real(df, *a))
    for low, limit, jobs in (("2024-01-02 00:00:02", 100, 0), ("2024-01-02 00:00:02", 8, 0), ("2024-01-03 00:00:05", 5, 0), ("2024-01-01", 5, 1)):
        seen.clear()
        increment_cutoff(src, low, limit)
        assert len(seen) == jobs


def test_limits_that_ask_for_nothing(spark):
    src = readings(spark, [("2024-01-01 00:00:01", 1, "m", 1.0)])
    step = read_increment(src, FLOOR, 0)
    assert step.high is None and step.rows.count() == 0
    with pytest.raises(ValueError, match="negative"):
        read_increment(src, FLOOR, -1)


def test_zone_less_source(spark):
    src = readings(spark, [("2024-01-01 00:00:01", 1, "m", 1.0), ("2024-01-02 00:00:01", 1, "m", 2.0)])
    src = src.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    step = read_increment(src, "2024-01-01 12:00:00", 10)
    assert (step.rows.count(), step.high) == (1, "2024-01-02 00:00:01.000000")


def test_retry_after_crash_with_a_grown_source(spark, monkeypatch):
    rows = [(f"2024-01-0{1 + i % 3} 00:00:{i:02d}", i, "m", float(i)) for i in range(60)]
    table, control = raw_table(spark), control_table(spark)

    def crash(*args):
        raise RuntimeError("died before the watermark")

    with monkeypatch.context() as m:
        m.setattr(plan, "set_watermark", crash)
        with pytest.raises(RuntimeError):
            ingest_increment(spark, readings(spark, rows[:40]), table, control, "job", 30)
    assert watermark.get_watermark(spark, control, "job") is None
    grown = readings(spark, rows)
    ingest_all(spark, grown, table, control, "job", 25)
    assert content(spark, table) == rows_of(grown)


def test_a_shorter_retry_leaves_nothing_of_the_first_attempt(spark):
    table = raw_table(spark)
    rows = [("2024-01-01 10:00:00", 1, "m", 1.0), ("2024-01-02 10:00:00", 1, "m", 2.0)]
    raw.load_batch(spark, table, readings(spark, rows), "l")
    raw.load_batch(spark, table, readings(spark, rows[:1]), "l")
    assert content(spark, table) == rows_of(readings(spark, rows[:1]))


def test_nothing_new_keeps_the_watermark(spark):
    table, control = raw_table(spark), control_table(spark)
    src = readings(spark, [("2024-01-01 10:00:00", 1, "m", 1.0)])
    assert ingest_increment(spark, src, table, control, "job") == "2024-01-01 10:00:00.000000"
    assert ingest_increment(spark, src, table, control, "job") is None
    assert watermark.get_watermark(spark, control, "job") == "2024-01-01 10:00:00.000000"


def test_late_rows_are_left_to_a_backfill(spark):
    table, control = raw_table(spark), control_table(spark)
    early = [("2024-01-01 10:00:00", 1, "m", 1.0)]
    late = [("2024-01-01 09:00:00", 1, "m", 0.5)]
    ingest_all(spark, readings(spark, early), table, control, "job")
    src = readings(spark, early + late)
    assert ingest_all(spark, src, table, control, "job") == []
    mark = watermark.get_watermark(spark, control, "job")
    raw.backfill(spark, table, src, "2024-01-01", "2024-01-02", upto=mark)
    assert content(spark, table) == rows_of(src)


def test_watermarks_per_job(spark):
    control = control_table(spark)
    assert watermark.get_watermark(spark, control, "a", "floor") == "floor"
    watermark.set_watermark(spark, control, "a", "1", as_of="2024-01-01 00:00:00")
    watermark.set_watermark(spark, control, "b", "2")
    watermark.set_watermark(spark, control, "a", "3", as_of="2024-01-02 00:00:00")
    kept = {r.job_key: (r.watermark, r.updated_at) for r in spark.table(control).collect()}
    assert kept["a"] == ("3", as_datetime("2024-01-02")) and kept["b"][0] == "2"
    with pytest.raises(ValueError):
        watermark.set_watermark(spark, control, "a/b", "1")


def test_labels_are_clean_and_unique():
    a = raw.label_for("job.x", "2024-01-01 00:00:00")
    assert a.startswith("job_x_2024-01-01_00_00_00_") and a != raw.label_for("job_x", "2024-01-01 00:00:00")
    long = [raw.label_for("j" * 300, str(i)) for i in range(2)]
    assert len(set(long)) == 2 and all(len(x) <= 128 for x in long)
