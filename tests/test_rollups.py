from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from gaugeline.functions import MEASURES, with_avg
from gaugeline.operators import merge_partials, rollup, rollup_up, timeseries
from gaugeline.plans import catalog, raw, rollups
from gaugeline.plans import dimension as dims
from gaugeline.plans.rollups import Rollup
from helpers import at, lake, plan, raw_table, readings


def rounded(df):
    out = df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c).cast("string") for c, t in df.dtypes])
    return sorted((tuple(r) for r in out.select(*sorted(out.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def some(spark):
    df = spark.range(3000).select(
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=F.col("id") * 97)).alias("event_time"),
        (F.col("id") % 7).alias("device_id"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("metric"),
        F.when(F.col("id") % 11 != 0, F.rand(5) * 100).alias("value"),
    )
    return spark.createDataFrame(df.collect(), df.schema)


def agg(spark, grain="hour", buckets=0, **kw) -> Rollup:
    spec = Rollup(f"{lake(spark)}.agg", grain, **kw)
    rollups.create_agg(spark, spec, buckets)
    return spec


def test_null_values(spark):
    rows = [("2024-01-01 00:00:01", 1, "m", 1.0), ("2024-01-01 00:00:02", 1, "m", None)]
    row = with_avg(rollup(readings(spark, rows), "hour")).first()
    assert (row.reading_cnt, row.value_cnt, row.value_avg, row.avg_per_reading) == (2, 1, 1.0, 0.5)


def test_group_of_nulls(spark):
    row = with_avg(rollup(readings(spark, [("2024-01-01 00:00:01", 1, "m", None)]), "hour")).first()
    assert row.reading_cnt == 1
    assert row.value_sum is row.value_max is row.value_min is row.value_avg is None


@pytest.mark.parametrize("seed", [1, 2])
def test_parts_merge_to_the_whole(some, seed):
    part = F.pmod(F.hash("event_time", F.lit(seed)), F.lit(3))
    keys = ["event_hour", "device_id", "metric"]
    parts = [rollup(some.filter(part == i), "hour") for i in range(3)]
    merged = merge_partials(parts[0].union(parts[1]).union(parts[2]), keys)
    assert rounded(merged) == rounded(rollup(some, "hour"))


def test_day_from_hours_and_minutes(some):
    whole = rounded(rollup(some, "day"))
    assert rounded(rollup_up(rollup(some, "hour"), "day")) == whole
    assert rounded(rollup_up(rollup_up(rollup(some, "minute"), "hour"), "day")) == whole
    with pytest.raises(ValueError):
        rollup_up(rollup(some, "day"), "hour")


def test_label_counts_once_and_new_label_adds(spark, some):
    spec = agg(spark, buckets=4)
    for label in ("a", "a", "b"):
        rollups.load_agg(spark, spec, some, label)
    got = rollups.read_agg(spark, spec).agg(F.sum("reading_cnt")).first()[0]
    assert got == 2 * some.count()


def test_compaction_keeps_the_answer(spark, some):
    spec = agg(spark)
    for i in range(3):
        rollups.load_agg(spark, spec, some.filter(F.minute("event_time") % 3 == i), f"l{i}")
    changed = rollups.compact_agg(spark, spec, final=["l0", "l1"])
    assert changed and {s["load_label"] for s in catalog.partitions(spark, spec.table)} & {"l0", "l1"} == set()
    assert rounded(rollups.read_agg(spark, spec).drop("event_date")) == rounded(rollup(some, "hour"))


def test_refresh_changes_only_its_days(spark, some):
    spec = agg(spark, measures=("reading_cnt", "value_sum", "value_max"))
    rollups.refresh_rollup(spark, spec, some, ["2024-01-01", "2024-01-02", "2024-01-04"])
    rollups.refresh_rollup(spark, spec, some.withColumn("value", F.lit(1.0)), [date(2024, 1, 2)])
    got = rollups.read_agg(spark, spec)
    day = F.to_date("event_time")
    mixed = some.withColumn("value", F.when(day == "2024-01-02", 1.0).otherwise(F.col("value")))
    mixed = mixed.filter(day.isin(date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 4)))
    assert rounded(got.drop("event_date")) == rounded(rollup(mixed, "hour", measures=spec.measures))
    rollups.rebuild_agg(spark, spec, some.limit(0), "2024-01-01")
    assert rollups.read_agg(spark, spec).filter(F.col("event_date") == "2024-01-01").count() == 0


HOUR = Rollup("t.hour", "hour", measures=("reading_cnt", "value_sum", "value_max"), complete=True)
DAY = Rollup("t.day", "day", complete=True)
MINUTE = Rollup("t.minute", "minute", ("device_id", "metric", "site_code"), complete=True)


@pytest.mark.parametrize(
    "grain, dims, measures, start, end, expected",
    [
        ("day", ["metric"], ["value_sum"], "2024-01-01", "2024-01-03", [(DAY, "01 00:00", "03 00:00")]),
        ("day", ["metric"], ["value_sum"], "2024-01-01 05:00:00", "2024-01-03", [(DAY, "02 00:00", "03 00:00"), (HOUR, "01 05:00", "02 00:00")]),
        ("hour", ["metric"], ["value_max"], "2024-01-01", "2024-01-03", [(HOUR, "01 00:00", "03 00:00")]),
        ("hour", ["metric"], ["value_min"], "2024-01-01", "2024-01-03", [(MINUTE, "01 00:00", "03 00:00")]),
        ("hour", ["metric"], ["value_avg"], "2024-01-01", "2024-01-03", [(MINUTE, "01 00:00", "03 00:00")]),
        ("hour", ["metric"], ["avg_per_reading"], "2024-01-01", "2024-01-03", [(HOUR, "01 00:00", "03 00:00")]),
        ("day", ["site_code"], ["value_sum"], "2024-01-01", "2024-01-03", [(MINUTE, "01 00:00", "03 00:00")]),
        ("hour", ["metric"], ["value_sum"], "2024-01-01 05:30:00", "2024-01-01 07:30:30",
         [(HOUR, "01 06:00", "01 07:00"), (MINUTE, "01 05:30", "01 06:00"), (MINUTE, "01 07:00", "01 07:30"), (None, "01 07:30", "01 07:30:30")]),
        ("day", ["serial"], ["value_sum"], "2024-01-01", "2024-01-03", [(None, "01 00:00", "03 00:00")]),
        (None, ["metric"], ["value_min"], "2024-01-01", "2024-01-03", [(DAY, "01 00:00", "03 00:00")]),
        (None, ["metric"], ["value_sum"], "2024-01-03", "2024-01-03", []),
    ],
)
def test_route(spark, grain, dims, measures, start, end, expected):
    got = rollups.route(spark, [HOUR, DAY, MINUTE], grain, dims, measures, start, end)
    assert got == [(spec, at(f"2024-01-{a}"), at(f"2024-01-{b}")) for spec, a, b in expected]


def test_an_unknown_rollup_is_not_trusted(spark, some):
    """Loaded up to a day only: the rest comes from the readings."""
    spec = agg(spark)
    rollups.load_agg(spark, spec, some.filter("event_time < '2024-01-02'"), "a")
    args = ("day", ["metric"], ["reading_cnt"], "2024-01-01", "2024-01-05")
    assert rounded(rollups.rollup_query(spark, some, [spec], *args)) == rounded(rollups.rollup_query(spark, some, [], *args))


def test_stale_days_are_answered_by_the_readings(spark, some):
    table = raw_table(spark)
    raw.load_batch(spark, table, some, "l")
    device = spark.createDataFrame([(i, f"s{i % 2}") for i in range(5)], "device_id bigint, site_code string")
    dim = f"{table}_dim"
    dims.create_dim(spark, dim)
    dims.upsert(spark, dim, device)
    spec = Rollup(f"{table}_agg", "day", ("site_code", "metric"))
    rollups.create_agg(spark, spec)
    days = raw.days_of_label(spark, table, "l")

    def refresh(which):
        rollups.refresh_rollup(
            spark, spec, raw.readings_of(spark, table), which, dims.read_dim(spark, dim), table, dim
        )

    def check(expected_fresh, **asked):
        rows, now = raw.readings_of(spark, table), dims.read_dim(spark, dim)
        args = ("day", ["site_code"], [*MEASURES, "value_avg"], "2024-01-01 10:30:00", "2024-01-05")
        routed = rollups.rollup_query(spark, rows, [spec], *args, source=table, dim=now, dim_table=dim, **asked)
        assert rounded(routed) == rounded(rollups.rollup_query(spark, rows, [], *args, dim=now, **asked))
        assert rollups.fresh_days(spark, spec, table, "2024-01-01", "2024-01-05", dim) == expected_fresh

    check([])
    refresh(days[:3])
    check(days[:3])
    check(days[:3], where={"metric": ["a"], "site_code": ["s1"]})
    raw.overwrite_day(spark, table, some.filter("to_date(event_time) = '2024-01-02'").limit(3), "2024-01-02")
    check([days[0], days[2]])
    refresh(["2024-01-02"])
    check(days[:3])
    dims.upsert(spark, dim, device.withColumn("site_code", F.lit("moved")))
    check([])
    with pytest.raises(ValueError, match="site_code"):
        rollups.rollup_query(spark, some, [], "day", ["site_code"], ["value_sum"], "2024-01-01", "2024-01-05")


def test_versions_are_folded_by_day_without_reading_columns(spark, some):
    """One row a day whatever the number of files; another file or another dimension is another version."""
    table = raw_table(spark)
    raw.load_batch(spark, table, some, "l")
    first = rollups.versions(spark, table, "2024-01-01", "2024-01-03")
    assert sorted(first) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert rollups.versions(spark, table, "2024-01-01", "2024-01-03") == first
    raw.load_batch(spark, table, some.filter("to_date(event_time) = '2024-01-02'").limit(1), "more")
    now = rollups.versions(spark, table, "2024-01-01", "2024-01-03")
    assert {day for day in first if first[day] != now[day]} == {"2024-01-02"}
    # The same label again has the same rows in other files.
    raw.load_batch(spark, table, some, "l")
    assert all(v != now[day] for day, v in rollups.versions(spark, table, "2024-01-01", "2024-01-03").items())
    assert rollups.versions(spark, table, "2025-01-01", "2025-01-03") == {}


def test_routed_answers_equal_the_readings(spark, some):
    specs = [replace(agg(spark, grain), complete=True) for grain in ("hour", "day", "minute")]
    for spec in specs:
        rollups.load_agg(spark, spec, some.filter(F.col("device_id") < 3), "a")
        rollups.load_agg(spark, spec, some.filter(F.col("device_id") >= 3), "b")
    measures = [*MEASURES, "value_avg", "avg_per_reading"]
    for grain, start, end in [
        ("day", "2024-01-02", "2024-01-04"),
        ("day", "2024-01-01 05:00:00", "2024-01-03 17:00:00"),
        ("hour", "2024-01-01 05:21:00", "2024-01-03 17:02:00"),
        ("hour", "2024-01-01 05:21:07", "2024-01-03 17:02:00"),
        (None, "2024-01-01 05:21:00", "2024-01-03 17:02:00"),
    ]:
        args = (grain, ["metric"], measures, start, end)
        routed = rollups.rollup_query(spark, some, specs, *args)
        assert rounded(routed) == rounded(rollups.rollup_query(spark, some, [], *args))


def test_minute_rollup_reads_only_the_hours_asked_for(spark, some):
    spec = replace(agg(spark, "minute"), complete=True)
    rollups.load_agg(spark, spec, some, "a")
    df = rollups.rollup_query(
        spark, some, [spec], "minute", ["metric"], ["value_sum"], "2024-01-01 05:00:00", "2024-01-01 07:00:00"
    )
    df.collect()
    assert "event_hour_key" in plan(df).split("PartitionFilters")[1].split("\n")[0]
    files = {f.rsplit("event_hour_key=", 1)[1][:13] for f in spark.table(spec.table).filter(
        F.col("event_hour_key").between("2024-01-01-05", "2024-01-01-06")).inputFiles()}
    assert files <= {"2024-01-01-05", "2024-01-01-06"}


def test_timeseries_has_no_empty_buckets(spark):
    rows = [("2024-01-01 00:10:00", 1, "m", 1.0), ("2024-01-01 02:00:00", 1, "m", 2.0)]
    got = timeseries(readings(spark, rows), "hour", "2024-01-01", "2024-01-01 02:00:00").collect()
    assert [(r.reading_cnt, r.value_sum) for r in got] == [(1, 1.0)]


def test_days_of_a_load(spark, some):
    table = raw_table(spark)
    raw.load_batch(spark, table, some, "l")
    assert raw.days_of_label(spark, table, "l") == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
