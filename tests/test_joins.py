import pytest
from pyspark.sql import functions as F

from gaugeline.operators import (
    colocated_join, enrich, enriched_rollup, groupby_dims, hot_keys, rollup, site_topn, topn, with_device,
)
from gaugeline.plans import dimension as dims
from gaugeline.plans import raw
from gaugeline.plans.rollups import rollup_query
from gaugeline.schemas import DEVICE
from helpers import executed, lake, plan, readings

LIMIT = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set(LIMIT, "-1")
    yield
    spark.conf.unset(LIMIT)


@pytest.fixture(scope="module")
def fact(spark):
    """A third of all readings come from device 1; some devices are not in the dimension."""
    rows = spark.range(6000).select(
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=F.col("id") * 40)).alias("event_time"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 120).cast("bigint").alias("device_id"),
        F.lit("m").alias("metric"),
        (F.col("id") % 100).cast("double").alias("value"),
    )
    table = f"{lake(spark)}.raw"
    raw.create_raw(spark, table, 16)
    raw.load_batch(spark, table, rows, "l")
    return table


@pytest.fixture(scope="module")
def dim(spark):
    table = f"{lake(spark)}.dim"
    dims.create_dim(spark, table)
    rows = [(i, f"d{i}", f"s{i % 4}", 0.0, 0.0, i % 2 == 0, None) for i in range(100)]
    dims.upsert(spark, table, spark.createDataFrame(rows, DEVICE))
    return table


def facts(spark, fact):
    return raw.readings_of(spark, fact)


def test_small_dimension_is_broadcast(spark, fact, dim):
    df = with_device(facts(spark, fact), dims.read_dim(spark, dim))
    assert "BroadcastHashJoin" in executed(df)


def test_large_dimension_is_shuffled(spark, fact, no_broadcast):
    other = spark.range(200).withColumnRenamed("id", "device_id")
    df = with_device(facts(spark, fact).select("device_id", "value"), other.filter("device_id > 0"))
    assert "SortMergeJoin" in plan(df) and "Exchange" in plan(df)


def test_bucketed_tables_join_without_a_shuffle(spark, fact, dim, no_broadcast):
    df = with_device(facts(spark, fact), dims.read_dim(spark, dim))
    assert "SortMergeJoin" in plan(df) and "Exchange" not in plan(df)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_device_is_joined_apart(spark, fact, dim, no_broadcast, how):
    left, right = facts(spark, fact), dims.read_dim(spark, dim)
    assert hot_keys(left) == [1]
    df = colocated_join(left, right, how)
    text = plan(df)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" in text
    # The only exchange is the broadcast of the hot device's row.
    assert "hashpartitioning" not in text
    cols = ["event_time", "device_id", "site_code", "value"]
    expected = left.join(right, "device_id", how).select(cols).collect()
    assert sorted(map(repr, df.select(cols).collect())) == sorted(map(repr, expected))


def test_no_hot_device_no_second_branch(spark, fact, dim, no_broadcast):
    calm = facts(spark, fact).filter("device_id <> 1")
    assert hot_keys(calm) == []
    assert "Union" not in plan(colocated_join(calm, dims.read_dim(spark, dim)))


def test_null_keys_stay_in_a_left_join(spark):
    left = spark.createDataFrame([(None, 1.0)] + [(1, 2.0)] * 5, "device_id bigint, value double")
    right = spark.createDataFrame([(1, "s")], "device_id bigint, site_code string")
    got = colocated_join(left, right, "left")
    assert got.count() == 6


def test_a_grouped_bucketed_table_is_not_read_by_bucket(spark, fact):
    """Else a hot device would be summed by the one task of its bucket."""
    for df in (
        rollup(facts(spark, fact), "hour"),
        topn(facts(spark, fact), "device_id", "m", 3),
        groupby_dims(facts(spark, fact), [], ["device_id"]),
        rollup_query(spark, facts(spark, fact), [], None, ["device_id"], ["value_sum"], "2024-01-01", "2024-02-01"),
    ):
        assert "Bucketed: true" not in plan(df)


def test_unknown_devices_survive_enrichment(spark):
    rows = readings(spark, [("2024-01-01 00:00:00", 1, "m", 1.0), ("2024-01-01 00:00:00", 7, "m", 1.0)])
    dim = spark.createDataFrame([(1, "home")], "device_id bigint, site_code string")
    got = {r.device_id: r.site_code for r in enrich(rows, dim).collect()}
    assert got == {1: "home", 7: None}
    own = rows.withColumn("site_code", F.when(F.col("device_id") == 1, "own"))
    got = {r.device_id: r.site_code for r in enrich(own, dim).collect()}
    assert got == {1: "own", 7: None}


def test_enriched_rollup_equals_enrich_then_rollup(spark, fact, dim):
    keys = ("device_id", "metric", "site_code")
    left, right = facts(spark, fact), dims.read_dim(spark, dim)
    part = left.withColumn("site_code", F.when(F.col("value") < 30, F.lit("s1")))  # some carry a site
    for rows in (left, part):
        for some_keys in (keys, ("metric", "site_code")):
            got = enriched_rollup(rows, right, "day", some_keys)
            expected = rollup(enrich(rows, right), "day", some_keys)
            assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.select(got.columns).collect()))


def test_enriched_rollup_folds_before_the_join(spark, fact, dim):
    text = plan(enriched_rollup(facts(spark, fact), dims.read_dim(spark, dim), "hour"))
    tree = text.split("\n\n")[0]
    assert tree.index("Join") < tree.index("HashAggregate") < tree.index("Scan parquet")


def test_groupby_dims_equals_join_then_group(spark, fact, dim):
    left, right = facts(spark, fact), dims.read_dim(spark, dim)
    sites = spark.createDataFrame([(f"s{i}", f"r{i % 2}") for i in range(4)], "site_code string, region string")
    got = groupby_dims(left, [(right, "device_id"), (sites, "site_code")], ["region", "metric"])
    joined = left.join(right, "device_id").join(sites, "site_code")
    expected = joined.groupBy("region", "metric").agg(
        F.count("*").alias("reading_cnt"), F.count("value").alias("value_cnt"), F.sum("value").alias("value_sum"),
        F.max("value").alias("value_max"), F.min("value").alias("value_min"))
    assert sorted(got.select(*expected.columns).collect()) == sorted(expected.collect())


def test_groupby_dims_from_a_rollup(spark, fact, dim):
    left, right = facts(spark, fact), dims.read_dim(spark, dim)
    args = ([(right, "device_id")], ["site_code"])
    a = groupby_dims(left, *args)
    b = groupby_dims(rollup(left, "hour"), *args)
    assert sorted(a.collect()) == sorted(b.select(*a.columns).collect())


def test_topn_ties_go_to_the_lower_device(spark):
    rows = [("2024-01-01 00:00:00", d, "m", v) for d, v in [(5, 0.1), (5, 0.2), (3, 0.3), (4, 0.3), (9, None)]]
    df = readings(spark, rows + [("2024-01-01 00:00:00", 1, "other", 99.0)])
    assert [r.device_id for r in topn(df, "device_id", "m", 4).collect()] == [3, 4, 5, 9]
    dim = spark.createDataFrame([(d, "s") for d in (1, 3, 4, 5, 9)], "device_id bigint, site_code string")
    got = site_topn(df, dim, "m", 2).orderBy("rank").collect()
    assert [(r.rank, r.device_id) for r in got] == [(1, 3), (2, 4)]


def test_site_topn_limits_each_task(spark, fact, dim):
    assert "WindowGroupLimit" in plan(site_topn(facts(spark, fact), dims.read_dim(spark, dim), "m", 2))


def test_a_colocated_join_does_not_turn_into_a_broadcast(spark, fact, dim):
    """Also below the broadcast limit: the caller asked for the bucketed join."""
    text = plan(colocated_join(facts(spark, fact), dims.read_dim(spark, dim), hot=[]))
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert text.count("SelectedBucketsCount: 16 out of 16") == 2


def test_ranks_do_not_depend_on_the_size_of_values(spark):
    rows = [("2024-01-01 00:00:00", 1, "m", 1e-9), ("2024-01-01 00:00:00", 2, "m", 4e-7), ("2024-01-01 00:00:00", 3, "m", -5e9)]
    got = [r.device_id for r in topn(readings(spark, rows), "device_id", "m", 3).collect()]
    assert got == [2, 1, 3]


def test_a_column_of_fact_and_dimension(spark):
    fact = spark.createDataFrame([(1, "own", 1.0), (1, None, 2.0), (2, None, 4.0)], "device_id bigint, site_code string, value double")
    dim = spark.createDataFrame([(1, "dim"), (2, "dim")], "device_id bigint, site_code string")
    got = groupby_dims(fact, [(dim, "device_id")], ["site_code"], ["value_sum"]).collect()
    assert {r.site_code: r.value_sum for r in got} == {"own": 1.0, "dim": 6.0}


@pytest.mark.parametrize("buckets", [16, 64])
def test_what_is_hot_depends_on_the_buckets(spark, buckets):
    """A device with half a bucket's share of the rows."""
    rows = spark.range(12800).select(F.when(F.col("id") < 12800 // buckets, -1).otherwise(F.col("id")).alias("device_id"))
    assert hot_keys(rows, buckets=buckets) == [-1] and hot_keys(rows, buckets=buckets // 4) == []
