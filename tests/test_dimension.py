import pytest
from pyspark.sql import functions as F

from gaugeline.operators import apply_changes, latest, serving
from gaugeline.plans import dimension as dims
from gaugeline.plans.rejects import create_quarantine
from gaugeline.schemas import DEVICE, DEVICE_CHANGE
from gaugeline.sources import conform
from helpers import lake, plan

STATE = "device_id bigint, site_code string, updated_at timestamp, seq bigint, __op int"


def changes(spark, rows):
    """(device, site, time, seq, op)"""
    text = spark.createDataFrame(rows, STATE.replace("updated_at timestamp", "updated_at string"))
    return text.withColumn("updated_at", F.col("updated_at").cast("timestamp"))


def served(state):
    return sorted((r.device_id, r.site_code) for r in serving(state).collect())


ORDER = ("updated_at", "seq")
T1, T2, T3, T4 = (f"2024-01-0{i} 00:00:00" for i in range(1, 5))

BATCHES = {
    "newest wins, also when the old one comes later": ([[(1, "b", T2, 1, 0)], [(1, "a", T1, 1, 0)]], [(1, "b")]),
    "delete": ([[(1, "a", T1, 1, 0)], [(1, None, T2, 1, 1)]], []),
    "delete then insert again": ([[(1, "a", T1, 1, 0)], [(1, None, T2, 1, 1)], [(1, "c", T3, 1, 0)]], [(1, "c")]),
    "delete of an unknown key": ([[(9, None, T1, 1, 1)]], []),
    "old update after a newer delete": ([[(1, None, T3, 1, 1)], [(1, "a", T2, 1, 0)]], []),
    "tie on time goes to the higher sequence": (
        [[(1, "a", T1, 2, 0), (1, "b", T1, 1, 0)], [(1, "c", T1, 1, 0)]],
        [(1, "a")],
    ),
    "no time is oldest": ([[(1, "a", T1, 1, 0)], [(1, "z", None, 9, 0)]], [(1, "a")]),
    "any time beats no time": ([[(1, "z", None, 9, 0)], [(1, "a", T1, 1, 0)]], [(1, "a")]),
    "same version again replaces": ([[(1, "a", T1, 1, 0)], [(1, "b", T1, 1, 0)]], [(1, "b")]),
    "several changes in one batch": (
        [[(1, "a", T1, 1, 0), (1, "d", T4, 1, 0), (1, "c", T3, 1, 1), (2, "x", T1, 1, 0)]],
        [(1, "d"), (2, "x")],
    ),
}


@pytest.mark.parametrize("name", BATCHES)
def test_upsert_order(spark, name):
    batches, expected = BATCHES[name]
    state = spark.createDataFrame([], STATE)
    for batch in batches:
        state = apply_changes(state, changes(spark, batch), order=ORDER)
    assert served(state) == expected


def test_a_replayed_batch_changes_nothing(spark):
    table = f"{lake(spark)}.dim"
    dims.create_dim(spark, table)
    batch = spark.createDataFrame(
        [(i, f"d{i}", "s", 1.0, 2.0, True, None) for i in range(20)], DEVICE
    ).withColumn("updated_at", F.lit(T1).cast("timestamp"))
    old = dims.upsert(spark, table, batch)
    assert old
    gone = batch.filter("device_id < 5").withColumns({"__op": F.lit(1), "updated_at": F.lit(T2).cast("timestamp")})
    for _ in range(2):
        dims.upsert(spark, table, gone)
    dims.upsert(spark, table, batch)  # the first batch again, older than the deletes
    assert dims.read_dim(spark, table).count() == 15
    assert spark.table(table).count() == 20


def test_a_failed_upsert_leaves_the_old_version(spark):
    table = f"{lake(spark)}.dim"
    dims.create_dim(spark, table)
    one = spark.createDataFrame([(1, "d", "s", 1.0, 2.0, True, None)], DEVICE)
    dims.upsert(spark, table, one)
    broken = one.withColumn("site_code", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        dims.upsert(spark, table, broken)
    assert dims.read_dim(spark, table).first().site_code == "s"


def test_latest_prunes_before_the_shuffle(spark):
    many = spark.range(1000).selectExpr("id % 3 device_id", "timestamp_seconds(id) updated_at", "'s' site_code")
    text = plan(latest(many))
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


@pytest.mark.parametrize("partitions", ["8", "200"])
def test_the_stored_state_is_not_shuffled(spark, partitions):
    table = f"{lake(spark)}.dim"
    dims.create_dim(spark, table)
    one = spark.createDataFrame([(1, "d", "s", 1.0, 2.0, True, None)], DEVICE).withColumn("__op", F.lit(0))
    dims.upsert(spark, table, one)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        text = plan(apply_changes(spark.table(table), one, buckets=16))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    tree = text.split("\n\n")[0]
    above_scan = tree[: tree.index("Scan parquet")].splitlines()
    join = next(i for i, line in enumerate(above_scan) if "SortMergeJoin" in line)
    assert not any("Exchange" in line for line in above_scan[join:])
    assert "SelectedBucketsCount: 16 out of 16" in text


def test_one_file_per_bucket(spark):
    table = f"{lake(spark)}.dim"
    dims.create_dim(spark, table)
    many = spark.range(1000).selectExpr("id device_id", "timestamp_seconds(id) updated_at")
    for _ in range(2):
        dims.upsert(spark, table, many)
    assert len(spark.table(table).inputFiles()) == 16


def test_changes_from_a_message_feed(spark):
    table = f"{lake(spark)}.dim"
    dims.create_dim(spark, table)
    sent = [
        '{"device_id": 1, "device_name": "a", "site_code": "s", "latitude": 1.5, "is_active": true, '
        '"updated_at": "2024-01-01T00:00:00Z", "__op": 0}',
        '{"device_id": 2, "site_code": "s", "updated_at": "2024-01-01T00:00:00Z", "__op": 0}',
        '{"device_id": 2, "updated_at": "2024-01-02T00:00:00Z", "__op": 1}',
        '{"device_id": 3, "site_code": "s"}',
    ]
    good, bad = conform(spark.createDataFrame([(x,) for x in sent], "value string"), DEVICE_CHANGE)
    dims.upsert(spark, table, good)
    row = dims.read_dim(spark, table).collect()
    assert [(r.device_id, r.device_name, r.latitude, r.is_active) for r in row] == [(1, "a", 1.5, True)]
    assert [r.reason for r in bad.collect()] == ["__op missing"]


def test_changes_that_cannot_be_applied(spark):
    """They fail the batch, or are set aside once however often the batch comes."""
    lake_ = lake(spark)
    table, bad = f"{lake_}.dim", f"{lake_}.bad"
    dims.create_dim(spark, table, spark.createDataFrame([], STATE).drop("__op").schema)
    create_quarantine(spark, bad)
    batch = changes(
        spark,
        [(1, "a", T1, 1, 0), (None, "a", T1, 1, 0), (5, "b", T1, 1, None), (6, "c", T1, 1, 2), (7, "s" * 33, T1, 1, 0), (8, "s" * 32, T1, 1, 0)],
    )
    with pytest.raises(ValueError, match="4 changes cannot be applied"):
        dims.upsert(spark, table, batch, order=ORDER)
    assert spark.table(table).count() == 0
    for _ in range(3):
        dims.upsert(spark, table, batch, order=ORDER, quarantine=bad)
        assert spark.table(table).count() == 2
    assert sorted(r.reason for r in spark.table(bad).collect()) == ["__op invalid"] * 2 + ["device_id missing", "site_code too long"]


def test_rejects_that_come_in_pairs_are_all_kept(spark):
    lake_ = lake(spark)
    table, bad = f"{lake_}.dim", f"{lake_}.bad"
    dims.create_dim(spark, table, spark.createDataFrame([], STATE).drop("__op").schema)
    create_quarantine(spark, bad)
    for name in ("aaa", "bbb"):
        batch = changes(spark, [(None, name, T1, 1, 0)] * 2)
        dims.upsert(spark, table, batch, order=ORDER, quarantine=bad)
    assert spark.table(bad).count() == 4


def test_a_load_keeps_the_version_it_began_with(spark):
    table = f"{lake(spark)}.dim"
    dims.create_dim(spark, table)
    one = spark.createDataFrame([(1, "d", "s1", 1.0, 2.0, True, None)], DEVICE)
    dims.upsert(spark, table, one.withColumn("updated_at", F.lit(T1).cast("timestamp")))
    notes = f"{table}_of"

    def site(label, job="j"):
        return dims.pinned(spark, table, notes, job, label).first().site_code

    assert site("j-1") == "s1"
    dims.upsert(spark, table, one.withColumns({"site_code": F.lit("s2"), "updated_at": F.lit(T2).cast("timestamp")}))
    assert site("j-1") == "s1" and site("k-1", "k") == "s2"
    assert site("j-2") == "s2" and spark.table(notes).count() == 2
