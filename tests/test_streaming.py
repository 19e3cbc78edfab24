import json
import os
from pathlib import Path
from tempfile import mkdtemp

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import rollup
from gaugeline.operators.rollup import STREAM_KEYS
from gaugeline.plans import catalog, rollups
from gaugeline.plans.rollups import Rollup
from gaugeline.sources import read_stream
from gaugeline.streaming import (
    StreamJob, compact_stream_rollup, create_quarantine, jobs, stream_raw, stream_rollup, stream_rollup_bounded,
)
from helpers import content, lake, raw_table, readings, rows_of

ONCE = {"availableNow": True}


class Topic:
    """A folder of JSON lines; every ``send`` is one file, every file one micro-batch."""

    def __init__(self, spark):
        self.spark, self.n = spark, 0
        self.root = Path(mkdtemp(prefix="gaugeline-topic-"))
        (self.root / "in").mkdir()
        self.checkpoint = str(self.root / "checkpoint")

    def send(self, rows, junk=0):
        keys = ["event_time", "device_id", "metric", "value", "site_code"]
        lines = [json.dumps(dict(zip(keys, r))) for r in rows] + ["junk"] * junk
        path = self.root / "in" / f"{self.n:04d}.json"
        path.write_text("\n".join(lines))
        os.utime(path, (1_700_000_000 + self.n,) * 2)  # files are taken by age
        self.n += 1

    def source(self):
        return read_stream(self.spark, "text", {"path": str(self.root / "in"), "maxFilesPerTrigger": "1"})


def quarantine(spark, table):
    create_quarantine(spark, f"{table}_bad")
    return f"{table}_bad"


def rows(minute, n=3, device=1):
    return [(f"2024-01-01 00:{minute:02d}:{s:02d}", device, "m", float(s)) for s in range(n)]


def test_resumes_from_its_checkpoint(spark):
    topic, table = Topic(spark), raw_table(spark)

    def run():
        stream_raw(spark, topic.source(), table, "raw", topic.checkpoint, 0, trigger=ONCE).awaitTermination()

    topic.send(rows(1))
    topic.send(rows(2))
    run()
    run()
    topic.send(rows(3))
    run()
    assert content(spark, table) == rows_of(readings(spark, rows(1) + rows(2) + rows(3)))
    assert {s["load_label"] for s in catalog.partitions(spark, table)} == {jobs.batch_label("raw", i) for i in range(3)}


def test_error_budget(spark):
    topic, table = Topic(spark), raw_table(spark)
    bad = f"{table}_bad"
    create_quarantine(spark, bad)

    def run(**kw):
        stream_raw(
            spark, topic.source(), table, "raw", topic.checkpoint, quarantine=bad, trigger=ONCE, **kw
        ).awaitTermination()

    topic.send(rows(1), junk=100)
    run()
    assert spark.table(bad).count() == 100
    topic.send(rows(2), junk=101)
    for _ in range(2):  # it meets the same batch again until the budget is raised
        with pytest.raises(Exception, match="101 malformed messages, limit 100"):
            run()
        assert content(spark, table) == rows_of(readings(spark, rows(1)))
        assert spark.table(bad).count() == 100
    run(max_errors=101)
    assert content(spark, table) == rows_of(readings(spark, rows(1) + rows(2)))
    assert spark.table(bad).count() == 201


def test_a_replayed_batch_counts_once(spark, monkeypatch):
    topic = Topic(spark)
    spec = Rollup(f"{lake(spark)}.agg", "minute", STREAM_KEYS)
    rollups.create_agg(spark, spec)
    real = jobs.load_agg

    def load_and_die(*args):
        real(*args)
        raise RuntimeError("died after the write")

    topic.send(rows(1))
    with monkeypatch.context() as m:
        m.setattr(jobs, "load_agg", load_and_die)
        with pytest.raises(Exception, match="died after the write"):
            stream_rollup(spark, topic.source(), spec, "j", topic.checkpoint, None, 0, trigger=ONCE).awaitTermination()
    assert rollups.read_agg(spark, spec).first().reading_cnt == 3
    stream_rollup(spark, topic.source(), spec, "j", topic.checkpoint, None, 0, trigger=ONCE).awaitTermination()
    assert rollups.read_agg(spark, spec).first().reading_cnt == 3


def test_late_rows_enter_the_rollup(spark):
    topic = Topic(spark)
    spec = Rollup(f"{lake(spark)}.agg", "minute", STREAM_KEYS)
    rollups.create_agg(spark, spec)
    dim = spark.createDataFrame([(1, "home")], "device_id bigint, site_code string")
    sent = [rows(1), rows(50), rows(1, 5), rows(2, device=9)]
    for batch in sent:
        topic.send(batch)
    stream_rollup(spark, topic.source(), spec, "j", topic.checkpoint, dim, 0, trigger=ONCE).awaitTermination()
    expected = rollup(readings(spark, sum(sent, [])), "minute")

    def seen(df):
        return sorted((str(r.event_minute), r.device_id, r.reading_cnt, r.value_sum) for r in df.collect())

    stored = rollups.read_agg(spark, spec)
    assert seen(stored) == seen(expected)
    assert {(r.device_id, r.site_code) for r in stored.collect()} == {(1, "home"), (9, None)}
    # All but the newest micro-batch may be merged.
    assert compact_stream_rollup(spark, spec) == ["2024-01-01-00"]
    labels = {s["load_label"] for s in catalog.partitions(spark, spec.table)}
    assert len(labels) == 2 and jobs.batch_label("j", 3) in labels
    assert seen(rollups.read_agg(spark, spec)) == seen(expected)


def test_bounded_rollup_emits_passed_minutes(spark):
    topic = Topic(spark)
    for batch in (rows(1), rows(30), rows(31), rows(2), rows(50)):  # minute 2 comes too late
        topic.send(batch)
    out = str(topic.root / "out")
    dim = spark.createDataFrame([(1, "home")], "device_id bigint, site_code string")
    bad = quarantine(spark, f"{lake(spark)}.bounded")
    topic.send(rows(51), junk=2)
    for query in stream_rollup_bounded(
        spark, topic.source(), out, "bounded", topic.checkpoint, bad, "10 minutes", dim, 2, ONCE
    ):
        query.awaitTermination()
    assert spark.table(bad).count() == 2
    stored = spark.read.parquet(out).collect()
    got = sorted(str(r.event_minute)[14:16] for r in stored)
    assert got == ["01", "30", "31"] and {r.site_code for r in stored} == {"home"}
    topic.send([], junk=3)
    rollup_query, rejects = stream_rollup_bounded(
        spark, topic.source(), out, "bounded", topic.checkpoint, bad, "10 minutes", dim, 2, ONCE
    )
    rollup_query.awaitTermination()
    with pytest.raises(Exception, match="3 malformed messages, limit 2"):
        rejects.awaitTermination()


@pytest.mark.parametrize("kind", ["raw", "rollup"])
def test_partitions_stay_few_while_a_stream_runs(spark, monkeypatch, kind):
    """Sixty micro-batches into one hour, folded by the job itself; the last one replayed at the end."""
    monkeypatch.setattr(jobs, "FOLD", 4)
    topic = Topic(spark)
    sent = [rows(i % 60, 2, device=i) for i in range(60)]
    for batch in sent:
        topic.send(batch)
    if kind == "raw":
        table = raw_table(spark)
        start = lambda: stream_raw(spark, topic.source(), table, "s", topic.checkpoint, 0, trigger=ONCE)
    else:
        spec = Rollup(f"{lake(spark)}.agg", "minute", STREAM_KEYS)
        rollups.create_agg(spark, spec)
        table = spec.table
        start = lambda: stream_rollup(spark, topic.source(), spec, "s", topic.checkpoint, None, 0, trigger=ONCE)
    start().awaitTermination()
    held = [s["load_label"] for s in catalog.partitions(spark, table)]
    assert len(held) <= 4 * 4 and any(label.startswith("part2-") for label in held)
    for f in Path(topic.checkpoint, "commits").glob("*59*"):
        f.unlink()
    start().awaitTermination()
    expected = readings(spark, sum(sent, []))
    if kind == "raw":
        assert content(spark, table) == rows_of(expected)
    else:
        assert rollups.read_agg(spark, spec).agg(F.sum("reading_cnt")).first()[0] == 120


def test_rejects_need_a_place(spark):
    with pytest.raises(ValueError, match="quarantine"):
        stream_raw(spark, Topic(spark).source(), "t", "raw", "/nowhere")


def test_job_keys_are_safe(spark):
    for key in ("day", "part3", "a/b", ""):
        with pytest.raises(ValueError):
            stream_raw(spark, Topic(spark).source(), "t", key, "/nowhere", 0)


def test_show_pause_resume_stop(spark):
    topic, table = Topic(spark), raw_table(spark)
    now, bad = {"processingTime": "0 seconds"}, quarantine(spark, table)
    job = StreamJob(lambda: stream_raw(spark, topic.source(), table, "raw", topic.checkpoint, quarantine=bad, trigger=now), bad)
    assert job.show() == {"state": "NEW"}
    topic.send(rows(1))
    job.resume().processAllAvailable()
    shown = job.show()
    assert shown["state"] == "RUNNING" and shown["error"] is None
    assert shown["rejects"] == 0 and len(shown["lag"]) == 1
    job.pause()
    assert job.show()["state"] == "PAUSED"
    topic.send(rows(2))
    job.resume().processAllAvailable()
    assert spark.table(table).count() == 6
    topic.send([], junk=5)
    job.resume().processAllAvailable()
    assert job.show()["rejects"] == 5
    topic.send([], junk=101)
    with pytest.raises(Exception, match="101 malformed"):
        job.resume().processAllAvailable()
    assert job.show()["state"] == "FAILED" and "101 malformed" in job.show()["error"]
    job.stop()
    assert job.show()["state"] == "STOPPED"
    with pytest.raises(RuntimeError):
        job.resume()


def test_pacing_options(spark):
    topic, table = Topic(spark), raw_table(spark)
    for i in range(3):
        topic.send(rows(i))
    query = stream_raw(spark, topic.source(), table, "raw", topic.checkpoint, 0, trigger=ONCE)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert spark.table(table).agg(F.count("*")).first()[0] == 9
