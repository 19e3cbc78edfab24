"""Random sequences of loads, crashes, backfills and compactions lose nothing and double nothing."""

from datetime import timedelta
from random import Random

import pytest

from gaugeline.plans import catalog, raw, watermark
from gaugeline.plans import ingest as loads
from gaugeline.plans.ingest import ingest_all, ingest_increment
from helpers import at, content, lake, raw_table, readings, rows_of

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05"]


class Died(RuntimeError):
    pass


def die(*args, **kw):
    raise Died


@pytest.mark.parametrize("seed, buckets", [(1, 0), (2, 4), (3, 0)])
def test_random_operations(spark, monkeypatch, seed, buckets):
    rng = Random(seed)
    table, control = raw_table(spark, buckets), f"{lake(spark)}.control"
    watermark.create_control(spark, control)
    rows, clock = [], at(DAYS[0])
    late_day = None

    def grow():
        nonlocal clock
        for _ in range(rng.randrange(1, 12)):
            clock += timedelta(minutes=rng.choice([0, 0, 7, 200]))  # ties are common
            rows.append((str(min(clock, at("2024-01-05 23:59:00"))), rng.randrange(5), "m", rng.random()))

    def arrive_late():
        nonlocal late_day
        late_day = DAYS[0]
        rows.append((f"{DAYS[0]} 00:00:00.5", 9, "late", rng.random()))

    def source():
        return readings(spark, rows)

    def mark():
        return watermark.get_watermark(spark, control, "job", "1970-01-01")

    def ingest():
        ingest_increment(spark, source(), table, control, "job", rng.choice([1, 5, 20, None]))

    def ingest_and_die():
        with monkeypatch.context() as m:
            m.setattr(loads, "set_watermark", die)
            try:
                ingest()
            except Died:
                pass

    def days():
        first, last = sorted(rng.sample(range(len(DAYS) + 1), 2))
        ends = [*DAYS, "2024-01-06"]
        return ends[first], ends[last]

    def backfill():
        raw.backfill(spark, table, source(), *days(), upto=mark())

    def compact():
        raw.compact(spark, table, *days(), upto=mark())

    def die_in(change):
        with monkeypatch.context() as m:
            m.setattr(catalog, rng.choice(["add_partitions", "drop_partitions", "move_partitions", "stage", "write"]), die)
            try:
                change()
            except Died:
                pass

    def json_batch():
        """A batch of its own, sent again and again; its days lie after all others."""
        sent.append(rng.randrange(3))
        day = readings(spark, [(f"2024-02-0{sent[-1] + 1} 00:00:00", 7, "json", 1.0)])
        raw.load_batch(spark, table, day, f"json{sent[-1]}", done=True)

    def compact_json():
        raw.compact(spark, table, "2024-02-01", "2024-02-10")

    sent = []
    steps = [json_batch, compact_json, lambda: die_in(json_batch), lambda: die_in(ingest), grow, grow, ingest, ingest, ingest_and_die, backfill, compact, arrive_late,
             lambda: die_in(backfill), lambda: die_in(compact)]
    grow()
    for _ in range(18):
        rng.choice(steps)()
    for label in set(sent):  # what died is sent again
        raw.load_batch(spark, table, readings(spark, [(f"2024-02-0{label + 1} 00:00:00", 7, "json", 1.0)]), f"json{label}", done=True)
    rows += [(f"2024-02-0{label + 1} 00:00:00", 7, "json", 1.0) for label in set(sent)]
    ingest_all(spark, source().filter("metric <> 'json'"), table, control, "job", 10)
    if late_day:
        raw.backfill(spark, table, source(), late_day, DAYS[1], upto=mark())
    catalog.finish_swap(spark, table)
    assert content(spark, table) == rows_of(source())
