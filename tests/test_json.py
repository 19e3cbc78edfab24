import json
from pathlib import Path
from tempfile import mkdtemp

import pytest

from gaugeline.plans.ingest import load_json
from gaugeline.plans.rejects import ErrorBudgetExceeded, create_quarantine
from gaugeline.sources import conform, jdbc_options, kafka_options, read_json_batch
from gaugeline.sources.topic import read_stream
from helpers import raw_table

RECORDS = [
    {"event_time": "2024-01-01T00:00:00Z", "device_id": 1, "metric": "power_kw", "value": 1.5, "site_code": "s"},
    {"event_time": "2024-01-01T02:00:00+02:00", "device_id": 2, "metric": "temp_c", "value": None},
    {"event_time": "2024-01-01 00:00:01.25", "device_id": 3, "metric": "[x]", "value": -2e-3, "extra": {"a": [1]}},
]


def good_rows(df):
    good, bad = conform(df)
    assert bad.count() == 0
    return sorted((r.device_id, r.metric, r.value, r.site_code, r.event_time.isoformat()) for r in good.collect())


def files(*texts):
    folder = Path(mkdtemp(prefix="gaugeline-json-"))
    for i, text in enumerate(texts):
        (folder / f"{i}.json").write_text(text)
    return str(folder)


def test_array_and_lines_hold_the_same(spark):
    lines = files("\n".join(json.dumps(r) for r in RECORDS) + "\n\n")
    array = files("  " + json.dumps(RECORDS, indent=2) + "\n", "[]")
    a, b = good_rows(read_json_batch(spark, array, array=True)), good_rows(read_json_batch(spark, lines, array=False))
    assert a == b and len(a) == 3
    assert [r[2] for r in a] == [1.5, None, -0.002]
    assert a[1][4] == "2024-01-01T00:00:00"


def test_the_wrong_flag_raises(spark):
    lines = files("\n".join(json.dumps(r) for r in RECORDS))
    array = files(json.dumps(RECORDS, indent=2))
    one_line = files(json.dumps(RECORDS))
    for path, flag in [(lines, True), (array, False), (one_line, False), (files('[{"a": 1}, {"a"'), True)]:
        with pytest.raises(Exception, match="JSON array"):
            read_json_batch(spark, path, array=flag).collect()


BAD = {
    '{"event_time": "soon", "device_id": 1, "metric": "m"}': "event_time invalid",
    '{"event_time": "12:30", "device_id": 1, "metric": "m"}': "event_time invalid",
    '{"event_time": "T12:30:01", "device_id": 1, "metric": "m"}': "event_time invalid",
    '{"event_time": "2024", "device_id": 1, "metric": "m"}': "event_time invalid",
    '{"event_time": "2024-01-01", "device_id": 1, "metric": "m"}': "event_time invalid",
    '{"event_time": "2024-1-1 1:2:3", "device_id": 1, "metric": "m"}': "event_time invalid",
    '{"event_time": "2024-13-01 01:02:03", "device_id": 1, "metric": "m"}': "event_time invalid",
    '{"event_time": "2024-01-01T00:00:00Z", "metric": "m", "value": 1}': "device_id missing",
    '{"event_time": "2024-01-01T00:00:00Z", "device_id": null, "metric": "m"}': "device_id missing",
    '{"event_time": "2024-01-01T00:00:00Z", "device_id": "x1", "metric": "m"}': "device_id invalid",
    '{"event_time": "2024-01-01T00:00:00Z", "device_id": 1.5, "metric": "m"}': "device_id invalid",
    '{"event_time": "2024-01-01T00:00:00Z", "device_id": 1}': "metric missing",
    '{"event_time": "2024-01-01T00:00:00Z", "device_id": 1, "metric": "%s"}' % ("m" * 65): "metric too long",
    '{"event_time": "2024-01-01T00:00:00Z", "device_id": 1, "metric": "m", "site_code": "%s"}' % ("s" * 33): "site_code too long",
    "not JSON": "not a JSON object",
    '{"event_time": "2024-01-01T00:00:00Z", "device_id": 1, "metric": "m"': "not a JSON object",
    '[{"event_time": "2024-01-01T00:00:00Z", "device_id": 1, "metric": "m"}]': "not a JSON object",
    "7": "not a JSON object",
    "": "not a JSON object",
}


def test_rejects_and_their_reasons(spark):
    df = spark.createDataFrame([(k,) for k in BAD], "value string")
    good, bad = conform(df)
    assert good.count() == 0
    assert {r.payload: r.reason for r in bad.collect()} == BAD


@pytest.mark.parametrize("value, expected", [('"n/a"', None), ('"2.5"', 2.5), ('"NaN"', None), ('"Infinity"', None),
                                             ("1e3", 1000.0), ("true", None), ('{"a": 1}', None), ('""', None)])
def test_an_odd_value_costs_the_value_only(spark, value, expected):
    text = '{"value": %s, "event_time": "2024-01-01T00:00:00Z", "device_id": 1, "metric": "m"}' % value
    good, bad = conform(spark.createDataFrame([(text,)], "value string"))
    assert bad.count() == 0 and good.first().value == expected


def test_a_batch_sent_twice_counts_once(spark):
    table = raw_table(spark)
    first = load_json(spark, table, files(json.dumps(RECORDS)), array=True)
    again = load_json(spark, table, files(json.dumps(RECORDS[2:]), json.dumps(RECORDS[:2])), array=True)
    assert first == again and spark.table(table).count() == 3
    other = load_json(spark, table, files(json.dumps(RECORDS + RECORDS[:1])), array=True)
    assert other != first and spark.table(table).count() == 7


def test_a_batch_with_bad_rows_loads_nothing_beyond_the_budget(spark):
    table = raw_table(spark)
    create_quarantine(spark, f"{table}_bad")
    path = files("\n".join([*map(json.dumps, RECORDS), "junk", '{"metric": "m"}']))
    with pytest.raises(ErrorBudgetExceeded, match="2 malformed messages, limit 0"):
        load_json(spark, table, path, array=False)
    assert spark.table(table).count() == 0
    load_json(spark, table, path, array=False, max_errors=2, quarantine=f"{table}_bad")
    assert (spark.table(table).count(), spark.table(f"{table}_bad").count()) == (3, 2)


def test_topic_options():
    options = kafka_options("b:9092", "t", 500, 3, groupIdPrefix="x")
    assert options == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "t", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "500", "minPartitions": "3", "failOnDataLoss": "true", "groupIdPrefix": "x",
    }


def test_jdbc_options():
    options = jdbc_options("jdbc:postgresql://h/db", "sensor_readings", "2024-01-01", "2024-02-01", 31, user="u")
    assert options["numPartitions"] == "31" and options["partitionColumn"] == "event_time"
    assert options["pushDownPredicate"] == "true" and options["user"] == "u"


def test_stream_source_yields_text(spark):
    source = read_stream(spark, "text", {"path": files("a\n")})
    assert source.isStreaming and source.dtypes == [("value", "string")]


@pytest.fixture
def tiny_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for key, value in zip(before, ("700", "1")):
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_an_array_is_read_in_splits(spark, tiny_splits):
    """Braces and quotes in texts, inner objects, and splits anywhere."""
    odd = ['}{"', "a\\", '\\"}', "{{", "}", "\n]", "[{", "é}漢", ""]
    records = [{"n": i, "t": odd[i % len(odd)] * (i % 4), "o": {"p": {"q": [i, {}]}} if i % 3 else None} for i in range(400)]
    for indent in (None, 3):
        df = read_json_batch(spark, files(json.dumps(records, indent=indent, ensure_ascii=False), "[]", " [ ] ", ""), array=True)
        assert df.rdd.getNumPartitions() > 1
        got = sorted((json.loads(r.value) for r in df.collect()), key=lambda r: r["n"])
        assert got == records


def test_what_is_no_object_is_passed_on(spark):
    got = [r.value for r in read_json_batch(spark, files('[1, {"a": 2}, null , {"b": 3}, 4, 5]', "[7]"), array=True).collect()]
    assert sorted(got) == sorted(["1", '{"a": 2}', "null", '{"b": 3}', "4, 5", "7"])


@pytest.mark.parametrize("torn", ['[{"a": 1}', '[{"a": 1},{"b"', '[{"a": "x} y', '[{"a": {"b": 1}', '[{"a": 1}{"b": 2}]', '[{"a": 1}] x', '{"a": 1}]', '[{"a": 1}]]{', "7"])
def test_a_torn_array_raises(spark, torn):
    with pytest.raises(Exception, match="JSON array"):
        read_json_batch(spark, files(torn, json.dumps(RECORDS)), array=True).collect()
