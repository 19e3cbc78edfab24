"""Declared schemas. Nothing is ever inferred."""

from pyspark.sql import types as T

READING_COLS = ["event_time", "device_id", "metric", "value"]

READING = T.StructType(
    [
        T.StructField("event_time", T.TimestampType(), False),
        T.StructField("device_id", T.LongType(), False),
        T.StructField("metric", T.StringType(), False),
        T.StructField("value", T.DoubleType()),
    ]
)

# The stream's shape: a reading plus the optional site it was taken at.
STREAM_READING = T.StructType([*READING.fields, T.StructField("site_code", T.StringType())])

DEVICE = T.StructType(
    [
        T.StructField("device_id", T.LongType(), False),
        T.StructField("device_name", T.StringType()),
        T.StructField("site_code", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

# A change of a device: the row, and whether to upsert (0) or delete (1) it.
DEVICE_CHANGE = T.StructType([*DEVICE.fields, T.StructField("__op", T.IntegerType(), False)])

WATERMARK = T.StructType(
    [
        T.StructField("job_key", T.StringType(), False),
        T.StructField("watermark", T.StringType(), False),
        T.StructField("updated_at", T.TimestampType(), False),
    ]
)

# Results must equal these.
MAX_LENGTH = {"metric": 64, "device_name": 128, "site_code": 32}
SORT_KEY = ["event_time", "device_id", "metric"]
BUCKETS = 16
BATCH_LIMIT = 200_000
WATERMARK_FLOOR = "1970-01-01 00:00:00"
LIVE_DAYS = 90
LABEL_CHARS = "A-Za-z0-9_-"
LABEL_LENGTH = 128


def ddl(schema: T.StructType) -> str:
    """Column list for ``CREATE TABLE``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def as_strings(schema: T.StructType) -> T.StructType:
    """The same field names, all text: a bad field then costs that field and not the row."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
