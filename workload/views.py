"""The given tables seen as readings, devices, device changes and messages.

``VIEWS`` states the same views as SQL for the comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = (
    "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
)
LINEITEM = "l_shipdate timestamp, l_suppkey bigint, l_returnflag string, l_quantity double"
ORDERS = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp, "
    "o_orderpriority string"
)
CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double"
NATION = "n_nationkey int, n_name string, n_regionkey int"
REGION = "r_regionkey int, r_name string"


def _table(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as readings; some have lost their value, as sensors do."""
    gap = F.col("event_id") % 17 == 0
    return _table(spark, sf_dir, "events", EVENTS).select(
        F.col("ts").alias("event_time"),
        F.col("user_id").alias("device_id"),
        F.col("event_type").alias("metric"),
        F.when(~gap, F.col("value")).alias("value"),
    )


def line_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as readings: few distinct times, so many ties."""
    return _table(spark, sf_dir, "lineitem", LINEITEM).select(
        F.col("l_shipdate").alias("event_time"),
        F.col("l_suppkey").alias("device_id"),
        F.col("l_returnflag").alias("metric"),
        F.col("l_quantity").alias("value"),
    )


def device(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer", CUSTOMER)
    nation = _table(spark, sf_dir, "nation", NATION)
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("device_id"),
        F.col("c_name").alias("device_name"),
        F.col("n_name").alias("site_code"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
    )


def site(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation", NATION)
    region = _table(spark, sf_dir, "region", REGION)
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("site_code"), F.col("r_name").alias("region")
    )


def device_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a change feed of the device that placed them."""
    return _table(spark, sf_dir, "orders", ORDERS).select(
        F.col("o_custkey").alias("device_id"),
        F.col("o_orderpriority").alias("site_code"),
        F.col("o_orderdate").alias("updated_at"),
        F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("__op"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON messages, some malformed: the payload number ``k`` says how.

    0: bad time, 1: text as value, 2: no device, 3: cut off, 4: NULL as value, 5: a time without a
    date, 6: a year alone, 7: parts without their zeros.
    """
    how = F.get_json_object("props", "$.k").cast("int")
    # A generator, so that the number is taken from the text once per row.
    events = _table(spark, sf_dir, "events", EVENTS).select(
        "*", F.inline(F.array(F.struct(how.alias("k"))))
    )
    k = F.col("k")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    number = F.concat(F.lit(', "value": '), F.col("value").cast("string"))
    text = F.concat(
        F.lit('{"event_time": "'),
        F.when(k == 0, F.lit("yesterday"))
        .when(k == 5, F.date_format("ts", "'T'HH:mm:ss"))
        .when(k == 6, F.date_format("ts", "yyyy"))
        .when(k == 7, F.date_format("ts", "yyyy-M-d H:m:s"))
        .otherwise(iso),
        F.when(k == 2, F.lit('"')).otherwise(
            F.concat(F.lit('", "device_id": '), F.col("user_id").cast("string"))
        ),
        F.lit(', "metric": "'),
        F.col("event_type"),
        F.lit('"'),
        F.when(k == 1, F.lit(', "value": "n/a"')).when(k == 4, F.lit(', "value": null')).otherwise(number),
        F.when(k == 3, F.lit("")).otherwise(F.lit("}")),
    )
    return events.select("event_id", text.alias("value"))


VIEWS = {
    "readings": """
        SELECT ts AS event_time, user_id AS device_id, event_type AS metric,
               CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS value
        FROM events""",
    "line_readings": """
        SELECT l_shipdate AS event_time, l_suppkey AS device_id, l_returnflag AS metric,
               l_quantity AS value
        FROM lineitem""",
    "device": """
        SELECT c.c_custkey AS device_id, c.c_name AS device_name, n.n_name AS site_code,
               c.c_acctbal >= 0 AS is_active
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "site": """
        SELECT n.n_name AS site_code, r.r_name AS region
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "device_changes": """
        SELECT o_custkey AS device_id, o_orderpriority AS site_code, o_orderdate AS updated_at,
               o_orderkey AS seq, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS op
        FROM orders""",
    "messages": """
        SELECT CASE WHEN k IN (0, 5, 6, 7) THEN NULL ELSE ts END AS event_time,
               CASE WHEN k = 2 THEN NULL ELSE user_id END AS device_id, event_type AS metric,
               CASE WHEN k IN (1, 4) THEN NULL ELSE value END AS value,
               CASE WHEN k IN (0, 5, 6, 7) THEN 'event_time invalid' WHEN k = 2 THEN 'device_id missing'
                    WHEN k = 3 THEN 'not a JSON object' END AS reason
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
}
