"""Meter readings derived from the shared tables.

Each fixture is one SQL text, used by Spark and by the oracle database.
``readings`` comes from ``events``; ``star`` from ``orders`` with its customer;
``bulk`` from ``lineitem`` with its supplier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

READINGS = """
SELECT event_id AS _seq, ts AS `Timestamp`,
  concat('MTR-', CAST(user_id AS STRING)) AS Meter_ID,
  concat('Z', CAST(user_id % 4 AS STRING)) AS Zone_ID,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 499 = 1 THEN CAST(0 AS DOUBLE)
       ELSE CAST(200 + (event_id * 7) % 60 AS DOUBLE) END AS Voltage_V,
  CASE WHEN event_id % 211 = 5 THEN CAST(-1 AS DOUBLE) ELSE value / 5 END AS Current_A,
  CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 307 = 3 THEN CAST(-0.5 AS DOUBLE)
       ELSE value / 20 END AS Active_Power_kW,
  value / 20 * (event_id % 5) / 10 AS Reactive_Power_kW,
  sqrt((value / 20) * (value / 20)
       + (value / 20 * (event_id % 5) / 10) * (value / 20 * (event_id % 5) / 10))
    + CASE WHEN event_id % 53 = 0 THEN 1 ELSE 0 END AS Apparent_Power_kVA,
  CAST(494 + event_id % 13 AS DOUBLE) / 10 AS Frequency_Hz,
  value / 200 AS Sub_Meter_Kitchen, value / 60 AS Sub_Meter_HVAC,
  CAST(event_id % 64 - 12 AS DOUBLE) AS Outdoor_Temp_C
FROM {events}
"""

READINGS_DUP = """
SELECT * FROM {readings}
UNION ALL
SELECT _seq + 1000000000 AS _seq, `Timestamp`, Meter_ID, Zone_ID, Voltage_V, Current_A,
  Active_Power_kW, Reactive_Power_kW, Apparent_Power_kVA, Frequency_Hz, Sub_Meter_Kitchen,
  Sub_Meter_HVAC, Outdoor_Temp_C
FROM {readings} WHERE _seq % 40 = 0
"""

STAR = """
SELECT o_orderkey AS reading_id, o_orderdate AS ts, CAST(o_custkey AS STRING) AS meter_id,
  CAST(c_nationkey AS STRING) AS zone_id, o_totalprice / 20000 AS active_power_kw,
  CASE WHEN o_orderkey % 37 = 0 THEN 1 ELSE 0 END AS is_anomaly
FROM {orders} LEFT JOIN {customer} ON o_custkey = c_custkey
"""

BULK = """
SELECT l_shipdate AS `Timestamp`, CAST(l_suppkey AS STRING) AS Meter_ID,
  CAST(s_nationkey AS STRING) AS Zone_ID, l_quantity / 2 AS Active_Power_kW
FROM {lineitem} LEFT JOIN {supplier} ON l_suppkey = s_suppkey
"""

MESSAGE_COLUMNS = (
    "Timestamp", "Meter_ID", "Zone_ID", "Voltage_V", "Current_A", "Active_Power_kW",
    "Reactive_Power_kW", "Apparent_Power_kVA", "Frequency_Hz", "Sub_Meter_Kitchen",
    "Sub_Meter_HVAC", "Outdoor_Temp_C",
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(READINGS, events=load(spark, sf_dir, "events"))


def readings_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(READINGS_DUP, readings=readings(spark, sf_dir))


def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        STAR, orders=load(spark, sf_dir, "orders"), customer=load(spark, sf_dir, "customer")
    )


def bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        BULK, lineitem=load(spark, sf_dir, "lineitem"), supplier=load(spark, sf_dir, "supplier")
    )


def for_duckdb(text: str, **tables: str) -> str:
    return text.format(**tables).replace("`", '"').strip()


CTE_READINGS = for_duckdb(READINGS, events="events")
CTE_READINGS_DUP = for_duckdb(READINGS_DUP, readings="readings")
CTE_STAR = for_duckdb(STAR, orders="orders", customer="customer")
CTE_BULK = for_duckdb(BULK, lineitem="lineitem", supplier="supplier")
