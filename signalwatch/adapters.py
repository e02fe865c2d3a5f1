"""Domain views over the generic test tables.

The ``events`` table is clean, so NULLs, NaN and unknown regions are put in by id; every row is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
)

# Which route each generic event type stands for; ``signup`` is left unmatched on purpose.
ROUTE_OF = {
    "click": "symptom_report",
    "view": "symptom_report",
    "purchase": "clinic_visit",
    "error": "environmental_conditions",
}

_REGION = (
    "case user_id % 4 when 0 then 'NE' when 1 then 'NW' when 2 then 'SE' else 'SW' end"
)
_DIRTY_REGION = (
    f"case when event_id % 97 = 0 then null when event_id % 89 = 0 then 'XX' else {_REGION} end"
)
_SEVERITY = (
    "case when value < 15 then 'mild' when value < 70 then 'moderate' "
    "when value < 110 then 'severe' when value < 230 then 'critical' else 'unknown' end"
)
_K = "cast(get_json_object(props, '$.k') as int) as k"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generic event table, read with a declared schema so that time filters reach the scan."""
    return spark.read.schema(EVENTS_SCHEMA).parquet(table_path(sf_dir, "events"))


def symptom_reports(source: DataFrame) -> DataFrame:
    return source.selectExpr(
        "cast(event_id as string) as event_id",
        "'symptom_report' as event_type",
        "ts as event_timestamp",
        "case when event_id % 101 = 0 then null else cast(user_id as string) end as patient_id",
        "cast(user_id % 90 as int) as age",
        "case when user_id % 2 = 0 then 'F' else 'M' end as gender",
        f"{_DIRTY_REGION} as region",
        "event_type as symptoms",
        f"{_SEVERITY} as severity",
    )


def environmental_conditions(source: DataFrame) -> DataFrame:
    return source.selectExpr("*", _K).selectExpr(
        "'environmental_conditions' as event_type",
        "ts as event_timestamp",
        f"{_REGION} as region",
        "concat('ST', cast(user_id % 10 as string)) as station_id",
        "value as temperature_f",
        "k as humidity_percent",
        "cast((event_id * 7) % 300 as int) as air_quality_index",
        "cast((event_id * 3) % 120 as int) as pollen_count",
        "case when event_id % 43 = 0 then null else cast(event_id % 12 as int) end as uv_index",
        "value / 10 as wind_speed_mph",
    )


def dq_events(source: DataFrame) -> DataFrame:
    return source.selectExpr("*", _K).selectExpr(
        "event_id",
        "ts as event_timestamp",
        "case when event_id % 53 = 0 then null "
        "when event_id % 59 = 0 then double('NaN') else value end as temperature",
        "case when event_id % 61 = 0 then null else k * 1.05D end as humidity",
        "k - 2 as symptom_count",
        f"{_DIRTY_REGION} as region",
    )


def raw_messages(source: DataFrame) -> DataFrame:
    """Untyped messages as a broker delivers them: one JSON document per row in ``value``, with all fields
    that producers write; the router adds the rest."""
    routed = F.col("event_type")
    for generic, route in ROUTE_OF.items():
        routed = F.when(F.col("event_type") == generic, route).otherwise(routed)
    return source.select(
        F.col("event_id").cast("string").alias("key"),
        F.to_json(
            F.struct(
                F.col("event_id").cast("string").alias("event_id"),
                routed.alias("event_type"),
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
                F.col("user_id").cast("string").alias("patient_id"),
                F.expr("cast(user_id % 90 as int)").alias("age"),
                F.expr("case when user_id % 2 = 0 then 'F' else 'M' end").alias("gender"),
                F.expr(_DIRTY_REGION).alias("region"),
                F.col("event_type").alias("symptoms"),
                F.expr(_SEVERITY).alias("severity"),
            )
        ).alias("value"),
    )
