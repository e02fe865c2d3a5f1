"""Event schemas and table column lists.

Schemas are DDL texts; every field is nullable and no schema is ever inferred.  Field names, types and
table names in this file are fixed values: they are the wire and table formats that producers and
dashboards already use.
"""

SYMPTOM_REPORT = (
    "event_id string, event_type string, timestamp string, patient_id string, age int, "
    "gender string, region string, symptoms string, severity string, team_id string, "
    "processing_timestamp string, event_source string"
)

ENVIRONMENTAL_CONDITIONS = (
    "event_type string, timestamp string, region string, station_id string, "
    "temperature_f double, humidity_percent int, air_quality_index int, pollen_count int, "
    "uv_index int, wind_speed_mph double, processing_timestamp string, event_source string, "
    "team_id string"
)

# The columns the data-quality rules look at.
DQ_INPUT = "temperature double, humidity double, symptom_count int, region string"

# How producers write the event time, and the router the processing time.
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
PROCESSING_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Event types the router knows; anything else is quarantined.
ROUTES = ("symptom_report", "clinic_visit", "environmental_conditions")

# Severity words and their scores; every other word, and NULL, scores 0.
SEVERITY_SCORES = {"mild": 1, "moderate": 2, "severe": 3, "critical": 4}

# Columns of each feature and result table, in the order readers list them.
TABLES = {
    "symptom_by_region": [
        "region", "symptoms", "event_count", "avg_severity_score", "last_updated",
    ],
    "severity_distribution": [
        "severity", "hour_of_day", "event_count", "last_updated", "percentage",
    ],
    "temporal_patterns": [
        "day_of_week", "hour_of_day", "event_count", "unique_patients", "last_updated",
    ],
    "env_avg_temp": [
        "region", "avg_temperature_f", "last_updated",
    ],
    "env_aqi_distribution": [
        "region", "avg_air_quality", "avg_pollen_count", "avg_uv_index", "last_updated",
    ],
    "env_hourly_temp": [
        "hour_of_day", "average_temp", "average_humidity", "average_windspeed", "last_updated",
    ],
    "anomalies": [
        "region", "symptoms", "event_count", "avg_severity_score", "last_updated", "z_score",
        "detected_at",
    ],
    "outbreak_predictions": [
        "day_of_week", "hour_of_day", "unique_patients", "event_count_true", "event_count_pred",
        "rmse", "mae", "run_id", "predicted_at",
    ],
    "model_comparison": [
        "run_id", "model_name", "rmse", "mae",
    ],
}
