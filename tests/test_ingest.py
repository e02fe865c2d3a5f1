from datetime import datetime

from pyspark.sql import functions as F

from signalwatch.operators import ingest
from signalwatch.schemas import SYMPTOM_REPORT
from signalwatch.sources.readers import decode_json


def test_decode_keeps_bad_rows_as_nulls(spark):
    texts = [
        '{"event_id":"1","age":7,"symptoms":["cough","fever"]}',
        '{"event_id":"2","age":7.5}',
        '{"event_id":"3","age":"12"}',
        "{bad",
        "[]",
        None,
    ]
    got = decode_json(spark.createDataFrame([(t,) for t in texts], "value string"), SYMPTOM_REPORT)
    out = [tuple(r) for r in got.select("event_id", "age", "symptoms").collect()]
    assert out == [
        ("1", 7, '["cough","fever"]'), ("2", None, None), ("3", None, None),
        (None, None, None), (None, None, None), (None, None, None),
    ]


def test_decode_accepts_binary_payload(spark):
    df = spark.createDataFrame([(bytearray(b'{"event_id":"9"}'),)], "value binary")
    assert decode_json(df, SYMPTOM_REPORT).first().event_id == "9"


def test_decode_keeps_envelope_columns(spark):
    df = spark.createDataFrame([('{"event_id":"9"}', "t", 4)], "value string, topic string, n int")
    row = decode_json(df, "event_id string", keep=["topic"]).first()
    assert row.asDict() == {"topic": "t", "event_id": "9"}


def test_event_time_formats(spark):
    texts = [
        "2024-01-02T03:04:05.123456", "2024-01-02T03:04:05.123", "2024-01-02T03:04:05",
        "2024-01-02 03:04:05.123456", "2024-01-02T03:04:05.123456Z", "", None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "timestamp string")
    out = [r.event_timestamp for r in ingest.with_event_time(df).collect()]
    assert out[0] == datetime(2024, 1, 2, 3, 4, 5, 123456)
    assert out[1] == datetime(2024, 1, 2, 3, 4, 5, 123000)
    assert out[2:] == [None] * 5


def test_severity_score_is_exact(spark):
    words = ["mild", "moderate", "severe", "critical", "Mild", "other", "", None]
    df = spark.createDataFrame([(w,) for w in words], "severity string")
    out = [r.severity_score for r in ingest.with_severity_score(df).collect()]
    assert out == [1, 2, 3, 4, 0, 0, 0, 0]


def test_routes_cover_every_row_once(spark, rows):
    texts = [
        '{"event_type":"symptom_report"}', '{"event_type":"clinic_visit"}',
        '{"event_type":"environmental_conditions"}', '{"event_type":"Symptom_Report"}',
        '{"other":1}', "{bad", None,
    ]
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    assert ingest.extract_type(raw).count() == 4
    typed = ingest.extract_type(raw, drop_unparseable=False)
    marked = [r.route for r in ingest.with_route(typed).collect()]
    assert marked == [
        "symptom_report", "clinic_visit", "environmental_conditions", ingest.UNMATCHED,
        ingest.UNPARSEABLE, ingest.UNPARSEABLE, ingest.UNPARSEABLE,
    ]
    branches = ingest.route(typed)
    assert {k: v.count() for k, v in branches.items()} == {
        "symptom_report": 1, "clinic_visit": 1, "environmental_conditions": 1, "quarantine": 4,
    }


def test_enrich(spark):
    now = F.lit("2024-02-01 12:00:00").cast("timestamp")
    row = ingest.enrich(spark.range(1), "src", "42", now).first()
    assert (row.processing_timestamp, row.event_source, row.team_id) == (
        "2024-02-01 12:00:00", "src", "42"
    )


def test_explode_symptoms(spark, rows):
    df = spark.createDataFrame(
        [(1, '["a","b"]'), (2, "cough"), (3, None), (4, "[]")], "id int, symptoms string"
    )
    assert rows(ingest.explode_symptoms(df), "id", "symptom") == [
        (1, "a"), (1, "b"), (2, "cough"), (3, None), (4, None)
    ]


def test_symptoms_as_text(spark):
    df = spark.createDataFrame([(["a", "b"],)], "symptoms array<string>")
    assert ingest.symptoms_as_text(df).first().symptoms == '["a","b"]'
