"""Routing and enrichment of raw messages.  Everything here is stateless and works on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalwatch.functions import event_time, severity_score
from signalwatch.schemas import EVENT_TIME_FORMAT, PROCESSING_TIME_FORMAT, ROUTES

UNMATCHED = "unmatched"
UNPARSEABLE = "unparseable"


def extract_type(
    df: DataFrame, path: str = "$.event_type", col: str = "value", drop_unparseable: bool = True
) -> DataFrame:
    """Add the routing key ``event_type`` read from the raw JSON text."""
    typed = df.withColumn("event_type", F.get_json_object(F.col(col).cast("string"), path))
    return typed.where(F.col("event_type").isNotNull()) if drop_unparseable else typed


def with_route(
    df: DataFrame, key: str = "event_type", routes: tuple[str, ...] = ROUTES
) -> DataFrame:
    """Add a ``route`` column in one pass; rows no route takes are marked, not lost."""
    return df.withColumn(
        "route",
        F.when(F.col(key).isNull(), UNPARSEABLE)
        .when(F.col(key).isin(*routes), F.col(key))
        .otherwise(UNMATCHED),
    )


def route(
    df: DataFrame, key: str = "event_type", routes: tuple[str, ...] = ROUTES
) -> dict[str, DataFrame]:
    """One DataFrame per route, plus ``quarantine`` with every other row."""
    branches = {name: df.where(F.col(key) == name) for name in routes}
    branches["quarantine"] = df.where(F.col(key).isNull() | ~F.col(key).isin(*routes))
    return branches


def enrich(df: DataFrame, source: str, team_id: str, now: Column | None = None) -> DataFrame:
    """Add the processing time, the event source and the team; ``now`` fixes the time for tests."""
    return df.withColumns(
        {
            "processing_timestamp": F.date_format(
                F.current_timestamp() if now is None else now, PROCESSING_TIME_FORMAT
            ),
            "event_source": F.lit(source),
            "team_id": F.lit(team_id),
        }
    )


def with_event_time(
    df: DataFrame, col: str = "timestamp", fmt: str = EVENT_TIME_FORMAT
) -> DataFrame:
    """Add ``event_timestamp`` parsed from text, NULL where the text does not match."""
    return df.withColumn("event_timestamp", event_time(col, fmt))


def with_severity_score(df: DataFrame, col: str = "severity") -> DataFrame:
    return df.withColumn("severity_score", severity_score(col))


def symptoms_as_text(df: DataFrame, col: str = "symptoms") -> DataFrame:
    """Symptoms as one text; a list becomes its JSON text."""
    kind = df.schema[col].dataType.typeName()
    text = F.to_json(col) if kind in ("array", "map", "struct") else F.col(col).cast("string")
    return df.withColumn(col, text)


def explode_symptoms(df: DataFrame, col: str = "symptoms") -> DataFrame:
    """One row per symptom; plain text counts as a list of one, no symptoms keep one NULL row."""
    listed = F.from_json(col, "array<string>")
    is_list = F.ltrim(F.col(col)).startswith("[")
    return df.withColumn(
        "symptom",
        F.explode_outer(F.when(is_list, listed).when(F.col(col).isNotNull(), F.array(col))),
    )
