"""Hand-made feed rows, given as plain dictionaries."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail import schemas


def frame(spark: SparkSession, fields: dict[str, str], rows: list[dict]) -> DataFrame:
    """Rows of the given columns; a column a row does not name is NULL."""
    texts = spark.createDataFrame([(json.dumps(row),) for row in rows], "row string")
    schema = schemas.ddl(fields)
    return texts.select(F.from_json("row", schema, {"timestampFormat": "yyyy-MM-dd HH:mm:ss"}).alias("r")).select("r.*")


def micros(ts: str) -> int:
    moment = dt.datetime.fromisoformat(ts).replace(tzinfo=dt.UTC)
    return int(moment.timestamp()) * 1_000_000 + moment.microsecond


def param(key: str, value: str | int) -> dict:
    kind = "int_value" if isinstance(value, int) else "string_value"
    return {"key": key, "value": {kind: value}}


def ga4(user: str, ts: str, name: str, session: int | None = None, bundle: int = 0, params: list | None = None, **more) -> dict:
    sent = list(params or [])
    if session is not None:
        sent.insert(0, param("ga_session_id", session))
    return {
        "event_date": ts[:10].replace("-", ""),
        "event_timestamp": micros(ts),
        "event_name": name,
        "event_bundle_sequence_id": bundle,
        "user_pseudo_id": user,
        "event_params": sent,
        "device": {"category": "mobile"},
        **more,
    }


def snowplow(event_id: str, user: str, ts: str, name: str, session: str | None = None, **more) -> dict:
    return {
        "event_id": event_id, "user_pseudo_id": user, "collector_tstamp": ts, "event_name": name, "session_id": session,
        **more,
    }


def ga4_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return frame(spark, schemas.GA4_EVENTS, rows)


def snowplow_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return frame(spark, schemas.SNOWPLOW_EVENTS, rows)


def cs_frame(spark: SparkSession, table: str, rows: list[dict]) -> DataFrame:
    return frame(spark, schemas.CONTENTSQUARE_TABLES[table], rows)


def same_rows(left: DataFrame, right: DataFrame) -> None:
    """Both frames hold the same rows, whatever their order."""
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    a = sorted(map(str, left.select(*columns).collect()))
    b = sorted(map(str, right.select(*columns).collect()))
    assert len(a) == len(b)
    assert a == b
