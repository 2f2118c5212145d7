"""Sensor messages: flatten API answers, build envelopes, parse them again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skygauge.functions.names import partition_of
from skygauge.functions.times import from_epoch, utc_wall_clock
from skygauge.functions.units import in_celsius
from skygauge.schemas import API_RESPONSE, MESSAGE, READING_FIELDS, column_names

ROUNDED = ("main_temp", "main_feels_like", "main_temp_min", "main_temp_max", "wind_speed")
RENAMED = {"id": "location_id", "name": "location_name"}
RECORDED_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Groups of the nested answer; the rest of a flat name is the field within the group.
_GROUPS = ("coord", "weather", "main", "wind", "clouds", "sys")


def _parsed_once(json: str, schema: str) -> Column:
    """The parsed text as a generated column. A plain ``from_json`` would be split up by the optimizer
    into one parse per field that is read later."""
    return F.explode(F.array(F.from_json(json, schema)))


def _answer_field(answer: Column, flat_name: str) -> Column:
    group, _, field = flat_name.partition("_")
    if group not in _GROUPS or not field:
        return answer[flat_name]
    # Only the first entry of the weather list counts; out-of-range and NULL give NULL.
    parent = F.get(answer["weather"], F.lit(0)) if group == "weather" else answer[group]
    return parent[field]


def flatten_answers(raw: DataFrame, recorded_at: Column, json: str = "json") -> DataFrame:
    """``data`` struct of 30 fields next to the other columns; NULL fields where the answer has none."""
    names = column_names(READING_FIELDS)
    parsed = raw.select("*", _parsed_once(json, API_RESPONSE).alias("_answer"))
    answer = F.col("_answer")
    fields = [_answer_field(answer, n).alias(n) for n in names if n != "recorded_at"]
    fields.append(F.date_format(recorded_at, RECORDED_FORMAT).alias("recorded_at"))
    return parsed.withColumn("data", F.struct(*fields)).drop("_answer", json)


def envelopes(readings: DataFrame, sent_at: Column, strict: bool = False) -> DataFrame:
    """``key``, ``partition`` and JSON ``value`` of readings (``governorate``, ``data``).

    Readings of unknown governorates get a NULL partition; ``deliverable`` and ``unknown_region``
    separate them. With ``strict`` they raise an error.
    """
    partition = partition_of("governorate", strict)
    body = F.struct(
        "governorate", F.unix_seconds(sent_at).alias("timestamp"),
        F.date_format(utc_wall_clock(sent_at), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("datetime"),
        partition.alias("partition"), "data")
    return readings.select(F.col("governorate").alias("key"), F.to_json(body).alias("value"),
                           partition.alias("partition"))


def deliverable(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("partition").isNotNull())


def unknown_region(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("partition").isNull())


def parse(messages: DataFrame) -> DataFrame:
    """Message fields next to the message text. Text that is no message gives NULL fields.

    What else the topic tells of a message stays, as ``kafka_key``, ``kafka_offset`` and so on.
    """
    text = F.col("value").cast("string")
    origin = {f"kafka_{c}": c for c in ("key", "topic", "partition", "offset", "timestamp") if c in messages.columns}
    return (messages.select(text.alias("value"), *[F.col(c).alias(name) for name, c in origin.items()])
            .select("value", *origin, _parsed_once("value", MESSAGE).alias("message"))
            .select("value", *origin, "message.*"))


def _usable() -> Column:
    return F.col("governorate").isNotNull() & F.col("timestamp").isNotNull()


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(_usable())


def rejected(parsed: DataFrame) -> DataFrame:
    """Texts without governorate or time, with their place in the topic, for the quarantine."""
    return parsed.filter(~_usable()).select("value", *[c for c in parsed.columns if c.startswith("kafka_")])


def flat_readings(parsed: DataFrame, processed_at: Column | None = None, unit: str = "celsius") -> DataFrame:
    """Parsed messages as rows of the reading table: 33 columns and ``processed_at``.

    The table is in Celsius; ``unit`` says in what unit the messages are.
    """
    columns = []
    for name in column_names(READING_FIELDS):
        field = F.col(f"data.{name}")
        if name in ROUNDED:
            field = F.round(field, 2)
        elif name == "recorded_at":
            field = F.try_to_timestamp(field, F.lit(RECORDED_FORMAT))
        columns.append(field.alias(RENAMED.get(name, name)))
    flat = parsed.select("governorate", F.col("partition").alias("kafka_partition"),
                         from_epoch("timestamp").alias("timestamp"), *columns)
    return (in_celsius(flat, unit)
            .withColumn("processed_at", F.current_timestamp() if processed_at is None else processed_at))
