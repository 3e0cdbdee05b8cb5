"""Decoding raw events, the structure check, the canary drop and the media strip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from editstream.functions import variants as V
from editstream.functions.columns import compute_once
from editstream.schemas import EVENT_TYPES, META_KEYS
from editstream.sources.event_lines import decoded_text

# --- Fixed values: the canary domain and the media namespace with its heavy key ---
CANARY_DOMAIN = "canary"
MEDIA_NAMESPACE = 6
MEDIA_PAYLOAD_KEY = "log_params"


def parse_events(lines: DataFrame) -> DataFrame:
    """Add ``event``, the parsed ``value``; NULL for bad UTF-8 or bad JSON."""
    return compute_once(lines, event=F.try_parse_json(decoded_text(F.col("value"))))


def reject_reason(event: Column) -> Column:
    meta_kind = V.kind(V.child(event, "$.meta"))
    missing_key = F.lit(False)
    for key in META_KEYS:
        missing_key = missing_key | V.child(event, f"$.meta.{key}").isNull()
    event_type = V.text_if_string(V.child(event, "$.type"))
    domain = V.text_if_string(V.child(event, "$.meta.domain"))
    return (
        F.when(event.isNull(), "DECODE_ERROR")
        .when(~F.coalesce(V.is_object(meta_kind), F.lit(False)), "BAD_META")
        .when(missing_key, "MISSING_META_FIELD")
        .when(~F.coalesce(event_type.isin(EVENT_TYPES), F.lit(False)), "BAD_TYPE")
        .when(F.coalesce(domain == CANARY_DOMAIN, F.lit(False)), "CANARY")
        .otherwise("OK")
    )


def classify_events(lines: DataFrame) -> DataFrame:
    """``event`` and ``reason`` for every line: OK, or why the line is dropped."""
    return compute_once(parse_events(lines), reason=reject_reason(F.col("event")))


#: Columns of the job's progress, by what became of a line.
REASON_COUNTS = {
    "accepted": "OK",
    "not_decoded": "DECODE_ERROR",
    "bad_meta": "BAD_META",
    "missing_meta_field": "MISSING_META_FIELD",
    "bad_type": "BAD_TYPE",
    "canaries": "CANARY",
}


def count_reasons(classified: DataFrame, observation: Observation | str) -> DataFrame:
    """Count lines and reasons on the way, without a pass of their own."""
    counts = [
        F.count_if(F.col("reason") == reason).alias(name) for name, reason in REASON_COUNTS.items()
    ]
    return classified.observe(observation, F.count(F.lit(1)).alias("lines"), *counts)


def accepted_events(lines: DataFrame, observation: Observation | str | None = None) -> DataFrame:
    classified = classify_events(lines)
    if observation is not None:
        classified = count_reasons(classified, observation)
    return classified.where("reason = 'OK'").drop("reason")


def reject_counts(lines: DataFrame) -> DataFrame:
    return classify_events(lines).groupBy("reason").agg(F.count("*").alias("events"))


def has_media_payload(event: Column) -> Column:
    """Whether the event is in the media namespace and holds the heavy key."""
    namespace = V.child(event, "$.namespace")
    kind = V.kind(namespace)
    is_media = ((kind == "BIGINT") | V.is_fraction(kind)) & (V.as_double(namespace) == MEDIA_NAMESPACE)
    return F.coalesce(is_media, F.lit(False)) & V.child(event, f"$.{MEDIA_PAYLOAD_KEY}").isNotNull()


def _without_payload(event: Column) -> Column:
    entries = event.cast("map<string,variant>")
    return F.to_json(F.map_filter(entries, lambda key, _: key != MEDIA_PAYLOAD_KEY))


def stripped_media_json(event: Column) -> Column:
    """The event as JSON, without its heavy payload if it is in the media namespace."""
    return F.when(has_media_payload(event), _without_payload(event)).otherwise(F.to_json(event))


def strip_media(events: DataFrame) -> DataFrame:
    """Replace ``value`` by the stripped JSON; the flattened columns never use that payload."""
    return events.withColumn("value", stripped_media_json(F.col("event")))


def lighten(events: DataFrame) -> DataFrame:
    """Replace ``value`` where it holds a heavy media payload; all other lines stay as they came."""
    event, text = F.col("event"), decoded_text(F.col("value"))
    light = F.when(has_media_payload(event), _without_payload(event)).otherwise(text)
    return events.withColumn("value", light)
