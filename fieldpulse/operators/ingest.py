"""From message bytes to typed readings, and back to keyed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldpulse.functions.topics import topic_matches
from fieldpulse.schema import READING_DDL, READING_FIELDS

# Microseconds and offset, so that writing and parsing a timestamp is lossless.
JSON_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
# JSON as the standard has it; Spark also takes single quotes by default.
_STRICT = {"allowSingleQuotes": "false"}


def decode_payload(payload: str | Column) -> Column:
    """Message bytes as UTF-8 text, NULL when they are not valid UTF-8."""
    column = F.col(payload) if isinstance(payload, str) else payload
    return F.try_validate_utf8(column.cast("string"))


def parse_readings(messages: DataFrame, payload: str = "value", keep: list[str] = ()) -> DataFrame:
    """Typed reading columns from JSON messages, one row per message.

    Never fails on bad input: what does not parse becomes NULL.  ``keep`` names
    message columns to carry along.

    The struct goes through ``inline`` and not through ``select("parsed.*")``:
    filters cannot be pushed below a generator, so each message is parsed
    once however many later predicates look at its fields.
    """
    parsed = F.from_json(decode_payload(payload), READING_DDL)
    return messages.select(*keep, F.inline(F.array(parsed)))


def is_malformed(payload: str, fields: list[str] = READING_FIELDS) -> Column:
    """Whether a parsed message was not a JSON object at all.

    A malformed message has no field set, so the second parse that tells it
    from an empty object runs only for rows without any field.
    """
    nothing_parsed = F.coalesce(*[F.col(name).cast("string") for name in fields]).isNull()
    not_an_object = F.from_json(decode_payload(payload), "map<string,string>").isNull()
    return F.when(nothing_parsed, not_an_object).otherwise(F.lit(False))


def filter_topics(messages: DataFrame, pattern: str = "sensors/#", topic: str = "topic") -> DataFrame:
    """Messages whose topic path matches an MQTT filter."""
    return messages.filter(topic_matches(F.col(topic), pattern))


def enrich_topic(messages: DataFrame, payload: str = "value", topic: str = "topic") -> DataFrame:
    """Messages with the topic they arrived on written into their JSON.

    ``payload`` becomes text with the field ``mqtt_topic`` at its end; every
    other field keeps its exact text, known or not.  An ``mqtt_topic`` the
    device sent is taken out first.  Messages that cannot carry the field are
    left out; :func:`classify_forwarding` keeps them with the reason.
    """
    classified = classify_forwarding(messages, payload, topic)
    return classified.filter(F.col("reject_reason").isNull()).select(*messages.columns)


def classify_forwarding(
    messages: DataFrame, payload: str = "value", topic: str = "topic"
) -> DataFrame:
    """Messages enriched as by :func:`enrich_topic`, with ``payload`` and ``reject_reason``.

    Reading the field back proves that the message was one whole object: after
    a broken or cut one, or one followed by other text, it is not there.  The
    reason is ``undecodable`` for bytes that are not UTF-8, else ``malformed``,
    and NULL for messages to be forwarded.  The column ``payload`` has the
    message as it came, with invalid bytes as replacement characters;
    ``ingest_time`` is added where the messages have none.
    """
    others = [name for name in messages.columns if name != payload]
    text = decode_payload(payload)
    as_it_came = F.make_valid_utf8(F.col(payload).cast("string"))
    decoded = messages.select(*others, text.alias("_text"), as_it_came.alias("payload"))
    # Through a generator, so that the test on the result does not repeat its making.
    result = _stamped(decoded, topic).select(
        *others, "payload", "_text", F.inline(F.array(F.struct(F.col("_result").alias(payload))))
    )
    whole = F.from_json(payload, "mqtt_topic STRING", _STRICT)["mqtt_topic"]
    reason = F.when(F.col("_text").isNull(), "undecodable").when(
        ~F.coalesce(whole == F.col(topic), F.lit(False)), "malformed"
    )
    if "ingest_time" not in others:
        result = result.withColumn("ingest_time", F.current_timestamp())
    return result.withColumn("reject_reason", reason).drop("_text")


# The field as devices write it: its name, not as the end of an escaped one, and a string.
_SENT_TOPIC = r'(?<![\\])"mqtt_topic"\s*:\s*"(?:[^"\\]|\\.)*+"'


def _stamped(decoded: DataFrame, topic: str) -> DataFrame:
    """``_text`` with the topic spliced in as ``_result``, NULL if it ends in no object.

    One column per step: each is used more than once by the next.  A field the
    device sent is cut out of the text where it stands there once, as a string;
    only where the name occurs again, or with another kind of value, is the object
    taken apart and written anew, which may change how its numbers are written.
    """
    unpadded = F.when(F.endswith("_text", F.lit("}")), F.col("_text")).otherwise(
        F.trim("_text", F.lit(" \t\r\n"))
    )
    own = F.from_json("_body", "mqtt_topic STRING", _STRICT)["mqtt_topic"]
    once = (F.size(F.split("_body", '"mqtt_topic"')) == 2) & own.isNotNull() & F.col("_body").rlike(_SENT_TOPIC)
    # With the comma after it, or the one before it if it is the last field.
    cut = F.regexp_replace(F.regexp_replace("_body", _SENT_TOPIC + r"\s*,", ""), r"(?:,\s*)?" + _SENT_TOPIC, "")
    sent_fields = F.from_json("_body", "map<string,variant>", _STRICT)
    without = F.to_json(F.map_filter(sent_fields, lambda name, _: name != "mqtt_topic"))
    fields = (
        F.when(~F.contains("_body", F.lit('"mqtt_topic"')), F.col("_body")).when(once, cut).otherwise(without)
    )
    opened = F.when(
        F.endswith("_fields", F.lit("}")), F.left("_fields", F.length("_fields") - 1)
    )
    # An object that has any field has a quoted name.
    comma = F.when(F.contains("_opened", F.lit('"')), ",").otherwise("")
    added = F.to_json(F.struct(F.col(topic).alias("mqtt_topic")))
    return (
        decoded.withColumn("_body", unpadded)
        .withColumn("_fields", fields)
        .withColumn("_opened", opened)
        .withColumn("_result", F.concat("_opened", comma, F.substring(added, 2, 1 << 30)))
    )


def keyed_records(enriched: DataFrame, payload: str = "value", topic: str = "topic") -> DataFrame:
    """Enriched messages as records for a keyed log: topic path and JSON text.

    Equal keys go to one log partition, which keeps the order per sensor.
    """
    return enriched.select(F.col(topic).alias("key"), F.col(payload).alias("value"))


def readings_to_json(readings: DataFrame, alias: str = "value") -> Column:
    """The reading columns of a row as a JSON object; NULL fields are left out."""
    present = [name for name in READING_FIELDS if name in readings.columns]
    return F.to_json(F.struct(*present), {"timestampFormat": JSON_TIMESTAMP}).alias(alias)
