from __future__ import annotations

import pytest

from fieldpulse.sources.topic import kafka_source
from fieldpulse.streaming.app import Settings
from fieldpulse.streaming.sinks import jdbc_sink


def test_kafka_options():
    source = kafka_source("broker:9092", "readings", max_records_per_batch=5000, minPartitions="8")
    assert source.format == "kafka" and source.options == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "readings",
        "startingOffsets": "latest", "failOnDataLoss": "true", "maxOffsetsPerTrigger": "5000",
        "minPartitions": "8",
    }
    skipping = kafka_source(
        "b", topic_pattern="sensors.*", fail_on_data_loss=False, max_records_per_batch=None
    )
    assert skipping.options["failOnDataLoss"] == "false"
    assert skipping.options["subscribePattern"] == "sensors.*"
    assert "maxOffsetsPerTrigger" not in skipping.options
    with pytest.raises(ValueError):
        kafka_source("b")


def test_jdbc_options():
    sink = jdbc_sink("db", "jdbc:x://h/d", "t", "u", "p", "x.Driver")
    assert sink.format == "jdbc"
    assert sink.options == {
        "url": "jdbc:x://h/d", "dbtable": "t", "user": "u", "password": "p",
        "driver": "x.Driver", "batchsize": "50000", "numPartitions": "8",
    }


def test_settings_without_databases():
    settings = Settings.from_env({"TABLES_PATH": "/data"})
    assert settings.extra_reading_sinks == [] and settings.extra_stats_sinks == []
    assert settings.source.options["subscribe"] == "sensor-readings"
    with pytest.raises(KeyError):
        Settings.from_env({})


def test_settings_with_databases():
    settings = Settings.from_env({
        "TABLES_PATH": "/data", "JDBC_URL": "jdbc:x://h/d", "JDBC_DRIVER": "x.Driver",
        "WAREHOUSE_FORMAT": "some.warehouse", "WAREHOUSE_OPTIONS": '{"dbtable": "READINGS"}',
    })
    assert [s.format for s in settings.extra_reading_sinks] == ["jdbc", "some.warehouse"]
    assert [s.options["dbtable"] for s in settings.extra_stats_sinks] == ["sensor_aggregations"]
    assert settings.extra_reading_sinks[1].options == {"dbtable": "READINGS"}


def test_every_setting_comes_from_the_environment():
    settings = Settings.from_env({
        "TABLES_PATH": "/data", "STARTING_OFFSETS": "earliest", "FAIL_ON_DATA_LOSS": "false",
        "MAX_RECORDS_PER_BATCH": "none", "READINGS_EVERY": "once", "STATS_EVERY": "1 minute", "WATERMARK": "5 minutes",
        "CLOCK_ALLOWANCE": "1 hour", "FIRST_DELIVERIES_ONLY": "true", "DEAD_LETTER_TOPIC": "dead",
        "REPUBLISH_FROM": "raw", "REPUBLISH_TO": "keyed", "WAREHOUSE_FORMAT": "some.warehouse",
        "WAREHOUSE_STATS_OPTIONS": '{"dbtable": "STATS"}', "JDBC_URL": "jdbc:x", "JDBC_DRIVER": "x.Driver",
        "JDBC_CONNECTIONS": "3",
    })
    assert settings.source.options["startingOffsets"] == "earliest"
    assert settings.source.options["failOnDataLoss"] == "false"
    assert "maxOffsetsPerTrigger" not in settings.source.options
    assert (settings.readings_every, settings.stats_every, settings.watermark) == (None, "1 minute", "5 minutes")
    assert (settings.clock_allowance, settings.first_deliveries_only) == ("1 hour", True)
    assert settings.extra_reject_sinks[0].options["topic"] == "dead"
    assert settings.republish_from.options["subscribe"] == "raw"
    assert settings.republish_sinks[0].options["topic"] == "keyed"
    assert [s.format for s in settings.extra_stats_sinks] == ["jdbc", "some.warehouse"]
    assert settings.extra_stats_sinks[0].options["numPartitions"] == "3"
    with pytest.raises(ValueError):
        Settings.from_env({"TABLES_PATH": "/data", "FAIL_ON_DATA_LOSS": "no"})


def test_a_missing_driver_is_found_at_the_start(spark):
    with pytest.raises(ValueError, match="driver"):
        jdbc_sink("db", "jdbc:x://h/d", "t", "u", "p", "no.such.Driver").check(spark)
    jdbc_sink("db", "jdbc:x://h/d", "t", "u", "p", "java.lang.String").check(spark)
