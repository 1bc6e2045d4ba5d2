"""Where messages come from: a Kafka topic, or files with the same columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class MessageSource:
    """A reader format with its options; ``value`` is the message column it yields."""

    format: str
    options: dict[str, str] = field(default_factory=dict)
    schema: str | None = None

    def stream(self, spark: SparkSession) -> DataFrame:
        return self._configured(spark.readStream)

    def batch(self, spark: SparkSession) -> DataFrame:
        return self._configured(spark.read)

    def _configured(self, reader) -> DataFrame:
        reader = reader.format(self.format).options(**self.options)
        return (reader.schema(self.schema) if self.schema else reader).load()


def kafka_source(
    servers: str,
    topic: str | None = None,
    topic_pattern: str | None = None,
    start: str = "latest",
    fail_on_data_loss: bool = True,
    max_records_per_batch: int | None = 5_000_000,
    **more: str,
) -> MessageSource:
    """A Kafka topic, or all topics whose name matches a regular expression.

    ``start`` only matters on the first run; later the checkpoint decides.
    With ``fail_on_data_loss=False`` expired offsets are skipped, which loses
    records without an error.  ``max_records_per_batch`` bounds a micro-batch.
    """
    if (topic is None) == (topic_pattern is None):
        raise ValueError("name either a topic or a topic pattern")
    options = {"kafka.bootstrap.servers": servers, "startingOffsets": start}
    options.update({"subscribe": topic} if topic else {"subscribePattern": topic_pattern})
    options["failOnDataLoss"] = str(fail_on_data_loss).lower()
    if max_records_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(max_records_per_batch)
    return MessageSource("kafka", {**options, **more})


def file_source(
    path: str,
    format: str = "text",
    schema: str | None = None,
    max_files_per_batch: int | None = None,
    max_age: str = "3650d",
) -> MessageSource:
    """Files with one message per row: text lines, or a ``value`` column.

    After the first batch, files older than ``max_age`` against the newest one
    seen are skipped without a word; the default keeps backfills of ten years.
    The source remembers every file of that time, so shorten it where files
    are many and never late.
    """
    options = {"path": path, "maxFileAge": max_age}
    if max_files_per_batch is not None:
        options["maxFilesPerTrigger"] = str(max_files_per_batch)
    return MessageSource(format, options, schema)
