"""Topics as sources: records with ``key, value, topic, partition, offset, timestamp``.

The live source needs Spark's Kafka package on the classpath. A recorded topic
is a folder of Parquet files with the same columns; everything downstream reads
either.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint,"
    " timestamp timestamp"
)
_CORRUPT = "_corrupt_record"
FILE_ROWS = 200_000  # of a recorded topic, which a task sorts


@dataclass(frozen=True)
class Topic:
    """Where a topic is and from which end to read it."""

    name: str
    servers: str = "localhost:9092"
    start: str = "latest"  # or "earliest"
    group: str | None = None
    max_per_trigger: int | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def read_options(self, partitions: Sequence[int] | None = None) -> dict[str, str]:
        """For the whole topic, or for some of its partitions."""
        what = (
            {"subscribe": self.name}
            if partitions is None
            else {"assign": json.dumps({self.name: list(partitions)})}
        )
        options = {
            "kafka.bootstrap.servers": self.servers,
            **what,
            "startingOffsets": self.start,
            # A lost offset ends the job instead of leaving a silent gap.
            "failOnDataLoss": "true",
        }
        if self.group:
            options["kafka.group.id"] = self.group
        if self.max_per_trigger:
            options["maxOffsetsPerTrigger"] = str(self.max_per_trigger)
        return {**options, **self.extra}

    def write_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers, "topic": self.name, **self.extra}


def read_topic(spark: SparkSession, topic: Topic) -> DataFrame:
    return spark.readStream.format("kafka").options(**topic.read_options()).load()


def read_partitions(spark: SparkSession, topic: Topic, partitions: Sequence[int]) -> list[DataFrame]:
    """A stream for each partition, for `slowest_watermark`."""
    reader = spark.readStream.format("kafka")
    return [reader.options(**topic.read_options([p])).load() for p in partitions]


def read_topic_batch(spark: SparkSession, topic: Topic) -> DataFrame:
    """The whole topic as a table; a batch read always starts at the earliest offset."""
    options = {k: v for k, v in topic.read_options().items() if k != "maxOffsetsPerTrigger"}
    options["startingOffsets"] = "earliest"
    return spark.read.format("kafka").options(**options).load()


def recorded_topic(
    spark: SparkSession, path: str, streaming: bool = True, max_files: int | None = None
) -> DataFrame:
    if not streaming:
        return spark.read.schema(RECORD_SCHEMA).parquet(path)
    reader = spark.readStream.schema(RECORD_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def record_partitions(records: DataFrame, path: str, files: int | None = None) -> None:
    """Records a topic with a folder for each partition, in about ``files`` files each, by offset.

    Without a number there is one for every `FILE_ROWS` records of the topic. A task sorts
    the records of its range of offsets.
    """
    if files is None:
        files = 1 + records.count() // FILE_ROWS
    spread = records.repartitionByRange(files, "offset").sortWithinPartitions("partition", "offset")
    spread.write.partitionBy("partition").parquet(path)


def recorded_partitions(
    spark: SparkSession, path: str, partitions: Sequence[int], max_files: int | None = None
) -> list[DataFrame]:
    """A stream for each partition of what `record_partitions` wrote."""
    whole = T.StructType.fromDDL(RECORD_SCHEMA)
    stored = T.StructType([f for f in whole if f.name != "partition"])
    found = []
    for partition in partitions:
        reader = spark.readStream.schema(stored)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        rows = reader.parquet(f"{path}/partition={partition}")
        found.append(rows.withColumn("partition", F.lit(partition)).select(whole.fieldNames()))
    return found


def json_rows(
    records: DataFrame,
    schema: str | T.StructType,
    keep: tuple[str, ...] = (),
    on_error: str = "fail",
) -> DataFrame:
    """Rows of a plain JSON topic; records without a value are dropped.

    A record that isn't JSON, or has a field that doesn't fit its type, ends the job,
    or with ``on_error="skip"`` gives no row.
    """
    if on_error not in ("fail", "skip"):
        raise ValueError(f"on_error is 'fail' or 'skip', not {on_error!r}")
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = T.StructType([*fields.fields, T.StructField(_CORRUPT, T.StringType())])
    text = F.col("value").cast("string")
    parsed = F.from_json(text, whole, {"columnNameOfCorruptRecord": _CORRUPT})
    bad = F.col("__m").isNull() | F.col("__m")[_CORRUPT].isNotNull()
    row = F.array(F.struct(*[F.col("__m")[f.name].alias(f.name) for f in fields.fields]))
    if on_error == "skip":
        rows = F.when(~bad, row)
    else:
        why = F.concat(F.lit("Corrupt JSON record: "), F.col("value").cast("string"))
        rows = F.when(bad, F.raise_error(why)).otherwise(row)
    # The filter is part of what is exploded: moved below the parse, it would parse twice.
    rows = F.when(F.col("value").isNotNull(), rows)
    parsed_once = records.select(*keep, "value", parsed.alias("__m"))
    return parsed_once.select(*keep, F.explode(rows).alias("row")).select(*keep, "row.*")


def drop_replays(
    records: DataFrame,
    message_id: str = "message_id",
    event_time: str | None = None,
    delay: str = "10 minutes",
) -> DataFrame:
    """One record per message id, for topics whose writer is at least once.

    On a stream, repeats are recognised for ``delay`` of event time, which
    bounds the state.
    """
    if not records.isStreaming:
        return records.dropDuplicates([message_id])
    if event_time is None:
        raise ValueError("a stream needs an event time to forget old ids")
    return records.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(
        [message_id]
    )
