"""External systems: Kafka topics, JDBC databases, catalog tables.

These are the Spark data-source calls only. The Kafka connector jar and
JDBC drivers are not on this container's classpath, so the calls are not
exercised by the tests; everything on either side of them (record
decoding/encoding, parsing, windowing, upsert) is, through
``mercato.streaming.events`` and the file-based stand-ins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mercato.streaming.events import encode_records


def read_kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming frame over a topic: key, value (binary), topic, partition,
    offset, timestamp (S9, T15). ``maxOffsetsPerTrigger`` bounds a
    micro-batch after a backlog (a replay from ``earliest``)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def read_kafka_batch(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """The whole topic from the earliest offset as a batch frame (S10);
    decode it with ``events.decode_records``."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .load()
    )


def write_kafka(df: DataFrame, servers: str, topic: str, key_col: str) -> None:
    """Publish rows as keyed JSON records (K14): the key decides the topic
    partition, so one publisher's events keep their order."""
    (
        encode_records(df, key_col)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str], partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, partitions: int | None = None) -> DataFrame:
    """A database table as a frame; with a numeric ``partition_column`` the
    read is split into ``partitions`` parallel range queries."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append",
               batch_size: int = 10000) -> None:
    """Batched insert into a database table (the reference's ``executemany``)."""
    df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size).options(
        **properties
    ).mode(mode).save()


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """``FROM db.table`` through the session catalog."""
    return spark.table(name)
