"""Kafka sources and sinks. They need Spark's Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def source_options(host: str, port: int, topics: str, starting: str = "latest") -> dict[str, str]:
    """Reader options; several topics are separated by ``;``."""
    names = [t.strip() for t in topics.split(";") if t.strip()]
    if not names:
        raise ValueError("no topic given")
    return {"kafka.bootstrap.servers": f"{host}:{port}", "subscribe": ",".join(names),
            "startingOffsets": starting}


def sink_options(host: str, port: int, topic: str, **options: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": f"{host}:{port}", "topic": topic,
            **{f"kafka.{k}": v for k, v in options.items()}}


def read_stream(spark: SparkSession, host: str, port: int, topics: str) -> DataFrame:
    raw = spark.readStream.format("kafka").options(**source_options(host, port, topics)).load()
    return messages(raw)


def read_batch(spark: SparkSession, host: str, port: int, topics: str, n: int | None = None) -> DataFrame:
    """Messages present now, at most ``n``."""
    raw = spark.read.format("kafka").options(**source_options(host, port, topics, "earliest")).load()
    return first_messages(messages(raw), n)


def messages(raw: DataFrame) -> DataFrame:
    return raw.select("topic", F.col("value").cast("string").alias("message"), "timestamp")


def first_messages(df: DataFrame, n: int | None) -> DataFrame:
    """Stop after ``n`` messages; all of them for None or 0."""
    return df.limit(n) if n else df


def to_records(alerts: DataFrame, message: str = "message") -> DataFrame:
    """Rows in the form the Kafka sink takes."""
    return alerts.select(F.col(message).cast("string").alias("value"))


def write_stream(alerts: DataFrame, host: str, port: int, topic: str, checkpoint: str,
                 **options: str) -> DataStreamWriter:
    return (to_records(alerts).writeStream.format("kafka").options(**sink_options(host, port, topic, **options))
            .option("checkpointLocation", checkpoint))


def write_batch(alerts: DataFrame, host: str, port: int, topic: str, **options: str) -> None:
    to_records(alerts).write.format("kafka").options(**sink_options(host, port, topic, **options)).save()
