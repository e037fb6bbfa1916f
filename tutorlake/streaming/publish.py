"""Publishing of text files to a topic, or to the folder that stands in for one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def publish(lines: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Send each line as a message. Needs the Kafka connector on the classpath."""
    writer = lines.select("value").write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("topic", topic).options(**options).save()


def publish_files(lines: DataFrame, folder: str) -> None:
    """Add each line to text files in a folder that a file stream reads."""
    lines.select("value").write.mode("append").text(folder)
