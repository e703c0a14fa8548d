"""Kafka topics as streaming or batch text sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str, topic: str, starting: str = "latest", security: Mapping[str, str] | None = None, **extra: str
) -> dict[str, str]:
    """Reader options for one topic. ``security`` holds ``kafka.*`` client settings such as SASL."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    return options | dict(security or {}) | extra


def sasl_ssl(username: str, password: str, mechanism: str = "PLAIN") -> dict[str, str]:
    """Client settings for a SASL_SSL listener."""
    login = f'org.apache.kafka.common.security.plain.PlainLoginModule required username="{username}" password="{password}";'
    return {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": mechanism,
        "kafka.sasl.jaas.config": login,
    }


def stream_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Streaming rows ``key, value, topic, partition, offset, timestamp``.

    Needs the public ``spark-sql-kafka`` connector on the classpath.
    """
    return spark.readStream.format("kafka").options(**options).load()


def batch_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """The same rows as a bounded scan; a start at ``latest`` would be empty and is refused."""
    if options.get("startingOffsets", "earliest") == "latest":
        raise ValueError("a bounded scan can't start at the latest offsets")
    return spark.read.format("kafka").options(**{"startingOffsets": "earliest", **options}).load()
