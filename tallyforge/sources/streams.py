"""Streaming sources, all brought to the columns ``value`` and ``timestamp``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def kafka_options(servers: str, topic: str, starting: str = "latest") -> dict[str, str]:
    """Options of a Kafka topic read. Spark keeps the offsets in the query's checkpoint,
    so no consumer group is named."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }


def socket_options(host: str, port: int) -> dict[str, str]:
    return {"host": host, "port": str(port), "includeTimestamp": "true"}


def event_stream(spark: SparkSession, fmt: str, options: dict[str, str]) -> DataFrame:
    """Stream of ``value`` and ``timestamp`` from ``kafka``, ``socket`` or ``rate``.

    ``value`` is left as the source gives it (binary for Kafka).
    """
    return spark.readStream.format(fmt).options(**options).load().select("value", "timestamp")


def table_stream(
    spark: SparkSession,
    folder: str,
    name: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Replay of a parquet table as a stream.

    ``max_files`` / ``max_bytes`` bound one micro-batch; set one of them for a
    backfill whose files would not fit in a single batch. Timestamps without a time
    zone are turned into instants, since watermarks need those.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    # A pattern, since a stream cannot start from the path of a single file.
    df = reader.parquet(f"{folder}/{name}.parque[t]")
    naive = [c for c, kind in df.dtypes if kind == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df
