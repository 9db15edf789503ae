"""Stream sources (S1, S2, T6): a connector format with options, or an
offline replay of landed files. Rate caps come from the source options."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def connector_stream(spark: SparkSession, fmt: str, **options) -> DataFrame:
    """S1/S2 against a message-bus connector on the classpath (the format name
    and its options, e.g. a subscription and a per-batch message cap)."""
    return spark.readStream.format(fmt).options(**options).load()


def replay_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None,
                  max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Replay landed files as a stream, oldest first (the file source reads
    from the earliest file, like a TRIM_HORIZON start)."""
    r = spark.readStream.format(fmt).schema(schema).option("latestFirst", "false")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    return r.load(path)
