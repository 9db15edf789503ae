"""File landing and table metadata sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def load_files(spark: SparkSession, path: str, fmt: str = "parquet", schema=None,
               **options) -> DataFrame:
    """Bulk read PARQUET / AVRO / CSV / JSON; without ``schema`` the
    reader infers it (autodetect). Write disposition is a sink concern
    (``sinks.tables.write_table(mode="WRITE_APPEND"|...)``)."""
    fmt = fmt.lower()
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    elif fmt in ("csv",):
        r = r.option("header", options.get("header", True)).option("inferSchema", True)
    return r.load(path)


def read_lake(spark: SparkSession, root: str) -> DataFrame:
    """Partitioned Parquet tree; partition columns come from the folder
    names (no recursiveFileLookup, which would drop them)."""
    return spark.read.parquet(root)


class _footers_only:
    """Context manager: Parquet counts are taken from file footers (aggregate push-down of the engine's
    second reader), no column is read."""
    SETTINGS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        self.before = {k: self.spark.conf.get(k, None) for k in self.SETTINGS}
        for k, v in self.SETTINGS.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *exc):
        for k, v in self.before.items():
            self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)
        return False


def counted(spark: SparkSession, path: str) -> DataFrame:
    """Row count of a Parquet path by its footers; to be run inside ``_footers_only``."""
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))


def table_stats(spark: SparkSession, path: str, table_name: str) -> DataFrame:
    """(table_name, rows, bytes, files) of a Parquet table, from footers and the file listing."""
    with _footers_only(spark):
        rows = counted(spark, path).first()["rows"]
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
             .select("length"))         # the content column is not read
    return files.agg(F.lit(table_name).alias("table_name"), F.lit(rows).cast("long").alias("rows"),
                     F.coalesce(F.sum("length"), F.lit(0).cast("long")).alias("bytes"), F.count(F.lit(1)).alias("files"))


def list_partitions(df: DataFrame, date_col: str, start=None, end=None) -> DataFrame:
    """Distinct partition days in the inclusive optional range, newest
    first, as yyyyMMdd ids."""
    d = F.to_date(F.col(date_col))
    out = df.select(d.alias("_d")).distinct()
    if start is not None:
        out = out.filter(F.col("_d") >= F.to_date(F.lit(str(start))))
    if end is not None:
        out = out.filter(F.col("_d") <= F.to_date(F.lit(str(end))))
    return out.orderBy(F.col("_d").desc()).select(F.date_format("_d", "yyyyMMdd").alias("partition_id"))


def table_info(spark: SparkSession, path: str, table_name: str, partition_cols=(), cluster_cols=()) -> DataFrame:
    """One row: rows, bytes, number of fields, partition / cluster columns; from footers and the listing."""
    fields = len(spark.read.parquet(path).columns)
    return table_stats(spark, path, table_name).select(
        "table_name", F.col("rows").alias("num_rows"), F.col("bytes").alias("num_bytes"),
        F.lit(fields).alias("num_fields"),
        F.lit(",".join(partition_cols)).alias("partition_columns"),
        F.lit(",".join(cluster_cols)).alias("cluster_columns"))
