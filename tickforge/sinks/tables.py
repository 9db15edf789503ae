"""Writers and table maintenance on Parquet folders / catalog tables.

Parquet has no MERGE / DELETE, so keyed upserts (``sinks.versioned``) are an anti-join + union of
the *touched partitions only*, written to new folders that a manifest commit makes live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from .. import fixed as FX
from ..functions.columns import order_key

DISPOSITIONS = {"WRITE_APPEND": "append", "WRITE_TRUNCATE": "overwrite",
                "WRITE_EMPTY": "errorifexists"}

PARQUET_OPTIONS = {"compression": FX.PARQUET_COMPRESSION,
                   "parquet.block.size": str(FX.PARQUET_BLOCK_BYTES),
                   "parquet.page.size": str(FX.PARQUET_PAGE_BYTES)}


def write_table(df: DataFrame, path: str, partition_by=(), cluster_by=(),
                mode: str = "append", max_records_per_file: int | None = None, options=None) -> None:
    """Partitioned Parquet write. Rows are sorted
    within each task by (partition, cluster) columns so each task streams one
    file per partition value and row-group min/max stats stay selective."""
    mode = DISPOSITIONS.get(mode, mode)
    keys = list(partition_by) + list(cluster_by)
    out = df.sortWithinPartitions(*keys) if keys else df
    w = out.write.mode(mode).options(**PARQUET_OPTIONS, **(options or {}))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_counted(df: DataFrame, path: str, partition_by=()) -> int:
    """K8: append and return rows written, counted by an observation on the
    write itself (no second pass)."""
    from pyspark.sql import Observation
    obs = Observation("rows_written")
    write_table(df.observe(obs, F.count(F.lit(1)).alias("n")), path, partition_by, mode="append")
    return int(obs.get["n"])


def merge_rows(target: DataFrame, updates: DataFrame, keys) -> DataFrame:
    """K9/J3 semantics as a DataFrame: target rows without a matching key plus
    every update row (matched -> updated, not matched -> inserted)."""
    cols = target.columns
    u = updates.select(*cols)
    return target.join(u.select(*keys), list(keys), "left_anti").select(*cols).unionByName(u)


def retention_keep(df: DataFrame, date_col: str, days: int = FX.RETENTION_DAYS, as_of=None) -> DataFrame:
    """K12 as a DataFrame: rows whose ``date_col`` is within ``days`` of as_of
    (default: newest date in the table)."""
    d = F.to_date(F.col(date_col))
    now = df.select(F.max(d)).scalar() if as_of is None else F.to_date(F.lit(str(as_of)))
    return df.filter(d >= F.date_sub(now, days))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def partition_values(spark: SparkSession, path: str, partition_col: str) -> list[str]:
    """Partition directory values of a Parquet table (metadata listing only)."""
    fs, p = _fs(spark, path)
    pre = f"{partition_col}="
    return sorted(s.getPath().getName()[len(pre):] for s in fs.listStatus(p)
                  if s.isDirectory() and s.getPath().getName().startswith(pre))


def delete_partition(spark: SparkSession, path: str, partition_col: str, value) -> bool:
    """Drop one partition directory (no data rewrite)."""
    fs, p = _fs(spark, f"{path.rstrip('/')}/{partition_col}={value}")
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def apply_retention(spark: SparkSession, path: str, partition_col: str, keep_from: str) -> list[str]:
    """K12 on a day-partitioned table: delete whole partitions older than
    ``keep_from`` (yyyy-MM-dd); returns the dropped values."""
    dropped = [v for v in partition_values(spark, path, partition_col) if v < str(keep_from)]
    for v in dropped:
        delete_partition(spark, path, partition_col, v)
    return dropped


def create_table(spark: SparkSession, name: str, schema_ddl: str, partition_by=(), location=None):
    """CREATE TABLE IF NOT EXISTS ... USING parquet."""
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema_ddl}) USING parquet{part}{loc}")
    if location and partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def create_view(spark: SparkSession, name: str, query: str) -> None:
    """CREATE OR REPLACE VIEW over catalog tables."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def insert_rows(rows: DataFrame, schema, json_col: str = "json") -> tuple[DataFrame, DataFrame]:
    """JSON rows -> (typed good rows, errors). ``schema`` is a StructType or DDL text.
    A row is an error when it is not a JSON object, when a present value does not fit its
    target type, or when it has fields the table lacks."""
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = target.fieldNames()
    t = rows.select(F.col(json_col), F.from_json(F.col(json_col), target).alias("r"),
                    F.from_json(F.col(json_col), "map<string,string>").alias("m"))
    unfit = F.array_compact(F.array(*[F.when(F.col("m")[n].isNotNull() & F.col("r")[n].isNull(), F.lit(n))
                                      for n in names]))
    unknown = F.array_sort(F.array_except(F.map_keys("m"), F.array(*[F.lit(n) for n in names])))
    reasons = [F.when(F.col("m").isNull(), "not a JSON object"),
               F.when(F.size("_unfit") > 0, F.concat(F.lit("invalid fields: "), F.array_join("_unfit", ","))),
               F.when(F.size("_unknown") > 0, F.concat(F.lit("unknown fields: "), F.array_join("_unknown", ",")))]
    t = t.withColumns({"_unfit": unfit, "_unknown": unknown})
    t = t.withColumn("error", F.nullif(F.concat_ws("; ", *reasons), F.lit("")))
    return t.filter("error IS NULL").select("r.*"), t.filter("error IS NOT NULL").select(json_col, "error")


def latest_price_items(df: DataFrame, ttl_seconds: int = FX.KV_TTL_SECONDS,
                       as_decimal: bool = True, keep: tuple = ()) -> DataFrame:
    """K4/K15 + W11: newest row per symbol (ties by event_id), projected to the key-value
    item (decimal(38,18) numerics, ttl = timestamp + 86400, market_cap only when
    non-zero) and the columns to ``keep``. max_by is a partial aggregate: no per-symbol
    sort or shuffle of whole series."""
    cols = [c for c in ["price", "volume", "high_24h", "low_24h", "price_change_percent_24h",
                        "market_cap", "rsi", "macd_line", "is_anomaly", "source", *keep] if c in df.columns]
    order = order_key(F.col("timestamp"), F.col("event_id") if "event_id" in df.columns else F.lit(0),
                      primary_is_time=False)
    g = df.groupBy("symbol").agg(F.max("timestamp").alias("timestamp"),
                                 *[F.max_by(c, order).alias(c) for c in cols])
    dec = (lambda c: F.col(c).cast("decimal(38,18)")) if as_decimal else F.col
    out = [F.col("symbol"), F.col("timestamp")]
    for c in cols:
        if c == "market_cap":
            mc = F.nullif(F.col(c), F.lit(0.0))
            out.append((mc.cast("decimal(38,18)") if as_decimal else mc).alias(c))
        elif c in ("is_anomaly", "source", *keep):
            out.append(F.col(c))
        else:
            out.append(dec(c).alias(c))
    out.append((F.col("timestamp") + F.lit(ttl_seconds)).alias("ttl"))
    return g.select(*out)



KV_COLUMNS = ("symbol", "timestamp", "price", "rsi", "macd_line", "is_anomaly", "processing_time")


def kv_items(df: DataFrame, ttl_seconds: int = FX.KV_TTL_SECONDS, write_batch: int = 0,
             tiebreak: str = "event_id") -> DataFrame:
    """K4 item projection: one item per (symbol, timestamp) (later rows of the
    same key win, by ``tiebreak``), the item columns that exist, ttl =
    timestamp + 86400 and the batch that wrote it."""
    cols = [c for c in KV_COLUMNS if c in df.columns]
    order = [F.col(tiebreak).desc()] if tiebreak in df.columns else [F.lit(0)]
    latest = newest_of(df, ["symbol", "timestamp"], order).select(*cols)
    return latest.withColumns({"ttl": F.col("timestamp") + F.lit(ttl_seconds),
                               "write_batch": F.lit(write_batch).cast("long")})


def newest_of(df: DataFrame, keys, order) -> DataFrame:
    """First row per ``keys`` in ``order``; a map-side group limit keeps one row per key and
    task before the shuffle."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1").drop("_nth")
