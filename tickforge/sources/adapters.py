"""Adapters that present the driver's tables as trade and tick streams.

* ``trades``      - events  -> canonical trade rows (symbol = event_type)
* ``ticks``       - events  -> ticker rows (price, volume, epoch-second timestamp)
* ``trades_bulk`` - lineitem -> many-symbol trade rows for benchmarks

Every adapter is a projection: it adds no shuffle, keeps the parquet scan's
column pruning and lets Catalyst push later filters to the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _prop_k(props: str = "props") -> Column:
    return F.get_json_object(F.col(props), "$.k").try_cast("double")


def trades(events: DataFrame) -> DataFrame:
    """events -> trades(symbol, trade_id, price, quantity, is_buyer_maker,
    trade_timestamp, trade_value_usd)."""
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("event_id").alias("trade_id"),
        F.col("value").alias("price"),
        _prop_k().alias("quantity"),
        ((F.col("user_id") % 2) == 0).alias("is_buyer_maker"),
        F.col("ts").alias("trade_timestamp"),
    ).withColumn("trade_value_usd", F.col("price") * F.col("quantity"))


def ticks(events: DataFrame) -> DataFrame:
    """events -> ticks(symbol, price, volume, timestamp[s], watermark_time,
    partition_date, partition_hour, event_id). Series order is (watermark_time, event_id)."""
    ts = F.col("ts")
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        _prop_k().alias("volume"),
        F.unix_seconds(ts.cast("timestamp")).alias("timestamp"),
        ts.alias("watermark_time"),
        F.date_format(ts, "yyyy-MM-dd").alias("partition_date"),
        F.date_format(ts, "HH").alias("partition_hour"),
        F.col("event_id"),
    )


def trades_bulk(lineitem: DataFrame) -> DataFrame:
    """lineitem -> trades with ~1000 symbols per sf0.1 (symbol = supplier key).
    trade_id packs (orderkey, linenumber) so (trade_timestamp, trade_id) is a total order."""
    return lineitem.select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("trade_id"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_returnflag") == "R").alias("is_buyer_maker"),
        F.col("l_shipdate").alias("trade_timestamp"),
    ).withColumn("trade_value_usd", F.col("price") * F.col("quantity"))
