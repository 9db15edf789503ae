"""OHLCV and market roll-ups.

Group keys always include a time bucket next to the symbol, so a hot symbol
spreads over many reduce groups, and every aggregate here (min/max/sum/count,
min_by/max_by) is partial-aggregated map side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed as FX
from ..functions.columns import lookback_start, order_key, pct, resolve_as_of, safe_div, to_ntz


def _filter_symbols(df: DataFrame, symbols) -> DataFrame:
    return df if not symbols else df.filter(F.col("symbol").isin(list(symbols)))


def _range(df: DataFrame, col: str, start=None, end=None) -> DataFrame:
    """Half-open [start, end)."""
    if start is not None:
        df = df.filter(F.col(col) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(col) < F.lit(end))
    return df


def hourly_ohlcv(trades: DataFrame, start=None, end=None, symbols=None,
                 ts: str = "trade_timestamp", tiebreak: str = "trade_id",
                 aggregation_time: Column | None = None, date_col: str = "trade_date") -> DataFrame:
    """A1: per (symbol, hour) open/high/low/close, volumes, trades, value, VWAP.

    open/close are the first/last price by (timestamp, tiebreak). With
    ``start`` and no ``end`` the range is one hour (reference default)."""
    if start is not None and end is None:
        end = F.lit(start) + F.expr("INTERVAL 1 HOUR")
    df = _filter_symbols(trades, symbols)
    # On a day-partitioned table, repeat the bounds on the partition column so
    # the scan prunes whole partitions (a timestamp filter alone cannot).
    by_day = date_col if date_col in trades.columns else None
    if start is not None:
        df = df.filter(F.col(ts) >= F.lit(start))
        if by_day:
            df = df.filter(F.col(by_day) >= F.to_date(F.lit(start)))
    if end is not None:
        e = end if isinstance(end, Column) else F.lit(end)
        df = df.filter(F.col(ts) < e)
        if by_day:
            df = df.filter(F.col(by_day) <= F.to_date(e))
    order = order_key(F.col(ts), F.col(tiebreak))
    q, bm = F.col("quantity"), F.col("is_buyer_maker")
    out = (df.groupBy("symbol", to_ntz(F.date_trunc("hour", F.col(ts))).alias("hour_timestamp"))
             .agg(F.min_by("price", order).alias("open_price"),
                  F.max("price").alias("high_price"),
                  F.min("price").alias("low_price"),
                  F.max_by("price", order).alias("close_price"),
                  F.sum(q).alias("total_volume"),
                  F.count(F.lit(1)).alias("total_trades"),
                  F.sum("trade_value_usd").alias("total_value_usd"),
                  F.avg(q).alias("avg_trade_size"),
                  F.sum(F.when(~bm, q).otherwise(F.lit(0.0))).alias("buy_volume"),
                  F.sum(F.when(bm, q).otherwise(F.lit(0.0))).alias("sell_volume"),
                  safe_div(F.sum("trade_value_usd"), F.sum(q)).alias("vwap")))
    if aggregation_time is not None:
        out = out.withColumn("aggregation_time", aggregation_time)
    return out


def daily_ohlcv(hourly: DataFrame, day=None, symbols=None,
                aggregation_time: Column | None = None) -> DataFrame:
    """A2: daily roll-up *of hourly rows* (first open, last close by hour)."""
    df = _filter_symbols(hourly, symbols)
    if day is not None:
        df = df.filter(F.to_date("hour_timestamp") == F.to_date(F.lit(str(day))))
    h = F.col("hour_timestamp")
    out = (df.groupBy("symbol", F.to_date(h).alias("trade_date"))
             .agg(F.min_by("open_price", h).alias("open_price"),
                  F.max("high_price").alias("high_price"),
                  F.min("low_price").alias("low_price"),
                  F.max_by("close_price", h).alias("close_price"),
                  F.sum("total_volume").alias("total_volume"),
                  F.sum("total_trades").alias("total_trades"),
                  F.sum("total_value_usd").alias("total_value_usd"),
                  F.avg("total_volume").alias("avg_hourly_volume"),
                  F.max("total_volume").alias("max_hourly_volume"))
             .withColumn("price_change", F.col("close_price") - F.col("open_price"))
             .withColumn("price_change_pct", pct(F.col("price_change"), F.col("open_price"))))
    if aggregation_time is not None:
        out = out.withColumn("aggregation_time", aggregation_time)
    return out


def recent_hourly(trades: DataFrame, hours: float, as_of=None, ts: str = "trade_timestamp"):
    """(A1 rows of the last ``hours`` before ``as_of``'s hour, that hour). The cut-off is put on
    the raw time column before the roll-up, so files and row groups outside it are not read; with
    ``as_of`` given, nothing else of the table is read either."""
    now = to_ntz(F.date_trunc("hour", resolve_as_of(trades, ts, as_of)))
    end = now + F.expr("INTERVAL 1 HOUR")
    return hourly_ohlcv(trades, start=to_ntz(lookback_start(now, hours=hours)), end=end, ts=ts), now


def latest_aggregates(hourly: DataFrame, symbol=None, hours: int = FX.LATEST_HOURS,
                      as_of=None) -> DataFrame:
    """Hourly rows of the last ``hours`` hours (one symbol or all), newest first.
    ``as_of`` defaults to the newest hour in the table."""
    now = resolve_as_of(hourly, "hour_timestamp", as_of)
    df = hourly if symbol is None else hourly.filter(F.col("symbol") == F.lit(symbol))
    return (df.filter(F.col("hour_timestamp") >= lookback_start(now, hours=hours))
              .orderBy(F.col("hour_timestamp").desc(), F.col("symbol")))


def volume_leaders(hourly: DataFrame, top_n: int = FX.LEADERS_TOP_N, hours: int = FX.LEADERS_HOURS,
                   as_of=None) -> DataFrame:
    """Top-N symbols by volume over the look-back; avg_vwap is the
    unweighted mean of hourly VWAPs, vwap_weighted the value-weighted one."""
    now = resolve_as_of(hourly, "hour_timestamp", as_of)
    return (hourly.filter(F.col("hour_timestamp") >= lookback_start(now, hours=hours))
                  .groupBy("symbol")
                  .agg(F.sum("total_volume").alias("total_volume"),
                       F.sum("total_trades").alias("total_trades"),
                       F.sum("total_value_usd").alias("total_value_usd"),
                       F.avg("vwap").alias("avg_vwap"),
                       safe_div(F.sum("total_value_usd"), F.sum("total_volume")).alias("vwap_weighted"))
                  .orderBy(F.col("total_volume").desc(), F.col("symbol"))
                  .limit(top_n))


def dashboard_cache(hourly: DataFrame, days: int = FX.DASHBOARD_DAYS, as_of=None) -> DataFrame:
    """Symbol x day volume/trades/value/low/high over the last ``days`` days."""
    now = resolve_as_of(hourly, "hour_timestamp", as_of)
    return (hourly.filter(F.col("hour_timestamp") >= lookback_start(now, days=days))
                  .groupBy("symbol", F.to_date("hour_timestamp").alias("trade_date"))
                  .agg(F.sum("total_volume").alias("daily_volume"),
                       F.sum("total_trades").alias("daily_trades"),
                       F.sum("total_value_usd").alias("daily_value"),
                       F.min("low_price").alias("daily_low"),
                       F.max("high_price").alias("daily_high")))


def market_5min(enriched: DataFrame, ts: str = "watermark_time", window: str = FX.MARKET_WINDOW,
                watermark: str | None = None) -> DataFrame:
    """A3: tumbling window x symbol over indicator-enriched ticks. The same code
    runs on a stream (pass ``watermark``, e.g. "10 minutes")."""
    df = enriched
    if watermark:
        df = df.withWatermark(ts, watermark)
    return (df.groupBy(F.window(ts, window).alias("window"), "symbol")
              .agg(F.avg("price").alias("avg_price_5min"),
                   F.max("price").alias("max_price_5min"),
                   F.min("price").alias("min_price_5min"),
                   F.sum("volume").alias("total_volume_5min"),
                   F.count(F.lit(1)).alias("trade_count_5min"),
                   F.avg("rsi").alias("avg_rsi_5min"),
                   F.max("is_anomaly").alias("has_anomaly_5min"))
              .withColumn("price_range_5min", F.col("max_price_5min") - F.col("min_price_5min"))
              .withColumn("volatility_5min", pct(F.col("price_range_5min"), F.col("avg_price_5min"))))


def market_summary(market: DataFrame) -> DataFrame:
    """A5: market-wide figures per 5-minute window from A3 rows."""
    return (market.groupBy("window")
                  .agg(F.avg("avg_price_5min").alias("market_avg_price"),
                       F.sum("total_volume_5min").alias("total_market_volume"),
                       F.avg("volatility_5min").alias("avg_market_volatility"),
                       F.countDistinct("symbol").alias("active_symbols"),
                       F.sum(F.when(F.col("has_anomaly_5min"), 1).otherwise(0)).cast("long")
                       .alias("total_anomalies")))


def hourly_symbol_analytics(enriched: DataFrame) -> DataFrame:
    """A4: symbol x partition_date x partition_hour statistics."""
    return (enriched.groupBy("symbol", "partition_date", "partition_hour")
                    .agg(F.avg("price").alias("avg_price"),
                         F.max("price").alias("max_price"),
                         F.min("price").alias("min_price"),
                         F.sum("volume").alias("total_volume"),
                         F.avg("rsi").alias("avg_rsi"),
                         F.avg("macd_line").alias("avg_macd"),
                         F.sum(F.when(F.col("is_anomaly"), 1).otherwise(0)).cast("long")
                         .alias("anomaly_count"),
                         F.count(F.lit(1)).alias("data_points"))
                    .withColumn("price_volatility",
                                pct(F.col("max_price") - F.col("min_price"), F.col("avg_price"))))


def daily_performance(enriched: DataFrame, days: int | None = FX.PERFORMANCE_DAYS,
                      as_of=None) -> DataFrame:
    """Symbol x day price performance over the last ``days`` days
    (None = every day). ``as_of`` defaults to the newest partition_date."""
    df = enriched.withColumn("_d", F.to_date("partition_date"))
    if days is not None:
        now = resolve_as_of(df, "_d", as_of)
        df = df.filter(F.col("_d") >= F.date_sub(F.to_date(now), days))
    return (df.groupBy("symbol", "partition_date")
              .agg(F.avg("price").alias("avg_daily_price"),
                   F.max("price").alias("max_daily_price"),
                   F.min("price").alias("min_daily_price"),
                   pct(F.max("price") - F.min("price"), F.avg("price")).alias("daily_volatility"),
                   F.sum("volume").alias("total_daily_volume"),
                   F.avg("rsi").alias("avg_rsi"),
                   F.count(F.when(F.col("is_anomaly"), 1)).alias("anomaly_count"))
              .orderBy("symbol", "partition_date"))


def hourly_volume(enriched: DataFrame, day=None) -> DataFrame:
    """A10: symbol x hour (from epoch-second timestamp) volume, mean price,
    trade count; ``day`` restricts to one partition_date (None = all days)."""
    df = enriched if day is None else enriched.filter(
        F.to_date("partition_date") == F.to_date(F.lit(str(day))))
    hb = to_ntz(F.date_trunc("hour", F.timestamp_seconds("timestamp"))).alias("hour_bucket")
    return (df.groupBy("symbol", hb)
              .agg(F.sum("volume").alias("hourly_volume"),
                   F.avg("price").alias("avg_hourly_price"),
                   F.count(F.lit(1)).alias("trade_frequency"))
              .orderBy("symbol", "hour_bucket"))


def daily_report(trades: DataFrame, day=None, ts: str = "trade_timestamp") -> DataFrame:
    """Per-day operational report (total trades, distinct symbols, value,
    mean price, first/last trade time). ``day`` = one day, None = every day."""
    d = F.to_date(F.col(ts))
    df = trades if day is None else trades.filter(d == F.to_date(F.lit(str(day))))
    return (df.groupBy(d.alias("report_date"))
              .agg(F.count(F.lit(1)).alias("total_transactions"),
                   F.countDistinct("symbol").alias("unique_symbols"),
                   F.sum("trade_value_usd").alias("total_value_usd"),
                   F.avg("price").alias("avg_price"),
                   F.min(ts).alias("first_trade"),
                   F.max(ts).alias("last_trade")))


def scheduled_hour_bounds(execution_time, lookback_hours: int = FX.SCHEDULED_LOOKBACK_HOURS):
    """Bounds for a scheduled hourly roll-up: [trunc_hour(t - lookback), t).
    Aligning the lower bound to the hour keeps a run from replacing a full
    hour with a partial one (the un-aligned look-back does)."""
    t = execution_time if isinstance(execution_time, Column) else F.lit(execution_time).cast("timestamp_ntz")
    start = to_ntz(F.date_trunc("hour", t - F.make_dt_interval(F.lit(0), F.lit(int(lookback_hours)))))
    return start, t
