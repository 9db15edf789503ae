"""Queries: OHLCV roll-ups and market aggregates."""

import datetime as dt

from ..operators import indicators as I, rollups as R
from ..operators.series import since
from . import sql_blocks as Q
from .catalog import register
from .common import TICK_SPEC, flat_window, newest_day, rounded, ticks, trades

OHLC_D = ("open_price", "high_price", "low_price", "close_price", "total_volume",
          "total_value_usd", "avg_trade_size", "buy_volume", "sell_volume", "vwap")
DAILY_D = ("open_price", "high_price", "low_price", "close_price", "total_volume",
           "total_value_usd", "avg_hourly_volume", "max_hourly_volume", "price_change",
           "price_change_pct")
M5_D = ("avg_price_5min", "max_price_5min", "min_price_5min", "total_volume_5min",
        "avg_rsi_5min", "price_range_5min", "volatility_5min")
HOURLY_SQL = Q.HOURLY
HOUR_AS_OF = f"(SELECT max(hour_timestamp) FROM ({HOURLY_SQL}) AS hx)"


def _hourly(spark, d):
    return R.hourly_ohlcv(trades(spark, d))


def _enriched(spark, d):
    return I.technical_indicators(ticks(spark, d), spec=TICK_SPEC)


@register("hourly_ohlcv", HOURLY_SQL, OHLC_D)
def hourly_ohlcv(spark, d):
    return rounded(_hourly(spark, d))


@register("hourly_ohlcv_symbols",
          Q.hourly(f"SELECT * FROM ({Q.TRADES}) AS t WHERE symbol IN ('click', 'view')"), OHLC_D)
def hourly_ohlcv_symbols(spark, d):
    """The symbol IN-list option of the hourly roll-up."""
    return rounded(R.hourly_ohlcv(trades(spark, d), symbols=["click", "view"]))


@register("daily_ohlcv", Q.daily(HOURLY_SQL), DAILY_D)
def daily_ohlcv(spark, d):
    return rounded(R.daily_ohlcv(_hourly(spark, d)))


@register("latest_aggregates",
          f"SELECT * FROM ({HOURLY_SQL}) AS h WHERE hour_timestamp >= {HOUR_AS_OF} - INTERVAL 24 HOUR",
          OHLC_D)
def latest_aggregates(spark, d):
    hourly, now = R.recent_hourly(trades(spark, d), 24)
    return rounded(R.latest_aggregates(hourly, hours=24, as_of=now))


@register("volume_leaders", f"""SELECT symbol, sum(total_volume) AS total_volume,
  CAST(sum(total_trades) AS BIGINT) AS total_trades, sum(total_value_usd) AS total_value_usd,
  avg(vwap) AS avg_vwap, sum(total_value_usd) / NULLIF(sum(total_volume), 0) AS vwap_weighted
FROM ({HOURLY_SQL}) AS h WHERE hour_timestamp >= {HOUR_AS_OF} - INTERVAL 24 HOUR
GROUP BY symbol ORDER BY total_volume DESC, symbol LIMIT 10""",
          ("total_volume", "total_value_usd", "avg_vwap", "vwap_weighted"))
def volume_leaders(spark, d):
    hourly, now = R.recent_hourly(trades(spark, d), 24)
    return rounded(R.volume_leaders(hourly, top_n=10, hours=24, as_of=now))


@register("dashboard_cache", f"""SELECT symbol, CAST(hour_timestamp AS DATE) AS trade_date,
  sum(total_volume) AS daily_volume, CAST(sum(total_trades) AS BIGINT) AS daily_trades,
  sum(total_value_usd) AS daily_value, min(low_price) AS daily_low, max(high_price) AS daily_high
FROM ({HOURLY_SQL}) AS h WHERE hour_timestamp >= {HOUR_AS_OF} - INTERVAL 7 DAY
GROUP BY 1, 2""", ("daily_volume", "daily_value", "daily_low", "daily_high"))
def dashboard_cache(spark, d):
    hourly, now = R.recent_hourly(trades(spark, d), 24 * 7)
    return rounded(R.dashboard_cache(hourly, days=7, as_of=now))


@register("market_5min", Q.market_5min(Q.indicators()), M5_D)
def market_5min(spark, d):
    return rounded(flat_window(R.market_5min(_enriched(spark, d))))


@register("market_summary", f"""SELECT window_start, window_end,
  avg(avg_price_5min) AS market_avg_price, sum(total_volume_5min) AS total_market_volume,
  avg(volatility_5min) AS avg_market_volatility, count(DISTINCT symbol) AS active_symbols,
  CAST(sum(CASE WHEN has_anomaly_5min THEN 1 ELSE 0 END) AS BIGINT) AS total_anomalies
FROM ({Q.market_5min(Q.indicators())}) AS m GROUP BY 1, 2""",
          ("market_avg_price", "total_market_volume", "avg_market_volatility"))
def market_summary(spark, d):
    return rounded(flat_window(R.market_summary(R.market_5min(_enriched(spark, d)))))


@register("hourly_symbol_analytics", f"""SELECT symbol, partition_date, partition_hour,
  avg(price) AS avg_price, max(price) AS max_price, min(price) AS min_price,
  sum(volume) AS total_volume, avg(rsi) AS avg_rsi, avg(macd_line) AS avg_macd,
  CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count,
  count(*) AS data_points,
  (max(price) - min(price)) / NULLIF(avg(price), 0) * 100 AS price_volatility
FROM ({Q.indicators()}) AS i GROUP BY 1, 2, 3""",
          ("avg_price", "max_price", "min_price", "total_volume", "avg_rsi", "avg_macd",
           "price_volatility"))
def hourly_symbol_analytics(spark, d):
    return rounded(R.hourly_symbol_analytics(_enriched(spark, d)))


@register("daily_performance", f"""SELECT symbol, partition_date,
  avg(price) AS avg_daily_price, max(price) AS max_daily_price, min(price) AS min_daily_price,
  (max(price) - min(price)) / NULLIF(avg(price), 0) * 100 AS daily_volatility,
  sum(volume) AS total_daily_volume, avg(rsi) AS avg_rsi,
  count(CASE WHEN is_anomaly THEN 1 END) AS anomaly_count
FROM ({Q.indicators()}) AS i
WHERE CAST(partition_date AS DATE) >= {Q.AS_OF_DATE} - INTERVAL 30 DAY
GROUP BY 1, 2""", ("avg_daily_price", "max_daily_price", "min_daily_price", "daily_volatility",
                   "total_daily_volume", "avg_rsi"))
def daily_performance(spark, d):
    now = newest_day(spark, d)
    near = since(ticks(spark, d), now - dt.timedelta(days=30), TICK_SPEC, I.COMPOSITE_LOOKBACK, "watermark_time")
    return rounded(R.daily_performance(I.technical_indicators(near, spec=TICK_SPEC), days=30, as_of=now))


@register("hourly_volume", f"""SELECT symbol,
  date_trunc('hour', make_timestamp(CAST("timestamp" AS BIGINT) * 1000000)) AS hour_bucket,
  sum(volume) AS hourly_volume, avg(price) AS avg_hourly_price, count(*) AS trade_frequency
FROM ({Q.TICKS}) AS t GROUP BY 1, 2""", ("hourly_volume", "avg_hourly_price"))
def hourly_volume(spark, d):
    return rounded(R.hourly_volume(ticks(spark, d)))


@register("daily_report", f"""SELECT CAST(trade_timestamp AS DATE) AS report_date,
  count(*) AS total_transactions, count(DISTINCT symbol) AS unique_symbols,
  sum(trade_value_usd) AS total_value_usd, avg(price) AS avg_price,
  min(trade_timestamp) AS first_trade, max(trade_timestamp) AS last_trade
FROM ({Q.TRADES}) AS t GROUP BY 1""", ("total_value_usd", "avg_price"))
def daily_report(spark, d):
    return rounded(R.daily_report(trades(spark, d)))
