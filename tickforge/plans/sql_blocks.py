"""Oracle SQL building blocks (DuckDB dialect) mirroring the adapters and
operators. Written independently of the Spark code: plain SQL with NULLIF-
guarded divisions (DuckDB returns inf/NaN where Spark returns NULL)."""

K = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"

TRADES = f"""SELECT event_type AS symbol, event_id AS trade_id, value AS price,
  {K} AS quantity, (user_id % 2 = 0) AS is_buyer_maker, ts AS trade_timestamp,
  value * {K} AS trade_value_usd
FROM events"""

TICKS = f"""SELECT event_type AS symbol, value AS price, {K} AS volume,
  CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp", ts AS watermark_time,
  strftime(ts, '%Y-%m-%d') AS partition_date, strftime(ts, '%H') AS partition_hour,
  event_id
FROM events"""

BULK = """SELECT CAST(l_suppkey AS VARCHAR) AS symbol, l_orderkey * 8 + l_linenumber AS trade_id,
  l_extendedprice / l_quantity AS price, l_quantity AS quantity,
  (l_returnflag = 'R') AS is_buyer_maker, l_shipdate AS trade_timestamp,
  (l_extendedprice / l_quantity) * l_quantity AS trade_value_usd
FROM lineitem"""


def hourly(src: str) -> str:
    return f"""SELECT symbol, date_trunc('hour', trade_timestamp) AS hour_timestamp,
  first(price ORDER BY trade_timestamp, trade_id) AS open_price,
  max(price) AS high_price, min(price) AS low_price,
  first(price ORDER BY trade_timestamp DESC, trade_id DESC) AS close_price,
  sum(quantity) AS total_volume, count(*) AS total_trades,
  sum(trade_value_usd) AS total_value_usd, avg(quantity) AS avg_trade_size,
  sum(CASE WHEN NOT is_buyer_maker THEN quantity ELSE 0 END) AS buy_volume,
  sum(CASE WHEN is_buyer_maker THEN quantity ELSE 0 END) AS sell_volume,
  sum(trade_value_usd) / NULLIF(sum(quantity), 0) AS vwap
FROM ({src}) AS tr GROUP BY 1, 2"""


def daily(hourly_src: str) -> str:
    return f"""SELECT symbol, CAST(hour_timestamp AS DATE) AS trade_date,
  first(open_price ORDER BY hour_timestamp) AS open_price,
  max(high_price) AS high_price, min(low_price) AS low_price,
  first(close_price ORDER BY hour_timestamp DESC) AS close_price,
  sum(total_volume) AS total_volume, CAST(sum(total_trades) AS BIGINT) AS total_trades,
  sum(total_value_usd) AS total_value_usd, avg(total_volume) AS avg_hourly_volume,
  max(total_volume) AS max_hourly_volume,
  first(close_price ORDER BY hour_timestamp DESC) - first(open_price ORDER BY hour_timestamp) AS price_change,
  (first(close_price ORDER BY hour_timestamp DESC) - first(open_price ORDER BY hour_timestamp))
    / NULLIF(first(open_price ORDER BY hour_timestamp), 0) * 100 AS price_change_pct
FROM ({hourly_src}) AS h GROUP BY 1, 2"""


def w(n: int | None, order: str = "watermark_time, event_id") -> str:
    frame = f" ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW" if n else ""
    return f"(PARTITION BY symbol ORDER BY {order}{frame})"


def indicators(src: str = TICKS, order: str = "watermark_time, event_id") -> str:
    """The 22 composite indicator columns over ordered per-symbol series."""
    W = lambda n=None: w(n, order)
    return f"""WITH a AS (SELECT *, lag(price) OVER {W()} AS price_lag_1 FROM ({src}) AS s),
b AS (SELECT *, price - price_lag_1 AS price_change,
        (price - price_lag_1) / NULLIF(price_lag_1, 0) * 100 AS price_change_pct FROM a),
c AS (SELECT *, avg(price) OVER {W(20)} AS sma_20,
        stddev_samp(price_change_pct) OVER {W(20)} AS price_volatility,
        avg(volume) OVER {W(20)} AS volume_sma_20,
        CASE WHEN price_change > 0 THEN price_change ELSE 0.0 END AS gain,
        CASE WHEN price_change < 0 THEN -price_change ELSE 0.0 END AS loss,
        avg(price) OVER {W(12)} AS ema_12, avg(price) OVER {W(26)} AS ema_26,
        avg(price) OVER {W(20)} AS price_mean, stddev_samp(price) OVER {W(20)} AS price_stddev
      FROM b),
d AS (SELECT *, avg(gain) OVER {W(14)} AS avg_gain, avg(loss) OVER {W(14)} AS avg_loss,
        ema_12 - ema_26 AS macd_line,
        (price - price_mean) / NULLIF(price_stddev, 0) AS z_score FROM c),
e AS (SELECT *, avg_gain / NULLIF(avg_loss, 0) AS rs,
        avg(macd_line) OVER {W(9)} AS macd_signal FROM d)
SELECT *, 100 - 100 / (1 + rs) AS rsi, macd_line - macd_signal AS macd_histogram,
  abs(z_score) > 2.5 AS is_anomaly,
  CASE WHEN z_score > 2.5 THEN 'price_spike' WHEN z_score < -2.5 THEN 'price_drop'
       ELSE 'normal' END AS anomaly_type
FROM e"""


def signals(ind_src: str, order: str = "watermark_time, event_id") -> str:
    """W9 + W10 + W10b on top of ``indicators``."""
    return f"""WITH i AS ({ind_src}),
p AS (SELECT *, lag(macd_line) OVER {w(None, order)} AS prev_macd_line,
        lag(macd_signal) OVER {w(None, order)} AS prev_macd_signal FROM i),
q AS (SELECT *,
        CASE WHEN rsi < 30 THEN 'BUY' WHEN rsi > 70 THEN 'SELL' ELSE 'HOLD' END AS rsi_signal,
        CASE WHEN macd_line > macd_signal AND prev_macd_line <= prev_macd_signal THEN 'BUY'
             WHEN macd_line < macd_signal AND prev_macd_line >= prev_macd_signal THEN 'SELL'
             ELSE 'HOLD' END AS macd_signal_trade FROM p)
SELECT *, CASE WHEN rsi_signal = 'BUY' AND macd_signal_trade = 'BUY' THEN 'STRONG_BUY'
               WHEN rsi_signal = 'SELL' AND macd_signal_trade = 'SELL' THEN 'STRONG_SELL'
               WHEN rsi_signal = 'BUY' OR macd_signal_trade = 'BUY' THEN 'BUY'
               WHEN rsi_signal = 'SELL' OR macd_signal_trade = 'SELL' THEN 'SELL'
               ELSE 'HOLD' END AS combined_signal
FROM q"""


def series_select(extra: str, src: str = TICKS, order: str = "watermark_time, event_id") -> str:
    """SELECT *, <extra window columns> over ordered ticks; ``{W(n)}`` in
    ``extra`` is replaced by the window clause."""
    out = extra
    for n in (None, 9, 12, 14, 20, 26):
        out = out.replace("{W(%s)}" % ("" if n is None else n), w(n, order))
    return f"SELECT *, {out} FROM ({src}) AS s"


PRICE_CHANGE = series_select(
    "lag(price) OVER {W()} AS price_lag_1, price - lag(price) OVER {W()} AS price_change,"
    " (price - lag(price) OVER {W()}) / NULLIF(lag(price) OVER {W()}, 0) * 100 AS price_change_pct")
SMA = series_select("avg(price) OVER {W(20)} AS sma_20")
EMA_ROLLING = series_select("avg(price) OVER {W(20)} AS ema_20")
BOLLINGER = f"""SELECT *, bb_middle + bb_std * 2.0 AS bb_upper, bb_middle - bb_std * 2.0 AS bb_lower
FROM ({series_select("avg(price) OVER {W(20)} AS bb_middle, stddev_samp(price) OVER {W(20)} AS bb_std")}) AS b"""
ANOMALIES = f"""SELECT *, abs(z_score) > 2.5 AS is_anomaly,
  CASE WHEN z_score > 2.5 THEN 'price_spike' WHEN z_score < -2.5 THEN 'price_drop' ELSE 'normal' END AS anomaly_type
FROM (SELECT *, (price - price_mean) / NULLIF(price_stddev, 0) AS z_score
      FROM ({series_select("avg(price) OVER {W(20)} AS price_mean, stddev_samp(price) OVER {W(20)} AS price_stddev")}) AS a) AS z"""
VOLATILITY = f"""SELECT *, stddev_samp("return") OVER {w(20)} AS volatility
FROM ({series_select('(price / NULLIF(lag(price) OVER {W()}, 0) - 1) * 100 AS "return"')}) AS r"""
RSI = f"""WITH c AS ({series_select("price - lag(price) OVER {W()} AS price_change")}),
g AS (SELECT *, CASE WHEN price_change > 0 THEN price_change ELSE 0.0 END AS gain,
        CASE WHEN price_change < 0 THEN -price_change ELSE 0.0 END AS loss FROM c),
a AS (SELECT *, avg(gain) OVER {w(14)} AS avg_gain, avg(loss) OVER {w(14)} AS avg_loss FROM g),
r AS (SELECT *, avg_gain / NULLIF(avg_loss, 0) AS rs FROM a)
SELECT *, 100 - 100 / (1 + rs) AS rsi FROM r"""
MACD = f"""WITH e AS ({series_select("avg(price) OVER {W(12)} AS ema_12, avg(price) OVER {W(26)} AS ema_26")}),
m AS (SELECT *, ema_12 - ema_26 AS macd_line FROM e),
s AS (SELECT *, avg(macd_line) OVER {w(9)} AS macd_signal FROM m)
SELECT *, macd_line - macd_signal AS macd_histogram FROM s"""


def ema_recursive(alpha: float, src: str = TICKS, order: str = "watermark_time, event_id") -> str:
    return f"""WITH RECURSIVE s AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY {order}) AS rn FROM ({src}) AS t),
r AS (SELECT symbol, rn, price AS ema FROM s WHERE rn = 1
      UNION ALL
      SELECT s.symbol, s.rn, (1 - {alpha!r}) * r.ema + {alpha!r} * s.price
      FROM r JOIN s ON s.symbol = r.symbol AND s.rn = r.rn + 1)
SELECT s.* EXCLUDE (rn), r.ema AS ema_20_exp FROM s JOIN r USING (symbol, rn)"""


HOURLY = hourly(TRADES)
AS_OF_TS = "(SELECT max(ts) FROM events)"
AS_OF_DATE = "(SELECT CAST(max(ts) AS DATE) FROM events)"


def market_5min(ind_src: str) -> str:
    return f"""SELECT time_bucket(INTERVAL '5 minutes', watermark_time) AS window_start,
  time_bucket(INTERVAL '5 minutes', watermark_time) + INTERVAL '5 minutes' AS window_end, symbol,
  avg(price) AS avg_price_5min, max(price) AS max_price_5min, min(price) AS min_price_5min,
  sum(volume) AS total_volume_5min, count(*) AS trade_count_5min, avg(rsi) AS avg_rsi_5min,
  bool_or(is_anomaly) AS has_anomaly_5min,
  max(price) - min(price) AS price_range_5min,
  (max(price) - min(price)) / NULLIF(avg(price), 0) * 100 AS volatility_5min
FROM ({ind_src}) AS i GROUP BY 1, 2, 3"""
