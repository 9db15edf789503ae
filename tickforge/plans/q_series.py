"""Queries: per-symbol indicators (W1-W8, W13) and signals."""

from ..operators import indicators as I, signals as SG
from . import sql_blocks as Q
from .catalog import register
from .common import TICK_SPEC, TRADE_SPEC, bulk, rounded, ticks

TICK_D = ("price", "volume")
IND_D = TICK_D + ("price_lag_1", "price_change", "price_change_pct", "sma_20",
                  "price_volatility", "volume_sma_20", "gain", "loss", "avg_gain", "avg_loss",
                  "rs", "rsi", "ema_12", "ema_26", "macd_line", "macd_signal", "macd_histogram",
                  "price_mean", "price_stddev", "z_score")
RSI_D = TICK_D + ("price_change", "gain", "loss", "avg_gain", "avg_loss", "rs", "rsi")
MACD_D = TICK_D + ("ema_12", "ema_26", "macd_line", "macd_signal", "macd_histogram")


def _t(spark, d):
    return ticks(spark, d)


@register("price_change", Q.PRICE_CHANGE, TICK_D + ("price_lag_1", "price_change", "price_change_pct"))
def price_change(spark, d):
    return rounded(I.price_change(_t(spark, d), spec=TICK_SPEC))


@register("sma", Q.SMA, TICK_D + ("sma_20",))
def sma(spark, d):
    return rounded(I.sma(_t(spark, d), window=20, spec=TICK_SPEC))


@register("ema_rolling", Q.EMA_ROLLING, TICK_D + ("ema_20",))
def ema_rolling(spark, d):
    return rounded(I.ema(_t(spark, d), window=20, spec=TICK_SPEC))


@register("ema_recursive", Q.ema_recursive(2.0 / 21), TICK_D + ("ema_20_exp",))
def ema_recursive(spark, d):
    return rounded(I.ema_recursive(_t(spark, d), window=20, spec=TICK_SPEC))


@register("rsi", Q.RSI, RSI_D)
def rsi(spark, d):
    return rounded(I.rsi(_t(spark, d), window=14, spec=TICK_SPEC))


@register("macd", Q.MACD, MACD_D)
def macd(spark, d):
    return rounded(I.macd(_t(spark, d), spec=TICK_SPEC))


@register("bollinger", Q.BOLLINGER, TICK_D + ("bb_middle", "bb_std", "bb_upper", "bb_lower"))
def bollinger(spark, d):
    return rounded(I.bollinger_bands(_t(spark, d), spec=TICK_SPEC))


@register("price_anomalies", Q.ANOMALIES, TICK_D + ("price_mean", "price_stddev", "z_score"))
def price_anomalies(spark, d):
    return rounded(I.price_anomalies(_t(spark, d), spec=TICK_SPEC))


@register("volatility", Q.VOLATILITY, TICK_D + ("return", "volatility"))
def volatility(spark, d):
    return rounded(I.volatility(_t(spark, d), spec=TICK_SPEC))


@register("technical_indicators", Q.indicators(), IND_D)
def technical_indicators(spark, d):
    return rounded(I.technical_indicators(_t(spark, d), spec=TICK_SPEC))


@register("rsi_signals",
          f"SELECT *, CASE WHEN rsi < 30 THEN 'BUY' WHEN rsi > 70 THEN 'SELL' ELSE 'HOLD' END AS rsi_signal FROM ({Q.RSI}) AS r",
          RSI_D)
def rsi_signals(spark, d):
    return rounded(SG.generate_rsi_signals(I.rsi(_t(spark, d), spec=TICK_SPEC)))


MACD_SIG_SQL = f"""WITH m AS ({Q.MACD}),
p AS (SELECT *, lag(macd_line) OVER {Q.w(None)} AS prev_macd_line,
        lag(macd_signal) OVER {Q.w(None)} AS prev_macd_signal FROM m)
SELECT *, CASE WHEN macd_line > macd_signal AND prev_macd_line <= prev_macd_signal THEN 'BUY'
               WHEN macd_line < macd_signal AND prev_macd_line >= prev_macd_signal THEN 'SELL'
               ELSE 'HOLD' END AS macd_signal_trade FROM p"""


@register("macd_signals", MACD_SIG_SQL, MACD_D + ("prev_macd_line", "prev_macd_signal"))
def macd_signals(spark, d):
    return rounded(SG.macd_with_signals(_t(spark, d), spec=TICK_SPEC))


@register("combined_signals", Q.signals(Q.indicators()),
          IND_D + ("prev_macd_line", "prev_macd_signal"))
def combined_signals(spark, d):
    return rounded(SG.indicators_with_signals(_t(spark, d), spec=TICK_SPEC))


@register("trading_signals", f"""SELECT symbol, price, rsi, macd_line, macd_signal,
  CASE WHEN rsi < 30 AND macd_line > macd_signal THEN 'BUY_SIGNAL'
       WHEN rsi > 70 AND macd_line < macd_signal THEN 'SELL_SIGNAL' ELSE 'HOLD' END AS trading_signal,
  watermark_time
FROM ({Q.indicators()}) AS i WHERE rsi IS NOT NULL AND macd_line IS NOT NULL""",
          ("price", "rsi", "macd_line", "macd_signal"))
def trading_signals(spark, d):
    ind = I.technical_indicators(_t(spark, d), spec=TICK_SPEC)
    return rounded(SG.trading_signals(ind, order_col="watermark_time"))


BULK_IND_SQL = Q.indicators(
    Q.BULK.replace("l_quantity AS quantity,", "l_quantity AS volume,"),
    order="trade_timestamp, trade_id")


@register("bulk_indicators", BULK_IND_SQL, IND_D)
def bulk_indicators(spark, d):
    """Composite indicators over the lineitem-derived many-symbol trade stream."""
    b = bulk(spark, d).withColumnRenamed("quantity", "volume")
    return rounded(I.technical_indicators(b, spec=TRADE_SPEC))
