"""Trading signals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed as FX
from . import indicators as I
from . import series as S
from .series import SeriesSpec


def rsi_signal_col(rsi: str = "rsi", oversold: float = FX.RSI_OVERSOLD,
                   overbought: float = FX.RSI_OVERBOUGHT):
    """W9 as a column expression."""
    r = F.col(rsi)
    return _labelled(F.when(r < oversold, 1).when(r > overbought, -1))


def generate_rsi_signals(df: DataFrame, oversold: float = FX.RSI_OVERSOLD,
                         overbought: float = FX.RSI_OVERBOUGHT) -> DataFrame:
    """rsi_signal BUY (< oversold) / SELL (> overbought) / HOLD (incl. NULL rsi)."""
    return df.withColumn("rsi_signal", rsi_signal_col("rsi", oversold, overbought))


# Labels by vote: -1 sell, 0 hold, 1 buy.
BUY, SELL, HOLD = FX.SIGNALS
_BY_VOTE = (SELL, HOLD, BUY)


def _labelled(vote):
    """Label of a vote column (NULL votes hold)."""
    return F.element_at(F.array(*[F.lit(x) for x in _BY_VOTE]), F.coalesce(vote, F.lit(0)).cast("int") + 2)


def _macd_cross(d, part, spec):
    """A trade happens where the side of macd_line relative to macd_signal differs from the
    previous row's side and is not level."""
    w = S.window(part, spec)
    before = {f"prev_{c}": F.lag(c, 1).over(w) for c in ("macd_line", "macd_signal")}
    side = F.signum(F.col("macd_line") - F.col("macd_signal"))
    side_before = F.signum(F.col("prev_macd_line") - F.col("prev_macd_signal"))
    crossing = F.when(side != side_before, side)
    return d.withColumns(before).withColumn("macd_signal_trade", _labelled(crossing))


def generate_macd_signals(df: DataFrame, spec: SeriesSpec = I.TICKS) -> DataFrame:
    """Crossover of macd_line over macd_signal versus the previous row.
    Input must already carry macd_line / macd_signal."""
    return S.evaluate(df, lambda d, p: _macd_cross(d, p, spec), spec, 1)


def macd_with_signals(df: DataFrame, spec: SeriesSpec = I.TICKS, **kw) -> DataFrame:
    """W5 + W10 in one window evaluation."""
    return I.macd(df, spec=spec, extra=lambda d, p: _macd_cross(d, p, spec), extra_lookback=1, **kw)


def _agreement(one: str, other: str) -> str:
    """Combined label of two votes: the first of the combined labels that they earn."""
    votes = {one, other}
    earned = {f"STRONG_{one}" if len(votes) == 1 else None, *votes}
    return next(x for x in FX.COMBINED_SIGNALS if x in earned)


# Every pair of votes with its combined label.
DECISIONS = {(a, b): _agreement(a, b) for a in FX.SIGNALS for b in FX.SIGNALS}


def combined_signal_col(rsi_sig: str = "rsi_signal", macd_sig: str = "macd_signal_trade"):
    """W10b as a column expression: a lookup in the decision table."""
    table = F.create_map(*[F.lit(x) for (a, b), label in DECISIONS.items() for x in (f"{a}|{b}", label)])
    key = F.concat_ws("|", F.coalesce(F.col(rsi_sig), F.lit(HOLD)), F.coalesce(F.col(macd_sig), F.lit(HOLD)))
    return F.element_at(table, key)


def generate_combined_signals(df: DataFrame) -> DataFrame:
    """STRONG_BUY / STRONG_SELL / BUY / SELL / HOLD (BUY wins a conflict)."""
    return df.withColumn("combined_signal", combined_signal_col())


def indicators_with_signals(df: DataFrame, spec: SeriesSpec = I.TICKS, **kw) -> DataFrame:
    """W13 + W9 + W10 + W10b in one window evaluation (lookback 34 rows)."""
    out = I.technical_indicators(df, spec=spec, extra=lambda d, p: _macd_cross(d, p, spec),
                                 extra_lookback=1, **kw)
    return generate_combined_signals(generate_rsi_signals(out))


def trading_signal_col(rsi: str = "rsi", line: str = "macd_line", signal: str = "macd_signal"):
    """P19 as a column expression."""
    r, l, s = F.col(rsi), F.col(line), F.col(signal)
    buy, sell, hold = FX.TRADING_SIGNALS
    return (F.when((r < FX.RSI_OVERSOLD) & (l > s), buy)
             .when((r > FX.RSI_OVERBOUGHT) & (l < s), sell).otherwise(hold))


def trading_signals(enriched: DataFrame, day=None, date_col: str = "partition_date",
                    order_col: str = "timestamp") -> DataFrame:
    """Level-based BUY_SIGNAL / SELL_SIGNAL / HOLD for rows that have both
    rsi and macd_line, newest first. ``day`` (yyyy-MM-dd or date) restricts to
    one calendar day; None keeps every day."""
    df = enriched.filter(F.col("rsi").isNotNull() & F.col("macd_line").isNotNull())
    if day is not None:
        df = df.filter(F.to_date(F.col(date_col)) == F.to_date(F.lit(str(day))))
    return (df.select("symbol", "price", "rsi", "macd_line", "macd_signal",
                      trading_signal_col().alias("trading_signal"), order_col)
              .orderBy(F.col(order_col).desc()))
