"""Shared helpers for registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.series import SeriesSpec
from ..sources import adapters, tables

DIGITS = 6
LIMIT = 1e12   # larger magnitudes are compared unrounded (floor() returns a long)

# Series layouts of the adapters: ticks are ordered by (event time, event id);
# trades by (trade time, trade id).
TICK_SPEC = SeriesSpec(key="symbol", order=("watermark_time", "event_id"))
TRADE_SPEC = SeriesSpec(key="symbol", order=("trade_timestamp", "trade_id"))


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Comparison projection: doubles rounded to ``digits`` decimals (and -0.0
    folded to 0.0) so last-bit differences in float sums do not count as
    mismatches. Uses floor(x*10^d + 0.5)/10^d, the same IEEE steps as the SQL
    side, instead of either engine's round() (they break decimal ties apart)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            scale = float(10 ** digits)
            x = F.col(f.name)
            r = F.when(F.abs(x) < LIMIT, F.floor(x * scale + 0.5) / scale).otherwise(x)
            cols.append((r + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def flat_window(df: DataFrame, col: str = "window") -> DataFrame:
    """window struct -> window_start / window_end (wall-clock timestamps)."""
    rest = [c for c in df.columns if c != col]
    return df.select(F.col(f"{col}.start").cast("timestamp_ntz").alias("window_start"),
                     F.col(f"{col}.end").cast("timestamp_ntz").alias("window_end"), *rest)


def events(spark: SparkSession, d: str) -> DataFrame:
    return tables.load(spark, d, "events")


def trades(spark: SparkSession, d: str) -> DataFrame:
    return adapters.trades(events(spark, d))


def ticks(spark: SparkSession, d: str) -> DataFrame:
    return adapters.ticks(events(spark, d))


def newest_day(spark: SparkSession, d: str):
    """Day of the newest event."""
    return events(spark, d).agg(F.to_date(F.max("ts"))).first()[0]


def bulk(spark: SparkSession, d: str) -> DataFrame:
    return adapters.trades_bulk(tables.load(spark, d, "lineitem"))


def rnd_sql(sql: str, *cols: str) -> str:
    """Wrap an oracle query so the listed DOUBLE columns are rounded like ``rounded``."""
    if not cols:
        return sql
    scale = f"{float(10 ** DIGITS)!r}"
    rep = ", ".join(f'CASE WHEN abs("{c}") < {LIMIT!r} THEN floor("{c}" * {scale} + 0.5) / {scale}'
                    f' ELSE "{c}" END + 0.0 AS "{c}"' for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS _q"
