"""Market analytics.

The pairwise correlation works on *daily aggregates* (symbols x days rows),
never raw ticks: the raw data is reduced map-side to one row per symbol-day
first, then multiplied blockwise (no per-day pair expansion).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .. import fixed as FX
from ..functions.columns import pct, resolve_as_of
from ..session import materialize


def _since(df: DataFrame, days: int | None, as_of, date_col: str = "partition_date") -> DataFrame:
    df = df.withColumn("_d", F.to_date(date_col))
    if days is None:
        return df
    now = resolve_as_of(df, "_d", as_of)
    return df.filter(F.col("_d") >= F.date_sub(F.to_date(now), days))


def daily_returns(ticks: DataFrame, days: int | None = FX.RETURNS_DAYS, as_of=None) -> DataFrame:
    """Mean price per symbol-day, previous day's mean (LAG over the
    aggregate) and the percentage return; a symbol's first day is dropped."""
    df = _since(ticks, days, as_of)
    daily = df.groupBy("symbol", "partition_date").agg(F.avg("price").alias("daily_price"))
    w = Window.partitionBy("symbol").orderBy("partition_date")
    return (daily.withColumn("prev_price", F.lag("daily_price").over(w))
                 .filter(F.col("prev_price").isNotNull())
                 .select("symbol", "partition_date",
                         pct(F.col("daily_price") - F.col("prev_price"), F.col("prev_price"))
                         .alias("daily_return")))


CORR_SCHEMA = ("symbol_a string, symbol_b string, correlation_coefficient double, "
               "common_days long")


def _tile_correlations(min_days: int):
    """Pandas body for one (block i, block j) tile: pairwise-complete
    Pearson correlation from co-moment sums computed as matrix products."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = int(pdf["_i"].iloc[0]), int(pdf["_j"].iloc[0])
        wide = pdf.pivot_table(index="partition_date", columns="symbol", values="daily_return",
                               aggfunc="first")
        blk = pdf.drop_duplicates("symbol").set_index("symbol")["_b"]
        left = [s for s in wide.columns if blk[s] == i]
        right = [s for s in wide.columns if blk[s] == j]
        R = wide.to_numpy(dtype="float64")
        # Each series about its own mean: sums of squares then do not cancel.
        R = R - np.nanmean(R, axis=0)
        M = (~np.isnan(R)).astype("float64")
        X = np.nan_to_num(R)
        li = [wide.columns.get_loc(s) for s in left]
        ri = [wide.columns.get_loc(s) for s in right]
        Xa, Ma, Xb, Mb = X[:, li], M[:, li], X[:, ri], M[:, ri]
        n = Ma.T @ Mb                       # common days per pair
        sa, sb = Xa.T @ Mb, Ma.T @ Xb       # sums over common days
        saa, sbb = (Xa * Xa).T @ Mb, Ma.T @ (Xb * Xb)
        sab = Xa.T @ Xb
        with np.errstate(all="ignore"):
            cov = n * sab - sa * sb
            corr = cov / np.sqrt((n * saa - sa * sa) * (n * sbb - sb * sb))
        wanted = n >= max(min_days, 1)
        if i == j:                          # columns are sorted: each pair once, by name
            wanted &= np.triu(np.ones(n.shape, bool), 1)
        x, y = np.nonzero(wanted)
        a, b = np.array(left, object)[x], np.array(right, object)[y]
        c = pd.Series(corr[x, y], dtype="float64")
        return pd.DataFrame({"symbol_a": np.where(a < b, a, b), "symbol_b": np.where(a < b, b, a),
                             "correlation_coefficient": c.where(np.isfinite(c)), "common_days": n[x, y].astype("int64")})
    return run


def correlation_pairs(returns: DataFrame, min_days: int = FX.CORRELATION_MIN_DAYS,
                      block_size: int = 512) -> DataFrame:
    """A8 + J1: Pearson correlation of daily returns for every symbol pair
    (a < b) sharing at least ``min_days`` days, strongest first.

    Computed as a blocked co-moment (Gram) product instead of a self-join on
    the day, which would emit every symbol pair of every day. Symbols are
    hashed into ``ceil(S / block_size)`` blocks; each symbol-day row is sent
    to the tiles (i, j) its block takes part in (S/block_size copies of a
    symbols x days table), and each tile computes its pairs with matrix
    products over pairwise-complete days. A tile holds at most two blocks x
    days rows and emits only result pairs."""
    returns = materialize(returns.select("symbol", "partition_date", "daily_return"), "daily-returns")
    n_sym = returns.select("symbol").distinct().count()
    nb = max(1, int(math.ceil(n_sym / float(block_size))))
    r = returns.withColumn("_b", F.pmod(F.xxhash64("symbol"), F.lit(nb)).cast("int"))
    r = (r.withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))))
          .withColumn("_i", F.least("_b", "_o")).withColumn("_j", F.greatest("_b", "_o"))
          .drop("_o"))
    out = r.groupBy("_i", "_j").applyInPandas(_tile_correlations(min_days), CORR_SCHEMA)
    return out.orderBy(F.col("correlation_coefficient").desc())


def anomaly_summary(enriched: DataFrame, days: int | None = FX.ANOMALY_SUMMARY_DAYS,
                    as_of=None) -> DataFrame:
    """Per symbol-day record and anomaly counts, anomaly share (%) and the
    mean |z| of anomalous rows; days without anomalies are left out."""
    df = _since(enriched, days, as_of)
    anom = F.col("is_anomaly")
    return (df.groupBy("symbol", "partition_date")
              .agg(F.count(F.lit(1)).alias("total_records"),
                   F.count(F.when(anom, 1)).alias("anomaly_count"),
                   (F.count(F.when(anom, 1)) * 100.0 / F.count(F.lit(1))).cast("double")
                   .alias("anomaly_percentage"),
                   F.avg(F.when(anom, F.abs("z_score"))).alias("avg_anomaly_severity"))
              .filter(F.col("anomaly_count") > 0)
              .orderBy(F.col("anomaly_percentage").desc()))
