"""Technical indicators over per-symbol price series.

All rolling frames are ``rowsBetween(-(n-1), 0)``: the first rows of a series
get partial windows, not NULL. Standard deviations are sample deviations
(NULL for a single row). Every division is zero-safe (NULL instead of an ANSI
error). Each public function is ``DataFrame -> DataFrame`` and evaluates
through :func:`series.evaluate`, which cuts all series by rank into pieces of bounded size.

EMA note: the classic ``ema_{n}`` column is a rolling *simple* mean over n rows
(that is the reference behaviour, alpha is not used). ``ema_recursive`` gives
the exponential version.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .. import fixed as FX
from ..functions.columns import safe_div
from ..session import materialize
from . import series as S
from .series import SeriesSpec

TICKS = SeriesSpec(key="symbol", order=("timestamp",))


# ---------------------------------------------------------------- column builders
# Each builder adds columns given the window partition columns ``part``.

def _price_change(df, part, spec, price):
    w = S.window(part, spec)
    return (df.withColumn("price_lag_1", F.lag(price, 1).over(w))
              .withColumn("price_change", F.col(price) - F.col("price_lag_1"))
              .withColumn("price_change_pct",
                          safe_div(F.col("price_change"), F.col("price_lag_1")) * 100))


def _rolling_mean(df, part, spec, src, n, name):
    return df.withColumn(name, F.avg(src).over(S.window(part, spec, -(n - 1))))


def _rsi_cols(df, part, spec, n, change="price_change"):
    w = S.window(part, spec, -(n - 1))
    ch = F.col(change)
    return (df.withColumn("gain", F.when(ch > 0, ch).otherwise(F.lit(0.0)))
              .withColumn("loss", F.when(ch < 0, -ch).otherwise(F.lit(0.0)))
              .withColumn("avg_gain", F.avg("gain").over(w))
              .withColumn("avg_loss", F.avg("loss").over(w))
              .withColumn("rs", safe_div("avg_gain", "avg_loss"))
              .withColumn("rsi", F.lit(100.0) - safe_div(F.lit(100.0), 1 + F.col("rs"))))


def _macd_cols(df, part, spec, price, fast, slow, signal):
    df = _rolling_mean(df, part, spec, price, fast, f"ema_{fast}")
    df = _rolling_mean(df, part, spec, price, slow, f"ema_{slow}")
    df = df.withColumn("macd_line", F.col(f"ema_{fast}") - F.col(f"ema_{slow}"))
    df = _rolling_mean(df, part, spec, "macd_line", signal, "macd_signal")
    return df.withColumn("macd_histogram", F.col("macd_line") - F.col("macd_signal"))


def _anomaly_cols(df, part, spec, price, n, threshold, mean_col: str | None = None):
    w = S.window(part, spec, -(n - 1))
    z = F.col("z_score")
    spike, drop, normal = FX.ANOMALY_TYPES
    # the composite already has this frame's mean as sma_{n}: reuse it
    mean = F.col(mean_col) if mean_col else F.avg(price).over(w)
    return (df.withColumn("price_mean", mean)
              .withColumn("price_stddev", F.stddev_samp(price).over(w))
              .withColumn("z_score", safe_div(F.col(price) - F.col("price_mean"), F.col("price_stddev")))
              .withColumn("is_anomaly", F.abs(z) > threshold)
              .withColumn("anomaly_type", F.when(z > threshold, spike).when(z < -threshold, drop).otherwise(normal)))


# ---------------------------------------------------------------- public operators

def price_change(df: DataFrame, price: str = "price", spec: SeriesSpec = TICKS) -> DataFrame:
    """price_lag_1, price_change, price_change_pct."""
    return S.evaluate(df, lambda d, p: _price_change(d, p, spec, price), spec, 1)


def sma(df: DataFrame, price: str = "price", window: int = FX.SMA_WINDOW, spec: SeriesSpec = TICKS) -> DataFrame:
    """sma_{window} = rolling mean of the last ``window`` rows."""
    return S.evaluate(df, lambda d, p: _rolling_mean(d, p, spec, price, window, f"sma_{window}"),
                      spec, window - 1)


def ema(df: DataFrame, price: str = "price", window: int = FX.SMA_WINDOW, alpha: float | None = None,
        spec: SeriesSpec = TICKS) -> DataFrame:
    """W3 (reference semantics): ema_{window} is a rolling simple mean; alpha unused."""
    return S.evaluate(df, lambda d, p: _rolling_mean(d, p, spec, price, window, f"ema_{window}"),
                      spec, window - 1)


def rsi(df: DataFrame, price: str = "price", window: int = FX.RSI_WINDOW, spec: SeriesSpec = TICKS) -> DataFrame:
    """price_change, gain, loss, avg_gain, avg_loss, rs, rsi (simple means;
    no losses in the frame -> rs and rsi NULL)."""
    def comp(d, p):
        w = S.window(p, spec)
        d = d.withColumn("price_change", F.col(price) - F.lag(price, 1).over(w))
        return _rsi_cols(d, p, spec, window)
    return S.evaluate(df, comp, spec, window)


def macd(df: DataFrame, price: str = "price", fast: int = FX.MACD_FAST, slow: int = FX.MACD_SLOW,
         signal: int = FX.MACD_SIGNAL, spec: SeriesSpec = TICKS, extra=None, extra_lookback: int = 0) -> DataFrame:
    """ema_{fast}, ema_{slow}, macd_line, macd_signal, macd_histogram. ``extra(d, part)``
    may chain window columns that look back ``extra_lookback`` rows more."""
    def comp(d, p):
        d = _macd_cols(d, p, spec, price, fast, slow, signal)
        return extra(d, p) if extra else d
    return S.evaluate(df, comp, spec, max(fast, slow) - 1 + signal - 1 + extra_lookback)


def bollinger_bands(df: DataFrame, price: str = "price", window: int = FX.SMA_WINDOW,
                    num_std: float = FX.BOLLINGER_STD,
                    spec: SeriesSpec = TICKS) -> DataFrame:
    """bb_middle, bb_std, bb_upper, bb_lower."""
    def comp(d, p):
        w = S.window(p, spec, -(window - 1))
        return (d.withColumn("bb_middle", F.avg(price).over(w))
                 .withColumn("bb_std", F.stddev_samp(price).over(w))
                 .withColumn("bb_upper", F.col("bb_middle") + F.col("bb_std") * num_std)
                 .withColumn("bb_lower", F.col("bb_middle") - F.col("bb_std") * num_std))
    return S.evaluate(df, comp, spec, window - 1)


def price_anomalies(df: DataFrame, price: str = "price", window: int = FX.SMA_WINDOW,
                    threshold: float = FX.ANOMALY_Z,
                    spec: SeriesSpec = TICKS) -> DataFrame:
    """price_mean, price_stddev, z_score, is_anomaly, anomaly_type."""
    return S.evaluate(df, lambda d, p: _anomaly_cols(d, p, spec, price, window, threshold),
                      spec, window - 1)


def volatility(df: DataFrame, price: str = "price", window: int = FX.SMA_WINDOW,
               spec: SeriesSpec = TICKS) -> DataFrame:
    """Return (% change vs previous row) and volatility = rolling stddev of it."""
    def comp(d, p):
        d = d.withColumn("return", (safe_div(F.col(price), F.lag(price, 1).over(S.window(p, spec))) - 1) * 100)
        return d.withColumn("volatility", F.stddev_samp("return").over(S.window(p, spec, -(window - 1))))
    return S.evaluate(df, comp, spec, window)


# Composite lookback: MACD signal over the slow mean (25 + 8 rows), plus one
# more when MACD crossover signals read the previous row.
COMPOSITE_LOOKBACK = 33


def technical_indicators(df: DataFrame, spec: SeriesSpec = TICKS, price: str = "price",
                         volume: str = "volume", window: int = FX.SMA_WINDOW,
                         rsi_window: int = FX.RSI_WINDOW, fast: int = FX.MACD_FAST,
                         slow: int = FX.MACD_SLOW, signal: int = FX.MACD_SIGNAL,
                         threshold: float = FX.ANOMALY_Z, extra=None, extra_lookback: int = 0) -> DataFrame:
    """The 22 indicator columns of the ticker stream in one evaluation.

    Every window shares the (key, order) spec, so Spark plans a single exchange
    and sort for all of them. ``extra(d, part)`` may chain more window columns
    (e.g. MACD crossover signals) inside the same evaluation."""
    def comp(d, p):
        d = _price_change(d, p, spec, price)
        w = S.window(p, spec, -(window - 1))
        d = (d.withColumn(f"sma_{window}", F.avg(price).over(w))
              .withColumn("price_volatility", F.stddev_samp("price_change_pct").over(w))
              .withColumn(f"volume_sma_{window}", F.avg(volume).over(w)))
        d = _rsi_cols(d, p, spec, rsi_window)
        d = _macd_cols(d, p, spec, price, fast, slow, signal)
        d = _anomaly_cols(d, p, spec, price, window, threshold, mean_col=f"sma_{window}")
        return extra(d, p) if extra else d
    lookback = max(window, rsi_window, max(fast, slow) - 1 + signal - 1) + extra_lookback
    return S.evaluate(df, comp, spec, lookback)


INDICATOR_COLUMNS = ["price_lag_1", "price_change", "price_change_pct", "sma_20",
                     "price_volatility", "volume_sma_20", "gain", "loss", "avg_gain",
                     "avg_loss", "rs", "rsi", "ema_12", "ema_26", "macd_line", "macd_signal",
                     "macd_histogram", "price_mean", "price_stddev", "z_score", "is_anomaly",
                     "anomaly_type"]


# ---------------------------------------------------------------- exponential EMA

_STATE = ("_ema", "_gap")       # average before a series or piece (null: none yet), rows without a price since


def _behind(ema: float, gap: int, price: float, a: float) -> float:
    """The average at ``price``, ``gap`` rows without a price behind average ``ema``."""
    old = (1.0 - a) ** (gap + 1)
    return (old * ema + a * price) / (old + a)


def _averages(prices: np.ndarray, a: float, state: tuple) -> tuple[np.ndarray, tuple]:
    """Averages of ``prices`` (NaN: none) behind a state, and the state after them."""
    ema, gap = state
    out = np.full(len(prices), np.nan if ema is None else ema)
    has = np.flatnonzero(~np.isnan(prices))
    if not len(has):
        return out, (ema, gap + len(prices))
    first = int(has[0])
    rest = prices[first:].copy()
    if ema is not None:
        rest[0] = _behind(ema, gap + first, rest[0], a)
    out[first:] = pd.Series(rest).ewm(alpha=a, adjust=False).mean()
    return out, (float(out[-1]), len(prices) - 1 - int(has[-1]))


def _runs(batches, keys: list):
    """(batch, [(start, end, goes on)]) of sorted Arrow batches: runs of equal ``keys``, and whether a run
    goes on with the last one of the batch before."""
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        change = np.zeros(n, bool)
        for k in keys:
            code = batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            change[1:] |= code[1:] != code[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), n]
        here = [batch.column(k)[0].as_py() for k in keys]
        yield batch, [(x, y, x == 0 and here == last) for x, y in zip(cuts[:-1], cuts[1:])]
        last = [batch.column(k)[n - 1].as_py() for k in keys]


def _prices(batch) -> np.ndarray:
    return batch.column("_price").to_numpy(zero_copy_only=False)


def _piece_maps(pieces: DataFrame, spec: SeriesSpec, a: float) -> DataFrame:
    """(key, piece, first, lead, mul, add, trail) of every key's piece: an average that is e at the piece's first price
    (``first``, behind ``lead`` rows without one) is mul * e + add at its end, ``trail`` rows behind its last price."""
    def run(batches):
        held, done = None, []
        for batch, runs in _runs(batches, [S.PIECE, spec.key]):
            prices = _prices(batch)
            for x, y, goes_on in runs:
                if not goes_on:
                    done += [held] if held else []
                    held = [batch.column(spec.key)[x].as_py(), batch.column(S.PIECE)[x].as_py(), None, 0, (1.0, 0), (0.0, 0)]
                v = prices[x:y]
                if held[2] is None:
                    has = np.flatnonzero(~np.isnan(v))
                    held[3] += int(has[0]) if len(has) else len(v)
                    if not len(has):
                        continue
                    held[2], v = float(v[has[0]]), v[has[0] + 1:]
                if len(v):
                    held[4] = _averages(np.where(np.isnan(v), np.nan, 0.0), a, held[4])[1]
                    held[5] = _averages(v, a, held[5])[1]
            if done:
                yield rows(done, batch)
                done = []
        if held:
            yield rows([held], batch)

    def rows(found, batch):
        keys, piece, first, lead, mul, add = zip(*found)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, batch.schema.field(spec.key).type), pa.array(piece, pa.int64()), pa.array(first, pa.float64()),
             pa.array(lead, pa.int64()), pa.array([m[0] for m in mul], pa.float64()),
             pa.array([d[0] for d in add], pa.float64()), pa.array([d[1] for d in add], pa.int64())],
            names=["_k", "_from", "first", "lead", "mul", "add", "trail"])

    schema = T.StructType([T.StructField("_k", pieces.schema[spec.key].dataType)]
                          + [T.StructField(n, t()) for n, t in (("_from", T.LongType), ("first", T.DoubleType), ("lead", T.LongType),
                                                                ("mul", T.DoubleType), ("add", T.DoubleType), ("trail", T.LongType))])
    cols = list(dict.fromkeys([spec.key, S.PIECE, *spec.order, S.ARRIVAL, "_price"]))
    return _in_order(pieces.select(*cols), [S.PIECE, spec.key], spec).mapInArrow(run, schema)


def _piece_states(maps: DataFrame, a: float) -> DataFrame:
    """(_k, _from, _ema, _gap): the state before every piece, by composing a key's maps in order."""
    def run(batches):
        state = (None, 0)
        for batch, runs in _runs(batches, ["_k"]):
            values = [batch.column(c).to_pylist() for c in ("first", "lead", "mul", "add", "trail")]
            before = []
            for x, y, goes_on in runs:
                state = state if goes_on else (None, 0)
                for first, lead, mul, add, trail in zip(*(v[x:y] for v in values)):
                    before.append(state)
                    ema, gap = state
                    if first is None:
                        state = (ema, gap + lead)
                    else:
                        state = (mul * (first if ema is None else _behind(ema, gap + lead, first, a)) + add, trail)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_k"), batch.column("_from"), pa.array([e for e, _ in before], pa.float64()),
                 pa.array([g for _, g in before], pa.int64())], names=["_k", "_from", *_STATE])

    schema = T.StructType([maps.schema["_k"], maps.schema["_from"], T.StructField("_ema", T.DoubleType()), T.StructField("_gap", T.LongType())])
    return maps.repartition("_k").sortWithinPartitions("_k", "_from").mapInArrow(run, schema)


def _in_order(rows: DataFrame, part: list, spec: SeriesSpec) -> DataFrame:
    return rows.repartition(*part).sortWithinPartitions(*part, *S.order_cols(spec))


def ema_recursive(df: DataFrame, price: str = "price", window: int = FX.SMA_WINDOW,
                  alpha: float | None = None, spec: SeriesSpec = TICKS) -> DataFrame:
    """Exponential moving average ema_t = a*p_t + (1-a)*ema_{t-1}, seeded with
    the first price of the series; column ``ema_{window}_exp``. A row without a price repeats the
    average (null before the first price), and later prices weigh more by its age.

    Exact for any alpha by an affine scan: a piece of a large key maps the average before it to the one at its
    end; the maps, a row per piece, are composed in order, and every piece starts from its
    state. Rows stream by in Arrow batches: a task holds one batch and one average."""
    a = alpha if alpha is not None else 2.0 / (window + 1)
    out_col = f"ema_{window}_exp"

    def averages(rows: DataFrame, part: list) -> DataFrame:
        def run(batches):
            state = None
            for batch, runs in _runs(batches, part):
                prices, ema, gap = _prices(batch), batch.column("_ema"), batch.column("_gap")
                out = np.empty(batch.num_rows)
                for x, y, goes_on in runs:
                    if not goes_on:
                        state = (ema[x].as_py(), gap[x].as_py())
                    out[x:y], state = _averages(prices[x:y], a, state)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, mask=np.isnan(out))],
                                                 names=[*batch.schema.names, out_col])

        schema = T.StructType(rows.schema.fields + [T.StructField(out_col, T.DoubleType())])
        return _in_order(rows, part, spec).mapInArrow(run, schema).select(*df.columns, out_col)

    whole, pieces = S.split(df, spec)
    double = F.col(price).cast("double")
    start = {"_price": double, "_ema": F.lit(None).cast("double"), "_gap": F.lit(0).cast("long")}
    out = averages(whole.withColumns(start), [spec.key])
    if pieces is None:
        return out
    pieces = pieces.withColumn("_price", double)
    # At most two rows per piece, as only one key crosses each boundary.
    states = materialize(_piece_states(_piece_maps(pieces, spec, a), a), "series-states")
    behind = pieces.join(F.broadcast(states), F.col(spec.key).eqNullSafe(F.col("_k")) & (F.col(S.PIECE) == F.col("_from")))
    return out.unionByName(averages(behind.drop("_k", "_from"), [S.PIECE, spec.key]))
