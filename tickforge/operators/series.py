"""Per-key time-series evaluation that does not funnel a hot key into one task.

Window indicators look back a bounded number of rows. Partitioning the window by the key
alone puts every row of a hot symbol (possibly a third of the data) into a single task. Here no
window partition has more than ``piece_rows`` rows of its own, whatever the keys, the instants and
``spark.sql.shuffle.partitions`` are:

* Rows are counted per key (one column read, counts combine map-side). A key of at most
  ``piece_rows`` rows is a window partition as it stands: one shuffle on the key, nothing written.
* Only the rows of larger keys are cut by *rank* in the order (key, series order, arrival): a
  range exchange into counted / ``piece_rows`` parts, sorted, and each part numbered off every
  ``piece_rows`` rows, so the limit is exact where the range bounds, which the engine samples, are
  not. A burst at one instant is cut like anything else. A piece is evaluated in its own window
  partition together with a *halo*, the last ``lookback`` rows of that key before the piece. Halo
  rows only feed the frames and are dropped afterwards, so results equal the plain per-key
  window exactly.

Plan shape for large keys (per call):
  * pieces        -> range exchange on (key, order, arrival), written once; the input is
                     read for the sample of range bounds and for the write
  * spans         -> per (piece, key) counts; only keys that run over several pieces are kept:
                     every piece boundary is crossed by at most one key, so this table has
                     at most two rows per piece whatever the data, and is broadcast
  * tails         -> row_number() <= lookback in spanning pieces (map-side group limit)
  * main window   -> one shuffle on (piece, key), partitions bounded by the piece size
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace
from typing import Callable, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize

PIECE, ARRIVAL, HALO = "_piece", "_arrival", "_halo"
PIECE_ROWS = 1_000_000


@dataclass(frozen=True)
class SeriesSpec:
    """How rows form ordered per-key series.

    key        - series key column (NULL is a series of its own)
    order      - order inside a key; rows equal in all of these keep their order of arrival
    piece_rows - most rows of a key that are evaluated in one window partition
    """
    key: str = "symbol"
    order: tuple[str, ...] = ("timestamp",)
    piece_rows: int = PIECE_ROWS

    def with_(self, **kw) -> "SeriesSpec":
        return replace(self, **kw)


def order_cols(spec: SeriesSpec, descending: bool = False):
    """Sort expressions of the series order."""
    cols = [F.col(c) for c in (*spec.order, ARRIVAL)]
    return [c.desc() if descending else c.asc() for c in cols]


def window(part: Sequence[str], spec: SeriesSpec, lo: int | None = None):
    """Window over ``part`` in series order; with ``lo``, rows from ``lo`` to the current one."""
    w = Window.partitionBy(*part).orderBy(*order_cols(spec))
    return w if lo is None else w.rowsBetween(lo, 0)


def large_keys(df: DataFrame, spec: SeriesSpec) -> DataFrame | None:
    """(_k, _n): keys with more than ``piece_rows`` rows and their rows, at most one key per
    ``piece_rows`` rows of ``df``; None if there is none."""
    large = (df.groupBy(F.col(spec.key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
             .filter(F.col("_n") > spec.piece_rows))
    return materialize(large, "series-large-keys") if large.take(1) else None


def cut(rows: DataFrame, n_rows: int, spec: SeriesSpec) -> DataFrame:
    """``rows`` (with their arrival number) in pieces of at most ``piece_rows`` rows that follow each
    other in series order, written to the shared folder."""
    parts = max(1, -(-n_rows // spec.piece_rows))
    # A burst at one instant is cut too: the arrival number is part of the range key.
    by = [F.col(spec.key), *order_cols(spec)]
    dealt = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    # The upper bits of the id are the partition, the lower 33 the row's place in it.
    place, half = F.monotonically_increasing_id(), 1 << 33
    number = F.shiftright(place, 33) * F.lit(half) + F.floor(F.pmod(place, F.lit(half)) / F.lit(spec.piece_rows))
    return materialize(dealt.withColumn(PIECE, number), "series-pieces")


def _halo(pieces: DataFrame, cols: list[str], spec: SeriesSpec, lookback: int) -> DataFrame:
    """The last ``lookback`` rows of each spanning key before each of its pieces, marked with
    the piece they serve."""
    k = spec.key
    counts = pieces.groupBy(k, PIECE).agg(F.count(F.lit(1)).alias("_n"))
    by_key = Window.partitionBy(k)
    # At most two rows per piece are left: only one key crosses each boundary.
    spans = materialize(counts.withColumn("_pieces", F.count(F.lit(1)).over(by_key)).filter("_pieces > 1")
                        .select(F.col(k).alias("_k"), F.col(PIECE).alias("_from"), "_n"), "series-spans")
    run = Window.partitionBy("_k").orderBy("_from")
    ends = spans.withColumn("_end", F.sum("_n").over(run.rowsBetween(Window.unboundedPreceding, 0)))
    earlier = F.collect_list(F.struct("_from", "_end")).over(run.rowsBetween(-lookback, -1))
    need = F.col("_end") - F.col("_n") - lookback          # rows of the key that lie before the halo
    wanted = (ends.withColumn("_earlier", F.filter(earlier, lambda e: e["_end"] > need))
              .withColumn("_e", F.explode("_earlier"))
              .select("_k", F.col("_from").alias("_to"), F.col("_e._from").alias("_src"),
                      (F.col("_e._end") - need).alias("_take")))
    last = Window.partitionBy(k, PIECE).orderBy(*order_cols(spec, descending=True))
    crossing = pieces.join(F.broadcast(spans.drop("_n")),
                           F.col(k).eqNullSafe(F.col("_k")) & (F.col(PIECE) == F.col("_from")), "left_semi")
    tails = crossing.withColumn("_back", F.row_number().over(last)).filter(F.col("_back") <= lookback)
    return (tails.join(F.broadcast(wanted), F.col(k).eqNullSafe(F.col("_k")) & (F.col(PIECE) == F.col("_src")))
            .filter(F.col("_back") <= F.col("_take"))
            .select(*cols, ARRIVAL, F.col("_to").alias(PIECE), F.lit(True).alias(HALO)))


def split(df: DataFrame, spec: SeriesSpec) -> tuple[DataFrame, DataFrame | None]:
    """(rows of the keys that are evaluated whole, pieces of the larger keys or None), with arrival numbers."""
    rows = df.withColumn(ARRIVAL, F.monotonically_increasing_id())
    large = large_keys(df, spec)
    if large is None:
        return rows, None
    of_large = F.col(spec.key).eqNullSafe(F.col("_k"))
    keys = F.broadcast(large.select("_k"))
    pieces = cut(rows.join(keys, of_large, "left_semi"), large.agg(F.sum("_n")).first()[0], spec)
    return rows.join(keys, of_large, "left_anti"), pieces


def evaluate(df: DataFrame, compute: Callable[[DataFrame, list], DataFrame],
             spec: SeriesSpec, lookback: int) -> DataFrame:
    """Run ``compute(frame, partition_cols)`` over every key's series.

    ``compute`` must only use window frames in series order that look back at most
    ``lookback`` rows (counting chained windows)."""
    rows, pieces = split(df, spec)
    whole = compute(rows, [spec.key])
    if pieces is None:
        return whole.drop(ARRIVAL)
    own = pieces.select(*df.columns, ARRIVAL, PIECE, F.lit(False).alias(HALO))
    out = compute(own.unionByName(_halo(pieces, df.columns, spec, lookback)), [PIECE, spec.key])
    return whole.unionByName(out.filter(~F.col(HALO)).drop(PIECE, HALO)).drop(ARRIVAL)


def _on(day: dt.date, dtype: str):
    """A day as a literal of a date, timestamp or yyyy-MM-dd string column."""
    return F.lit(day.isoformat()) if dtype == "string" else F.lit(day).cast(dtype)


def history_start(df: DataFrame, cutoff: dt.date, spec: SeriesSpec, lookback: int, day_col: str) -> dt.date:
    """The latest day (of ``day_col``: date, timestamp or yyyy-MM-dd text) to read from, so that every key with rows from
    ``cutoff`` on has ``lookback`` rows before it or has none further back than that. Walks back 1, 2, 4, ... days;
    every step reads the key column of the days in question only."""
    day, dtype = F.col(day_col), dict(df.dtypes)[day_col]
    keys = materialize(df.filter(day >= _on(cutoff, dtype)).select(F.col(spec.key).alias("_k")).distinct(), "series-keys")
    span = 1
    while True:
        start = cutoff - dt.timedelta(days=span)
        counts = (df.filter((day >= _on(start, dtype)) & (day < _on(cutoff, dtype)))
                  .groupBy(F.col(spec.key).alias("_c")).agg(F.count(F.lit(1)).alias("_n")))
        short = keys.join(counts, F.col("_k").eqNullSafe(F.col("_c")), "left").filter(F.coalesce("_n", F.lit(0)) < lookback)
        if not short.take(1) or not df.filter(day < _on(start, dtype)).take(1):
            return start
        span *= 2


def since(df: DataFrame, cutoff: dt.date, spec: SeriesSpec, lookback: int, day_col: str) -> DataFrame:
    """Rows of ``df`` from which windows that look back ``lookback`` rows are exact from ``cutoff`` on. The
    filter is on ``day_col``, so it prunes partitions or row groups."""
    start = history_start(df, cutoff, spec, lookback, day_col)
    return df.filter(F.col(day_col) >= _on(start, dict(df.dtypes)[day_col]))
