"""Validation, dead-lettering, cleaning, dedup and DQ counts (P5-P7, P11, P12,
O4, A13, D3, D6)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fixed as FX
from ..functions.columns import lookback_start, resolve_as_of


def _present(c: str) -> Column:
    return F.col(c).isNotNull()


def _sound(c: str, kind: str) -> Column:
    """Whether a field meets its requirement (NULL for a missing number)."""
    return F.col(c) > 0 if kind == "positive" else _present(c)


def validity(requirements=FX.TRADE_REQUIREMENTS) -> Column:
    """P5: every required field is sound (NULL if a comparison is NULL)."""
    return reduce(Column.__and__, [_sound(c, kind) for c, kind in requirements])


def error_label(requirements=FX.TRADE_REQUIREMENTS, named=FX.NAMED_FIELDS) -> Column:
    """Label of the first named field that is missing or unsound, in the order of the
    requirements; other failures share one label."""
    reasons = [F.when(~_present(c), f"missing_{c}").when(~_sound(c, kind), f"invalid_{c}")
               for c, kind in requirements if c in named]
    return F.coalesce(*reasons, F.lit(FX.OTHER_ERROR))


def validate(df: DataFrame, null_policy: str = "dead_letter") -> tuple[DataFrame, DataFrame]:
    """Split into (valid, invalid + validation_error).

    ``dead_letter`` (default) sends rows whose check is NULL (missing price or
    quantity) to the invalid side, so valid + invalid = input. ``drop`` keeps
    the two-filter behaviour where such rows appear in neither output."""
    p = validity()
    if null_policy == "drop":
        valid, invalid = df.filter(p), df.filter(~p)
    else:
        ok = F.coalesce(p, F.lit(False))
        valid, invalid = df.filter(ok), df.filter(~ok)
    return valid, invalid.withColumn("validation_error", error_label())


def dead_letter(invalid: DataFrame, source: str = "trade_stream", processing_time=None) -> DataFrame:
    """DLQ rows = (raw_data JSON of the record, validation_error,
    processing_time, source)."""
    rec = [c for c in invalid.columns if c != "validation_error"]
    pt = F.current_timestamp() if processing_time is None else (
        processing_time if isinstance(processing_time, Column) else F.lit(processing_time))
    # NULL fields stay in the record as null.
    raw = F.to_json(F.struct(*rec), {"ignoreNullFields": "false"})
    return invalid.select(raw.alias("raw_data"), "validation_error",
                          pt.alias("processing_time"), F.lit(source).alias("source"))


def clean_ticks(df: DataFrame, order=("timestamp",)) -> DataFrame:
    """P11 + O4 + P12: keep price > 0, volume >= 0, timestamp and symbol
    present; one row per (symbol, timestamp) chosen deterministically by the
    remaining ``order`` columns; data_quality_score 100 / 80 / 60."""
    f = df.filter((F.col("price") > 0) & (F.col("volume") >= 0)
                  & F.col("timestamp").isNotNull() & F.col("symbol").isNotNull())
    f = dedup_first(f, ["symbol", "timestamp"], order[1] if len(order) > 1 else None)
    return f.withColumn("data_quality_score", quality_score(f.columns))


def quality_score(columns, levels=FX.QUALITY_LEVELS, least=FX.QUALITY_LEAST) -> Column:
    """Score of the first level whose columns exist and are all filled."""
    reached = [F.when(reduce(Column.__and__, [_present(c) for c in group]), score)
               for group, score in levels if set(group) <= set(columns)]
    return F.coalesce(*reached, F.lit(least))


def dedup_first(df: DataFrame, keys, tiebreak: str | None = None) -> DataFrame:
    """One row per ``keys``, the one with the smallest ``tiebreak`` (None keeps an
    arbitrary copy like dropDuplicates). Planned with a map-side group limit: every task
    keeps one row per key before the shuffle, so a key holding a large share of all rows never
    reaches one task whole."""
    if tiebreak is None:
        return df.dropDuplicates(list(keys))
    first = Window.partitionBy(*keys).orderBy(tiebreak)
    return df.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1").drop("_nth")


def dq_counts(trades: DataFrame, hours: float | None = FX.DQ_HOURS, as_of=None,
              ts: str = "trade_timestamp") -> DataFrame:
    """total_rows, null_symbols, invalid_prices, invalid_quantities over
    the last ``hours`` (None = whole table) and has_issues."""
    df = trades
    if hours is not None:
        now = resolve_as_of(trades, ts, as_of)
        df = df.filter(F.col(ts) >= lookback_start(now, hours=hours))
    return (df.agg(F.count(F.lit(1)).alias("total_rows"),
                   F.count_if(F.col("symbol").isNull()).alias("null_symbols"),
                   F.count_if(F.col("price") <= 0).alias("invalid_prices"),
                   F.count_if(F.col("quantity") <= 0).alias("invalid_quantities"))
              .withColumn("has_issues", (F.col("null_symbols") > 0) | (F.col("invalid_prices") > 0)
                          | (F.col("invalid_quantities") > 0)))
