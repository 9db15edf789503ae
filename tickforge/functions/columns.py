"""Column-expression helpers (all JVM-side built-ins, codegen friendly)."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI mode would raise instead)."""
    return F.try_divide(_c(num), _c(den))


def pct(num, den) -> Column:
    """num / den * 100 with a zero-safe divisor."""
    return safe_div(num, den) * F.lit(100.0)


def to_ntz(c) -> Column:
    """Wall-clock timestamp without zone (what the parquet tables carry)."""
    return _c(c).cast("timestamp_ntz")


def epoch_ms_to_ts(c, truncate_to_second: bool = False) -> Column:
    """Epoch milliseconds -> TIMESTAMP. Keeps milliseconds unless asked to
    truncate to whole seconds (the behaviour of a from_unixtime round trip)."""
    ts = F.timestamp_millis(_c(c))
    return F.date_trunc("second", ts) if truncate_to_second else ts


def epoch_s_to_ts(c) -> Column:
    """Epoch seconds -> TIMESTAMP."""
    return F.timestamp_seconds(_c(c))


def as_of_max(df: DataFrame, ts_col: str) -> Column:
    """'Now' for look-back reports = newest timestamp in the data, as a scalar
    subquery (evaluated once by Spark, never collected by the caller)."""
    return df.select(F.max(ts_col)).scalar()


def resolve_as_of(df: DataFrame, ts_col: str, as_of) -> Column:
    """The look-back "now" as a Column: the given value, or the newest ``ts_col`` of ``df``."""
    if as_of is None:
        return as_of_max(df, ts_col)
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (datetime, date)):
        return F.lit(as_of)
    return F.lit(as_of).cast("timestamp_ntz")


def lookback_start(as_of: Column, hours: float | None = None, days: int | None = None) -> Column:
    """``as_of`` minus a look-back of ``hours`` (or ``days``)."""
    if hours is not None:
        return as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(hours) * 3600))
    return as_of - F.make_dt_interval(F.lit(int(days or 0)))


_SHIFT = "100000000000000000000"        # 10^20 > 2^64: room for any shifted long
_HALF = "9223372036854775808"           # 2^63: maps signed longs to [0, 2^64)


def order_key(primary, tiebreak, primary_is_time: bool = True) -> Column:
    """Single fixed-width DECIMAL(38,0) key that orders like (primary,
    tiebreak). ``primary`` is a timestamp (taken as epoch micros) or, with
    ``primary_is_time=False``, a long; ``tiebreak`` is a long (NULL -> 0).
    min_by/max_by over this key keep a fixed-width aggregation buffer, so
    Spark plans a hash aggregate with map-side partial aggregation instead of
    sorting every row (which a struct-typed ordering forces)."""
    p = F.unix_micros(_c(primary).cast("timestamp")) if primary_is_time else _c(primary).cast("long")
    t = F.coalesce(_c(tiebreak).cast("long"), F.lit(0).cast("long"))
    return (p.cast("decimal(20,0)") * F.lit(_SHIFT).cast("decimal(21,0)")
            + (t.cast("decimal(20,0)") + F.lit(_HALF).cast("decimal(20,0)"))).cast("decimal(38,0)")


def bind_once(df: DataFrame, **exprs: Column) -> DataFrame:
    """Add expensive per-row expressions (JSON parsing) evaluated exactly once.

    Catalyst pushes filters below projections by substituting the projected
    expression, so a filter on three fields of a parsed struct would re-run
    the parser three more times. Binding the values through a one-element
    generator (``inline``) stops that substitution: the parse runs once per
    row and later filters apply to its output."""
    packed = F.struct(*[e.alias(n) for n, e in exprs.items()])
    return df.select("*", F.inline(F.array(packed)))
