"""Pipeline metrics and alert rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fixed as FX
from ..functions.columns import resolve_as_of
from ..session import materialize


def _metric_rows(df: DataFrame, keys) -> DataFrame:
    """Wide metric columns -> long (metric_name, value, unit) rows via stack."""
    return df.select(*keys, F.expr(
        "stack(4, 'TotalRecords', CAST(total_records AS DOUBLE), 'Count',"
        " 'AnomalyCount', CAST(anomaly_count AS DOUBLE), 'Count',"
        " 'AnomalyRate', anomaly_rate, 'Percent',"
        " 'ActiveSymbols', CAST(active_symbols AS DOUBLE), 'Count')"
        " AS (metric_name, value, unit)"))


def _metric_aggs():
    n = F.count(F.lit(1))
    a = F.count(F.when(F.col("is_anomaly"), 1))
    return [n.alias("total_records"), a.alias("anomaly_count"),
            F.when(n > 0, a * 100.0 / n).otherwise(F.lit(0.0)).cast("double").alias("anomaly_rate"),
            F.countDistinct("symbol").alias("active_symbols")]


def custom_metrics(latest: DataFrame, as_of=None, seconds: int = FX.METRICS_WINDOW_SECONDS,
                     ts: str = "timestamp") -> DataFrame:
    """TotalRecords, AnomalyCount, AnomalyRate (% , 0 when empty) and
    ActiveSymbols over rows with epoch-second ``ts`` > as_of - ``seconds``."""
    now = resolve_as_of(latest, ts, as_of)
    recent = latest.filter(F.col(ts) > now - F.lit(seconds))
    return _metric_rows(recent.agg(*_metric_aggs()), [])


def custom_metrics_windows(df: DataFrame, seconds: int = FX.METRICS_WINDOW_SECONDS,
                             ts: str = "watermark_time") -> DataFrame:
    """A15 over a whole history: the same four metrics for every tumbling
    ``seconds`` window (window_start, metric_name, value, unit)."""
    w = F.window(ts, f"{seconds} seconds")
    agg = df.groupBy(w.start.cast("timestamp_ntz").alias("window_start")).agg(*_metric_aggs())
    return _metric_rows(agg, ["window_start"])


def batch_metrics(batches: DataFrame, batch_col: str = "batch_id", by_symbol: bool = False,
                  ok_col: str = "is_valid", ts_ms: str = "event_ms") -> DataFrame:
    """Per micro-batch (optionally per symbol) processed / failed counts,
    duration (ms, first to last record) and throughput = processed / seconds
    when both are positive."""
    keys = [batch_col] + (["symbol"] if by_symbol else [])
    ok = F.col(ok_col)
    out = (batches.groupBy(*keys)
                  .agg(F.count_if(ok).alias("messages_processed"),
                       F.count_if(~ok).alias("messages_failed"),
                       (F.max(ts_ms) - F.min(ts_ms)).alias("batch_duration_ms")))
    thr = F.when((F.col("messages_processed") > 0) & (F.col("batch_duration_ms") > 0),
                 F.col("messages_processed") / (F.col("batch_duration_ms") / 1000.0))
    return out.withColumn("throughput", thr.cast("double"))


def storage_report(tables: DataFrame) -> DataFrame:
    """Per table rows (millions) and size (GiB), largest first; input is
    (table_name, rows, bytes) per table, or per part of one, see sources.landing."""
    return (tables.groupBy("table_name")
                  .agg(F.sum("rows").alias("total_rows"), F.sum("bytes").alias("total_bytes"))
                  .select("table_name",
                          F.round(F.col("total_rows") / 1e6, 2).alias("rows_millions"),
                          F.round(F.col("total_bytes") / F.pow(F.lit(1024.0), 3), 2).alias("size_gb"),
                          "total_bytes")
                  .orderBy(F.col("total_bytes").desc()))


# Alert rules: anomaly rate above the limit for the sustain period ->
# alerting, missing data -> no_data; fewer than the minimum records summed
# over the period, for the period -> alerting, missing data -> alerting.
ANOMALY_RATE_LIMIT = FX.ANOMALY_RATE_LIMIT
MIN_RECORDS = FX.MIN_RECORDS
SUSTAIN_MINUTES = FX.SUSTAIN_MINUTES


def _trailing(minutes: DataFrame, n: int, aggs: dict) -> DataFrame:
    """``aggs`` over the ``n`` minutes up to each row of a gapless minute table: windows per day, each
    day behind the last n - 1 minutes of the day before (n - 1 of 1,440 rows are copied)."""
    day = F.date_trunc("day", "minute")
    own = minutes.withColumns({"_day": day, "_halo": F.lit(False)})
    shift = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n - 1))
    halo = (minutes.withColumns({"_day": F.date_trunc("day", F.col("minute") + shift), "_halo": F.lit(True)})
            .filter(F.col("_day") > day))
    w = Window.partitionBy("_day").orderBy("minute").rowsBetween(1 - n, 0)
    return (own.unionByName(halo).withColumns({k: v.over(w) for k, v in aggs.items()})
            .filter(~F.col("_halo")).drop("_day", "_halo"))


def minute_grid(lo: Column, hi: Column, bounds: DataFrame) -> DataFrame:
    """Every minute in [lo, hi]: days first, then minutes inside each day, so
    the generation spreads over tasks instead of one exploding row."""
    days = bounds.select(F.explode(F.sequence(F.date_trunc("day", lo).cast("timestamp_ntz"),
                                              F.date_trunc("day", hi).cast("timestamp_ntz"),
                                              F.expr("INTERVAL 1 DAY"))).alias("day"), lo.alias("lo"),
                         hi.alias("hi"))
    # one row per day, spread over tasks before each expands to 1440 minutes
    days = days.repartition(days.sparkSession.sparkContext.defaultParallelism, "day")
    mins = days.select(F.explode(F.sequence(
        F.greatest("day", "lo"),
        F.least(F.col("day") + F.expr("INTERVAL 1439 MINUTES"), F.col("hi")),
        F.expr("INTERVAL 1 MINUTE"))).alias("minute"))
    return mins


def alert_states(series: DataFrame, ts: str = "watermark_time") -> DataFrame:
    """Evaluate both alert rules on every minute of the data's time range.

    Per minute m: records and anomaly rate of that minute (minutes without
    records come from a generated grid). ``high_anomaly_rate``: no_data when
    minute m has no records; alerting when the rate exceeded the limit in each
    of the last 5 minutes; else ok. ``no_records``: alerting when minute m has
    no records (no data -> alerting) or fewer than the minimum in each of the last 5
    minutes; else ok. Spans that reach before the first minute are not full and
    never alert on duration."""
    n = SUSTAIN_MINUTES
    per_min = (series.groupBy(F.date_trunc("minute", F.col(ts)).cast("timestamp_ntz").alias("minute"))
                     .agg(F.count(F.lit(1)).alias("records"),
                          (F.count(F.when(F.col("is_anomaly"), 1)) * 100.0 / F.count(F.lit(1)))
                          .cast("double").alias("anomaly_rate")))
    # One row per minute, read by two branches below: materialise it once
    # as a table in the shared checkpoint folder instead of re-running the upstream plan.
    per_min = materialize(per_min, "alert-per-minute")
    bounds = per_min.agg(F.min("minute").alias("lo"), F.max("minute").alias("hi"))
    grid = minute_grid(F.col("lo"), F.col("hi"), bounds)
    m = grid.join(per_min, "minute", "left").fillna({"records": 0})
    m = m.withColumn("_high", F.coalesce(F.col("anomaly_rate") > ANOMALY_RATE_LIMIT,
                                         F.lit(False)).cast("int"))
    m = m.withColumn("_low", (F.col("records") < MIN_RECORDS).cast("int"))
    out = _trailing(m, n, {"_n": F.count(F.lit(1)), "_high_all": F.min("_high"), "_low_all": F.min("_low")})
    full = F.col("_n") == n
    rate_state = (F.when(F.col("records") == 0, "no_data")
                   .when(full & (F.col("_high_all") == 1), "alerting").otherwise("ok"))
    rec_state = F.when((F.col("records") == 0) | full & (F.col("_low_all") == 1), "alerting").otherwise("ok")
    return out.select("minute", "records", "anomaly_rate",
                      rate_state.alias("high_anomaly_rate_state"),
                      rec_state.alias("no_records_state"))
