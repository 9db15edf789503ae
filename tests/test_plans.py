"""Plan-shape guards: the physical properties the scale design relies on."""

import re

from tickforge.operators import analytics as A, indicators as I, quality as QL, rollups as R
from tickforge.plans.common import TICK_SPEC, ticks, trades
from tickforge.plans.q_ingest import _parsed

from paths import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ohlcv_is_hash_aggregated_with_pushed_range(spark):
    h = R.hourly_ohlcv(trades(spark, SF001), start="2024-01-02", end="2024-01-03")
    p = _plan(h)
    assert "HashAggregate" in p and "SortAggregate" not in p
    assert re.search(r"DataFilters: \[.*ts#\d+ >= 2024-01-02", p)


def test_indicator_set_shares_one_exchange(spark):
    df = I.technical_indicators(ticks(spark, SF001), spec=TICK_SPEC)
    p = _plan(df)
    assert p.count("Exchange hashpartitioning") == 1 and p.count("Window [") >= 4


def test_large_series_add_their_own_exchange_and_tails(spark):
    p = _plan(I.technical_indicators(ticks(spark, SF001), spec=TICK_SPEC.with_(piece_rows=100)))
    # whole series; pieces of large ones; tails of series that run over several pieces; two rows per piece
    assert p.count("Exchange hashpartitioning") == 4
    assert "WindowGroupLimit" in p and "BroadcastHashJoin" in p and "CartesianProduct" not in p


def test_input_of_series_is_pruned(spark):
    cut = ticks(spark, SF001).repartitionByRange(4, "symbol", "watermark_time", "event_id")
    assert "user_id" not in re.search(r"ReadSchema: struct<([^>]*)>", _plan(cut)).group(1)


def test_json_parsed_once_per_row(spark):
    _, invalid = QL.validate(_parsed(spark, SF001))
    assert _optimized(invalid).count("from_json(") == 1


def test_correlation_has_no_pair_join(spark):
    rets = A.daily_returns(ticks(spark, SF001), days=None)
    p = _plan(A.correlation_pairs(rets, min_days=2))
    assert "Join" not in p
    assert "FlatMapGroupsInPandas" in p


def test_upsert_reads_only_touched_partitions(spark):
    import uuid
    from pyspark.sql import functions as F
    from tickforge.session import scratch_path
    from tickforge.sinks import tables as TB
    h = R.hourly_ohlcv(trades(spark, SF001)).withColumn("trade_date", F.to_date("hour_timestamp"))
    path = scratch_path(spark, f"t-dpp-{uuid.uuid4().hex}")
    TB.write_table(h, path, partition_by=("trade_date",), mode="overwrite")
    upd = h.filter(F.col("trade_date") == F.lit("2024-01-10").cast("date"))
    cur = spark.read.parquet(path).join(upd.select("trade_date").distinct(), "trade_date", "left_semi")
    merged = TB.merge_rows(cur.select(*upd.columns), upd, ["symbol", "hour_timestamp"])
    merged.write.format("noop").mode("overwrite").save()
    assert "dynamicpruningexpression(trade_date" in _plan(merged)
