"""Parameterised paths of the operators: day filters, look-backs, as-of
metrics, registry lookups and the landed ticker payload chain."""

import datetime as dt
import json
import uuid

from pyspark.sql import functions as F

from tickforge import schemas as SC
from tickforge.operators import (indicators as I, ingest as G, metrics as MT, quality as QL,
                                 rollups as R, schema_ops as SO, signals as SG)
from tickforge.plans.common import TICK_SPEC, ticks, trades
from tickforge.session import scratch_path
from tickforge.sinks import tables as TB

from paths import SF001


def test_day_filters(spark):
    tr = trades(spark, SF001)
    day = "2024-01-05"
    h = R.hourly_ohlcv(tr)
    d = R.daily_ohlcv(h, day=day)
    assert {str(r["trade_date"]) for r in d.collect()} == {day}
    rep = R.daily_report(tr, day=day).collect()
    n = tr.filter(F.to_date("trade_timestamp") == day).count()
    assert len(rep) == 1 and rep[0]["total_transactions"] == n
    hv = R.hourly_volume(ticks(spark, SF001), day=day)
    assert hv.agg(F.sum("trade_frequency")).first()[0] == n
    ind = I.technical_indicators(ticks(spark, SF001), spec=TICK_SPEC)
    sig = SG.trading_signals(ind, day=day, order_col="watermark_time")
    assert sig.count() <= n and sig.filter(F.col("rsi").isNull()).count() == 0


def test_dq_counts_last_hour(spark):
    tr = trades(spark, SF001)
    mx = tr.agg(F.max("trade_timestamp")).first()[0]
    exp = tr.filter(F.col("trade_timestamp") >= mx - dt.timedelta(hours=1))
    r = QL.dq_counts(tr, hours=1).first()
    assert r["total_rows"] == exp.count()
    assert r["invalid_quantities"] == exp.filter("quantity <= 0").count()
    assert r["has_issues"] == (r["invalid_quantities"] > 0)


def test_custom_metrics_as_of(spark):
    ind = I.technical_indicators(ticks(spark, SF001), spec=TICK_SPEC)
    m = {r["metric_name"]: (r["value"], r["unit"]) for r in MT.custom_metrics(ind).collect()}
    mx = ind.agg(F.max("timestamp")).first()[0]
    recent = ind.filter(F.col("timestamp") > mx - 300)
    n = recent.count()
    a = recent.filter("is_anomaly").count()
    assert m["TotalRecords"] == (float(n), "Count")
    assert m["AnomalyCount"] == (float(a), "Count")
    assert m["AnomalyRate"] == (a * 100.0 / n if n else 0.0, "Percent")
    assert m["ActiveSymbols"][0] == float(recent.select("symbol").distinct().count())


def test_registry_lookups(spark):
    reg = spark.createDataFrame([
        ("t", "v-0001", "h1", json.dumps({"fields": {"a": "STRING"}}), "backward", True,
         dt.datetime(2024, 1, 1), "pipeline", None),
        ("t", "v-0002", "h2", json.dumps({"fields": {"a": "STRING", "b": "INTEGER"}}), "backward", True,
         dt.datetime(2024, 1, 2), "pipeline", None)], SC.SCHEMA_REGISTRY)
    assert SO.schema_by_hash(reg, "t", "h1").first()["version_id"] == "v-0001"
    assert [r["version_id"] for r in SO.schema_history(reg, "t").collect()] == ["v-0002", "v-0001"]
    act = {r["version_id"]: r["is_active"] for r in SO.with_active_flag(reg).collect()}
    assert act == {"v-0001": False, "v-0002": True}
    rep = SO.compatibility_report(reg).orderBy("version_id").collect()
    assert rep[1]["backward_ok"] and not rep[1]["forward_ok"] and rep[1]["previous_version"] == "v-0001"


def test_landed_ticker_chain(spark):
    base = scratch_path(spark, f"t-landing-{uuid.uuid4().hex}")
    payload = [{"symbol": "BTCUSDT", "lastPrice": "42000.5", "volume": "12.5", "highPrice": "43000",
                "lowPrice": "41000", "priceChange": "100.5", "priceChangePercent": "0.24", "count": 1234},
               {"symbol": "ETHUSDT", "lastPrice": "2200", "volume": "100", "highPrice": "2300",
                "lowPrice": "2100", "priceChange": "-5", "priceChangePercent": "-0.2", "count": 99},
               {"symbol": "XRPUSDT", "lastPrice": "0.5", "volume": "1", "highPrice": "0.6",
                "lowPrice": "0.4", "priceChange": "0", "priceChangePercent": "0", "count": 1}]
    spark.createDataFrame([(json.dumps(payload),)], "v string").coalesce(1).write.text(f"{base}/tickers")
    raw = G.read_ticker_payload(spark, f"{base}/tickers")
    t = G.normalize_tickers(raw, timestamp=1700000000, symbols=["BTCUSDT", "ETHUSDT"])
    assert t.count() == 2 and t.filter("symbol = 'BTCUSDT'").first()["price"] == 42000.5
    smap = spark.createDataFrame([("BTCUSDT", "bitcoin"), ("ETHUSDT", "ethereum")], SC.SYMBOL_MAP)
    market = spark.createDataFrame([(json.dumps({"bitcoin": {"usd_market_cap": 8e11, "usd_24h_vol": 2e10,
                                                             "usd_24h_change": 1.5}}),)], "value string")
    e = G.ingest_time_columns(G.enrich_tickers(t, smap, G.market_entries(market)),
                              now=dt.datetime(2024, 3, 1, 7, 5))
    rows = {r["symbol"]: r for r in e.collect()}
    assert rows["BTCUSDT"]["market_cap"] == 8e11 and rows["ETHUSDT"]["market_cap"] is None
    assert rows["BTCUSDT"]["partition_date"] == "2024-03-01" and rows["BTCUSDT"]["partition_hour"] == "07"
    item = TB.latest_price_items(e).filter("symbol = 'BTCUSDT'").first()
    assert item["ttl"] == 1700000000 + 86400 and float(item["market_cap"]) == 8e11


def test_a_day_is_landed_in_payloads_of_bounded_size(spark):
    from tickforge.plans import q_sinks
    base = scratch_path(spark, f"t-payloads-{uuid.uuid4().hex}")
    day = F.when(F.col("id") < 2_900, F.lit("2024-01-01")).when(F.col("id") < 2_990, F.lit("2024-01-02")).cast("date")
    rows = spark.range(3_000).withColumn("day", day)
    item = F.struct(F.lit("A").alias("symbol"), F.col("id").alias("count"))
    q_sinks._land_payloads(rows, item, f"{base}/p", records=100)
    back = G.read_ticker_payload(spark, f"{base}/p")
    sizes = [r["count"] for r in back.groupBy(F.input_file_name().alias("f")).count().collect()]
    assert len(sizes) >= 25 and max(sizes) <= 200
    assert sorted(r["count"] for r in back.select("count").collect()) == list(range(3_000))


def test_scheduled_hour_bounds_are_aligned(spark):
    lo, hi = R.scheduled_hour_bounds(dt.datetime(2024, 1, 5, 10, 37, 12), lookback_hours=2)
    r = spark.range(1).select(lo.alias("lo"), hi.alias("hi")).first()
    assert r["lo"] == dt.datetime(2024, 1, 5, 8, 0) and r["hi"] == dt.datetime(2024, 1, 5, 10, 37, 12)
    h = R.hourly_ohlcv(trades(spark, SF001), start=lo, end=hi)
    assert {x["hour_timestamp"].hour for x in h.collect()} <= {8, 9, 10}
