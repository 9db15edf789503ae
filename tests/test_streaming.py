"""Streaming: late rows are dropped by the watermark and counted."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tickforge.session import scratch_path
from tickforge.streaming import jobs as J, sources as SS

SCHEMA = "symbol string, price double, volume double, timestamp long, watermark_time timestamp, event_id long"


def _ticks(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


T0 = dt.datetime(2024, 1, 1, 0, 0)


def test_every_tick_is_accounted_for(spark):
    """Late and time-less ticks are audited, not lost; replays change nothing."""
    base = scratch_path(spark, f"t-audit-{uuid.uuid4().hex}")
    step = J.ordered_ticker_batches(base, "10 minutes")
    on_time = [("A", 10.0 + i, 1.0, i, T0 + dt.timedelta(minutes=i), i) for i in range(41)]
    batches = [on_time[:40], [on_time[40], ("A", 99.0, 1.0, 0, T0 + dt.timedelta(minutes=1), 100), ("A", 98.0, 1.0, 0, None, 101),
                              ("B", 5.0, 1.0, 0, T0 + dt.timedelta(minutes=33), 102), (None, 5.0, 1.0, 0, T0 + dt.timedelta(minutes=36), 103)],
               [], [("A", 1.0, 1.0, 0, T0 + dt.timedelta(minutes=90), 104)]]

    def account():
        return {r["outcome"]: r["n"] for r in J.ticker_account(spark, base).collect()}
    sent = 0
    for n, rows in enumerate(batches):
        step(_ticks(spark, rows), n)
        sent += len(rows)
        first = account()
        assert sum(first.values()) == sent
        step(_ticks(spark, rows), n)                                     # a replay
        assert account() == first
    assert first == {"written": 43, "pending": 1, "behind_watermark": 1, "no_event_time": 1}
    audited = spark.read.parquet(f"{base}/audited")
    assert {(r["event_id"], r["audit_reason"]) for r in audited.collect()} == {(100, "behind_watermark"), (101, "no_event_time")}
    agg = spark.read.parquet(f"{base}/aggregated")
    assert agg.filter(F.col("max_price_5min") >= 98.0).count() == 0
    J.drain_ticker(spark, base)
    assert account() == {"written": 44, "pending": 0, "behind_watermark": 1, "no_event_time": 1}


def test_ticker_state_follows_the_batch(spark):
    """What a batch writes as state does not grow with what waits or with the symbols that are quiet."""
    from tickforge.sinks import manifest as M
    base = scratch_path(spark, f"t-state-{uuid.uuid4().hex}")
    step = J.ordered_ticker_batches(base, "12 hours")
    big = [(f"S{k}", 1.0 + i, 1.0, i, T0 + dt.timedelta(minutes=i % 700), 1000 * k + i) for k in range(40) for i in range(300)]
    step(_ticks(spark, big), 0)
    first = M.size_of(spark, f"{base}/_state/pending/batch_id=0")
    assert first > 0
    for b in range(1, 4):
        step(_ticks(spark, [("S1", 2.0, 1.0, 1, T0 + dt.timedelta(minutes=700 + b), 10**6 + b)]), b)
        assert M.size_of(spark, f"{base}/_state/pending/batch_id={b}") + M.size_of(spark, f"{base}/_state/tails/b={b}") < first / 5
    # Once the watermark has passed a waiting hour, its folders go.
    for b in range(4, 7):
        step(_ticks(spark, [("S1", 2.0, 1.0, 1, T0 + dt.timedelta(days=3, minutes=b), 10**6 + b)]), b)
    assert M.folders(spark, f"{base}/_state/pending") == [f"batch_id={b}" for b in (4, 5, 6)]


def test_engine_counts_rows_behind_its_watermark(spark):
    """Stateful operators of the engine drop late rows; the count comes from its progress reports."""
    base = scratch_path(spark, f"t-late-{uuid.uuid4().hex}")
    b1 = [("A", 10.0 + i, 1.0, 0, T0 + dt.timedelta(minutes=i), i) for i in range(40)]
    # Spark drops rows behind the watermark of the *previous* micro-batch, so
    # one on-time batch sits between the watermark jump and the late row.
    for n, rows in enumerate((b1, [("A", 50.0, 1.0, 0, T0 + dt.timedelta(minutes=40), 40)],
                              [("A", 99.0, 1.0, 0, T0 + dt.timedelta(minutes=1), 100)])):
        _ticks(spark, rows).coalesce(1).write.parquet(f"{base}/in/f{n}")
    src = SS.replay_stream(spark, f"{base}/in/*", spark.read.parquet(f"{base}/in/f1").schema, max_files_per_trigger=1)
    kept = J.dedup_stream(src, keys=("symbol", "event_id"), ts="watermark_time")
    q = J._writer(kept, f"{base}/ck", None).format("parquet").option("path", f"{base}/out").start()
    J.run_to_completion(q)
    assert spark.read.parquet(f"{base}/out").count() == 41 and J.dropped_by_watermark(q) == 1
    pm = J.progress_metrics(spark, q).collect()
    assert sum(r["messages_processed"] for r in pm) == 42 and all(r["batch_duration_ms"] >= 0 for r in pm)


def test_progress_of_more_batches_than_the_engine_keeps(spark):
    base = scratch_path(spark, f"t-progress-{uuid.uuid4().hex}")
    spark.range(0, 240, 1, 120).write.parquet(f"{base}/in")
    src = SS.replay_stream(spark, f"{base}/in/*.parquet", spark.range(1).schema, max_files_per_trigger=1)
    q = J._writer(src, f"{base}/ck", None).format("noop").start()
    J.run_to_completion(q)
    rows = J.progress_metrics(spark, q).filter("messages_processed > 0").collect()
    assert len(rows) == 120 and sum(r["messages_processed"] for r in rows) == 240


def test_trade_stream_fan_out_and_replay(spark):
    from tickforge.plans.q_ingest import envelopes_of
    d = "/root/testdata/sf0.001"
    base = scratch_path(spark, f"t-trade-{uuid.uuid4().hex}")
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    env = envelopes_of(SS.replay_stream(spark, f"{d}/events*.parquet", schema))
    q = J.trade_stream(env, f"{base}/valid", f"{base}/dlq", f"{base}/ck")
    J.run_to_completion(q)
    valid, dlq = spark.read.parquet(f"{base}/valid"), spark.read.parquet(f"{base}/dlq")
    n = spark.read.parquet(f"{d}/events.parquet").count()
    n_valid = valid.count()
    assert n_valid + dlq.count() == n
    assert set(r[0] for r in dlq.select("validation_error").distinct().collect()) <= {"invalid_quantity"}
    # replaying batch 0 through the same body rewrites, never duplicates
    body = J.validated_batches(None, f"{base}/valid", f"{base}/dlq")
    batch = J.G.transform_trades(J.G.flatten_trades(J.G.parse_envelopes(
        envelopes_of(spark.read.parquet(f"{d}/events.parquet")))))
    body(batch, 0)
    assert spark.read.parquet(f"{base}/valid").count() == n_valid


def test_trade_sinks_are_packed(spark):
    """Valid rows and dead letters of many micro-batches: the same rows in few folders."""
    from tickforge.plans.q_ingest import envelopes_of
    from tickforge.sinks import manifest as M
    from tickforge.sinks.versioned import read_batches
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    base = scratch_path(spark, f"t-packed-{uuid.uuid4().hex}")
    body = J.validated_batches(None, f"{base}/valid", f"{base}/dlq", pack_every=5, small_folders=1)
    for n in range(11):
        part = ev.filter(F.col("event_id") % 11 == n)
        batch = J.G.transform_trades(J.G.flatten_trades(J.G.parse_envelopes(envelopes_of(part))))
        body(batch, n)
    body(batch, 10)                                          # a replay
    valid, dlq = read_batches(spark, f"{base}/valid", "trade_date"), read_batches(spark, f"{base}/dlq")
    assert valid.count() + dlq.count() == ev.count() and valid.select("symbol", "trade_id").distinct().count() == valid.count()
    doc = M.read(spark, f"{base}/dlq")[1]
    assert len(doc["folders"][""]) <= 2 and doc["upto"] == 8


def test_ticker_stream_writes_three_sinks(spark):
    from tickforge.sources import adapters
    d = "/root/testdata/sf0.001"
    base = scratch_path(spark, f"t-ticker-{uuid.uuid4().hex}")
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    ticks = adapters.ticks(SS.replay_stream(spark, f"{d}/events*.parquet", schema))
    J.run_to_completion(J.ticker_stream(ticks, base))
    det = spark.read.parquet(f"{base}/detailed")
    ev = spark.read.parquet(f"{d}/events.parquet")
    from pyspark.sql import functions as F
    newest = ev.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)
    mark = newest.replace(minute=newest.minute - newest.minute % 5, second=0, microsecond=0)
    waiting = ev.filter(F.col("ts") >= F.lit(mark)).count()
    assert det.count() == ev.count() - waiting and waiting > 0
    assert {"partition_date", "symbol", "rsi"} <= set(det.columns)
    agg = spark.read.parquet(f"{base}/aggregated")
    assert agg.count() > 0 and "partition_date" in agg.columns
    assert J.read_latest_price(spark, f"{base}/kv").count() == det.select("symbol").distinct().count()


def test_execute_query_parameters_and_dry_run(spark):
    from tickforge.sources.sql import execute_query
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    q = "SELECT count(*) AS n FROM {ev} WHERE event_type = :t"
    n = execute_query(spark, q, {"t": "click"}, ev=ev).first()["n"]
    assert n == ev.filter("event_type = 'click'").count()
    plan = execute_query(spark, q, {"t": "click"}, dry_run=True, ev=ev).first()[0]
    assert "Statistics" in plan


def test_latest_prices_survive_replay(spark):
    base = scratch_path(spark, f"t-kv-{uuid.uuid4().hex}")
    body = J.latest_price_batches(f"{base}/kv")
    mk = lambda rows: spark.createDataFrame(rows, "symbol string, timestamp long, event_id long, price double")
    prices = lambda: {r["symbol"]: r["price"] for r in J.read_latest_price(spark, f"{base}/kv").collect()}
    body(mk([("A", 1, 1, 10.0), ("B", 1, 2, 20.0)]), 0)
    body(mk([("A", 5, 3, 11.0)]), 1)
    body(mk([("A", 5, 3, 11.0)]), 1)                       # replay of batch 1
    assert prices() == {"A": 11.0, "B": 20.0}
    # a crashed write of batch 2 (never committed) is ignored by readers and by the replay
    mk([("B", 9, 4, 99.0)]).write.mode("overwrite").parquet(f"{base}/kv/delta/b=2/hour=0")
    assert prices()["B"] == 20.0
    body(mk([("B", 9, 4, 21.0), ("A", 5, 2, 1.0)]), 2)
    # equal timestamps: the later batch wins
    assert prices() == {"A": 1.0, "B": 21.0}
    for b in range(3, 15):                                  # deltas are merged on the way
        body(mk([("A", 5 + b, 3, float(b))]), b)
    assert prices() == {"A": 14.0, "B": 21.0}


def test_ticker_job_carries_state_across_batches(spark):
    from tickforge.operators import indicators as I
    from tickforge.plans.common import TICK_SPEC
    from tickforge.sinks.versioned import read_batches
    from tickforge.sources import adapters
    d = "/root/testdata/sf0.001"
    base = scratch_path(spark, f"t-multi-{uuid.uuid4().hex}")
    ev = spark.read.parquet(f"{d}/events.parquet")
    # six time-ordered files -> six micro-batches, each symbol spans all of them
    cuts = [dt.datetime(2024, 1, 1) + dt.timedelta(days=5 * i) for i in range(7)]
    for i in range(6):
        part = ev.filter((F.col("ts") >= cuts[i]) & (F.col("ts") < cuts[i + 1]) if i < 5 else (F.col("ts") >= cuts[i]))
        part.coalesce(1).write.parquet(f"{base}/in/p{i}")
    src = SS.replay_stream(spark, f"{base}/in/*", ev.schema, max_files_per_trigger=1)
    q = J.ticker_stream(adapters.ticks(src), f"{base}/out")
    J.run_to_completion(q)
    assert len([p for p in q.recentProgress if p.numInputRows > 0]) == 6
    J.drain_ticker(spark, f"{base}/out")
    got = {r["event_id"]: r for r in read_batches(spark, f"{base}/out/detailed").collect()}
    exp = {r["event_id"]: r for r in I.technical_indicators(adapters.ticks(ev), spec=TICK_SPEC).collect()}
    assert got.keys() == exp.keys()
    for k, e in exp.items():
        g = got[k]
        for c in ("rsi", "macd_signal", "z_score", "price_volatility"):
            if e[c] is None:
                assert g[c] is None, (k, c)
            else:
                assert abs(g[c] - e[c]) <= 1e-9 * max(1.0, abs(e[c])), (k, c, g[c], e[c])
        assert g["anomaly_type"] == e["anomaly_type"]


def test_connector_stream_and_graceful_stop(spark):
    src = SS.connector_stream(spark, "rate", rowsPerSecond=5)
    assert src.isStreaming
    base = scratch_path(spark, f"t-rate-{uuid.uuid4().hex}")
    q = (src.writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/ck").trigger(processingTime="1 second").start())
    assert q.isActive
    J.stop_all(spark)
    assert not q.isActive and not spark.streams.active


def test_read_ticks_parsed(spark):
    import json
    from tickforge.operators import ingest as G
    raw = spark.createDataFrame([(json.dumps({"symbol": "BTCUSDT", "price": 1.5, "volume": 2.0,
                                              "timestamp": 1700000000, "source": "x"}),), ("x{",)], "value string")
    out = G.read_ticks_parsed(raw).collect()
    assert len(out) == 2
    ok = [r for r in out if r["symbol"] == "BTCUSDT"][0]
    assert ok["watermark_time"].timestamp() == 1700000000 and ok["processing_time"] is not None
