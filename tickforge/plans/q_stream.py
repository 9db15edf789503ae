"""Queries: the streaming jobs, replaying the events table through real
Structured Streaming queries (availableNow trigger), then reading the sink.

Oracles are the batch SQL of the same operators; for the windowed aggregate,
windows the final watermark has not passed are not emitted in append mode,
so its oracle keeps only windows ending at or before max(ts) - 10 minutes."""

import uuid

from pyspark.sql import functions as F

from ..session import ensure_conf, scratch_path
from ..sources import adapters
from ..sinks import versioned as VT
from ..streaming import jobs as J, sources as SS
from . import sql_blocks as Q
from .catalog import register
from .common import flat_window, rounded
from .q_ingest import INVALID_SQL, PARSED_D, VALID_SQL, envelopes_of
from .q_rollups import M5_D
from .q_series import IND_D


def _events_stream(spark, d):
    ensure_conf(spark)
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    # A glob: the file source wants a folder or pattern, not a single file.
    return SS.replay_stream(spark, f"{d}/events*.parquet", schema, max_files_per_trigger=1)


def _run(spark, key):
    base = scratch_path(spark, f"stream-{key}-{uuid.uuid4().hex[:12]}")
    return base, f"{base}/_checkpoint"


@register("stream_validate", VALID_SQL, PARSED_D)
def stream_validate(spark, d):
    base, ck = _run(spark, "validate")
    env = envelopes_of(_events_stream(spark, d))
    flat = J.G.flatten_trades(J.G.parse_envelopes(env))
    parsed = J.G.transform_trades(flat, processing_time=F.col("pubsub_publish_time"))
    with J.state_partitions(spark):
        q = (parsed.writeStream.option("checkpointLocation", ck).trigger(availableNow=True)
             .foreachBatch(J.validated_batches(parsed, f"{base}/valid", f"{base}/dlq")).start())
    J.run_to_completion(q)
    out = spark.read.parquet(f"{base}/valid").drop("batch_id")
    ts_cols = ("pubsub_publish_time", "event_timestamp", "trade_timestamp", "processing_time")
    return rounded(out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ts_cols}))


@register("stream_validate_packed", VALID_SQL, PARSED_D)
def stream_validate_packed(spark, d):
    """K1: the same rows from four micro-batches whose day folders are packed between them, under the reader."""
    base, ck = _run(spark, "packed")
    ensure_conf(spark)
    ev = spark.read.parquet(f"{d}/events.parquet")
    for i in range(4):
        ev.filter(F.col("event_id") % 4 == i).write.parquet(f"{base}/landing/slice={i}")
        env = envelopes_of(SS.replay_stream(spark, f"{base}/landing/slice=*/*.parquet", ev.schema))
        parsed = J.G.transform_trades(J.G.flatten_trades(J.G.parse_envelopes(env)), processing_time=F.col("pubsub_publish_time"))
        body = J.validated_batches(parsed, f"{base}/valid", f"{base}/dlq", pack_every=2, small_folders=0)
        J.run_to_completion(J._writer(parsed, ck, None).foreachBatch(body).start())
    out = VT.read_batches(spark, f"{base}/valid", "trade_date")
    ts_cols = ("pubsub_publish_time", "event_timestamp", "trade_timestamp", "processing_time")
    return rounded(out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ts_cols}))


@register("stream_validate_dlq", f"""SELECT trade_id, price, symbol, validation_error, 'trade_stream' AS source,
  publish AS processing_time, true AS keeps_nulls
FROM (SELECT *, pubsub_publish_time AS publish FROM ({INVALID_SQL}) AS i) AS p""", ("price",))
def stream_validate_dlq(spark, d):
    """K2: the dead-letter rows, read back field by field from their JSON."""
    base, ck = _run(spark, "dlq")
    flat = J.G.flatten_trades(J.G.parse_envelopes(envelopes_of(_events_stream(spark, d))))
    parsed = J.G.transform_trades(flat, processing_time=F.col("pubsub_publish_time"))
    with J.state_partitions(spark):
        q = (parsed.writeStream.option("checkpointLocation", ck).trigger(availableNow=True)
             .foreachBatch(J.validated_batches(parsed, f"{base}/valid", f"{base}/dlq")).start())
    J.run_to_completion(q)
    field = lambda k, t: F.get_json_object("raw_data", f"$.{k}").cast(t).alias(k)
    return rounded(spark.read.parquet(f"{base}/dlq").select(
        field("trade_id", "long"), field("price", "double"), field("symbol", "string"), "validation_error", "source",
        F.col("processing_time").cast("timestamp_ntz").alias("processing_time"),
        F.col("raw_data").contains('"seller_order_id":null').alias("keeps_nulls")))


@register("stream_progress", """SELECT count(*) AS messages_processed, true AS measured, true AS has_throughput FROM events""")
def stream_progress(spark, d):
    """A17 as the engine measured it: rows per micro-batch, processing time and throughput."""
    base, ck = _run(spark, "progress")
    tr = adapters.trades(_events_stream(spark, d))
    q = J._writer(tr, ck, None).format("parquet").option("path", f"{base}/out").start()
    J.run_to_completion(q)
    per_batch = J.progress_metrics(spark, q).filter("messages_processed > 0")
    return per_batch.agg(F.sum("messages_processed").alias("messages_processed"),
                         (F.min("batch_duration_ms") > 0).alias("measured"),
                         (F.min("throughput") > 0).alias("has_throughput"))


@register("stream_dedup", Q.TRADES, ("price", "quantity", "trade_value_usd"))
def stream_dedup(spark, d):
    """Every fifth event lands twice: the stream has 20 % duplicates."""
    base, ck = _run(spark, "dedup")
    ensure_conf(spark)
    ev = spark.read.parquet(f"{d}/events.parquet")
    ev.filter(F.col("event_id") % 5 == 0).write.parquet(f"{base}/landing/slice=0")
    ev.write.parquet(f"{base}/landing/slice=1")
    src = SS.replay_stream(spark, f"{base}/landing/slice=*/*.parquet", ev.schema)
    tr = J.dedup_stream(adapters.trades(src))
    with J.state_partitions(spark):
        q = J._writer(tr, ck, None).format("parquet").option("path", f"{base}/out").start()
    J.run_to_completion(q)
    out = spark.read.parquet(f"{base}/out")
    return rounded(out.withColumn("trade_timestamp", F.col("trade_timestamp").cast("timestamp_ntz")))


def _detailed(spark, base):
    out = VT.read_batches(spark, f"{base}/detailed")
    return rounded(out.withColumn("partition_date", F.col("partition_date").cast("string")))


@register("stream_indicators", Q.indicators(), IND_D)
def stream_indicators(spark, d):
    """The ticker job over the whole stream, drained after it has stopped."""
    base, _ = _run(spark, "indicators")
    J.run_to_completion(J.ticker_stream(adapters.ticks(_events_stream(spark, d)), base))
    J.drain_ticker(spark, base)
    return _detailed(spark, base)


@register("stream_market_5min", f"""SELECT * FROM ({Q.market_5min(Q.indicators())}) AS m
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""", M5_D)
def stream_market_5min(spark, d):
    base, _ = _run(spark, "market")
    J.run_to_completion(J.ticker_stream(adapters.ticks(_events_stream(spark, d)), base))
    return rounded(flat_window(VT.read_batches(spark, f"{base}/aggregated").drop("partition_date")))


@register("stream_latest_price", f"""SELECT symbol, "timestamp", price, volume, "timestamp" + 86400 AS ttl
FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC, event_id DESC) AS rn
      FROM ({Q.TICKS}) AS t) AS r WHERE rn = 1""", ("price", "volume"))
def stream_latest_price(spark, d):
    base, ck = _run(spark, "kv")
    t = adapters.ticks(_events_stream(spark, d)).select("symbol", "timestamp", "event_id", "price", "volume")
    with J.state_partitions(spark):
        q = J._writer(t, ck, None).foreachBatch(J.latest_price_batches(f"{base}/kv")).start()
    J.run_to_completion(q)
    return rounded(J.read_latest_price(spark, f"{base}/kv"))


# Puts that overlap: every event, then two batches that put some of the last days' items again.
PUTS = (("true", 0.0), ("ts >= (SELECT max(ts) FROM events) - INTERVAL 2 DAY AND event_id % 3 = 0", 1.0),
        ("ts >= (SELECT max(ts) FROM events) - INTERVAL 12 HOUR AND event_id % 2 = 0", 2.0))
PUT_SQL = " UNION ALL ".join(f"SELECT symbol, \"timestamp\", event_id, price + {more} AS price, {n}::BIGINT AS write_batch FROM ({Q.TICKS}) AS t "
                             f"WHERE {cond.replace('ts >=', 'watermark_time >=')}" for n, (cond, more) in enumerate(PUTS))


@register("stream_kv_items", f"""SELECT symbol, "timestamp", price, "timestamp" + 86400 AS ttl, write_batch
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, "timestamp" ORDER BY write_batch DESC, event_id DESC) AS rn
      FROM ({PUT_SQL}) AS t) AS r
WHERE rn = 1 AND "timestamp" + 86400 > (SELECT max(CAST(floor(epoch(ts)) AS BIGINT)) FROM events)""", ("price",))
def stream_kv_items(spark, d):
    """K4: the key-value item table after three micro-batches whose puts overlap: the newest put of a (symbol,
    timestamp) stays, items older than the TTL on the data clock are gone."""
    base, ck = _run(spark, "kvitems")
    ensure_conf(spark)
    ev = spark.read.parquet(f"{d}/events.parquet")
    newest = ev.agg(F.max("ts")).first()[0]
    keep = (F.lit(True), (F.col("ts") >= F.lit(newest) - F.expr("INTERVAL 2 DAYS")) & (F.col("event_id") % 3 == 0),
            (F.col("ts") >= F.lit(newest) - F.expr("INTERVAL 12 HOURS")) & (F.col("event_id") % 2 == 0))
    for n, (cond, (_, more)) in enumerate(zip(keep, PUTS)):
        ev.filter(cond).withColumn("value", F.col("value") + F.lit(more)).write.parquet(f"{base}/landing/slice={n}")
        src = SS.replay_stream(spark, f"{base}/landing/slice=*/*.parquet", ev.schema)
        t = adapters.ticks(src).select("symbol", "timestamp", "event_id", "price")
        J.run_to_completion(J._writer(t, ck, None).foreachBatch(J.kv_item_batches(f"{base}/kv")).start())
    return rounded(J.KvTable(spark, f"{base}/kv").read())


SLICES = 4


@register("stream_indicators_sliced", Q.indicators(), IND_D)
def stream_indicators_sliced(spark, d):
    """T8 across micro-batches: events land as time-ordered slices; after each landing the same job is
    triggered again (availableNow) and sees only the new files, so its state has to carry
    the series across four micro-batches."""
    base, _ = _run(spark, "sliced")
    ev = spark.read.parquet(f"{d}/events.parquet")
    ensure_conf(spark)
    bounds = ev.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    step = (bounds["hi"] - bounds["lo"]) / SLICES
    cuts = [bounds["lo"] + step * i for i in range(1, SLICES)]
    for i in range(SLICES):
        cond = F.lit(True)
        if i > 0:
            cond = cond & (F.col("ts") >= F.lit(cuts[i - 1]))
        if i < SLICES - 1:
            cond = cond & (F.col("ts") < F.lit(cuts[i]))
        ev.filter(cond).write.parquet(f"{base}/landing/slice={i}")
        src = SS.replay_stream(spark, f"{base}/landing/slice=*/*.parquet", ev.schema)
        J.run_to_completion(J.ticker_stream(adapters.ticks(src), f"{base}/out"))
    J.drain_ticker(spark, f"{base}/out")
    return _detailed(spark, f"{base}/out")


# ---- event-time order: every third event arrives six hours late, the watermark waits twelve
LATE, DELAY, LANDINGS = "6 HOURS", "12 HOURS", 3
# Windows that the final watermark has passed are evaluated.
PASSED = f"time_bucket(INTERVAL 5 MINUTE, (SELECT max(ts) FROM events) - INTERVAL {DELAY})"


def _late_run(spark, d, key, arrival=None, time=None):
    """The ticker job over events that land in order of ``arrival``, in three micro-batches; ``time`` is their
    event time."""
    base, _ = _run(spark, key)
    ensure_conf(spark)
    ev = spark.read.parquet(f"{d}/events.parquet")
    if arrival is None:
        arrival = F.when(F.col("event_id") % 3 == 0, F.col("ts") + F.expr(f"INTERVAL {LATE}")).otherwise(F.col("ts"))
    landed = ev.withColumn("arrival", arrival)
    bounds = landed.agg(F.min("arrival").alias("lo"), F.max("arrival").alias("hi")).first()
    step = (bounds["hi"] - bounds["lo"]) / LANDINGS
    if time is not None:
        landed = landed.withColumn("ts", time)
    for i in range(LANDINGS):
        part = landed.filter((F.col("arrival") >= F.lit(bounds["lo"] + step * i))
                             & (F.lit(i == LANDINGS - 1) | (F.col("arrival") < F.lit(bounds["lo"] + step * (i + 1)))))
        part.drop("arrival").write.parquet(f"{base}/landing/slice={i}")
        src = SS.replay_stream(spark, f"{base}/landing/slice=*/*.parquet", ev.schema)
        J.run_to_completion(J.ticker_stream(adapters.ticks(src), f"{base}/out", watermark=DELAY))
    return f"{base}/out"


@register("stream_indicators_late", f"SELECT * FROM ({Q.indicators()}) AS i WHERE watermark_time < {PASSED}", IND_D)
def stream_indicators_late(spark, d):
    """Late rows inside the watermark change nothing: equal to the batch operator."""
    return _detailed(spark, _late_run(spark, d, "late"))


@register("stream_market_late", f"SELECT * FROM ({Q.market_5min(Q.indicators())}) AS m WHERE window_end <= {PASSED}", M5_D)
def stream_market_late(spark, d):
    """T9 behind T8: closed windows of the same run."""
    out = VT.read_batches(spark, f"{_late_run(spark, d, 'late-market')}/aggregated").drop("partition_date")
    return rounded(flat_window(out))


@register("stream_latest_late", f"""SELECT symbol, "timestamp", price, volume, rsi, macd_line, is_anomaly, "timestamp" + 86400 AS ttl
FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC, event_id DESC) AS rn
      FROM ({Q.indicators()}) AS i WHERE watermark_time < {PASSED}) AS r WHERE rn = 1""",
          ("price", "volume", "rsi", "macd_line"))
def stream_latest_late(spark, d):
    """K4 of the same run."""
    return rounded(J.read_latest_price(spark, f"{_late_run(spark, d, 'late-kv')}/kv"))


# Landing of the audited run: every eleventh event a week late, every 13th without event time.
LOST_SQL = f"""e AS (SELECT event_id, ts, CASE WHEN event_id % 11 = 0 THEN ts + INTERVAL 7 DAY ELSE ts END AS arrival FROM events),
b AS (SELECT min(arrival) AS lo, CAST(round(epoch_us(max(arrival)) - epoch_us(min(arrival))) AS BIGINT) AS width FROM e),
l AS (SELECT event_id, CASE WHEN event_id % 13 = 0 THEN NULL ELSE ts END AS t,
        CASE WHEN epoch_us(arrival) - epoch_us(lo) < CAST(round(width / 3.0) AS BIGINT) THEN 0
             WHEN epoch_us(arrival) - epoch_us(lo) < 2 * CAST(round(width / 3.0) AS BIGINT) THEN 1 ELSE 2 END AS n FROM e, b),
s AS (SELECT *, max(t) OVER (ORDER BY n RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM l),
o AS (SELECT *, CASE WHEN t IS NULL THEN 'no_event_time' WHEN t < seen - INTERVAL {DELAY} THEN 'behind_watermark'
               WHEN t < time_bucket(INTERVAL 5 MINUTE, (SELECT max(t) FROM l) - INTERVAL {DELAY}) THEN 'written' ELSE 'pending' END AS outcome FROM s)"""


@register("stream_ticker_audit", f"""WITH {LOST_SQL}
SELECT outcome, count(*) AS n, true AS adds_up FROM o GROUP BY outcome""")
def stream_ticker_audit(spark, d):
    """Every row sent is written, pending or audited with its reason."""
    arrival = F.when(F.col("event_id") % 11 == 0, F.col("ts") + F.expr("INTERVAL 7 DAYS")).otherwise(F.col("ts"))
    time = F.when(F.col("event_id") % 13 != 0, F.col("ts"))
    out = _late_run(spark, d, "audit", arrival, time)
    account = J.ticker_account(spark, out).filter("n > 0")
    sent = spark.read.parquet(f"{d}/events.parquet").agg(F.count(F.lit(1)).alias("sent"))
    total = account.agg(F.sum("n").alias("total"))
    return account.withColumn("adds_up", F.lit(sent.first()[0]) == F.lit(total.first()[0]))
