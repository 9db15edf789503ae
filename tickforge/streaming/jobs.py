"""Streaming jobs: trade validation with dead-letter fan-out (K1, K2, T4-T7,
T10-T13), ticker indicators -> lake + 5-minute aggregates + latest price + audit of late rows
(K3, K4, T1-T3, T8, T9), and stream-side dedup.

Every sink has its own checkpoint under the shared checkpoint folder; a
micro-batch replay after an executor or driver loss rewrites the same output
(batch-keyed folders / keyed upsert), so results stay exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .. import fixed as FX
from ..operators import indicators as I, ingest as G, quality as QL, rollups as R
from ..session import scratch_scope
from ..sinks import manifest as M, tables as TB
from ..sinks.kvstore import KvTable
from ..sinks.versioned import compact, read_batches


class state_partitions:
    """Context manager: shuffle partitions used when a stateful query first
    starts (the count is then fixed in its checkpoint). Defaults to twice the
    cluster's default parallelism instead of a session-wide constant."""

    def __init__(self, spark: SparkSession, n: int | None = None):
        self.spark = spark
        self.n = n or max(1, 2 * spark.sparkContext.defaultParallelism)

    def __enter__(self):
        self.prev = self.spark.conf.get("spark.sql.shuffle.partitions")
        self.spark.conf.set("spark.sql.shuffle.partitions", str(self.n))
        return self

    def __exit__(self, *exc):
        self.spark.conf.set("spark.sql.shuffle.partitions", self.prev)
        return False


def _writer(df: DataFrame, checkpoint: str, trigger: dict | None, mode: str = "append"):
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    trig = trigger or {"availableNow": True}
    return w.trigger(**trig)


def validated_batches(parsed: DataFrame, valid_path: str, dlq_path: str,
                      null_policy: str = "dead_letter", pack_every: int | None = None, small_folders: int = 4):
    """T10/T11 body: one persisted micro-batch written to both sinks.
    Output folders are keyed by batch id, so a replayed batch overwrites its
    own files instead of appending duplicates. With ``pack_every`` the folders of the batches before
    are packed every so many batches (``versioned.compact``); readers then use ``read_batches``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist()
        try:
            valid, invalid = QL.validate(b, null_policy=null_policy)
            # K1 layout: day partitions, rows clustered by (symbol, hour)
            TB.write_table(valid, f"{valid_path}/batch_id={batch_id}", partition_by=("trade_date",),
                           cluster_by=("symbol", "trade_hour"), mode="overwrite")
            QL.dead_letter(invalid, processing_time=F.col("processing_time")) \
              .write.mode("overwrite").parquet(f"{dlq_path}/batch_id={batch_id}")
        finally:
            b.unpersist()
        if pack_every and batch_id % pack_every == pack_every - 1:
            compact(batch.sparkSession, valid_path, "trade_date", ("symbol", "trade_hour"), small_folders=small_folders)
            compact(batch.sparkSession, dlq_path, small_folders=small_folders)
    return run


def trade_stream(envelopes: DataFrame, valid_path: str, dlq_path: str, checkpoint: str,
                 trigger: dict | None = None, truncate_to_second: bool = False, pack_every: int | None = None):
    """Trade stream job: parse -> transform -> validate -> valid + DLQ sinks,
    with the source read once per micro-batch."""
    flat = G.flatten_trades(G.parse_envelopes(envelopes), truncate_to_second)
    parsed = G.transform_trades(flat)
    return (_writer(parsed, checkpoint, trigger)
            .foreachBatch(validated_batches(parsed, valid_path, dlq_path, pack_every=pack_every)).start())


def dedup_stream(trades: DataFrame, watermark: str = FX.WATERMARK_DELAY,
                 keys=("symbol", "trade_id"), ts: str = "trade_timestamp") -> DataFrame:
    """Drop producer-retry duplicates seen within the watermark delay."""
    return (trades.withColumn(ts, F.col(ts).cast("timestamp"))
                  .withWatermark(ts, watermark)
                  .dropDuplicatesWithinWatermark(list(keys)))


# Columns that order puts of a symbol's price; not part of the items.
KV_ORDER = ("event_id", "write_batch")


def latest_price_table(spark: SparkSession, path: str) -> KvTable:
    """One item per symbol, the newest: equal timestamps go to the later batch, inside a batch to the higher
    event id. Items do not expire."""
    return KvTable(spark, path, ["symbol"], ["timestamp", "write_batch", "event_id"], expires=False)


def latest_price_batches(kv_path: str):
    """K4: foreachBatch body that puts the newest price of every symbol in the batch."""
    def run(batch: DataFrame, batch_id: int) -> None:
        items = TB.latest_price_items(batch, as_decimal=False, keep=("event_id",))
        for c in KV_ORDER[:1]:
            if c not in items.columns:
                items = items.withColumn(c, F.lit(None).cast("long"))
        latest_price_table(batch.sparkSession, kv_path).put(items.withColumn("write_batch", F.lit(batch_id).cast("long")), batch_id)
    return run


def read_latest_price(spark: SparkSession, kv_path: str) -> DataFrame:
    return latest_price_table(spark, kv_path).read().drop(*KV_ORDER)


def kv_item_batches(kv_path: str, ttl_seconds: int = FX.KV_TTL_SECONDS):
    """K4 faithful: every micro-batch puts one item per (symbol, timestamp) into the key-value table
    (the newer batch wins); items whose TTL passed on the data clock are gone."""
    def run(batch: DataFrame, batch_id: int) -> None:
        KvTable(batch.sparkSession, kv_path).put(TB.kv_items(batch, ttl_seconds, write_batch=batch_id), batch_id)
    return run


def run_to_completion(query) -> None:
    """Wait for an availableNow query and surface its failure, if any. Its progress reports are
    gathered as they come (``progress_reports``): the engine keeps only the last ones."""
    query._reports = {}
    while not query.awaitTermination(GATHER_SECONDS):
        _gather(query)
    if query.exception():
        raise query.exception()
    _gather(query)


# A report takes a batch, and a batch some commits to the checkpoint: far less than the
# engine's last 100 reports come in this time.
GATHER_SECONDS = 0.5
KEPT_REPORTS = 100


def _gather(query) -> None:
    reports = query.recentProgress
    if not query._reports:
        # Fewer than the engine keeps: none is gone yet.
        query._whole = len(reports) < KEPT_REPORTS or int(reports[0].batchId) == 0
    for p in reports:
        query._reports[(int(p.batchId), p.timestamp)] = (
            int(p.batchId), int(p.numInputRows), int(p.durationMs.get("triggerExecution", 0)),
            int(sum(op.numRowsDroppedByWatermark for op in p.stateOperators)))


def progress_reports(query) -> list[tuple]:
    """(batch, input rows, trigger ms, rows dropped by watermark) of every progress report. An
    error where reports are missing, never a part of them."""
    if not hasattr(query, "_reports"):
        query._reports = {}
    _gather(query)
    batches = {b for b, _ in query._reports}
    if not query._whole or batches and len(batches) <= max(batches) - min(batches):
        raise RuntimeError("progress reports are missing: wait for the query with run_to_completion")
    return [query._reports[k] for k in sorted(query._reports)]


def stop_all(spark: SparkSession) -> None:
    """Graceful stop of every active query of the session."""
    for q in spark.streams.active:
        q.stop()


AUDIT = ("behind_watermark", "no_event_time")
TAILS_MERGED = 16               # batches between full versions of the tails


def _state_versions(spark: SparkSession, out_root: str) -> list[int]:
    """Batches whose state is complete."""
    return M.versions(spark, f"{out_root}/_state")


class _TickerState:
    """State of the ordered ticker job under ``out_root/_state``, written in proportion to the batch:

    * ``pending/batch_id=N/hour=H`` - rows of batch N that have to wait, as they came, by the hour of their event
      time. They stay where they are until their time is evaluated; hours behind the mark are dropped as folders.
    * ``tails/b=N`` - the last rows of the symbols evaluated in batch N, merged every ``TAILS_MERGED`` batches.
    * the manifest - newest event time and mark (all rows before it are evaluated), which tails are live.
    """

    def __init__(self, spark: SparkSession, out_root: str, spec, batch_id: int):
        self.spark, self.root, self.spec, self.batch_id = spark, f"{out_root}/_state", spec, batch_id
        # A replayed batch starts from the state before it.
        _, self.before = M.read(spark, self.root, below=batch_id)

    @property
    def newest(self):
        return self.before.get("newest")

    @property
    def mark(self):
        return self.before.get("mark")

    def add(self, rows: DataFrame) -> None:
        """Put down the batch's waiting rows."""
        hour = F.floor(F.unix_micros(F.col("watermark_time").cast("timestamp")) / F.lit(HOUR_US)).cast("long")
        rows.withColumn("hour", hour).write.mode("overwrite").partitionBy("hour").parquet(f"{self.root}/pending/batch_id={self.batch_id}")

    def between(self, schema, lo: int | None, hi: int) -> DataFrame:
        """Waiting rows of earlier batches with event times (epoch microseconds) from ``lo`` on and before ``hi``: only
        their hours are read."""
        us = F.unix_micros(F.col("watermark_time").cast("timestamp"))
        folders = []
        for b in M.folders(self.spark, f"{self.root}/pending", "batch_id="):
            if int(b[9:]) < self.batch_id:
                for h in M.folders(self.spark, f"{self.root}/pending/{b}", "hour="):
                    if int(h[5:]) * HOUR_US < hi and (lo is None or (int(h[5:]) + 1) * HOUR_US > lo):
                        folders.append(f"{self.root}/pending/{b}/{h}")
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*folders).filter(us < hi)
        return rows if lo is None else rows.filter(us >= lo)

    def tails(self, schema) -> DataFrame:
        """The newest tail of every symbol."""
        live = [f"{self.root}/{x}" for x in self.before.get("tails", [])]
        if not live:
            return self.spark.createDataFrame([], schema).withColumn("_b", F.lit(0).cast("long"))
        rows = self.spark.read.parquet(*live)
        newest = Window.partitionBy(self.spec.key)
        return rows.withColumn("_top", F.max("_b").over(newest)).filter("_b = _top").drop("_top")

    def commit(self, tail: DataFrame, newest: int, mark: int) -> None:
        name = f"tails/b={self.batch_id}"
        live = self.before.get("tails", [])
        if len(live) >= TAILS_MERGED:
            rest = self.tails(tail.schema).drop("_b").join(tail.select(self.spec.key).distinct().withColumnRenamed(self.spec.key, "_k"),
                                                           F.col(self.spec.key).eqNullSafe(F.col("_k")), "left_anti")
            tail, live = tail.unionByName(rest), []
        tail.withColumn("_b", F.lit(self.batch_id).cast("long")).write.mode("overwrite").parquet(f"{self.root}/{name}")
        if self.batch_id in M.versions(self.spark, self.root):
            return                                      # a replay: the same state is there
        M.commit(self.spark, self.root, self.batch_id, {"newest": newest, "mark": mark, "tails": [*live, name]})
        self._drop()

    def _drop(self) -> None:
        """Remove what the batch before did not need any more: this batch cannot be followed by its replay."""
        kept = {f"tails/{n}" for n in M.folders(self.spark, f"{self.root}/tails")}
        for x in kept - set(self.before.get("tails", [])) - {f"tails/b={self.batch_id}"}:
            M.remove(self.spark, f"{self.root}/{x}")
        if self.mark is None:
            return
        for b in M.folders(self.spark, f"{self.root}/pending", "batch_id="):
            inside = M.folders(self.spark, f"{self.root}/pending/{b}", "hour=")
            done = [h for h in inside if (int(h[5:]) + 1) * HOUR_US <= self.mark]
            for x in [b] if len(done) == len(inside) and int(b[9:]) < self.batch_id else [f"{b}/{h}" for h in done]:
                M.remove(self.spark, f"{self.root}/pending/{x}")


HOUR_US = 3_600_000_000
WINDOW_US = 300_000_000         # FX.MARKET_WINDOW


def _interval_us(text: str) -> int:
    """Microseconds of an interval such as '10 minutes'."""
    n, unit = text.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400}[unit.lower().rstrip("s")] * 1_000_000


def ordered_ticker_batches(out_root: str, delay: str = FX.WATERMARK_DELAY, spec=None):
    """T3/T8/T9/T11 in event-time order: foreachBatch body for tick rows that may come late.

    Rows wait until the watermark (newest event time seen less ``delay``) has passed their 5-minute window;
    then the rows of all windows passed are evaluated in series order behind each symbol's last rows by the
    batch operator, which cuts hot symbols. A window is evaluated once and whole, so its aggregate needs no
    state. Outputs, each by batch: enriched rows (``detailed``), 5-minute aggregates (``aggregated``), the newest
    price per symbol (``kv``), and ``audited``: rows that cannot take part, as they came, with the reason
    (behind the watermark of the batches before, or without event time). Every row sent is in ``detailed``, still
    pending, or audited (``ticker_account``).

    A replayed batch starts from the same state and rewrites the same files."""
    spec = spec or I.SeriesSpec(key="symbol", order=("watermark_time", "event_id"))
    return lambda batch, batch_id: _ticker_step(batch, batch_id, out_root, _interval_us(delay), spec)


def _ticker_step(batch: DataFrame, batch_id: int, out_root: str, wait: int, spec, drain: bool = False) -> None:
    spark = batch.sparkSession
    state = _TickerState(spark, out_root, spec, batch_id)
    rows = batch.withColumn("watermark_time", F.col("watermark_time").cast("timestamp_ntz")).persist()
    enriched = None
    try:
        with scratch_scope(spark):
            us = F.unix_micros(F.col("watermark_time").cast("timestamp"))
            late = F.lit(False) if state.newest is None else us < F.lit(state.newest - wait)
            reason = F.when(us.isNull(), F.lit(AUDIT[1])).when(late, F.lit(AUDIT[0]))
            seen = rows.agg(F.max(F.when(reason.isNull(), us)).alias("newest"), F.count(reason).alias("audited")).first()
            if seen["audited"]:
                (rows.withColumn("audit_reason", reason).filter("audit_reason is not null")
                 .write.mode("overwrite").parquet(f"{out_root}/audited/batch_id={batch_id}"))
            accepted = rows.filter(reason.isNull())
            newest = max((x for x in (state.newest, seen["newest"]) if x is not None), default=None)
            if newest is None:
                mark = None
            else:
                # The start of the first window the watermark has not passed.
                mark = newest // WINDOW_US * WINDOW_US + WINDOW_US if drain else (newest - wait) // WINDOW_US * WINDOW_US
                mark = max(mark, state.mark or mark)
            state.add(accepted if mark is None else accepted.filter(us >= F.lit(mark)))
            ready = accepted.limit(0) if mark is None else accepted.filter(us < F.lit(mark)).unionByName(
                state.between(rows.schema, state.mark, mark))
            ready = ready.withColumn("_tail", F.lit(False)).unionByName(
                state.tails(rows.schema).drop("_b").withColumn("_tail", F.lit(True)))
            enriched = I.technical_indicators(ready, spec=spec).filter(~F.col("_tail")).drop("_tail").persist()
            days = ("partition_date", "symbol") if "partition_date" in enriched.columns else ()
            TB.write_table(enriched, f"{out_root}/detailed/batch_id={batch_id}", days, mode="overwrite")
            latest_price_batches(f"{out_root}/kv")(enriched, batch_id)
            agg = R.market_5min(enriched, ts="watermark_time", window=FX.MARKET_WINDOW)
            # the aggregate has no date of its own: the window's
            agg = agg.withColumn("partition_date", F.date_format(F.col("window.start"), "yyyy-MM-dd"))
            TB.write_table(agg, f"{out_root}/aggregated/batch_id={batch_id}", ("partition_date",), mode="overwrite")
            # Tails of the symbols evaluated now; the others' are as they were.
            moved = Window.partitionBy(spec.key)
            last = moved.orderBy(*[F.col(c).desc() for c in spec.order])
            # (New rows are later than a tail, so they are among the last ones.)
            tail = (ready.withColumn("_nth", F.row_number().over(last)).filter(F.col("_nth") <= I.COMPOSITE_LOOKBACK)
                    .withColumn("_new", F.max(~F.col("_tail")).over(moved)).filter("_new").drop("_nth", "_new", "_tail"))
            state.commit(tail, newest, mark)
    finally:
        rows.unpersist()
        if enriched is not None:
            enriched.unpersist()


def drain_ticker(spark: SparkSession, out_root: str, spec=None) -> None:
    """T12 for the ticker job: evaluate everything that still waits, after its query has stopped for good."""
    spec = spec or I.SeriesSpec(key="symbol", order=("watermark_time", "event_id"))
    done = _state_versions(spark, out_root)
    folders = M.folders(spark, f"{out_root}/_state/pending", "batch_id=")
    hours = [f"{out_root}/_state/pending/{b}/{h}" for b in folders for h in M.folders(spark, f"{out_root}/_state/pending/{b}", "hour=")]
    if done and hours:
        none = spark.read.parquet(*hours[:1]).limit(0)
        _ticker_step(none, done[-1] + 1, out_root, 0, spec, drain=True)


def ticker_account(spark: SparkSession, out_root: str) -> DataFrame:
    """(outcome, n): where every row of the ticker job is: ``written``, ``pending``, or audited by reason."""
    written = read_batches(spark, f"{out_root}/detailed")
    audited = read_batches(spark, f"{out_root}/audited")
    done = _state_versions(spark, out_root)
    mark = M.read(spark, f"{out_root}/_state")[1].get("mark") if done else None
    folders = M.folders(spark, f"{out_root}/_state/pending", "batch_id=")
    hours = [f"{out_root}/_state/pending/{b}/{h}" for b in folders for h in M.folders(spark, f"{out_root}/_state/pending/{b}", "hour=")]
    counts = spark.createDataFrame([(o, 0) for o in ("written", "pending", *AUDIT)], "outcome string, n long")
    if written is not None:
        counts = counts.unionByName(written.select(F.lit("written").alias("outcome"), F.lit(1).cast("long").alias("n")))
    if hours:
        pending = spark.read.parquet(*hours)
        if mark is not None:
            pending = pending.filter(F.unix_micros(F.col("watermark_time").cast("timestamp")) >= F.lit(mark))
        counts = counts.unionByName(pending.select(F.lit("pending").alias("outcome"), F.lit(1).cast("long").alias("n")))
    if audited is not None:
        counts = counts.unionByName(audited.select(F.col("audit_reason").alias("outcome"), F.lit(1).cast("long").alias("n")))
    return counts.groupBy("outcome").agg(F.sum("n").alias("n"))


def ticker_stream(ticks: DataFrame, out_root: str, trigger: dict | None = None,
                  watermark: str = FX.WATERMARK_DELAY):
    """Ticker stream job (K3, K4, T3, T8, T9, T11): one query whose batches write enriched ticks,
    5-minute market aggregates, the latest-price table and the audit of late rows from one state, in
    event-time order. Rows of windows the final watermark has not passed stay in the state (``drain_ticker``)."""
    return (_writer(ticks, f"{out_root}/_ck", trigger)
            .foreachBatch(ordered_ticker_batches(out_root, watermark)).start())


def dropped_by_watermark(query) -> int:
    """Rows the engine dropped as later than the watermark (all stateful
    operators, all progress reports)."""
    return sum(dropped for *_, dropped in progress_reports(query))


def progress_metrics(spark: SparkSession, query) -> DataFrame:
    """A17 from the engine's own progress reports: per micro-batch input rows,
    trigger duration (ms) and throughput (rows/s when both are positive)."""
    rows = [r[:3] for r in progress_reports(query)]
    df = spark.createDataFrame(rows, "batch_id long, messages_processed long, batch_duration_ms long")
    thr = F.when((F.col("messages_processed") > 0) & (F.col("batch_duration_ms") > 0),
                 F.col("messages_processed") / (F.col("batch_duration_ms") / 1000.0))
    return df.withColumn("throughput", thr.cast("double"))
