"""Queries: the write side, landing chain and parametrised SQL, each written to the shared
folder (or a catalog table) and read back (K3, K5-K8, K9, K11, K13, K14, K16, K17, S2, S3, S6, S8,
S10, S11, S13, A16, P9, P10, P16)."""

import uuid

from pyspark.sql import functions as F

from ..operators import indicators as I, ingest as G, rollups as R, signals as SG
from ..session import scratch_path
from ..sinks import tables as TB, versioned as VT
from ..sources import landing as LD, sql as SQ, tables as TBL
from . import sql_blocks as Q
from .catalog import REGISTRY, register
from .common import TICK_SPEC, events, rounded, ticks, trades
from .q_ops import TGT_H, UPD_H, _split_hourly, _stats_of_all
from .q_rollups import OHLC_D, market_summary


def registry_sql(key):
    return REGISTRY[key].oracle()


def _folder(spark, key):
    return scratch_path(spark, f"{key}-{uuid.uuid4().hex}")


def _dated(df):
    return df.withColumn("trade_date", F.to_date("hour_timestamp"))


@register("upsert_table", f"""SELECT * FROM ({TGT_H}) AS t
  WHERE NOT EXISTS (SELECT 1 FROM ({UPD_H}) AS u WHERE u.symbol = t.symbol AND u.hour_timestamp = t.hour_timestamp)
UNION ALL SELECT * FROM ({UPD_H}) AS u2""", OHLC_D)
def upsert_table(spark, d):
    """K9 end to end: first load, an overlapping update, and the same update once more."""
    path = _folder(spark, "upsert-table")
    target, updates = _split_hourly(spark, d)
    for rows in (target, updates, updates):
        VT.upsert(spark, path, _dated(rows), ["symbol", "hour_timestamp"], "trade_date")
    return rounded(VT.read_table(spark, path).drop("trade_date"))


@register("append_counted", """SELECT count(*) AS rows_written, 2 * count(*) AS rows_in_table FROM events""")
def append_counted(spark, d):
    """K8: two appends, each counting what it wrote."""
    path = _folder(spark, "append")
    t = ticks(spark, d)
    TB.append_counted(t, path, partition_by=("partition_date",))
    n = TB.append_counted(t, path, partition_by=("partition_date",))
    return spark.read.parquet(path).agg(F.lit(n).cast("long").alias("rows_written"), F.count(F.lit(1)).alias("rows_in_table"))


@register("lake_scan", f"SELECT * FROM ({Q.TICKS}) AS t", ("price", "volume"))
def lake_scan(spark, d):
    """K3/K5 + S3: a lake tree by day and symbol, read back with its folder columns."""
    path = _folder(spark, "lake")
    t = ticks(spark, d)
    TB.write_table(t, path, partition_by=("partition_date", "symbol"), mode="WRITE_TRUNCATE")
    back = LD.read_lake(spark, path).withColumn("partition_date", F.col("partition_date").cast("string"))
    return rounded(back.select(*t.columns))


@register("partition_delete", f"""SELECT * FROM ({Q.HOURLY}) AS h
WHERE CAST(hour_timestamp AS DATE) > (SELECT CAST(min(ts) AS DATE) FROM events)""", OHLC_D)
def partition_delete(spark, d):
    """The first day's partition dropped as a folder."""
    path = _folder(spark, "partitions")
    TB.write_table(_dated(R.hourly_ohlcv(trades(spark, d))), path, partition_by=("trade_date",), mode="overwrite")
    TB.delete_partition(spark, path, "trade_date", TB.partition_values(spark, path, "trade_date")[0])
    return rounded(spark.read.parquet(path).drop("trade_date"))


@register("retention_table", f"""SELECT * FROM ({Q.HOURLY}) AS h
WHERE CAST(hour_timestamp AS DATE) >= (SELECT CAST(max(ts) AS DATE) FROM events) - INTERVAL 14 DAY""", OHLC_D)
def retention_table(spark, d):
    """K12 on folders: partitions more than 14 days behind the newest are dropped unread."""
    import datetime as dt
    path = _folder(spark, "retention")
    TB.write_table(_dated(R.hourly_ohlcv(trades(spark, d))), path, partition_by=("trade_date",), mode="overwrite")
    newest = dt.date.fromisoformat(TB.partition_values(spark, path, "trade_date")[-1])
    TB.apply_retention(spark, path, "trade_date", str(newest - dt.timedelta(days=14)))
    return rounded(spark.read.parquet(path).drop("trade_date"))


FORMATS = ("csv", "json", "parquet")


@register("load_formats", " UNION ALL ".join(
    f"SELECT '{f}' AS format, event_id, event_type, value FROM events" for f in FORMATS), ("value",))
def load_formats(spark, d):
    """The same rows landed in three formats and loaded with detected schemas."""
    rows = events(spark, d).select("event_id", "event_type", "value")
    out = None
    for f in FORMATS:
        path = _folder(spark, f"load-{f}")
        rows.write.format(f).options(**({"header": True} if f == "csv" else {})).save(path)
        back = LD.load_files(spark, path, f).select(F.lit(f).alias("format"), F.col("event_id").cast("long").alias("event_id"),
                                                    "event_type", F.col("value").cast("double").alias("value"))
        out = back if out is None else out.unionByName(back)
    return rounded(out)


@register("view_table", f"""SELECT symbol, hour_timestamp, close_price, total_volume FROM ({Q.HOURLY}) AS h WHERE total_trades > 1""",
          ("close_price", "total_volume"))
def view_table(spark, d):
    """K14/K17 + K16: a partitioned table registered in the catalog over written files, and a
    stored view on it."""
    path, name = _folder(spark, "catalog"), f"hourly_{uuid.uuid4().hex[:12]}"
    hourly = _dated(R.hourly_ohlcv(trades(spark, d)))
    TB.write_table(hourly, path, partition_by=("trade_date",), mode="overwrite")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in hourly.schema.fields)
    TB.create_table(spark, name, ddl, partition_by=("trade_date",), location=path)
    TB.create_view(spark, f"{name}_busy", f"SELECT symbol, hour_timestamp, close_price, total_volume FROM {name} "
                                          "WHERE total_trades > 1")
    return rounded(spark.table(f"{name}_busy"))


@register("insert_rows", """SELECT event_id, CASE WHEN event_id % 11 = 1 THEN 'invalid fields: value'
    WHEN event_id % 11 = 2 THEN 'unknown fields: note'
    WHEN event_id % 11 = 3 THEN 'invalid fields: value; unknown fields: note' END AS error,
  CASE WHEN event_id % 11 NOT IN (1, 2, 3) THEN value END AS value FROM events""", ("value",))
def insert_rows(spark, d):
    """K11 against a DDL schema: good rows typed, each bad row with its reasons."""
    e = F.col("event_id") % 11
    rows = events(spark, d).select(F.to_json(F.struct(
        "event_id", F.when(e.isin(1, 3), "much").otherwise(F.col("value").cast("string")).alias("text"),
        F.when(e.isin(2, 3), "x").alias("note"))).alias("json"))
    # a number where it is one, text where it is not
    rows = rows.select(F.regexp_replace(F.regexp_replace("json", '"text":"([-0-9.E]+)"', '"value":$1'),
                                        '"text":"much"', '"value":"much"').alias("json"))
    good, errors = TB.insert_rows(rows, "event_id BIGINT, value DOUBLE")
    bad = errors.select(F.get_json_object("json", "$.event_id").cast("long").alias("event_id"), "error",
                        F.lit(None).cast("double").alias("value"))
    return rounded(good.select("event_id", F.lit(None).cast("string").alias("error"), "value").unionByName(bad))


# Tickers of a landed payload: some hundred kilobytes of JSON.
PAYLOAD_RECORDS = 5_000


def _land_payloads(rows, item, path, records=PAYLOAD_RECORDS):
    """The ``item`` of every row in JSON arrays of about ``records`` each, one to a file, by ``day``."""
    days = rows.groupBy("day").agg(F.ceil(F.count(F.lit(1)) / records).alias("chunks"))
    days = days.select(F.col("day").alias("of_day"), "chunks")
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = rows.join(days, F.col("day").eqNullSafe(F.col("of_day")))
    (rows.groupBy("day", F.pmod(F.xxhash64("row"), F.col("chunks")).alias("chunk"))
     .agg(F.to_json(F.collect_list(item)).alias("value")).select("day", "value")
     .write.partitionBy("day").option("maxRecordsPerFile", 1).text(path))


@register("ticker_landing", """SELECT upper(event_type) AS symbol, value AS price, CAST(user_id AS DOUBLE) AS volume,
  CAST(NULL AS DOUBLE) AS high_24h, CAST(event_id AS INTEGER) AS trade_count, 1700000000::BIGINT AS "timestamp",
  'binance' AS source, '2024-02-03' AS partition_date, '04' AS partition_hour,
  TIMESTAMP '2023-11-14 22:13:20' AS watermark_time FROM events""", ("price", "volume", "high_24h"))
def ticker_landing(spark, d):
    """S11 -> P9 -> P10 -> S2: exchange payloads landed as JSON arrays (files of about
    ``PAYLOAD_RECORDS`` tickers of a day, numbers as text), normalised, stamped, and read again as the ticker stream's JSON."""
    path = _folder(spark, "payload")
    ev = events(spark, d).withColumn("day", F.to_date("ts"))
    item = F.struct(F.upper("event_type").alias("symbol"), F.col("value").cast("string").alias("lastPrice"),
                    F.col("user_id").cast("string").alias("volume"), F.lit("n/a").alias("highPrice"),
                    F.col("event_id").alias("count"))
    _land_payloads(ev, item, path)
    tick = G.normalize_tickers(G.read_ticker_payload(spark, path), timestamp=1_700_000_000)
    tick = G.ingest_time_columns(tick, now=F.lit("2024-02-03 04:05:06").cast("timestamp"))
    back = G.read_ticks_parsed(tick.select(F.to_json(F.struct("*")).alias("value")))
    return rounded(back.select("symbol", "price", "volume", "high_24h", "trade_count", "timestamp", "source",
                               "partition_date", "partition_hour",
                               F.col("watermark_time").cast("timestamp_ntz").alias("watermark_time")))


@register("sql_parameters", """SELECT event_type, count(*) AS n, sum(value) AS total FROM events
WHERE value > 10.5 AND event_type <> 'error' GROUP BY event_type""", ("total",))
def sql_parameters(spark, d):
    """Named parameters bound by the engine, the table passed as a frame."""
    return rounded(SQ.execute_query(
        spark, "SELECT event_type, count(*) AS n, sum(value) AS total FROM {ev} "
               "WHERE value > :least AND event_type <> :kind GROUP BY event_type",
        {"least": 10.5, "kind": "error"}, ev=events(spark, d)))


@register("sql_dry_run", """SELECT 'good' AS query, true AS valid, true AS has_size, NULL::VARCHAR AS error
UNION ALL SELECT 'unknown column', false, false, 'UNRESOLVED_COLUMN' UNION ALL SELECT 'unbound parameter', false, false, 'UNBOUND_SQL_PARAMETER'""")
def sql_dry_run(spark, d):
    """Dry runs of parametrised queries, each as a row."""
    asked = {"good": ("SELECT count(*) AS n FROM {ev} WHERE value > :least", {"least": 1.0}),
             "unknown column": ("SELECT nothing FROM {ev}", {}), "unbound parameter": ("SELECT * FROM {ev} WHERE value > :least", {})}
    rows = [SQ.estimate(spark, q, p, ev=events(spark, d)).withColumn("query", F.lit(k)) for k, (q, p) in asked.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).select(
        "query", "valid", (F.coalesce("bytes", F.lit(0)) > 0).alias("has_size"), F.substring_index("error", ".", 1).alias("error"))


@register("summary_refresh", f"""SELECT * FROM ({registry_sql("market_summary")}) AS s""")
def summary_refresh(spark, d):
    """The unpartitioned market summary, written over an older one whose rows must all be gone."""
    path = _folder(spark, "summary")
    summary = market_summary(spark, d)
    old = summary.withColumn("active_symbols", F.lit(-1).cast("long")).unionByName(summary)
    TB.write_table(old, path, mode="WRITE_TRUNCATE")
    TB.write_table(summary, path, mode="WRITE_TRUNCATE")
    return spark.read.parquet(path)


@register("table_rows", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS total_rows FROM {t}" for t in TBL.TABLES))
def table_rows(spark, d):
    """S8 + A16: rows per table from file footers."""
    return _stats_of_all(spark, d).select("table_name", F.col("rows").alias("total_rows"))


@register("table_fields", """SELECT 'events' AS table_name, count(*) AS num_rows, 6 AS num_fields, '' AS partition_columns,
  'event_type' AS cluster_columns FROM events""")
def table_fields(spark, d):
    """S10 without the byte count."""
    return LD.table_info(spark, f"{d}/events.parquet", "events", cluster_cols=("event_type",)).drop("num_bytes")


NEWEST_DAY = "(SELECT CAST(max(ts) AS DATE) FROM events)"


@register("report_of_day", f"""SELECT CAST(trade_timestamp AS DATE) AS report_date,
  count(*) AS total_transactions, count(DISTINCT symbol) AS unique_symbols,
  sum(trade_value_usd) AS total_value_usd, avg(price) AS avg_price,
  min(trade_timestamp) AS first_trade, max(trade_timestamp) AS last_trade
FROM ({Q.TRADES}) AS t WHERE CAST(trade_timestamp AS DATE) = {NEWEST_DAY} - INTERVAL 1 DAY GROUP BY 1""",
          ("total_value_usd", "avg_price"))
def report_of_day(spark, d):
    """yesterday's report, seen from the newest trade."""
    import datetime as dt
    newest = events(spark, d).agg(F.max("ts")).first()[0].date()
    return rounded(R.daily_report(trades(spark, d), day=str(newest - dt.timedelta(days=1))))


@register("signals_of_day", f"""SELECT symbol, price, rsi, macd_line, macd_signal,
  CASE WHEN rsi < 30 AND macd_line > macd_signal THEN 'BUY_SIGNAL'
       WHEN rsi > 70 AND macd_line < macd_signal THEN 'SELL_SIGNAL' ELSE 'HOLD' END AS trading_signal, watermark_time
FROM ({Q.indicators()}) AS i WHERE rsi IS NOT NULL AND macd_line IS NOT NULL
  AND CAST(partition_date AS DATE) = {NEWEST_DAY}""", ("price", "rsi", "macd_line", "macd_signal"))
def signals_of_day(spark, d):
    """P16 + P19: the newest day's signals."""
    newest = events(spark, d).agg(F.max("ts")).first()[0].date()
    ind = I.technical_indicators(ticks(spark, d), spec=TICK_SPEC)
    return rounded(SG.trading_signals(ind, day=newest, order_col="watermark_time"))
