"""Queries: ingest, validation and enrichment.

Records are first serialised from the driver tables (to_json), so the parse
operators run on real JSON text whose size grows with the tables."""

from pyspark.sql import functions as F

from ..operators import ingest as G, quality as QL
from . import sql_blocks as Q
from .catalog import register
from ..operators import indicators as I
from .common import TICK_SPEC, events, rounded, ticks, trades
from .q_series import IND_D

# ---- envelopes built from events: canonical trade JSON + attributes + publish time
MS = "epoch_us(ts) // 1000"
TRADE_JSON_SQL = f"""SELECT to_json({{'event_type': 'trade', 'event_time': {MS},
    'symbol': upper(event_type), 'trade_id': event_id, 'price': value,
    'quantity': {Q.K}, 'buyer_order_id': user_id, 'seller_order_id': NULL::BIGINT,
    'trade_time': {MS}, 'is_buyer_maker': user_id % 2 = 0,
    'ingestion_time': NULL::VARCHAR, 'source': 'events'}}) AS data, ts AS publish_time
FROM events"""

PARSED_SQL = f"""WITH p AS (SELECT CAST(json_extract_string(data, '$.event_type') AS VARCHAR) AS event_type,
    CAST(json_extract(data, '$.event_time') AS BIGINT) AS event_time,
    json_extract_string(data, '$.symbol') AS symbol,
    CAST(json_extract(data, '$.trade_id') AS BIGINT) AS trade_id,
    CAST(json_extract(data, '$.price') AS DOUBLE) AS price,
    CAST(json_extract(data, '$.quantity') AS DOUBLE) AS quantity,
    CAST(json_extract(data, '$.buyer_order_id') AS BIGINT) AS buyer_order_id,
    CAST(json_extract_string(data, '$.seller_order_id') AS BIGINT) AS seller_order_id,
    CAST(json_extract(data, '$.trade_time') AS BIGINT) AS trade_time,
    CAST(json_extract(data, '$.is_buyer_maker') AS BOOLEAN) AS is_buyer_maker,
    json_extract_string(data, '$.ingestion_time') AS ingestion_time,
    json_extract_string(data, '$.source') AS source,
    publish_time AS pubsub_publish_time
  FROM ({TRADE_JSON_SQL}) AS e)
SELECT *, make_timestamp(event_time * 1000) AS event_timestamp,
  make_timestamp(trade_time * 1000) AS trade_timestamp,
  price * quantity AS trade_value_usd,
  CAST(make_timestamp(trade_time * 1000) AS DATE) AS trade_date,
  CAST(hour(make_timestamp(trade_time * 1000)) AS BIGINT) AS trade_hour,
  pubsub_publish_time AS processing_time, '1.0.0' AS pipeline_version
FROM p"""
PARSED_D = ("price", "quantity", "trade_value_usd")


def _envelopes(spark, d):
    return envelopes_of(events(spark, d))


def envelopes_of(ev):
    """events (batch or stream) -> message envelopes carrying trade JSON."""
    ms = F.unix_micros(F.col("ts").cast("timestamp")) / 1000
    rec = F.struct(F.lit("trade").alias("event_type"), F.floor(ms).alias("event_time"),
                   F.upper("event_type").alias("symbol"), F.col("event_id").alias("trade_id"),
                   F.col("value").alias("price"),
                   F.get_json_object("props", "$.k").cast("double").alias("quantity"),
                   F.col("user_id").alias("buyer_order_id"),
                   F.lit(None).cast("long").alias("seller_order_id"),
                   F.floor(ms).alias("trade_time"),
                   ((F.col("user_id") % 2) == 0).alias("is_buyer_maker"),
                   F.lit(None).cast("string").alias("ingestion_time"),
                   F.lit("events").alias("source"))
    return ev.select(F.to_json(rec).cast("binary").alias("data"),
                     F.create_map(F.lit("symbol"), F.upper("event_type")).alias("attributes"),
                     F.col("ts").cast("timestamp").alias("publish_time"))


def _parsed(spark, d):
    flat = G.flatten_trades(G.parse_envelopes(_envelopes(spark, d)))
    out = G.transform_trades(flat, processing_time=F.col("pubsub_publish_time"))
    ts_cols = ("pubsub_publish_time", "event_timestamp", "trade_timestamp", "processing_time")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ts_cols})


@register("parse_trades", PARSED_SQL, PARSED_D)
def parse_trades(spark, d):
    return rounded(_parsed(spark, d))


VALID_SQL = f"""SELECT * FROM ({PARSED_SQL}) AS p
WHERE symbol IS NOT NULL AND price > 0 AND quantity > 0 AND trade_id IS NOT NULL"""
INVALID_SQL = f"""SELECT *, CASE WHEN symbol IS NULL THEN 'missing_symbol'
    WHEN price IS NULL THEN 'missing_price' WHEN price <= 0 THEN 'invalid_price'
    WHEN quantity IS NULL THEN 'missing_quantity' WHEN quantity <= 0 THEN 'invalid_quantity'
    ELSE 'unknown_error' END AS validation_error
FROM ({PARSED_SQL}) AS p
WHERE NOT coalesce(symbol IS NOT NULL AND price > 0 AND quantity > 0 AND trade_id IS NOT NULL, false)"""


@register("validate_valid", VALID_SQL, PARSED_D)
def validate_valid(spark, d):
    return rounded(QL.validate(_parsed(spark, d))[0])


@register("validate_invalid", INVALID_SQL, PARSED_D)
def validate_invalid(spark, d):
    return rounded(QL.validate(_parsed(spark, d))[1])


# ---- raw exchange messages (single-letter keys, string numerics) from events
RAW_SQL = f"""SELECT CAST(json_object('e', 'trade', 'E', {MS}, 's', lower(event_type), 't', event_id,
    'p', CAST(value AS VARCHAR), 'q', CAST({Q.K} AS VARCHAR), 'b', user_id, 'T', {MS},
    'm', user_id % 2 = 0) AS VARCHAR) AS value FROM events"""


@register("normalize_raw_trades", f"""SELECT coalesce(json_extract_string(value, '$.e'), 'trade') AS event_type,
  CAST(json_extract(value, '$.E') AS BIGINT) AS event_time,
  upper(coalesce(json_extract_string(value, '$.s'), '')) AS symbol,
  CAST(json_extract(value, '$.t') AS BIGINT) AS trade_id,
  TRY_CAST(json_extract_string(value, '$.p') AS DOUBLE) AS price,
  TRY_CAST(json_extract_string(value, '$.q') AS DOUBLE) AS quantity,
  CAST(json_extract(value, '$.b') AS BIGINT) AS buyer_order_id,
  CAST(json_extract_string(value, '$.a') AS BIGINT) AS seller_order_id,
  CAST(json_extract(value, '$.T') AS BIGINT) AS trade_time,
  coalesce(CAST(json_extract(value, '$.m') AS BOOLEAN), false) AS is_buyer_maker,
  'binance' AS source
FROM ({RAW_SQL}) AS r""", ("price", "quantity"))
def normalize_raw_trades(spark, d):
    ev = events(spark, d)
    ms = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000)
    raw = ev.select(F.to_json(F.struct(
        F.lit("trade").alias("e"), ms.alias("E"), F.lower("event_type").alias("s"),
        F.col("event_id").alias("t"), F.col("value").cast("string").alias("p"),
        F.get_json_object("props", "$.k").cast("double").cast("string").alias("q"),
        F.col("user_id").alias("b"), ms.alias("T"),
        ((F.col("user_id") % 2) == 0).alias("m"))).alias("value"))
    return rounded(G.normalize_raw_trades(raw).drop("ingestion_time"))


@register("clean_ticks", f"""SELECT * EXCLUDE (rn),
  CASE WHEN rsi IS NOT NULL AND macd_line IS NOT NULL THEN 100
       WHEN price IS NOT NULL AND volume IS NOT NULL THEN 80 ELSE 60 END AS data_quality_score
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, "timestamp" ORDER BY event_id) AS rn
      FROM ({Q.indicators()}) AS t
      WHERE price > 0 AND volume >= 0 AND "timestamp" IS NOT NULL AND symbol IS NOT NULL) AS c
WHERE rn = 1""", IND_D)
def clean_ticks(spark, d):
    """P11 + O4 + P12 on the indicator-enriched detail rows (as the lake job
    cleans them): score 100 where rsi and macd_line exist, else 80."""
    enriched = I.technical_indicators(ticks(spark, d), spec=TICK_SPEC)
    return rounded(QL.clean_ticks(enriched, order=("timestamp", "event_id")))


# ---- J2 + S12: tickers -> symbol map -> market payload (all derived from events).
# "error" events are not a traded instrument, so they get no coin mapping and
# show the keep-unmatched behaviour of the lookup.
MAP_SQL = """SELECT DISTINCT event_type AS symbol, upper(event_type) || '_COIN' AS coin_id
FROM events WHERE event_type <> 'error'"""
MARKET_SQL = f"""WITH last_day AS (SELECT * FROM ({Q.TICKS}) AS t
  WHERE CAST(watermark_time AS DATE) = {Q.AS_OF_DATE})
SELECT upper(symbol) || '_COIN' AS coin_id, sum(price * volume) AS usd_market_cap,
  sum(volume) AS usd_24h_vol,
  (arg_max(price, watermark_time) - arg_min(price, watermark_time))
    / NULLIF(arg_min(price, watermark_time), 0) * 100 AS usd_24h_change
FROM last_day GROUP BY symbol"""


def _market_payload(spark, d):
    t = ticks(spark, d)
    last = t.filter(F.to_date("watermark_time") == t.select(F.max(F.to_date("watermark_time"))).scalar())
    per = last.groupBy("symbol").agg(
        F.sum(F.col("price") * F.col("volume")).alias("usd_market_cap"),
        F.sum("volume").alias("usd_24h_vol"),
        ((F.max_by("price", "watermark_time") - F.min_by("price", "watermark_time"))
         / F.min_by("price", "watermark_time") * 100).alias("usd_24h_change"))
    # Landed payload rows: JSON objects keyed by coin id (one per coin here).
    return per.select(F.to_json(F.create_map(
        F.concat(F.upper("symbol"), F.lit("_COIN")),
        F.struct("usd_market_cap", "usd_24h_vol", "usd_24h_change"))).alias("value"))


@register("enrich_lookup", f"""SELECT t.*, m.usd_market_cap AS market_cap, m.usd_24h_vol AS volume_24h_usd,
  m.usd_24h_change AS price_change_24h_cg
FROM ({Q.TICKS}) AS t LEFT JOIN ({MAP_SQL}) AS s ON t.symbol = s.symbol
LEFT JOIN ({MARKET_SQL}) AS m ON s.coin_id = m.coin_id""",
          ("price", "volume", "market_cap", "volume_24h_usd", "price_change_24h_cg"))
def enrich_lookup(spark, d):
    ev = events(spark, d)
    smap = (ev.filter(F.col("event_type") != "error")
              .select(F.col("event_type").alias("symbol"),
                      F.concat(F.upper("event_type"), F.lit("_COIN")).alias("coin_id")).distinct())
    market = G.market_entries(_market_payload(spark, d))
    return rounded(G.enrich_tickers(ticks(spark, d), smap, market))


@register("bus_envelope", f"""SELECT symbol AS "key",
  CAST(to_json({{'symbol': symbol, 'trade_id': trade_id, 'price': price, 'quantity': quantity,
                 'buyer_order_id': buyer}}) AS VARCHAR) AS value,
  symbol AS attr_symbol, 'unknown' AS attr_source, 'trade' AS attr_event_type
FROM (SELECT *, CASE WHEN trade_id % 3 <> 0 THEN trade_id END AS buyer FROM ({Q.TRADES}) AS t0) AS t""")
def bus_envelope(spark, d):
    """Every third record has no buyer: its field stays in the message as null."""
    t = trades(spark, d).select("symbol", "trade_id", "price", "quantity",
                                F.when(F.col("trade_id") % 3 != 0, F.col("trade_id")).alias("buyer_order_id"))
    env = G.bus_envelope(t)
    return env.select("key", "value", F.col("attributes")["symbol"].alias("attr_symbol"),
                      F.col("attributes")["source"].alias("attr_source"),
                      F.col("attributes")["event_type"].alias("attr_event_type"))
