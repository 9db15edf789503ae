"""Ingest: parse, normalise, enrich and envelope records (P1-P4, P8-P10, J2,
S11, S12, K18). Pure column expressions; nothing leaves the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed as FX
from .. import schemas as SC
from ..functions.columns import bind_once, epoch_ms_to_ts
from ..session import materialize

PIPELINE_VERSION = FX.PIPELINE_VERSION


def _ts_or_now(value) -> Column:
    if value is None:
        return F.current_timestamp()
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def parse_envelopes(envelopes: DataFrame, schema=SC.TRADE, payload: str = "data") -> DataFrame:
    """Payload bytes -> typed struct ``parsed`` (malformed JSON -> all-NULL
    struct), keeping attributes and publish_time."""
    env = envelopes.select(F.col(payload), "attributes", "publish_time")
    return bind_once(env, parsed=F.from_json(F.col(payload).cast("string"), schema)).drop(payload)


def flatten_trades(parsed: DataFrame, truncate_to_second: bool = False) -> DataFrame:
    """P2 + P3: ``parsed.*`` plus pubsub_publish_time, event_timestamp and
    trade_timestamp from epoch milliseconds (milliseconds kept unless
    ``truncate_to_second``)."""
    return parsed.select(
        "parsed.*",
        F.col("publish_time").alias("pubsub_publish_time"),
        epoch_ms_to_ts(F.col("parsed.event_time"), truncate_to_second).alias("event_timestamp"),
        epoch_ms_to_ts(F.col("parsed.trade_time"), truncate_to_second).alias("trade_timestamp"))


def transform_trades(df: DataFrame, processing_time=None,
                     pipeline_version: str = PIPELINE_VERSION) -> DataFrame:
    """trade_value_usd, trade_date, trade_hour, processing_time, pipeline_version."""
    return df.withColumns({
        "trade_value_usd": F.col("price") * F.col("quantity"),
        "trade_date": F.to_date("trade_timestamp"),
        "trade_hour": F.hour("trade_timestamp").cast("long"),
        "processing_time": _ts_or_now(processing_time),
        "pipeline_version": F.lit(pipeline_version),
    })


def normalize_raw_trades(raw: DataFrame, col: str = "value", ingestion_time=None,
                         source: str = FX.TRADE_SOURCE, now_ms=None,
                         missing_price_as_zero: bool = False) -> DataFrame:
    """Raw exchange JSON (keys e,E,s,t,p,q,b,a,T,m) -> canonical trade.

    The keys differ only by case (e/E, t/T), so the message is read as a
    case-sensitive map<string,string> and each value cast. Defaults: event_type
    "trade", event_time now (ms), symbol "" and upper-cased, is_buyer_maker
    false. A missing price/quantity stays NULL (the validator labels it
    missing_*); ``missing_price_as_zero`` restores the zero default."""
    m = F.from_json(F.col(col), "map<string,string>")
    now = now_ms if now_ms is not None else F.unix_millis(F.current_timestamp())
    now = now if isinstance(now, Column) else F.lit(now).cast("long")
    k = lambda key: F.col("m")[key]
    num = (lambda key: F.coalesce(k(key).try_cast("double"), F.lit(0.0))) if missing_price_as_zero \
        else (lambda key: k(key).try_cast("double"))
    ing = F.date_format(_ts_or_now(ingestion_time), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return bind_once(raw.select(col), m=m).select(
        F.coalesce(k("e"), F.lit(FX.RAW_TRADE_DEFAULTS["event_type"])).alias("event_type"),
        F.coalesce(k("E").try_cast("long"), now).alias("event_time"),
        F.upper(F.coalesce(k("s"), F.lit(FX.RAW_TRADE_DEFAULTS["symbol"]))).alias("symbol"),
        k("t").try_cast("long").alias("trade_id"),
        num("p").alias("price"),
        num("q").alias("quantity"),
        k("b").try_cast("long").alias("buyer_order_id"),
        k("a").try_cast("long").alias("seller_order_id"),
        k("T").try_cast("long").alias("trade_time"),
        F.coalesce(k("m").try_cast("boolean"), F.lit(FX.RAW_TRADE_DEFAULTS["is_buyer_maker"])).alias("is_buyer_maker"),
        ing.alias("ingestion_time"),
        F.lit(source).alias("source"))


def bus_envelope(df: DataFrame, key: str = "symbol") -> DataFrame:
    """Record -> (key, value JSON bytes, attributes map) for a message bus. NULL fields
    are written as null; missing attributes take their defaults."""
    def attr(c, default):
        return F.coalesce(F.col(c).cast("string"), F.lit(default)) if c in df.columns else F.lit(default)
    attributes = [x for c, default in FX.BUS_ATTRIBUTE_DEFAULTS.items() for x in (F.lit(c), attr(c, default))]
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}).alias("value"),
        F.create_map(*attributes).alias("attributes"))


# ---------------------------------------------------------------- ticker path

def read_ticker_payload(spark, path: str) -> DataFrame:
    """Landed JSON arrays of exchange tickers (string numerics)."""
    return spark.read.schema(SC.TICKER_PAYLOAD).option("multiLine", True).json(path)


def normalize_tickers(payload: DataFrame, timestamp=None, source: str = FX.TRADE_SOURCE,
                      symbols=None) -> DataFrame:
    """P9 (+P13): rename and cast ticker fields; optional symbol subset."""
    df = payload if not symbols else payload.filter(F.col("symbol").isin(list(symbols)))
    ts = timestamp if isinstance(timestamp, Column) else (
        F.unix_seconds(F.current_timestamp()) if timestamp is None else F.lit(int(timestamp)))
    d = lambda c: F.col(c).try_cast("double")
    return df.select("symbol", d("lastPrice").alias("price"), d("volume").alias("volume"),
                     d("highPrice").alias("high_24h"), d("lowPrice").alias("low_24h"),
                     d("priceChange").alias("price_change_24h"),
                     d("priceChangePercent").alias("price_change_percent_24h"),
                     F.col("count").cast("int").alias("trade_count"),
                     ts.cast("long").alias("timestamp"), F.lit(source).alias("source"))


def market_entries(payload: DataFrame, col: str = "value") -> DataFrame:
    """JSON object keyed by coin id -> one row per coin."""
    m = F.from_json(F.col(col), SC.MARKET_PAYLOAD)
    return (payload.select(F.explode(m).alias("coin_id", "m"))
                   .select("coin_id", "m.usd_market_cap", "m.usd_24h_vol", "m.usd_24h_change"))


def enrich_tickers(tickers: DataFrame, symbol_map: DataFrame, market: DataFrame,
                   lookup_rows: int = 200_000) -> DataFrame:
    """Two-step left lookup symbol -> coin_id -> market figures; tickers
    without a mapping or market row are kept with NULL market columns.
    A lookup of up to ``lookup_rows`` rows, counted, is sent to every task and the
    tickers are not shuffled; a larger one is joined by shuffle."""
    def side(df):
        df = materialize(df, "lookup")
        return F.broadcast(df) if df.count() <= lookup_rows else df
    mk = market.select("coin_id", F.col("usd_market_cap").alias("market_cap"),
                       F.col("usd_24h_vol").alias("volume_24h_usd"),
                       F.col("usd_24h_change").alias("price_change_24h_cg"))
    # both steps meet on the small sides: one row per mapped symbol
    by_symbol = symbol_map.select("symbol", "coin_id").join(mk, "coin_id", "left").drop("coin_id")
    return tickers.join(side(by_symbol), "symbol", "left")


def ingest_time_columns(df: DataFrame, now=None) -> DataFrame:
    """P10: event_time (ISO), partition_date (yyyy-MM-dd), partition_hour (HH)."""
    t = _ts_or_now(now)
    return df.withColumns({
        "event_time": F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        "partition_date": F.date_format(t, "yyyy-MM-dd"),
        "partition_hour": F.date_format(t, "HH"),
    })


def read_ticks_parsed(raw: DataFrame, col: str = "value") -> DataFrame:
    """S2 parse step: ticker JSON -> columns + processing_time + watermark_time."""
    return (bind_once(raw.select(col), d=F.from_json(F.col(col), SC.TICKER)).select("d.*")
               .withColumn("processing_time", F.current_timestamp())
               .withColumn("watermark_time", F.timestamp_seconds("timestamp")))
