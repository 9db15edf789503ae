"""Record and table schemas (Spark StructTypes)."""

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
TS, DT = T.TimestampType(), T.DateType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw exchange trade message (single-letter keys as sent by the exchange).
RAW_TRADE = _struct(("e", S), ("E", L), ("s", S), ("t", L), ("p", S), ("q", S),
                    ("b", L), ("a", L), ("T", L), ("m", B))

# Message-bus envelope: payload bytes, string attributes, publish time.
ENVELOPE = _struct(("data", T.BinaryType()), ("attributes", T.MapType(S, S)),
                   ("publish_time", TS))

# Canonical trade event (12 fields; epoch fields are milliseconds).
TRADE = _struct(("event_type", S), ("event_time", L), ("symbol", S), ("trade_id", L),
                ("price", D), ("quantity", D), ("buyer_order_id", L),
                ("seller_order_id", L), ("trade_time", L), ("is_buyer_maker", B),
                ("ingestion_time", S), ("source", S))

# Ticker snapshot event (timestamp is epoch seconds).
TICKER = _struct(("symbol", S), ("price", D), ("volume", D), ("high_24h", D),
                 ("low_24h", D), ("price_change_24h", D),
                 ("price_change_percent_24h", D), ("trade_count", I),
                 ("timestamp", L), ("source", S), ("market_cap", D),
                 ("volume_24h_usd", D), ("event_time", S), ("partition_date", S),
                 ("partition_hour", S))

# Exchange ticker payload element (numerics arrive as strings).
TICKER_PAYLOAD = _struct(("symbol", S), ("lastPrice", S), ("volume", S),
                         ("highPrice", S), ("lowPrice", S), ("priceChange", S),
                         ("priceChangePercent", S), ("count", L))

MARKET_ENTRY = _struct(("usd_market_cap", D), ("usd_24h_vol", D), ("usd_24h_change", D))
MARKET_PAYLOAD = T.MapType(S, MARKET_ENTRY)

SYMBOL_MAP = _struct(("symbol", S), ("coin_id", S))

HOURLY_AGGREGATES = _struct(
    ("symbol", S), ("hour_timestamp", T.TimestampNTZType()), ("open_price", D),
    ("high_price", D), ("low_price", D), ("close_price", D), ("total_volume", D),
    ("total_trades", L), ("total_value_usd", D), ("avg_trade_size", D),
    ("buy_volume", D), ("sell_volume", D), ("vwap", D),
    ("aggregation_time", TS))

DAILY_AGGREGATES = _struct(
    ("symbol", S), ("trade_date", DT), ("open_price", D), ("high_price", D),
    ("low_price", D), ("close_price", D), ("total_volume", D), ("total_trades", L),
    ("total_value_usd", D), ("avg_hourly_volume", D), ("max_hourly_volume", D),
    ("price_change", D), ("price_change_pct", D), ("aggregation_time", TS))

DLQ = _struct(("raw_data", S), ("validation_error", S), ("processing_time", TS),
              ("source", S))

SCHEMA_HISTORY = _struct(("table_id", S), ("version_hash", S), ("fields_added", S),
                         ("change_time", TS))

SCHEMA_REGISTRY = _struct(("subject", S), ("version_id", S), ("schema_hash", S),
                          ("schema_definition", S), ("compatibility_mode", S),
                          ("is_active", B), ("created_at", TS), ("created_by", S),
                          ("description", S))
