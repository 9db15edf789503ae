"""Fixed values.

Values the results depend on, equal to the behaviour being reproduced. They
are stated here once, in plain form; operators take them as parameter
defaults.
"""

# --- fixed values: technical indicators -------------------------------------
SMA_WINDOW = 20                 # also volatility, Bollinger and z-score frames
RSI_WINDOW = 14
MACD_FAST = 12
MACD_SLOW = 26
MACD_SIGNAL = 9
BOLLINGER_STD = 2.0
ANOMALY_Z = 2.5
ANOMALY_TYPES = ("price_spike", "price_drop", "normal")

# --- fixed values: signals ----------------------------------------------------
RSI_OVERSOLD = 30
RSI_OVERBOUGHT = 70
SIGNALS = ("BUY", "SELL", "HOLD")
COMBINED_SIGNALS = ("STRONG_BUY", "STRONG_SELL", "BUY", "SELL", "HOLD")
TRADING_SIGNALS = ("BUY_SIGNAL", "SELL_SIGNAL", "HOLD")

# --- fixed values: ingest and validation --------------------------------------
TRADE_REQUIREMENTS = (("symbol", "present"), ("price", "positive"), ("quantity", "positive"),
                      ("trade_id", "present"))
NAMED_FIELDS = ("symbol", "price", "quantity")      # labelled missing_* / invalid_*
OTHER_ERROR = "unknown_error"
PIPELINE_VERSION = "1.0.0"
TRADE_SOURCE = "binance"
RAW_TRADE_DEFAULTS = {"event_type": "trade", "symbol": "", "is_buyer_maker": False}
BUS_ATTRIBUTE_DEFAULTS = {"symbol": "UNKNOWN", "source": "unknown", "event_type": "trade"}
QUALITY_LEVELS = ((("rsi", "macd_line"), 100), (("price", "volume"), 80))
QUALITY_LEAST = 60

# --- fixed values: windows, look-backs, retention -----------------------------
MARKET_WINDOW = "5 minutes"
WATERMARK_DELAY = "10 minutes"
KV_TTL_SECONDS = 86400
METRICS_WINDOW_SECONDS = 300
LATEST_HOURS = 24
LEADERS_HOURS = 24
LEADERS_TOP_N = 10
DASHBOARD_DAYS = 7
PERFORMANCE_DAYS = 30
RETURNS_DAYS = 90
CORRELATION_MIN_DAYS = 30
ANOMALY_SUMMARY_DAYS = 7
DQ_HOURS = 1
SCHEDULED_LOOKBACK_HOURS = 2
RETENTION_DAYS = 90

# --- fixed values: storage layout ----------------------------------------------
PARQUET_COMPRESSION = "snappy"
PARQUET_BLOCK_BYTES = 128 * 1024 * 1024
PARQUET_PAGE_BYTES = 1024 * 1024

# --- fixed values: schema tooling ----------------------------------------------
TYPE_PRECEDENCE = ("RECORD", "REPEATED", "FLOAT64", "INTEGER", "BOOLEAN", "TIMESTAMP", "DATE",
                   "STRING")
COMPATIBILITY_MODES = ("backward", "forward", "full", "none")
VERSION_FORMAT = "v-%04d"
HISTORY_HASH_CHARS = 12
REGISTRY_CREATED_BY = "pipeline"

# --- fixed values: alert rules ----------------------------------------------------
ANOMALY_RATE_LIMIT = 10.0
MIN_RECORDS = 1
SUSTAIN_MINUTES = 5
