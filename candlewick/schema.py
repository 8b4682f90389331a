"""Fixed schemas and configuration defaults (S15, S16 and the landed layout)."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values that must equal the reference's for equal results -------
# Positional names of the 12 fields of one candle in an exchange page.
PAGE_FIELDS = [
    "open_time", "open_price", "high_price", "low_price", "close_price", "volume",
    "close_time", "quote_asset_volume", "number_of_trades",
    "taker_buy_base_asset_volume", "taker_buy_quote_asset_volume", "_unused",
]
# Columns converted from string to number after parsing a page.
NUMERIC_FIELDS = [
    "open_price", "high_price", "low_price", "close_price", "volume",
    "quote_asset_volume", "taker_buy_base_asset_volume", "taker_buy_quote_asset_volume",
]
# Default trading pairs, page size and history start (2020-01-01 00:00 UTC, epoch ms).
DEFAULT_SYMBOLS = ["BTCBRL", "ETHBRL", "SOLBRL"]
DEFAULT_LIMIT = 1000
DEFAULT_START_MS = 1577836800000
# Landed file layout and the pattern that recognises it (group 1 = symbol,
# groups 2-6 = year, month, day, hour, minute of the page start).
LANDING_ROOT = "binance_klines"
LANDING_PATTERN = (
    r"binance_klines/([A-Z0-9]+)/\d{4}/M\d{2}/[A-Z0-9]+_binance_klines_"
    r"(\d{4})-(\d{2})-(\d{2})-(\d{2})(\d{2})\.parquet$"
)
# --------------------------------------------------------------------------

LANDED_COLUMNS = [c for c in PAGE_FIELDS if c != "_unused"]

LANDED_SCHEMA = T.StructType([
    T.StructField("open_time", T.LongType()),
    T.StructField("open_price", T.DoubleType()),
    T.StructField("high_price", T.DoubleType()),
    T.StructField("low_price", T.DoubleType()),
    T.StructField("close_price", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("close_time", T.LongType()),
    T.StructField("quote_asset_volume", T.DoubleType()),
    T.StructField("number_of_trades", T.LongType()),
    T.StructField("taker_buy_base_asset_volume", T.DoubleType()),
    T.StructField("taker_buy_quote_asset_volume", T.DoubleType()),
])

# Raw table: landed columns + the two timestamps, plus our lineage columns.
# Partitioned on disk by load_id / symbol / date (see sources.raw).
RAW_SCHEMA = T.StructType(
    [
        T.StructField("open_time", T.LongType()),
        T.StructField("open_time_ts", T.TimestampType()),
        T.StructField("close_time", T.LongType()),
        T.StructField("close_time_ts", T.TimestampType()),
    ]
    + [f for f in LANDED_SCHEMA.fields if f.name not in ("open_time", "close_time")]
    + [
        T.StructField("source_file", T.StringType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("date", T.DateType()),
    ]
)
RAW_PARTITIONS = ["load_id", "symbol", "date"]

LEDGER_SCHEMA = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("loaded_at", T.TimestampType()),
    T.StructField("load_id", T.StringType()),
    T.StructField("event", T.StringType()),
    # calendar days of the file's candles, the null day included; null: not known
    T.StructField("days", T.ArrayType(T.StructType([T.StructField("date", T.DateType())]))),
    T.StructField("seq", T.LongType()),  # number of the commit
])
LOADED, REMOVED = "loaded", "removed"

# Staging / consolidated candle columns, in model order.
STAGING_COLUMNS = [
    "open_time_ts", "close_time_ts", "open_price", "high_price", "low_price",
    "close_price", "volume", "quote_asset_volume", "number_of_trades",
    "taker_buy_base_asset_volume", "taker_buy_quote_asset_volume", "symbol",
]
