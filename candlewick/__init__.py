"""candlewick: candlestick (kline) market analytics as Spark DataFrame jobs.

Landed candle pages -> incremental, ledgered raw table -> staging ->
five analytics models -> one-pass not-null checks. See README.md.
"""

from candlewick.operators.daily import market_liquidity, market_summary, market_volatility
from candlewick.operators.quality import assert_checks, run_checks
from candlewick.operators.series import market_returns, market_trend
from candlewick.operators.staging import consolidated_klines, stage_klines
from candlewick.plans.load import load_incremental
from candlewick.plans.pipeline import run_pipeline
from candlewick.session import build_session, ensure_utc
from candlewick.sinks.models import read_model
from candlewick.sources.pages import keep_full_pages, parse_kline_pages
from candlewick.sources.raw import read_raw
from candlewick.streaming.incremental import stream_to_raw

__all__ = [
    "assert_checks", "build_session", "consolidated_klines", "ensure_utc", "keep_full_pages",
    "load_incremental", "market_liquidity", "market_returns", "market_summary", "market_trend",
    "market_volatility", "parse_kline_pages", "read_model", "read_raw", "run_checks", "run_pipeline",
    "stage_klines", "stream_to_raw",
]
