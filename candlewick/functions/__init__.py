"""Column expressions (scalar functions F1-F13 and the path helpers S7, S10)."""

from candlewick.functions.arith import nullif, safe_divide
from candlewick.functions.paths import (
    landing_path,
    matches_landing,
    path_start_ms,
    symbol_from_path,
)
from candlewick.functions.time import fill_timestamps, trade_date, ts_from_millis

__all__ = [
    "fill_timestamps", "landing_path", "matches_landing", "nullif", "path_start_ms",
    "safe_divide", "symbol_from_path", "trade_date", "ts_from_millis",
]
