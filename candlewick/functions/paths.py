"""Landed-file path helpers (S7 layout, S9 filter, S10 symbol, F10-F12 start time)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlewick.schema import LANDING_PATTERN, LANDING_ROOT


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def landing_path(symbol: Column | str, start_ms: Column | str) -> Column:
    """``{root}/{sym}/{yyyy}/M{mm}/{sym}_{root}_{yyyy-MM-dd-HHmm}.parquet`` with
    ``root`` = :data:`candlewick.schema.LANDING_ROOT`.

    The page start is read as UTC and truncated to the minute.
    """
    sym, ts = _col(symbol), F.timestamp_millis(_col(start_ms).cast("bigint"))
    return F.concat(
        F.lit(LANDING_ROOT + "/"), sym, F.lit("/"),
        F.date_format(ts, "yyyy/'M'MM"), F.lit("/"),
        sym, F.lit(f"_{LANDING_ROOT}_"), F.date_format(ts, "yyyy-MM-dd-HHmm"),
        F.lit(".parquet"),
    )


def matches_landing(path: Column | str, ignore_case: bool = False) -> Column:
    """The path ends in a well-formed landed file name (unanchored start)."""
    return _col(path).rlike(("(?i)" if ignore_case else "") + LANDING_PATTERN)


def symbol_from_path(path: Column | str, strict: bool = True) -> Column:
    """Symbol directory of a landed path; raises on a path that does not match
    (``strict=False`` gives null instead)."""
    p = _col(path)
    sym = F.regexp_extract(p, LANDING_PATTERN.rstrip("$"), 1)
    fail = (F.raise_error(F.concat(F.lit("cannot extract a symbol from path: "), p))
            if strict else F.lit(None))
    return F.when(sym == "", fail).otherwise(sym)


def path_start_ms(path: Column | str) -> Column:
    """page start encoded in a landed file name, as epoch ms (UTC).

    Null for paths that do not match the layout.
    """
    p = _col(path)
    parts = [F.regexp_extract(p, LANDING_PATTERN, i) for i in range(2, 7)]
    stamp = F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2], F.lit("-"),
                     parts[3], parts[4])
    return F.when(p.rlike(LANDING_PATTERN),
                  F.unix_millis(F.to_timestamp(stamp, "yyyy-MM-dd-HHmm")))
