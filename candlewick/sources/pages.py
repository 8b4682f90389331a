"""Candle pages.

A page is what one exchange request returns: a JSON array of up to ``limit``
positional 12-element arrays (times and trade counts as numbers, prices and
volumes as strings, the last element unused). The HTTP fetch itself is not
rebuilt (see README); pages arrive as rows ``(symbol, page, body)`` of
already-landed JSON, e.g. ``spark.read.json``/``text`` output.

Everything page-level is a projection on the page row -- the page's length is
the array's size, its start the first element's open time -- so the
complete-page rule and the file naming need no shuffle; only the cursor
(S14) aggregates, per page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.paths import landing_path
from candlewick.schema import LANDED_SCHEMA, NUMERIC_FIELDS, PAGE_FIELDS

PAGE_JSON_TYPE = "array<array<string>>"
INTEGER_FIELDS = ["open_time", "close_time", "number_of_trades"]


def page_rows(body: Column | str) -> Column:
    """The page body parsed to ``array<array<string>>`` (fails on malformed JSON)."""
    b = F.col(body) if isinstance(body, str) else body
    return F.from_json(b, PAGE_JSON_TYPE, {"mode": "FAILFAST"})


def open_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """``pages`` with ``rows``, the parsed body, instead of ``body``. The parse sits in a generator, so
    whatever reads ``rows`` -- filters on the size, the start, the explode -- reads one parse per page."""
    keep = [c for c in pages.columns if c != body]
    return pages.select(*keep, F.inline(F.array(F.struct(page_rows(body).alias("rows")))))


def page_size(body: Column | str = "body") -> Column:
    """Candles in the page, as a bigint count (like ``count(*)``)."""
    return F.size(page_rows(body)).cast("bigint")


def keep_full_pages(pages: DataFrame, limit: int, body: str = "body") -> DataFrame:
    """Keep only pages holding ``limit`` candles or more. A short page is the
    newest, still-open stretch; it is not landed (T9)."""
    return pages.where(page_size(body) >= limit)


def page_start(body: Column | str = "body") -> Column:
    """Open time (epoch ms) of the page's first candle -- positional first."""
    return page_rows(body)[0][0].cast("bigint")


def with_landing_path(pages: DataFrame, symbol: str = "symbol", body: str = "body") -> DataFrame:
    """S6 + S7: page start and the landed file name it determines."""
    return pages.withColumn("page_start", page_start(body)) \
        .withColumn("source_file", landing_path(F.col(symbol), F.col("page_start")))


def _field_type(name: str) -> str:
    assert name in INTEGER_FIELDS or name in NUMERIC_FIELDS
    return "bigint" if name in INTEGER_FIELDS else "double"


def parse_kline_pages(pages: DataFrame, body: str = "body", lenient: bool = False,
                      limit: int | None = None) -> DataFrame:
    """One row per candle with the 11 named, typed landed columns.

    Keeps the page's other columns and the candle's position ``pos`` in the
    page. ``_unused`` is dropped (S2). Numbers are cast under ANSI rules, so a
    malformed value raises (S3); ``lenient=True`` gives null instead. An empty
    page yields no row (S4). With ``limit``, short pages are dropped first (S5).
    """
    return candles_of(open_pages(pages, body), lenient, limit)


def candles_of(opened: DataFrame, lenient: bool = False, limit: int | None = None) -> DataFrame:
    """:func:`parse_kline_pages` of pages that :func:`open_pages` has parsed."""
    if limit is not None:
        opened = opened.where(F.size("rows") >= limit)
    keep = [c for c in opened.columns if c != "rows"]
    exploded = opened.select(*keep, F.posexplode("rows").alias("pos", "_row"))
    cast = (lambda c, t: c.try_cast(t)) if lenient else (lambda c, t: c.cast(t))
    fields = [cast(F.col("_row")[i], _field_type(name)).alias(name)
              for i, name in enumerate(PAGE_FIELDS) if name != "_unused"]
    out = exploded.select(*keep, "pos", *fields)
    return out.select(*keep, "pos", *[F.col(f.name).cast(f.dataType) for f in LANDED_SCHEMA])


def parse_with_rejects(pages: DataFrame, body: str = "body") -> DataFrame:
    """S3 for pages that may hold malformed numbers: one row per candle like
    :func:`parse_kline_pages`, bad values as null, and ``rejects``, the (column, value) pairs that are
    no number. A missing value (JSON null) is not a reject."""
    return rejects_of(open_pages(pages, body))


def rejects_of(opened: DataFrame) -> DataFrame:
    """:func:`parse_with_rejects` of pages that :func:`open_pages` has parsed."""
    keep = [c for c in opened.columns if c != "rows"]
    exploded = opened.select(*keep, F.posexplode("rows").alias("pos", "_row"))
    numbers, bad = [], []
    for i, name in enumerate(PAGE_FIELDS):
        if name == "_unused":
            continue
        raw = F.col("_row")[i]
        number = raw.try_cast(_field_type(name))
        numbers.append(number.alias(name))
        bad.append(F.when(raw.isNotNull() & number.isNull(),
                          F.struct(F.lit(name).alias("column"), raw.alias("value"))))
    return exploded.select(*keep, "pos", *numbers, F.array_compact(F.array(*bad)).alias("rejects"))


def good_candles(parsed: DataFrame) -> DataFrame:
    """Candles without a bad value, of :func:`parse_with_rejects`."""
    return parsed.where(F.size("rejects") == 0).drop("rejects")


def rejected_values(parsed: DataFrame) -> DataFrame:
    """One row per bad value of :func:`parse_with_rejects`: the page's columns, ``pos``, ``column``, ``value``."""
    names = [f.name for f in LANDED_SCHEMA]
    keep = [c for c in parsed.columns if c not in names and c != "rejects"]
    return parsed.select(*keep, F.explode("rejects").alias("_r")).select(*keep, "_r.column", "_r.value")


def next_cursor(parsed: DataFrame, now_ms: int, keys=("symbol", "page")) -> DataFrame:
    """The next request start per page, ``max(close_time) + 1``; pages with no
    close time, or whose next start is not before ``now_ms``, end extraction."""
    nxt = F.max("close_time") + 1
    return parsed.groupBy(*keys).agg(nxt.alias("next_start")) \
        .where(F.col("next_start").isNotNull() & (F.col("next_start") < F.lit(now_ms)))


def _json_number(c: str) -> Column:
    return F.col(c).cast("string")


def _json_string(c: str) -> Column:
    return F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"'))


def candle_json(unused: str = "0") -> Column:
    """One landed candle as the exchange's positional JSON array."""
    parts = []
    for name in PAGE_FIELDS:
        if name == "_unused":
            parts.append(F.lit(f'"{unused}"'))
        elif name in INTEGER_FIELDS:
            parts.append(_json_number(name))
        else:
            parts.append(_json_string(name))
    return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))


def pages_from_candles(candles: DataFrame, limit: int) -> DataFrame:
    """Test-data adapter: cut each symbol's candles, in time order, into pages of
    ``limit`` rows (the last one usually short) as the exchange would serve
    them. Row numbers come from the sliced numbering, so no symbol's history
    lands in one task; each page group holds at most ``limit`` rows."""
    from candlewick.functions.time import fill_timestamps
    from candlewick.operators.sliced import number_rows

    cols = [f.name for f in LANDED_SCHEMA]
    numbered = number_rows(fill_timestamps(candles), carry=tuple(cols))
    items = numbered.select(
        "symbol",
        F.floor((F.col("row_num") - 1) / limit).cast("int").alias("page"),
        F.struct(F.col("row_num"), candle_json().alias("item")).alias("e"),
    )
    return items.groupBy("symbol", "page").agg(
        F.concat(F.lit("["),
                 F.concat_ws(",", F.transform(F.array_sort(F.collect_list("e")),
                                              lambda e: e["item"])),
                 F.lit("]")).alias("body"))
