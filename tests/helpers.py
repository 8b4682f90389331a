import datetime as dt

from candlewick.schema import STAGING_COLUMNS

UTC = dt.timezone.utc


def ts(s):
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M").replace(tzinfo=UTC)


def klines_df(spark, rows):
    """rows: (symbol, 'YYYY-MM-DD HH:MM', open, high, low, close, volume, quote, trades)."""
    data = []
    for sym, t, o, h, lo, c, v, q, n in rows:
        start = ts(t)
        data.append((start, start + dt.timedelta(seconds=59.999), o, h, lo, c, v, q, n,
                     v / 2 if v is not None else None, q / 2 if q is not None else None, sym))
    schema = ("open_time_ts timestamp, close_time_ts timestamp, open_price double, "
              "high_price double, low_price double, close_price double, volume double, "
              "quote_asset_volume double, number_of_trades bigint, "
              "taker_buy_base_asset_volume double, taker_buy_quote_asset_volume double, "
              "symbol string")
    df = spark.createDataFrame(data, schema)
    assert df.columns == STAGING_COLUMNS
    return df


def rounded(rows, digits=6):
    out = []
    for r in rows:
        out.append(tuple(round(v, digits) if isinstance(v, float) else v for v in r))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


K1 = [
    ("AAA", "2024-01-01 00:00", 10.0, 12.0, 9.0, 11.0, 1.0, 11.0, 2),
    ("AAA", "2024-01-01 00:01", 11.0, 15.0, 10.0, 14.0, 2.0, 28.0, 3),
    ("AAA", "2024-01-02 00:00", 14.0, 14.0, 7.0, 7.0, 4.0, 28.0, 0),
    ("BBB", "2024-01-01 00:00", 5.0, 6.0, 5.0, 0.0, 1.0, 5.0, 0),
    ("BBB", "2024-01-01 00:01", 0.0, 8.0, 4.0, 8.0, 1.0, 8.0, 0),
]
