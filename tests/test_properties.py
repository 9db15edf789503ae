"""Property tests (hypothesis, few examples each: every example is a Spark job)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tickforge.operators import indicators as I, quality as QL, rollups as R
from tickforge.operators.series import SeriesSpec

T0 = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

trade = st.tuples(st.sampled_from(["A", "B", "C"]),
                  st.integers(0, 72 * 60),                      # minute offset (3 days)
                  st.floats(0.01, 500, allow_nan=False),
                  st.sampled_from([0.0, 1.0, 2.5, 10.0]),
                  st.booleans())


def _trades(spark, rows):
    data = [(s, i, p, q, b, T0 + dt.timedelta(minutes=m)) for i, (s, m, p, q, b) in enumerate(rows)]
    return spark.createDataFrame(data, "symbol string, trade_id long, price double, quantity double,"
                                       " is_buyer_maker boolean, trade_timestamp timestamp_ntz") \
                .withColumn("trade_value_usd", F.col("price") * F.col("quantity"))


@SETTINGS
@given(st.lists(trade, min_size=1, max_size=80))
def test_ohlc_invariants(spark, rows):
    h = R.hourly_ohlcv(_trades(spark, rows)).collect()
    assert sum(r["total_trades"] for r in h) == len(rows)
    for r in h:
        assert r["low_price"] <= min(r["open_price"], r["close_price"])
        assert max(r["open_price"], r["close_price"]) <= r["high_price"]
        assert abs(r["buy_volume"] + r["sell_volume"] - r["total_volume"]) < 1e-9


@SETTINGS
@given(st.lists(trade, min_size=1, max_size=80))
def test_daily_of_hourly_equals_direct_daily(spark, rows):
    tr = _trades(spark, rows)
    via_hourly = {(r["symbol"], r["trade_date"]): r for r in R.daily_ohlcv(R.hourly_ohlcv(tr)).collect()}
    # direct: one "hour" per day by truncating timestamps to the day first
    direct = R.hourly_ohlcv(tr.withColumn("trade_timestamp", F.date_trunc("day", "trade_timestamp")
                                          .cast("timestamp_ntz"))).collect()
    assert len(via_hourly) == len(direct)
    for d in direct:
        v = via_hourly[(d["symbol"], d["hour_timestamp"].date())]
        assert v["total_trades"] == d["total_trades"]
        assert v["high_price"] == d["high_price"] and v["low_price"] == d["low_price"]
        assert abs(v["total_volume"] - d["total_volume"]) < 1e-6


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["A", "B"])),
                          st.one_of(st.none(), st.floats(-5, 5, allow_nan=False)),
                          st.one_of(st.none(), st.floats(-5, 5, allow_nan=False)),
                          st.one_of(st.none(), st.integers(0, 10))), min_size=1, max_size=40))
def test_valid_plus_invalid_is_input(spark, rows):
    df = spark.createDataFrame(rows, "symbol string, price double, quantity double, trade_id long")
    valid, invalid = QL.validate(df)
    assert valid.count() + invalid.count() == len(rows)
    assert invalid.filter(F.col("validation_error").isNull()).count() == 0


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 400), st.floats(1, 100, allow_nan=False)),
                min_size=2, max_size=120, unique_by=lambda x: x[0]),
       st.sampled_from([2, 5, 40]))
def test_halo_equals_plain_and_rsi_bounds(spark, pts, limit):
    rows = [("S", i, T0 + dt.timedelta(minutes=7 * m), p, 1.0) for i, (m, p) in enumerate(pts)]
    df = spark.createDataFrame(rows, "symbol string, id long, ts timestamp_ntz, price double, volume double")
    spec = SeriesSpec(key="symbol", order=("ts", "id"))
    plain = I.technical_indicators(df, spec=spec)
    halo = I.technical_indicators(df, spec=spec.with_(piece_rows=limit))
    assert plain.exceptAll(halo.select(plain.columns)).count() == 0
    rsi = [r["rsi"] for r in plain.select("rsi").collect() if r["rsi"] is not None]
    assert all(-1e-9 <= v <= 100 + 1e-9 for v in rsi)
