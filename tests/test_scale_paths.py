"""Skew-safe evaluation gives exactly the plain results."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickforge.operators import indicators as I, signals as SG
from tickforge.operators import series as S
from tickforge.plans.common import TICK_SPEC, ticks

from paths import SF01

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "symbol string, id long, ts timestamp_ntz, price double, volume double"
SPEC = S.SeriesSpec(key="symbol", order=("ts", "id"))


def _hot_rows(n=3000):
    rows = [("HOT", i, T0 + dt.timedelta(seconds=30 * i), float(50 + (i * 13) % 17), 1.0) for i in range(n)]
    # a burst of the hot key at one instant, many short series, and one without a symbol
    rows += [("HOT", 9000 + i, T0 + dt.timedelta(hours=2), float(40 + (i * 7) % 11), 1.0) for i in range(n // 2)]
    rows += [(f"C{k}", 20_000 + k * 100 + j, T0 + dt.timedelta(hours=j), float(10 + j % 5), 1.0)
             for k in range(20) for j in range(40)]
    return rows + [(None, 90_000 + j, T0 + dt.timedelta(hours=j), float(10 + j % 7), 1.0) for j in range(300)]


@pytest.mark.parametrize("rows", [2_100, 150])
def test_pieces_equal_plain_windows(spark, rows):
    t = ticks(spark, SF01)
    plain = SG.indicators_with_signals(t, spec=TICK_SPEC)
    split = SG.indicators_with_signals(t, spec=TICK_SPEC.with_(piece_rows=rows))
    cols = plain.columns
    assert split.count() == plain.count()
    assert plain.select(cols).exceptAll(split.select(cols)).count() == 0


def test_pieces_smaller_than_the_look_back(spark):
    rows = [("S", i, T0 + dt.timedelta(hours=i), float(10 + (i * 7) % 13), 1.0) for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA)
    a = I.technical_indicators(df, spec=SPEC)
    b = I.technical_indicators(df, spec=SPEC.with_(piece_rows=2))     # halos span many pieces
    assert a.exceptAll(b.select(a.columns)).count() == 0


def _cut(df, spec):
    return S.cut(df.withColumn(S.ARRIVAL, F.monotonically_increasing_id()), df.count(), spec)


@pytest.mark.parametrize("shuffle", ["2", "8"])
def test_no_piece_is_above_the_limit(spark, shuffle):
    """Whatever the number of shuffle partitions and however the engine samples its range bounds."""
    df = spark.createDataFrame(_hot_rows(), SCHEMA)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shuffle)
    try:
        for limit in (7, 250, 1_000):
            sizes = [r["n"] for r in _cut(df, SPEC.with_(piece_rows=limit)).groupBy(S.PIECE).agg(F.count("*").alias("n")).collect()]
            assert max(sizes) <= limit and sum(sizes) == df.count() and len(sizes) <= 4 * len(_hot_rows()) / limit
        plain = I.technical_indicators(df, spec=SPEC)
        split = I.technical_indicators(df, spec=SPEC.with_(piece_rows=250))
        assert plain.exceptAll(split.select(plain.columns)).count() == 0 and split.count() == df.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_only_large_keys_are_cut(spark):
    df = spark.createDataFrame(_hot_rows(), SCHEMA)
    large = S.large_keys(df, SPEC.with_(piece_rows=299)).collect()
    assert {(r["_k"], r["_n"]) for r in large} == {("HOT", 4500), (None, 300)}
    assert S.large_keys(df, SPEC) is None
    plan = I.sma(df, spec=SPEC)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "parquet" not in plan


def test_pieces_are_removed_with_their_scope(spark):
    from tickforge.session import _SCRATCH, scratch_scope
    from tickforge.sinks.tables import _fs
    df = spark.createDataFrame(_hot_rows(), SCHEMA)
    with scratch_scope(spark) as scope:
        assert I.sma(df, spec=SPEC.with_(piece_rows=250)).count() == df.count()
        paths = _SCRATCH[id(spark.sparkContext)][scope.before:]
    assert len(paths) == 3 and not any(_fs(spark, p)[0].exists(_fs(spark, p)[1]) for p in paths)


def test_equal_instants_without_a_tie_break_are_cut(spark):
    rows = [("HOT", i, T0, float(i), 1.0) for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA)
    spec = SPEC.with_(order=("ts",), piece_rows=200)
    assert _cut(df, spec).groupBy(S.PIECE).count().filter("count > 200").count() == 0
    out = I.sma(df, window=3, spec=spec)
    assert out.count() == 2000 and out.filter("sma_3 is null").count() == 0


def test_only_series_over_several_pieces_have_halos(spark):
    pieces = _cut(spark.createDataFrame(_hot_rows(), SCHEMA), SPEC.with_(piece_rows=250))
    halo = S._halo(pieces, ["symbol", "id", "ts", "price", "volume"], SPEC, 10)
    assert halo.groupBy(S.PIECE).count().agg(F.max("count")).first()[0] <= 10


def test_recursive_ema_over_pieces(spark):
    df = spark.createDataFrame(_hot_rows(), SCHEMA)
    plain = {r["id"]: r["ema_3_exp"] for r in I.ema_recursive(df, window=3, spec=SPEC).collect()}
    split = {r["id"]: r["ema_3_exp"] for r in I.ema_recursive(df, window=3, spec=SPEC.with_(piece_rows=250)).collect()}
    assert plain.keys() == split.keys()
    assert max(abs(plain[k] - split[k]) for k in plain) < 1e-9


def test_indicators_over_a_look_back(spark):
    """Only as many days are read as the rarest key that trades near the cut-off needs; results from the cut-off on
    are those of the whole history."""
    from tickforge.session import scratch_path
    import uuid
    day0 = dt.date(2024, 1, 1)
    rows = [("BUSY", 1000 * d + i, T0 + dt.timedelta(days=d, minutes=10 * i), float(10 + (i * 7 + d) % 13), 1.0) for d in range(60) for i in range(50)]
    rows += [("SLOW", 100_000 + d, T0 + dt.timedelta(days=d), float(5 + d % 7), 1.0) for d in range(60)]
    rows += [("GONE", 200_000 + d, T0 + dt.timedelta(days=d), 1.0, 1.0) for d in range(3)]
    rows += [("NEW", 300_000 + i, T0 + dt.timedelta(days=58, minutes=i), float(i), 1.0) for i in range(5)]
    path = scratch_path(spark, f"t-since-{uuid.uuid4().hex}")
    spark.createDataFrame(rows, SCHEMA).withColumn("day", F.date_format("ts", "yyyy-MM-dd")).write.partitionBy("day").parquet(path)
    df = spark.read.schema(f"{SCHEMA}, day string").parquet(path)
    cutoff = day0 + dt.timedelta(days=55)
    # SLOW has a row a day: 4 rows before the cut-off lie in 4 days, 40 of them in 64; NEW has none at all
    four = df.filter("symbol != 'NEW'")
    assert S.history_start(four, cutoff, SPEC, 4, "day") == cutoff - dt.timedelta(days=4)
    near = S.since(four, cutoff, SPEC, 4, "day")
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and cutoff.replace(day=21).isoformat() in plan
    files = near.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r["f"].split("day=")[1][:10] for r in files} == {(cutoff + dt.timedelta(days=k)).isoformat() for k in range(-4, 5)}
    for table, lookback in ((four, 4), (df, 4), (df, 19)):
        whole = I.sma(table, window=lookback + 1, spec=SPEC).filter(F.col("day") >= cutoff.isoformat())
        part = I.sma(S.since(table, cutoff, SPEC, lookback, "day"), window=lookback + 1, spec=SPEC).filter(F.col("day") >= cutoff.isoformat())
        assert whole.count() == part.count() > 0 and whole.exceptAll(part.select(whole.columns)).count() == 0
    by_time = S.history_start(spark.createDataFrame(rows, SCHEMA), cutoff, SPEC, 4, "ts")
    assert by_time <= cutoff - dt.timedelta(days=4)


def test_blocked_correlation_equals_brute_force(spark):
    import numpy as np
    from tickforge.operators import analytics as A
    from tickforge.plans.common import bulk
    b = bulk(spark, SF01)
    ticks_like = b.select("symbol", "price", F.date_format("trade_timestamp", "yyyy-MM-dd").alias("partition_date"))
    rets = A.daily_returns(ticks_like, days=None)
    got = {(r[0], r[1]): (r[2], r[3]) for r in A.correlation_pairs(rets, min_days=3, block_size=16).collect()}
    pdf = rets.toPandas().pivot_table(index="partition_date", columns="symbol", values="daily_return")
    cols = sorted(pdf.columns)
    exp = {}
    for x, a in enumerate(cols):
        for c in cols[x + 1:]:
            both = pdf[[a, c]].dropna()
            if len(both) >= 3:
                exp[(a, c)] = (both[a].corr(both[c]), len(both))
    assert got.keys() == exp.keys() and len(exp) > 100
    for k, (cv, n) in exp.items():
        assert got[k][1] == n
        if np.isfinite(cv):
            assert abs(got[k][0] - cv) < 1e-8, (k, got[k], cv)


def test_recursive_ema_is_exact_over_pieces_and_missing_prices(spark):
    """A slow average (no halo would be long enough), with missing prices at the start, inside and over
    whole pieces, equals the definition row by row."""
    rng = np.random.default_rng(3)
    prices = rng.uniform(1, 9, 900)
    prices[:7] = np.nan
    prices[rng.integers(0, 900, 120)] = np.nan
    prices[300:460] = np.nan
    rows = [(k, i, None if np.isnan(p) else float(p)) for k in ("a", None) for i, p in enumerate(prices)]
    rows += [("b", 0, 2.0), ("b", 1, 4.0), ("c", 0, None)]
    df = spark.createDataFrame(rows, "symbol string, timestamp long, price double").repartition(5)
    want = pd.Series(prices).ewm(alpha=0.001, adjust=False).mean()
    for piece_rows in (50, 1_000_000):
        out = I.ema_recursive(df, alpha=0.001, spec=I.SeriesSpec(piece_rows=piece_rows))
        assert out.columns == ["symbol", "timestamp", "price", "ema_20_exp"]
        got = {(r[0], r[1]): r[3] for r in out.collect()}
        assert len(got) == len(rows)
        for k in ("a", None):
            mine = np.array([got[k, i] for i in range(900)], float)
            np.testing.assert_allclose(mine, want, rtol=1e-12)
        assert got["b", 1] == pytest.approx(2.0 * 0.999 + 4.0 * 0.001) and got["c", 0] is None
