"""Hand-made edge rows (FIXTURES.md section 4) with hand-computed outcomes."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F, types as T

from tickforge import schemas as SC
from tickforge.operators import (indicators as I, ingest as G, quality as QL, rollups as R,
                                 schema_ops as SO, signals as SG)
from tickforge.operators.series import SeriesSpec

SPEC = SeriesSpec(key="symbol", order=("ts", "id"))
T0 = dt.datetime(2024, 1, 1)


def series(spark, prices, symbol="S"):
    rows = [(symbol, i, T0 + dt.timedelta(minutes=i), float(p), 1.0) for i, p in enumerate(prices)]
    return spark.createDataFrame(rows, "symbol string, id long, ts timestamp_ntz, price double, volume double")


def last(df, col):
    return df.orderBy(F.col("id").desc()).first()[col]


# ---------------------------------------------------------------- validation

def trade_rows(spark, rows):
    return spark.createDataFrame(rows, "symbol string, trade_id long, price double, quantity double")


def test_error_labels_first_match_wins(spark):
    df = trade_rows(spark, [
        (None, 1, 10.0, 1.0),     # missing_symbol
        ("A", 2, None, 1.0),      # missing_price
        ("A", 3, 0.0, 1.0),       # invalid_price
        ("A", 4, -1.0, 1.0),      # invalid_price
        ("A", 5, 10.0, 0.0),      # invalid_quantity
        ("A", None, 10.0, 1.0),   # unknown_error
        (None, 7, -1.0, 1.0),     # missing_symbol (first match)
        ("A", 8, 10.0, 2.0),      # valid
    ])
    valid, invalid = QL.validate(df)
    assert valid.count() == 1
    got = {r["trade_id"]: r["validation_error"] for r in invalid.collect()}
    assert got == {1: "missing_symbol", 2: "missing_price", 3: "invalid_price", 4: "invalid_price",
                   5: "invalid_quantity", None: "unknown_error", 7: "missing_symbol"}
    assert valid.count() + invalid.count() == df.count()


def test_null_price_dropped_under_drop_policy(spark):
    df = trade_rows(spark, [("A", 1, None, 1.0), ("A", 2, 5.0, 1.0), ("A", 3, -1.0, 1.0)])
    valid, invalid = QL.validate(df, null_policy="drop")
    assert valid.count() == 1 and invalid.count() == 1   # the NULL-price row is in neither


def test_malformed_json_is_missing_symbol(spark):
    env = spark.createDataFrame([(bytearray(b"x{"), {}, T0)], SC.ENVELOPE)
    flat = G.transform_trades(G.flatten_trades(G.parse_envelopes(env)))
    _, invalid = QL.validate(flat)
    assert [r["validation_error"] for r in invalid.collect()] == ["missing_symbol"]


def test_dead_letter_shape(spark):
    df = trade_rows(spark, [("A", 5, 10.0, 0.0)])
    _, invalid = QL.validate(df)
    dlq = QL.dead_letter(invalid, source="trades").collect()[0]
    assert dlq["validation_error"] == "invalid_quantity"
    assert json.loads(dlq["raw_data"]) == {"symbol": "A", "trade_id": 5, "price": 10.0, "quantity": 0.0}


def test_epoch_millis_kept_or_truncated(spark):
    payload = json.dumps({"symbol": "A", "trade_id": 1, "price": 1.0, "quantity": 1.0,
                          "event_time": 1700000000999, "trade_time": 1700000000999})
    env = spark.createDataFrame([(bytearray(payload.encode()), {}, T0)], SC.ENVELOPE)
    keep = G.flatten_trades(G.parse_envelopes(env)).first()["trade_timestamp"]
    trunc = G.flatten_trades(G.parse_envelopes(env), truncate_to_second=True).first()["trade_timestamp"]
    assert keep.microsecond == 999000
    assert trunc.microsecond == 0 and trunc.second == 20


def test_raw_trade_defaults(spark):
    raw = spark.createDataFrame([('{"s": "btcusdt", "t": 7, "q": "2"}',)], "value string")
    r = G.normalize_raw_trades(raw, now_ms=123).first()
    assert (r["event_type"], r["event_time"], r["symbol"], r["is_buyer_maker"]) == ("trade", 123, "BTCUSDT", False)
    assert r["price"] is None and r["quantity"] == 2.0
    r0 = G.normalize_raw_trades(raw, now_ms=123, missing_price_as_zero=True).first()
    assert r0["price"] == 0.0


# ---------------------------------------------------------------- indicators

def test_single_row_series(spark):
    out = SG.indicators_with_signals(series(spark, [10.0]), spec=SPEC, price="price").first()
    assert out["price_stddev"] is None and out["z_score"] is None and out["is_anomaly"] is None
    assert out["anomaly_type"] == "normal" and out["rsi"] is None
    assert out["rsi_signal"] == "HOLD" and out["macd_signal_trade"] == "HOLD"
    assert out["combined_signal"] == "HOLD"


def test_constant_price(spark):
    out = I.technical_indicators(series(spark, [5.0] * 25), spec=SPEC)
    r = out.orderBy(F.col("id").desc()).first()
    assert r["price_stddev"] == 0.0 and r["z_score"] is None and r["rsi"] is None
    assert r["macd_line"] == 0.0


def test_rising_price_rsi_null(spark):
    out = I.rsi(series(spark, list(range(1, 21))), spec=SPEC)
    assert out.filter(F.col("rsi").isNotNull()).count() == 0


def test_spike_and_drop(spark):
    spike = I.price_anomalies(series(spark, [10.0] * 19 + [20.0]), spec=SPEC)
    r = spike.orderBy(F.col("id").desc()).first()
    assert r["anomaly_type"] == "price_spike" and r["is_anomaly"]
    assert r["z_score"] == pytest.approx(4.2485, abs=1e-3)
    drop = I.price_anomalies(series(spark, [10.0] * 19 + [0.5]), spec=SPEC)
    r = drop.orderBy(F.col("id").desc()).first()
    assert r["anomaly_type"] == "price_drop" and r["z_score"] == pytest.approx(-4.2485, abs=1e-3)


def test_rsi_bounds(spark):
    prices = [10, 11, 9, 12, 8, 13, 7, 14, 13, 12, 15, 11, 16, 10, 17]
    out = I.rsi(series(spark, prices), spec=SPEC).filter(F.col("rsi").isNotNull())
    vals = [r["rsi"] for r in out.collect()]
    assert vals and all(0 <= v <= 100 for v in vals)


def test_combined_buy_beats_sell(spark):
    df = spark.createDataFrame([("BUY", "SELL"), ("SELL", "SELL"), ("BUY", "BUY"), ("HOLD", "SELL")],
                               "rsi_signal string, macd_signal_trade string")
    got = [r["combined_signal"] for r in SG.generate_combined_signals(df).collect()]
    assert got == ["BUY", "STRONG_SELL", "STRONG_BUY", "SELL"]


def test_ema_recursive_matches_definition(spark):
    prices = [10.0, 12.0, 11.0, 15.0, 14.0, 13.0]
    out = I.ema_recursive(series(spark, prices), window=3, spec=SPEC)
    a, e = 0.5, prices[0]
    exp = []
    for p in prices:
        e = p if not exp else a * p + (1 - a) * e
        exp.append(e)
    got = [r["ema_3_exp"] for r in out.orderBy("id").collect()]
    assert got == pytest.approx(exp)


# ---------------------------------------------------------------- roll-ups / dedup

def _trades(spark, rows):
    return spark.createDataFrame(
        rows, "symbol string, trade_id long, price double, quantity double, is_buyer_maker boolean,"
              " trade_timestamp timestamp_ntz").withColumn("trade_value_usd", F.col("price") * F.col("quantity"))


def test_same_timestamp_open_close_by_tiebreak(spark):
    t = T0 + dt.timedelta(minutes=5)
    h = R.hourly_ohlcv(_trades(spark, [("A", 2, 20.0, 1.0, False, t), ("A", 1, 10.0, 1.0, True, t)])).first()
    assert (h["open_price"], h["close_price"]) == (10.0, 20.0)
    assert h["buy_volume"] + h["sell_volume"] == h["total_volume"]


def test_zero_quantity_hour_vwap_null(spark):
    h = R.hourly_ohlcv(_trades(spark, [("A", 1, 10.0, 0.0, False, T0)])).first()
    assert h["vwap"] is None


def test_half_open_range_and_default_end(spark):
    rows = [("A", i, 10.0 + i, 1.0, False, T0 + dt.timedelta(minutes=30 * i)) for i in range(5)]
    h = R.hourly_ohlcv(_trades(spark, rows), start=T0 + dt.timedelta(hours=1))
    assert [r["total_trades"] for r in h.collect()] == [2]


def test_daily_of_hourly_equals_direct(spark):
    rows = [("A", i, 10.0 + (i % 7), 1.0 + i % 3, i % 2 == 0, T0 + dt.timedelta(minutes=17 * i))
            for i in range(200)]
    tr = _trades(spark, rows)
    d = R.daily_ohlcv(R.hourly_ohlcv(tr)).orderBy("trade_date").collect()
    for r in d:
        day = [x for x in rows if x[5].date() == r["trade_date"]]
        assert r["open_price"] == min(day, key=lambda x: (x[5], x[1]))[2]
        assert r["close_price"] == max(day, key=lambda x: (x[5], x[1]))[2]
        assert r["total_trades"] == len(day)
        assert r["low_price"] <= min(r["open_price"], r["close_price"]) <= r["high_price"]


def test_duplicate_symbol_timestamp_kept_once(spark):
    df = spark.createDataFrame([("A", 100, 5, 1.0, 1.0), ("A", 100, 3, 2.0, 1.0)],
                               "symbol string, timestamp long, event_id long, price double, volume double")
    out = QL.clean_ticks(df, order=("timestamp", "event_id")).collect()
    assert len(out) == 1 and out[0]["event_id"] == 3 and out[0]["data_quality_score"] == 80


def test_ticker_without_mapping_kept(spark):
    tick = spark.createDataFrame([("AAA", 1.0), ("BBB", 2.0)], "symbol string, price double")
    smap = spark.createDataFrame([("AAA", "coin-a")], SC.SYMBOL_MAP)
    payload = spark.createDataFrame([('{"coin-a": {"usd_market_cap": 5.0, "usd_24h_vol": 1.0, "usd_24h_change": 2.0}}',)],
                                    "value string")
    out = {r["symbol"]: r for r in G.enrich_tickers(tick, smap, G.market_entries(payload)).collect()}
    assert out["AAA"]["market_cap"] == 5.0 and out["BBB"]["market_cap"] is None


# ---------------------------------------------------------------- schema

def _defn(fields):
    return F.lit(json.dumps({"fields": fields}))


@pytest.mark.parametrize("old,new,exp", [
    ({"a": "STRING", "b": "INTEGER"}, {"a": "STRING"}, dict(backward=False, forward=True, full=False, none=True)),
    ({"a": "STRING"}, {"a": "STRING", "b": "INTEGER"}, dict(backward=True, forward=False, full=False, none=True)),
])
def test_compatibility_modes(spark, old, new, exp):
    row = spark.range(1).select(*[SO.compatible(SO.field_names(_defn(old)), SO.field_names(_defn(new)), F.lit(m)).alias(m)
                                  for m in exp]).first()
    assert row.asDict() == exp


def test_infer_prefers_non_string(spark):
    recs = spark.createDataFrame([('{"x": "abc", "y": 1.5}',), ('{"x": 7, "z": null}',)], "json string")
    got = {r["field_name"]: r["field_type"] for r in SO.infer_schema(recs).collect()}
    assert got == {"x": "INTEGER", "y": "FLOAT64", "z": "STRING"}


@pytest.mark.parametrize("definition", [
    {"fields": {"b": "INTEGER", "a": "STRING"}},
    {"fields": {"a": "STRING"}, "doc": "one \"quoted\" ü", "owners": [{"z": 1, "y": [2.5, None, True]}]},
    {"fields": {"a": "STRING"}, "doc": "two"}, {}, [1, {"b": 1, "a": 2}]])
def test_schema_hash_matches_python_json(spark, definition):
    import hashlib
    exp = hashlib.sha256(json.dumps(definition, sort_keys=True).encode()).hexdigest()
    df = spark.createDataFrame([(json.dumps(definition),)], "d string")
    assert df.select(SO.schema_hash(F.col("d")).alias("h")).first()["h"] == exp


def test_history_hash_matches_python_json(spark):
    import hashlib
    ch = spark.createDataFrame([("t", "b", None, "INTEGER", "added"), ("t", "a", None, "STRING", "added")],
                               "table_id string, field_name string, current_type string, new_type string, change string")
    row = SO.schema_history_rows(ch).first()
    text = json.dumps([{"name": "a", "type": "STRING"}, {"name": "b", "type": "INTEGER"}], sort_keys=True)
    assert row["version_hash"] == hashlib.sha256(text.encode()).hexdigest()[:12]
    assert json.loads(row["fields_added"]) == ["a", "b"]


def test_register_versions_and_status(spark):
    reg0 = spark.createDataFrame([], SC.SCHEMA_REGISTRY)
    props = spark.createDataFrame([
        ("t", json.dumps({"fields": {"a": "STRING"}}), "backward", None, T0),
        ("t", json.dumps({"fields": {"a": "STRING", "b": "INTEGER"}}), "backward", None, T0 + dt.timedelta(days=1)),
    ], "subject string, schema_definition string, compatibility_mode string, description string, proposed_at timestamp")
    both, decided = SO.register_schemas(reg0, props)
    assert [r["status"] for r in decided.orderBy("proposed_at").collect()] == ["registered", "registered"]
    assert {r["version_id"]: r["is_active"] for r in both.collect()} == {"v-0001": False, "v-0002": True}
    rows1, dec1 = SO.register_schemas(reg0, props.limit(1))
    assert rows1.first()["version_id"] == "v-0001" and dec1.count() == 1
    rest = props.filter(F.col("proposed_at") > F.lit(T0))
    rows2, dec2 = SO.register_schemas(rows1, rest)
    assert dec2.first()["status"] == "registered" and rows2.first()["version_id"] == "v-0002"
    # the same definition again is a duplicate; removing a field under BACKWARD is rejected
    _, dec3 = SO.register_schemas(rows1.unionByName(rows2), rest)
    assert dec3.first()["status"] == "duplicate"
    bad = spark.createDataFrame([("t", json.dumps({"fields": {"b": "INTEGER"}}), "backward", None, T0 + dt.timedelta(days=2))],
                                props.schema)
    _, dec4 = SO.register_schemas(rows1.unionByName(rows2), bad)
    assert dec4.first()["status"] == "incompatible"
    latest = SO.latest_schemas(rows1.unionByName(rows2)).first()
    assert latest["version_id"] == "v-0002"


def _decide_one_by_one(definitions):
    """Statuses of (definition, mode) in order, decided the plain way."""
    known, names, out = set(), None, []
    for d, mode in definitions:
        text, new = json.dumps(d, sort_keys=True), set(d.get("fields", {}))
        removed, added = (names or set()) - new, new - (names or set())
        ok = names is None or not (mode in ("backward", "full") and removed or mode in ("forward", "full") and added)
        out.append("duplicate" if text in known else "registered" if ok else "incompatible")
        if out[-1] == "registered":
            known.add(text)
            names = new
    return out


def test_registration_in_order_equals_one_by_one(spark):
    import random
    rng, rows, want = random.Random(1), [], {}
    for subject in "pqr":
        defs = []
        for k in range(40):
            d = {"fields": {f: "STRING" for f in rng.sample("abcd", rng.randint(1, 4))}}
            if rng.random() < 0.3:
                d["note"] = rng.choice(["x", "y"])
            defs += [(d, rng.choice(["backward", "forward", "full", "none"]))] * rng.choice([1, 1, 2])
        want[subject] = _decide_one_by_one(defs)
        rows += [(subject, json.dumps(d), m.upper(), None, T0 + dt.timedelta(hours=k)) for k, (d, m) in enumerate(defs)]
    props = spark.createDataFrame(rows, "subject string, schema_definition string, compatibility_mode string, "
                                        "description string, proposed_at timestamp")
    new, decided = SO.register_schemas(spark.createDataFrame([], SC.SCHEMA_REGISTRY), props)
    got = {s: [r["status"] for r in decided.filter(F.col("subject") == s).orderBy("proposed_at").collect()] for s in want}
    assert got == want and {"duplicate", "incompatible"} <= {x for v in want.values() for x in v}
    texts = {(r["subject"], r["schema_definition"]) for r in new.collect()}
    assert texts <= {(r[0], r[1]) for r in rows}                # stored as proposed, nothing lost


def test_evolve_adds_only_absent(spark):
    df = spark.createDataFrame([(1, "x")], "a long, b string")
    out, rep = SO.evolve_schema(df, [("b", "STRING"), ("c", "FLOAT64")])
    assert out.columns == ["a", "b", "c"] and rep["added"] == ["c"] and rep["already_present"] == ["b"]
    same, rep2 = SO.evolve_schema(df, [("c", "FLOAT64")], dry_run=True)
    assert same.columns == ["a", "b"] and rep2["dry_run"]


def test_null_payload_row_is_kept_and_dead_lettered(spark):
    env = spark.createDataFrame([(None, {}, T0), (bytearray(b'{"symbol": "A"}'), {}, T0)], SC.ENVELOPE)
    flat = G.transform_trades(G.flatten_trades(G.parse_envelopes(env)))
    valid, invalid = QL.validate(flat)
    assert flat.count() == 2 and valid.count() == 0
    assert sorted(r["validation_error"] for r in invalid.collect()) == ["missing_price", "missing_symbol"]


def test_null_fields_stay_in_records(spark):
    df = spark.createDataFrame([("A", 1.0, None)], "symbol string, price double, buyer_order_id long")
    assert json.loads(G.bus_envelope(df).first()["value"]) == {"symbol": "A", "price": 1.0, "buyer_order_id": None}
    dlq = QL.dead_letter(df.withColumn("validation_error", F.lit("x"))).first()["raw_data"]
    assert json.loads(dlq) == {"symbol": "A", "price": 1.0, "buyer_order_id": None}


def test_bus_envelope_attributes_and_defaults(spark):
    df = spark.createDataFrame([("BTCUSDT", "exch", "trade", 1.5), (None, None, None, 2.0)],
                               "symbol string, source string, event_type string, price double")
    rows = G.bus_envelope(df).collect()
    assert rows[0]["key"] == "BTCUSDT" and json.loads(rows[0]["value"])["price"] == 1.5
    assert rows[0]["attributes"] == {"symbol": "BTCUSDT", "source": "exch", "event_type": "trade"}
    assert rows[1]["attributes"] == {"symbol": "UNKNOWN", "source": "unknown", "event_type": "trade"}
