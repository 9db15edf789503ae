"""Sinks and table maintenance on real folders (under the test checkpoint dir)."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tickforge.operators import rollups as R
from tickforge.plans.common import trades
from tickforge.session import scratch_path
from tickforge.sinks import manifest as M, tables as TB, versioned as VT
from tickforge.sinks.kvstore import KvTable
from tickforge.sources import landing as LD

from paths import SF001


def _hourly(spark):
    return R.hourly_ohlcv(trades(spark, SF001)).withColumn("trade_date", F.to_date("hour_timestamp"))


def test_upsert_is_idempotent(spark):
    path = scratch_path(spark, f"t-upsert-{uuid.uuid4().hex}")
    h = _hourly(spark)
    VT.upsert(spark, path, h, ["symbol", "hour_timestamp"], "trade_date")
    n1 = VT.read_table(spark, path).count()
    VT.upsert(spark, path, h, ["symbol", "hour_timestamp"], "trade_date")   # same hours again
    assert VT.read_table(spark, path).count() == n1 == h.count()
    # an update changes values of matched keys only, and reads and writes its own partition only
    one = h.orderBy("hour_timestamp", "symbol").limit(1).withColumn("vwap", F.lit(-1.0))
    before = M.read(spark, path)[1]["partitions"]
    VT.upsert(spark, path, one, ["symbol", "hour_timestamp"], "trade_date")
    t, after = VT.read_table(spark, path), M.read(spark, path)[1]["partitions"]
    assert t.count() == n1 and t.filter("vwap = -1.0").count() == 1
    day = str(one.first()["trade_date"])
    assert {v for v in after if after[v] != before[v]} == {day} and after.keys() == before.keys()
    assert VT.read_table(spark, path, values={day}).select("trade_date").distinct().count() == 1
    assert VT.vacuum(spark, path) == 0 and VT.read_table(spark, path).count() == n1


def test_failed_upsert_leaves_the_old_table(spark, monkeypatch):
    path = scratch_path(spark, f"t-upsert-{uuid.uuid4().hex}")
    rows = lambda x: spark.createDataFrame([(k, f"2024-01-0{1 + k % 3}", x) for k in range(9)], "k int, day string, x double")
    VT.upsert(spark, path, rows(1.0), ["k"], "day")

    def fails(*a, **k):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:                 # all partitions are written, none is live
        m.setattr(VT.M, "commit", fails)
        with pytest.raises(RuntimeError):
            VT.upsert(spark, path, rows(2.0), ["k"], "day")
    assert {r["x"] for r in VT.read_table(spark, path).collect()} == {1.0}
    with monkeypatch.context() as m:                 # the write itself stops after a partition
        def half(df, folder, *a, **k):
            TB.write_table(df.filter("day = '2024-01-01'"), folder, *a, **k)
            raise RuntimeError("lost")
        m.setattr(VT, "write_table", half)
        with pytest.raises(RuntimeError):
            VT.upsert(spark, path, rows(2.0), ["k"], "day")
    assert {r["x"] for r in VT.read_table(spark, path).collect()} == {1.0}
    assert VT.vacuum(spark, path) == 4 and VT.read_table(spark, path).count() == 9
    VT.upsert(spark, path, rows(2.0), ["k"], "day")
    assert {r["x"] for r in VT.read_table(spark, path).collect()} == {2.0} and VT.read_table(spark, path).count() == 9


def test_concurrent_upserts_are_detected(spark, monkeypatch):
    path = scratch_path(spark, f"t-upsert-{uuid.uuid4().hex}")
    rows = lambda x: spark.createDataFrame([(1, "a", x), (2, None, x)], "k int, part string, x double")
    VT.upsert(spark, path, rows(1.0), ["k"], "part")
    write = VT.write_table

    def other_first(*a, **k):
        write(*a, **k)
        monkeypatch.setattr(VT, "write_table", write)
        VT.upsert(spark, path, rows(3.0), ["k"], "part")
    monkeypatch.setattr(VT, "write_table", other_first)
    with pytest.raises(M.ConcurrentUpdate):
        VT.upsert(spark, path, rows(2.0), ["k"], "part")
    assert {(r["k"], r["part"], r["x"]) for r in VT.read_table(spark, path).collect()} == {(1, "a", 3.0), (2, None, 3.0)}


def test_manifest_versions(spark):
    root = scratch_path(spark, f"t-manifest-{uuid.uuid4().hex}")
    assert M.read(spark, root) == (-1, {}) and M.versions(spark, root) == []
    for v in range(12):
        M.commit(spark, root, v, {"v": v, "name": "é"})
    assert M.read(spark, root) == (11, {"v": 11, "name": "é"}) and len(M.versions(spark, root)) == M.KEEP
    assert M.read(spark, root, below=11)[0] == 10
    with pytest.raises(M.ConcurrentUpdate):
        M.commit(spark, root, 11, {})
    assert M.read(spark, root)[1]["v"] == 11


@pytest.mark.parametrize("partition", ["trade_date", None])
def test_batches_are_packed(spark, partition, monkeypatch):
    """The number of folders stays bounded, rows stay the same at every moment, the newest batch is left out."""
    path = scratch_path(spark, f"t-compact-{uuid.uuid4().hex}")
    h = _hourly(spark).withColumn("trade_date", F.date_format("hour_timestamp", "yyyy-MM"))
    rows, n = h.collect(), h.count()

    def batch(i):
        part = h.filter(F.pmod(F.hash("symbol", "hour_timestamp"), F.lit(10)) == i)
        TB.write_table(part, f"{path}/batch_id={i}", [partition] if partition else (), mode="overwrite")

    def files():
        live = VT._live(spark, path, partition, M.read(spark, path)[1])
        return sum(len(x) for x in live.values()), len(live)
    for i in range(10):
        batch(i)
    assert VT.compact(spark, path, partition, ("symbol",)) > 0
    assert VT.compact(spark, path, partition, ("symbol",)) == 0            # nothing more to pack; old folders go
    folders, values = files()
    assert folders <= 2 * values and VT.read_batches(spark, path, partition).count() == n
    assert [int(x[9:]) for x in M.folders(spark, path, "batch_id=") if x[9:].isdigit() and M.size_of(spark, f"{path}/{x}")
            and VT._values(spark, f"{path}/{x}", "trade_date")] in ([9], [])
    got = VT.read_batches(spark, path, partition).select(h.columns[0], "symbol", "hour_timestamp").distinct().count()
    assert got == len({(r[h.columns[0]], r["symbol"], r["hour_timestamp"]) for r in rows})
    batch(9)                                                                # a replay of the newest batch
    assert VT.read_batches(spark, path, partition).count() == n
    # A compaction that fails before its commit changes nothing.
    for i in range(10, 16):
        TB.write_table(h.limit(5), f"{path}/batch_id={i}", [partition] if partition else (), mode="overwrite")
    total = VT.read_batches(spark, path, partition).count()

    def fails(*a, **k):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(VT.M, "commit", fails)
        with pytest.raises(RuntimeError):
            VT.compact(spark, path, partition)
    assert VT.read_batches(spark, path, partition).count() == total
    VT.compact(spark, path, partition)
    assert VT.read_batches(spark, path, partition).count() == total


def test_append_counted_and_partitions(spark):
    path = scratch_path(spark, f"t-append-{uuid.uuid4().hex}")
    h = _hourly(spark)
    n = TB.append_counted(h, path, partition_by=("trade_date",))
    assert n == h.count()
    parts = TB.partition_values(spark, path, "trade_date")
    assert len(parts) == h.select("trade_date").distinct().count()
    dropped = TB.apply_retention(spark, path, "trade_date", parts[-3])
    assert dropped == parts[:-3]
    assert TB.partition_values(spark, path, "trade_date") == parts[-3:]
    assert TB.delete_partition(spark, path, "trade_date", parts[-1])
    assert spark.read.parquet(path).select("trade_date").distinct().count() == 2


def test_list_partitions_range(spark):
    p = LD.list_partitions(trades(spark, SF001), "trade_timestamp", start="2024-01-03", end="2024-01-05")
    assert [r[0] for r in p.collect()] == ["20240105", "20240104", "20240103"]


def test_insert_rows_errors(spark):
    rows = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": "no", "b": "y"}',), ("nope",)], "json string")
    good, errors = TB.insert_rows(rows, spark.createDataFrame([], "a long, b string").schema)
    assert good.count() == 1
    assert sorted(r["error"] for r in errors.collect()) == ["invalid fields: a", "not a JSON object"]


def test_latest_price_items_decimal_and_ttl(spark):
    df = spark.createDataFrame([("A", 100, 1, 1.5, 0.0), ("A", 200, 2, 2.5, 3.0)],
                               "symbol string, timestamp long, event_id long, price double, market_cap double")
    r = TB.latest_price_items(df).first()
    assert str(r["price"]).startswith("2.5") and r["ttl"] == 200 + 86400
    r0 = TB.latest_price_items(df.filter("timestamp = 100")).first()
    assert r0["market_cap"] is None          # only stored when truthy


def test_table_stats_and_info(spark, tmp_path):
    """Rows come from footers without reading a column; bytes are those of the file system."""
    import os
    from tickforge.operators import metrics as MT
    path = f"{SF001}/events.parquet"
    ev = spark.read.parquet(path)
    info = LD.table_info(spark, path, "events").first()
    assert (info["num_rows"], info["num_bytes"], info["num_fields"]) == (ev.count(), os.path.getsize(path), 6)
    with LD._footers_only(spark):
        plan = LD.counted(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "event_id" not in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    folder = str(tmp_path / "t")
    ev.repartition(5).write.partitionBy("event_type").parquet(folder)
    sizes = [os.path.getsize(f"{p}/{n}") for p, _, names in os.walk(folder) for n in names if n.endswith(".parquet")]
    stats = LD.table_stats(spark, folder, "t")
    assert tuple(stats.first()) == ("t", ev.count(), sum(sizes), len(sizes))
    rows = [("a", 12_345_678, 5 * 2**30 + 2**20), ("a", 10, 2**29), ("b", 4_999, 7), ("c", 0, 0)]
    report = MT.storage_report(spark.createDataFrame(rows, "table_name string, rows long, bytes long")).collect()
    assert [tuple(r)[:3] for r in report] == [("a", 12.35, 5.5), ("b", 0.0, 0.0), ("c", 0.0, 0.0)]


def test_load_files_formats_and_dispositions(spark):
    base = scratch_path(spark, f"t-load-{uuid.uuid4().hex}")
    ev = spark.read.parquet(f"{SF001}/events.parquet").select("event_id", "event_type", "value")
    ev.write.option("header", True).csv(f"{base}/csv")
    ev.write.json(f"{base}/json")
    n = ev.count()
    assert LD.load_files(spark, f"{base}/csv", "CSV").count() == n           # autodetect
    typed = LD.load_files(spark, f"{base}/json", "JSON", schema=ev.schema)
    assert typed.schema == ev.schema and typed.count() == n
    TB.write_table(typed, f"{base}/t", mode="WRITE_TRUNCATE")
    TB.write_table(typed, f"{base}/t", mode="WRITE_APPEND")
    assert spark.read.parquet(f"{base}/t").count() == 2 * n
    with pytest.raises(Exception):
        TB.write_table(typed, f"{base}/t", mode="WRITE_EMPTY")


def _items(spark, rows, batch, ttl=1150):
    df = spark.createDataFrame(rows, "symbol string, timestamp long, event_id long, price double")
    return TB.kv_items(df, ttl_seconds=ttl, write_batch=batch)


def _kv(table):
    return {(r["symbol"], r["timestamp"]): r["price"] for r in table.read().collect()}


def test_kv_put_newer_write_wins_and_ttl(spark):
    t = KvTable(spark, scratch_path(spark, f"t-kv-{uuid.uuid4().hex}"), bucket_seconds=100)
    with pytest.raises(FileNotFoundError):
        t.read()
    t.put(_items(spark, [("A", 100, 1, 1.0), ("A", 100, 2, 2.0), ("B", 50, 3, 5.0)], 0), 0)
    assert _kv(t) == {("A", 100): 2.0, ("B", 50): 5.0}
    t.put(_items(spark, [("A", 100, 0, 9.0), ("A", 1200, 4, 3.0)], 1), 1)
    # batch 1 re-puts (A,100) -> replaced even with a smaller event id; (B,50) expired (1200 <= 1200)
    assert _kv(t) == {("A", 100): 9.0, ("A", 1200): 3.0}
    t.put(_items(spark, [("A", 100, 0, -1.0)], 1), 1)                       # a replayed batch changes nothing
    assert _kv(t) == {("A", 100): 9.0, ("A", 1200): 3.0}
    t.put(_items(spark, [], 2), 2)
    t.put(_items(spark, [(None, 1300, 0, 7.0)], 3), 3)
    assert _kv(t) == {("A", 1200): 3.0, (None, 1300): 7.0}                  # ttl 1250 of (A,100) is behind 1300


def test_kv_bytes_follow_the_batch(spark):
    """A large table does not make puts larger; expired hours go as folders; deltas of an hour are merged."""
    path = scratch_path(spark, f"t-kv-{uuid.uuid4().hex}")
    t, want = KvTable(spark, path, max_deltas=4), {}
    big = [(f"S{k}", 1000 + k, k, float(k)) for k in range(20_000)]
    t.put(_items(spark, big, 0, 86_400), 0)
    size = M.size_of(spark, path)
    for b in range(1, 12):
        rows = [(f"S{k}", 90_000 + k, k, float(b)) for k in range(b, b + 40)]
        before = M.folders(spark, f"{path}/delta")
        t.put(_items(spark, rows, b, 86_400), b)
        want.update({(s, ts): p for s, ts, _, p in rows})
        new = [x for x in M.folders(spark, f"{path}/delta") if x not in before]
        assert M.size_of(spark, f"{path}/delta/{new[0]}") < size / 10
    assert {k: v for k, v in _kv(t).items() if k[1] >= 90_000} == want
    hours = M.read(spark, path)[1]["hours"]
    assert max(len(x) for h, x in hours.items()) <= 5
    gone = {h for h in hours if (int(h) + 1) * 3600 <= 90_050}
    assert not gone and all(ts + 86_400 > 90_050 for _, ts in _kv(t))
    t.put(_items(spark, [("X", 250_000, 1, 1.0)], 12, 86_400), 12)
    t.put(_items(spark, [("X", 250_001, 1, 1.0)], 13, 86_400), 13)
    assert set(_kv(t)) == {("X", 250_000), ("X", 250_001)} and M.size_of(spark, path) < size / 4


def test_kv_failed_put_is_written_anew(spark, monkeypatch):
    from tickforge.sinks import kvstore
    t = KvTable(spark, scratch_path(spark, f"t-kv-{uuid.uuid4().hex}"))
    t.put(_items(spark, [("A", 100, 1, 1.0)], 0), 0)

    def fails(*a, **k):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(kvstore.M, "commit", fails)
        with pytest.raises(RuntimeError):
            t.put(_items(spark, [("A", 100, 1, 2.0), ("B", 100, 1, 2.0)], 1), 1)
    assert _kv(t) == {("A", 100): 1.0}
    t.put(_items(spark, [("A", 100, 1, 3.0)], 1), 1)
    assert _kv(t) == {("A", 100): 3.0}


def test_create_and_evolve_catalog_table(spark):
    from tickforge.operators import schema_ops as SO
    name = f"t_evolve_{uuid.uuid4().hex[:8]}"
    loc = scratch_path(spark, name)
    TB.create_table(spark, name, "symbol STRING, price DOUBLE", location=loc)
    added = SO.evolve_table(spark, name, [("price", "FLOAT64"), ("volume", "FLOAT64")])
    assert added == ["volume"]
    assert spark.table(name).columns == ["symbol", "price", "volume"]
    assert SO.evolve_table(spark, name, [("extra", "STRING")], dry_run=True) == ["extra"]
    assert "extra" not in spark.table(name).columns


def test_register_partitioned_lake_table(spark):
    name = f"t_lake_{uuid.uuid4().hex[:8]}"
    loc = scratch_path(spark, name)
    h = _hourly(spark)
    TB.write_table(h, loc, partition_by=("trade_date",), mode="overwrite")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in h.schema.fields)
    TB.create_table(spark, name, ddl, partition_by=("trade_date",), location=loc)
    assert spark.table(name).count() == h.count()
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == h.select("trade_date").distinct().count()
