"""Queries: data quality, metrics, alerts, table maintenance and schema tooling
(A13, A15-A17, M10, K9, K12, K15, W11, S8, S9, S10, M1-M9)."""

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import to_ntz
from ..operators import indicators as I, metrics as MT, quality as QL, rollups as R
from ..operators import schema_ops as SO
from ..sinks import tables as TB
from ..sources import landing as LD, tables as TBL
from ..session import materialize
from . import sql_blocks as Q
from .catalog import register
from .common import TICK_SPEC, events, rounded, ticks, trades
from .q_ingest import PARSED_SQL, _parsed
from .q_rollups import DAILY_D, OHLC_D

IND = Q.indicators()


@register("dq_counts", f"""SELECT count(*) AS total_rows,
  count(*) FILTER (WHERE symbol IS NULL) AS null_symbols,
  count(*) FILTER (WHERE price <= 0) AS invalid_prices,
  count(*) FILTER (WHERE quantity <= 0) AS invalid_quantities,
  (count(*) FILTER (WHERE symbol IS NULL) > 0 OR count(*) FILTER (WHERE price <= 0) > 0
   OR count(*) FILTER (WHERE quantity <= 0) > 0) AS has_issues
FROM ({Q.TRADES}) AS t""")
def dq_counts(spark, d):
    return QL.dq_counts(trades(spark, d), hours=None)


@register("dq_counts_last_hour", f"""SELECT count(*) AS total_rows,
  count(*) FILTER (WHERE symbol IS NULL) AS null_symbols,
  count(*) FILTER (WHERE price <= 0) AS invalid_prices,
  count(*) FILTER (WHERE quantity <= 0) AS invalid_quantities,
  (count(*) FILTER (WHERE symbol IS NULL) > 0 OR count(*) FILTER (WHERE price <= 0) > 0
   OR count(*) FILTER (WHERE quantity <= 0) > 0) AS has_issues
FROM ({Q.TRADES}) AS t WHERE trade_timestamp >= {Q.AS_OF_TS} - INTERVAL 1 HOUR""")
def dq_counts_last_hour(spark, d):
    """A13 as scheduled: the last hour before the newest trade."""
    return QL.dq_counts(trades(spark, d))


@register("custom_metrics", f"""WITH w AS (
  SELECT time_bucket(INTERVAL '300 seconds', watermark_time) AS window_start, count(*) AS n,
    count(CASE WHEN is_anomaly THEN 1 END) AS a, count(DISTINCT symbol) AS s
  FROM ({IND}) AS i GROUP BY 1)
SELECT window_start, 'TotalRecords' AS metric_name, CAST(n AS DOUBLE) AS value, 'Count' AS unit FROM w
UNION ALL SELECT window_start, 'AnomalyCount', CAST(a AS DOUBLE), 'Count' FROM w
UNION ALL SELECT window_start, 'AnomalyRate', CASE WHEN n > 0 THEN a * 100.0 / n ELSE 0.0 END, 'Percent' FROM w
UNION ALL SELECT window_start, 'ActiveSymbols', CAST(s AS DOUBLE), 'Count' FROM w""", ("value",))
def custom_metrics(spark, d):
    enriched = I.technical_indicators(ticks(spark, d), spec=TICK_SPEC)
    return rounded(MT.custom_metrics_windows(enriched, seconds=300))


@register("custom_metrics_recent", f"""WITH w AS (
  SELECT count(*) AS n, count(CASE WHEN is_anomaly THEN 1 END) AS a, count(DISTINCT symbol) AS s
  FROM ({IND}) AS i WHERE "timestamp" > (SELECT max("timestamp") FROM ({Q.TICKS}) AS t) - 3600)
SELECT 'TotalRecords' AS metric_name, CAST(n AS DOUBLE) AS value, 'Count' AS unit FROM w
UNION ALL SELECT 'AnomalyCount', CAST(a AS DOUBLE), 'Count' FROM w
UNION ALL SELECT 'AnomalyRate', CASE WHEN n > 0 THEN a * 100.0 / n ELSE 0.0 END, 'Percent' FROM w
UNION ALL SELECT 'ActiveSymbols', CAST(s AS DOUBLE), 'Count' FROM w""", ("value",))
def custom_metrics_recent(spark, d):
    """S7 + A15 as asked at a moment: the rows of the last hour (the table has a row every few minutes)."""
    enriched = I.technical_indicators(ticks(spark, d), spec=TICK_SPEC)
    return rounded(MT.custom_metrics(enriched, seconds=3600))


@register("batch_metrics", f"""SELECT CAST(strftime(trade_timestamp, '%Y%m%d%H') AS BIGINT) AS batch_id, symbol,
  count(*) FILTER (WHERE coalesce(symbol IS NOT NULL AND price > 0 AND quantity > 0 AND trade_id IS NOT NULL, false)) AS messages_processed,
  count(*) FILTER (WHERE NOT coalesce(symbol IS NOT NULL AND price > 0 AND quantity > 0 AND trade_id IS NOT NULL, false)) AS messages_failed,
  max(event_time) - min(event_time) AS batch_duration_ms,
  CASE WHEN count(*) FILTER (WHERE coalesce(symbol IS NOT NULL AND price > 0 AND quantity > 0 AND trade_id IS NOT NULL, false)) > 0
        AND max(event_time) - min(event_time) > 0
       THEN count(*) FILTER (WHERE coalesce(symbol IS NOT NULL AND price > 0 AND quantity > 0 AND trade_id IS NOT NULL, false))
            / ((max(event_time) - min(event_time)) / 1000.0) END AS throughput
FROM ({PARSED_SQL}) AS p GROUP BY 1, 2""", ("throughput",))
def batch_metrics(spark, d):
    """A17 with hourly ingestion slices as micro-batches."""
    p = _parsed(spark, d)
    b = p.select("symbol", F.date_format("trade_timestamp", "yyyyMMddHH").cast("long").alias("batch_id"),
                 F.coalesce(QL.validity(), F.lit(False)).alias("is_valid"),
                 F.col("event_time").alias("event_ms"))
    return rounded(MT.batch_metrics(b, by_symbol=True))


@register("alert_state", f"""WITH pm AS (
  SELECT CAST(date_trunc('minute', watermark_time) AS TIMESTAMP) AS minute, count(*) AS records,
    count(CASE WHEN is_anomaly THEN 1 END) * 100.0 / count(*) AS anomaly_rate
  FROM ({IND}) AS i GROUP BY 1),
g AS (SELECT unnest(generate_series((SELECT min(minute) FROM pm), (SELECT max(minute) FROM pm),
                                    INTERVAL 1 MINUTE)) AS minute),
m AS (SELECT g.minute, coalesce(pm.records, 0) AS records, pm.anomaly_rate,
        CAST(coalesce(pm.anomaly_rate > 10.0, false) AS INTEGER) AS high
      FROM g LEFT JOIN pm USING (minute)),
s1 AS (SELECT *, count(*) OVER f AS n1, min(high) OVER f AS high_all, sum(records) OVER f AS sum5
       FROM m WINDOW f AS (ORDER BY minute ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
s2 AS (SELECT *, CAST(sum5 < 1 AND n1 = 5 AS INTEGER) AS low FROM s1),
s3 AS (SELECT *, count(*) OVER f AS n2, min(low) OVER f AS low_all
       FROM s2 WINDOW f AS (ORDER BY minute ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT minute, records, anomaly_rate,
  CASE WHEN records = 0 THEN 'no_data' WHEN n1 = 5 AND high_all = 1 THEN 'alerting' ELSE 'ok' END
    AS high_anomaly_rate_state,
  CASE WHEN records = 0 THEN 'alerting' WHEN n2 = 5 AND low_all = 1 THEN 'alerting' ELSE 'ok' END
    AS no_records_state
FROM s3""", ("anomaly_rate",))
def alert_state(spark, d):
    enriched = I.technical_indicators(ticks(spark, d), spec=TICK_SPEC)
    return rounded(MT.alert_states(enriched))


# ---- keyed upserts: target = older roll-up, updates = newer overlapping roll-up
SPLIT = "date_trunc('hour', (SELECT max(ts) FROM events) - INTERVAL 10 DAY)"
OVERLAP = "date_trunc('hour', (SELECT max(ts) FROM events) - INTERVAL 15 DAY)"
TGT_H = Q.hourly(f"SELECT * FROM ({Q.TRADES}) AS t WHERE trade_timestamp < {SPLIT}")
UPD_H = Q.hourly(f"SELECT * FROM ({Q.TRADES}) AS t WHERE trade_timestamp >= {OVERLAP}")


def _split_hourly(spark, d):
    tr = trades(spark, d)
    mx = tr.select(F.max("trade_timestamp")).scalar()
    split = to_ntz(F.date_trunc("hour", mx - F.expr("INTERVAL 10 DAYS")))
    overlap = to_ntz(F.date_trunc("hour", mx - F.expr("INTERVAL 15 DAYS")))
    return R.hourly_ohlcv(tr, end=split), R.hourly_ohlcv(tr, start=overlap, end=mx + F.expr("INTERVAL 1 HOUR"))


@register("upsert_hourly", f"""SELECT * FROM ({TGT_H}) AS t
  WHERE NOT EXISTS (SELECT 1 FROM ({UPD_H}) AS u WHERE u.symbol = t.symbol AND u.hour_timestamp = t.hour_timestamp)
UNION ALL SELECT * FROM ({UPD_H}) AS u2""", OHLC_D)
def upsert_hourly(spark, d):
    target, updates = _split_hourly(spark, d)
    return rounded(TB.merge_rows(target, updates, ["symbol", "hour_timestamp"]))


TGT_D = Q.daily(TGT_H)
UPD_D = Q.daily(UPD_H)


@register("upsert_daily", f"""SELECT * FROM ({TGT_D}) AS t
  WHERE NOT EXISTS (SELECT 1 FROM ({UPD_D}) AS u WHERE u.symbol = t.symbol AND u.trade_date = t.trade_date)
UNION ALL SELECT * FROM ({UPD_D}) AS u2""", DAILY_D)
def upsert_daily(spark, d):
    target, updates = _split_hourly(spark, d)
    return rounded(TB.merge_rows(R.daily_ohlcv(target), R.daily_ohlcv(updates), ["symbol", "trade_date"]))


@register("retention_keep", f"""SELECT * FROM ({Q.HOURLY}) AS h
WHERE CAST(hour_timestamp AS DATE) >= (SELECT max(CAST(hour_timestamp AS DATE)) FROM ({Q.HOURLY}) AS x) - INTERVAL 14 DAY""",
          OHLC_D)
def retention_keep(spark, d):
    return rounded(TB.retention_keep(R.hourly_ohlcv(trades(spark, d)), "hour_timestamp", days=14))


@register("latest_price", f"""SELECT symbol, "timestamp", price, volume, rsi, macd_line, is_anomaly,
  "timestamp" + 86400 AS ttl
FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC, event_id DESC) AS rn
      FROM ({IND}) AS i) AS r WHERE rn = 1""", ("price", "volume", "rsi", "macd_line"))
def latest_price(spark, d):
    enriched = I.technical_indicators(ticks(spark, d), spec=TICK_SPEC)
    items = TB.latest_price_items(enriched.select("symbol", "timestamp", "event_id", "price", "volume",
                                                  "rsi", "macd_line", "is_anomaly"), as_decimal=False)
    return rounded(items)


@register("latest_price_decimal", f"""SELECT symbol, "timestamp", CAST(price AS DECIMAL(38, 6)) AS price,
  CAST(volume AS DECIMAL(38, 6)) AS volume, CAST(nullif(market_cap, 0) AS DECIMAL(38, 6)) AS market_cap, "timestamp" + 86400 AS ttl
FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN 0.0 ELSE round(price * 4, 2) END AS market_cap,
        row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC, event_id DESC) AS rn
      FROM ({Q.TICKS}) AS t) AS r WHERE rn = 1""")
def latest_price_decimal(spark, d):
    """Items as the key-value store takes them, decimals, and ``market_cap`` only when it is not zero."""
    t = ticks(spark, d).withColumn("market_cap", F.when(F.col("event_id") % 2 == 0, F.lit(0.0)).otherwise(F.round(F.col("price") * 4, 2)))
    items = TB.latest_price_items(t.select("symbol", "timestamp", "event_id", "price", "volume", "market_cap"))
    return items.withColumns({c: F.col(c).cast("decimal(38,6)") for c in ("price", "volume", "market_cap")})


@register("list_partitions", f"""SELECT DISTINCT strftime(CAST(trade_timestamp AS DATE), '%Y%m%d') AS partition_id
FROM ({Q.TRADES}) AS t""")
def list_partitions(spark, d):
    return LD.list_partitions(trades(spark, d), "trade_timestamp")


@register("storage_report", None)
def storage_report(spark, d):
    """S8 + A16: file metadata of every driver table (no SQL oracle: file
    sizes are not visible to the SQL views)."""
    return MT.storage_report(_stats_of_all(spark, d))


def _stats_of_all(spark, d):
    return reduce(DataFrame.unionByName, [LD.table_stats(spark, f"{d}/{t}.parquet", t) for t in TBL.TABLES])


@register("table_info", None)
def table_info(spark, d):
    """S10 for the trade source table."""
    return LD.table_info(spark, f"{d}/events.parquet", "events", partition_cols=(), cluster_cols=("event_type",))


# ---- schema tooling over JSON records serialised from events
TYPE_CASE = """CASE WHEN t IN ('OBJECT') THEN 'RECORD' WHEN t = 'ARRAY' THEN 'REPEATED'
  WHEN t IN ('BIGINT', 'UBIGINT', 'INTEGER') THEN 'INTEGER' WHEN t = 'DOUBLE' THEN 'FLOAT64'
  WHEN t = 'BOOLEAN' THEN 'BOOLEAN' ELSE 'STRING' END"""
PREC = "['RECORD', 'REPEATED', 'FLOAT64', 'INTEGER', 'BOOLEAN', 'TIMESTAMP', 'DATE', 'STRING']"


def infer_sql(records_sql: str, group: str = "") -> str:
    gsel = f"{group}, " if group else ""
    return f"""WITH r AS ({records_sql}),
kt AS (SELECT {gsel}k AS field_name, json_type(j, concat('$."', k, '"')) AS t
       FROM (SELECT {gsel}j, unnest(json_keys(j)) AS k FROM r) AS x),
kv AS (SELECT {gsel}field_name, {TYPE_CASE} AS ft FROM kt)
SELECT {gsel}field_name, {PREC}[min(list_position({PREC}, ft))] AS field_type, count(*) AS n_records
FROM kv GROUP BY {gsel}field_name"""


EVENT_JSON_SQL = "SELECT CAST(to_json({'event_id': event_id, 'ts': strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), 'user_id': user_id, 'event_type': event_type, 'value': value, 'props': props}) AS VARCHAR) AS j FROM events UNION ALL SELECT props AS j FROM events"


def _event_records(spark, d):
    ev = events(spark, d)
    rows = ev.select(F.to_json(F.struct("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
                                        "user_id", "event_type", "value", "props")).alias("json"))
    return rows.unionByName(ev.select(F.col("props").alias("json")))


@register("schema_infer", infer_sql(EVENT_JSON_SQL))
def schema_infer(spark, d):
    return SO.infer_schema(_event_records(spark, d))


NEW_JSON_SQL = f"""SELECT CAST(to_json({{'event_id': event_id, 'ts': strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'),
  'event_type': event_type, 'value': value, 'props': json(props), 'quantity': {Q.K}}}) AS VARCHAR) AS j FROM events"""
# Field types of the events table as documented for the driver data
# (event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type/props VARCHAR,
# value DOUBLE) in warehouse type names.
CUR_FIELDS_SQL = """SELECT * FROM (VALUES ('event_id', 'INTEGER'), ('ts', 'TIMESTAMP'),
  ('user_id', 'INTEGER'), ('event_type', 'STRING'), ('value', 'FLOAT64'), ('props', 'STRING'))
  AS c(field_name, field_type)"""


def _new_records(spark, d):
    ev = events(spark, d)
    return ev.select(F.to_json(F.struct(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), "event_type", "value",
        F.from_json("props", "map<string,bigint>").alias("props"),
        F.get_json_object("props", "$.k").cast("double").alias("quantity"))).alias("json"))


SCHEMA_DIFF_SQL = f"""SELECT coalesce(c.field_name, n.field_name) AS field_name, c.field_type AS current_type,
  n.field_type AS new_type,
  CASE WHEN c.field_type IS NULL THEN 'added' WHEN n.field_type IS NULL THEN 'removed'
       WHEN c.field_type <> n.field_type THEN 'modified' ELSE 'unchanged' END AS change
FROM ({CUR_FIELDS_SQL}) AS c FULL OUTER JOIN ({infer_sql(NEW_JSON_SQL)}) AS n ON c.field_name = n.field_name"""


@register("schema_diff", SCHEMA_DIFF_SQL)
def schema_diff(spark, d):
    return SO.schema_changes(SO.table_fields(events(spark, d)), SO.infer_schema(_new_records(spark, d)))


@register("schema_evolve", """SELECT *, CAST(NULL AS DOUBLE) AS quantity FROM events""")
def schema_evolve(spark, d):
    """M4: add the inferred fields that the events table lacks (add-only)."""
    inferred = SO.infer_schema(_new_records(spark, d))
    new_fields = [(r["field_name"], r["field_type"]) for r in inferred.collect()]  # one row per field
    evolved, _ = SO.evolve_schema(events(spark, d), new_fields)
    return evolved


def _proposals(spark, d):
    """One schema proposal per (event type, day): the schema inferred from that day's records
    of that type. Fields come and go by day and the owner changes now and then, so added,
    removed, repeated and conflicting definitions occur under every mode."""
    ev = events(spark, d)
    day = F.datediff(F.to_date("ts"), F.lit("2020-01-01").cast("date"))
    rec = ev.select(F.col("event_type").alias("subject"),
                    F.to_date("ts").cast("timestamp").alias("proposed_at"),
                    F.to_json(F.struct("event_id", "user_id", F.when(day % 5 != 2, F.col("value")).alias("value"),
                                       F.when((day % 5).isin(1, 3), F.col("user_id")).alias("extra"),
                                       F.from_json("props", "map<string,bigint>").alias("props"))).alias("json"))
    fields = SO.infer_schema(rec, group_cols=("subject", "proposed_at"))
    fm = SO.fields_map(fields, ("subject", "proposed_at"))
    at = F.datediff(F.to_date("proposed_at"), F.lit("2020-01-01").cast("date"))
    return fm.select("subject", "proposed_at",
                     F.to_json(F.struct(F.when(at % 7 == 0, "b").otherwise("a").alias("owner"), F.col("fields")))
                     .alias("schema_definition"),
                     F.element_at(F.array(*[F.lit(m) for m in ("BACKWARD", "FORWARD", "FULL", "NONE")]),
                                  F.length("subject") % 4 + 1).alias("compatibility_mode"),
                     F.lit(None).cast("string").alias("description"))


def _empty_registry(spark):
    from ..schemas import SCHEMA_REGISTRY
    return spark.createDataFrame([], SCHEMA_REGISTRY)


# The same proposals with their field names, canonical text and place in the subject's order.
PROPOSALS_SQL = """SELECT *, row_number() OVER (PARTITION BY subject ORDER BY proposed_at) AS rn,
  sha256('{"fields": {' || array_to_string(list_transform(names, lambda n: '"' || n || '": "' ||
    CASE n WHEN 'props' THEN 'RECORD' WHEN 'value' THEN 'FLOAT64' ELSE 'INTEGER' END || '"'), ', ')
    || '}, "owner": "' || CASE WHEN day % 7 = 0 THEN 'b' ELSE 'a' END || '"}') AS hash
FROM (SELECT subject, proposed_at, day,
    list_sort(list_concat(['event_id', 'props', 'user_id'], list_concat(
      CASE WHEN day % 5 <> 2 THEN ['value'] ELSE [] END, CASE WHEN day % 5 IN (1, 3) THEN ['extra'] ELSE [] END))) AS names,
    (['backward', 'forward', 'full', 'none'])[CAST(length(subject) % 4 + 1 AS INTEGER)] AS mode
  FROM (SELECT DISTINCT event_type AS subject, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS proposed_at,
          datediff('day', DATE '2020-01-01', CAST(ts AS DATE)) AS day FROM events) AS e) AS n"""


def _ok_sql(old: str, new: str, mode: str) -> str:
    removed = f"len(list_filter({old}, lambda x: NOT list_contains({new}, x))) > 0"
    added = f"len(list_filter({new}, lambda x: NOT list_contains({old}, x))) > 0"
    return (f"({old} IS NULL OR {mode} = 'none' OR ({mode} = 'backward' AND NOT {removed}) OR "
            f"({mode} = 'forward' AND NOT {added}) OR ({mode} = 'full' AND NOT {removed} AND NOT {added}))")


# Folded one proposal at a time per subject.
REGISTER_SQL = f"""WITH RECURSIVE p AS ({PROPOSALS_SQL}),
f AS (
  SELECT DISTINCT subject, CAST(0 AS BIGINT) AS rn, CAST(NULL AS TIMESTAMP) AS proposed_at, CAST(NULL AS VARCHAR) AS hash,
    CAST([] AS VARCHAR[]) AS known, CAST(NULL AS VARCHAR[]) AS names, 0 AS number, CAST(NULL AS VARCHAR) AS status FROM p
  UNION ALL
  SELECT subject, rn, proposed_at, hash,
    CASE WHEN status = 'registered' THEN list_append(known, hash) ELSE known END,
    CASE WHEN status = 'registered' THEN new_names ELSE names END,
    CASE WHEN status = 'registered' THEN number + 1 ELSE number END, status
  FROM (SELECT p.subject, p.rn, p.proposed_at, p.hash, f.known, f.names, f.number, p.names AS new_names,
      CASE WHEN list_contains(f.known, p.hash) THEN 'duplicate'
           WHEN {_ok_sql('f.names', 'p.names', 'p.mode')} THEN 'registered' ELSE 'incompatible' END AS status
    FROM f JOIN p ON p.subject = f.subject AND p.rn = f.rn + 1) AS s)
SELECT subject, proposed_at, hash AS schema_hash, status,
  CASE WHEN status = 'registered' THEN printf('v-%04d', number) END AS version_id
FROM f WHERE rn > 0"""


@register("schema_register", REGISTER_SQL)
def schema_register(spark, d):
    _, decisions = SO.register_schemas(_empty_registry(spark), _proposals(spark, d))
    return decisions.withColumn("proposed_at", F.col("proposed_at").cast("timestamp_ntz"))


def _registry(spark, d):
    """The registry after all proposals, written once."""
    return materialize(SO.register_schemas(_empty_registry(spark), _proposals(spark, d))[0], "schema-registry")


REGISTERED_SQL = f"SELECT subject, version_id, schema_hash, proposed_at AS created_at FROM ({REGISTER_SQL}) AS d WHERE status = 'registered'"


@register("schema_rows", f"""SELECT *, row_number() OVER (PARTITION BY subject ORDER BY version_id DESC) = 1 AS is_active
FROM ({REGISTERED_SQL}) AS v""")
def schema_rows(spark, d):
    """M6: the rows written, only the newest of a subject active."""
    return _stamped(_registry(spark, d).select("subject", "version_id", "schema_hash", "created_at", "is_active"))


def _stamped(df):
    return df.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@register("schema_latest", f"SELECT * FROM ({REGISTERED_SQL}) AS v QUALIFY row_number() OVER (PARTITION BY subject ORDER BY version_id DESC) = 1")
def schema_latest(spark, d):
    """Newest registered version per subject."""
    return _stamped(SO.latest_schemas(_registry(spark, d)).select("subject", "version_id", "schema_hash", "created_at"))


@register("schema_by_hash", f"""SELECT v.* FROM ({REGISTERED_SQL}) AS v
WHERE subject = (SELECT min(event_type) FROM events) AND version_id = 'v-0001'""")
def schema_by_hash(spark, d):
    """M7: the first subject's first version, looked up by its hash."""
    reg = _registry(spark, d)
    first = reg.filter("version_id = 'v-0001'").orderBy("subject").select("subject", "schema_hash").first()
    found = SO.schema_by_hash(reg, first["subject"], first["schema_hash"])
    return _stamped(found.select("subject", "version_id", "schema_hash", "created_at"))


@register("schema_versions", REGISTERED_SQL)
def schema_versions(spark, d):
    """M7: history of every subject."""
    return _stamped(SO.schema_history(_registry(spark, d)).select("subject", "version_id", "schema_hash", "created_at"))


@register("schema_active", f"""SELECT subject, version_id, row_number() OVER (PARTITION BY subject ORDER BY version_id DESC) = 1 AS is_active
FROM ({REGISTERED_SQL}) AS v""")
def schema_active(spark, d):
    """M7: deactivation of all but the newest version as a derived column."""
    return SO.with_active_flag(_registry(spark, d).drop("is_active")).select("subject", "version_id", "is_active")


@register("schema_history", f"""SELECT 'events' AS table_id,
  substr(sha256('[' || string_agg('{{"name": "' || field_name || '", "type": "' || new_type || '"}}', ', '
                                  ORDER BY field_name, new_type) || ']'), 1, 12) AS version_hash,
  '[' || string_agg('"' || field_name || '"', ',' ORDER BY field_name, new_type) || ']' AS fields_added,
  (SELECT max(ts) FROM events) AS change_time
FROM (SELECT field_name, new_type FROM ({SCHEMA_DIFF_SQL}) AS dd WHERE change = 'added') AS a""")
def schema_history(spark, d):
    """M5: history row for the fields the inferred trade records add to the
    events table, stamped with the newest event time."""
    ev = events(spark, d)
    ch = SO.schema_changes(SO.table_fields(ev), SO.infer_schema(_new_records(spark, d)))
    ch = ch.withColumn("table_id", F.lit("events"))
    now = ev.select(F.max("ts")).scalar()
    return SO.schema_history_rows(ch, change_time=now).withColumn(
        "change_time", F.col("change_time").cast("timestamp_ntz"))


@register("schema_compat", f"""WITH v AS (SELECT subject, rn, names, lag(names) OVER (PARTITION BY subject ORDER BY rn) AS old
    FROM ({PROPOSALS_SQL}) AS p)
SELECT subject, printf('v-%04d', CAST(rn AS INTEGER)) AS version_id,
  CASE WHEN rn > 1 THEN printf('v-%04d', CAST(rn - 1 AS INTEGER)) END AS previous_version,
  {', '.join(f"""{_ok_sql('old', 'names', f"'{m}'")} AS {m}_ok""" for m in SO.COMPATIBILITY_MODES)}
FROM v""")
def schema_compat(spark, d):
    """M8 over a registry that holds every daily proposal as a version."""
    p = _proposals(spark, d)
    n = F.row_number().over(Window.partitionBy("subject").orderBy("proposed_at"))
    return SO.compatibility_report(p.select(
        "subject", F.format_string("v-%04d", n).alias("version_id"), "schema_definition",
        F.col("proposed_at").alias("created_at")))
