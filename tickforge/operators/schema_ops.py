"""Schema tooling as DataFrame jobs.

Schemas are plain tables of fields (field_name, field_type). Inference runs
distributed over the records: each JSON record is exploded into (key, value
type) pairs by the JVM, so no record ever reaches the driver.
"""

from __future__ import annotations

import json

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from .. import fixed as FX
from ..functions.columns import order_key

# Precedence when one field shows several types (STRING only if nothing else).
TYPE_PRECEDENCE = list(FX.TYPE_PRECEDENCE)
COMPATIBILITY_MODES = list(FX.COMPATIBILITY_MODES)

_SPARK_TO_WAREHOUSE = [
    ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), "INTEGER"),
    ((T.FloatType, T.DoubleType, T.DecimalType), "FLOAT64"),
    ((T.BooleanType,), "BOOLEAN"),
    ((T.TimestampType, T.TimestampNTZType), "TIMESTAMP"),
    ((T.DateType,), "DATE"),
    ((T.ArrayType,), "REPEATED"),
    ((T.StructType, T.MapType), "RECORD"),
]
_WAREHOUSE_TO_SPARK = {"INTEGER": "bigint", "FLOAT64": "double", "BOOLEAN": "boolean",
                       "TIMESTAMP": "timestamp", "DATE": "date", "STRING": "string",
                       "RECORD": "string", "REPEATED": "string"}


def warehouse_type(dt: T.DataType) -> str:
    """Spark type -> warehouse type name (INTEGER, FLOAT64, ..., STRING)."""
    for classes, name in _SPARK_TO_WAREHOUSE:
        if isinstance(dt, classes):
            return name
    return "STRING"


def _variant_type(v: Column) -> Column:
    """JSON value -> warehouse type name (null -> STRING like a missing type)."""
    t = F.schema_of_variant(v)
    return (F.when(t.startswith("OBJECT"), "RECORD")
             .when(t.startswith("ARRAY"), "REPEATED")
             .when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "INTEGER")
             .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), "FLOAT64")
             .when(t == "BOOLEAN", "BOOLEAN")
             .when(t == "DATE", "DATE")
             .when(t.startswith("TIMESTAMP"), "TIMESTAMP")
             .otherwise("STRING"))


def infer_schema(records: DataFrame, json_col: str = "json", group_cols=()) -> DataFrame:
    """M1: union of keys over JSON object records; one type per key: the only
    type seen, else the first non-STRING type in ``TYPE_PRECEDENCE``.
    Output (*group_cols, field_name, field_type, n_records), one schema per
    group (whole input when ``group_cols`` is empty).

    Records are exploded to (key, type) pairs in the JVM and reduced per
    (group, key, type) with partial aggregation; the per-key type set is
    bounded by the 8 type names, so no group ever gathers records."""
    g = list(group_cols)
    rid = records.select(*g, F.col(json_col).alias("_j"),
                         F.monotonically_increasing_id().alias("_rid"))
    kv = rid.select(*g, "_rid", F.posexplode(F.from_json("_j", "map<string,variant>"))
                    .alias("_pos", "field_name", "_v"))
    typed = kv.select(*g, "_rid", "_pos", "field_name", _variant_type(F.col("_v")).alias("_t"))
    # first appearance as a fixed-width key -> hash aggregate, no sort of all pairs
    first = order_key(F.col("_rid"), F.col("_pos"), primary_is_time=False)
    per_type = typed.groupBy(*g, "field_name", "_t").agg(
        F.count(F.lit(1)).alias("_n"), F.min(first).alias("_first"))
    prec = F.array(*[F.lit(t) for t in TYPE_PRECEDENCE])
    per_type = per_type.withColumn("_rank", F.array_position(prec, F.col("_t")))
    agg = per_type.groupBy(*g, "field_name").agg(
        F.min("_rank").alias("_best"), F.sum("_n").alias("n_records"))
    return (agg.select(*g, "field_name",
                       F.element_at(prec, F.col("_best").cast("int")).alias("field_type"),
                       "n_records"))


def fields_map(fields: DataFrame, group_cols=()) -> DataFrame:
    """Field rows -> one map<string,string> (name -> type) per group; a
    schema is as wide as its field list, never as long as the data."""
    return fields.groupBy(*group_cols).agg(F.map_from_entries(F.collect_list(
        F.struct("field_name", "field_type"))).alias("fields"))


def table_fields(df: DataFrame) -> DataFrame:
    """M2: schema of a DataFrame/table as rows (position, field_name, field_type)."""
    rows = [(i, f.name, warehouse_type(f.dataType)) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "position int, field_name string, field_type string")


def schema_changes(current: DataFrame | None, new: DataFrame) -> DataFrame:
    """M3 + J4: full outer join of field tables by name -> change
    added / removed / modified (type differs) / unchanged. A missing current
    schema makes every new field ``added``."""
    n = new.select("field_name", F.col("field_type").alias("new_type"))
    if current is None:
        return n.select("field_name", F.lit(None).cast("string").alias("current_type"),
                        "new_type", F.lit("added").alias("change"))
    c = current.select("field_name", F.col("field_type").alias("current_type"))
    j = c.join(n, "field_name", "full_outer")
    change = (F.when(F.col("current_type").isNull(), "added")
               .when(F.col("new_type").isNull(), "removed")
               .when(F.col("current_type") != F.col("new_type"), "modified")
               .otherwise("unchanged"))
    return j.select("field_name", "current_type", "new_type", change.alias("change"))


def evolve_schema(df: DataFrame, new_fields: list[tuple[str, str]], dry_run: bool = False):
    """M4: append absent fields as NULL columns (add-only). Fields already
    present are reported, never duplicated or retyped. Returns
    (evolved DataFrame, report dict); dry_run returns the input unchanged."""
    have = {c.lower(): c for c in df.columns}
    add = [(n, t) for n, t in new_fields if n.lower() not in have]
    exist = [n for n, _ in new_fields if n.lower() in have]
    report = {"added": [n for n, _ in add], "already_present": exist, "dry_run": dry_run}
    if dry_run or not add:
        return df, report
    return df.select("*", *[F.lit(None).cast(_WAREHOUSE_TO_SPARK.get(t, "string")).alias(n)
                            for n, t in add]), report


def evolve_table(spark: SparkSession, table: str, new_fields: list[tuple[str, str]],
                 dry_run: bool = False) -> list[str]:
    """M4 on a catalog table: ALTER TABLE ... ADD COLUMNS for absent fields."""
    have = {c.lower() for c in spark.table(table).columns}
    add = [(n, t) for n, t in new_fields if n.lower() not in have]
    if add and not dry_run:
        cols = ", ".join(f"`{n}` {_WAREHOUSE_TO_SPARK.get(t, 'string')}" for n, t in add)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")
    return [n for n, _ in add]


def _py_json_fields(arr: Column) -> Column:
    """Text of Python ``json.dumps([{"name":..,"type":..}, ...], sort_keys=True)``
    for an array of (name, type) structs (fixed format: ", " and ": ")."""
    item = F.transform(arr, lambda s: F.concat(F.lit('{"name": "'), s["name"],
                                               F.lit('", "type": "'), s["type"], F.lit('"}')))
    return F.concat(F.lit("["), F.array_join(item, ", "), F.lit("]"))


def schema_history_rows(changes: DataFrame, table_col: str = "table_id",
                        change_time=None) -> DataFrame:
    """M5: one history row per table for its added fields: version_hash = first
    12 hex chars of SHA-256 over the canonical JSON of added fields,
    fields_added = JSON array of names."""
    added = changes.filter(F.col("change") == "added")
    g = added.groupBy(table_col).agg(
        F.array_sort(F.collect_list(F.struct(F.col("field_name").alias("name"),
                                             F.col("new_type").alias("type")))).alias("_f"))
    ct = F.current_timestamp() if change_time is None else F.lit(change_time)
    return g.select(table_col,
                    F.substring(F.sha2(_py_json_fields(F.col("_f")), 256), 1, FX.HISTORY_HASH_CHARS).alias("version_hash"),
                    F.to_json(F.transform("_f", lambda s: s["name"])).alias("fields_added"),
                    ct.alias("change_time"))


@F.pandas_udf(T.StringType())
def canonical_definition(definitions: pd.Series) -> pd.Series:
    """Whole definitions as JSON with sorted keys at every level (", " and ": " between items);
    what is not JSON is NULL."""
    def one(text):
        try:
            return json.dumps(json.loads(text), sort_keys=True)
        except (TypeError, ValueError):
            return None
    return definitions.map(one)


def schema_hash(definition: Column) -> Column:
    """M9: SHA-256 hex of the canonical text of a whole definition."""
    return F.sha2(canonical_definition(definition), 256)


def field_names(definition: Column) -> Column:
    """Names under "fields" of a definition; none if it has no fields."""
    fields = F.from_json(definition, "struct<fields: map<string,string>>")["fields"]
    return F.when(definition.isNotNull(), F.coalesce(F.map_keys(fields), F.array().cast("array<string>")))


def compatible(old_names: Column, new_names: Column, mode: Column) -> Column:
    """M8: name-level compatibility of two field-name arrays.
    backward: nothing removed; forward: nothing added; full: same names;
    none: always. A missing old schema is always compatible."""
    kept = F.size(F.array_except(old_names, new_names)) == 0
    nothing_new = F.size(F.array_except(new_names, old_names)) == 0
    m = F.lower(mode)
    asked = (~m.isin("backward", "full") | kept) & (~m.isin("forward", "full") | nothing_new)
    return F.when(old_names.isNull(), True).otherwise(asked)


def _fits(old: list | None, new: list | None, mode: str | None) -> bool:
    """``compatible`` of plain values."""
    if old is None:
        return True
    # A missing mode asks for both, and a definition without names passes no check.
    known, old = new is not None, set(old)
    kept, nothing_new = known and old <= set(new), known and set(new) <= old
    return (mode not in (None, "backward", "full") or kept) and (mode not in (None, "forward", "full") or nothing_new)


_KNOWN, _NEWEST, _RUN = 0, 1, 2


def _decide(batches):
    """Decisions on proposal runs, in one pass over rows sorted by (subject, kind, run). Of a subject only
    what is registered is held: hashes, the newest field names and version number."""
    subject, known, names, number, started = None, set(), None, 0, False
    for batch in batches:
        out = {"subject": [], "run": [], "status": [], "number": []}
        for r in batch.to_pylist():
            if not started or r["subject"] != subject:
                subject, known, names, number, started = r["subject"], set(), None, 0, True
            if r["kind"] == _KNOWN:
                known.add(r["hash"])
            elif r["kind"] == _NEWEST:
                names, number = r["names"], r["run"]
            else:
                status = "duplicate" if r["hash"] in known else "registered" if _fits(names, r["names"], r["mode"]) else "incompatible"
                if status == "registered":
                    known.add(r["hash"])
                    names, number = r["names"], number + 1
                for k, v in zip(out, (subject, r["run"], status, number)):
                    out[k].append(v)
        yield pa.RecordBatch.from_pydict(out, schema=_DECIDED)


_DECIDED = pa.schema([("subject", pa.string()), ("run", pa.int64()), ("status", pa.string()), ("number", pa.int32())])


def register_schemas(registry: DataFrame, proposals: DataFrame,
                     created_by: str = FX.REGISTRY_CREATED_BY):
    """M6: every proposal decided, in order of ``proposed_at`` per subject, many subjects in one job.

    ``registry``: rows shaped like ``schemas.SCHEMA_REGISTRY``.
    ``proposals``: (subject, schema_definition JSON, compatibility_mode, description, proposed_at).
    A proposal is ``duplicate`` when its hash is registered by then, ``incompatible`` when the
    mode's check against the newest version by then fails, else ``registered`` as the next
    version v-NNNN. A definition that was rejected may pass later against a newer version.
    Returns (new registry rows with the definitions as proposed, decisions).

    Neighbouring proposals with the same hash and mode meet the same registry, so each run of them
    is decided once. Runs are folded in order as they stream by, subject after subject: a task holds
    what a subject has registered, never its proposals."""
    order = Window.partitionBy("subject").orderBy("proposed_at", "schema_hash", "mode")
    p = proposals.withColumns({"schema_hash": schema_hash(F.col("schema_definition")),
                               "names": field_names(F.col("schema_definition")),
                               "mode": F.lower("compatibility_mode")})
    same = F.lag("schema_hash").over(order).eqNullSafe(F.col("schema_hash")) \
        & F.lag("mode").over(order).eqNullSafe(F.col("mode"))
    p = p.withColumn("_new", F.when(same, 0).otherwise(1))
    p = p.withColumns({"run": F.sum("_new").over(order),
                       "_nth": F.row_number().over(order)})
    runs = (p.groupBy("subject", "run").agg(F.any_value("schema_hash").alias("hash"), F.any_value("names").alias("names"),
                                            F.any_value("mode").alias("mode"))
            .select("subject", F.lit(_RUN).alias("kind"), F.col("run").cast("long").alias("run"), "hash", "names", "mode"))
    none = F.lit(None).cast("string")
    newest = latest_schemas(registry).select(
        "subject", F.lit(_NEWEST).alias("kind"), F.split("version_id", "-").getItem(1).cast("long").alias("run"),
        none.alias("hash"), field_names(F.col("schema_definition")).alias("names"), none.alias("mode"))
    known = registry.select("subject", F.lit(_KNOWN).alias("kind"), F.lit(0).cast("long").alias("run"),
                            F.col("schema_hash").alias("hash"), F.lit(None).cast("array<string>").alias("names"), none.alias("mode"))
    decided = (known.unionByName(newest).unionByName(runs).repartition("subject")
               .sortWithinPartitions("subject", "kind", "run")
               .mapInArrow(_decide, "subject string, run long, status string, number int"))
    first = F.row_number().over(Window.partitionBy("subject", "run").orderBy("_nth")) == 1
    j = p.withColumn("_leads", first).join(decided, ["subject", "run"])
    # Behind the first of a run, what was registered is known.
    status = F.when((F.col("status") == "registered") & ~F.col("_leads"), "duplicate").otherwise(F.col("status"))
    j = j.withColumn("status", status).withColumn(
        "version_id", F.when(F.col("status") == "registered", F.format_string(FX.VERSION_FORMAT, F.col("number"))))
    decisions = j.select("subject", "proposed_at", "schema_hash", "status", "version_id")
    newest = F.max("number").over(Window.partitionBy("subject"))
    new_rows = (j.filter("status = 'registered'")
                 .select("subject", "version_id", "schema_hash", "schema_definition",
                         F.col("mode").alias("compatibility_mode"), (F.col("number") == newest).alias("is_active"),
                         F.col("proposed_at").cast("timestamp").alias("created_at"),
                         F.lit(created_by).alias("created_by"), "description"))
    return new_rows, decisions


def with_active_flag(registry: DataFrame) -> DataFrame:
    """M7 deactivation as a derived column: only the newest version of each
    subject is active (no UPDATE needed on immutable files)."""
    w = Window.partitionBy("subject").orderBy(F.col("created_at").desc(), F.col("version_id").desc())
    return registry.withColumn("is_active", F.row_number().over(w) == 1)


def latest_schemas(registry: DataFrame) -> DataFrame:
    """Newest version per subject."""
    w = Window.partitionBy("subject").orderBy(F.col("created_at").desc(), F.col("version_id").desc())
    return registry.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def schema_by_hash(registry: DataFrame, subject: str, h: str) -> DataFrame:
    """M7: the registry row of ``subject`` with schema hash ``h`` (at most one)."""
    return registry.filter((F.col("subject") == subject) & (F.col("schema_hash") == h)).limit(1)


def schema_history(registry: DataFrame, subject: str | None = None) -> DataFrame:
    """M7: versions of a subject (or all), newest first."""
    df = registry if subject is None else registry.filter(F.col("subject") == subject)
    return df.orderBy(F.col("created_at").desc())


def compatibility_report(registry: DataFrame) -> DataFrame:
    """M8 over the whole registry: every version against its predecessor,
    under every mode (one job, lag over consecutive versions)."""
    w = Window.partitionBy("subject").orderBy("created_at", "version_id")
    r = (registry.withColumn("_new", field_names(F.col("schema_definition")))
                 .withColumn("_old", F.lag("_new").over(w))
                 .withColumn("previous_version", F.lag("version_id").over(w)))
    return r.select("subject", "version_id", "previous_version",
                    *[compatible(F.col("_old"), F.col("_new"), F.lit(m)).alias(f"{m}_ok")
                      for m in COMPATIBILITY_MODES])
