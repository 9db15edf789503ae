"""Small helpers shared by the text operators."""

from __future__ import annotations

import sys
import types
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import scratch_path


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null: empty), whatever else the table carries."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def utf8(column: pa.Array) -> list[bytes]:
    """An Arrow string column as UTF-8 byte strings (null: empty)."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def in_parts(batch: pa.RecordBatch, column: str, limit: int = 16 << 20):
    """Slices of an Arrow batch with about ``limit`` bytes of ``column`` each, so
    that what a task holds does not depend on how long the texts are."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield batch.slice(start)


def filter_rows(docs: DataFrame, make_test, text_col: str = "text", limit: int = 2 << 20) -> DataFrame:
    """Rows of ``docs``, all columns as they are, that pass a test of their text. ``make_test``
    is called once per task and returns a function from UTF-8 texts (null: empty) to booleans."""
    def run(batches):
        test = make_test()
        for batch in batches:
            for part in in_parts(batch, text_col, limit):
                yield part.filter(pa.array(test(utf8(part.column(text_col))), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def process_cache(name: str) -> types.SimpleNamespace:
    """A namespace that lives as long as the Python worker does, so that models
    and word caches are built once per process and not once per task."""
    home = sys.modules.setdefault("_text_operator_cache", types.ModuleType("_text_operator_cache"))
    if not hasattr(home, name):
        setattr(home, name, types.SimpleNamespace())
    return getattr(home, name)


def written(df: DataFrame, name: str, fmt: str = "parquet", **options) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends in
    files that survive lost executors."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.format(fmt).options(**options).save(path)
    out = spark.read.schema(df.schema).format(fmt).load(path)
    out._written_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove the files of ``written`` tables that nothing to come reads."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t._written_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def sorted_groups(batches, keys: list[str]):
    """Consecutive rows with equal ``keys`` out of sorted Arrow batches, each group as one
    record batch. Only the group at hand is held."""
    held: list[pa.RecordBatch] = []

    def joined():
        return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        change = np.zeros(n, bool)
        for k in keys:
            v = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        here = [batch.column(k)[0].as_py() for k in keys]
        if held and here != last:
            yield joined()
            held = []
        cuts = [0, *np.flatnonzero(change).tolist(), n]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a:
                yield joined()
                held = []
            held.append(batch.slice(a, b - a))
        last = [batch.column(k)[n - 1].as_py() for k in keys]
    if held:
        yield joined()


def least_of(rows: DataFrame, group: str, by: str, n: int, salts: int = 256) -> DataFrame:
    """At most ``n`` rows of each ``group``, those with the least ``by`` (a 64-bit hash): first within salts of the
    group, so that no task gets what all tasks pass on, then among what these left."""
    salted = rows.withColumn("__salt", F.pmod(F.col(by), F.lit(salts)))
    for part in ((group, "__salt"), (group,)):
        nth = F.row_number().over(Window.partitionBy(*part).orderBy(by))
        salted = salted.withColumn("__nth", nth).filter(F.col("__nth") <= n)
    return salted.drop("__nth", "__salt")


def small_side(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """``df`` (few short columns, already written) marked for broadcast if it has at most
    ``rows`` rows; else as it is, for a shuffled join that adaptive execution splits where hot."""
    return F.broadcast(df) if df.count() <= rows else df
