"""Tables whose live folders a manifest names: atomic keyed upserts (K9) and compaction of
per-batch folders (K1-K3).

Partitions are folders ``<partition column>=<value>``; every write puts its partitions under a folder
of its own, and the manifest maps each value to the folders that are live.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialize, scratch_scope
from . import manifest as M
from .tables import merge_rows, write_table

DATA = "data"
TARGET_BYTES = 128 << 20
SMALL_FOLDERS = 4               # live folders of a partition before they are packed


def _values(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """Partition value -> folder name, in a written folder."""
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return {unescape(n[len(column) + 1:]): n for n in M.folders(spark, path, f"{column}=")}


def _load(spark: SparkSession, root: str, live: list[str]) -> DataFrame:
    """Rows of the folders ``live`` (relative to ``root``); partition columns come from their names."""
    out = spark.read.option("basePath", root).parquet(*[f"{root}/{x}" for x in live])
    return out.drop("v", "batch_id")


def read_table(spark: SparkSession, path: str, values=None) -> DataFrame | None:
    """The table as of its newest version, only the partitions with ``values`` if given; None if there is
    nothing."""
    _, doc = M.read(spark, path)
    live = [x for v, x in doc.get("partitions", {}).items() if values is None or v in values]
    return _load(spark, f"{path}/{DATA}", live) if live else None


def upsert(spark: SparkSession, path: str, updates: DataFrame, keys, partition_col: str) -> int:
    """K9: keyed upsert into a partitioned table, all partitions at once; returns the new version. Only
    the partitions in ``updates`` are read and written, into a new folder; one manifest commit
    makes them live. A failure before it leaves the old table as it is, and a writer that
    started from the same version gets ``ConcurrentUpdate``."""
    with scratch_scope(spark):
        updates = materialize(updates, "upsert-updates")
        version, doc = M.read(spark, path)
        before = doc.get("partitions", {})
        # One value per touched partition: metadata.
        touched = {"__HIVE_DEFAULT_PARTITION__" if r[0] is None else r[0]
                   for r in updates.select(F.col(partition_col).cast("string")).distinct().collect()}
        merged = updates
        current = [before[v] for v in sorted(touched) if v in before]
        if current:
            cur = _load(spark, f"{path}/{DATA}", current)
            cur = cur.select(*[F.col(f.name).cast(f.dataType) for f in updates.schema.fields])
            merged = merge_rows(cur, updates, keys)
        folder = f"v={version + 1}-{uuid.uuid4().hex[:8]}"
        write_table(merged, f"{path}/{DATA}/{folder}", [partition_col], mode="overwrite")
        written = _values(spark, f"{path}/{DATA}/{folder}", partition_col)
        live = {**before, **{v: f"{folder}/{name}" for v, name in written.items()}}
        try:
            M.commit(spark, path, version + 1, {"partitions": live})
        except M.ConcurrentUpdate:
            M.remove(spark, f"{path}/{DATA}/{folder}")
            raise
    return version + 1


def vacuum(spark: SparkSession, path: str) -> int:
    """Remove partition folders that no readable version names; returns how many. Not while an upsert runs."""
    used = set()
    for v in M.versions(spark, path):
        used |= set(M.read(spark, path, v + 1)[1].get("partitions", {}).values())
    gone = 0
    for folder in M.folders(spark, f"{path}/{DATA}", "v="):
        inside = M.folders(spark, f"{path}/{DATA}/{folder}")
        unused = [x for x in inside if f"{folder}/{x}" not in used]
        for x in [folder] if len(unused) == len(inside) else [f"{folder}/{x}" for x in unused]:
            M.remove(spark, f"{path}/{DATA}/{x}")
        gone += len(unused)
    return gone


# ---------------------------------------------------------------- folders per micro-batch

def _batches(spark: SparkSession, path: str) -> list[int]:
    """Complete batch folders."""
    out = []
    for name in M.folders(spark, path, "batch_id="):
        if not name[len("batch_id="):].isdigit():          # packed
            continue
        fs, p = M.filesystem(spark, f"{path}/{name}/_SUCCESS")
        if fs.exists(p):
            out.append(int(name[len("batch_id="):]))
    return sorted(out)


def _live(spark: SparkSession, path: str, column: str | None, doc: dict, upto: int | None = None) -> dict[str, list[str]]:
    """Partition value ('' without partitions) -> live folders."""
    live = {v: list(x) for v, x in doc.get("folders", {}).items()}
    for n in _batches(spark, path):
        if n > doc.get("upto", -1) and (upto is None or n <= upto):
            # A batch without rows may have no file to take a schema from.
            found = _values(spark, f"{path}/batch_id={n}", column) if column else \
                {"": ""} if M.size_of(spark, f"{path}/batch_id={n}") else {}
            for value, name in found.items():
                live.setdefault(value, []).append(f"batch_id={n}/{name}".rstrip("/"))
    return live


def read_batches(spark: SparkSession, path: str, partition_col: str | None = None) -> DataFrame | None:
    """Rows of all complete batches, packed or not, each once; None if there are none."""
    live = _live(spark, path, partition_col, M.read(spark, path)[1])
    every = [x for found in live.values() for x in found]
    return _load(spark, path, every) if every else None


def compact(spark: SparkSession, path: str, partition_col: str | None = None, cluster_by=(),
            target_bytes: int = TARGET_BYTES, small_folders: int = SMALL_FOLDERS) -> int:
    """Pack the folders of complete batches into files of about ``target_bytes`` per partition; returns
    how many folders went into it. A partition is packed when more than ``small_folders`` of its live
    folders are smaller than the target; large ones stay as they are, so no byte is packed often. The newest
    batch stays out, as a stream may replay it. One commit swaps old folders for new ones; what a
    compaction replaces is removed by the next one, when its readers are gone."""
    version, doc = M.read(spark, path)
    batches = _batches(spark, path)
    if len(batches) < 2:
        return 0
    upto = max(batches[-2], doc.get("upto", -1))
    live = _live(spark, path, partition_col, doc, upto)
    packed, bins, total = {}, 0, 0
    for value, found in live.items():
        sizes = {x: M.size_of(spark, f"{path}/{x}") for x in found}
        small = [x for x in found if sizes[x] < target_bytes]
        if len(small) > small_folders:
            packed[value] = small
            bins += -(-sum(sizes[x] for x in small) // target_bytes)
            total += len(small)
    folder = f"batch_id=c{version + 1}-{uuid.uuid4().hex[:8]}"
    if packed:
        rows = _load(spark, path, [x for small in packed.values() for x in small])
        by = [c for c in (partition_col, *cluster_by) if c]
        rows = rows.repartitionByRange(max(1, bins), *by) if by else rows.repartition(max(1, bins))
        write_table(rows, f"{path}/{folder}", [partition_col] if partition_col else (), cluster_by, mode="overwrite")
        new = _values(spark, f"{path}/{folder}", partition_col) if partition_col else {"": ""}
        for value, small in packed.items():
            gone = set(small)
            live[value] = [x for x in live[value] if x not in gone] + [f"{folder}/{new[value]}".rstrip("/")]
    M.commit(spark, path, version + 1, {"folders": live, "upto": upto,
                                        "replaced": [x for small in packed.values() for x in small]})
    for x in doc.get("replaced", []):
        M.remove(spark, f"{path}/{x}")
    return total
