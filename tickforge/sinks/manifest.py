"""Pointers to the live files of a table: numbered JSON documents, committed by one rename.

A writer prepares files nobody reads yet and then commits the next version of the document that names
the live ones. Readers take the newest version and see all of a change or nothing of it. The rename does not
replace an existing file, so of two writers that start from the same version one fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

FOLDER = "_manifest"
KEEP = 8                        # versions that stay readable


class ConcurrentUpdate(RuntimeError):
    """Another writer committed the version first."""


def filesystem(spark: SparkSession, path: str):
    """(file system, path) of the JVM."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def folders(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names of the folders in ``path`` that begin with ``prefix``."""
    fs, p = filesystem(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p)
                  if s.isDirectory() and s.getPath().getName().startswith(prefix))


def remove(spark: SparkSession, path: str) -> None:
    fs, p = filesystem(spark, path)
    fs.delete(p, True)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes under a folder."""
    fs, p = filesystem(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, oldest first."""
    fs, p = filesystem(spark, f"{root}/{FOLDER}")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read(spark: SparkSession, root: str, below: int | None = None) -> tuple[int, dict]:
    """(version, document) of the newest version, or of the newest one below ``below``; (-1, {}) if none."""
    found = [v for v in versions(spark, root) if below is None or v < below]
    if not found:
        return -1, {}
    fs, p = filesystem(spark, f"{root}/{FOLDER}/{found[-1]:012d}.json")
    stream = fs.open(p)
    try:
        return found[-1], json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, root: str, version: int, document: dict) -> None:
    """Make ``document`` the version ``version`` of the table; older versions beyond ``KEEP`` go."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs, draft = filesystem(spark, f"{root}/{FOLDER}/.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(document, sort_keys=True).encode()))
    out.close()
    final = jvm.org.apache.hadoop.fs.Path(f"{root}/{FOLDER}/{version:012d}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        if fs.exists(final):
            raise ConcurrentUpdate(f"version {version} of {root} is there")
        context.rename(draft, final, gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(e):
            raise ConcurrentUpdate(f"version {version} of {root} is there") from e
        raise
    for v in versions(spark, root)[:-KEEP]:
        remove(spark, f"{root}/{FOLDER}/{v:012d}.json")
