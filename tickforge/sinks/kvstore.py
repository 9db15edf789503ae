"""K4: a log-structured key-value table on Parquet folders.

Every batch of puts is written as a delta, in folders by the hour in which its items expire; nothing that
is there already is read or rewritten, so the bytes written follow the batch and not the table.
A commit of the manifest makes the whole batch visible. A put of an existing key wins because its
batch is newer: readers keep the newest item per key. An hour whose items have all expired on the data
clock leaves the manifest as a folder; items of hours that are still running are filtered when read. An hour with
more than ``MAX_DELTAS`` deltas is merged into one folder.

A batch that is put again after its commit changes nothing; one that failed before it is
written anew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from . import manifest as M
from .tables import newest_of

MAX_DELTAS = 8
BUCKET_SECONDS = 3600


class KvTable:
    """Items by ``keys``. ``order`` (descending, after the write order) decides between puts of a key;
    ``expires``: items are dropped when their ``ttl`` passes on the data clock, the newest
    ``timestamp`` put so far."""

    def __init__(self, spark: SparkSession, path: str, keys=("symbol", "timestamp"), order=("write_batch",),
                 expires: bool = True, bucket_seconds: int = BUCKET_SECONDS, max_deltas: int = MAX_DELTAS):
        self.spark, self.path, self.keys, self.order = spark, path, list(keys), list(order)
        self.expires, self.bucket_seconds, self.max_deltas = expires, bucket_seconds, max_deltas

    def _newest(self, rows: DataFrame) -> DataFrame:
        return newest_of(rows, self.keys, [F.col(c).desc_nulls_last() for c in self.order])

    def _load(self, folders: list[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{x}" for x in folders])

    def put(self, items: DataFrame, batch: int) -> None:
        """Put ``items`` (keys, ``timestamp``, ``ttl``, the order columns and any others) as batch ``batch``."""
        done = M.versions(self.spark, self.path)
        if done and done[-1] >= batch:
            return
        _, doc = M.read(self.spark, self.path)
        hours = {h: list(x) for h, x in doc.get("hours", {}).items()}
        bucket = F.floor(F.col("ttl") / F.lit(self.bucket_seconds)).cast("long") if self.expires else F.lit(0)
        delta, clock = f"delta/b={batch}", Observation()
        # A key's items of one batch are one.
        (self._newest(items).observe(clock, F.max("timestamp").alias("now"))
         .withColumn("hour", bucket).write.mode("overwrite").partitionBy("hour").parquet(f"{self.path}/{delta}"))
        now = max((x for x in (doc.get("now"), clock.get["now"]) if x is not None), default=None)
        for name in M.folders(self.spark, f"{self.path}/{delta}", "hour="):
            hours.setdefault(name[5:], []).append(f"{delta}/{name}")
        replaced = []
        for hour in list(hours):
            if self.expires and now is not None and (int(hour) + 1) * self.bucket_seconds <= now:
                replaced += hours.pop(hour)             # every ttl in it is under its end
            elif len(hours[hour]) > self.max_deltas:
                merged = f"merged/h={hour}/b={batch}-{uuid.uuid4().hex[:8]}"
                self._newest(self._load(hours[hour])).write.mode("overwrite").parquet(f"{self.path}/{merged}")
                replaced += hours[hour]
                hours[hour] = [merged]
        M.commit(self.spark, self.path, batch, {"hours": hours, "now": now, "replaced": replaced})
        # What the batch before replaced has no readers of the newest version any more.
        for x in doc.get("replaced", []):
            M.remove(self.spark, f"{self.path}/{x}")

    def read(self) -> DataFrame:
        """Live items as of the newest committed batch."""
        version, doc = M.read(self.spark, self.path)
        folders = [x for found in doc.get("hours", {}).values() for x in found]
        if not folders:
            raise FileNotFoundError(f"no items under {self.path}")
        rows = self._newest(self._load(folders))
        return rows.filter(F.col("ttl") > F.lit(doc["now"])) if self.expires else rows
