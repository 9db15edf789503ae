"""Registered queries: key -> (spark callable, oracle SQL).

Each callable takes (spark, sf_dir) and returns a DataFrame over the *whole*
driver tables; its oracle is DuckDB SQL over the same parquet views. Doubles
are rounded to 6 decimals on both sides (``rounded`` / ``rnd_sql``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import rnd_sql


@dataclass
class Entry:
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: tuple[str, ...] = field(default_factory=tuple)
    note: str = ""

    def oracle(self) -> str | None:
        return None if self.sql is None else rnd_sql(self.sql, *self.doubles)


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None, doubles=(), note: str = ""):
    def deco(fn):
        REGISTRY[name] = Entry(fn, sql, tuple(doubles), note)
        return fn
    return deco

