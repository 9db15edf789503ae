"""Public accessors used by ``__spark_entry__``."""

from .catalog import REGISTRY
# Modules that register entries (import order = key order).
from . import q_rollups, q_series, q_analytics, q_ingest, q_ops, q_stream, q_sinks  # noqa: F401


def queries():
    return {k: e.fn for k, e in REGISTRY.items()}


def oracle_sql():
    return {k: e.oracle() for k, e in REGISTRY.items() if e.sql is not None}
