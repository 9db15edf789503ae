"""Named-parameter SQL with an optional cost-only dry run."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def execute_query(spark: SparkSession, query: str, parameters: dict | None = None,
                  dry_run: bool = False, **frames: DataFrame) -> DataFrame:
    """Run ``query`` with ``:name`` parameters bound by Spark (never spliced
    into the text). ``frames`` become ``{name}`` table references. With
    ``dry_run`` the plan and its cost estimate are returned instead of data."""
    if dry_run:
        return spark.sql("EXPLAIN COST " + query, args=parameters or {}, **frames)
    return spark.sql(query, args=parameters or {}, **frames)


def estimate(spark: SparkSession, query: str, parameters: dict | None = None, **frames: DataFrame) -> DataFrame:
    """A dry run as one row (valid, error, bytes): whether the query can be planned with its parameters, and the
    optimizer's estimate of the bytes its tables hold. Nothing is run."""
    try:
        plan = spark.sql(query, args=parameters or {}, **frames)._jdf.queryExecution().optimizedPlan()
        leaves = plan.collectLeaves()
        size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
        row = (True, None, size)
    except AnalysisException as e:
        row = (False, e.getCondition(), None)
    return spark.createDataFrame([row], "valid boolean, error string, bytes long")
