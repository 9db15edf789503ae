"""Corpus pipeline: quality filter, near-dedup, exact-substring dedup, benchmark
decontamination, subword encoding.

Every stage takes (spark, docs, sf_dir) and works on all rows the one before kept; all but
the last return the columns of ``documents``. ``run`` writes each stage to the shared folder and
reads it again, so a later stage never computes an earlier one anew.

Defined results: null and empty texts are scored like any text by the classifier, link with nothing and hold
no passage; rows without an id take part everywhere; rows that repeat in full stay or go together; texts whose
words all go in substring_dedup stay as rows without words; columns beyond those of ``documents`` pass
through; an empty table passes every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickforge.llm import decontaminate, hyperminhash, merge_dropout, passage_attention, suffix_dedup
from tickforge.llm.common import written
from tickforge.llm.queries import table, vocabulary

# No SQL: a learned classifier comes first. tests/llm checks the stages against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return passage_attention.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id: linked are
    sets of five-word shingles from 80 percent on and, as in op4, of three-word ones from 85 on."""
    return hyperminhash.keep_one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words or more that stand in an earlier place too; the first copy stays."""
    return suffix_dedup.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, checked by decoding them."""
    return merge_dropout.round_trip(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("decontamination", decontamination), ("encoding", encoding)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
