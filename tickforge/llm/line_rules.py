"""Quality rules with cross-document line frequency, in DataFrame functions only.

Base figures of each text come from its own words and lines. The method then
hashes every normalised line (lower case, runs of white space as one blank),
counts the documents of each host that hold it, removes lines found in more than ``max_share``
of the host's documents and more than ``few`` of them, and rejects documents that lose more
than ``max_lost`` of their words that way.

Plan: one narrow pass for the figures; one pass that explodes distinct line
hashes of a document and counts them with map-side combining; the frequent
lines (few) are written, and joined back by broadcast only when their counted
number is within ``BROADCAST_LINES``, else by a shuffled join that adaptive
execution splits where a line is hot. Texts are never shuffled.

Defined results: null or empty texts have no words, so their base rule fails
and they are rejected; a null host counts as the host ''; rows that repeat
(same id, host and text) each count as a document and each get their row; very long
texts are handled whole; a line found in just the limit of documents stays, and a document that loses just
``max_lost`` of its words is kept; other columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import small_side, written

BLANKS = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[^#*$%&|<>]+"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# Method: a line with at least MIN_LINE_WORDS words is frequent in a host when more than MAX_SHARE
# of its documents, and more than FEW, hold it.
MIN_LINE_WORDS = 1
MAX_SHARE = 0.1
FEW = 4
MAX_LOST = 0.5
# Two longs and a string per frequent line: a million of them stay near 100 MB.
BROADCAST_LINES = 1_000_000


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated_words(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more in ``hashes``:
    windows sorted by hash, those equal to a neighbour kept, their positions
    sorted again and the covered lengths added up."""
    def covered(s):
        same = F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["v"] == x["v"], F.lit(False))
                        | F.coalesce(F.get(s, k + 1)["v"] == x["v"], F.lit(False)))
        at = F.sort_array(F.transform(same, lambda x: x["i"]))
        return F.aggregate(
            at, F.struct(F.lit(0).alias("e"), F.lit(0).alias("n")),
            lambda a, i: F.struct((i + WINDOW).alias("e"),
                                  (a["n"] + i + WINDOW - F.greatest(a["e"], i)).alias("n")),
            lambda a: a["n"])
    by_hash = F.sort_array(F.transform(hashes, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
        _let(by_hash, covered))


def _lines(text: Column) -> Column:
    """Lines (split at \\n) that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))


def _normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, BLANKS, " ")))


def _hashed_lines(text: Column) -> Column:
    """(hash, words) of every line with a word, in order."""
    return F.transform(_lines(text), lambda x: _let(_normal(x), lambda y: F.struct(
        F.xxhash64(y).alias("h"), F.size(F.split(y, " ")).cast("long").alias("w"))))


def _keyed(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
                       F.xxhash64(F.col(id_col).cast("long"), text).alias("key"), text.alias("text"))


def base_figures(keyed: DataFrame) -> DataFrame:
    """Base figures and hashed lines of each row; the text itself is left behind."""
    t = F.col("text")
    d = keyed.withColumn("words", F.array_remove(F.split(t, BLANKS), ""))
    d = d.withColumn("hashes", F.when(F.size("words") < WINDOW, F.array().cast("array<long>")).otherwise(
        _let(F.transform("words", lambda w: F.xxhash64(w)),
             lambda ws: F.transform(F.sequence(F.lit(1), F.size(ws) - (WINDOW - 1)),
                                    lambda i: F.xxhash64(F.slice(ws, i, WINDOW))))))
    d = d.withColumn("lines", _lines(t))
    return d.select(
        "doc_id", "host", "key", F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace(t, BLANKS, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(t, SYMBOLS, "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("hashes")).cast("long").alias("n_repeat_words"))


def frequent_lines(keyed: DataFrame, max_share: float = MAX_SHARE, few: int = FEW,
                   min_line_words: int = MIN_LINE_WORDS) -> DataFrame:
    """(host, h, n_docs): lines held by more than ``max_share`` and more than ``few`` of a host's
    documents. A document counts once per line; the count combines before the shuffle."""
    found = F.filter(_hashed_lines(F.col("text")), lambda x: x["w"] >= min_line_words)
    rows = keyed.select("host", F.explode(F.array_distinct(F.transform(found, lambda x: x["h"]))).alias("h"))
    lines = rows.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") > few)
    hosts = written(keyed.groupBy("host").agg(F.count(F.lit(1)).alias("docs")), "host-sizes")
    return (lines.join(small_side(hosts), "host").filter(F.col("n_docs") > max_share * F.col("docs"))
            .select("host", "h", "n_docs"))


def _lost_words(keyed: DataFrame, frequent: DataFrame, min_line_words: int) -> DataFrame:
    """(host, key, lost): words in frequent lines, for rows that have any; one row per distinct
    (host, key), so rows that repeat are not added up."""
    frequent = written(frequent.select("host", "h"), "frequent-lines")
    if frequent.count() <= BROADCAST_LINES:
        frequent = F.broadcast(frequent)
    rows = (keyed.select("host", "key", F.posexplode(_hashed_lines(F.col("text"))).alias("pos", "l"))
            .select("host", "key", "pos", F.col("l.h").alias("h"), F.col("l.w").alias("w"))
            .filter(F.col("w") >= min_line_words))
    return (rows.join(frequent, ["host", "h"]).groupBy("host", "key", "pos").agg(F.max("w").alias("w"))
            .groupBy("host", "key").agg(F.sum("w").alias("lost")))


def without_frequent_lines(docs: DataFrame, frequent: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           host_col: str = "source", min_line_words: int = MIN_LINE_WORDS) -> DataFrame:
    """(doc_id, host, text): texts with the lines of ``frequent`` taken out. Lines are
    joined one by one and put together again by document."""
    keyed = _keyed(docs, id_col, text_col, host_col)
    lines = keyed.select("doc_id", "host", "key", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.withColumn("h", F.xxhash64(_normal(F.col("line"))))
    marked = lines.join(frequent.select("host", "h", F.lit(True).alias("bad")), ["host", "h"], "left")
    kept = F.when(F.col("bad").isNull() | (F.size(F.split(_normal(F.col("line")), " ")) < min_line_words),
                  F.struct("pos", "line"))
    return (marked.groupBy("doc_id", "host", "key")
            .agg(F.array_sort(F.collect_set(kept)).alias("lines"))
            .select("doc_id", "host", F.array_join(F.col("lines.line"), "\n").alias("text")))


def line_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
               max_share: float = MAX_SHARE, few: int = FEW, min_line_words: int = MIN_LINE_WORDS,
               max_lost: float = MAX_LOST) -> DataFrame:
    """One row per input row: the base figures, ``base_failed``, words lost with
    frequent lines (``n_line_words_removed``) and ``kept``."""
    keyed = _keyed(docs, id_col, text_col, host_col)
    lost = _lost_words(keyed, frequent_lines(keyed, max_share, few, min_line_words), min_line_words)
    figures = base_figures(keyed)
    out = figures.join(lost, ["host", "key"], "left")
    removed = F.coalesce("lost", F.lit(0).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), removed.alias("n_line_words_removed"),
                      (~failed & (removed <= max_lost * F.col("n_words"))).alias("kept"))
