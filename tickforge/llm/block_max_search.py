"""Ranked lexical search by Block-Max MaxScore over an inverted index in shards.

Index: a task cuts its documents into shards of about ``SHARD_BYTES`` of text. A shard numbers its
documents in ascending id order and holds, per term, a list of postings in blocks of ``BLOCK``,
each compressed by itself (gaps and frequencies in 1, 2 or 4 bytes), with the last document and the
largest impact of each block beside it. A posting's impact is its score without the term's weight; as
the weight is one factor per term, largest impacts bound scores. All terms of all documents are indexed.

Search of a query in a shard, in windows of documents and with the k-th best score so far as
threshold:

1. Lists are sorted by their global bound (weight times largest impact). The longest prefix whose
   bounds add up to no more than the threshold is non-essential: no document
   of these lists alone can enter the heap. Only documents of the other, essential lists are candidates.
2. A window in which the block maxima of all lists add up to no more than the threshold is skipped.
3. Non-essential lists follow from the highest bound down. A candidate whose score so far, the
   list's block maximum there and the bounds of the lists below cannot beat the threshold is
   rejected; only blocks with a candidate left are decompressed.

The heaps of all shards are merged by rank. Bounds are exact integers, so results are those of
scoring every document. Queries are a stated set: they are read in blocks of ``BLOCK_WORDS`` words,
each sent to all tasks, and only the lists of their terms leave the index.

Defined results: null, empty or term-free texts are in no count and no result, queries without terms
have no rows; equal scores go by ascending id, rows without an id last; repeated rows are documents of
their own, repeated items queries of their own; very long texts are one document, indexed whole; other
columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import id_text, in_parts, sorted_groups, utf8, written
from .decontaminate import _blocks

K = 10
BLOCK = 128
SHARD_BYTES = 16 << 20
SPAN = 2048                     # documents of a window
BLOCK_WORDS = 500_000
SCALE = 1_000_000_000
KEPT_BLOCKS = 20_000            # decompressed blocks a search remembers in a shard

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_INDEX = ("shard long, term binary, df long, top long, last binary, peak binary, offset binary, data binary")
_ARROW = pa.schema([("shard", pa.int64()), ("term", pa.binary()), ("df", pa.int64()), ("top", pa.int64()),
                    ("last", pa.binary()), ("peak", pa.binary()), ("offset", pa.binary()), ("data", pa.binary())])
_WIDTHS = (np.dtype("<u1"), np.dtype("<u2"), np.dtype("<u4"))


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text; only A-Z are lower-cased."""
    return _TERM.findall(text.lower())


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """(documents with a term, terms with repeats)."""
    schema = pa.schema([("n", pa.int64()), ("l", pa.int64())])

    def run(batches):
        n = total = 0
        for batch in batches:
            for part in in_parts(batch, "text"):
                sizes = [len(terms_of(t)) for t in utf8(part.column("text"))]
                n, total = n + sum(map(bool, sizes)), total + sum(sizes)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total])], schema=schema)

    row = docs.select("text").mapInArrow(run, "n long, l long").agg(F.sum("n").alias("n"), F.sum("l").alias("l")).first()
    return row["n"] or 0, row["l"] or 0


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Scores without the term's weight."""
    return SCALE * tf // (1000 * tf + 8 * m)


def _width(largest: np.ndarray) -> np.ndarray:
    return np.searchsorted([1 << 8, 1 << 16], largest, side="right")


def build_shard(number: int, ids: list, texts: list[bytes], n_docs: int, n_terms: int) -> pa.RecordBatch:
    """Rows of a shard: its documents (a row without a term), then a row per term in term order."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    kept, sizes, codes = [], [], []
    for i in order:
        found = terms_of(texts[i])
        if found:
            kept.append(ids[i])
            sizes.append(len(found))
            codes.append(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)))
    rows: dict[str, list] = {f.name: [] for f in _ARROW}

    def add(*values):
        for name, v in zip(rows, values):
            rows[name].append(v)

    if kept:
        d = len(kept)
        m = 10 + 90 * np.array(sizes, np.int64) * n_docs // n_terms
        # Terms in byte order, so that a shard's rows are sorted.
        names = sorted(numbers)
        place = np.empty(len(names), np.int64)
        place[[numbers[t] for t in names]] = np.arange(len(names))
        code = place[np.concatenate(codes)] * d + np.repeat(np.arange(d), sizes)
        code, tf = np.unique(code, return_counts=True)
        term, doc = code // d, code % d
        first = np.flatnonzero(np.diff(term, prepend=-1))
        df = np.diff(np.append(first, len(term)))
        within = np.arange(len(term)) - np.repeat(first, df)
        block = np.flatnonzero(within % BLOCK == 0)
        end = np.append(block[1:], len(term))
        impact = impacts(tf, m[doc])
        peak, top = np.maximum.reduceat(impact, block), np.maximum.reduceat(impact, first)
        last = doc[end - 1].astype("<i4")
        gap = np.diff(doc, prepend=0) - 1
        gap[first] = doc[first]
        tf -= 1
        gap_width, tf_width = _width(np.maximum.reduceat(gap, block)), _width(np.maximum.reduceat(tf, block))
        size = 1 + (end - block) * ((1 << gap_width) + (1 << tf_width))
        gaps, tfs = [gap.astype(t) for t in _WIDTHS], [tf.astype(t) for t in _WIDTHS]
        packed = [bytes([g | f << 4]) + gaps[g][a:b].tobytes() + tfs[f][a:b].tobytes()
                  for g, f, a, b in zip(gap_width.tolist(), tf_width.tolist(), block.tolist(), end.tolist())]
        add(number, None, d, None, np.array([i is None for i in kept]).tobytes(), m.tobytes(), b"",
            np.array([i or 0 for i in kept], "<i8").tobytes())
        at = np.searchsorted(block, np.append(first, len(term))).tolist()
        for k, (name, n, t) in enumerate(zip(names, df.tolist(), top.tolist())):
            a, b = at[k], at[k + 1]
            add(number, name, n, t, last[a:b].tobytes(), peak[a:b].tobytes(),
                np.cumsum(np.append(0, size[a:b])).astype("<i4").tobytes() if b > a + 1 else b"", b"".join(packed[a:b]))
    return pa.RecordBatch.from_pydict(rows, schema=_ARROW)


def build_index(docs: DataFrame, n_docs: int, n_terms: int, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index of ``docs`` (doc_id, text), written to the shared folder."""
    def run(batches):
        number = TaskContext.get().partitionId() << 32
        ids, texts, held = [], [], 0
        for batch in batches:
            for part in in_parts(batch, "text", shard_bytes // 4):
                more = utf8(part.column("text"))
                size = sum(map(len, more))
                if ids and held + size > shard_bytes:
                    yield build_shard(number, ids, texts, n_docs, n_terms)
                    ids, texts, held, number = [], [], 0, number + 1
                ids += part.column("doc_id").to_pylist()
                texts += more
                held += size
        if ids:
            yield build_shard(number, ids, texts, n_docs, n_terms)

    return written(docs.mapInArrow(run, _INDEX), "search-index")


class Postings:
    """A term's list in a shard; blocks are decompressed when asked for."""

    def __init__(self, row: dict, weight: int, m: np.ndarray, kept: dict):
        self.term, self.weight, self.m, self.kept = row["term"], weight, m, kept
        self.last = np.frombuffer(row["last"], "<i4").astype(np.int64)
        self.peak = np.frombuffer(row["peak"], "<i8") * weight
        self.offset = np.frombuffer(row["offset"], "<i4") if row["offset"] else (0, len(row["data"]))
        self.data, self.df, self.bound = row["data"], row["df"], row["top"] * weight

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of a block."""
        found = self.kept.get((self.term, b))
        if found is None:
            at, n = int(self.offset[b]), min(BLOCK, self.df - b * BLOCK)
            gap, tf = _WIDTHS[self.data[at] & 15], _WIDTHS[self.data[at] >> 4]
            docs = np.cumsum(np.frombuffer(self.data, gap, n, at + 1).astype(np.int64) + 1)
            docs += (self.last[b - 1] if b else -1)
            tf = np.frombuffer(self.data, tf, n, at + 1 + n * gap.itemsize).astype(np.int64) + 1
            if len(self.kept) >= KEPT_BLOCKS:
                self.kept.clear()
            found = self.kept[(self.term, b)] = docs, impacts(tf, self.m[docs]) * self.weight
        return found


def search(lists: list[Postings], n_docs: int, k: int = K, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """(document numbers, scores) of the ``k`` best documents of a shard, best first."""
    lists = sorted((x for x in lists if x.bound > 0), key=lambda x: x.bound)
    upto = np.cumsum([x.bound for x in lists])
    top_docs, top, threshold = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    for lo in range(0, n_docs, span):
        hi = min(n_docs, lo + span)
        first = int(np.searchsorted(upto, threshold, side="right"))     # lists before it are non-essential
        if first == len(lists):
            break
        ranges = [np.searchsorted(x.last, (lo, hi - 1)) for x in lists]
        most = sum(int(x.peak[a:b + 1].max(initial=0)) for x, (a, b) in zip(lists, ranges))
        if most <= threshold:
            continue
        score = np.zeros(hi - lo, np.int64)
        for x, (a, b) in zip(lists[first:], ranges[first:]):
            for n in range(a, min(b + 1, len(x.last))):
                docs, s = x.block(n)
                i, j = np.searchsorted(docs, (lo, hi))
                score[docs[i:j] - lo] += s[i:j]
        found = np.flatnonzero(score)
        found = found[score[found] + (upto[first - 1] if first else 0) > threshold]
        for r in range(first - 1, -1, -1):
            x, below = lists[r], upto[r - 1] if r else 0
            block = np.searchsorted(x.last, found + lo)
            held = block < len(x.last)
            bound = np.where(held, x.peak[np.minimum(block, len(x.last) - 1)], 0)
            able = score[found] + bound + below > threshold
            found, block, held = found[able], block[able], held[able]
            for n in np.unique(block[held]).tolist():
                here = found[block == n]
                docs, s = x.block(n)
                at = np.minimum(np.searchsorted(docs, here + lo), len(docs) - 1)
                hit = docs[at] == here + lo
                score[here[hit]] += s[at[hit]]
            found = found[score[found] + below > threshold]
        found = found[score[found] > threshold]
        if len(found):
            top_docs, top = np.concatenate([top_docs, found + lo]), np.concatenate([top, score[found]])
            best = np.lexsort((top_docs, -top))[:k]
            top_docs, top = top_docs[best], top[best]
            if len(top) == k:
                threshold = int(top[-1])
    return top_docs, top


def search_shard(rows: list[dict], queries: list[list[tuple[bytes, int]]], k: int) -> list[tuple]:
    """(query, doc_id, score) of a shard's heap for each query of (term, weight)."""
    if not rows or rows[0]["term"] is not None:
        return []
    about, kept, lists = rows[0], {}, {}
    m = np.frombuffer(about["peak"], "<i8")
    ids, none = np.frombuffer(about["data"], "<i8"), np.frombuffer(about["last"], bool)
    weights = {t: w for q in queries for t, w in q}
    for row in rows[1:]:
        lists[row["term"]] = Postings(row, weights[row["term"]], m, kept)
    out = []
    for number, q in enumerate(queries):
        docs, scores = search([lists[t] for t, _ in q if t in lists], len(m), k)
        out += [(number, None if none[d] else int(ids[d]), int(s)) for d, s in zip(docs, scores)]
    return out


def _search_block(index: DataFrame, items: list, n_docs: int, k: int) -> DataFrame:
    """(item, item_id, doc_id, score): heaps of all shards for a block of items."""
    spark = index.sparkSession
    terms = [sorted(set(terms_of((t or "").encode("utf-8", "surrogatepass")))) for _, t in items]
    known = sorted({t for q in terms for t in q})       # bounded by the block's words
    wanted = F.broadcast(spark.createDataFrame([(None,), *((bytearray(t),) for t in known)], "wanted binary"))
    lists = index.join(wanted, F.col("term").eqNullSafe(F.col("wanted")), "left_semi")
    counts = lists.filter("term is not null").groupBy("term").agg(F.sum("df").alias("df")).collect()
    weights = {bytes(r["term"]): weight(n_docs, r["df"]) for r in counts}
    sent = spark.sparkContext.broadcast([[(t, weights[t]) for t in q if weights.get(t, 0) > 0] for q in terms])
    schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        queries = sent.value
        asked = {t for q in queries for t, _ in q}
        for shard in sorted_groups(batches, ["shard"]):
            rows = [r for r in shard.to_pylist() if r["term"] is None or r["term"] in asked]
            found = search_shard(rows, queries, k)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else [[]] * 3)], schema=schema)

    heaps = (lists.repartition("shard").sortWithinPartitions("shard", "term")
             .mapInArrow(run, "item long, doc_id long, score long"))
    ids = F.broadcast(spark.createDataFrame([(n, i) for n, (i, _) in enumerate(items)], "item long, item_id long"))
    return heaps.join(ids, "item")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS,
                  shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item."""
    d = id_text(docs, id_col, text_col)
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    n_docs, n_terms = corpus_size(d)
    if not n_docs:
        return out
    index = build_index(d, n_docs, n_terms, shard_bytes)
    asked = id_text(items, item_col, item_text_col).withColumnRenamed("doc_id", "item_id")
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    for block in _blocks(asked, block_words):
        heaps = _search_block(index, block, n_docs, k)
        out = out.unionByName(heaps.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
                              .select("item_id", "rank", "doc_id", "score"))
    return out
