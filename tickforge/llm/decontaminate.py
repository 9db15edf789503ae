"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Every word trigram of the benchmark items is counted over all documents. The trigrams of
an item that are at most ``RARE`` times as frequent as its median one are its seeds: at
least half of them, whatever the corpus holds. Where a seed stands
in a document, the passage around it is aligned with the item word by word (match +2,
mismatch -1, gap -1). A local alignment is a match if it is worth ``min_score`` of a perfect copy
of the item or as much as ``QUOTE`` words copied in a row, whatever the item's length: edited
and partly rewritten copies count as well as exact ones, and so do quotations of a part. After
each match the parts of the passage left and right of it are aligned anew as long as they hold a
seed, so every copy is reported.

The benchmark is a stated query set: it is read in blocks of at most about
``BLOCK_WORDS`` words, each sent to all tasks, and every block meets every document. Documents
are never shuffled. Counts combine inside each task before they move.

Defined results: null, empty or short texts (under three words) match nothing, neither do
such items; repeated documents and items give repeated matches; very long texts are searched
whole; ties of alignments go to the first one; other columns are ignored; empty tables
give an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import filter_rows, id_text, in_parts

N = 3
RARE = 4
MIN_SCORE = 0.5
QUOTE = 13
BLOCK_WORDS = 500_000
_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class SeedIndex:
    """Trigrams of a block of items. ``codes`` is sorted; those at ``k`` belong to the
    occurrences ``at[k]:at[k + 1]`` of ``item`` (index) and ``place`` (word)."""
    ids: list[int]
    words: dict
    items: list[np.ndarray]
    codes: np.ndarray
    at: np.ndarray
    item: np.ndarray
    place: np.ndarray

    @staticmethod
    def build(items: list[tuple[int, str]]) -> "SeedIndex":
        vocabulary: dict[str, int] = {}
        coded = [np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(t)], np.int64)
                 for _, t in items]
        index = SeedIndex([i for i, _ in items], vocabulary, coded, *[np.zeros(0, np.int64)] * 4)
        grams = [index.grams(c)[0] for c in coded]
        code = np.concatenate([*grams, np.zeros(0, np.int64)])
        item = np.repeat(np.arange(len(items)), [len(g) for g in grams])
        place = np.concatenate([*(np.arange(len(g)) for g in grams), np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(code, kind="stable")
        index.codes, first = np.unique(code[order], return_index=True)
        index.at = np.append(first, len(code))
        index.item, index.place = item[order], place[order]
        return index

    def grams(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, places) of the trigrams whose words are all known."""
        if len(ids) < N:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b, c = ids[:-2], ids[1:-1], ids[2:]
        places = np.flatnonzero((a > 0) & (b > 0) & (c > 0))
        m = len(self.words) + 1                    # its cube fits 63 bits for any block
        return (a[places] * m + b[places]) * m + c[places], places

    def encode(self, text: str) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.words.get, words, repeat(0)), np.int64, len(words))

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``codes``, place) of every known trigram of a text."""
        codes, places = self.grams(ids)
        if not len(codes) or not len(self.codes):
            return codes[:0], places[:0]
        k = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        hit = self.codes[k] == codes
        return k[hit], places[hit]

    def rare(self, counts: np.ndarray) -> np.ndarray:
        """For every occurrence of a trigram in an item, whether it is a seed of that item."""
        df = np.repeat(counts, np.diff(self.at))
        order = np.lexsort((df, self.item))
        sizes = np.bincount(self.item, minlength=len(self.ids))
        middle = np.cumsum(sizes) - sizes + np.maximum(sizes - 1, 0) // 2
        median = np.zeros(len(self.ids), np.int64)
        some = sizes > 0
        median[some] = df[order][middle[some]]
        return df <= RARE * (median[self.item] + 1)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best Smith-Waterman alignment: (score, end in item, end in passage), ends exclusive.
    Rows are vectors; gaps along a row come from a running maximum."""
    n = len(passage)
    step = np.arange(n, dtype=np.int64)
    h, best = np.zeros(n, np.int64), (0, 0, 0)
    for i, w in enumerate(item):
        diagonal = np.empty(n, np.int64)
        diagonal[0], diagonal[1:] = 0, h[:-1]
        h = np.maximum(np.maximum(diagonal + np.where(passage == w, 2, -1), h - 1), 0)
        h = np.maximum.accumulate(h + step) - step
        j = int(h.argmax())
        if h[j] > best[0]:
            best = (int(h[j]), i + 1, j + 1)
    return best


def matches_of(index: SeedIndex, seed: np.ndarray, text: str, min_score: float) -> list[tuple]:
    """(item index, score, first word, end word) of every match in one text."""
    ids = index.encode(text)
    k, places = index.find(ids)
    if not len(k):
        return []
    sizes = index.at[k + 1] - index.at[k]
    occurrence = np.repeat(index.at[k] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    seed_here = seed[occurrence]
    starts = np.repeat(places, sizes)[seed_here]
    occurrence = occurrence[seed_here]
    starts, items = starts - index.place[occurrence], index.item[occurrence]
    at = np.repeat(places, sizes)[seed_here]
    order = np.lexsort((starts, items))
    found = []
    windows: list[list] = []
    for item, start, place in zip(items[order].tolist(), starts[order].tolist(), at[order].tolist()):
        size = len(index.items[item])
        lo, hi = max(0, start - size // 2 - 4), min(len(ids), start + size + size // 2 + 4)
        if windows and windows[-1][0] == item and lo <= windows[-1][2]:
            windows[-1][2] = max(hi, windows[-1][2])
            windows[-1][3].append(place)
        else:
            windows.append([item, lo, hi, [place]])
    for item, lo, hi, seeds in windows:
        words = index.items[item]
        for score, a, b in _passages(words, ids, lo, hi, np.unique(seeds), limit_of(len(words), min_score)):
            found.append((item, score / (2 * len(words)), a, b))
    return found


def limit_of(size: int, min_score: float) -> float:
    """Least score of a match with an item of ``size`` words."""
    return min(2 * size * min_score, 2 * QUOTE)


def _parts(item: np.ndarray, ids: np.ndarray, lo: int, hi: int, seeds: np.ndarray, limit: float) -> list[tuple]:
    """(score, first word, end word) of the matches in words ``lo`` to ``hi``, in order: the best
    alignment, then those left and right of it."""
    found, todo = [], [(lo, hi)]
    while todo:
        lo, hi = todo.pop()
        k = np.searchsorted(seeds, lo)
        if k == len(seeds) or seeds[k] + N > hi:
            continue
        score, i, j = align(item, ids[lo:hi])
        if score < limit:
            continue
        # The same alignment backwards from its end gives its start.
        _, _, back = align(item[:i][::-1], ids[lo:lo + j][::-1])
        a, b = lo + j - back, lo + j
        found.append((score, a, b))
        todo += [(lo, a), (b, hi)]
    return sorted(found, key=lambda x: x[1])


def _passages(item: np.ndarray, ids: np.ndarray, lo: int, hi: int, seeds: np.ndarray, limit: float):
    """Matches of a window of any length, in slices of some item lengths, so that many copies in a
    row cost no more each than a few. A match spans three item lengths at most: what ends nearer
    than that to a slice's end is left to the next slice, which starts before it."""
    reach = 3 * len(item) + 8
    while lo < hi:
        end = min(hi, lo + 6 * reach)
        done = lo
        for match in _parts(item, ids, lo, end, seeds, limit):
            if end < hi and match[2] > end - reach:
                break
            yield match
            done = match[2]
        if end == hi:
            return
        lo = max(done, end - 2 * reach)


def _blocks(benchmark: DataFrame, block_words: int):
    """Items in blocks of about ``block_words`` words, dealt by hash."""
    size = F.size(F.split("text", "\\s+"))
    total = benchmark.agg(F.sum(size)).first()[0] or 0
    n = max(1, -(-int(total) // block_words))
    for b in range(n):
        part = benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b) if n > 1 else benchmark
        rows = sorted(((r["item_id"], r["text"]) for r in part.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        if rows:
            yield rows


def trigram_counts(docs: DataFrame, size: int, sent) -> np.ndarray:
    """Documents that hold each of the ``size`` trigrams of the index whose fields were
    ``sent`` to the tasks, over all of ``docs``."""
    schema = pa.schema([("code", pa.int64()), ("n", pa.int64())])

    def run(batches):
        index = SeedIndex(**sent.value)
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for part in in_parts(batch, "text"):
                for text in part.column("text").to_pylist():
                    k, _ = index.find(index.encode(text))
                    counts[np.unique(k)] += 1
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], schema=schema)

    out = np.zeros(size, np.int64)
    # At most one row per trigram of the block.
    for r in docs.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():
        out[r["code"]] = r["n"]
    return out


def _searches(docs: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, block_words: int):
    """(index fields, seeds), both sent to the tasks, of each block of the benchmark."""
    b = id_text(benchmark, item_col, item_text_col).withColumnRenamed("doc_id", "item_id")
    send = docs.sparkSession.sparkContext.broadcast
    for items in _blocks(b, block_words):
        built = SeedIndex.build(items)
        sent = send(vars(built))
        yield sent, send(built.rare(trigram_counts(docs, len(built.codes), sent)))


def find_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", min_score: float = MIN_SCORE,
                 block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word): one row per passage of a document
    that aligns with an item. ``score`` is 1.0 for an exact copy, less than ``min_score`` for a
    quotation of a smaller part; word positions count from 0."""
    d = id_text(docs, id_col, text_col)
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()),
                        ("first_word", pa.int64()), ("end_word", pa.int64())])
    ddl = "doc_id long, item_id long, score double, first_word long, end_word long"
    out = docs.sparkSession.createDataFrame([], ddl)
    for sent, seed in _searches(d, benchmark, item_col, item_text_col, block_words):

        def run(batches, sent=sent, seed=seed):
            index = SeedIndex(**sent.value)
            for batch in batches:
                for part in in_parts(batch, "text"):
                    rows = [(doc, index.ids[item], score, first, end)
                            for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist())
                            for item, score, first, end in matches_of(index, seed.value, text, min_score)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 5, schema)], schema=schema)

        out = out.unionByName(d.mapInArrow(run, ddl))
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE,
               block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows of ``docs`` (all columns) that match no benchmark item."""
    d = id_text(docs)
    out = docs
    for sent, seed in _searches(d, benchmark, "item_id", "text", block_words):

        def make_test(sent=sent, seed=seed):
            index = SeedIndex(**sent.value)
            return lambda texts: [not matches_of(index, seed.value, t.decode(), min_score) for t in texts]

        out = filter_rows(out, make_test)
    return out
