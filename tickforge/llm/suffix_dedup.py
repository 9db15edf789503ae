"""Exact-substring dedup: what is covered by a window that stands elsewhere too is removed.

A window is ``BYTES.length`` bytes of a text, or ``WORDS.length`` / 4 words: texts then become
strings of four-byte word hashes, and windows begin at words only. Which windows repeat is decided by suffix
arrays (two-stage sorting, then adjacent common prefixes) over the places where a repeat is
possible at all:

1. Equal texts become one text that is known to repeat.
2. Of the hashes of all ``gram``-byte strings in a window, the least (the first of equal
   ones) is the window's anchor. Equal windows have equal anchors at the same offset, so
   only windows under an anchor hash that occurs twice or more can repeat. Windows with one
   anchor stand side by side: they are a segment.
3. Segments move to a task by their anchor's hash; equal ones are merged on the way. Tasks
   build suffix arrays over blocks of whole groups, in a bounded number of bytes.
4. A group larger than ``HOT_BYTES`` is dealt out anew: its distinct segments are cut into narrower
   ranges of offsets, whose windows share a longer core, and grouped by that core. With
   ever narrower ranges, down to single windows, equal ones merge and groups fall apart.
5. Neighbouring segments of a text are chained up to a segment whose digest says so, so that
   shared passages give equal chains wherever they stand; runs of equal segments are one row. What repeats is worked out per distinct chain and
   comes back to the texts with a row per chain and place.

``substring_dedup`` removes every copy. ``without_repeats`` keeps the first: of equal windows that in the
row of the least id (of equal ids the least text digest), the earliest one in it. Windows never cross
documents, all judgements are on the input, and overlaps count.

Defined results: null and empty texts have 0 bytes and nothing removed; rows that repeat, ids
included, count as repeats of each other (``without_repeats`` takes rows equal in id and text as one
document and leaves each of them what that one keeps); texts shorter than a window keep everything; very
long texts are read in overlapping chunks; rows without an id take part like any other and come last
among copies; a text whose words all go stays as a row with what white space is left; other columns are
ignored; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .common import discard, id_text, in_parts, small_side, sorted_groups, utf8, written
from .shingles import mix, words
from .suffix_array import common_prefixes, suffix_array



@dataclass(frozen=True)
class Unit:
    """What a window is: its bytes, those of the strings hashed for anchors (a power of two), the step
    between windows, and whether its first copy stays."""
    length: int
    gram: int
    step: int = 1
    keep_first: bool = False

    @property
    def span(self) -> int:
        """Anchor offsets in a window."""
        return self.length - self.gram + 1

    @property
    def widths(self) -> tuple[int, ...]:
        """Ranges of offsets, level by level."""
        return (self.span, *(w for w in (64, 16, 4, 1) if w < self.span))

    def read(self, text: bytes) -> bytes:
        """The bytes that are compared."""
        return text if self.step == 1 else words(text, fold=False)[0].astype("<u4").tobytes()


BYTES = Unit(400, 64)
WORDS = Unit(4 * 50, 32, step=4, keep_first=True)
CHUNK = 2 << 20                       # bytes of text hashed at once
BLOCK_BYTES = 256 << 10               # bytes under one suffix array
HOT_BYTES = 2 << 20                   # of distinct segments in one group
CHAIN = 8                             # segments of a chain, on average

_U = np.uint64
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_STEP = [int(x) | 1 for x in mix(np.arange(101, 108, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))]
_PLACE = _U((1 << 24) - 1)            # low bits that hold a position in a chunk


def text_key(text: bytes) -> bytes:
    return xxhash.xxh3_128_digest(text)


def gram_hashes(x: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from every position, by doubling."""
    h, size, k = _BYTE[x], 1, 0
    while size < gram:
        h = h[:-size] * _U(_STEP[k]) + h[size:]
        size, k = 2 * size, k + 1
    return mix(h)


def _window_least(v: np.ndarray, w: int) -> np.ndarray:
    """Least value of every ``w`` consecutive ones."""
    n = len(v)
    full = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = v
    blocks = full.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def segments(data: bytes, unit: Unit = BYTES):
    """(anchor hash, start, windows, offset) arrays of a text's segments: ``windows``
    neighbouring windows from ``start`` on; ``offset`` is span - 1 less the anchor's distance
    from the first of them, so it rises by one from window to window."""
    out = []
    for lo in range(0, max(len(data) - unit.length + 1, 0), CHUNK):
        x = np.frombuffer(data[lo:lo + CHUNK + unit.length - 1], np.uint8)
        h = gram_hashes(x, unit.gram)
        at = np.arange(len(h), dtype=np.uint64)
        anchor = (_window_least((h & ~_PLACE) | at, unit.span) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
        count = np.diff(np.append(first, len(anchor)))
        out.append((h[anchor[first]].astype(np.int64), first + lo, count, unit.span - 1 - (anchor[first] - first)))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(c) for c in zip(*out))


def in_runs(key, start, windows, offset):
    """Segments that follow each other with equal anchor, width and offset (in periodic passages, one per
    period) as one row: the arrays of the first ones and how many there are."""
    if not len(key):
        return key, start, windows, offset, windows
    new = np.ones(len(key), bool)
    new[1:] = ((key[1:] != key[:-1]) | (windows[1:] != windows[:-1]) | (offset[1:] != offset[:-1])
               | (start[1:] != start[:-1] + windows[:-1]))
    first = np.flatnonzero(new)
    return key[first], start[first], windows[first], offset[first], np.diff(np.append(first, len(key)))


def fingerprints(docs: DataFrame, unit: Unit = BYTES) -> DataFrame:
    """(doc_id, key, text_id, n_bytes, size, sha) of every row: ``size`` is that of what is compared, sha is of
    the whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("text_id", pa.binary()), ("n_bytes", pa.int64()),
                        ("size", pa.int64()), ("sha", pa.string())])

    def run(batches):
        for batch in batches:
            for part in in_parts(batch, "text"):
                texts = utf8(part.column("text"))
                sizes = [len(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"), pa.array([text_key(t) for t in texts], pa.binary()),
                     pa.array(sizes, pa.int64()),
                     pa.array(sizes if unit.step == 1 else [unit.step * len(words(t, fold=False)[0]) for t in texts], pa.int64()),
                     pa.array([hashlib.sha256(t).hexdigest() for t in texts])], schema=schema)

    return docs.withColumn("key", _row_key()).mapInArrow(
        run, "doc_id long, key long, text_id binary, n_bytes long, size long, sha string")


def _texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(text_id, text) of the texts in ``chosen`` (text_id, rep), read from the rows with their least key."""
    # 128-bit keys of texts are taken apart in the tasks, which see the text anyway.
    return (docs.join(small_side(chosen.select("text_id", "rep")), _row_key() == F.col("rep"))
            .select("text_id", "text"))


def _row_key():
    """Hash of a row's id and text, never null."""
    return F.xxhash64("doc_id", "text")


def _anchors(texts: DataFrame, unit: Unit) -> DataFrame:
    """(key, text_id, start, windows, offset, times) of every segment, or run of equal ones, of every text."""
    schema = pa.schema([("key", pa.int64()), ("text_id", pa.binary()), ("start", pa.int64()),
                        ("windows", pa.int32()), ("offset", pa.int32()), ("times", pa.int32())])

    def run(batches):
        for batch in batches:
            for part in in_parts(batch, "text", CHUNK):
                cols, ids, counts = [], [], []
                for tid, t in zip(part.column("text_id").to_pylist(), utf8(part.column("text"))):
                    if text_key(t) == tid:          # another text of the same id has its own row
                        cols.append(in_runs(*segments(unit.read(t), unit)))
                        ids.append(tid)
                        counts.append(len(cols[-1][0]))
                if not ids:
                    continue
                key, start, windows, offset, times = (np.concatenate(c) for c in zip(*cols))
                owner = pa.array(np.repeat(np.arange(len(ids)), counts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(ids, pa.binary()).take(owner), pa.array(start),
                     pa.array(windows.astype(np.int32)), pa.array(offset.astype(np.int32)), pa.array(times.astype(np.int32))],
                    schema=schema)

    return texts.mapInArrow(run, "key long, text_id binary, start long, windows int, offset int, times int")


# A segment: its first place (owner, text_id, start), and where it stands: in a chain of segments, ``times`` times in
# a row from ``at`` on, or, cut out of a wider segment, in that one. ``n`` counts all its places. Rows without a key
# are the places of whole chains.
_ROW = ("key binary, seg binary, windows int, offset int, bytes binary, n long, owner long, text_id binary, start long, "
        "chain binary, at long, times int")
_ROW_ARROW = pa.schema([("key", pa.binary()), ("seg", pa.binary()), ("windows", pa.int32()), ("offset", pa.int32()),
                        ("bytes", pa.binary()), ("n", pa.int64()), ("owner", pa.int64()), ("text_id", pa.binary()),
                        ("start", pa.int64()), ("chain", pa.binary()), ("at", pa.int64()), ("times", pa.int32())])
_RUNS_DDL = "array<struct<lo: int, n: int>>"
_RUNS = pa.list_(pa.struct([("lo", pa.int32()), ("n", pa.int32())]))
_FOUND = f"key binary, seg binary, text_id binary, start long, gone {_RUNS_DDL}, rest {_RUNS_DDL}"
_FOUND_ARROW = pa.schema([("key", pa.binary()), ("seg", pa.binary()), ("text_id", pa.binary()), ("start", pa.int64()),
                          ("gone", _RUNS), ("rest", _RUNS)])


def _chains(data: bytes, at: list[dict], unit: Unit):
    """Chains of neighbouring segments of a text: lists of [key, seg, start, windows, offset, bytes, times]. Equal
    segments that follow each other are one entry, whatever their number."""
    chain, end = [], None
    for a in at:
        lo = a["start"]
        for _ in range(a["times"]):
            b = data[lo:lo + a["windows"] + unit.length - 1]
            seg = _seg(b, a["offset"])
            same = chain and end == lo and chain[-1][1] == seg
            if chain and not same and (end != lo or chain[-1][1][0] % CHAIN == 0):
                yield chain
                chain = []
            if same:
                chain[-1][6] += 1
            else:
                chain.append([a["key"].to_bytes(8, "little", signed=True), seg, lo, a["windows"], a["offset"], b, 1])
            lo = end = lo + a["windows"]
    if chain:
        yield chain


def _cut(texts_and_places: DataFrame, unit: Unit) -> DataFrame:
    """Places of chains, and the segments of every chain that a slice of texts holds. Input: (text_id, text,
    owner, at: array of key, start, windows, offset, times in order of start)."""
    def run(batches):
        for batch in batches:
            for part in in_parts(batch, "text", CHUNK):
                places, held = [], {}
                for tid, t, owner, at in zip(part.column("text_id").to_pylist(), utf8(part.column("text")),
                                             part.column("owner").to_pylist(), part.column("at").to_pylist()):
                    if text_key(t) != tid:
                        continue
                    for chain in _chains(unit.read(t), at, unit):
                        name = xxhash.xxh3_128_digest(b"".join(s + times.to_bytes(4, "little") for _, s, *_, times in chain))
                        places.append((tid, chain[0][2], name))
                        for key, seg, lo, windows, offset, b, times in chain:
                            row = held.get((name, lo - chain[0][2]))
                            if row is None:
                                held[(name, lo - chain[0][2])] = [key, seg, windows, offset, b, times, (owner, tid, lo), times]
                            else:
                                row[5] += times
                                row[6] = min(row[6], (owner, tid, lo))
                rows = [(k, s, w, o, b, n, *first, name, at, times)
                        for (name, at), (k, s, w, o, b, n, first, times) in held.items()]
                rows += [(None, None, None, None, None, None, None, tid, lo, name, None, None) for tid, lo, name in places]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(_ROW_ARROW), _ROW_ARROW)],
                    schema=_ROW_ARROW)

    return texts_and_places.mapInArrow(run, _ROW)


def _seg(data: bytes, offset: int) -> bytes:
    """Equal segments have equal bytes and offsets."""
    return xxhash.xxh3_128_digest(data, seed=offset)


def _narrow(segs: DataFrame, width: int, unit: Unit) -> DataFrame:
    """Distinct segments cut into ranges of ``width`` offsets, keyed by the bytes all windows of a range
    share; ``chain`` is the key and digest of the segment that is cut."""
    def run(batches):
        for batch in batches:
            for part in in_parts(batch, "bytes", CHUNK):
                rows = []
                for r in part.to_pylist():
                    lo, end = r["offset"], r["offset"] + r["windows"]
                    while lo < end:
                        base = lo - lo % width
                        hi = min(end, base + width)
                        skip = lo - r["offset"]
                        b = r["bytes"][skip:skip + hi - lo + unit.length - 1]
                        core = r["bytes"][base + width - 1 - r["offset"]:base + unit.length - r["offset"]]
                        key = xxhash.xxh3_128_digest(r["key"] + base.to_bytes(4, "little") + core)
                        rows.append((key, _seg(b, lo), hi - lo, lo, b, r["n"], r["owner"], r["text_id"], r["start"] + skip,
                                     r["key"] + r["seg"], skip, 1))
                        lo = hi
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(_ROW_ARROW), _ROW_ARROW)],
                    schema=_ROW_ARROW)

    return segs.select(*(n for n in _ROW_ARROW.names if n not in ("chain", "at", "times"))).mapInArrow(run, _ROW)


def repeated_windows(block: list[tuple], unit: Unit = BYTES) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each (bytes, windows, n, rank, start) of a block two masks of its windows: those to go at all
    its places, and those to go at all but its first place. Equal windows are neighbours in the suffix
    array that share ``unit.length`` bytes; ``rank`` orders the texts of first places. Without
    ``keep_first`` all windows that repeat go everywhere."""
    data = b"".join(b for b, *_ in block)
    begin = np.cumsum([0] + [len(b) for b, *_ in block])
    place = np.full(len(data) + 1, -1, np.int64)
    for (_, windows, _, rank, start), at in zip(block, begin.tolist()):
        # Windows begin at whole steps of their text.
        skip = -start % unit.step
        place[at + skip:at + windows:unit.step] = (rank << 40) + start + np.arange(skip, windows, unit.step)
    order = suffix_array(data, unit.length)
    order = order[place[order] >= 0]
    equal = common_prefixes(data, order, unit.length) >= unit.length
    first = np.flatnonzero(np.concatenate([[True], ~equal])) if len(order) else order
    gone = np.zeros(len(data) + 1, bool)
    if len(order):
        size = np.diff(np.append(first, len(order)))
        head = np.repeat(np.minimum.reduceat(place[order], first), size) == place[order]
        gone[order[np.repeat(size > 1, size) & ~(head & unit.keep_first)]] = True
    out = []
    for (_, windows, n, *_), at in zip(block, begin.tolist()):
        out.append(_known(gone[at:at + windows], place[at:at + windows] >= 0, n, unit))
    return out


def _known(gone: np.ndarray, window: np.ndarray, n: int, unit: Unit) -> tuple[np.ndarray, np.ndarray]:
    """The two masks of a segment with ``n`` places, ``gone`` being what equals others."""
    if n == 1:
        return gone, np.zeros(len(gone), bool)
    return (gone, window & ~gone) if unit.keep_first else (window, np.zeros(len(gone), bool))


def _runs(mask: np.ndarray, step: int = 1) -> list[dict]:
    """Runs of windows ``step`` apart: the first, and the positions from it to the last."""
    at = np.flatnonzero(mask)
    first = np.flatnonzero(np.diff(at, prepend=-2 * step) != step)
    last = at[np.append(first[1:], len(at)) - 1] if len(at) else at
    return [{"lo": a, "n": b - a + 1} for a, b in zip(at[first].tolist(), last.tolist())]


def _array_pass(groups: DataFrame, unit: Unit) -> DataFrame:
    """Windows to go of distinct segments, whole groups of a key together, several groups to a suffix array."""
    def solve(block):
        # Texts of first places in order.
        ranks = {p: k for k, p in enumerate(sorted({r[5:7] for r in block}))}
        return found(block, repeated_windows([(r[4], r[3], r[2], ranks[r[5:7]], r[7]) for r in block], unit))

    def found(block, masks):
        rows = [(r[0], r[1], r[6], r[7], _runs(a, unit.step), _runs(b, unit.step)) for r, (a, b) in zip(block, masks)
                if a.any() or b.any()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(_FOUND_ARROW), _FOUND_ARROW)],
            schema=_FOUND_ARROW)

    def run(batches):
        block, held, alone = [], 0, []
        for g in sorted_groups(batches, ["key"]):
            rows = list(zip(*(g.column(c).to_pylist() for c in ("key", "seg", "n", "windows", "bytes", "owner", "text_id", "start"))))
            if len(rows) == 1:                  # nothing to compare with: equal windows have different segments
                if rows[0][2] > 1:
                    none = np.zeros(rows[0][3], bool)
                    window = (np.arange(rows[0][3]) + rows[0][7]) % unit.step == 0
                    alone.append((rows[0], _known(none, window, rows[0][2], unit)))
                if len(alone) >= 1_000:
                    yield found(*zip(*alone))
                    alone = []
                continue
            block += rows
            held += sum(len(r[4]) for r in rows)
            if held >= BLOCK_BYTES:
                yield solve(block)
                block, held = [], 0
        if alone:
            yield found(*zip(*alone))
        if block:
            yield solve(block)

    return groups.repartition("key").sortWithinPartitions("key").mapInArrow(run, _FOUND)


def _distinct(rows: DataFrame) -> DataFrame:
    """One row per (key, seg) with all its places counted and the first of them."""
    first = F.min(F.struct("owner", "text_id", "start")).alias("p")
    return written(rows.groupBy("key", "seg").agg(F.sum("n").alias("n"), F.first("windows").alias("windows"),
                                                  F.first("offset").alias("offset"), F.first("bytes").alias("bytes"), first)
                   .select("key", "seg", "n", "windows", "offset", "bytes", "p.*"), "segments")


def _solve(rows: DataFrame, unit: Unit, temporary: list, level: int = 0) -> DataFrame:
    """(key, seg, text_id, start, gone, rest) of the segments in ``rows`` that lose windows; (text_id, start) is a
    segment's first place."""
    distinct = _distinct(rows)
    large = written(distinct.groupBy("key").agg(F.sum(F.length("bytes").cast("long")).alias("size"),
                                                F.count(F.lit(1)).alias("segs"))
                    .filter((F.col("size") > HOT_BYTES) & (F.col("segs") > 1)).select("key"), "large-groups")
    temporary += [distinct, large]
    if level == len(unit.widths) - 1 or not large.limit(1).count():
        return _array_pass(distinct, unit)
    side = small_side(large, 100_000)
    hot = distinct.join(side, "key", "left_semi")
    parts = written(_narrow(hot, unit.widths[level + 1], unit), "cut")
    temporary.append(parts)
    found = _solve(parts, unit, temporary, level + 1)
    found = found.select("key", "seg", F.col("text_id").alias("f_text"), F.col("start").alias("f_start"), "gone", "rest")
    # A part whose first place is not that of its equals goes there too.
    own = (F.col("text_id") == F.col("f_text")) & (F.col("start") == F.col("f_start"))
    none = F.array().cast(_RUNS_DDL)
    moved = {c: F.transform(c, lambda r: F.struct((r["lo"] + F.col("at").cast("int")).alias("lo"), r["n"].alias("n")))
             for c in ("gone", "rest")}
    up = (parts.join(found, ["key", "seg"])
          .select("chain", "text_id", (F.col("start") - F.col("at")).alias("start"),
                  F.when(own, moved["gone"]).otherwise(F.concat(moved["gone"], moved["rest"])).alias("gone"),
                  F.when(own, moved["rest"]).otherwise(none).alias("rest"))
          .groupBy("chain", "text_id", "start")
          .agg(F.flatten(F.collect_list("gone")).alias("gone"), F.flatten(F.collect_list("rest")).alias("rest")))
    cut = F.length("chain") - 16
    up = up.select(F.substring("chain", F.lit(1), cut).alias("key"), F.substring("chain", cut + 1, F.lit(16)).alias("seg"),
                   "text_id", "start", "gone", "rest")
    return _array_pass(distinct.join(side, "key", "left_anti"), unit).unionByName(up)


def repeated_runs(docs: DataFrame, distinct_texts: DataFrame, unit: Unit = BYTES) -> tuple[DataFrame, list]:
    """((text_id, chains), tables it reads): for the texts that lose anything, of the distinct
    texts (text_id, rep, owner, size) that are long enough, their chains with what goes in them."""
    long_enough = written(distinct_texts.filter(F.col("size") >= unit.length).select("text_id", "rep", "owner"), "long-texts")
    anchors = written(_anchors(_texts(docs, long_enough), unit), "anchors")
    # Written: the join below then has two plain sides, and a hot anchor's rows can be split.
    twice = written(anchors.groupBy("key").agg(F.sum("times").alias("c")).filter("c > 1").select("key"), "twice")
    at = F.array_sort(F.collect_list(F.struct("start", "key", "windows", "offset", "times")))
    places = anchors.join(twice, "key").groupBy("text_id").agg(at.alias("at"))
    places = written(places.join(long_enough, "text_id"), "places")
    texts = _texts(docs, places).join(places.select("text_id", "owner", "at"), "text_id")
    rows = written(_cut(texts, unit), "cut")
    discard(anchors, twice, long_enough, places)
    temporary = [rows]
    segs = rows.filter("key is not null")
    found = _solve(segs, unit, temporary)
    found = found.select("key", "seg", F.col("text_id").alias("f_text"), F.col("start").alias("f_start"), "gone", "rest")
    members = segs.select("chain", "at", "times", "windows", "key", "seg").distinct()
    inside = (members.join(found, ["key", "seg"]).groupBy("chain")
              .agg(F.collect_list(F.struct("at", "times", "windows", "f_text", "f_start", "gone", "rest")).alias("segs")))
    runs = (rows.filter("key is null").select("chain", "text_id", "start").join(inside, "chain")
            .groupBy("text_id").agg(F.collect_list(F.struct("start", "segs")).alias("chains")))
    return runs, temporary


def windows_gone(text_id: bytes, chains: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """(start, number) of the runs of windows to go in a text."""
    lo, n = [], []
    for c in chains:
        for s in c["segs"]:
            first = c["start"] + s["at"]
            for start in range(first, first + s["times"] * s["windows"], s["windows"]):
                own = s["f_text"] == text_id and s["f_start"] == start
                for r in s["gone"] if own else [*s["gone"], *s["rest"]]:
                    lo.append(start + r["lo"])
                    n.append(r["n"])
    return np.array(lo, np.int64), np.array(n, np.int64)


def covered(lo: np.ndarray, n: np.ndarray, length: int = BYTES.length) -> tuple[np.ndarray, np.ndarray]:
    """Merged (start, end) of the bytes under runs of windows."""
    order = np.argsort(lo, kind="stable")
    start, end = lo[order], np.maximum.accumulate(lo[order] + n[order] + length - 1)
    new = np.concatenate([[True], start[1:] > end[:-1]])
    return start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


def kept_parts(text: bytes, starts, ends) -> bytes:
    """The bytes outside the spans."""
    out, at = [], 0
    for a, b in zip(starts, ends):
        out.append(text[at:a])
        at = b
    return b"".join(out) + text[at:]


def kept_words(text: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """A text without the words in spans of its word hashes, and without the white space behind them."""
    first, step = words(text, fold=False)[1], WORDS.step
    at = np.append(first, len(text))
    # A span of whole windows begins and ends at words.
    return kept_parts(text, at[starts // step].tolist(), at[ends // step].tolist())


def _outcome(docs: DataFrame, rows: DataFrame, unit: Unit = BYTES) -> tuple[DataFrame, DataFrame]:
    """((text_id, n_removed, n_spans, kept_sha256, kept) of the distinct texts that lose anything besides what
    they lose as copies of each other, (text_id, copies, owner, size) of all distinct texts)."""
    least = F.coalesce(F.min("doc_id"), F.lit((1 << 63) - 1))
    distinct = written(rows.groupBy("text_id").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                                   least.alias("owner"), F.first("size").alias("size")), "distinct-texts")
    found, temporary = repeated_runs(docs, distinct, unit)
    # Where no copy stays, texts with several rows go as a whole.
    asked = distinct if unit.keep_first else distinct.filter("copies = 1")
    once = written(found.join(asked.select("text_id", "rep"), "text_id"), "runs")
    discard(*temporary)
    schema = pa.schema([("text_id", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept_sha256", pa.string()), ("kept", pa.string())])

    def run(batches):
        for batch in batches:
            for part in in_parts(batch, "text", CHUNK):
                out = []
                for tid, t, chains in zip(part.column("text_id").to_pylist(), utf8(part.column("text")),
                                          part.column("chains").to_pylist()):
                    if text_key(t) != tid:
                        continue
                    lo, n = windows_gone(tid, chains)
                    if not len(lo):
                        continue
                    a, b = covered(lo, n, unit.length)
                    if unit.step == 1:
                        kept = kept_parts(t, a.tolist(), b.tolist())
                        out.append((tid, int((b - a).sum()), len(a), hashlib.sha256(kept).hexdigest(), None))
                    else:
                        kept = kept_words(t, a, b)
                        out.append((tid, len(t) - len(kept), len(a), None, kept.decode("utf-8", "ignore")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 5, schema)], schema=schema)

    partly = (_texts(docs, once).join(once.select("text_id", "chains"), "text_id")
              .mapInArrow(run, "text_id binary, n_removed long, n_spans long, kept_sha256 string, kept string"))
    return partly, distinct.select("text_id", "copies", "owner", "size")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    d = id_text(docs, id_col, text_col)
    rows = written(fingerprints(d), "fingerprints")
    partly, distinct = _outcome(d, rows)
    wholly = distinct.filter((F.col("copies") > 1) & (F.col("size") >= BYTES.length)).select(
        "text_id", F.col("size").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.lit(hashlib.sha256(b"").hexdigest()).alias("kept_sha256"))
    out = rows.join(partly.drop("kept").unionByName(wholly), "text_id", "left")
    none = F.lit(0).cast("long")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"),
                      F.coalesce("n_spans", none).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` (all columns) without the words of windows of ``WORDS.length`` / 4 words that stand
    in an earlier place too; ``n_chars``, if there is one, is set to what is left."""
    d = id_text(docs)
    partly, distinct = _outcome(d, written(fingerprints(d, WORDS), "fingerprints"), WORDS)
    copied = distinct.filter((F.col("copies") > 1) & (F.col("size") >= WORDS.length)).select("text_id", "owner")
    cut = written(partly.select("text_id", "kept").join(copied, "text_id", "full")
                  .select(F.col("text_id").alias("__text_id"), F.col("kept").alias("__kept"), F.col("owner").alias("__owner")),
                  "kept-texts")
    schema = T.StructType([*docs.schema, T.StructField("__text_id", T.BinaryType())])

    def name(batches):
        for batch in batches:
            for part in in_parts(batch, "text"):
                keys = pa.array([text_key(t) for t in utf8(part.column("text"))], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, keys], [*part.schema.names, "__text_id"])

    rows = docs.mapInArrow(name, schema).join(cut, "__text_id", "left")
    later = F.col("__owner") != F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    changed = F.when(later, F.lit("")).otherwise(F.col("__kept"))
    rows = rows.withColumn("__kept", changed).withColumn("text", F.coalesce("__kept", "text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.col("__kept").isNull(), F.col("n_chars"))
                               .otherwise(F.length("text").cast(kind)))
    return rows.select(*docs.columns)
