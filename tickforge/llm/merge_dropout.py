"""SentencePiece (merge type) encoding with seeded merge-dropout, and decoding.

Segmentation starts from characters and merges adjacent symbols in the order of their
piece's score, leftmost first. Every candidate merge taken from the agenda is skipped for
good with probability ``dropout``, decided by a hash keyed with the seed, the document and
the candidate's place, so that a run is repeatable and every document and place varies. With
``dropout=0`` the ids are those of the sentencepiece library. Characters without a piece, and the blank sign
itself, become byte pieces, so any segmentation decodes to the very text.

No piece holds a blank sign behind another character, so that segments (blanks and what
follows) are independent: all segments of a slice of texts go through the agenda side by
side, one merge per segment and round, as arrays. A segment of over ``LONG`` characters goes
through a heap by itself.

Defined results: null and empty texts have no ids; repeated rows get equal ids (the key is the id
of the document); very long texts are handled whole in slices of bounded size; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text, in_parts, process_cache
from .shingles import mix

DROPOUT = 0.1
SEED = 2
LONG = 192
SLICE = 1 << 18
BLANK = "▁"

_U = np.uint64
_NONE = np.int64(1) << 40
_A, _B, _C = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)


@dataclass
class Pieces:
    """Vocabulary: symbol of each character (``chars`` up to its length; others fall back to
    bytes), a hash table of pairs that merge, and the bytes of each id."""
    chars: np.ndarray
    byte0: int
    slots: np.ndarray
    merged: np.ndarray
    rank: np.ndarray
    shift: int
    spell: list[bytes]

    @staticmethod
    def load(path: str) -> "Pieces":
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        text = [sp.id_to_piece(i) for i in range(n)]
        byte0 = sp.piece_to_id("<0x00>")
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        ids = {text[i]: i for i in plain}
        assert not any(BLANK in p.lstrip(BLANK) for p in ids), "a piece holds a blank behind another character"
        score = np.array([sp.get_score(i) for i in range(n)])
        rank = np.zeros(n, np.int64)
        rank[plain] = np.unique(-score[plain], return_inverse=True)[1]
        pairs = [(ids[p[:k]], ids[p[k:]], i) for p, i in ids.items() for k in range(1, len(p))
                 if p[:k] in ids and p[k:] in ids]
        bits = max(4, int(np.ceil(np.log2(4 * len(pairs) + 1))))
        slots, merged = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        key = np.array([a << 32 | b for a, b, _ in pairs], np.int64)
        for k, s, m in zip(key.tolist(), Pieces._slot(key, 64 - bits).tolist(), (c for _, _, c in pairs)):
            while slots[s] >= 0:
                s = (s + 1) & (len(slots) - 1)
            slots[s], merged[s] = k, m
        single = {ord(p): i for p, i in ids.items() if len(p) == 1}
        chars = np.full(max(single) + 2, -1, np.int32)
        chars[list(single)] = list(single.values())
        spell = [p.replace(BLANK, " ").encode() for p in text]
        for b in range(256):
            spell[byte0 + b] = bytes([b])
        return Pieces(chars, byte0, slots, merged, rank, 64 - bits, spell)

    @staticmethod
    def _slot(key: np.ndarray, shift: int) -> np.ndarray:
        return ((key.astype(np.uint64) * _A) >> _U(shift)).astype(np.int64)

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged symbol of each pair, -1 where there is none."""
        key = left.astype(np.int64) << 32 | (right.astype(np.int64) & 0xFFFFFFFF)
        slot = self._slot(key, self.shift)
        found = self.slots[slot]
        out = np.where(found == key, self.merged[slot], -1)
        open_ = np.flatnonzero((found != key) & (found >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.slots) - 1)
            found = self.slots[slot[open_]]
            hit = found == key[open_]
            out[open_[hit]] = self.merged[slot[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """Symbol of each code point: a piece, a byte piece for ASCII, else minus the point."""
        known = self.chars[np.minimum(points, len(self.chars) - 1)]
        return np.where(known >= 0, known, np.where(points < 128, self.byte0 + points, -points)).astype(np.int32)


def pieces(path: str) -> Pieces:
    """The process's tables of a model file."""
    cache = process_cache("merge_pieces").__dict__
    if path not in cache:
        cache[path] = Pieces.load(path)
    return cache[path]


def _skips(salt: np.ndarray, start, middle, end, dropout: float) -> np.ndarray:
    """Whether the candidate merge of [start, middle) with [middle, end) is skipped."""
    h = mix(salt[start] + (middle - start).astype(np.uint64) * _B + (end - start).astype(np.uint64) * _C)
    return (h >> _U(11)).astype(np.float64) < dropout * float(1 << 53)


def _heap(p: Pieces, sym: list[int], salt: np.ndarray, base: int, dropout: float) -> list[tuple[int, int]]:
    """(place, symbol) of one segment that starts at ``base``, by an agenda in a heap."""
    n = len(sym)
    sym, prev, nxt = list(sym), list(range(-1, n - 1)), [*range(1, n), -1]
    end, agenda = list(range(1, n + 1)), []

    def consider(i):
        j = nxt[i] if i >= 0 else -1
        if j >= 0:
            m = int(p.merge(np.array([sym[i]]), np.array([sym[j]]))[0])
            if m >= 0:
                heapq.heappush(agenda, (int(p.rank[m]), i, j, end[j], m))

    for i in range(n - 1):
        consider(i)
    while agenda:
        _, i, j, e, m = heapq.heappop(agenda)
        if sym[i] is None or sym[j] is None or nxt[i] != j or end[j] != e:
            continue
        if dropout and _skips(salt, *(np.array([base + x]) for x in (i, j, e)), dropout)[0]:
            continue
        sym[i], sym[j], end[i] = m, None, e
        nxt[i] = nxt[j]
        if nxt[j] >= 0:
            prev[nxt[j]] = i
        consider(prev[i])
        consider(i)
    return [(base + i, s) for i, s in enumerate(sym) if s is not None]


def segment(p: Pieces, points: np.ndarray, starts, salt: np.ndarray, dropout: float, long: int = LONG) -> np.ndarray:
    """Symbols at the places of ``points`` where a piece starts, the least int32 elsewhere.
    Segments start at ``starts`` (of texts) and at a blank sign that follows another character."""
    gone = np.iinfo(np.int32).min
    out = np.full(len(points), gone, np.int32)
    blank = points == ord(BLANK)
    head = blank.copy()
    head[1:] &= ~blank[:-1]
    head[starts] = True
    first = np.flatnonzero(head)
    size = np.diff(np.append(first, len(points)))
    sym = p.symbols(points)
    for k in np.flatnonzero(size > long):
        for at, s in _heap(p, sym[first[k]:first[k] + size[k]].tolist(), salt, int(first[k]), dropout):
            out[at] = s
    short = np.repeat(size <= long, size)
    place = np.flatnonzero(short)
    sym = sym[place]
    end = place + 1
    size = size[size <= long]

    def candidates(at: np.ndarray) -> np.ndarray:
        """Rank and index, in one number, of the pairs that begin at the symbols ``at``."""
        m = p.merge(sym[at], sym[at + 1])
        ok = np.flatnonzero(m >= 0)
        if dropout and len(ok):
            a = at[ok]
            ok = ok[~_skips(salt, place[a], place[a + 1], end[a + 1], dropout)]
        c = np.full(len(at), _NONE)
        c[ok] = p.rank[m[ok]]
        return c

    last = np.zeros(len(sym), bool)
    last[np.cumsum(size) - 1] = True
    agenda = np.full(len(sym), _NONE)
    inner = np.flatnonzero(~last)
    agenda[inner] = candidates(inner)
    while len(size):
        head = np.cumsum(size) - size
        # Least rank of each segment, leftmost of equal ones.
        best = np.minimum.reduceat(agenda << 22 | np.arange(len(agenda)) - np.repeat(head, size), head)
        going = best < _NONE << 22
        if not going.all():
            stay = np.repeat(going, size)
            out[place[~stay]] = sym[~stay]
            place, end, sym, agenda, last = place[stay], end[stay], sym[stay], agenda[stay], last[stay]
            best, size = best[going], size[going]
            if not len(size):
                break
            head = np.cumsum(size) - size
        at = head + (best & ((1 << 22) - 1))
        sym[at] = p.merge(sym[at], sym[at + 1])
        end[at], last[at] = end[at + 1], last[at + 1]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        at -= np.arange(len(at))                    # one symbol less in every segment before
        place, end, sym, agenda, last = place[keep], end[keep], sym[keep], agenda[keep], last[keep]
        size = size - 1
        agenda[at] = _NONE
        a = at[~last[at]]
        agenda[a] = candidates(a)
        b = at[at > (np.cumsum(size) - size)] - 1
        agenda[b] = candidates(b)
    return out


def _salt(seed: int, doc: int, n: int) -> np.ndarray:
    key = mix(np.array([(doc * 0x9E3779B97F4A7C15 + seed * 0xC2B2AE3D27D4EB4F) % (1 << 64)], np.uint64))
    return mix(key + np.arange(1, n + 1, dtype=np.uint64) * _A)


def encode_texts(p: Pieces, docs: list[int], texts: list[str], dropout: float = DROPOUT, seed: int = SEED,
                 long: int = LONG) -> list[np.ndarray]:
    """Ids of whole texts, slices of bounded size at a time. A text's slices are cut
    where a segment starts."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    batch, held = [], 0

    def flush():
        nonlocal batch, held
        if batch:
            points = np.concatenate([b[1] for b in batch])
            salt = np.concatenate([b[2] for b in batch])
            starts = np.cumsum([0] + [len(b[1]) for b in batch[:-1]])
            at = segment(p, points, starts, salt, dropout, long)
            cut = 0
            for i, x, _ in batch:
                out[i].append(_spell_out(p, at[cut:cut + len(x)]))
                cut += len(x)
        batch, held = [], 0

    for i, (doc, text) in enumerate(zip(docs, texts)):
        if not text:
            continue
        points = np.frombuffer((" " + text).encode("utf-32-le"), np.uint32).astype(np.int64)
        # The blank sign itself has no piece of its own here: it goes by its bytes.
        points = np.where(points == ord(BLANK), -1, points)
        points = np.where(points == 32, ord(BLANK), points)
        points = np.where(points == -1, _LITERAL, points)
        salt = _salt(seed, doc, len(points))
        lo = 0
        while lo < len(points):
            hi = min(len(points), lo + SLICE)
            while hi < len(points) and not (points[hi] == ord(BLANK) and points[hi - 1] != ord(BLANK)):
                hi += 1
            batch.append((i, points[lo:hi], salt[lo:hi]))
            held += hi - lo
            lo = hi
            if held >= SLICE:
                flush()
    flush()
    return [np.concatenate(x) if x else np.zeros(0, np.int32) for x in out]


# Stands for the blank sign as a character of a text; beyond all code points.
_LITERAL = 0x110000


def _spell_out(p: Pieces, at: np.ndarray) -> np.ndarray:
    """Ids in order, symbols without a piece as the bytes of their character."""
    ids = at[at != np.iinfo(np.int32).min]
    odd = np.flatnonzero(ids < 0)
    if not len(odd):
        return ids
    parts, cut = [], 0
    for k in odd.tolist():
        parts.append(ids[cut:k])
        c = -int(ids[k])
        raw = (BLANK if c == _LITERAL else chr(c)).encode("utf-8", "surrogatepass")
        parts.append(np.frombuffer(raw, np.uint8).astype(np.int32) + p.byte0)
        cut = k + 1
    parts.append(ids[cut:])
    return np.concatenate(parts)


def decode_ids(p: Pieces, ids: list[int]) -> bytes:
    """UTF-8 text of any segmentation."""
    return b"".join(map(p.spell.__getitem__, ids))[1:]


def _lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(x) for x in ids], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))


def encode(docs: DataFrame, model: str, dropout: float = DROPOUT, seed: int = SEED,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row; a narrow map over whole texts."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        p = pieces(model)
        for batch in batches:
            for part in in_parts(batch, "text", SLICE):
                ids = encode_texts(p, part.column("doc_id").fill_null(0).to_pylist(), part.column("text").to_pylist(),
                                   dropout, seed)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _lists(ids)], schema=schema)

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) back from (doc_id, ids)."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        p = pieces(model)
        for batch in batches:
            texts = [decode_ids(p, x or []).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], schema=schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: str, dropout: float = DROPOUT, seed: int = SEED,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, n_bytes, lossless, ids): every text encoded, decoded again
    and compared. The crc is over the ids as little-endian 32-bit integers."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                        ("n_bytes", pa.int64()), ("lossless", pa.bool_()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        p = pieces(model)
        for batch in batches:
            for part in in_parts(batch, "text", SLICE):
                texts = part.column("text").to_pylist()
                ids = encode_texts(p, part.column("doc_id").fill_null(0).to_pylist(), texts, dropout, seed)
                raw = [t.encode() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                     pa.array([len(r) for r in raw], pa.int64()),
                     pa.array([decode_ids(p, x.tolist()) == r for x, r in zip(ids, raw)]), _lists(ids)], schema=schema)

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_crc32 long, n_bytes long, lossless boolean, ids array<int>")
