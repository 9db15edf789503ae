"""Alignment of two tokenizers' tokens over the same bytes.

Every text (with a blank in front) is encoded by a byte-level vocabulary (A) and by a piece
vocabulary (B); both sides cut the same bytes. The tokens of a slice of texts form two tables keyed
by document and ordered by start; ``pandas.merge_asof`` gives each token the other side's token
that covers its start. Both directions together are all overlaps, as of two tokens that
overlap one holds the other's start. Places where both sides end a token cut them into groups.

How many documents hold an id pair is counted over all of them:

1. A slice of at most ``SLICE`` bytes of texts (a longer text is one by itself) yields a row
   per document, with the places of its pairs in the slice's list of pairs and their numbers, and a
   row per pair of that list with the documents of the slice that hold it. Written once.
2. Pairs are summed over slices; an A id's highest count is among its pairs. Ids of A
   are bounded by the vocabulary, so these maxima are broadcast.
3. Counts go back to the slices' lists (a row per slice and pair, not per document), and
   each slice's documents meet its list by ``cogroup``.

Defined results: texts that are null, empty, or that a vocabulary does not give back byte by
byte have no tokens: zeros and ''; every row is a document of its own, repeated ones and ids
included; ties of an A id's highest count are all best; very long texts are aligned whole; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import id_text, in_parts, process_cache, written
from .token_store import PieceEncoder

SLICE = 2 << 20
WORDS = 150_000                 # words remembered by each encoder of a worker
BLANK = "▁"

_ALIGNED = ("slice long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "pairs array<int>, times array<int>, pair long, docs long")
_ARROW = pa.schema([("slice", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
                    ("pairs", pa.list_(pa.int32())), ("times", pa.list_(pa.int32())), ("pair", pa.int64()), ("docs", pa.int64())])
_RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")


def byte_letters() -> dict[str, int]:
    """Letter by which byte-level vocabularies spell each byte: printable Latin-1 characters
    stand for themselves, the others follow from code 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


class WordEncoder(dict):
    """Word -> ids (32-bit) of a blank and the word in a piece vocabulary, nothing where they do not give back
    its bytes. No piece holds a blank behind another character, so words between single blanks
    are independent."""

    def __init__(self, path: str, limit: int = WORDS):
        import sentencepiece
        super().__init__()
        self.model, self.limit = m, _ = sentencepiece.SentencePieceProcessor(model_file=path), limit
        self.spell = [bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace(BLANK, " ").encode()
                      for i in range(m.get_piece_size())]

    def ids(self, text: str) -> bytes | None:
        ids = self.model.encode(text)
        same = b"".join(map(self.spell.__getitem__, ids)) == b" " + text.encode()
        return array("i", ids).tobytes() if same else None

    def __missing__(self, word: str) -> bytes | None:
        if len(self) >= self.limit:
            self.clear()
        ids = self[word] = self.ids(word)
        return ids

    def encode(self, text: str) -> bytes | None:
        """Ids of a text, if they give back a blank and the text."""
        if text[:1] == " " or text[-1:] == " " or "  " in text or BLANK in text:
            return self.ids(text)
        found = list(map(self.__getitem__, text.split(" ")))
        return None if None in found else b"".join(found)


class Aligner:
    """Both encoders, the byte length of every id, and the spellings of groups: ``words`` holds each id
    of A with a comma and with the bar, then each id of B with a comma and with the semicolon."""

    def __init__(self, path_a: str, path_b: str):
        self.encode_a, self.encode_b = PieceEncoder(path_a, WORDS), WordEncoder(path_b)
        tokenizer = self.encode_a.tokenizer
        tokenizer.encode_special_tokens = True
        letters = byte_letters()
        names = {i: t for t, i in tokenizer.get_vocab(with_added_tokens=True).items()}
        self.spell_a = [bytes(letters[c] for c in names.get(i, "")) for i in range(max(names) + 1)]
        self.size_a, self.size_b = (np.array([len(s) for s in side], np.int64) for side in (self.spell_a, self.encode_b.spell))
        numbers = [[str(i) for i in range(len(s))] for s in (self.size_a, self.size_b)]
        self.words = np.array([n + sign for side, signs in zip(numbers, (",|", ",;")) for sign in signs for n in side], object)

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, if both give back the blank and the text."""
        b = self.encode_b.encode(text) if text else None
        if b is None:
            return None
        a = np.frombuffer(self.encode_a.encode(" " + text), "<i4")
        # A byte-level vocabulary changes no byte; it could only lack some.
        if int(self.size_a[a].sum()) != 1 + len(text.encode()):
            return None
        return a, np.frombuffer(b, "<i4")


def aligner(path_a: str, path_b: str) -> Aligner:
    """The process's aligner of two vocabulary files."""
    cache = process_cache("aligners").__dict__
    key = f"{path_a}|{path_b}"
    if key not in cache:
        cache[key] = Aligner(path_a, path_b)
    return cache[key]


def overlaps(doc_a, start_a, doc_b, start_b) -> tuple[np.ndarray, np.ndarray]:
    """(A token, B token) of every overlap of the tokens of some documents. Starts rise over the
    whole slice; both sides cover the same bytes."""
    a = pd.DataFrame({"doc": doc_a, "start": start_a, "a": np.arange(len(start_a))})
    b = pd.DataFrame({"doc": doc_b, "start": start_b, "b": np.arange(len(start_b))})
    from_a = pd.merge_asof(a, b, on="start", by="doc")
    from_b = pd.merge_asof(b, a, on="start", by="doc")
    # A pair with equal starts is found from both sides.
    other = from_b["a"].to_numpy()
    new = start_a[other] != start_b
    return (np.concatenate([from_a["a"].to_numpy(), other[new]]),
            np.concatenate([from_a["b"].to_numpy(), from_b["b"].to_numpy()[new]]))


def group_marks(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every token of both sides whether its end is one of the other side, too."""
    return (end_b[np.minimum(np.searchsorted(end_b, end_a), len(end_b) - 1)] == end_a,
            end_a[np.minimum(np.searchsorted(end_a, end_b), len(end_a) - 1)] == end_b)


def spelled(al: Aligner, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> np.ndarray:
    """Places in ``al.words`` of the ids of both sides in the order of their groups: A tokens of a
    group, then its B tokens, the last of each with its closing sign."""
    n_a, n_b = len(al.size_a), len(al.size_b)
    group_a = np.cumsum(cut_a) - cut_a
    group_b = np.cumsum(cut_b) - cut_b
    out = np.empty(len(a) + len(b), np.int32)
    # In front of a token of A stand all B tokens of earlier groups, and so on.
    out[np.arange(len(a)) + np.concatenate([[0], np.flatnonzero(cut_b) + 1])[group_a]] = a + n_a * cut_a
    out[np.arange(len(b)) + (np.flatnonzero(cut_a) + 1)[group_b]] = b + (2 * n_a + n_b * cut_b)
    return out


def align_slice(al: Aligner, ids: list, texts: list[str], number: int) -> pa.RecordBatch:
    """Rows of a slice: its documents, then its pairs."""
    tokens = [al.ids(t) for t in texts]
    some = [k for k, t in enumerate(tokens) if t is not None]
    n = len(texts)
    rows = {f.name: None for f in _ARROW}
    zero = np.zeros(n, np.int64)
    n_a, n_b, n_groups, n_links, shas = zero.copy(), zero.copy(), zero.copy(), zero.copy(), [""] * n
    offsets, places, times, pairs, docs = np.zeros(n + 1, np.int32), zero[:0], zero[:0], zero[:0], zero[:0]
    if some:
        a, b = (np.concatenate([tokens[k][s] for k in some]) for s in (0, 1))
        size_a, size_b = ([len(tokens[k][s]) for k in some] for s in (0, 1))
        doc_a, doc_b = (np.repeat(np.array(some), s) for s in (size_a, size_b))
        end_a, end_b = np.cumsum(al.size_a[a]), np.cumsum(al.size_b[b])
        la, lb = overlaps(doc_a, end_a - al.size_a[a], doc_b, end_b - al.size_b[b])
        cut_a, cut_b = group_marks(end_a, end_b)
        n_a, n_b = np.bincount(doc_a, minlength=n), np.bincount(doc_b, minlength=n)
        n_groups, n_links = np.bincount(doc_a[cut_a], minlength=n), np.bincount(doc_a[la], minlength=n)
        words, at = spelled(al, a, b, cut_a, cut_b), 0
        for k, sa, sb in zip(some, size_a, size_b):
            line = "".join(al.words[words[at:at + sa + sb]].tolist())[:-1]
            shas[k] = hashlib.sha256(line.encode()).hexdigest()
            at += sa + sb
        span = np.int64(len(al.size_b))
        whole = np.int64(len(al.size_a)) * span
        held, times = np.unique(doc_a[la] * whole + (a[la] * span + b[lb]), return_counts=True)
        offsets[1:] = np.cumsum(np.bincount(held // whole, minlength=n))
        pairs, places, docs = np.unique(held % whole, return_inverse=True, return_counts=True)
    p = len(pairs)
    rows["slice"] = pa.array(np.full(n + p, number, np.int64))
    rows["doc_id"] = pa.concat_arrays([ids, pa.nulls(p, pa.int64())])
    for name, v in (("n_a", n_a), ("n_b", n_b), ("n_groups", n_groups), ("n_links", n_links)):
        rows[name] = pa.concat_arrays([pa.array(v.astype(np.int64)), pa.nulls(p, pa.int64())])
    rows["groups_sha256"] = pa.concat_arrays([pa.array(shas, pa.string()), pa.nulls(p, pa.string())])
    for name, v in (("pairs", places), ("times", times)):
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(v.astype(np.int32)))
        rows[name] = pa.concat_arrays([lists, pa.nulls(p, pa.list_(pa.int32()))])
    for name, v in (("pair", pairs), ("docs", docs)):
        rows[name] = pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(v.astype(np.int64))])
    return pa.RecordBatch.from_arrays([rows[f.name] for f in _ARROW], schema=_ARROW)


def aligned(docs: DataFrame, path_a: str, path_b: str, slice_bytes: int = SLICE) -> DataFrame:
    """Documents and pairs of every slice of ``docs`` (doc_id, text)."""
    def run(batches):
        al, number = aligner(path_a, path_b), TaskContext.get().partitionId() << 32
        held, size = [], 0

        def done():
            nonlocal held, size, number
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size, number = [], 0, number + 1
            return align_slice(al, t.column("doc_id"), t.column("text").to_pylist(), number - 1)

        for batch in batches:
            for part in in_parts(batch, "text", slice_bytes // 4):
                n = pa.compute.sum(pa.compute.binary_length(part.column("text"))).as_py() or 0
                if held and size + n > slice_bytes:
                    yield done()
                held.append(part)
                size += n
        if held:
            yield done()

    return docs.mapInArrow(run, _ALIGNED)


def token_links(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                slice_bytes: int = SLICE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    import sentencepiece
    # Pairs are numbered a * span + b.
    span = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    table = written(aligned(id_text(docs, id_col, text_col), path_a, path_b, slice_bytes), "aligned")
    entries = table.filter("pair is not null").select("slice", "pair", "docs")
    total = entries.groupBy("pair").agg(F.sum("docs").alias("count"))
    total = written(total.withColumn("a", F.expr(f"pair div {span}")), "pair-counts")
    best = total.groupBy("a").agg(F.max("count").alias("best"))     # at most one row per id of A
    scored = total.join(F.broadcast(best), "a").select("pair", "count", (F.col("count") == F.col("best")).alias("is_best"))
    lists = entries.select(F.col("slice").alias("of"), "pair").join(scored, "pair")
    schema = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                        ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])

    def finish(rows: pa.Table, listed: pa.Table) -> pa.Table:
        order = np.argsort(listed.column("pair").to_numpy())
        count = listed.column("count").to_numpy()[order]
        is_best = listed.column("is_best").to_numpy()[order].astype(np.int64)
        rows = rows.combine_chunks()
        pairs = rows.column("pairs").combine_chunks()
        at = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(pairs).to_numpy(zero_copy_only=False))]).astype(np.int64)
        place, times = (rows.column(c).combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("pairs", "times"))
        sums = [np.concatenate([[0], np.cumsum(v[place] * times)]) if len(place) else np.zeros(1, np.int64) for v in (is_best, count)]
        n_best, count_sum = ((s[at[1:]] - s[at[:-1]]).astype(np.int64) for s in sums)
        cols = {**{c: rows.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")},
                "n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
        return pa.table([cols[f.name] for f in schema], schema=schema)

    rows = table.filter("pair is null").drop("pair", "docs")
    return rows.groupBy("slice").cogroup(lists.groupBy("of")).applyInArrow(finish, _RESULT)
