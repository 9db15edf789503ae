"""Token ids in ORC: run-length encoded integers, row indexes, Bloom filters.

Texts are dealt out by ranges of ``doc_id``, sorted inside each range, encoded and
written as ORC, so that files and stripes hold ascending ids. ORC stores the id lists as
run-length encoded integers, keeps minima and maxima per stripe and per
``index_stride`` rows, and a Bloom filter on ``doc_id``. Readers split files by stripe and
skip stripes and row groups that the pushed-down filter excludes.

Encoding goes through the tokenizers library. A text is cut at those single blanks where
its pre-tokenizer always starts a new piece, and every distinct piece is encoded once per
worker process; texts with longer runs of white space, where that does not hold, are
encoded whole.

Defined results: null and empty texts become the end id alone; rows with equal ids keep
their number and stand side by side in hash order of their texts; very long texts are one
row each; other columns are ignored; an empty table gives an empty file set and result.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import scratch_path
from .common import id_text, in_parts, process_cache, written

INDEX_STRIDE = 2_000
STRIPE_BYTES = 16 << 20
# Distinct pieces a worker remembers (about 200 bytes each).
CACHE_PIECES = 700_000
# White space on both sides of a blank: pieces are not independent there. The literal
# blank in front lets the search skip from blank to blank.
_RUNS = re.compile(r" (?<=\s )(?=\s)")
# Marks that the pre-tokenizer always parts from letters before them.
_MARKS = frozenset(".,;:!?")


class PieceEncoder(dict):
    """Blank-led piece of a text -> its ids as 32-bit integers.

    Words of letters alone go straight to the library's merge model, as they are one piece
    for its pre-tokenizer; words with one mark behind them and lines that meet inside a
    piece are put together from their parts; everything else is encoded as it stands."""

    def __init__(self, path: str, limit: int = CACHE_PIECES):
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.model, self.split = self.tokenizer.model, self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.letters: dict[int, str] = {}           # letter -> its bytes as the model spells them
        self.heads: dict[str, bytes] = {}           # pieces at the start of a line
        self.blank = self.split(" a")[0][0][:-1]
        self.marks = {m: self.ids(m) for m in _MARKS}
        self.newline = self.ids("\n")

    def ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def word(self, word: str, before: str) -> bytes:
        """Ids of letters alone, after ``before`` (the model's blank or nothing)."""
        if not word.isascii():
            for c in word:
                if ord(c) not in self.letters:
                    self.letters[ord(c)] = self.split(c)[0][0]
            word = word.translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(before + word)]).tobytes()

    def piece(self, piece: str, lead: str) -> bytes:
        """Ids of a piece after ``lead`` (a blank or nothing)."""
        before = self.blank if lead else ""
        if piece.isalpha():
            return self.word(piece, before)
        if piece and piece[-1] in self.marks and piece[:-1].isalpha():
            return (self[piece[:-1]] if lead else self.word(piece[:-1], "")) + self.marks[piece[-1]]
        return self.ids(lead + piece)

    def head(self, piece: str) -> bytes:
        """Ids of a piece that starts a text or line."""
        ids = self.heads.get(piece)
        if ids is None:
            if len(self.heads) >= self.limit // 4:
                self.heads.clear()
            ids = self.heads[piece] = self.piece(piece, "")
        return ids

    def __missing__(self, piece: str) -> bytes:
        if "\n" in piece:
            first, *lines = piece.split("\n")
            if piece.split() == [first, *lines]:        # single line ends between words
                return self[first] + b"".join(self.newline + self.head(x) for x in lines)
        if len(self) >= self.limit:
            self.clear()
        ids = self[piece] = self.piece(piece, " ")
        return ids

    def encode(self, text: str) -> bytes:
        if not text or _RUNS.search(text):
            return self.ids(text) if text else b""
        head, *rest = text.split(" ")
        return (self.head(head) if head else b"") + b"".join(map(self.__getitem__, rest))


def encoder(path: str) -> PieceEncoder:
    """The process's encoder for a vocabulary file."""
    cache = process_cache("piece_encoders")
    if path not in cache.__dict__:
        cache.__dict__[path] = PieceEncoder(path)
    return cache.__dict__[path]


def encode_ids(docs: DataFrame, vocabulary: str, end_id: int = 0) -> DataFrame:
    """(doc_id, ids): ids of each whole text with ``end_id`` appended."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        enc = encoder(vocabulary)
        for batch in batches:
            for part in in_parts(batch, "text"):
                rows = [enc.encode(t) + end for t in part.column("text").to_pylist()]
                offsets = np.zeros(len(rows) + 1, np.int32)
                np.cumsum([len(r) // 4 for r in rows], out=offsets[1:])
                flat = np.frombuffer(b"".join(rows), "<i4")
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                    schema=schema)

    return docs.mapInArrow(run, "doc_id long, ids array<int>")


def write_token_store(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0,
                      id_col: str = "doc_id", text_col: str = "text",
                      index_stride: int = INDEX_STRIDE, stripe_bytes: int = STRIPE_BYTES) -> None:
    """Encode ``docs`` and write them as ORC in ascending ``doc_id`` order."""
    rows = id_text(docs, id_col, text_col)
    # The hash keeps apart what shares an id; equal rows are interchangeable.
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie")
    rows = rows.sortWithinPartitions("doc_id", "tie").drop("tie")
    (encode_ids(rows, vocabulary, end_id).write.format("orc")
     .option("compression", "zstd")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.create.index", "true").option("orc.row.index.stride", str(index_stride))
     .option("orc.stripe.size", str(stripe_bytes)).option("orc.dictionary.key.threshold", "0")
     .save(path))


def read_token_store(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids) of a store; filters on ``doc_id`` are pushed to stripes and row groups."""
    return spark.read.schema("doc_id long, ids array<int>").orc(path)


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Rows of a few documents, found through file and stripe minima and Bloom filters."""
    return read_token_store(spark, path).filter(F.col("doc_id").isin([int(i) for i in doc_ids]))


def token_table(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored document. Only counts move:
    ids are summed up where their stripe is read; a file's documents are then numbered
    inside the file, and files among each other by one row per file."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                        ("file", pa.string()), ("block", pa.int64()), ("row", pa.int64())])

    def digest(batches):
        for batch in batches:
            ids = batch.column("ids")
            # Slices of Arrow lists keep their offsets into the shared values.
            at = ids.offsets.to_numpy()
            flat = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<u4")).cast("B")
            crc = [zlib.crc32(flat[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64()),
                 batch.column("file"), batch.column("block"), batch.column("row")], schema=schema)

    rows = (read_token_store(spark, path)
            .select("doc_id", "ids", F.col("_metadata.file_name").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))
            .mapInArrow(digest, "doc_id long, n_tokens long, ids_crc32 long, file string, block long, row long"))
    rows = written(rows, "token-counts")        # read twice below; a few bytes per document
    within = Window.partitionBy("file").orderBy("block", "row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    # One row per file: files bear the number of their task, and tasks the order of ids.
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("all"))
    task = F.regexp_extract("file", "^part-([0-9]+)", 1).cast("long")
    earlier = Window.orderBy(task, "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("base"))
    return rows.join(files, "file").select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def store_and_read(docs: DataFrame, vocabulary: str, end_id: int = 0, id_col: str = "doc_id",
                   text_col: str = "text", path: str | None = None) -> DataFrame:
    """Write the store (to the shared folder unless ``path`` is given) and read it back."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, f"token-store-{uuid.uuid4().hex}")
    write_token_store(docs, path, vocabulary, end_id, id_col, text_col)
    return token_table(spark, path)
