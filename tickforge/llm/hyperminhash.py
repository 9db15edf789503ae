"""Near-duplicate documents by HyperMinHash.

A document is the set of its hashed word shingles. Its sketch has ``BUCKETS`` registers;
each keeps, of the least hash in its bucket, the count of leading zeros (6 bits) and
``MANTISSA`` bits after the leading one: as many as keep accidental agreement of nearly empty
bands rare among billions of documents. ``ROWS`` neighbouring registers form a band; documents
that agree in a band are candidates. Within a band's bucket, sketches are compared
(register agreement less the expected accidental collisions, over occupied registers) and
pairs far below the threshold are dropped; the rest are confirmed on full shingle sets.

What moves is never a pair of documents before it is a confirmed link:

* equal sets are one node from the start, so exact copies cost one row per document;
* a bucket with many members is cut into blocks by hash; sketches are compared as matrices, first inside
  the blocks only. Blocks of different bands mix members anew, so members that belong together are
  mostly one component by then; across blocks only members of different components meet (a bucket's largest
  component with the rest, and the rest among each other), in a task for every two blocks;
* a pair is taken up only in the first band it agrees in, so no pair is confirmed twice; inside a task rows that
  both have a pair left are not compared again, nor are sets that its links have joined already, so a
  group of near copies costs about one comparison a member;
* texts join only the nodes that have a pair left to confirm;
* of the links a task confirms it returns a spanning forest, which names the same components.

A ``Measure`` says how many words a shingle has, from which similarity on sets are linked and how
the bands are cut. The query uses ``QUERY``; ``keep_one_of_each`` links what any of ``STAGE`` links:
an edit of one word costs more five-word shingles than three-word ones, a passage put in
one place costs about as many of both, so neither measure finds all that the other does. Sets of a longer
shingle tell apart whatever sets of a shorter one do, so links are brought to the sets of the first
(shortest) measure, and components are those of all links together.

At its threshold a pair shares no band of a measure with a chance of about 3e-7, (1 - 0.85**6)**32 and
(1 - 0.8**5)**38; the sketch test lies five standard deviations below the threshold.

Defined results: null, empty or blank texts have an empty set and link with nothing (their own
component); texts under three words are one shingle; repeated rows share their set and
component; very long texts are handled whole; ids that repeat with different texts are separate
nodes and the least id names the component; rows without an id are linked like any other, and
a component of such rows alone has no name and is kept by one of its sets; other columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import discard, id_text, in_parts, small_side, sorted_groups, utf8, written
from .graph import components
from .shingles import mix, shingle_set

ROWS, BANDS = 6, 32
BUCKETS = ROWS * BANDS
MANTISSA = 26
SHINGLE = 3
PERCENT = 85
MARGIN = 5.0
BAND_BITS = 63                        # low bits of a key that hold its band


@dataclass(frozen=True)
class Measure:
    """Sets of ``shingle``-word shingles, linked where 100 * shared >= percent * union; sketches
    of ``bands`` bands (64 at most) of ``rows`` registers."""
    shingle: int = SHINGLE
    percent: int = PERCENT
    rows: int = ROWS
    bands: int = BANDS

    @property
    def buckets(self) -> int:
        return self.rows * self.bands


QUERY = Measure()
STAGE = (QUERY, Measure(5, 80, 5, 38))
# Members of a block and their shingles (8 bytes each).
BLOCK_DOCS, BLOCK_SHINGLES = 1_024, 2_000_000

_U = np.uint64


def sketch(hashes: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Registers of a sorted hash set (0: empty bucket)."""
    out = np.zeros(buckets, np.uint32)
    if len(hashes):
        bucket = ((hashes >> _U(32)) * _U(buckets)) >> _U(32)
        first = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1))
        rest = hashes[first] * _U(buckets)                 # uniform and rising within a bucket
        zeros = np.clip(64 - np.frexp(rest.astype(np.float64))[1], 0, 62).astype(np.uint64)
        after = (rest << (zeros + _U(1))) >> _U(64 - MANTISSA)
        out[bucket[first].astype(np.int64)] = (((zeros + _U(1)) << _U(MANTISSA)) | after).astype(np.uint32)
    return out


def band_keys(registers: np.ndarray, m: Measure = QUERY) -> np.ndarray:
    """(documents, bands) keys of the bands; 0 where all registers of a band are empty."""
    r = registers.reshape(len(registers), m.bands, m.rows).astype(np.uint64)
    key = np.broadcast_to(mix(np.arange(1, m.bands + 1, dtype=np.uint64)), r.shape[:2])
    for i in range(m.rows):
        key = mix(key * _U(0x9E3779B97F4A7C15) + r[:, :, i])
    band = np.arange(m.bands, dtype=np.uint64)
    return np.where(r.any(2), (key & ~_U(BAND_BITS)) | band, _U(0)).astype(np.int64)


def expected_collisions(n, m, buckets: int = BUCKETS) -> np.ndarray:
    """Registers that agree by accident in sketches of ``n`` and ``m`` elements (public
    approximation for large sets; an upper estimate for small ones)."""
    share = 4.0 * n * m / np.square(n + m, dtype=np.float64)
    return 0.169919487159739093975 * buckets / (1 << MANTISSA) * share


def estimates(registers: np.ndarray, size: np.ndarray, i: int, js: np.ndarray, m: Measure = QUERY):
    """(Jaccard estimates, occupied registers) of row ``i`` with rows ``js``."""
    a, b = registers[i], registers[js]
    occupied = np.count_nonzero(a) + (np.count_nonzero(b[:, a == 0], axis=1) if not a.all() else np.zeros(len(js), np.int64))
    equal = np.zeros((len(js), -(-m.buckets // 8) * 8), bool)
    np.logical_and(b == a, a > 0, out=equal[:, :m.buckets])
    # Eight counts to a word: a byte's count is at most an eighth of the registers.
    agree = equal.view(np.uint64).sum(1).view(np.uint8).reshape(-1, 8).sum(1, dtype=np.int64)
    accidental = expected_collisions(float(size[i]), size[js].astype(np.float64), m.buckets)
    return (agree - accidental) / np.maximum(occupied, 1), occupied


def _close_pairs(registers, size, block, root, band, here: tuple[int, int], m: Measure, left):
    """Index pairs of a bucket's rows of different ``root`` that may be linked and first agree in
    ``band``. With two blocks only pairs across them are looked at. ``left(i, js)`` marks the rows ``js`` that row
    ``i`` still has to meet after the pairs taken so far."""
    goal = m.percent / 100
    rows = np.arange(len(size))
    # All rows agree in this band; those that agree in one before meet there.
    before = np.ascontiguousarray(band_keys(registers, m)[:, :band])
    for i in rows:
        js = rows[block == here[1]] if here[0] != here[1] else rows[i + 1:]
        if here[0] != here[1] and block[i] != here[0] or not len(js):
            continue
        # Sets whose sizes differ too much can't reach the threshold.
        lo, hi = np.minimum(size[i], size[js]), np.maximum(size[i], size[js])
        js = js[(100 * lo >= m.percent * hi) & (root[js] != root[i]) & left(i, js)]
        js = js[~((before[js] == before[i]) & (before[i] != 0)).any(1)]
        if not len(js):
            continue
        est, occupied = estimates(registers, size, i, js, m)
        near = (est >= goal - MARGIN * np.sqrt(goal * (1 - goal) / np.maximum(occupied, 1)))
        for j in js[near]:
            yield int(i), int(j)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Elements that two sorted non-empty sets share."""
    a, b = (a, b) if len(a) >= len(b) else (b, a)
    return int(np.count_nonzero(a[np.minimum(a.searchsorted(b), len(a) - 1)] == b))


def _registers(column: pa.Array, m: Measure) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, m.buckets)


def _node(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def sketches(docs: DataFrame, measures: tuple[Measure, ...] = (QUERY,)) -> DataFrame:
    """(doc_id, key, then n_k, node_k, registers_k for measure k) of every row (doc_id, key, text); node (a 128-bit hash of
    the set) and registers are null for empty sets."""
    kinds = [("n", pa.int64(), "long"), ("node", pa.binary(), "binary"), ("registers", pa.binary(), "binary")]
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), *((f"{c}_{k}", t) for k in range(len(measures)) for c, t, _ in kinds)])
    ddl = ", ".join(["doc_id long", "key long", *(f"{c}_{k} {t}" for k in range(len(measures)) for c, _, t in kinds)])

    def run(batches):
        for batch in batches:
            for part in in_parts(batch, "text"):
                columns, texts = [part.column("doc_id"), part.column("key")], utf8(part.column("text"))
                for m in measures:
                    sets = [shingle_set(t, m.shingle) for t in texts]
                    columns += [pa.array([len(s) for s in sets], pa.int64()),
                                pa.array([_node(s) if len(s) else None for s in sets], pa.binary()),
                                pa.array([sketch(s, m.buckets).tobytes() if len(s) else None for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.mapInArrow(run, ddl)


def _bands(nodes: DataFrame, m: Measure) -> DataFrame:
    """(key, id, n) rows of every non-empty band of every node (id, n, registers); the low
    six bits of a key are its band."""
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(_registers(batch.column("registers"), m), m)
                doc, band = np.nonzero(keys)
                owner = pa.array(doc)
                yield pa.RecordBatch.from_arrays([pa.array(keys[doc, band]), batch.column("id").take(owner),
                                                  batch.column("n").take(owner)], schema=schema)

    return nodes.select("id", "n", "registers").mapInArrow(run, "key long, id long, n long")


_GROUP = ["key", "i", "j"]
_MEMBER = pa.schema([("key", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("block", pa.int32()), ("id", pa.int64()),
                     ("root", pa.int64())])


def _blocks_of(docs, shingles):
    """Blocks that so many members with so many shingles are cut into."""
    return F.ceil(F.greatest(docs / BLOCK_DOCS, shingles / BLOCK_SHINGLES)).cast("int")


def _shared(bands: DataFrame) -> DataFrame:
    """(key, blocks) of the buckets with two members or more."""
    return written(bands.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s")).filter("c > 1")
                   .select("key", _blocks_of(F.col("c"), F.col("s")).alias("blocks")), "shared-bands")


def _inside(bands: DataFrame, shared: DataFrame) -> DataFrame:
    """Rows of shared buckets, each in its block alone."""
    block = F.pmod(F.xxhash64("id", "key"), F.col("blocks")).cast("int")
    return (bands.join(small_side(shared), "key").withColumn("block", block)
            .select("key", F.col("block").alias("i"), F.col("block").alias("j"), "block", "id", F.col("id").alias("root")))


def _across(bands: DataFrame, wide: DataFrame, stars: DataFrame) -> DataFrame:
    """Rows of the buckets ``wide`` (key) that hold members of several components (``stars``: node, root), in
    all block pairs in which members of different components may meet, written. Blocks of the rest come
    first, those of the largest component behind them; the latter meet blocks of the rest only."""
    rows = bands.join(small_side(wide), "key").join(small_side(stars.withColumnRenamed("node", "id")), "id", "left")
    found = rows = written(rows.withColumn("root", F.coalesce("root", "id")), "wide-rows")
    parts = written(rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s")), "bucket-parts")
    both = (parts.groupBy("key").agg(F.max(F.struct("c", "root", "s")).alias("t"), F.sum("c").alias("c"), F.sum("s").alias("s"))
            .filter("c > t.c"))
    cuts = written(both.select("key", F.col("t.root").alias("top"), _blocks_of(F.col("c") - F.col("t.c"), F.col("s") - F.col("t.s")).alias("rest"),
                               _blocks_of(F.col("t.c"), F.col("t.s")).alias("tops")), "bucket-cuts")
    discard(parts)
    rows = rows.join(small_side(cuts), "key")
    hashed, of_top = F.xxhash64("id", "key"), F.col("root") == F.col("top")
    rows = rows.withColumn("block", F.when(of_top, F.col("rest") + F.pmod(hashed, F.col("tops")))
                           .otherwise(F.pmod(hashed, F.col("rest"))).cast("int"))
    last = F.when(of_top, F.col("rest")).otherwise(F.col("rest") + F.col("tops")) - 1
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    out = written(rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                              "block", "id", "root"), "across")
    discard(found, cuts)
    return out


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.repartition(*[F.col(c) for c in _GROUP]).sortWithinPartitions(*_GROUP)


def _place(g: pa.RecordBatch) -> tuple[int, tuple[int, int]]:
    """(band, blocks) of a group."""
    return g.column("key")[0].as_py() & BAND_BITS, (g.column("i")[0].as_py(), g.column("j")[0].as_py())


def _survivors(members: DataFrame, nodes: DataFrame, m: Measure) -> DataFrame:
    """Bucket rows that have a pair left to confirm after comparing sketches."""
    def run(batches):
        for g in sorted_groups(batches, _GROUP):
            if g.num_rows < 2:
                continue
            band, here = _place(g)
            kept = np.zeros(g.num_rows, bool)
            # Two rows that both have a pair already need not be compared.
            for pair in _close_pairs(_registers(g.column("registers"), m), g.column("n").to_numpy(),
                                     g.column("block").to_numpy(), g.column("root").to_numpy(), band, here, m,
                                     lambda i, js: ~(kept[i] & kept[js])):
                kept[list(pair)] = True
            if kept.any():
                yield g.select(_MEMBER.names).take(pa.array(np.flatnonzero(kept))).cast(_MEMBER)

    rows = members.join(nodes.select("id", "n", "registers"), "id")
    return _grouped(rows).mapInArrow(run, "key long, i int, j int, block int, id long, root long")


def _links(survivors: DataFrame, texts: DataFrame, m: Measure) -> DataFrame:
    """(a, b): confirmed links between nodes, a spanning forest of each group's; sets are
    made again from the joined texts."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for g in sorted_groups(batches, _GROUP):
            sets, seen = {}, []
            for k, (i, node, text) in enumerate(zip(g.column("id").to_pylist(), g.column("node").to_pylist(),
                                                    utf8(g.column("text")))):
                if i not in sets:
                    s = shingle_set(text, m.shingle)
                    if _node(s) == node:            # keys of other rows may be equal by chance
                        sets[i] = s
                        seen.append(k)
            if len(seen) < 2:
                continue
            ids, sets = list(sets), list(sets.values())
            regs = np.stack([sketch(s, m.buckets) for s in sets])
            band, here = _place(g)
            part = np.arange(len(ids))                  # component of each set so far
            found = []
            for x, y in _close_pairs(regs, np.array([len(s) for s in sets]), g.column("block").to_numpy()[seen],
                                     g.column("root").to_numpy()[seen], band, here, m,
                                     lambda i, js: part[js] != part[i]):
                if part[x] == part[y]:
                    continue
                both, same = len(sets[x]) + len(sets[y]), _common(sets[x], sets[y])
                if 100 * same >= m.percent * (both - same):
                    part[part == part[x]] = part[y]
                    found.append((ids[x], ids[y]))
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()),
                                              pa.array([f[1] for f in found], pa.int64())], schema=schema)

    return _grouped(survivors.join(texts, "id")).mapInArrow(run, "a long, b long")


def _confirmed(d: DataFrame, sets: DataFrame, nodes: DataFrame, members: DataFrame, m: Measure) -> DataFrame:
    """(a, b): links among ``members`` of shared buckets, written."""
    survivors = written(_survivors(members, nodes, m), "survivors")
    # Texts of the sets that survived, by the key of a row that has the set.
    wanted = written(survivors.select("id").distinct().join(sets, "id").select("id", "node", "key"), "wanted")
    texts = d.join(small_side(wanted), "key").select("id", "node", "text")
    links = written(_links(survivors, texts, m).distinct(), "links")
    discard(survivors, wanted)
    return links


def _linked_sets(d: DataFrame, rows: DataFrame, k: int, m: Measure) -> tuple[DataFrame, DataFrame]:
    """((node, rep, key, id) of every set of measure ``k`` in the sketch table, links (a, b) between ids)."""
    mine = rows.select("doc_id", "key", "row", F.col(f"n_{k}").alias("n"), F.col(f"node_{k}").alias("node"),
                       F.col(f"registers_{k}").alias("registers"))
    # One row per set: its least document, the key of a row with its text and the row that stands for it.
    sets = written(mine.filter("node is not null").groupBy("node")
                   .agg(F.min("doc_id").alias("rep"), F.min("key").alias("key"), F.min("row").alias("id")), "sets")
    nodes = mine.join(small_side(sets.select("id")), F.col("row") == F.col("id"))
    bands = written(_bands(nodes, m), "bands")
    shared = _shared(bands)
    links = _confirmed(d, sets, nodes, _inside(bands, shared), m)
    wide = shared.filter("blocks > 1").select("key")
    if wide.take(1):
        stars = written(components(links).filter("node != root"), "stars")
        across = _across(bands, wide, stars)
        discard(bands)
        # Only sketches of sets that meet others there move again.
        ids = written(across.select("id").distinct(), "across-ids")
        more = _confirmed(d, sets, nodes.join(small_side(ids), "id", "left_semi"), across, m)
        # Stars name the same components as the links they come from.
        links = written(stars.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more), "links")
        discard(across, ids, stars, more)
    else:
        discard(bands)
    discard(shared)
    return sets, links


def _judged(d: DataFrame, measures: tuple[Measure, ...]) -> DataFrame:
    """(doc_id, key, n_shingles, component_id, kept, nameless) of every row of ``d`` (doc_id, text); sizes are
    those of the first measure, whose shingles are the shortest. ``nameless`` is the set of a row
    whose component holds no id."""
    d = _keyed(d)
    rows = written(sketches(d, measures).withColumn("row", F.monotonically_increasing_id()), "sketches")
    sets, links = _linked_sets(d, rows, 0, measures[0])
    found, temporary = [links], [sets, links]
    for k, m in enumerate(measures[1:], 1):
        finer, more = _linked_sets(d, rows, k, m)
        temporary += [finer, more]
        # A set of this measure lies within one of the first: that of the row that stands for it.
        ends = written(more.select(F.explode(F.array("a", "b")).alias("row")).distinct()
                       .join(rows.select("row", F.col("node_0").alias("node")), "row")
                       .join(sets, "node").select("row", "id"), "ends")
        temporary.append(ends)
        for c in ("a", "b"):
            more = more.join(ends.select(F.col("row").alias(c), F.col("id").alias(f"{c}_id")), c)
        found.append(more.select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).filter("a != b"))
    named = components(reduce(DataFrame.unionByName, found)).withColumnRenamed("node", "id").join(sets.select("id", "rep"), "id")
    least = named.groupBy("root").agg(F.min("rep").alias("component"), F.min("id").alias("first"))
    linked = named.join(least, "root").select("id", "component", "first")
    component = F.coalesce("component", "rep")
    classes = written(sets.join(linked, "id", "left")
                      .select("node", component.alias("component"), F.when(component.isNull(), F.col("id")).alias("nameless"),
                              (component.isNull() & (F.col("id") != F.coalesce("first", "id"))).alias("later")), "classes")
    discard(*temporary)
    out = rows.select("doc_id", "key", F.col("n_0").alias("n_shingles"), F.col("node_0").alias("node")).join(classes, "node", "left")
    component = F.coalesce("component", "doc_id")
    stands = F.col("doc_id").eqNullSafe(component) & ~F.coalesce("later", F.lit(False))
    return out.select("doc_id", "key", "n_shingles", component.alias("component_id"), stands.alias("kept"), "nameless")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT, shingle: int = SHINGLE, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row. Sets are linked where
    100 * shared >= percent * union; lower thresholds need more bands or fewer rows."""
    return (_judged(id_text(docs, id_col, text_col), (Measure(shingle, percent, rows, bands),))
            .drop("key", "nameless"))


def keep_one_of_each(docs: DataFrame, measures: tuple[Measure, ...] = STAGE) -> DataFrame:
    """Rows of ``docs`` (all columns) that stand for their component: those of its least id, or
    one row where it has no id. Of rows that repeat an id and its text one stays. Sets are
    linked by any of ``measures``."""
    kept = written(_judged(id_text(docs), measures).filter("kept").select("doc_id", "key", "nameless"), "kept-rows")
    named = kept.filter("nameless is null").select("doc_id", "key")
    nameless = (kept.filter("nameless is not null").groupBy("nameless").agg(F.min("key").alias("key"))
                .select(F.lit(None).cast("long").alias("doc_id"), "key"))
    # The nameless key stands with as many rows as repeat it.
    repeats = kept.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n"))
    chosen = named.unionByName(nameless).distinct().select(F.col("doc_id").alias("c_id"), F.col("key").alias("c_key"))
    rows = written(repeats.join(chosen, (F.col("key") == F.col("c_key")) & F.col("doc_id").eqNullSafe(F.col("c_id")),
                                "left_semi"), "kept-keys")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumn("__key", F.xxhash64(F.col("doc_id").cast("long"), text))

    def of(keys: DataFrame) -> DataFrame:
        side = small_side(keys.select(F.col("doc_id").alias("__id"), F.col("key").alias("__kept_key")))
        return keyed.join(side, (F.col("__key") == F.col("__kept_key"))
                          & F.col("doc_id").cast("long").eqNullSafe(F.col("__id")), "left_semi")

    return of(rows.filter("n = 1")).unionByName(of(rows.filter("n > 1")).dropDuplicates(["doc_id", "text"])).drop("__key")


def _keyed(d: DataFrame) -> DataFrame:
    """``d`` (doc_id, text) with a key of each row that is never null."""
    return d.withColumn("key", F.xxhash64("doc_id", "text"))
