"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes. Each passage is described by its byte
frequencies, hashed byte trigrams and how few of those are distinct, encoded by a learned
layer, and weighted by gated attention (tanh times logistic, softmax over the document).
The weighted sum of encodings gives the score. Only document labels are used: encoder,
attention and readout are learned together in numpy.

Training sample: about ``SAMPLE_PER_CLASS`` labelled documents of each class, chosen by a
hash of their id, each cut to a span of ``SPAN`` characters at a hashed place; that is the
only bound. Scoring reads every document whole, in slices of bounded size.

Defined results: null and empty texts are a bag of one empty passage and get its score;
without labelled rows every score is 0.5; labels that are null or neither 0 nor 1 are ignored;
repeated rows repeat; other columns are never inputs; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import filter_rows, id_text, in_parts, least_of, utf8

PASSAGE = 256
BUCKETS = 256
WIDTH = 128 + 2 + BUCKETS + 2
HIDDEN = 24
GATE = 12
SAMPLE_PER_CLASS = 1_500
SPAN = 4_096
EPOCHS = 12
RATE = 0.01
DECAY = 1e-4
SEED = 11
ACCEPT = 0.7
BLOCK = PASSAGE * 1_024               # bytes of a text that are described at once
PART = 256 << 10                      # bytes of texts scored at once: about 40 times that is held meanwhile


def passage_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features, first): one row per passage and the index of each text's first passage."""
    parts = [max(1, -(-len(t) // PASSAGE)) for t in texts]
    first = np.concatenate([[0], np.cumsum(parts)[:-1]]).astype(np.int64)
    n = int(sum(parts))
    x = np.frombuffer(b"".join(t.ljust(k * PASSAGE, b"\0") for t, k in zip(texts, parts)), np.uint8).reshape(n, PASSAGE)
    size = np.full(n, PASSAGE, np.float32)
    size[first + np.array(parts) - 1] = [len(t) - (k - 1) * PASSAGE for t, k in zip(texts, parts)]
    row = np.arange(n, dtype=np.int32)[:, None]
    # Bytes of other than ASCII characters share one class; padding is class 0, left out below.
    hist = np.bincount((np.minimum(x, 128) + row * 129).ravel(), minlength=n * 129).reshape(n, 129).astype(np.float32)
    pad = PASSAGE - size
    hist[:, 0] -= pad
    c = x.astype(np.int32)
    tri = ((c[:, :-2] * 961 + c[:, 1:-1] * 31 + c[:, 2:]) * 40503 >> 4) % BUCKETS
    live = np.arange(PASSAGE - 2)[None, :] < (size - 2)[:, None]
    tri = np.where(live, tri, BUCKETS) + row * (BUCKETS + 1)
    grams = np.bincount(tri.ravel(), minlength=n * (BUCKETS + 1)).reshape(n, -1)[:, :BUCKETS].astype(np.float32)
    whole = np.maximum(size, 1)
    # Distinct trigrams against what that many random ones would fill.
    m = np.maximum(size - 2, 0)
    fill = BUCKETS * (1 - (1 - 1 / BUCKETS) ** m)
    distinct = (grams > 0).sum(1) / np.maximum(fill, 1)
    out = np.empty((n, WIDTH), np.float32)
    out[:, :129] = np.sqrt(np.maximum(hist, 0) / whole[:, None])
    out[:, 129] = np.log1p(size) / 5.55
    out[:, 130:130 + BUCKETS] = np.sqrt(grams / whole[:, None])
    out[:, 130 + BUCKETS] = distinct
    out[:, 131 + BUCKETS] = (m < 20).astype(np.float32)
    return out, first


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class AttentionModel:
    """``e``, ``eb`` passage encoder; ``v``, ``g``, ``a`` gated attention; ``c``, ``cb`` readout."""
    e: np.ndarray
    eb: np.ndarray
    v: np.ndarray
    g: np.ndarray
    a: np.ndarray
    c: np.ndarray
    cb: np.ndarray

    @staticmethod
    def fresh(rng) -> "AttentionModel":
        def normal(scale, *shape):
            return rng.normal(0, scale, shape).astype(np.float32)
        return AttentionModel(normal(0.2, WIDTH, HIDDEN), np.zeros(HIDDEN, np.float32), normal(0.3, HIDDEN, GATE),
                              normal(0.3, HIDDEN, GATE), normal(0.3, GATE), normal(0.3, HIDDEN), np.zeros(1, np.float32))

    def params(self):
        return [self.e, self.eb, self.v, self.g, self.a, self.c, self.cb]


def _forward(model: AttentionModel, x: np.ndarray, first: np.ndarray):
    h = np.tanh(x @ model.e + model.eb)
    t, s = np.tanh(h @ model.v), _sigmoid(h @ model.g)
    logit = (t * s) @ model.a
    count = np.diff(np.append(first, len(x)))
    bag = np.repeat(np.arange(len(first)), count)
    w = np.exp(logit - np.maximum.reduceat(logit, first)[bag])
    w /= np.add.reduceat(w, first)[bag]
    z = np.add.reduceat(h * w[:, None], first, axis=0)
    return h, t, s, w, bag, z, _sigmoid(z @ model.c + model.cb)


def score_bags(model: AttentionModel, x: np.ndarray, first: np.ndarray) -> np.ndarray:
    return _forward(model, x, first)[-1]


def loss_and_gradients(model: AttentionModel, x, first, y, weight):
    """Weighted mean cross entropy of document labels and gradients in the order of ``params``."""
    h, t, s, w, bag, z, p = _forward(model, x, first)
    loss = -(weight * np.log(np.where(y > 0, p, 1 - p) + 1e-9)).sum()
    d = (weight * (p - y)).astype(np.float32)
    dz = d[:, None] * model.c
    dw = (dz[bag] * h).sum(1)
    dlogit = w * (dw - np.add.reduceat(w * dw, first)[bag])
    dts = dlogit[:, None] * model.a
    dt, ds = dts * s * (1 - t * t), dts * t * s * (1 - s)
    dh = (w[:, None] * dz[bag] + dt @ model.v.T + ds @ model.g.T) * (1 - h * h)
    return loss, [x.T @ dh, dh.sum(0), h.T @ dt, h.T @ ds, (t * s).T @ dlogit, z.T @ d, d.sum(keepdims=True)]


def fit(texts: list[bytes], labels: list[int], epochs: int = EPOCHS, batch: int = 64, rate: float = RATE,
        seed: int = SEED) -> AttentionModel | None:
    """Train with Adam; both classes weigh alike. None without texts."""
    if not texts:
        return None
    rng = np.random.default_rng(seed)
    model = AttentionModel.fresh(rng)
    x, first = passage_features(texts)
    end = np.append(first, len(x))[1:]
    y = np.array(labels, np.float32)
    share = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    m1 = [np.zeros_like(p) for p in model.params()]
    m2 = [np.zeros_like(p) for p in model.params()]
    step, steps = 0, epochs * -(-len(y) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(y), batch):
            pick = order[k:k + batch]
            rows = np.concatenate([np.arange(first[i], end[i]) for i in pick])
            starts = np.concatenate([[0], np.cumsum(end[pick] - first[pick])[:-1]])
            step += 1
            _, grads = loss_and_gradients(model, x[rows], starts, y[pick], share[pick] / len(pick))
            scale = rate * (1 - step / (steps + 1))
            for p, g, a, b in zip(model.params(), grads, m1, m2):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= (scale * (a / (1 - 0.9 ** step) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-7)
                               + rate * DECAY * p)).astype(np.float32)
    return model


def _pooled(model: AttentionModel, text: bytes) -> float:
    """Score of one long text, its passages encoded block by block: the attention's
    maximum, weights and weighted encodings of blocks combine exactly."""
    top, total, z = -np.inf, 0.0, 0.0
    for k in range(0, len(text), BLOCK):
        h, t, s, *_ = _forward(model, *passage_features([text[k:k + BLOCK]]))
        logit = ((t * s) @ model.a).astype(np.float64)
        new = max(top, logit.max())
        w = np.exp(logit - new)
        total, z = total * np.exp(top - new) + w.sum(), z * np.exp(top - new) + w @ h
        top = new
    return float(_sigmoid(z / total @ model.c + model.cb)[0])


def score_texts(model: AttentionModel | None, texts: list[bytes]) -> np.ndarray:
    """Scores of whole texts."""
    if model is None:
        return np.full(len(texts), 0.5)
    out = np.empty(len(texts))
    short = [i for i, t in enumerate(texts) if len(t) <= BLOCK]
    if short:
        out[short] = score_bags(model, *passage_features([texts[i] for i in short]))
    for i, t in enumerate(texts):
        if len(t) > BLOCK:
            out[i] = _pooled(model, t)
    return out


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, span: int = SPAN) -> DataFrame:
    """(doc_id, label, u, span) of at most ``per_class`` rows of each class: of the labels with the least hashes of
    the id, the rows with the least hashes of id and text."""
    known = labels.filter(F.col("label").isin(0, 1)).withColumn("v", F.xxhash64("doc_id", F.lit(SEED)))
    chosen = least_of(known, "label", "v", per_class).select("doc_id", "label")       # at most two times per_class short rows
    at = F.pmod(F.xxhash64(F.lit(SEED), F.col("doc_id")), F.greatest(F.length("text") - span, F.lit(1))).cast("int") + 1
    rows = (docs.withColumn("at", at).join(F.broadcast(chosen), "doc_id")
            .select("doc_id", "label", F.xxhash64("doc_id", "text", F.lit(SEED)).alias("u"),
                    F.substring("text", F.col("at"), F.lit(span)).alias("span")))
    return least_of(rows, "label", "u", per_class)


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> AttentionModel | None:
    """Fit on the bounded sample; ``docs`` has doc_id and text, ``labels`` doc_id and label."""
    rows = sorted(training_rows(docs, labels, per_class).collect(), key=lambda r: (r["u"], r["doc_id"] or 0, r["label"], r["span"]))
    return fit([r["span"].encode() for r in rows], [int(r["label"]) for r in rows])


def score_documents(docs: DataFrame, model: AttentionModel | None, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs`` (doc_id, text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches):
        for batch in batches:
            for part in in_parts(batch, "text", PART):
                s = score_texts(model, utf8(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(s), pa.array((s >= accept).astype(np.int32))], schema=schema)

    return docs.mapInArrow(run, "doc_id long, score double, predicted int")


def held_out(folds: int = 4, fold: int = 2):
    """Whether a row of ``doc_id`` is never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "quality", per_class: int = SAMPLE_PER_CLASS, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, held_out, score, predicted): trained outside the held-out fold, applied to every row."""
    d = id_text(docs, id_col, text_col)
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("label"))
    model = train(d, known.filter(~held_out()), per_class)
    return score_documents(d, model, accept).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, label_col: str = "quality", accept: float = ACCEPT) -> DataFrame:
    """Rows of ``docs`` (all columns) whose score reaches ``accept``; trained like ``quality``."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).alias("label"))
    model = train(id_text(docs), known.filter(~held_out()))
    return filter_rows(docs, lambda: lambda texts: (score_texts(model, texts) >= accept).tolist(), limit=PART)
