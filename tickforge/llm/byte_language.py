"""Language identification by a bidirectional gated recurrent network over bytes.

Trained in numpy by backpropagation through time on a bounded sample of labelled spans;
every byte position gets a distribution over languages, and a document's distribution is
the mean over all its positions. Texts are cut into segments of ``SEGMENT`` bytes that run
through the network side by side, so a text of any length takes bounded memory.

Training sample: about ``SAMPLE_PER_LANG`` documents of each language, chosen by a hash of
their id and cut to a span of ``SPAN`` characters at a hashed place; this bound is the only
one: every document is scored whole.

Defined results: a null text or one without a letter is ``und`` with score 0; without any
labelled row (an empty table included) every document is ``und``; ties go to the language
first in alphabetical order; repeated rows repeat; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import in_parts, least_of

SEGMENT = 64
HIDDEN = 8
SAMPLE_PER_LANG = 400
SPAN = 512
STEPS = 160
BATCH = 192
RATE = 0.02
SEED = 20

_WORDLIKE = re.compile(r"[^\W\d_]")


def has_letter(text: bytes) -> bool:
    """Whether a UTF-8 text has a letter of any script."""
    return any(m[0].isalpha() for m in _WORDLIKE.finditer(text.decode("utf-8", "ignore")))


@dataclass
class ByteGRU:
    """Weights: per direction ``w`` (256, 3H) input and bias of each byte, ``u`` (H, 3H)
    recurrent, in the order update, reset, candidate; ``v`` (2H, L) and ``c`` (L) readout."""
    langs: list[str]
    w: list[np.ndarray]
    u: list[np.ndarray]
    v: np.ndarray
    c: np.ndarray

    @staticmethod
    def fresh(langs: list[str], hidden: int, rng) -> "ByteGRU":
        def normal(*shape):
            return rng.normal(0, 0.3, shape).astype(np.float32)
        return ByteGRU(langs, [normal(256, 3 * hidden) for _ in "fb"], [normal(hidden, 3 * hidden) for _ in "fb"],
                       normal(2 * hidden, len(langs)), np.zeros(len(langs), np.float32))

    def params(self):
        return [*self.w, *self.u, self.v, self.c]


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(x, w, u):
    """States (T, B, H) of one direction and what backpropagation needs."""
    t_max, b = x.shape
    hid = u.shape[0]
    h = np.zeros((b, hid), np.float32)
    states, kept = np.empty((t_max, b, hid), np.float32), []
    for t in range(t_max):
        gx, gh = w[x[t]], h @ u
        zr = _sigmoid(gx[:, :2 * hid] + gh[:, :2 * hid])
        z, r = zr[:, :hid], zr[:, hid:]
        n = np.tanh(gx[:, 2 * hid:] + r * gh[:, 2 * hid:])
        kept.append((h, z, r, n, gh[:, 2 * hid:]))
        h = n + z * (h - n)
        states[t] = h
    return states, kept


def _backprop(x, u, kept, d_states):
    """Gradients of ``w`` and ``u`` from gradients of the states, last step first."""
    t_max, b, hid = d_states.shape
    du, dh = np.zeros_like(u), np.zeros((b, hid), np.float32)
    dgx = np.empty((t_max, b, 3 * hid), np.float32)
    for t in range(t_max - 1, -1, -1):
        h, z, r, n, ghn = kept[t]
        dh = dh + d_states[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z)
        dr = dn * ghn * r * (1 - r)
        dgx[t] = np.concatenate([dz, dr, dn], 1)
        dgh = np.concatenate([dz, dr, dn * r], 1)
        du += h.T @ dgh
        dh = dh * z + dgh @ u.T
    flat = x.reshape(-1)
    dw = np.stack([np.bincount(flat, d, 256) for d in dgx.reshape(-1, 3 * hid).T], 1).astype(np.float32)
    return dw, du


def loss_and_gradients(model: ByteGRU, x: np.ndarray, y: np.ndarray):
    """Mean cross entropy over all positions of ``x`` (T, B) with labels ``y`` (B), and
    its gradients in the order of ``params``."""
    t_max, b = x.shape
    fs, fk = _run(x, model.w[0], model.u[0])
    bs, bk = _run(x[::-1], model.w[1], model.u[1])
    both = np.concatenate([fs, bs[::-1]], 2)
    logits = both @ model.v + model.c
    logits -= logits.max(2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(2, keepdims=True)
    loss = -np.log(p[:, np.arange(b), y] + 1e-9).mean()
    p[:, np.arange(b), y] -= 1
    p /= t_max * b
    hid = fs.shape[2]
    dv = both.reshape(-1, 2 * hid).T @ p.reshape(-1, p.shape[2])
    d_both = p @ model.v.T
    dwf, duf = _backprop(x, model.u[0], fk, d_both[:, :, :hid])
    dwb, dub = _backprop(x[::-1], model.u[1], bk, d_both[::-1, :, hid:])
    return loss, [dwf, dwb, duf, dub, dv, p.sum((0, 1))]


def fit(spans: list[bytes], langs: list[str], hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH,
        rate: float = RATE, seed: int = SEED) -> ByteGRU | None:
    """Train on labelled spans with Adam; languages are drawn alike often. None without spans."""
    names = sorted(set(langs))
    by = [[s for s, k in zip(spans, langs) if k == name and s] for name in names]
    names, by = [n for n, s in zip(names, by) if s], [s for s in by if s]
    if not names:
        return None
    rng = np.random.default_rng(seed)
    model = ByteGRU.fresh(names, hidden, rng)
    first = [np.zeros_like(p) for p in model.params()]
    second = [np.zeros_like(p) for p in model.params()]
    for step in range(1, steps + 1):
        y = rng.integers(0, len(names), batch)
        x = np.zeros((SEGMENT, batch), np.uint8)
        for j, k in enumerate(y):
            s = by[k][rng.integers(len(by[k]))]
            at = rng.integers(max(1, len(s) - SEGMENT + 1))
            s = (s * (SEGMENT // len(s) + 1))[at:at + SEGMENT] if len(s) < SEGMENT else s[at:at + SEGMENT]
            s = s.ljust(SEGMENT, b" ")
            x[:, j] = np.frombuffer(s, np.uint8)
        _, grads = loss_and_gradients(model, x, y)
        scale = rate * (1 - step / (steps + 1)) ** 0.5
        for p, g, m, v in zip(model.params(), grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (scale * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return model


def _states(x, live, w, u):
    """States (T, H, B) of one direction, laid out so that every operation runs over
    long rows. The halves of the logistic function are folded into the weights."""
    hid, (t_max, b) = u.shape[0], x.shape
    wt, ut = np.ascontiguousarray(w.T).copy(), np.ascontiguousarray(u.T).copy()
    wt[:2 * hid] *= 0.5
    ut[:2 * hid] *= 0.5
    out = np.empty((t_max, hid, b), np.float32)
    h = np.zeros((hid, b), np.float32)
    gx, gh = np.empty((3 * hid, b), np.float32), np.empty((3 * hid, b), np.float32)
    for t in range(t_max):
        np.take(wt, x[t], axis=1, out=gx, mode="clip")
        np.matmul(ut, h, out=gh)
        zr = gx[:2 * hid]
        zr += gh[:2 * hid]
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        n, hn = gx[2 * hid:], gh[2 * hid:]
        hn *= zr[hid:]
        n += hn
        np.tanh(n, out=n)
        h -= n
        h *= zr[:hid]
        h += n
        if live is not None:
            h *= live[t]
        out[t] = h
    return out


def position_sums(model: ByteGRU, x: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Per segment of ``x`` (T, B): language probabilities summed over its first
    ``length`` positions, (L, B)."""
    t_max, b = x.shape
    live = (np.arange(t_max)[:, None] < length).astype(np.float32)
    whole = length.min(initial=t_max) == t_max
    fs = _states(x, None, model.w[0], model.u[0])
    bs = _states(x[::-1], None if whole else live[::-1], model.w[1], model.u[1])[::-1]
    hid = fs.shape[1]
    vf, vb = np.ascontiguousarray(model.v[:hid].T), np.ascontiguousarray(model.v[hid:].T)
    total = np.zeros((len(model.langs), b), np.float32)
    for t in range(t_max):
        p = vf @ fs[t]
        p += vb @ bs[t]
        p += model.c[:, None]
        p -= p.max(0)
        np.exp(p, out=p)
        p *= live[t] / p.sum(0)
        total += p
    return total


def predict(model: ByteGRU | None, texts: list[bytes], width: int = 4096) -> tuple[list[str], list[float]]:
    """Language and its pooled probability for each whole text (UTF-8)."""
    lang, score = ["und"] * len(texts), [0.0] * len(texts)
    todo = [i for i, t in enumerate(texts) if t and has_letter(t)] if model else []
    if not todo:
        return lang, score
    parts = [-(-len(texts[i]) // SEGMENT) for i in todo]
    x = np.frombuffer(b"".join(texts[i].ljust(n * SEGMENT, b"\0") for i, n in zip(todo, parts)), np.uint8)
    x = x.reshape(-1, SEGMENT)
    last = np.cumsum(parts) - 1
    length = np.full(len(x), SEGMENT)
    length[last] = [len(texts[i]) - (n - 1) * SEGMENT for i, n in zip(todo, parts)]
    sums = np.concatenate([position_sums(model, np.ascontiguousarray(x[k:k + width].T), length[k:k + width])
                           for k in range(0, len(x), width)], 1)
    total = np.add.reduceat(sums.astype(np.float64), last - np.array(parts) + 1, axis=1)
    total /= np.array([len(texts[i]) for i in todo])
    for j, (i, k) in enumerate(zip(todo, total.argmax(0))):
        lang[i], score[i] = model.langs[k], float(min(1.0, total[k, j]))
    return lang, score


def training_spans(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG, span: int = SPAN) -> DataFrame:
    """(doc_id, lang, u, span) of at most ``per_lang`` rows of each language: those with the least hashes of id
    and text, cut by hash. ``docs`` has doc_id, text and lang."""
    d = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
    at = F.pmod(F.xxhash64(F.lit(SEED), F.col("doc_id")), F.greatest(F.length("text") - span, F.lit(1)))
    # The same rows whatever the partitioning.
    d = d.select("doc_id", "lang", F.xxhash64("doc_id", "text", F.lit(SEED)).alias("u"),
                 F.substring("text", at.cast("int") + 1, F.lit(span)).alias("span"))
    return least_of(d, "lang", "u", per_lang)


def train(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> ByteGRU | None:
    """Fit on the bounded sample of ``docs`` (doc_id, text, lang)."""
    rows = sorted(training_spans(docs, per_lang).collect(), key=lambda r: (r["u"], r["doc_id"] or 0, r["span"]))
    return fit([r["span"].encode() for r in rows], [r["lang"] for r in rows])


def identify(docs: DataFrame, model: ByteGRU | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs`` (doc_id, text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            for part in in_parts(batch, "text", 4 << 20):
                texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
                lang, score = predict(model, texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                folds: int = 5, held_fold: int = 0, per_lang: int = SAMPLE_PER_LANG) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): trained on rows outside the held-out fold
    (crc32 of the id as text, modulo ``folds``), applied to every row."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                    F.col(lang_col).cast("string").alias("lang"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held_fold
    model = train(d.filter(~F.coalesce(held, F.lit(False))), per_lang)
    found = identify(d, model)
    return found.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")
