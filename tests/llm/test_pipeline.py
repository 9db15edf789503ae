"""Each pipeline stage against a brute-force version on its own input."""

import random
import re

import corpus_pipeline
import pytest
from test_methods import _union_find, brute_kept

from tickforge.llm import decontaminate, merge_dropout, passage_attention
from tickforge.llm.common import written
from tickforge.llm.queries import vocabulary
from tickforge.llm.shingles import shingle_set

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["input"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), f"test-{name}")
        out[name] = docs.collect()
    return out


def test_stages(outputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "substring_dedup", "decontamination", "encoding"]
    sizes = [len(outputs[n]) for n in ("input", "quality", "near_dedup", "substring_dedup", "decontamination", "encoding")]
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > sizes[4] == sizes[5] > 0
    for n in ("quality", "near_dedup", "substring_dedup", "decontamination"):
        assert outputs[n][0].asDict().keys() == outputs["input"][0].asDict().keys()


def test_quality_stage(spark, outputs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scores = passage_attention.quality(docs, spark.read.parquet(f"{SF}/labels.parquet")).filter("predicted = 1").collect()
    assert sorted(r["doc_id"] for r in outputs["quality"]) == sorted(r["doc_id"] for r in scores)


def test_near_dedup_stage(outputs):
    sets = {r["doc_id"]: set(shingle_set((r["text"] or "").encode()).tolist()) for r in outputs["quality"]}
    ids = [i for i in sets if sets[i]]
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = {i for i, c in _union_find(sets, links).items() if i == c}
    assert {r["doc_id"] for r in outputs["near_dedup"]} == want


def test_near_dedup_stage_measures(spark):
    """Against brute force: copies with one passage put in (five words, 0.8) and with scattered
    words replaced (three words, 0.85), which the other measure misses."""
    rng = random.Random(4)
    rows = []
    for k in range(6):
        words = [f"w{rng.randrange(10**6)}" for _ in range(100)]
        edited = [f"e{i}" if i in (20, 60) else w for i, w in enumerate(words[:80])]
        rows += [(" ".join(words), 0), (" ".join(words + [f"x{rng.randrange(10**6)}" for _ in range(22)]), 0),
                 (" ".join(words[:50] + [f"y{rng.randrange(10**6)}" for _ in range(18 + 2 * k)] + words[50:]), 0)]
        base = [f"z{rng.randrange(10**6)}" for _ in range(76)]
        rows += [(" ".join(base), 0), (" ".join(f"e{i}" if i in (20, 50) else w for i, w in enumerate(base)), 0)]
        rows += [(" ".join(edited), 0)]
    docs = spark.createDataFrame([(i, t, "en", "h", len(t)) for i, (t, _) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars int")

    def links(n, percent):
        sets = [set(shingle_set(t.encode(), n).tolist()) for t, _ in rows]
        return {(a, b) for a in range(len(rows)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}

    five, three = links(5, 80), links(3, 85)
    assert five - three and three - five
    want = {i for i, c in _union_find(dict(enumerate(rows)), five | three).items() if i == c}
    assert {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()} == want


def test_substring_stage(outputs):
    before = outputs["near_dedup"]
    want = brute_kept([(r["doc_id"], r["text"] or "") for r in before])
    texts = {r["doc_id"]: r["text"] or "" for r in before}
    assert sum(len(w) < len(re.findall(r"[^\x20\x09-\x0D]+", t)) for (_, t), w in want.items()) > 0
    for r in outputs["substring_dedup"]:
        t = texts[r["doc_id"]]
        assert re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "") == want[(r["doc_id"], t)]
        assert (r["text"] or "") == t or r["n_chars"] == len(r["text"])


def test_decontamination_stage(spark, outputs):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    index = decontaminate.SeedIndex.build(items)
    want = {r["doc_id"] for r in outputs["substring_dedup"]
            if not any(decontaminate.align(w, index.encode(r["text"]))[0] >= len(w) for w in index.items if len(index.encode(r["text"])))}
    assert {r["doc_id"] for r in outputs["decontamination"]} == want


def test_encoding_stage(outputs):
    p = merge_dropout.Pieces.load(vocabulary("piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] for r in outputs["decontamination"]}
    for r in outputs["encoding"]:
        assert r["lossless"] and merge_dropout.decode_ids(p, r["ids"]).decode() == texts[r["doc_id"]]
