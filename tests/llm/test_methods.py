"""Each operator's method against brute force, an exact round trip or held-out accuracy."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from edge import edge_docs, prose

from tickforge.llm import (byte_language, decontaminate, graph, hyperminhash, licenses, merge_dropout,
                           passage_attention, suffix_array, suffix_dedup, tag_paths, token_store)
from tickforge.llm.common import written
from tickforge.llm.queries import QUERIES, vocabulary
from tickforge.llm.shingles import shingle_set

SF = "/root/testdata/sf0.001"


# --- license automata -------------------------------------------------------------------

def test_template_regions():
    a = licenses.compile_template("one <<beginOptional>>two <<beginOptional>>three<<endOptional>><<endOptional>> four "
                                  "<<var;name=x;words=1..2>> five")
    for text, ok in (("one four x five", True), ("one two four x y five", True), ("one two three four x five", True),
                     ("one three four x five", False), ("one four five", False), ("one four x y z five", False)):
        assert (a.match_at(licenses.words_of(text.encode()), 0) is not None) == ok, text
    assert a.openings() == {(b"one", b"two", b"three"), (b"one", b"two", b"four"), (b"one", b"four")}
    with pytest.raises(ValueError):
        licenses.compile_template("a <<endOptional>>")
    with pytest.raises(ValueError):
        licenses.compile_template("<<beginOptional>> a")


def test_scan_places():
    r = licenses.LicenseScanner().scan("MIT License mit-license, General  Public\nLicense; generalpublic license".encode())
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (9, 3, 0, 4, "gpl,mit")
    leading = licenses.LicenseScanner(templates={"any": "<<var;name=x;words=1..1>> end"}).scan(b"a b end")
    assert leading["spans"] == [{"first": 1, "end": 3, "label": "any"}]


# --- token store ------------------------------------------------------------------------

def test_token_store_equals_whole_text_encoding(spark, docs, texts, tmp_path):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    path = str(tmp_path / "store")
    rows = {r["doc_id"]: r for r in token_store.store_and_read(docs, vocabulary("byte_bpe_50k.json"), path=path).collect()}
    start = 0
    for i in sorted(texts):
        ids = t.encode(texts[i], add_special_tokens=False).ids + [0]
        r = rows[i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (
            start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), i
        start += len(ids)
    found = token_store.lookup(spark, path, [3, 7, 10**9])
    assert sorted(r["doc_id"] for r in found.collect()) == [3, 7]
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().executedPlan().toString()


def test_token_store_files(spark, docs, tmp_path):
    import glob
    path = str(tmp_path / "store")
    token_store.write_token_store(docs, path, vocabulary("byte_bpe_50k.json"))
    files = sorted(glob.glob(f"{path}/*.orc"))
    ranges = [(r["a"], r["b"]) for f in files for r in
              spark.read.orc(f).selectExpr("min(doc_id) a", "max(doc_id) b").collect() if r["a"] is not None]
    assert all(x[1] < y[0] for x, y in zip(ranges, ranges[1:]))         # files hold ascending ranges
    import pyarrow.orc as orc
    ids = [i for f in files for i in orc.ORCFile(f).read(columns=["doc_id"]).column(0).to_pylist()]
    assert ids == sorted(ids)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for f in files:
        reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(f), jvm.org.apache.orc.OrcFile.readerOptions(conf))
        stripes = list(reader.getStripes())
        rows = reader.rows()
        for stripe in stripes:
            kinds = {(x.getColumn(), str(x.getKind())) for x in rows.readStripeFooter(stripe).getStreamsList()}
            assert (1, "BLOOM_FILTER_UTF8") in kinds and (1, "ROW_INDEX") in kinds and not any("BLOOM" in k for c, k in kinds if c != 1)


def test_piece_encoder_on_odd_texts():
    e = token_store.PieceEncoder(vocabulary("byte_bpe_50k.json"), limit=50)
    rng = random.Random(5)
    parts = ["a", "b", "é", "ß", "12", " ", " ", "\n", "\t", ".", ",", "'s", "!", "日", "ª", "😀", "<|endoftext|>", "\x85", "\xa0", "'ll"]
    for _ in range(5_000):
        x = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert e.encode(x) == (e.ids(x) if x else b""), repr(x)


# --- merge-dropout ----------------------------------------------------------------------

PARTS = ["a", "b", "the", "ing", " ", " ", "  ", "\n", "\t", "é", "日", "😀", "1", ".", "\x00", "ción", "▁", "ﬁ"]


@pytest.fixture(scope="module")
def pieces():
    return merge_dropout.Pieces.load(vocabulary("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(3)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(1_500)]


def test_without_dropout_equals_the_library(pieces, odd, texts):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    plain = [t for t in odd if "▁" not in t] + list(texts.values())
    for t, x in zip(plain, merge_dropout.encode_texts(pieces, [0] * len(plain), plain, 0.0)):
        assert x.tolist() == sp.encode(t), repr(t)


def test_dropout_equals_heap_and_decodes(pieces, odd, monkeypatch):
    ids = list(range(len(odd)))
    a = merge_dropout.encode_texts(pieces, ids, odd, 0.3)
    b = merge_dropout.encode_texts(pieces, ids, odd, 0.3, long=0)       # every segment by the heap
    monkeypatch.setattr(merge_dropout, "SLICE", 7)
    c = merge_dropout.encode_texts(pieces, ids, odd, 0.3)               # texts cut into slices
    for t, x, y, z in zip(odd, a, b, c):
        assert x.tolist() == y.tolist() == z.tolist(), repr(t)
        assert merge_dropout.decode_ids(pieces, x.tolist()) == t.encode()


def test_dropout_is_seeded_and_varied(pieces):
    text = prose(1, 200)
    one, again, other, doc = (merge_dropout.encode_texts(pieces, [d], [text], 0.2, seed=s)[0].tolist()
                              for d, s in ((1, 1), (1, 1), (1, 2), (2, 1)))
    plain = merge_dropout.encode_texts(pieces, [1], [text], 0.0)[0]
    assert one == again and one != other and one != doc and len(one) > len(plain)


# --- near-duplicates --------------------------------------------------------------------

def _union_find(items, links):
    up = {i: i for i in items}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}


def _edited(seed: int, n: int):
    """A group of copies of one text, each edited in a few places."""
    rng = random.Random(seed)
    words = prose(seed, 150).split()
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = "edit%d" % rng.randrange(10**6)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [1_024, 7])
def test_components_equal_brute_force(spark, texts, monkeypatch, block):
    monkeypatch.setattr(hyperminhash, "BLOCK_DOCS", block)              # small blocks: the split path
    rows = [(i, t) for i, t in texts.items()] + [(10_000 + k, t) for k, t in enumerate(_edited(1, 60) + _edited(2, 30))]
    got = {r["doc_id"]: r for r in hyperminhash.near_duplicates(edge_docs(spark, [(i, t, "en", "h") for i, t in rows])).collect()}
    sets = {i: set(shingle_set(t.encode()).tolist()) for i, t in rows}
    ids = [i for i in sets if sets[i]]
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if 100 * min(len(sets[a]), len(sets[b])) >= 85 * max(len(sets[a]), len(sets[b]))
             and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = _union_find(sets, links)
    assert len(links) > 100
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (want[i] == i) for i, r in got.items())


def test_blocks_meet_only_across_components(spark, monkeypatch):
    """A bucket of one component sends nothing across its blocks; one with few others sends each member
    as often as those have blocks, not as often as the bucket has."""
    monkeypatch.setattr(hyperminhash, "BLOCK_DOCS", 10)
    bands = spark.createDataFrame([(1, i, 5) for i in range(200)] + [(2, i, 5) for i in range(200)], "key long, id long, n long")
    stars = spark.createDataFrame([(i, 0) for i in range(1, 200)], "node long, root long")
    wide = written(bands.select("key").distinct(), "wide")
    assert hyperminhash._across(bands, wide, stars).count() == 0
    apart = bands.filter("key = 2").unionByName(spark.createDataFrame([(2, 1000 + i, 5) for i in range(10)], bands.schema))
    rows = hyperminhash._across(apart, wide, stars).collect()
    assert len(rows) == 200 + 10 * 21                   # the rest meets itself and 20 blocks
    met = {}
    for r in rows:
        met.setdefault((r["i"], r["j"]), set()).add(r["id"])
    for a in range(1000, 1010):
        partners = set().union(*(ids for ids in met.values() if a in ids))
        assert partners == set(range(200)) | set(range(1000, 1010))


def test_shingles_are_words_in_order():
    def plain(text):
        w = bytes(text, "utf8").lower().split()
        return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()
    rng = random.Random(1)
    for _ in range(300):
        t = "".join(rng.choice(["a", "B", "é", "cc", " ", " ", "\t", " ", "\x1f"]) for _ in range(rng.randint(0, 40)))
        assert len(shingle_set(t.encode())) == len(plain(t)), repr(t)
    assert set(shingle_set(b"A b C d").tolist()) == set(shingle_set(b"a B c D").tolist())


def test_estimates_follow_jaccard():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.7, 0.9):
        all_ = np.unique(rng.integers(0, 2**63, 20_000, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        n = len(all_)
        a, b = np.sort(all_[:int(n * (1 + share) / 2)]), np.sort(all_[int(n * (1 - share) / 2):])
        r = np.stack([hyperminhash.sketch(a), hyperminhash.sketch(b)])
        est = hyperminhash.estimates(r, np.array([len(a), len(b)]), 0, np.array([1]))[0][0]
        assert abs(est - share) < 0.13


def _bucket(n: int, changed: int, seed: int):
    """Registers and sizes of ``n`` sets of 2,000 elements, all but ``changed`` of them shared."""
    rng = np.random.default_rng(seed)
    draw = lambda k: rng.integers(0, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    core = draw(2_000 - changed)
    sets = [np.unique(np.concatenate([core, draw(changed)])) for _ in range(n)]
    return sets, np.stack([hyperminhash.sketch(x) for x in sets]), np.array([len(x) for x in sets])


@pytest.mark.parametrize("changed", [40, 200, 330, 1_500])
def test_pairs_of_a_bucket(changed):
    m, goal = hyperminhash.QUERY, hyperminhash.QUERY.percent / 100
    sets, r, size = _bucket(40, changed, changed)
    blocks, one = np.arange(40) % 3, np.zeros(40, int)
    for band, block, here in ((0, one, (0, 0)), (3, one, (0, 0)), (20, one, (0, 0)), (3, blocks, (0, 2))):
        want = set()
        for i in range(40):
            for j in range(40):
                if (i < j if here[0] == here[1] else (block[i], block[j]) == here):
                    same = (r[i] == r[j]) & (r[i] > 0)
                    used = ((r[i] > 0) | (r[j] > 0)).sum()
                    est = (same.sum() - hyperminhash.expected_collisions(float(size[i]), float(size[j]))) / used
                    earlier = ((r[i] == r[j]).reshape(m.bands, m.rows).all(1) & (r[i].reshape(m.bands, m.rows) > 0).any(1))[:band].any()
                    if not earlier and est >= goal - hyperminhash.MARGIN * np.sqrt(goal * (1 - goal) / used):
                        want.add((i, j))
        got = hyperminhash._close_pairs(r, size, block, np.arange(40), band, here, m, lambda i, js: np.ones(len(js), bool))
        assert set(got) == want
    for a in sets[:5]:
        for b in (sets[7], sets[7][:300], a, a[5:6]):
            assert hyperminhash._common(a, b) == hyperminhash._common(b, a) == len(set(a.tolist()) & set(b.tolist()))


def test_members_with_a_pair_are_not_compared_again(monkeypatch):
    _, r, size = _bucket(300, 20, 1)
    compared, plain = [], hyperminhash.estimates
    monkeypatch.setattr(hyperminhash, "estimates", lambda r, n, i, js, m: compared.append(len(js)) or plain(r, n, i, js, m))
    kept = np.zeros(300, bool)
    for pair in hyperminhash._close_pairs(r, size, np.zeros(300, int), np.arange(300), 0, (0, 0), hyperminhash.QUERY,
                                          lambda i, js: ~(kept[i] & kept[js])):
        kept[list(pair)] = True
    assert kept.all() and sum(compared) < 600


def test_graph_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(500, 560)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == _union_find(nodes, [(a, b) for a, b in links if a != b])


# --- suffix arrays ----------------------------------------------------------------------

def test_two_stage_suffix_array():
    rng = random.Random(1)
    for _ in range(500):
        d = bytes(rng.choice(b"ab\0\xff") for _ in range(rng.randint(0, 60)))
        assert suffix_array.suffix_array(d, 1_000).tolist() == sorted(range(len(d)), key=lambda i: d[i:])
        assert suffix_array.smaller_than_next(np.frombuffer(d, np.uint8)).tolist() == [
            i + 1 < len(d) and d[i:] < d[i + 1:] for i in range(len(d))]


def test_common_prefixes():
    rng = random.Random(1)
    for _ in range(60):
        base = bytes(rng.choice(b"abc") for _ in range(30))
        d = b"".join(rng.choice([base, base[:-3], base[2:], b"x"]) for _ in range(20)) + b"\0" * 50
        places = np.array(sorted(range(len(d) - 50), key=lambda i: d[i:]))
        want = [next((k for k in range(40) if d[a + k] != d[b + k]), 40) for a, b in zip(places, places[1:])]
        assert suffix_array.common_prefixes(d, places, 40).tolist() == want


def _brute_removal(texts):
    raw = [t.encode() for t in texts]
    n = Counter(t[i:i + 400] for t in raw for i in range(len(t) - 399))
    out = []
    for t in raw:
        hit = bytearray(len(t))
        for i in range(len(t) - 399):
            if n[t[i:i + 400]] > 1:
                hit[i:i + 400] = b"\1" * 400
        kept = bytes(b for b, h in zip(t, hit) if not h)
        out.append((len(t), sum(hit), hit.count(b"\0\1") + (hit[:1] == b"\1"), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [1 << 20, 2_000])
def test_removal_equals_brute_force(spark, texts, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", hot)                 # small limit: groups are dealt out anew
    monkeypatch.setattr(suffix_dedup, "CHUNK", 3_000)
    shared = prose(7, 90)
    rows = [t for t in texts.values() if len(t) < 9_000]
    rows += [prose(100 + k, 40) + shared[k % 5:] + prose(200 + k, 40) for k in range(25)]
    rows += ["ab" * 500, "z" * 399, "z" * 400 + "y", "é" * 900, "the the " * 200 + shared]
    got = suffix_dedup.substring_dedup(edge_docs(spark, [(i, t, "en", "h") for i, t in enumerate(rows)])).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == _brute_removal(rows)


def brute_kept(rows, size=50):
    """Words left of every (id, text): windows of ``size`` words that stand in an earlier place go."""
    top = 1 << 62
    docs = sorted({(top if i is None else i, xxhash.xxh3_128_digest(t.encode()), t) for i, t in rows})
    owner, seen, kept = {}, {}, {}
    for i, k, t in docs:
        owner.setdefault(t, (i, k))
    for (i, k), t in sorted((o, t) for t, o in owner.items()):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        for p in range(len(w) - size + 1):
            seen.setdefault(tuple(w[p:p + size]), (i, k, p))
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        me = (top if i is None else i, xxhash.xxh3_128_digest(t.encode()))
        hit = bytearray(len(w))
        for p in range(len(w) - size + 1):
            if seen[tuple(w[p:p + size])] != (*me, p):
                hit[p:p + size] = b"\1" * size
        kept.setdefault((i, t), [x for x, h in zip(w, hit) if not h])
    return kept


@pytest.mark.parametrize("hot", [1 << 20, 2_000])
def test_repeats_of_fifty_words_keep_their_first_copy(spark, texts, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", hot)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 3_000)
    shared, other = prose(7, 60), prose(8, 49)
    rows = [(i, t) for i, t in texts.items() if len(t) < 9_000]
    rows += [(5_000 + k, prose(100 + k, 40) + " " + shared + "\n\t " * (k % 3) + prose(200 + k, 40 + k) + f" u{k} " + other) for k in range(25)]
    rows += [(None, "x " + shared), (4_000, shared + " y " + shared), (None, shared), (6_001, shared), (6_000, shared), (6_000, shared),
             (6_002, "the " * 200), (6_003, "the " * 120 + other), (6_004, other), (6_005, "\u00a0".join(shared.split())), (6_006, "")]
    out = suffix_dedup.without_repeats(edge_docs(spark, [(i, t, "en", str(k)) for k, (i, t) in enumerate(rows)])).collect()
    want = brute_kept(rows)
    assert len(out) == len(rows)
    for r in out:
        i, t = rows[int(r["source"])]
        assert r["doc_id"] == i and re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "") == want[(i, t)], (i, t[:50])
        assert r["text"] == t or r["n_chars"] == len(r["text"])
    by_id = {r["doc_id"]: r["text"] for r in out}
    assert sum(shared in (r["text"] or "") for r in out) == 1 and by_id[4_000] == shared + " y "
    assert all(other in by_id[5_000 + k] for k in range(25))       # 49 words are no window


@pytest.mark.parametrize("hot", [1 << 20, 1_000])
def test_lines_that_go_on_are_one_row(spark, monkeypatch, hot):
    """A line repeated all through many texts: its segments join with what goes as runs, not one by one."""
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", hot)
    seen, solve = [], suffix_dedup._solve

    def counted(rows, unit, temporary, level=0):
        if not level:
            seen.append(rows.count())
        return solve(rows, unit, temporary, level)

    monkeypatch.setattr(suffix_dedup, "_solve", counted)
    line = "one very common line of eight words here "
    rows = [(k, prose(300 + k, 60) + " " + line * (200 + k % 3) + prose(400 + k, 30 + k)) for k in range(30)] + [(90, line * 150)]
    out = suffix_dedup.without_repeats(edge_docs(spark, [(i, t, "en", str(k)) for k, (i, t) in enumerate(rows)])).collect()
    want = brute_kept(rows)
    assert {r["doc_id"]: (r["text"] or "").split() for r in out} == {i: want[(i, t)] for i, t in rows}
    # Before: a row for each of the 200 lines of a text.
    assert len(seen) == 1 and seen[0] <= 20 * len(rows)


# --- learned models ---------------------------------------------------------------------

def _numeric(loss, params, grads, rng, eps=1e-3):
    for p, g in zip(params, grads):
        for _ in range(4):
            i = tuple(rng.integers(s) for s in p.shape)
            old = p[i]
            p[i] = old + eps
            up = loss()
            p[i] = old - eps
            down = loss()
            p[i] = old
            assert abs((up - down) / (2 * eps) - g[i]) < 2e-3 + 0.05 * abs(g[i])


def test_network_gradients():
    rng = np.random.default_rng(1)
    m = byte_language.ByteGRU.fresh(["a", "b", "c"], 3, rng)
    x, y = rng.integers(0, 256, (9, 5)).astype(np.uint8), rng.integers(0, 3, 5)
    _numeric(lambda: byte_language.loss_and_gradients(m, x, y)[0], m.params(),
             byte_language.loss_and_gradients(m, x, y)[1], rng)


def test_inference_equals_training_pass():
    rng = np.random.default_rng(2)
    m = byte_language.ByteGRU.fresh(["a", "b", "c"], 4, rng)
    text = bytes(rng.integers(97, 123, 150).astype(np.uint8))
    want = np.zeros(3)
    for k in range(0, len(text), byte_language.SEGMENT):
        x = np.frombuffer(text[k:k + byte_language.SEGMENT], np.uint8)[:, None]
        f, _ = byte_language._run(x, m.w[0], m.u[0])
        b, _ = byte_language._run(x[::-1], m.w[1], m.u[1])
        z = np.concatenate([f, b[::-1]], 2)[:, 0] @ m.v + m.c
        e = np.exp(z - z.max(1, keepdims=True))
        want += (e / e.sum(1, keepdims=True)).sum(0)
    lang, score = byte_language.predict(m, [text, b"", b"123"])
    assert lang == ["abc"[want.argmax()], "und", "und"] and abs(score[0] - want.max() / len(text)) < 1e-4


def test_attention_gradients():
    rng = np.random.default_rng(3)
    m = passage_attention.AttentionModel.fresh(rng)
    x, first = passage_attention.passage_features([prose(i, 30 + 60 * i).encode() for i in range(4)])
    y, w = np.array([0, 1, 1, 0], np.float32), np.full(4, 0.25)
    _numeric(lambda: passage_attention.loss_and_gradients(m, x, first, y, w)[0], m.params(),
             passage_attention.loss_and_gradients(m, x, first, y, w)[1], rng)


def test_long_texts_are_scored_whole(monkeypatch):
    m = passage_attention.AttentionModel.fresh(np.random.default_rng(4))
    text = prose(1, 2_000).encode()
    whole = passage_attention.score_texts(m, [text])[0]
    monkeypatch.setattr(passage_attention, "BLOCK", passage_attention.PASSAGE * 3)
    assert abs(passage_attention.score_texts(m, [text])[0] - whole) < 1e-4


def test_texts_are_scored_in_small_slices(spark, monkeypatch):
    rows = [(i, prose(i, 500)) for i in range(300)]
    size = sum(len(t) for _, t in rows)
    longest = max(len(t) for _, t in rows)
    held = passage_attention.PART + longest
    assert size > 3 * held
    # Keeps nothing of a slice that is too large.
    monkeypatch.setattr(passage_attention, "train", lambda *a: None)
    monkeypatch.setattr(passage_attention, "score_texts", lambda model, texts: np.full(len(texts), float(sum(map(len, texts)) <= held)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert passage_attention.PART <= 256 << 10
    assert passage_attention.keep_good(docs, spark.createDataFrame([], "doc_id long, quality int")).count() == len(rows)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    q = QUERIES["op5_passage_attention"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    h = q[q.held_out]
    assert (h.predicted == h.quality).mean() > 0.95 and ((h.score >= 0.7) == (h.predicted == 1)).all()
    q = QUERIES["op8_byte_language"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    h = q[q.held_out]
    assert (h.lang_pred == h.lang).mean() > 0.95
    assert all(o == (zlib.crc32(str(i).encode()) % 5 == 0) for i, o in zip(q.doc_id, q.held_out))


# --- pages ------------------------------------------------------------------------------

def test_pages_without_named_article():
    para = "Long running text, with commas, and a full stop at the end of it. " * 6
    page = ("<body><div class='menu'><a href=1>Home</a><a href=2>News</a></div><div><div><ul><li><a>x</a><li><a>y</a></ul></div>"
            f"<div id=story><p>{para}</p><p>{para}second <b>bold</b><i>it</i></p></div></div>"
            "<div id='comments'><p>I think, that, this, is, wrong, wrong, wrong.</p></div>"
            "<form>Your mail</form><div class='cookie-notice'>We use cookies.</div><footer>(c) x</footer><script>var a='<p>no</p>'</script>")
    assert tag_paths.extract(page) == f"{para.strip()} {para}second boldit"


def test_pages_with_article():
    page = ("<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav>a b</nav><article><h1>Title</h1>"
            "<p>One &lt;two&gt;&nbsp;three<br>four<p>five</p><aside>ad</aside><section class=comments>no</section></article><footer>f</footer>")
    assert tag_paths.extract(page) == "Title One <two> three four five"


@pytest.mark.parametrize("wrapper", [
    '<div class="content no-sidebar">', '<div class="content-sidebar-wrap">', '<div class="has-sidebar">', '<div class="legal">',
    '<div class="overflow-hidden">', '<div class="post-tags form-page">', '<div data-state="hidden">', '<div data-id="ad">',
    '<div title="a class=ad or hidden thing">', '<div class="widget"><article>'])
def test_marked_wrappers_keep_the_article(wrapper):
    para = "A sentence of the article, with commas, and with a good many words in it. " * 4
    end = "</article></div>" if "article" in wrapper else "</div>"
    page = (f"<body><nav><a href=x>Home</a></nav>{wrapper}<p>{para}</p><p>{para}</p>{end}"
            "<div class='sidebar'><p>Some words beside.</p></div><div class='site-footer'><a href=x>Imprint</a></div></body>")
    assert tag_paths.extract(page) == f"{para}{para}".strip()


TALK = "".join(f"<p>I do not agree with number {k}, as I said before, and I will say it again. " for k in range(9))
STORY = "<h1>A title</h1><p>It was a long day, and nobody said a word; the rain fell.<p>Then it was over, and they left."
STORY_TEXT = "A title It was a long day, and nobody said a word; the rain fell. Then it was over, and they left."


@pytest.mark.parametrize("page", [
    f"<body><article>{STORY}</article><div id=comments>{TALK}</div>", f"<body><div>{STORY}</div><div id='comments'>{TALK}</div>",
    f"<body><article>{STORY}<section class=comments>{TALK}</section></article>",
    f"<body><article>{STORY}<div class='comment-list'><article>{TALK}</article></div></article>",
    f"<body><article>{STORY}</article><div class=discussion><article class=comment>{TALK}</article></div>",
    f"<body><article>{STORY}</article><article class=teaser>{TALK}</article><article class='related-item'>{TALK}</article>",
    f"<body><main>{STORY}<div class='ad'>{TALK}</div></main>", f"<body><div>{STORY}</div><div class=newsletter>{TALK}</div>",
    f"<body class='comments-open'><div class=story>{STORY}</div><ol class=commentlist><li>{TALK}</ol>"])
def test_marked_elements_go_whatever_their_share(page):
    assert tag_paths.extract(page) == STORY_TEXT


def test_page_under_marks_alone_keeps_its_text():
    assert tag_paths.extract(f"<body><div class=legal>{STORY}</div>") == STORY_TEXT
    assert tag_paths.extract(f"<body><div class=comments>{STORY}</div>") == ""


def test_ratios_decide_inside_an_article():
    """Without a name or mark: a long run of unpunctuated fragments goes by its path's ratio."""
    rows = "".join(f"<tr><td>cell {k}</td></tr>" for k in range(120))
    paras = "".join(f"<p>{STORY_TEXT} {STORY_TEXT}</p>" for _ in range(6))
    page = f"<body><article>{paras}<table>{rows}</table></article>"
    kept = " ".join([f"{STORY_TEXT} {STORY_TEXT}"] * 6)
    assert tag_paths.extract(page) == kept and tag_paths.extract(page, threshold=0) == kept + "".join(f" cell {k}" for k in range(120))
    short = f"<body><article>{paras}<ul><li>one</li><li>two</li><li>three</li></ul>{paras}</article>"
    assert tag_paths.extract(short) == f"{kept} one two three {kept}"


def test_given_pages_equal_a_plain_parser(spark):
    """Independent of paths, ratios and marks: the blocks of the article element, by the standard library's parser."""
    from html.parser import HTMLParser

    class Article(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.inside, self.blocks = 0, []

        def handle_starttag(self, tag, attrs):
            self.inside += tag == "article"
            if tag not in tag_paths.INLINE or tag == "br":
                self.blocks.append("") if tag != "br" else self.handle_data(" ")

        def handle_endtag(self, tag):
            self.inside -= tag == "article"
            if tag not in tag_paths.INLINE:
                self.blocks.append("")

        def handle_data(self, data):
            if self.inside and self.blocks:
                self.blocks[-1] += data

    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(rows) > 20
    for r in rows:
        p = Article()
        p.feed(r["html"])
        p.close()
        assert tag_paths.extract(r["html"]) == " ".join(x for x in (re.sub(r"\s+", " ", b).strip() for b in p.blocks) if x)


# --- bounded samples --------------------------------------------------------------------

def test_samples_are_bounded_whatever_repeats(spark):
    rows = [(7, prose(k, 30), "en", "h") for k in range(900)] + [(None, prose(k, 30), "de", "h") for k in range(500)]
    rows += [(7, prose(1, 30), "en", "h")] * 300 + [(100 + k, prose(k, 30), "fr", "h") for k in range(20)]
    d = edge_docs(spark, rows)
    sample = byte_language.training_spans(d.select("doc_id", "text", "lang"), per_lang=40).collect()
    assert Counter(r["lang"] for r in sample) == {"en": 40, "de": 40, "fr": 20}
    again = byte_language.training_spans(d.select("doc_id", "text", "lang").repartition(5), per_lang=40).collect()
    assert sorted(map(tuple, sample), key=str) == sorted(map(tuple, again), key=str)
    labels = spark.createDataFrame([(7, 1), (7, 0), (7, 1)] + [(100 + k, k % 2) for k in range(20)], "doc_id long, label int")
    found = passage_attention.training_rows(d.select("doc_id", "text"), labels, per_class=15).collect()
    assert Counter(r["label"] for r in found)[1] == 15 and Counter(r["label"] for r in found)[0] <= 15


# --- decontamination --------------------------------------------------------------------

def _align(item, passage):
    best, h = 0, [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a == b else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_equals_dynamic_programming():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = rng.integers(1, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 30))
        assert decontaminate.align(a, b)[0] == _align(a.tolist(), b.tolist())


def test_edited_copies_are_found_and_others_left(spark):
    rng = random.Random(4)
    items = [(k, prose(50 + k, 40)) for k in range(8)]
    rows = [(k, prose(300 + k, 200), "en", "h") for k in range(40)]
    for k, t in items:
        w = t.split()
        for n in range(0, len(w), 6):
            w[n] = "changed%d" % rng.randrange(10**6)
        del w[13], w[27]
        rows += [(100 + k, prose(400 + k, 60) + " " + " ".join(w) + " " + prose(500 + k, 60), "en", "h"),
                 (200 + k, prose(600 + k, 30) + " " + t.upper() + ". " + prose(700 + k, 30), "en", "h"),
                 (300 + k, prose(800 + k, 30) + " " + " ".join(t.split()[5:11]), "en", "h")]
    found = decontaminate.find_matches(edge_docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(x + k, k) for k in range(8) for x in (100, 200)}
    assert all(r["score"] == 1.0 for r in found if r["doc_id"] >= 200)


def test_quotations_and_every_copy_are_found():
    rng = random.Random(6)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    items = [words(59), words(200), words(60)]
    index = decontaminate.SeedIndex.build([(k, " ".join(w)) for k, w in enumerate(items)])
    seed = np.ones(len(index.item), bool)

    def found(text):
        return [(item, a, b) for item, _, a, b in decontaminate.matches_of(index, seed, " ".join(text), 0.5)]

    assert found(words(40) + items[0][10:39] + words(40)) == [(0, 40, 69)]
    assert found(words(40) + items[1][50:140] + words(40)) == [(1, 40, 130)]
    assert found(words(40) + items[1][50:62] + words(40)) == []
    third = [w if k % 9 < 6 else "other%d" % k for k, w in enumerate(items[2])]
    assert found(words(30) + third + words(30)) == [(2, 30, 90)]
    # Copies close to each other, one of them edited, and many in a row.
    edited = [w if k % 7 else "new%d" % k for k, w in enumerate(items[2])][1:-1]
    assert found(items[2] + words(5) + edited + words(70) + items[2]) == [(2, 0, 60), (2, 65, 123), (2, 193, 253)]
    assert found(items[0] * 100) == [(0, 59 * k, 59 * k + 59) for k in range(100)]


def test_matches_equal_search_of_all_pairs(spark, docs, texts):
    """Alignment of every document with every item, without seeds."""
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    index = decontaminate.SeedIndex.build(items)
    want = set()
    for i, t in texts.items():
        ids = index.encode(t)
        for item, words in zip(index.ids, index.items):
            if len(ids) and np.isin(words, ids).mean() >= 0.5 and \
                    decontaminate.align(words, ids)[0] >= 2 * len(words) * decontaminate.MIN_SCORE:
                want.add((i, item))
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op10_decontaminate"](spark, SF).collect()}
    assert got == want and want


def test_seeds_find_every_edited_copy_above_the_limit(spark):
    """Copies with a growing share of words replaced at random: found are those whose alignment reaches the limit."""
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    index = decontaminate.SeedIndex.build(items)
    counts = np.zeros(len(index.codes), np.int64)
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        counts[np.unique(index.find(index.encode(r["text"] or ""))[0])] += 1
    seed, rng = index.rare(counts), random.Random(1)
    for share, least in ((0.0, 1.0), (0.1, 1.0), (0.2, 0.95), (0.3, 0.8)):
        found = above = n = 0
        for i, (_, text) in enumerate(items):
            w = decontaminate.words_of(text)
            if len(w) >= 20:
                doc = " ".join(["zz"] * 30 + [x if rng.random() >= share else f"q{rng.randrange(10**6)}" for x in w] + ["zz"] * 30)
                reaches = decontaminate.align(index.items[i], index.encode(doc))[0] >= decontaminate.limit_of(len(w), decontaminate.MIN_SCORE)
                got = any(m[0] == i for m in decontaminate.matches_of(index, seed, doc, decontaminate.MIN_SCORE))
                found, above, n = found + got, above + reaches, n + 1
                assert got <= reaches
        assert n > 5 and found >= 0.95 * above and above >= least * n
