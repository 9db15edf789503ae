"""Ranked search, token alignment and host reputation against brute force, and on awkward rows."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from edge import LONG_WORDS, edge_docs, edge_rows, prose

from tickforge.llm import block_max_search as search, host_reputation as hosts, token_alignment as align
from tickforge.llm.queries import vocabulary

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
ITEMS = "item_id long, text string, n_chars int, term string, shard int"


# ---------------------------------------------------------------- op11

def brute_search(rows, items, k=10):
    """Every document scored for every item."""
    docs = [(i, search.terms_of((t or "").encode())) for i, t in rows]
    docs = [(i, Counter(t), len(t)) for i, t in docs if t]
    n, total = len(docs), sum(size for _, _, size in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, size in docs:
            m = 10 + 90 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in set(search.terms_of((text or "").encode())) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found_by(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def corpus(n=700):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (1 + i) for i in range(60)]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 60)))) for i in range(n)]
    return rows + [(n, "w1 w2 w3"), (n, "w1 w2 w3"), (None, "w1 w2 w3"), (n + 1, "W1, w2! ÉÉ é"), (n + 2, None), (n + 3, "")]


@pytest.mark.parametrize("shard_bytes, block_words", [(16 << 20, 10_000), (3_000, 5)])
def test_search_equals_scoring_everything(spark, shard_bytes, block_words):
    rows = corpus()
    items = [(0, "w1 w2 w3 w50"), (1, "w0 w59 w40 W1"), (2, "unknown"), (3, None), (3, "w7 w7 é ÉÉ"), (None, "w11 w30 w31 w32 w33 w34")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, term string, shard int").repartition(3)
    asked = spark.createDataFrame([(*x, 1, "t", 2) for x in items], ITEMS)
    got = found_by(search.ranked_search(docs, asked, shard_bytes=shard_bytes, block_words=block_words))
    assert got == brute_search(rows, items)


def test_search_rejects_before_decompression():
    """Block maxima and essential lists leave most blocks of a long list compressed, with equal results."""
    rng = random.Random(3)
    texts = [" ".join(["common"] * rng.randint(1, 3) + ["filler"] * rng.randint(5, 200) + ["rare"] * (i % 1500 == 40)).encode()
             for i in range(12_000)]
    n, total = len(texts), sum(len(search.terms_of(t)) for t in texts)
    batch = search.build_shard(0, list(range(n)), texts, n, total).to_pylist()
    m, kept = np.frombuffer(batch[0]["peak"], "<i8"), {}
    lists = {r["term"]: search.Postings(r, search.weight(n, r["df"]), m, kept) for r in batch[1:]}
    asked = [lists[b"common"], lists[b"rare"]]
    docs, scores = search.search(asked, n, k=5)
    full = np.zeros(n, np.int64)
    for x in asked:
        for b in range(len(x.last)):
            d, s = search.Postings.block(x, b)
            full[d] += s
    best = np.lexsort((np.arange(n), -full))[:5]
    assert docs.tolist() == best.tolist() and scores.tolist() == full[best].tolist()
    kept.clear()
    search.search(asked, n, k=5)
    opened = sum(t == b"common" for t, _ in kept)
    assert opened < 0.5 * len(lists[b"common"].last)


def test_search_blocks_hold_all_postings():
    texts = [(f"a b{i % 7} " + "c " * (i % 400) + "q " * (70_000 if i == 5 else 0)).encode() for i in range(1_000)]
    rows = search.build_shard(9, [7 * i for i in range(1_000)], texts, 1_000, 10**6).to_pylist()
    assert [r["term"] for r in rows[1:]] == sorted(r["term"] for r in rows[1:]) and rows[0]["term"] is None
    want = defaultdict(dict)
    for d, t in enumerate(texts):
        for term, c in Counter(search.terms_of(t)).items():
            want[term][d] = c
    m = np.frombuffer(rows[0]["peak"], "<i8")
    for r in rows[1:]:
        p = search.Postings(r, 1, m, {})
        got = {}
        for b in range(len(p.last)):
            d, s = p.block(b)
            assert d[-1] == p.last[b] and s.max() == p.peak[b]
            got.update(zip(d.tolist(), s.tolist()))
        assert got == {d: 10**9 * c // (1000 * c + 8 * int(m[d])) for d, c in want[r["term"]].items()}


def test_search_edges(spark):
    items = spark.createDataFrame([(1, LONG_WORDS[0] + "a", 1, "t", 1), (2, "", 1, "t", 1)], ITEMS)
    got = found_by(search.ranked_search(edge_docs(spark), items))
    assert got == brute_search([(i, t) for i, t, *_ in edge_rows()], [(1, LONG_WORDS[0] + "a"), (2, "")])
    assert search.ranked_search(edge_docs(spark, []), items).collect() == []
    assert search.ranked_search(edge_docs(spark), items.limit(0)).collect() == []
    blank = edge_docs(spark, [(1, None, None, None), (2, " .,", None, None)])
    assert search.ranked_search(blank, items).collect() == []


# ---------------------------------------------------------------- op12

def brute_alignment(texts):
    """Every token against every token, by byte ranges."""
    import sentencepiece
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary(A))
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary(B))
    letters = align.byte_letters()
    names = {i: n for n, i in t.get_vocab().items()}
    docs, count = [], Counter()
    for text in texts:
        a = t.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in names[i]) for i in a]
        bytes_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            docs.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        starts_a, starts_b = [0, *ends_a[:-1]], [0, *ends_b[:-1]]
        links = [(x, y) for x, s, e in zip(a, starts_a, ends_a) for y, u, v in zip(b, starts_b, ends_b) if s < v and u < e]
        cuts = sorted(set(ends_a) & set(ends_b))
        lo, groups = 0, []
        for hi in cuts:
            groups.append(",".join(str(x) for x, e in zip(a, ends_a) if lo < e <= hi) + "|"
                          + ",".join(str(x) for x, e in zip(b, ends_b) if lo < e <= hi))
            lo = hi
        docs.append((a, b, groups, links))
        count.update(set(links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (len(d[0]), len(d[1]), len(d[2]), len(d[3]), sum(count[p] == best[p[0]] for p in d[3]), sum(count[p] for p in d[3]),
             hashlib.sha256(";".join(d[2]).encode()).hexdigest()) for d in docs]


TEXTS = ["", "plain words here", " leading", "trailing ", "two  blanks", "line\nends\r\nand\ttabs", "▁ sign", "x▁y", "<s> <unk> </s> <0x41>",
         "<|endoftext|> inside<|endoftext|>", "日本語のテキスト と 中文", "😀 emoji 👩‍👩‍👧", "é vs é, ﬁ ligature ½", "\x00 control \x7f", "a" * 3_000,
         "naïveté coöperate façade", "http://example.com/a?b=c&d=%20", "12345 67,890.12", "...", "plain words here", prose(3, 200)]


def test_alignment_equals_brute_force(spark):
    texts = [*TEXTS, *(prose(k, 40) for k in range(12))]
    rows = [(k, t) for k, t in enumerate(texts)] + [(len(texts), None)]
    docs = spark.createDataFrame([(i, t, 0, 0, 0) for i, t in rows], "doc_id long, text string, slice int, pair int, docs int").repartition(2)
    want = brute_alignment([t or "" for _, t in rows])
    assert sum(w[0] == 0 for w in want) >= 3 and sum(w[2] < w[0] for w in want) > 5
    for size in (align.SLICE, 200):
        got = {r["doc_id"]: tuple(r[1:]) for r in align.token_links(docs, vocabulary(A), vocabulary(B), slice_bytes=size).select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()}
        assert got == dict(enumerate(want))


def test_alignment_edges(spark):
    rows = align.token_links(edge_docs(spark), vocabulary(A), vocabulary(B)).collect()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r["doc_id"]].append(r)
    assert sorted((r["doc_id"] for r in rows), key=str) == sorted((i for i, *_ in edge_rows()), key=str)
    assert all(r["groups_sha256"] == "" and r["n_a"] == r["count_sum"] == 0 for i in (0, 1) for r in by_id[i])
    assert len(by_id[5]) == 2 and by_id[5][0] == by_id[5][1] and by_id[5][0]["n_links"] > 100
    assert align.token_links(edge_docs(spark, []), vocabulary(A), vocabulary(B)).collect() == []


def test_encoders_equal_the_libraries(spark):
    import sentencepiece
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary(A))
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary(B))
    al = align.aligner(vocabulary(A), vocabulary(B))
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        text = r["text"] or ""
        assert np.frombuffer(al.encode_a.encode(" " + text), "<i4").tolist() == t.encode(" " + text, add_special_tokens=False).ids
        assert np.frombuffer(al.encode_b.encode(text), "<i4").tolist() == (sp.encode(text) if text else [])


# ---------------------------------------------------------------- op13

PAGES = "page_id long, url string, host string, path string, rule string, n int"


def _judged(spark, urls, labels=(), **options):
    pages = spark.createDataFrame([(i, u, "x", "y", "z", 1) for i, u in urls], PAGES)
    marks = spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int")
    return hosts.filter_pages(pages, marks, **options).collect()


def test_rules(spark):
    want = {"http://A.com/x": ("a.com", "/x", "com/", "allow"), "https://sub.Example.com/en/1?q#f": ("sub.example.com", "/en/1", "example.com/en/", "block"),
            "http://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
            "http://x.www.example.com/en/a": ("x.www.example.com", "/en/a", "www.example.com/en/", "allow"),
            "http://badexample.com/en/": ("badexample.com", "/en/", "com/", "allow"), "http://example.com/english": ("example.com", "/english", "com/", "allow"),
            "x://a.net/es/1": ("a.net", "/es/1", "net/es/", "block"), "http://a.net/fr/1": ("a.net", "/fr/1", "net/fr/", "block"),
            "http://a.net/en/es/": ("a.net", "/en/es/", None, "allow"), "http://a.com": ("a.com", "", None, "allow"),
            "http://a.com?x=/": ("a.com", "", None, "allow"), "http://a.com:80/": ("a.com:80", "/", None, "allow"),
            "no scheme.com/": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
            "http://b.org/a://c.com/d": ("b.org", "/a://c.com/d", None, "allow"), "http://u@h.org/p\nq": ("u@h.org", "/p\nq", None, "allow"),
            "http://ÀB.org/" + "z" * 100_000: ("Àb.org", "/" + "z" * 100_000, None, "allow")}
    rows = _judged(spark, list(enumerate(want)))
    assert {tuple(want)[r["page_id"]]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows} == want
    assert all(r["n_labelled"] == 0 for r in rows)


def brute_reputation(urls, labels):
    """The levels one by one in plain Python: upper bound of every host."""
    bad = defaultdict(bool)
    for i, q, t in labels:
        bad[i] |= q == 0 or t == 1
    n, good = defaultdict(Counter), defaultdict(Counter)
    up = {}
    for _, u in urls:
        host, _, path = u.split("://")[1].partition("/")
        chain = [host, ".".join(host.split(".")[-2:]), host.split(".")[-1], ""]
        key = path.split("/")[-1]
        for k, name in enumerate(chain):
            up[(k, name)] = (k + 1, chain[k + 1]) if k < 3 else None
            hit = key.isdigit() and int(key) in bad
            n[k][name] += hit
            good[k][name] += hit and not bad[int(key)]
    mean = {(3, ""): (good[3][""] + 1) / (n[3][""] + 1)}
    out = {}
    for k in (2, 1, 0):
        over = pairs = 0.0
        for name, size in n[k].items():
            p = mean[up[(k, name)]]
            over += (good[k][name] - size * p) ** 2 - size * p * (1 - p)
            pairs += size * (size - 1) * p * (1 - p)
        rho = min(max(over / pairs if pairs else 0.05, 0.001), 0.5)
        s = 1 / rho - 1
        for name, size in n[k].items():
            m = mean[(k, name)] = (good[k][name] + mean[up[(k, name)]] * s) / (size + s)
            out[name] = min(m + 1.645 * math.sqrt(m * (1 - m) / (size + s + 1)), 1.0)
    return out


def test_reputation_equals_brute_force_and_blocks_bad_hosts(spark):
    rng = random.Random(5)
    urls, labels = [], []
    share = {f"h{h}.d{h % 9}.{'org' if h % 2 else 'info'}": (0.15 if h in (3, 8) else 0.9) for h in range(40)}
    for i in range(3_000):
        host = "h3.d3.org" if i % 3 == 0 else rng.choice(list(share))
        urls.append((i, f"http://{host}/en/{i}"))
        if i % 2 == 0 and host != "h8.d8.info" or i % 50 == 0:
            fine = rng.random() < share[host]
            labels.append((i, int(fine or i % 4 == 0), int(not fine)))
    labels += [(4, 1, 0), (4, 0, 0), (None, 0, 0), (6, None, None)]
    rows = _judged(spark, urls, labels)
    want = brute_reputation(urls, [x for x in labels if x[0] is not None and x[1] is not None])
    assert len(rows) == 3_000 and all(abs(r["good_bound"] - want[r["host"]]) < 2e-6 for r in rows)
    assert {r["host"] for r in rows if r["verdict"] == "block"} == {"h3.d3.org"}
    # A host with few labels keeps close to its domain.
    few = next(r for r in rows if r["host"] == "h8.d8.info")
    assert few["n_labelled"] < 10 and few["verdict"] == "allow"


def test_hosts_and_owners(spark):
    names = ["a.b.example.org", "example.org", "x.example.co.uk", "co.uk", "localhost", "", "u:p@a.b.org:8080", "a.org.", "10.0.0.1"]
    df = spark.createDataFrame([(n,) for n in names], "host string")
    got = [tuple(r) for r in df.select(*hosts.owners(df["host"])).collect()]
    assert got == [("example.org", "org"), ("example.org", "org"), ("example.co.uk", "co.uk"), ("co.uk", "co.uk"),
                   ("localhost", "localhost"), ("", ""), ("b.org", "org"), ("a.org", "org"), ("0.1", "1")]


def test_empty_pages(spark):
    assert _judged(spark, []) == []
    assert _judged(spark, [], [(1, 1, 0)]) == []
    rows = _judged(spark, [(1, "http://a.org/1"), (1, "http://a.org/1"), (None, "http://a.org/1")], [(1, 0, 1)])
    assert [r["n_labelled"] for r in rows] == [3, 3, 3] and sorted((r["page_id"] for r in rows), key=str) == [1, 1, None]
