"""Nulls, empty and long texts, repeated rows, clashing columns and empty tables through every operator."""

import pytest
from edge import edge_docs, edge_rows, prose

from tickforge.llm import (byte_language, decontaminate, hyperminhash, licenses, line_rules, merge_dropout,
                           passage_attention, suffix_dedup, tag_paths, token_store)
from tickforge.llm.queries import vocabulary

LABELS = "doc_id long, quality int, toxic int"
ITEMS = "item_id long, text string, score int"


def _labels(spark, rows=((3, 0, 0), (8, 1, 0), (9, 0, None), (12, None, 1), (None, 1, 1), (77, 1, 0))):
    return spark.createDataFrame(list(rows), LABELS)


def _items(spark, rows=None):
    return spark.createDataFrame([(0, None, 1), (1, "", 1), (2, "two words", 1), (None, prose(8, 9), 1),
                                  (3, " ".join(edge_rows()[5][1].split()[10:40]), 1)] if rows is None else rows, ITEMS)


OPERATORS = {
    "licenses": lambda s, d: licenses.license_scan(d),
    "token_store": lambda s, d: token_store.store_and_read(d, vocabulary("byte_bpe_50k.json")),
    "merge_dropout": lambda s, d: merge_dropout.round_trip(d, vocabulary("piece_bpe_32k.model")),
    "hyperminhash": lambda s, d: hyperminhash.near_duplicates(d),
    "passage_attention": lambda s, d: passage_attention.quality(d, _labels(s)),
    "line_rules": lambda s, d: line_rules.line_rules(d, max_share=0, few=2),
    "suffix_dedup": lambda s, d: suffix_dedup.substring_dedup(d),
    "byte_language": lambda s, d: byte_language.language_id(d, per_lang=3),
}


@pytest.fixture(scope="module")
def results(spark):
    d = edge_docs(spark)
    return {k: f(spark, d).collect() for k, f in OPERATORS.items()}


def _by_id(rows, i):
    return [r for r in rows if r["doc_id"] == i]


def test_one_row_per_input_row(results):
    want = sorted((i for i, *_ in edge_rows()), key=str)
    for name, rows in results.items():
        assert sorted((r["doc_id"] for r in rows), key=str) == want, name


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, edge_docs(spark, [])).collect() == []


def test_defined_results(results):
    r = {k: {i: _by_id(v, i) for i in range(14)} for k, v in results.items()}
    assert [x["n_words"] for x in r["licenses"][1] + r["licenses"][0] + r["licenses"][2]] == [0, 0, 0]
    assert r["licenses"][13][0]["labels"] == "mit,mit-notice" and r["licenses"][13][0]["first_word"] == 3
    assert [x["n_tokens"] for x in r["token_store"][0] + r["token_store"][1]] == [1, 1]
    assert all(x["lossless"] for rows in r["merge_dropout"].values() for x in rows)
    assert [x["n_tokens"] for x in r["merge_dropout"][0] + r["merge_dropout"][1]] == [0, 0]
    h = r["hyperminhash"]
    assert [h[i][0]["n_shingles"] for i in (0, 1, 2, 3, 4)] == [0, 0, 0, 1, 1]
    assert [h[i][0]["component_id"] for i in (0, 1, 2, 3, 4, 5, 6, 7, 8)] == [0, 1, 2, 3, 4, 5, 5, 5, 8]
    assert [x["kept"] for x in h[5]] == [True, True] and not h[6][0]["kept"]
    assert all(0 <= x["score"] <= 1 for rows in r["passage_attention"].values() for x in rows)
    assert r["passage_attention"][0][0]["score"] == r["passage_attention"][1][0]["score"]
    lines = r["line_rules"]
    assert lines[0][0]["base_failed"] and not lines[0][0]["kept"] and lines[10][0]["n_dup_lines"] == 39
    assert lines[10][0]["n_repeat_words"] == 120
    # The line of rows 5, 5 and 6 stands twice in host h and once in host '': not above two.
    assert [x["n_line_words_removed"] for x in lines[5] + lines[6]] == [0, 0, 0]
    s = r["suffix_dedup"]
    n = len(edge_rows()[5][1])
    assert [(x["n_removed"], x["n_spans"]) for x in s[5] + s[6]] == [(n, 1)] * 3
    assert s[7][0]["n_removed"] == n and s[9][0]["n_removed"] == 5_000 and s[12][0]["n_removed"] == 0
    b = r["byte_language"]
    assert [b[i][0]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and b[0][0]["score"] == 0
    assert b[3][0]["lang_pred"] in ("de", "en")


def test_lines_above_the_limit_go(spark):
    text = "a line that many share\n" + prose(9, 30)
    d = edge_docs(spark, [(i, text + str(i), "en", "h") for i in range(5)] + [(9, "a line that many share", "en", "g")])
    rows = {r["doc_id"]: r for r in line_rules.line_rules(d, max_share=0.8, few=4).collect()}
    assert rows[0]["n_line_words_removed"] == 5 and rows[0]["kept"] and rows[9]["n_line_words_removed"] == 0
    freq = line_rules.frequent_lines(line_rules._keyed(d, "doc_id", "text", "source"), 0.8, 4)
    kept = {r["doc_id"]: r["text"] for r in line_rules.without_frequent_lines(d, freq).collect()}
    assert kept[0] == prose(9, 30) + "0" and kept[9] == "a line that many share"


def test_decontamination_edges(spark):
    d = edge_docs(spark)
    found = decontaminate.find_matches(d, _items(spark)).collect()
    assert sorted(r["doc_id"] for r in found) == [5, 5, 6, 7, 12]
    assert {(r["item_id"], r["score"], r["first_word"], r["end_word"]) for r in found} == {(3, 1.0, 10, 40)}
    assert decontaminate.find_matches(edge_docs(spark, []), _items(spark)).collect() == []
    assert decontaminate.find_matches(d, _items(spark, [])).collect() == []
    assert decontaminate.keep_clean(d, _items(spark)).count() == len(edge_rows()) - 5
    # Small blocks give the same.
    assert decontaminate.find_matches(d, _items(spark), block_words=8).count() == 5


def test_without_labels(spark):
    d = edge_docs(spark)
    assert {r["score"] for r in passage_attention.quality(d, _labels(spark, [])).collect()} == {0.5}
    none = edge_docs(spark, [(i, t, None, s) for i, t, _, s in edge_rows()])
    assert {r["lang_pred"] for r in byte_language.language_id(none).collect()} == {"und"}


def test_rows_without_an_id(spark):
    """They stay in the pipeline's stages and take part in every comparison."""
    shared, base = prose(21, 90), prose(22, 120)
    near = base + " tail end"
    d = edge_docs(spark, [(None, prose(23, 60), "en", "h"), (None, prose(24, 70), "en", "h"), (None, base, "en", "h"),
                          (None, near, "en", "h"), (7, prose(25, 80), "en", "h"), (7, prose(26, 80), "en", "h"),
                          (3, prose(26, 80) + " more", "en", "h"), (None, prose(27, 50) + shared, "en", "h"),
                          (9, prose(28, 50) + shared, "en", "h")])
    kept = [r["text"] for r in hyperminhash.keep_one_of_each(d).collect()]
    assert (base in kept) + (near in kept) == 1
    assert sorted(t for t in kept if t not in (base, near)) == sorted(
        [prose(23, 60), prose(24, 70), prose(25, 80), prose(26, 80) + " more", prose(27, 50) + shared, prose(28, 50) + shared])
    cut = {r["doc_id"]: r for r in suffix_dedup.substring_dedup(d.filter("doc_id = 9 or text like '%" + shared + "'")).collect()}
    assert len(shared) > 400 and all(cut[i]["n_removed"] >= len(shared) for i in (None, 9))
    rows = suffix_dedup.without_repeats(d).collect()
    assert len(rows) == 9 and [r["doc_id"] for r in rows if shared in r["text"]] == [9]    # rows without an id come last


def test_pages(spark):
    schema = "page_id long, url string, html string, text string, n_chars int"
    pages = spark.createDataFrame([(1, None, None, "x", 1), (1, "u", "", "x", 1), (None, "u", "<p>only &amp; one", "x", 1),
                                   (2, "u", "<b><<>>&&#; <p", "x", 1), (3, "u", "<div>" * 3_000 + "deep", "x", 1)], schema)
    rows = tag_paths.extract_pages(pages).collect()
    assert sorted(r["text"] for r in rows)[:2] == ["", ""] and len(rows) == 5
    assert {r["text"] for r in rows} >= {"only & one", "deep"}
    assert tag_paths.extract_pages(spark.createDataFrame([], schema)).collect() == []
