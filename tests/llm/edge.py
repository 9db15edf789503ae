"""Small tables with every awkward row the text operators have to take."""

import random


LONG_WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(LONG_WORDS) + rng.choice("abcdefgh") * rng.randint(0, 2) for _ in range(n))


def edge_rows():
    base = prose(1, 120)
    return [
        (0, "", "en", "h"), (1, None, None, None), (2, " \n\t ", "en", "h"), (3, "one", "en", "h"), (4, "one two", "en", "h"),
        (5, base, "en", "h"), (5, base, "en", "h"), (6, base, "de", None), (7, base + " tail end", "en", "h"),
        (8, prose(2, 30_000), "en", "h"), (None, prose(3, 50), "en", "h"), (9, "x" * 5_000, None, "h"),
        (10, "\n".join(["same line here"] * 40), "en", "h"), (11, "日本語 ▁ é ß \x00 😀  double  blanks\r\n", "de", "h"),
        (12, base[:300] + " other " + prose(4, 40), "en", "h"),
        (13, "released under the MIT license. " + prose(5, 30), "en", "h"),
    ]


def edge_docs(spark, rows=None):
    """Documents with extra columns whose names the operators use inside."""
    rows = edge_rows() if rows is None else rows
    return spark.createDataFrame([(i, t, g, s, len(t or ""), "n", "t", 1, 2, 3, 4) for i, t, g, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, node string, "
                                 "text_id string, key long, words int, rep long, ids int")
