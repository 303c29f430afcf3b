"""Inputs with nulls, empty and long texts, ties, repeated rows and clashing column names."""

import random

CLASHING = "node string, score string, row string, key string, size string, kept string, text_a string, band string, doc string, part string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


def words(n, seed, stock=400):
    r = random.Random(seed)
    return [r.choice("bcdfglmnprst") + r.choice("aeiou") + r.choice("lmnrst") + str(r.randrange(stock)) for _ in range(n)]


def prose(n, seed, per_line=12):
    w = words(n, seed)
    return "\n".join(" ".join(w[i : i + per_line]) for i in range(0, n, per_line))


def rows():
    long = prose(30_000, 99)
    near = prose(200, 1).split(" ")
    near[50] = "changed"
    passage = " ".join(words(60, 7))
    out = [
        (1, prose(200, 1), "en", "a"), (2, prose(200, 1), "en", "a"), (2, prose(200, 1), "en", "a"), (3, " ".join(near), "de", None),
        (4, None, None, None), (4, None, None, None), (5, "", "en", ""), (6, " \n\t ", "en", "b"), (None, prose(120, 3), "en", "b"),
        (None, prose(120, 3), "en", "b"), (7, long, "en", "a"), (8, "one two", "fr", "a"), (9, "one two", "fr", "c"),
        (10, "été Ünïcode ☃ 漢字 " * 30, None, "c"), (11, prose(80, 5) + "\n" + passage, "de", "d"), (12, prose(80, 6) + "\n" + passage, "de", "d"),
        (13, "\x00 null \x00 bytes", "en", "a"), (14, "12 34 %% 56", "en", "a"), (12, "same id, other text", "de", "e"),
    ]
    return [(i, t, lang, s, len(t) if t is not None else None, *["x"] * 10) for i, t, lang, s in out]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)
