"""Small tables with the hard cases: nulls, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, source string, _text string, fp long, kept boolean, n_words long"


def rows(seed: int = 5, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 7))) for _ in range(150)]
    text = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passage = text(110)
    out = [(i, text(rng.randint(5, 120)), rng.choice(["a", "b", None])) for i in range(n)]
    out += [
        (n, None, "a"), (n + 1, "", "b"), (n + 2, "   \n\t ", None), (None, text(40), "a"),
        (n + 3, text(3000), "b"), (n + 4, "word " * 2000, "a"), (n + 5, passage, "c"),
        (n + 6, text(20) + " " + passage + " " + text(10), "c"), (n + 7, passage.upper(), "c"),
        (n + 8, "x" * 1500, "a"), (n + 9, "line one two\nline one two\n\nOTHER! ##\n" * 12, "b"),
    ]
    same = (n + 10, text(90), "b")
    out += [same, same, (n + 11, same[1], "b"), (n + 12, same[1] + " tail", "b"), (n + 10, text(30), "a")]
    rng.shuffle(out)
    return [(i, t, s, "clash", 7, False, 3) for i, t, s in out]


def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3)


def none(spark):
    return spark.createDataFrame([], DOCS)


def got(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
