"""Small tables with the awkward rows that every operator must take: nulls, empty and long texts, ties, copies, clashing names."""

from __future__ import annotations

import random

import pytest

#: Names that operators might use themselves; they must not disturb.
EXTRA = "_own string, _own_key string, _own_id string, _bad_id string, _bad_key string, bad_id string, bad_key string, dropped_id string, dropped_key string, kept string, n_words long, prob_quality string, _row string, _gone string, _text string, _arrival string, arrival string, key string, row string, term string, item string, node string, comp string, block string, _k string, _id string, n string, t string, h string, a string, b string"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    vocabulary = [f"w{r.randrange(400)}" for _ in range(300)]
    return " ".join(r.choice(vocabulary) for _ in range(n))


def texts() -> list[tuple[int | None, str | None]]:
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    passage = prose(2, 60)
    rows = [
        (1, base),
        (2, base),  # an exact copy
        (3, " ".join(near)),  # a near copy
        (4, prose(3, 80) + "\n" + passage + "\n" + prose(4, 70)),
        (5, prose(5, 90) + "\n" + passage),
        (6, None),
        (7, ""),
        (8, "  \n \t"),
        (9, "one two three"),
        (10, "one two three"),
        (10, "one two three"),  # a repeated row
        (11, "x " * 9000),  # long
        (None, prose(6, 55)),
        (None, None),
        (12, "Short line.\nOther line.\n" + prose(7, 30)),
        (13, prose(8, 25) + "\nShort line.\nOther line."),
        (14, "ÀÉ éà ß Straße A-Z 12,5 ﬁ ÉCOLE école naïve — “quoted”"),
    ]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
    extra = [7 if x.endswith("long") else "e" for x in EXTRA.split(", ")]
    return spark.createDataFrame([(i, t, "en" if k % 2 else None, None, None if t is None else len(t), *extra) for k, (i, t) in enumerate(texts())], schema)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
