import random

import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared, long = say(70), "\n".join(say(40) for _ in range(800))
    line = "A shared LINE of text, \u00e9t\u00e9."
    rows = [
        (1, f"{say(30)}\n{line}\n{shared}", "en", "a"), (2, f"  {line.lower()}\t\n{say(20)} {shared} {say(10)}", "en", "b"),
        (3, None, None, None), (4, "", "en", "a"), (5, " \n\t ", "fr", "b"), (None, f"{line}\n{shared}", "en", "a"), (None, None, None, None),
        (6, long, "de", "c"), (7, long + " tail", "de", "c"), (8, f"{shared}\n{shared}", "en", "a"), (8, f"{shared}\n{shared}", "en", "a"),
        (9, "AAAA bbbb", "en", None), (10, "aaaa BBBB", "en", None), (11, "short\nshort\nshort line\nshort line", "en", "a"),
        (12, "x" * 50_000, "en", "a"), (-3, f"{line}\npassword = 'abc.def/ghi' token: x AKIA{'Z9' * 10}", None, "b"),
        (13, "secret=token: abcdef 0123456789abcdef0123456789abcdef \U0001f600 Api_Key:\"zz==zzzz", "en", "a"),
        (14, say(120), "en", "\u00e9"), (15, say(90) + " " + shared[:200], "es", "z"), (16, "a b c a b c a b c " * 20, "en", "a"),
    ]
    rows = [(d, t, g, s, None if t is None else len(t), "clash", 1, True) for d, t, g, s in rows]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, chunk int, kept boolean")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
