import random

import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long, score string, bin int, label double"
SYLLABLES = {"en": "th er on an re he in ed nd ha at en es of or".split(), "de": "sch ung ein ver ich keit ge zu pf ach lich".split()}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def corpus(n=60, seed=1):
    """Documents with exact and near copies, a hot source, and short texts."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        lang = rng.choice(["en", "de"])
        t = prose(rng, lang, rng.choice([1, 2, 5, 40, 120]))
        if i % 5 == 1 and rows:
            t, lang = rows[rng.randrange(len(rows))][1:3]
        elif i % 5 == 2 and rows:
            t, lang = rows[rng.randrange(len(rows))][1:3]
            w = t.split()
            if w:
                w[rng.randrange(len(w))] = "changed"
            t = " ".join(w)
        rows.append((i, t, lang, "hot" if i % 3 == 0 else f"s{i % 4}", len(t), "x", 1, 0.5))
    return rows


EDGES = [
    (1, None, None, None, None, None, None, None), (2, "", "en", "a", 0, "x", 1, 0.1), (2, "", "en", "a", 0, "x", 1, 0.1), (None, "null id text here", "en", None, 1, None, None, None),
    (3, " \t\n ", "de", "a", 4, "x", 1, 0.1), (4, "one", "en", "a", 3, "x", 1, 0.1), (4, "one other text", "en", "b", 3, "x", 1, 0.1), (5, "12 34 !!", "en", "b", 8, "x", 1, 0.1),
    (6, "word " * 30000, "en", "a", 150000, "x", 1, 0.1), (7, "Ünï çödé 漢字 \U0001f600 text", "de", "b", 10, "x", 1, 0.1), (8, "the same words", "en", "a", 1, "x", 1, 0.1), (9, "the same words", "en", "a", 1, "x", 1, 0.1),
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), DDL)


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(EDGES, DDL)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DDL)
