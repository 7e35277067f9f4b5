import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _text string, n long, words string"


def corpus():
    """Rows with nulls, empty and long texts, ties, repeated rows, shared passages and near copies."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)] + ["Été", "naïve", "日本", "x\x1cy", "a\xa0b"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = text(70)
    rows = []
    for i in range(60):
        rows.append((i, text(rng.randint(1, 160)) + rng.choice(["", "\n", " \t"]), "en", f"s{i % 4}"))
    for i in range(60, 75):
        rows.append((i, text(20) + " " + passage + "\n" + text(15), "fr", "s0"))
    base = text(150).split(" ")
    for i in range(75, 95):
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, " ".join(words).upper() if i % 5 == 0 else " ".join(words), "en", "s0"))
    rows += [(95, rows[3][1], "en", "s1"), (96, rows[3][1], "en", None), (97, None, None, "s2"), (98, "", "en", "s2"), (99, "   \n\t ", None, None)]
    rows += [(100, text(9000), "en", "s3"), (101, "word", "en", "s1"), (102, "word", "de", "s1"), (103, "ab ab " * 120, "en", "s1")]
    rows += [rows[5], rows[5], (None, text(80), "en", "s0"), (None, None, None, None), (3, text(60), "en", "s1")]
    return [(i, t, lang, s, None if t is None else len(t), "clash", 1, "w") for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
