"""Small tables with every odd case, for all operators of this folder."""

import random

import pytest

DOC_SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint,"
    " score double, kept string, id int, _id string, class_id string, label int, n string"
)


def sentence(rng, n):
    sounds = ["tha", "re", "ing", "on", "ed", "ti", "sh", "an", "ou", "ble"]
    return " ".join("".join(rng.choices(sounds, k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """id, text, lang, source; ids and rows repeat, some of everything is null."""
    rng = random.Random(5)
    shared = sentence(rng, 120)
    rows = [(i, sentence(rng, rng.randint(40, 160)), "en", f"s{i % 2}") for i in range(40)]
    rows += [(100 + i, sentence(rng, 60) + "\n" + shared + "\n" + sentence(rng, 60), "de", None) for i in range(5)]
    base = sentence(rng, 150).split()
    for i in range(5):
        copy = list(base)
        copy[10 + 20 * i] = "changed"
        rows.append((200 + i, " ".join(copy), None, "s0"))
    rows += [(300, " ".join(base), "en", "s0"), (301, " ".join(base), "en", "s0")]
    rows += [(400, None, None, None), (401, "", "en", "s1"), (402, " \n\t", "en", "s1")]
    rows += [(403, "a" * 5000, "en", "s1"), (404, sentence(rng, 30000), "en", "s1")]
    rows += [(405, "é日本🙂 " * 200 + "tail", "fr", "s1"), (None, sentence(rng, 80), "en", "s1")]
    rows += [(406, "one two", "en", "s1"), (407, "one two", "en", "s1")]
    return rows + [rows[0], rows[0], rows[47], (1, "other text of a repeated id", "en", "s0")]


def wide(rows):
    return [(a, b, c, d, 0, 0.5, "x", 1, "y", "z", 1, "m") for a, b, c, d in rows]


@pytest.fixture(scope="session")
def docs(spark, texts):
    return spark.createDataFrame(wide(texts), DOC_SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
