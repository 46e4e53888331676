import random
from collections import Counter

import duckdb
import pytest
from smudgelex.llm import spelling_variants as v

COLUMNS = ["word", "n", "n_near", "form", "form_n", "root"]


def by_sql(docs):
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    return con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({v.op11_sql()})").fetchall()


def found(docs):
    return [tuple(r) for r in v.group_variants(docs).select(*COLUMNS).collect()]


def test_odd_rows_against_sql(docs, no_docs):
    assert sorted(found(docs), key=repr) == sorted(by_sql(docs), key=repr)
    assert found(no_docs) == []


@pytest.fixture(scope="module")
def dense(spark):
    """Words over few letters, so that many are near and many share their letters."""
    rng = random.Random(8)
    words = ["".join(rng.choices("abé", k=rng.randint(5, 7))) for _ in range(900)] + ["a" * 5000, "É" * 40, "ÿ" * 6]
    rows = [(i, " ".join(rng.choices(words, weights=range(1, 904), k=60))) for i in range(400)] + [(0, "abaÉab X" * 9), (None, "aaabb " * 9)]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)


def test_dense_words_against_sql_and_brute_force(dense, monkeypatch):
    monkeypatch.setattr(v, "BLOCK", 3)
    monkeypatch.setattr(v, "HELD_WORDS", 50)
    got = found(dense)
    assert sorted(got, key=repr) == sorted(by_sql(dense), key=repr)
    letters = "abéÉÿabx"
    words = {w for w, *_ in got}
    for word, _, n_near, *_ in got:
        if len(word) > 100:
            continue
        cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
        near = {a + z[1:] for a, z in cuts if z} | {a + c + z for a, z in cuts for c in letters}
        near |= {a + c + z[1:] for a, z in cuts if z for c in letters}
        assert n_near == len(near & words - {word})
    assert any(r[3] and r[5] != r[3] for r in got)


def test_pairs_meet_in_one_choice():
    rng = random.Random(3)
    for _ in range(3000):
        a = rng.choices("abcdeé", k=rng.randint(4, 9))
        b = list(a)
        change = rng.random()
        if change < 0.5:
            b[rng.randrange(len(b))] = rng.choice("abcdeéz")
        else:
            b.append(rng.choice("abcdeéz"))
        a, b = "".join(sorted(a)), "".join(sorted(b))
        left, right = v.vector(a), v.vector(b)
        differ = [(left ^ right) >> (v.BITS * p) & v._FIELD != 0 for p in range(v.PARTS)]
        assert sum(differ) <= v.DISTANCE
        meet = [q for q, parts in enumerate(v.CHOICES) if not any(differ[p] for p in parts)]
        assert v.FIRST_CHOICE[sum(d << p for p, d in enumerate(differ))] == meet[0]
        out, into = Counter(a) - Counter(b), Counter(b) - Counter(a)
        want = ("".join(out), "".join(into)) if into else None
        assert v.changes(a, b) == want
    assert v.changes("aabc", "abbd") is None and v.changes("abc", "abdd") is None
