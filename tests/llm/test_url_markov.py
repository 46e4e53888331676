from collections import Counter

import duckdb
from smudgelex.llm import url_markov as u

URLS = [
    ("http://WWW.Example.org/en/1?x=1", "www.example.org", "/en/1", "example.org/en/1", "block"),
    ("https://example.org/es/a#b", "example.org", "/es/a", "example.org/es/", "block"),
    ("https://a.example.org/fr", "a.example.org", "/fr", "org/", "allow"),
    ("http://x.com/fr/a", "x.com", "/fr/a", "com/fr/", "allow"),
    ("http://x.com/de/a", "x.com", "/de/a", "com/de/", "block"),
    ("http://x.com/en/://y.org/", "x.com", "/en/://y.org/", None, None),
    ("http://notorg/a", "notorg", "/a", None, None),
    ("http://x.org", "x.org", "", None, None),
    ("http://x.org?/a", "x.org", "", None, None),
    ("no scheme.org/a", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
    ("://", "", "", None, None),
]


def frame(spark, urls):
    rows = [(i, url, "h", "v", 1) for i, url in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id bigint, url string, host string, verdict string, id int")


def test_parts_and_rules(spark):
    got = {r.page_id: r for r in u.judge_urls(frame(spark, [x[0] for x in URLS])).collect()}
    assert len(got) == len(URLS)
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert verdict is None and r.verdict in ("allow", "block") or r.verdict == verdict


def test_model_learns_from_the_rules(spark):
    good = [f"http://library{i}.org/book/{i}" for i in range(80)]
    bad = [f"http://casino-win{i}.com/de/{i}" for i in range(80)]
    asked = [f"http://library{i}.net/book/{i}" for i in range(20)] + [f"http://casino-win{i}.net/x/{i}" for i in range(20)]
    rows = [r for r in u.judge_urls(frame(spark, good + bad + asked)).collect() if r.page_id >= 160]
    verdicts = Counter((r.page_id < 180, r.verdict) for r in rows)
    assert verdicts == {(True, "allow"): 20, (False, "block"): 20}


def test_windows_in_linear_time_and_repeats(spark):
    long = "http://a.net/" + "x" * 300_000
    out = u.judge_urls(frame(spark, [long, "http://b.net/"]).union(frame(spark, [long, "http://b.net/"]))).collect()
    assert Counter(r.page_id for r in out) == {0: 2, 1: 2}


def test_smoothing_by_brute_force(spark):
    import math

    texts = ["abab", "abc", "bca"]
    grams = Counter(w for t in texts for w in (("^" * u.ORDER + t)[i : i + u.ORDER + 1] for i in range(len(t))))
    counts = spark.createDataFrame([(g, n, 0) for g, n in grams.items()], "window string, good bigint, bad bigint")
    got = {r.window: r.llr for r in u._smoothed(counts).collect()}
    flat = 1 / len(u.SYMBOLS)

    def p(gram):
        if not gram:
            return flat
        seen = Counter()
        for g, n in grams.items():
            if g[-len(gram) :][:-1] == gram[:-1]:
                seen[g[-1]] += n
        below = p(gram[1:]) if len(gram) > 1 else flat
        return (seen[gram[-1]] + len(seen) * below) / (seen.total() + len(seen))

    for g, llr in got.items():
        assert abs(llr - u.UNIT * (math.log(p(g)) - math.log(flat))) <= 1


def test_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{small}/pages.parquet'")
    rows = u.op2_url_markov(spark, small).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(con.execute(u.op2_sql()).fetchall(), key=str)


def test_empty(spark):
    assert u.judge_urls(frame(spark, [])).count() == 0
