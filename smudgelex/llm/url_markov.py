"""Accept or reject URLs: host rules first, then a character language-model ratio.

Two smoothed variable-order Markov models are learned, one from the URLs that the rules
allow and one from those they block. A URL without a rule is judged by the difference
of the two log-likelihoods per character, against a threshold calibrated on labelled
URLs kept out of the models.

Everything is a native column expression. A model is one number per window of
``ORDER + 1`` characters over an alphabet of fewer than 48 symbols, so it has fewer than
48 ** 4 rows whatever the corpus; it is measured before it is broadcast.

Null and empty URLs, and URLs without ``://``, have an empty host and path, no rule and
a score of 0. Repeated rows give repeated results. Without any labelled URL on one side
both models fall back to the uniform distribution. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smudgelex.llm.common import joined, let, materialized, table

ORDER = 3
# Symbols a model knows; digits become 0 and every other character "~".
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0./:-_?=&#%+,;@!~^"
START = "^" * ORDER
# Log ratios are kept in millionths, so that sums do not depend on their order.
UNIT = 1_000_000
# Width of a threshold step, in millionths per character.
STEP = 10_000


@dataclass(frozen=True)
class Rule:
    """``pattern`` is host/path; it fits the host and all its subdomains."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


# The rules of the registered query.
RULES = (
    Rule("allow", "org/"),
    Rule("block", "example.org/es/"),
    Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"),
    Rule("block", "com/de/"),
)

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1)
    return F.translate(host, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    of_host = (host == rule.host) | host.endswith("." + rule.host)
    return of_host & path.startswith(rule.path)


def with_rules(df: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Adds ``rule`` and ``listed``, the verdict of the longest rule that fits."""
    rule = listed = None
    for r in sorted(rules, key=lambda r: -len(r.pattern)):
        fits = _fits(r, F.col("host"), F.col("path"))
        rule = F.when(fits, r.pattern) if rule is None else rule.when(fits, r.pattern)
        listed = F.when(fits, r.verdict) if listed is None else listed.when(fits, r.verdict)
    if rule is None:
        rule = listed = F.lit(None).cast("string")
    return df.select("*", rule.alias("rule"), listed.alias("listed"))


def normal_form(url: Column) -> Column:
    """The characters the models read: lower case, without the scheme."""
    text = F.regexp_replace(F.coalesce(url, F.lit("")), r"(?s)^.*?://", "")
    text = F.translate(text, _UPPER, _UPPER.lower())
    text = F.regexp_replace(text, "[0-9]", "0")
    return F.regexp_replace(text, r"[^a-z0./:\-_?=&#%+,;@!]", "~")


def windows(text: Column) -> Column:
    """Every character with the ``ORDER`` before it, in linear time."""

    def shifted(chars: Column) -> Column:
        n = F.size(chars) - F.lit(ORDER)
        parts = [F.slice(chars, F.lit(k + 1), n) for k in range(ORDER + 1)]
        zipped = F.arrays_zip(*[p.alias(f"c{k}") for k, p in enumerate(parts)])
        return F.transform(
            zipped, lambda z: F.concat(*[z[f"c{k}"] for k in range(ORDER + 1)])
        )

    padded = F.concat(F.lit(START), text)
    return F.when(F.length(text) > 0, let(F.split(padded, ""), shifted))


def _smoothed(counts: DataFrame) -> DataFrame:
    """``(window, llr)``: Witten-Bell interpolation from order 0 up to ``ORDER``.

    Contexts never seen by a model pass the probability of the shorter context on.
    """
    flat = 1.0 / len(SYMBOLS)
    below = None
    for k in range(ORDER + 1):
        seen = counts.groupBy(F.right("window", F.lit(k + 1)).alias("gram")).agg(
            F.sum("good").alias("good"), F.sum("bad").alias("bad")
        )
        context = F.left("gram", F.lit(k)).alias("context")
        w = Window.partitionBy("context")
        seen = seen.select("*", context).select(
            "gram",
            *[
                F.struct(
                    F.col(side).alias("n"),
                    F.sum(side).over(w).alias("all"),
                    F.sum((F.col(side) > 0).cast("int")).over(w).alias("kinds"),
                ).alias(side)
                for side in ("good", "bad")
            ],
        )
        if below is None:
            seen = seen.select("*", F.lit(flat).alias("p_good"), F.lit(flat).alias("p_bad"))
        else:
            seen = seen.withColumn("lower", F.right("gram", F.lit(k)))
            seen = seen.join(below, "lower")
        probabilities = [
            F.when(F.col(side)["all"] == 0, F.col(f"p_{side}"))
            .otherwise(
                (F.col(side)["n"] + F.col(side)["kinds"] * F.col(f"p_{side}"))
                / (F.col(side)["all"] + F.col(side)["kinds"])
            )
            .alias(f"p_{side}")
            for side in ("good", "bad")
        ]
        below = seen.select(F.col("gram").alias("lower"), *probabilities)
    ratio = F.round(UNIT * (F.ln("p_good") - F.ln("p_bad"))).cast("bigint")
    return below.select(F.col("lower").alias("window"), ratio.alias("llr"))


def calibrated_threshold(scores: DataFrame) -> int:
    """The step with the best sum of true rates on labelled URLs outside the models.

    It lies half way between two occupied steps. Ties go to the threshold nearest 0, then
    to the lower one; 0 without URLs of both kinds.
    The histogram has one row per step, whatever the number of URLs.
    """
    total = Window.partitionBy(F.lit(0))
    upto = total.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = scores.groupBy("step").agg(
        F.count_if(F.col("listed") == "allow").alias("good"),
        F.count_if(F.col("listed") == "block").alias("bad"),
    )
    zero = F.lit(0).cast("bigint")
    below = F.lag("step").over(total.orderBy("step"))
    middle = F.floor((F.coalesce(below, F.col("step")) + F.col("step") + 1) / 2).alias("step")
    steps = steps.select(
        middle,
        (F.sum("good").over(total) - F.coalesce(F.sum("good").over(upto), zero)).alias("kept"),
        F.coalesce(F.sum("bad").over(upto), zero).alias("stopped"),
        F.sum("good").over(total).alias("good"),
        F.sum("bad").over(total).alias("bad"),
    ).where((F.col("good") > 0) & (F.col("bad") > 0))
    gain = F.col("kept") * F.col("bad") + F.col("stopped") * F.col("good")
    best = steps.select(F.struct(gain, -F.abs("step"), -F.col("step")).alias("best"))
    row = best.agg(F.max("best").alias("best")).first()["best"]
    return 0 if row is None else -row[2]


def judge_urls(
    df: DataFrame,
    id: str = "page_id",
    url: str = "url",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """``(id, host, path, rule, verdict, score)``; the score is in log units per
    character, positive for URLs like the allowed ones."""
    rows = df.select(F.col(id).alias("id"), F.col(url).alias("url"))
    rows = rows.select("*", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = with_rules(rows, rules)
    # Three sixteenths of the labelled URLs calibrate and are not learned from.
    aside = F.left(F.md5("url"), F.lit(1)).isin("0", "1", "2")
    text = normal_form(F.col("url")).alias("text")
    learned = F.coalesce(~aside, F.lit(False)).alias("learned")
    rows = rows.select("id", "url", "host", "path", "rule", "listed", learned, text)
    grams = rows.select("listed", "learned", F.explode(windows(F.col("text"))).alias("window"))
    counts = grams.groupBy("window").agg(
        F.count_if(F.col("learned") & (F.col("listed") == "allow")).alias("good"),
        F.count_if(F.col("learned") & (F.col("listed") == "block")).alias("bad"),
    )
    model = materialized(_smoothed(materialized(counts)))
    spelled = rows.select("*", F.posexplode_outer(windows(F.col("text"))).alias("pos", "window"))
    scored = joined(spelled, model, ["window"])
    # All windows of a row are in one task, so the sum is combined before the shuffle.
    keys = ["id", "url", "host", "path", "rule", "listed", "learned"]
    first = F.coalesce("pos", F.lit(0)) == 0
    scored = scored.groupBy(*keys).agg(
        F.count_if(first).alias("copies"),
        F.count("pos").alias("n"),
        F.coalesce(F.sum("llr"), F.lit(0).cast("bigint")).alias("total"),
    )
    step = F.floor(F.col("total") / (F.greatest("n", F.lit(1)) * F.lit(float(STEP))))
    scored = materialized(scored.select("*", step.alias("step")))
    outside = scored.where(~F.col("learned") & F.col("listed").isNotNull())
    threshold = calibrated_threshold(outside)
    own = F.when(F.col("step") >= threshold, "allow").otherwise("block")
    rated = F.col("total") / (F.greatest("n", F.lit(1)) * F.lit(float(UNIT)))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return scored.select(
        F.col("id").alias(id),
        "host",
        "path",
        "rule",
        F.coalesce("listed", own).alias("verdict"),
        rated.alias("score"),
        copies.alias("_copy"),
    ).drop("_copy")


def op2_url_markov(spark, sf):
    judged = judge_urls(table(spark, sf, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_sql() -> str:
    """The same in DuckDB SQL, a common table expression for each order of the model."""
    rules = sorted(RULES, key=lambda r: -len(r.pattern))
    cases = [
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN "
        for r in rules
    ]
    rule = " ".join(f"{c}'{r.pattern}'" for c, r in zip(cases, rules, strict=True))
    listed = " ".join(f"{c}'{r.verdict}'" for c, r in zip(cases, rules, strict=True))
    parts = [f"translate(regexp_extract(u, '{_PARTS}', 1), '{_UPPER}', '{_UPPER.lower()}')", f"regexp_extract(u, '{_PARTS}', 2)"]
    orders = []
    for k in range(ORDER + 1):
        flat = 1.0 / len(SYMBOLS)
        below = f"JOIN p{k - 1} b ON b.gram = right(s.gram, {k})" if k else ""
        p = {side: f"b.p_{side}" if k else f"CAST({flat!r} AS DOUBLE)" for side in ("good", "bad")}
        smooth = ", ".join(
            f"CASE WHEN all_{x} = 0 THEN {p[x]} ELSE ({x} + kinds_{x} * {p[x]}) / (all_{x} + kinds_{x}) END AS p_{x}"
            for x in ("good", "bad")
        )
        sums = ", ".join(
            f"sum({x}) OVER w AS all_{x}, sum(CASE WHEN {x} > 0 THEN 1 ELSE 0 END) OVER w AS kinds_{x}" for x in ("good", "bad")
        )
        orders.append(f"""
g{k} AS (SELECT right(gram, {k + 1}) AS gram, sum(good) AS good, sum(bad) AS bad FROM counts GROUP BY 1),
s{k} AS (SELECT *, {sums} FROM g{k} WINDOW w AS (PARTITION BY left(gram, {k}))),
p{k} AS (SELECT s.gram, {smooth} FROM s{k} s {below}),""")
    return f"""
WITH base AS (SELECT row_number() OVER () AS rid, page_id, url, coalesce(url, '') AS u FROM pages),
parts AS (SELECT *, {parts[0]} AS host, {parts[1]} AS path,
  regexp_replace(regexp_replace(translate(regexp_replace(u, '(?s)^.*?://', ''), '{_UPPER}', '{_UPPER.lower()}'),
    '[0-9]', '0', 'g'), '[^a-z0./:\\-_?=&#%+,;@!]', '~', 'g') AS t,
  coalesce(left(md5(url), 1) NOT IN ('0', '1', '2'), false) AS learned FROM base),
ruled AS (SELECT *, CASE {rule} END AS rule, CASE {listed} END AS listed FROM parts),
grams AS (SELECT rid, listed, learned, unnest(list_transform(range(1, length(t) + 1),
  lambda i: substr('{START}' || t, i, {ORDER + 1}))) AS gram FROM ruled),
counts AS (SELECT gram, count(*) FILTER (learned AND listed = 'allow') AS good,
  count(*) FILTER (learned AND listed = 'block') AS bad FROM grams GROUP BY gram),{"".join(orders)}
model AS (SELECT gram, CAST(round({UNIT} * (ln(p_good) - ln(p_bad))) AS BIGINT) AS llr FROM p{ORDER}),
sums AS (SELECT rid, count(*) AS n, sum(llr) AS total FROM grams JOIN model USING (gram) GROUP BY rid),
scored AS (SELECT r.*, floor(coalesce(s.total, 0) / (greatest(coalesce(s.n, 0), 1) * {float(STEP)})) AS step
  FROM ruled r LEFT JOIN sums s USING (rid)),
steps AS (SELECT step, count(*) FILTER (listed = 'allow') AS good, count(*) FILTER (listed = 'block') AS bad
  FROM scored WHERE NOT learned AND listed IS NOT NULL GROUP BY step),
tried AS (SELECT floor((coalesce(lag(step) OVER (ORDER BY step), step) + step + 1) / 2) AS mark,
  (sum(good) OVER () - coalesce(sum(good) OVER b, 0)) * sum(bad) OVER ()
    + coalesce(sum(bad) OVER b, 0) * sum(good) OVER () AS gain,
  sum(good) OVER () AS all_good, sum(bad) OVER () AS all_bad
  FROM steps WINDOW b AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen AS (SELECT coalesce((SELECT mark FROM tried WHERE all_good > 0 AND all_bad > 0
  ORDER BY gain DESC, abs(mark), mark LIMIT 1), 0) AS mark)
SELECT page_id, host, path, rule, coalesce(listed, CASE WHEN step >= mark THEN 'allow' ELSE 'block' END) AS verdict
FROM scored, chosen"""
