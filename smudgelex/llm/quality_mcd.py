"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Each text becomes a small vector of transformed statistics. For every language and
source, the location and scatter of the half of the documents with the smallest
covariance determinant are estimated: concentration steps run from three starts (the
coordinate-wise quartiles) until the determinants stand still, and the start that ends
with the least one is kept. The scatter is calibrated to the chi-squared law by the
median distance, estimated once more from all documents within its 97.5 % quantile, and
calibrated again. A document is rejected when its Mahalanobis distance is too large.

A statistic that is the same for more than half of a group (no symbol, no repeated line)
leaves that half in a plane, so the group has no spread to offer for it. The estimate
then holds for the other statistics, and a text off the plane is judged by a stated
tolerance, which does not depend on the group.

Everything is a native expression. A concentration step is one aggregation that is
combined before its shuffle: per group and distance bucket it keeps counts and sums, so
no group is ever gathered, however large. Statistics are fixed-point integers and their
sums exact decimals, so the result depends neither on the partitions nor on a retry.

Groups with fewer than ``MIN_GROUP`` usable documents are estimated together by
language, and languages with fewer together with all such. Null languages and sources
are groups of their own. Null and empty texts have no words: they fail the base rules
and take no part in the estimates. Repeated rows count and are returned as often as
they occur. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smudgelex.llm.common import joined, let, materialized, table

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MIN_GROUP = 100
# Concentration steps at most, and the change of a log-determinant that counts as none.
STEPS = 10
STILL = 1e-3
# Where the starts lie in every coordinate.
STARTS = (0.5, 0.25, 0.75)
# Share of a group in the covering half: what is alike in less than half is not fitted.
COVER = 0.5
# Statistics are kept in multiples of 1 / SCALE.
SCALE = 4096
# Buckets of squared distance per doubling.
PER_OCTAVE = 16
# Cells of a coordinate's histogram per unit.
CELLS = 512
# Statistic and the spread it is given where more than half of a group agree on it. A
# share differs by at most log1p(100): with less than 0.64 it can reject a text by itself.
STATISTICS = (
    ("word_length", 0.40),
    ("symbols", 0.40),
    ("repeated_lines", 0.40),
    ("repeated_words", 0.40),
    ("capitals", 0.40),
)
# What a spread that was found is widened by: a tenth of the median deviation, or this.
WIDEN = 0.1
LEAST = 0.01
# A document goes beyond this squared distance: the 1 - 1e-9 quantile of chi-squared
# with five degrees of freedom, since clean text has heavier tails than a normal law.
CUTOFF = 51.4
# Medians and 97.5 % quantiles of chi-squared, by degrees of freedom from one to five.
CHI2_MEDIAN = (0.455, 1.386, 2.366, 3.357, 4.351)
CHI2_MOST = (5.02, 7.38, 9.35, 11.14, 12.83)

_BLANK = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"
P = len(STATISTICS)
X = [f"x{i}" for i in range(P)]
M = [f"m{i}" for i in range(P)]
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
# What is added to the diagonal of a scatter, and the number of statistics with spread.
FLOORS = [f"f{i}" for i in range(P)]
FIXED = [*FLOORS, "dof"]


def _repeated_windows(words: Column) -> Column:
    """Start positions, in order, of the three-word windows that occur twice or more.

    The windows are sorted with their words, so equal ones are neighbours; no hash.
    """
    n = F.greatest(F.size(words) - F.lit(2), F.lit(0))
    parts = [F.slice(words, F.lit(k + 1), n).alias(f"w{k}") for k in range(3)]
    places = F.slice(F.sequence(F.lit(1), F.size(words) + 1), F.lit(1), n).alias("at")
    ordered = F.sort_array(F.arrays_zip(*parts, places))

    def marked(s: Column) -> Column:
        same = F.zip_with(
            F.slice(s, F.lit(1), F.size(s) - 1),
            F.slice(s, F.lit(2), F.size(s) - 1),
            lambda a, b: (a["w0"] == b["w0"]) & (a["w1"] == b["w1"]) & (a["w2"] == b["w2"]),
        )

        def twice(same: Column) -> Column:
            no = F.array(F.lit(False))
            flags = F.arrays_zip(s["at"].alias("at"), F.concat(no, same).alias("a"), F.concat(same, no).alias("b"))
            hits = F.filter(flags, lambda f: f["a"] | f["b"])
            return F.sort_array(F.transform(hits, lambda f: f["at"]))

        return F.when(F.exists(same, lambda x: x), let(same, twice))

    found = F.when(F.size(words) >= 4, let(ordered, marked))
    return F.coalesce(found, F.array().cast("array<int>"))


def _covered(starts: Column) -> Column:
    """Words covered by three-word windows that begin at these sorted positions."""
    following = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.lit(2**31 - 1)))
    gaps = F.zip_with(starts, following, lambda a, b: F.least(b - a, F.lit(3)))
    total = F.aggregate(gaps, F.lit(0), lambda s, g: s + g)
    return F.when(F.size(starts) == 0, 0).otherwise(total).cast("bigint")


def base_statistics(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Word, symbol, line and repetition counts of each whole text."""
    value = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(value, _BLANK), "")
    lines = F.filter(F.split(value, "\n"), lambda x: F.rlike(x, F.lit(_WORD)))
    count = lambda pattern: F.length(value) - F.length(F.regexp_replace(value, pattern, ""))
    return df.select(
        *keep,
        words.alias("_words"),
        count(r"[#*$%&|<>]+").cast("bigint").alias("n_symbols"),
        count(r"\p{Lu}+").cast("bigint").alias("n_capitals"),
        let(
            lines,
            lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct")),
        ).alias("_lines"),
    ).select(
        *keep,
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        "n_capitals",
        F.col("_lines")["n"].cast("bigint").alias("n_lines"),
        (F.col("_lines")["n"] - F.col("_lines")["distinct"]).cast("bigint").alias("n_dup_lines"),
        let(_repeated_windows(F.col("_words")), _covered).alias("n_repeat_words"),
    )


def _vector() -> list[Column]:
    def share(count: str, of: str, more: int) -> Column:
        """Of so many more, since a line of five that repeats says little."""
        return F.log1p(100.0 * F.col(count) / (F.col(of) + F.lit(more)))

    values = (
        F.log(F.greatest("word_chars", F.lit(1)) / F.greatest("n_words", F.lit(1))),
        share("n_symbols", "n_words", 20),
        share("n_dup_lines", "n_lines", 20),
        share("n_repeat_words", "n_words", 100),
        F.log((F.col("n_capitals") + F.lit(2.0)) / (F.col("word_chars") + F.lit(200.0))),
    )
    return [F.round(v * SCALE).cast("bigint").alias(x) for v, x in zip(values, X, strict=True)]


def _grouped(rows: DataFrame) -> DataFrame:
    """Adds ``group``: language and source, language, or all, by the size of each."""
    sizes = rows.where(~F.col("base_failed")).groupBy("_lang", "_source").agg(F.count(F.lit(1)).alias("n"))
    small = F.col("n") < MIN_GROUP
    by_lang = Window.partitionBy("_lang")
    # One row per source: summed within a language before a language is looked at.
    rest = F.sum(F.when(small, F.col("n")).otherwise(0)).over(by_lang)
    level = F.when(~small, 2).when(rest >= MIN_GROUP, 1).otherwise(0)
    levels = materialized(sizes.select("_lang", "_source", level.alias("level")))
    rows = joined(rows, levels, ["_lang", "_source"])
    named = F.to_json(F.struct("level", F.when(F.col("level") > 0, F.col("_lang")).alias("l"), F.when(F.col("level") > 1, F.col("_source")).alias("s")))
    return rows.withColumn("level", F.coalesce("level", F.lit(0))).withColumn("group", named)


def _bucket(value: Column) -> Column:
    return F.floor(PER_OCTAVE * F.log2(value + F.lit(2.0**-20))).cast("int")


def _cut(counts: DataFrame, keys: list[str], order: str, share: float) -> DataFrame:
    """The bucket in which a group reaches ``share`` of its rows."""
    whole = Window.partitionBy(*keys)
    upto = F.sum("n").over(whole.orderBy(order))
    counts = counts.select("*", upto.alias("upto"), F.sum("n").over(whole).alias("all"))
    reached = counts.where(F.col("upto") >= F.ceil(F.col("all") * share))
    return reached.groupBy(*keys).agg(F.min(order).alias(order))


def _median_start(rows: DataFrame, shares: tuple[float, ...] = (0.5,)) -> DataFrame:
    """A start at each of these shares of all coordinates, numbered by ``start``: its
    place, a diagonal scatter from the median deviations, and the floors."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(i).alias("dim"), F.col(x).alias("x")) for i, x in enumerate(X)])
    )
    long = rows.select("group", cells.alias("c")).select("group", "c.dim", "c.x")
    cell = F.floor(F.col("x") / (SCALE // CELLS)).cast("bigint").alias("cell")
    counts = long.groupBy("group", "dim", cell).agg(F.count(F.lit(1)).alias("n"))
    counts = materialized(counts)
    places = [_cut(counts, ["group", "dim"], "cell", share) for share in shares]
    medians = _cut(counts, ["group", "dim"], "cell", 0.5).withColumnRenamed("cell", "mid")
    away = counts.join(medians, ["group", "dim"]).select(
        "group", "dim", F.abs(F.col("cell") - F.col("mid")).alias("cell"), "n"
    )
    away = away.groupBy("group", "dim", "cell").agg(F.sum("n").alias("n"))
    spread = materialized(_cut(away, ["group", "dim"], "cell", 0.5).withColumnRenamed("cell", "mad"))
    one = lambda name, i: F.max(F.when(F.col("dim") == i, F.col(name)))
    starts = None
    for number, place in enumerate(places):
        flat = place.join(spread, ["group", "dim"]).groupBy("group").agg(
            *[(one("cell", i) / float(CELLS)).alias(M[i]) for i in range(P)],
            *[(one("mad", i) * 1.4826 / float(CELLS)).alias(f"s{i}") for i in range(P)],
        )
        flat = flat.withColumn("start", F.lit(number))
        starts = flat if starts is None else starts.unionByName(flat)
    floors = [
        F.when(F.col(f"s{i}") > 0, F.pow(F.greatest(WIDEN * F.col(f"s{i}"), F.lit(LEAST)), F.lit(2.0)))
        .otherwise(tolerance**2)
        .alias(FLOORS[i])
        for i, (_, tolerance) in enumerate(STATISTICS)
    ]
    dof = F.lit(0)
    for i in range(P):
        dof = dof + (F.col(f"s{i}") > 0).cast("int")
    scatter = [
        (F.pow(f"s{i}", F.lit(2.0)) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS
    ]
    return starts.select("group", "start", *M, *floors, dof.alias("dof"), *scatter)


def _inverted(params: DataFrame) -> DataFrame:
    """Scatter as ``r00...``; with the floors added, its inverse by sweeping as
    ``c00...`` and ``logdet``."""
    pairs = [f"c{i}{j}" for i, j in PAIRS]
    rest = [f"`{c}`" for c in params.columns if c not in pairs] + [f"r{i}{j}" for i, j in PAIRS]
    params = params.selectExpr("*", "0D as logdet", *[f"c{i}{j} as r{i}{j}" for i, j in PAIRS])
    params = params.selectExpr(
        *rest, "logdet", *[f"c{i}{j} + f{i} as c{i}{j}" if i == j else f"c{i}{j}" for i, j in PAIRS]
    )
    name = lambda i, j: f"c{min(i, j)}{max(i, j)}"
    for k in range(P):
        pivot = name(k, k)
        swept = []
        for i, j in PAIRS:
            if i == k and j == k:
                value = f"-1D / {pivot}"
            elif k in (i, j):
                value = f"{name(i, j)} / {pivot}"
            else:
                value = f"{name(i, j)} - {name(i, k)} * {name(j, k)} / {pivot}"
            swept.append(f"{value} as {name(i, j)}")
        params = params.selectExpr(*rest, f"logdet + ln({pivot}) as logdet", *swept)
    return params.selectExpr(*rest, "logdet", *[f"-{c} as {c}" for c in pairs])


def _distance() -> Column:
    off = [f"(x{i} / {SCALE}D - m{i})" for i in range(P)]
    terms = [f"{1 if i == j else 2}D * c{i}{j} * {off[i]} * {off[j]}" for i, j in PAIRS]
    return F.expr(f"greatest({' + '.join(terms)}, 0D)")


def _sums() -> list[Column]:
    """Exact sums of statistics and of their products."""
    parts = ["count(1) as n"]
    parts += [f"sum(cast({x} as decimal(20, 0))) as {x}" for x in X]
    parts += [f"sum(cast(x{i} * x{j} as decimal(20, 0))) as p{i}{j}" for i, j in PAIRS]
    parts += [f"max({c}) as {c}" for c in FIXED]
    return [F.expr(x) for x in parts]


def _moments(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and scatter by ``keys`` from sums of parts."""
    totals = [f"cast(sum({x}) as double) as {x}" for x in [*X, *[f"p{i}{j}" for i, j in PAIRS]]]
    kept = sums.groupBy(*keys).agg(*[F.expr(x) for x in ["sum(n) as n", *totals, *[f"max({c}) as {c}" for c in FIXED]]])
    kept = kept.selectExpr("*", *[f"x{i} / n / {SCALE}D as m{i}" for i in range(P)])
    scatter = [f"p{i}{j} / n / {SCALE**2}D - m{i} * m{j} as c{i}{j}" for i, j in PAIRS]
    return kept.selectExpr(*[f"`{k}`" for k in keys], *M, *FIXED, *scatter)


def _concentrated(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Mean and scatter of the covering half nearest to the present estimate."""
    keys = [k for k in ("group", "start") if k in rows.columns]
    near = joined(rows, params, keys).select(*keys, *X, *FIXED, _bucket(_distance()).alias("b"))
    sums = near.groupBy(*keys, "b").agg(*_sums())
    w = Window.partitionBy(*keys)
    sums = sums.select(
        "*",
        (F.sum("n").over(w.orderBy("b")) - F.col("n")).alias("before"),
        F.sum("n").over(w).alias("all"),
    ).where(F.col("before") < F.ceil(F.col("all") * COVER))
    return _moments(sums, keys)


def _least_determinant(rows: DataFrame, steps: int) -> DataFrame:
    """Mean and scatter of each group's half, from the start that ends lowest."""
    keys = ["group", "start"]
    params = materialized(_inverted(_median_start(rows, STARTS)))
    each = F.explode(F.array(*map(F.lit, range(len(STARTS))))).alias("start")
    rows = rows.select("*", each)
    for _ in range(steps):
        before = params.select(*keys, F.col("logdet").alias("was"))
        params = materialized(_inverted(_concentrated(rows, params)))
        moved = params.join(before, keys).where(F.abs(F.col("logdet") - F.col("was")) > STILL)
        if moved.isEmpty():
            break
    found = params.groupBy("group").agg(F.min(F.struct("logdet", "start")).alias("best"))
    found = found.select("group", F.col("best.start").alias("start"))
    return materialized(params.join(found, keys).drop("start"))


def _by_dof(values: tuple[float, ...], none: float) -> Column:
    out = F.lit(none)
    for dof, value in enumerate(values, 1):
        out = F.when(F.col("dof") == dof, value).otherwise(out)
    return out


def _calibrated(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Scatter in the scale at which the median distance is that of the chi-squared law;
    ``params`` come from ``_inverted``.

    Statistics on which more than half agree add nothing to it and keep their floor."""
    counts = joined(rows, params, ["group"]).groupBy("group", _bucket(_distance()).alias("b"))
    middle = _cut(counts.agg(F.count(F.lit(1)).alias("n")), ["group"], "b", 0.5)
    params = params.join(middle, "group")
    scale = F.pow(F.lit(2.0), F.col("b") / float(PER_OCTAVE)) / _by_dof(CHI2_MEDIAN, 1.0)
    params = params.withColumn("scale", F.when(F.col("dof") > 0, F.greatest(scale, F.lit(0.25))).otherwise(1.0))
    scatter = []
    for i, j in PAIRS:
        value = F.col("scale") * F.col(f"r{i}{j}")
        if i == j:
            # ``_inverted`` adds the floor once more.
            found = F.col(FLOORS[i]) != F.lit(STATISTICS[i][1] ** 2)
            value = value + F.when(found, (F.col("scale") - 1.0) * F.col(FLOORS[i])).otherwise(0.0)
        scatter.append(value.alias(f"c{i}{j}"))
    return params.select("group", *M, *FIXED, *scatter)


def robust_estimates(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """By group, from ``(group, x0...)``: mean and inverse of the calibrated scatter."""
    params = materialized(_inverted(_calibrated(rows, _least_determinant(rows, steps))))
    inside = joined(rows, params, ["group"]).where(_distance() <= _by_dof(CHI2_MOST, CHI2_MOST[0]))
    params = materialized(_inverted(_moments(inside.groupBy("group").agg(*_sums()), ["group"])))
    return materialized(_inverted(_calibrated(rows, params)))


def mark_outliers(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    cutoff: float = CUTOFF,
    steps: int = STEPS,
) -> DataFrame:
    """``(id, counts, base_failed, distance, kept)``; ``distance`` is squared, calibrated
    to the chi-squared law, and null where the base rules failed."""
    keys = df.select(
        F.col(id).alias("_id"), F.col(lang).alias("_lang"), F.col(source).alias("_source"), F.col(text).alias("_text")
    )
    rows = base_statistics(keys, "_text", ["_id", "_lang", "_source"])
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    rows = materialized(rows.select("*", failed.alias("base_failed"), *_vector()))
    rows = materialized(_grouped(rows))
    usable = rows.where(~F.col("base_failed")).select("group", *X)
    params = robust_estimates(usable, steps)
    judged = joined(rows, params, ["group"])
    distance = F.when(~F.col("base_failed"), _distance())
    return judged.select(
        F.col("_id").alias(id),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(distance <= cutoff, F.lit(True))).alias("kept"),
        distance.alias("distance"),
    )


def op1_quality_mcd(spark, sf):
    return mark_outliers(table(spark, sf, "documents"))
