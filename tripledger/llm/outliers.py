"""Quality rules: robust multivariate outliers of text statistics, per language and source.

Four shares are computed for each text and transformed; each language and source gets a minimum
covariance determinant estimate of their centre and spread, and a text is rejected when its
squared Mahalanobis distance is above a chi-square quantile.

The estimates come from concentration steps over all rows: distances under the present estimate
are counted in bins of 1/32 octave together with the moments of their rows, and the bins that
hold the nearest `H` of the rows give the next estimate. Rows are folded map-side to one row per
group and bin, so a group of any size meets as a few hundred rows. Statistics are integers
(1/1024 units) and their sums decimals, so estimates do not depend on the order of rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripledger.llm.common import packed, words
from tripledger.sources.scratch import materialize

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

STATS = ("word_length", "symbols", "dup_lines", "repeats")
D = len(STATS)
UNIT = 1024
#: Share of a group's rows that an estimate rests on.
H = 0.75
STEPS = 6
#: Chi-square quantile beyond which a text is an outlier.
QUANTILE = 0.999999
#: Least spread of each transformed statistic: below it a difference is noise of short texts.
FLOORS = (0.15, 0.6, 1.0, 1.0)
#: Bins per octave of squared distance, and the bin of distance zero.
PER_OCTAVE, LOWEST = 32, -1024
#: Groups whose estimates are broadcast (under 300 bytes each); more are joined by shuffle.
BROADCAST_GROUPS = 50_000


def _gamma_p(a: float, x: float) -> float:
    term = total = 1 / a
    n = a
    while term > total * 1e-15:
        n += 1
        term *= x / n
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def chi2_cdf(x: float, df: int) -> float:
    return _gamma_p(df / 2, x / 2) if x > 0 else 0.0


def chi2_quantile(p: float, df: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, df) < p else (lo, mid)
    return hi


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """`row` and the counts of the whole text: `n_words`, `word_chars` (code points in words),
    `n_symbols`, `n_lines` (with a word), `n_dup_lines` (equal to an earlier one),
    `n_repeat_words` (words in 8-word windows that occur twice or more, first included).

    Null texts count as empty; empty texts have zeros. Windows are told apart by the XXH64 value
    of their words' XXH64 values.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    n = F.size("ws")
    cut = packed(docs, text=F.col(text)).select(
        "row", t.alias("text"), words(F.col("text")).alias("ws"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"))
    hashed = cut.withColumn("hs", F.when(n > WINDOW, F.transform("ws", lambda w: F.xxhash64(w))))
    # Columns read inside a lambda are named twice at least: Spark would write a column that is
    # used once in place of its name, and compute it anew for every element.
    windows = hashed.withColumn("windows", F.when(F.size("hs") > WINDOW, F.array_sort(F.transform(
        F.sequence(F.lit(1), F.size("hs") - (WINDOW - 1)),
        lambda i: F.struct(F.xxhash64(F.slice("hs", i, WINDOW)).alias("h"), i.alias("i"))))))
    at = F.col("windows")
    size = F.size(at)
    twice = windows.withColumn("twice", F.array_sort(F.transform(
        F.filter(at, lambda w, k: ((k > 0) & (F.get(at, k - 1)["h"] == w["h"]))
                 | ((k < size - 1) & (F.get(at, k + 1)["h"] == w["h"]))),
        lambda w: w["i"])))
    # A window covers its words up to where the next one begins.
    covered = F.aggregate(
        F.transform("twice", lambda i, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(F.col("twice"), k + 1) - i, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return twice.select(
        "row", n.cast("long").alias("n_words"),
        F.length(F.array_join("ws", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
    )


def _share(part: str, whole: str) -> Column:
    share = F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))
    return F.log1p(100 * share)


def _transformed() -> list[Column]:
    mean_length = F.coalesce(F.try_divide(F.col("word_chars"), F.col("n_words")), F.lit(0.0))
    values = [F.log1p(mean_length), _share("n_symbols", "word_chars"),
              _share("n_dup_lines", "n_lines"), _share("n_repeat_words", "n_words")]
    return [F.round(v * UNIT).cast("long").alias(name) for name, v in zip(STATS, values)]


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution with the Cholesky factor `l`."""
    solved: list[Column] = []
    for i, name in enumerate(STATS):
        rest = F.col(name) / UNIT - F.col(f"c{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * solved[j]
        solved.append(rest / F.col(f"l{i}{i}"))
    return reduce(lambda a, b: a + b, [s * s for s in solved])


def _pairs():
    return [(i, j) for i in range(D) for j in range(i + 1)]


def _moments() -> list[Column]:
    sums = [F.sum(F.col(n).cast("decimal(20,0)")).alias(f"s{i}") for i, n in enumerate(STATS)]
    products = [F.sum((F.col(STATS[i]) * F.col(STATS[j])).cast("decimal(20,0)")).alias(f"p{i}{j}")
                for i, j in _pairs()]
    return [F.count("*").alias("m"), *sums, *products]


def _estimate(sums: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """Centre and Cholesky factor of the covariance from one row of moments per group."""
    m = F.col("m").cast("double")
    df = sums.select(*keys, "m", *[(F.col(f"s{i}").cast("double") / m / UNIT).alias(f"c{i}") for i in range(D)],
                     *[F.col(f"p{i}{j}").cast("double").alias(f"p{i}{j}") for i, j in _pairs()])
    cov = {}
    for i, j in _pairs():
        raw = F.col(f"p{i}{j}") / F.col("m") / (UNIT * UNIT) - F.col(f"c{i}") * F.col(f"c{j}")
        cov[i, j] = raw * factor + (FLOORS[i] ** 2 if i == j else 0.0)
    df = df.select(*keys, *[f"c{i}" for i in range(D)], *[v.alias(f"v{i}{j}") for (i, j), v in cov.items()])
    for i in range(D):
        for j in range(i + 1):
            rest = F.col(f"v{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            # The floors keep the diagonal positive.
            value = F.sqrt(F.greatest(rest, F.lit(FLOORS[i] ** 2 / 4))) if i == j else rest / F.col(f"l{j}{j}")
            df = df.withColumn(f"l{i}{j}", value)
    return df.select(*keys, *[f"c{i}" for i in range(D)], *[f"l{i}{j}" for i, j in _pairs()])


def _attached(rows: DataFrame, table: DataFrame, keys: list[str], few: bool) -> DataFrame:
    on = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(table[k]) for k in keys])
    side = F.broadcast(table) if few else table
    joined = rows.join(side, on)
    for k in keys:
        joined = joined.drop(table[k])
    return joined


def _medians(rows: DataFrame, keys: list[str]) -> DataFrame:
    """First estimate: medians and scaled median deviations of each statistic, from counts of values."""

    def median_of(values: DataFrame, name: str) -> DataFrame:
        counts = values.groupBy(*keys, "stat", "v").agg(F.sum("n").alias("n"))
        upto = Window.partitionBy(*keys, "stat").orderBy("v")
        whole = Window.partitionBy(*keys, "stat")
        return (
            counts.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(whole))
            .where("2 * upto >= all").groupBy(*keys, "stat").agg(F.min("v").alias(name))
        )

    long = rows.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(i).alias("stat"), F.col(n).alias("v")) for i, n in enumerate(STATS)])).alias("x"))
    counts = materialize(
        long.groupBy(*keys, "x").agg(F.count("*").alias("n"))
        .select(*keys, "x.stat", "x.v", "n"), "values")
    centre = materialize(median_of(counts, "centre"), "medians")
    on = [counts[k].eqNullSafe(centre[k]) for k in [*keys, "stat"]]
    off = counts.join(centre, reduce(lambda a, b: a & b, on)).select(
        *[counts[k] for k in [*keys, "stat"]], F.abs(F.col("v") - F.col("centre")).alias("v"), "n")
    spread = median_of(off, "spread")
    on = [spread[k].eqNullSafe(centre[k]) for k in [*keys, "stat"]]
    both = spread.join(centre, reduce(lambda a, b: a & b, on)).select(
        *[spread[k] for k in [*keys, "stat"]], "centre", "spread")
    cols = []
    for i in range(D):
        cols.append(F.max(F.when(F.col("stat") == i, F.col("centre") / UNIT)).alias(f"c{i}"))
        scaled = F.col("spread") / UNIT * 1.4826
        cols.append(F.max(F.when(F.col("stat") == i, F.sqrt(scaled * scaled + FLOORS[i] ** 2))).alias(f"l{i}{i}"))
    wide = both.groupBy(*keys).agg(*cols)
    return wide.select(*keys, *[f"c{i}" for i in range(D)],
                       *[(F.col(f"l{i}{j}") if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i, j in _pairs()])


def estimates(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, bool]:
    """Centre and spread of every group of `keys`, and whether the groups are few."""
    few = rows.select(*keys).distinct().count() <= BROADCAST_GROUPS
    present = materialize(_medians(rows, keys), "estimate")
    # A normal sample cut to its nearest share H has a smaller spread, by this factor.
    factor = H / chi2_cdf(chi2_quantile(H, D), D + 2)
    bin_of = F.when(F.col("d2") > 2.0 ** (LOWEST / PER_OCTAVE),
                    F.floor(F.log2("d2") * PER_OCTAVE)).otherwise(F.lit(LOWEST)).cast("int")
    for _ in range(STEPS):
        bins = (
            _attached(rows, present, keys, few).withColumn("d2", _distance()).withColumn("bin", bin_of)
            .groupBy(*keys, "bin").agg(*_moments())
        )
        upto = F.sum("m").over(Window.partitionBy(*keys).orderBy("bin"))
        whole = F.sum("m").over(Window.partitionBy(*keys))
        names = ["m", *[f"s{i}" for i in range(D)], *[f"p{i}{j}" for i, j in _pairs()]]
        nearest = (
            bins.withColumn("before", upto - F.col("m")).withColumn("all", whole)
            .where(F.col("before") < H * F.col("all"))
            .groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])
        )
        present = materialize(_estimate(nearest, keys, factor), "estimate")
    return present, few


def quality(docs: DataFrame, text: str = "text", by: tuple[str, ...] = ("lang", "source"),
            quantile: float = QUANTILE) -> DataFrame:
    """`row`, the counts of `statistics`, `base_failed`, `distance` (squared) and `kept`.

    A text fails the base rules with fewer than 20 words or over 30 % of its words in repeated
    windows; it is then not kept and has no distance. Estimates rest on the texts that pass.
    Null languages or sources are groups of their own; so is each small group (one text is its
    own centre and is kept). Null and empty texts fail the base rules. Equal rows get equal
    verdicts. An empty input gives no row. `n_words` and the others stand beside `row`, so input
    columns of the same names stay inside it.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    keys = [f"k{i}" for i in range(len(by))]
    marked = statistics(docs, text).withColumn("base_failed", failed).select(
        "*", *[F.col(f"row.`{b}`").alias(k) for b, k in zip(by, keys)], *_transformed())
    rows = materialize(marked, "statistics")
    present, few = estimates(rows.where("NOT base_failed").select(*keys, *STATS), keys)
    on = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(present[k]) for k in keys])
    judged = rows.join(F.broadcast(present) if few else present, on, "left")
    distance = F.when(~F.col("base_failed"), _distance())
    limit = chi2_quantile(quantile, D)
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    return judged.select("row", *counts, "base_failed", distance.alias("distance"),
                         F.coalesce(distance <= limit, F.lit(False)).alias("kept"))
