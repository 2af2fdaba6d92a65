"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Each document's statistics become a vector of smoothed, log-scaled shares.
Per group (language and source; language alone, then all documents, where a
group has too few distinct vectors) the centre and covariance are the MCD
estimates, and a document whose robust Mahalanobis distance exceeds the cutoff
is rejected.

The fit is a handful of passes over the table of vectors, each one map-side
aggregate:

* a concentration step needs the ``h`` vectors nearest to the current centre
  and their mean and covariance.  One pass sums the moments per group and
  distance bucket (1/16 of a power of two); a running count over a group's few
  hundred buckets then tells which of them make up ``h``.  So a group with a
  third of all rows is reduced to its buckets in every task, before the shuffle;
* two starts (the classical moments, and median with MAD) are concentrated
  side by side and the one with the smaller determinant is kept;
* a last, reweighted pass over the vectors within the 97.5 % distance follows,
  as is usual for MCD.

Equal vectors of a group count once in the fit, so copies don't narrow it.
Vectors are measured in units of what counts as a material difference, and one
such unit is added to each variance: a statistic that is the same for almost
all documents then rejects material differences only, and no covariance is
singular.  Cholesky factors and distances are plain column expressions.

Edge cases: a null or empty text has no words and fails the base rule; null
languages and sources are groups of their own; groups of fewer than
``min_group`` distinct vectors use the next coarser one, and with too few
documents overall all are kept; repeated rows get equal verdicts; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopline.llm.common import BLANKS, UPPER, drop, stored, table

WINDOW = 8
#: Statistic vectors: name, what counts as a material difference.
DIMENSIONS = {"v_length": 0.08, "v_symbols": 0.35, "v_capitals": 0.35, "v_lines": 0.6, "v_repeats": 0.6}
#: Weight (words, lines) of the usual value in the smoothed shares of short texts.
PRIOR = 30.0
SHARE_KEPT = 0.75
STEPS = 5
CUTOFF = 1e-4


def text_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and
    n_lines and n_capitals (lines with a word; capitals A to Z)."""
    body = F.coalesce(F.col(text), F.lit(""))
    spaced = F.translate(body, BLANKS[1:], " " * (len(BLANKS) - 1))
    rest = lambda chars: F.length(body) - F.length(F.translate(body, chars, ""))
    df = df.withColumns({
        "__words": F.array_remove(F.split(spaced, " "), ""),
        "__lines": F.filter(F.split(body, "\n"), lambda x: F.translate(x, BLANKS, "") != ""),
        "word_chars": F.length(F.translate(body, BLANKS, "")).cast("long"),
        "n_symbols": rest("#*$%&|<>").cast("long"),
        "n_capitals": rest(UPPER).cast("long"),
    })
    windows = F.size("__words") - (WINDOW - 1)
    df = df.withColumns({
        "n_words": F.size("__words").cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__hashes": F.when(windows > 0, F.transform(F.sequence(F.lit(1), windows), lambda i: F.xxhash64(F.slice("__words", i, WINDOW)))),
    })
    # A window that occurs twice has its hash twice; only then are the windows themselves compared.
    suspect = F.size("__hashes") > F.size(F.array_distinct("__hashes"))
    df = df.withColumn("n_repeat_words", F.when(suspect, _repeated(F.col("__words"), windows)).otherwise(F.lit(0)).cast("long"))
    return df.drop("__words", "__lines", "__hashes")


def _repeated(words: Column, windows: Column) -> Column:
    """Words within windows that occur twice or more, from the windows in sorted order."""
    numbered = F.sort_array(F.transform(F.sequence(F.lit(1), windows), lambda i: F.struct(
        F.concat_ws(" ", F.slice(words, i, WINDOW)).alias("w"), i.alias("at"))))
    # transform over a one-element array: `order` is computed once, not for each element.
    twice = F.transform(F.array(numbered), lambda order: F.filter(order, lambda x, k: (
        x["w"].eqNullSafe(F.get(order, k - 1)["w"]) | x["w"].eqNullSafe(F.get(order, k + 1)["w"]))))
    at = F.array_sort(F.transform(F.flatten(twice), lambda x: x["at"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(at, start, lambda seen, p: F.struct(
        (seen["n"] + p + WINDOW - F.greatest(seen["end"], p)).alias("n"), (p + WINDOW).alias("end")), lambda seen: seen["n"])


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def vectors(df: DataFrame) -> DataFrame:
    """Add the transformed statistics, in units of material differences."""
    share = lambda part, whole, usual: (F.col(part) + PRIOR * usual) / (F.col(whole) + PRIOR)
    raw = {
        "v_length": F.log(share("word_chars", "n_words", 5.0)),
        "v_symbols": F.log(share("n_symbols", "n_words", 0.0) + 0.05),
        "v_capitals": F.log(share("n_capitals", "n_words", 0.1) + 0.05),
        "v_lines": F.log(F.col("n_dup_lines") / (F.col("n_lines") + 5.0) + 0.05),
        "v_repeats": F.log(share("n_repeat_words", "n_words", 0.0) + 0.05),
    }
    return df.withColumns({k: F.round(v / DIMENSIONS[k], 6) for k, v in raw.items()})


# --- chi-square quantiles, needed once per plan --------------------------------

def chi2_cdf(x: float, p: int) -> float:
    a, x = p / 2, x / 2
    if x <= 0:
        return 0.0
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= x / n
        total += term
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a)))


def chi2_quantile(q: float, p: int) -> float:
    low, high = 0.0, 400.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, p) < q else (low, mid)
    return (low + high) / 2


def consistency(share: float, p: int) -> float:
    """Factor that makes the covariance of the nearest ``share`` of normal vectors consistent."""
    return share / chi2_cdf(chi2_quantile(share, p), p + 2)


# --- estimates as columns -------------------------------------------------------

def _moments(dims: list[str]) -> dict[str, Column]:
    out = {"s_n": F.count(F.lit(1))}
    for i, a in enumerate(dims):
        out[f"s_{i}"] = F.sum(a)
        for j in range(i + 1):
            out[f"s_{i}_{j}"] = F.sum(F.col(a) * F.col(dims[j]))
    return out


def _estimate(df: DataFrame, p: int, factor: float) -> DataFrame:
    """Centre m_i and lower Cholesky factor l_i_j of factor * covariance + 1, and its log determinant."""
    n = F.col("s_n")
    df = df.withColumns({f"m_{i}": F.col(f"s_{i}") / n for i in range(p)})
    cov = {(i, j): F.lit(factor) * (F.col(f"s_{i}_{j}") / n - F.col(f"m_{i}") * F.col(f"m_{j}")) + (1.0 if i == j else 0.0)
           for i in range(p) for j in range(i + 1)}
    return _cholesky(df, cov, p)


def _cholesky(df: DataFrame, cov: dict, p: int) -> DataFrame:
    df = df.withColumns({f"c_{i}_{j}": c for (i, j), c in cov.items()})
    for j in range(p):
        below = lambda i, j=j: sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
        # Rounding may take a variance below the unit that was added to it.
        df = df.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(F.col(f"c_{j}_{j}") - below(j), F.lit(1e-3))))
        if j + 1 < p:
            df = df.withColumns({f"l_{i}_{j}": (F.col(f"c_{i}_{j}") - below(i)) / F.col(f"l_{j}_{j}") for i in range(j + 1, p)})
    logdet = sum((F.log(f"l_{j}_{j}") for j in range(p)), F.lit(0.0))
    return df.withColumn("logdet", logdet)


def _estimate_columns(p: int) -> list[str]:
    return [f"m_{i}" for i in range(p)] + [f"l_{i}_{j}" for i in range(p) for j in range(i + 1)] + ["logdet"]


def _with_distance(df: DataFrame, dims: list[str]) -> DataFrame:
    """Add d2, the squared Mahalanobis distance, by forward substitution."""
    for i, a in enumerate(dims):
        before = sum((F.col(f"l_{i}_{k}") * F.col(f"z_{k}") for k in range(i)), F.lit(0.0))
        df = df.withColumn(f"z_{i}", (F.col(a) - F.col(f"m_{i}") - before) / F.col(f"l_{i}_{i}"))
    return df.withColumn("d2", sum((F.col(f"z_{i}") * F.col(f"z_{i}") for i in range(len(dims))), F.lit(0.0)))


def _bucket(d2: Column) -> Column:
    return F.floor(16 * F.log2(d2 + 1e-3)).cast("int")


def fit(points: DataFrame, key: str, dims: list[str], share: float = SHARE_KEPT, steps: int = STEPS) -> DataFrame:
    """MCD estimates per ``key`` from distinct points: n_points and the estimate's columns."""
    p = len(dims)
    cols = _estimate_columns(p)
    size = points.groupBy(key).agg(F.count(F.lit(1)).alias("n_points"), *[v.alias(k) for k, v in _moments(dims).items()],
                                   *[F.percentile_approx(a, 0.5, 10_000).alias(f"q_{a}") for a in dims])
    size = stored(size)
    centre = points.join(size.select(key, *[f"q_{a}" for a in dims]), key)
    spread = centre.groupBy(key).agg(*[F.percentile_approx(F.abs(F.col(a) - F.col(f"q_{a}")), 0.5, 10_000).alias(f"w_{a}") for a in dims])
    robust = size.join(spread, key).select(key, F.lit(1).alias("start"), *[F.col(f"q_{a}").alias(f"m_{i}") for i, a in enumerate(dims)],
                                           *[F.col(f"w_{a}") for a in dims])
    diagonal = {(i, j): (F.pow(1.4826 * F.col(f"w_{dims[i]}"), 2) + 1.0) if i == j else F.lit(0.0) for i in range(p) for j in range(i + 1)}
    starts = (_estimate(size, p, 1.0).select(key, F.lit(0).alias("start"), *cols)
              .unionByName(_cholesky(robust, diagonal, p).select(key, "start", *cols)))
    now, before = stored(starts), None
    half = size.select(key, F.ceil(share * F.col("n_points")).alias("__h"))
    order = Window.partitionBy(key, "start").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    names = list(_moments(dims))
    for _ in range(steps):
        near = _with_distance(points.join(now, key), dims).withColumn("b", _bucket(F.col("d2")))
        sums = near.groupBy(key, "start", "b").agg(*[v.alias(k) for k, v in _moments(dims).items()])
        sums = sums.join(half, key).withColumn("__before", F.coalesce(F.sum("s_n").over(order), F.lit(0)))
        taken = sums.filter(F.col("__before") < F.col("__h")).groupBy(key, "start").agg(*[F.sum(k).alias(k) for k in names])
        drop(before)
        before, now = now, stored(_estimate(taken, p, consistency(share, p)).select(key, "start", *cols))
    best = now.groupBy(key).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct("logdet", "start")).alias("e")).select(key, "e.*")
    weighted = _with_distance(points.join(best, key), dims).filter(F.col("d2") <= chi2_quantile(0.975, p))
    final = weighted.groupBy(key).agg(*[v.alias(k) for k, v in _moments(dims).items()])
    final = _estimate(final, p, consistency(0.975, p)).select(key, *cols)
    return stored(size.select(key, "n_points").join(final, key))


def _keys(lang: str, source: str) -> list[Column]:
    """Group keys from fine to coarse; nulls differ from every string."""
    text = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    return [F.concat_ws("\x1f", F.lit("2"), text(lang), text(source)), F.concat_ws("\x1f", F.lit("1"), text(lang)), F.lit("0")]


def outliers(df: DataFrame, dims: list[str], lang: str = "lang", source: str = "source", min_group: int = 100,
             cutoff: float = CUTOFF) -> DataFrame:
    """Add ``distance`` (squared, null where no group is large enough) and
    ``outlier``; ``cutoff`` is the share of normal vectors beyond it.

    ``df`` should be a stored table: it is read once to fit and once to judge.
    """
    keys = _keys(lang, source)
    used = df.withColumn("__k", F.explode(F.array(*keys)))
    points = stored(used.groupBy("__k", *dims).agg(F.count(F.lit(1)).alias("__copies")).drop("__copies"))
    fitted = fit(points, "__k", dims).filter(F.col("n_points") >= min_group)
    levels = df
    for i, k in enumerate(keys):
        here = fitted.select(F.col("__k").alias(f"__k{i}"), F.lit(True).alias(f"__has{i}"))
        levels = levels.withColumn(f"__k{i}", k).join(here, f"__k{i}", "left")
    chosen = F.coalesce(*[F.when(F.col(f"__has{i}"), F.col(f"__k{i}")) for i in range(len(keys))])
    judged = levels.withColumn("__k", chosen).drop(*[f"__{n}{i}" for n in ("k", "has") for i in range(len(keys))])
    judged = _with_distance(judged.join(fitted, "__k", "left"), dims)
    out = F.coalesce(F.col("d2") > chi2_quantile(1 - cutoff, len(dims)), F.lit(False))
    return judged.select(*df.columns, F.col("d2").alias("distance"), out.alias("outlier"))


def op1_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base statistics and verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    rows = stored(vectors(text_statistics(docs)).drop("text"))
    judged = outliers(rows, list(DIMENSIONS)).withColumn("base_failed", base_failed())
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & ~F.col("outlier")).alias("kept"), "distance")
