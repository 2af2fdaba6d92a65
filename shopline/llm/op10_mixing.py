"""Mixing sources to target weights by iterative proportional fitting.

The tokens of the corpus form a table of cells (source x language x topic).
Raking scales the cells until their sums meet the target share of every
source, every language and every topic; a cell's calibrated probability is the
part of its tokens that the mixture wants.  Documents are then drawn one by one
with their cell's probability.

Only the first aggregate (map-side sums) and the last join see documents; the
sweeps run on the cells, until no cell's weight changes any more: on the driver
for up to ``HELD`` cells, as Spark steps for more.  No cell can give more tokens than it has: after each
sweep, cells are cut to that, which the next sweep evens out over the others.
A draw depends on the seed and the document's id alone, so a task that is run
again draws the same.

Targets are frames (value, share) for ``source``, ``lang`` and ``topic``.  The
default tempers the corpus: a margin's shares to the power ``alpha``, so that
large sources, languages and topics lose weight to small ones.

Edge cases: null sources, languages and topics are values of their own; a
document without words has probability 0; values without a target share, or
with share 0, get probability 0; targets that the cells can't meet leave the
nearest fit after ``max_sweeps`` (see ``deviation``); rows with equal ids are
drawn or not together if in one cell; an empty table gives an empty result;
extra columns are kept unless they have an output's name.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopline.llm.common import drop, stored, table, word_array

MARGINS = ["source", "lang", "topic"]
ALPHA, KEEP, SEED = 0.8, 0.75, 17
TOLERANCE, SWEEPS_A_STEP, MAX_SWEEPS = 1e-6, 4, 10_000
#: Cells that the driver takes to fit them there; more are swept by Spark.
HELD = 1 << 16


def n_words(text: str) -> Column:
    return F.size(word_array(F.col(text))).cast("long")


def token_cells(docs: DataFrame, tokens: str = "n_tokens") -> DataFrame:
    """(source, lang, topic, tokens) of the cells that have tokens."""
    return docs.groupBy(*MARGINS).agg(F.sum(tokens).alias("tokens")).filter("tokens > 0")


def tempered(cells: DataFrame, margin: str, alpha: float = ALPHA) -> DataFrame:
    """(value, share): the margin's shares to the power alpha, summing to 1."""
    total = cells.groupBy(F.col(margin).alias("value")).agg(F.sum("tokens").alias("t"))
    part = F.pow(F.col("t").cast("double"), F.lit(alpha))
    return total.select("value", (part / F.sum(part).over(Window.partitionBy(F.lit(0)))).alias("share"))


def _fitted(rows: list) -> list[float]:
    """The weights of the cells after sweeps to convergence, here."""
    weight, most = (np.array([r[c] for r in rows], float) for c in ("weight", "most"))
    margins = []
    for m in MARGINS:
        codes: dict[str, int] = {}
        at = np.array([codes.setdefault(repr(r[m]), len(codes)) for r in rows], np.int64)
        margins.append((at, np.array([r[f"to_{m}"] for r in rows], float)))
    for _ in range(MAX_SWEEPS if rows else 0):
        was = weight
        for at, to in margins:
            have = np.bincount(at, weight)[at]
            weight = np.divide(weight * to, have, out=np.zeros_like(weight), where=have > 0)
        weight = np.minimum(weight, most)
        live = was > 0
        if (np.abs(weight - was)[live] < TOLERANCE * was[live]).all():
            break
    return weight.tolist()


def _swept(now: DataFrame) -> DataFrame:
    """As :func:`_fitted`, by Spark."""
    columns = now.columns
    for _ in range(0, MAX_SWEEPS, SWEEPS_A_STEP):
        step = now.select(*columns)
        for _ in range(SWEEPS_A_STEP):
            step = step.withColumn("was", F.col("weight"))
            for m in MARGINS:
                have = F.sum("weight").over(Window.partitionBy(m))
                step = step.withColumn("weight", F.when(have > 0, F.col("weight") * F.col(f"to_{m}") / have).otherwise(0.0))
            step = step.withColumn("weight", F.least("weight", "most"))
        before, now = now, stored(step)
        drop(before)
        change = now.filter("was > 0").agg(F.max(F.abs(F.col("weight") - F.col("was")) / F.col("was"))).first()[0]
        if change is None or change < TOLERANCE:
            break
    return now.select(*columns)


def rake(cells: DataFrame, targets: dict[str, DataFrame], keep: float = KEEP) -> DataFrame:
    """Cells with weight (calibrated share of all tokens) and probability.

    The driver sees up to HELD cells, or else the largest relative change of a
    cell's weight in a sweep, and the total.
    """
    total = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    rows = cells
    for m in MARGINS:
        want = targets[m].select(F.col("value").alias("__v"), F.col("share").alias(f"to_{m}"))
        rows = rows.join(want, rows[m].eqNullSafe(want["__v"]), "left").drop("__v")
    rows = rows.withColumns({f"to_{m}": F.coalesce(f"to_{m}", F.lit(0.0)) for m in MARGINS})
    rows = rows.withColumns({"weight": F.col("tokens") / float(total or 1), "most": F.col("tokens") / (keep * float(total or 1))})
    now = stored(rows)
    held = now.limit(HELD + 1).collect()
    if len(held) <= HELD:
        held.sort(key=lambda r: [repr(r[m]) for m in MARGINS])
        found = [(*[r[c] for c in cells.columns], w, *[r[f"to_{m}"] for m in MARGINS], r.most) for r, w in zip(held, _fitted(held), strict=True)]
        order = [*cells.columns, "weight", *[f"to_{m}" for m in MARGINS], "most"]
        fitted = stored(cells.sparkSession.createDataFrame(found, now.select(*order).schema).select(*now.columns))
        drop(now)
        now = fitted
    else:
        now = _swept(now)
    return now.withColumn("probability", F.least(F.lit(1.0), keep * float(total or 1) * F.col("weight") / F.col("tokens")))


def deviation(cells: DataFrame, margin: str) -> DataFrame:
    """(value, weight, target) of a margin after raking."""
    return cells.groupBy(F.col(margin).alias("value")).agg(F.sum("weight").alias("weight"), F.first(f"to_{margin}").alias("target"))


def draw(doc_id: Column, seed: int = SEED) -> Column:
    """Uniform in [0, 1), by hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id), 11) / float(1 << 53)


def with_probabilities(docs: DataFrame, cells: DataFrame, doc_id: str = "doc_id", tokens: str = "n_tokens", seed: int = SEED) -> DataFrame:
    """Add probability and sampled.  The cells are a small stored table; Spark sends
    it to the tasks if its size allows, and else joins and splits what is skewed."""
    own = cells.select(*[F.col(m).alias(f"__{m}") for m in MARGINS], F.col("probability").alias("__p"))
    rows = docs.drop("probability", "sampled")
    rows = rows.join(own, [rows[m].eqNullSafe(own[f"__{m}"]) for m in MARGINS], "left")
    p = F.when(F.col(tokens) > 0, F.coalesce("__p", F.lit(0.0))).otherwise(0.0)
    rows = rows.withColumn("probability", p).withColumn("sampled", draw(F.col(doc_id), seed) < F.col("probability"))
    return rows.drop("__p", *[f"__{m}" for m in MARGINS])


def calibrated_cells(docs: DataFrame, tokens: str = "n_tokens", targets: dict[str, DataFrame] | None = None,
                     alpha: float = ALPHA, keep: float = KEEP) -> DataFrame:
    """Raked cells of documents that have source, lang, topic and a token count."""
    cells = stored(token_cells(docs, tokens))
    return stored(rake(cells, {m: (targets or {}).get(m) or tempered(cells, m, alpha) for m in MARGINS}, keep))


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(topic_of, topic): the label of a document's embedding, where there is one."""
    rows = table(spark, sf_dir, "embeddings").filter("vec_id is not null")
    return rows.groupBy(F.col("vec_id").alias("topic_of")).agg(F.min("label").cast("string").alias("topic"))


def with_topic(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Add topic (null where none is known)."""
    docs = docs.drop("topic", "topic_of")
    return docs.join(known, docs[doc_id] == known["topic_of"], "left").drop("topic_of")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's cell, calibrated probability and draw."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", n_words("text").alias("n_tokens"))
    rows = stored(with_topic(docs, topics(spark, sf_dir)))
    return with_probabilities(rows, calibrated_cells(rows)).select("doc_id", *MARGINS, "n_tokens", "probability", "sampled")
