"""Exact top-k inner products by MaxScore over sharded postings.

Vectors are rows of integer weights; a query's terms are its components, and
the posting list of a term holds every row's weight for it.  Per shard, a
term's bound is the most it can add to any row's score.  For each query the
terms are ordered by their bounds: the least of them, whose bounds together
are well under the k-th best score so far, are non-essential.  The essential lists
are traversed for all rows, for many queries in one product; then the others are
probed, one by one from the largest bound, for the rows that are still
competitive.  A shard whose bounds can't lift a row over the k-th best score is
left out.  The k best of each shard meet in a merge by query.

Shards are packed rows of at most PACK vectors, in the least integer type that
holds their weights; query blocks likewise.  Both are dealt over a grid of
cells: shards over its columns, blocks over its rows, each row copied along
the other side, so a block meets each shard in one cell.  A cell is one
partition of a shuffle, sorted so that its blocks come first; its task holds
those and streams the shards past them.  Nothing is broadcast or passes through
the driver, whatever size Spark takes a side for, and the copies grow with the
tasks, not with the shards.  A task keeps a block's k-th best scores from one
shard to the next (they remain true lower limits).

Edge cases: vectors that are null, empty, or hold a null or non-finite
component take no part; a null id takes no part; rows with equal ids are
separate candidates, but never of a query with that id, and separate queries; vectors of unequal
length are compared as if padded with zeros; ties go to the smaller id, equal
rows get successive ranks; fewer than k candidates are all returned; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopline.llm.common import by_stream, stored, table

#: Vectors in a shard or a query block at most.
PACK = 8192
#: Weights in one at most: very wide vectors make packs of fewer.
PACK_WEIGHTS = 1 << 21
#: Weights of the query blocks that a cell holds, about.
HELD_WEIGHTS = 1 << 22
#: Rows of a shard that are scored outright to get a first k-th best score.
SEED_ROWS = 256
#: Scores held at a time: so many queries of a block meet a shard in one product.
ROUND = 1 << 20
#: Lists are non-essential once their bounds together are under this share of the k-th best score.
SHARE = 0.1


def quantise(vectors: DataFrame, vec_id: str, vector: str, scale: float = 256.0) -> DataFrame:
    """(id, w): floor(scale * x) of the vectors that take part."""
    sound = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(sound, F.lit(False)))
    return rows.select(F.col(vec_id).cast("long").alias("id"), F.transform(F.col(vector), lambda x: F.floor(scale * x.cast("double"))).alias("w"))


def pack(rows: DataFrame, size: int = PACK) -> DataFrame:
    """Packed rows (n, width, ids, weights) of at most ``size`` vectors each, of one width.
    The weights' integer type follows from their length (:func:`_matrix`)."""

    def out(ids: list[int], rows: list[list[int]], width: int) -> dict:
        weights = np.array(rows, "<i8").reshape(len(ids), width)
        least = next(t for t in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(t).min <= weights.min(initial=0) and weights.max(initial=0) <= np.iinfo(t).max)
        return {"n": [len(ids)], "width": [width], "ids": [np.array(ids, "<i8").tobytes()], "weights": [weights.astype(least).tobytes()]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for i, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, weights = held.setdefault(len(w), ([], []))
                ids.append(i)
                weights.append(w)
                if len(ids) >= min(size, max(1, PACK_WEIGHTS // max(1, len(w)))):
                    yield out(*held.pop(len(w)), len(w))
        for width, (ids, weights) in held.items():
            yield out(ids, weights, width)

    return by_stream(rows, [F.col("id"), F.col("w")], "n int, width int, ids binary, weights binary", run)


def _matrix(weights: bytes, n: int, width: int) -> np.ndarray:
    return np.frombuffer(weights, f"<i{len(weights) // (n * width) if n * width else 8}").reshape(n, width)


class Shard:
    """Posting lists of one shard: a row of weights per term, in the order of ids."""

    def __init__(self, ids: bytes, weights: bytes, n: int, width: int):
        self.ids = np.frombuffer(ids, "<i8")
        order = np.argsort(self.ids, kind="stable")
        self.ids = self.ids[order]
        lists = _matrix(weights, n, width)[order].T
        # Exact in doubles as long as every sum stays under 2**53; else Python integers.
        self.limit = float(np.abs(lists.astype(float)).max(initial=0))
        self.whole = np.ascontiguousarray(lists)
        self.lists = self.whole.astype(np.float32 if self.limit < 2**24 else float)
        self.most, self.least = self.lists.max(1, initial=-np.inf).astype(float), self.lists.min(1, initial=np.inf).astype(float)

    def scores(self, query: np.ndarray, k: int, theta: float, skip: int) -> tuple[np.ndarray, np.ndarray, float]:
        """Rows that may be among the k best of one query (scores exact), and the new k-th best score."""
        limits = np.array([theta])
        _, rows, total = self.best(query[None, :], k, limits, np.array([skip]))
        return rows, total, limits[0]

    def best(self, queries: np.ndarray, k: int, theta: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best rows of each query that may be among its k best of all shards:
        places in ``queries``, rows and exact scores.  ``theta``, the k-th best scores so far, rises."""
        most = np.abs(queries.astype(float)).max(1, initial=0)
        bound = self.limit * most * max(1, len(self.lists))
        step = max(1, ROUND // max(1, len(self.ids)))
        found = []
        # Sums under 2**24 are exact in single precision, under 2**53 in double, else taken in Python integers.
        for kind, of in ((np.float32, bound < 2.0**24), (float, (bound >= 2.0**24) & (bound < 2.0**53))):
            places = np.flatnonzero(of)
            for i in range(0, len(places), step):
                at = places[i : i + step]
                limits = theta[at]
                q, rows, total = self._round(queries[at], k, limits, skip[at], kind)
                theta[at] = limits
                found.append((at[q], rows, total.astype("<i8")))
        for i in np.flatnonzero(bound >= 2.0**53):
            width = min(len(self.whole), queries.shape[1])
            exact = (self.whole[:width].T.astype(object) * queries[i][None, :width].astype(object)).sum(1)
            rows = np.flatnonzero(self.ids != skip[i])
            rows = rows[np.array(sorted(range(len(rows)), key=lambda r: (-exact[rows[r]], self.ids[rows[r]]))[:k], int)]
            found.append((np.full(len(rows), i), rows, exact[rows]))
        places, rows, total = zip(*found, strict=True) if found else ([np.zeros(0, int)],) * 3
        return np.concatenate(places), np.concatenate(rows), np.concatenate(total)

    def _round(self, queries: np.ndarray, k: int, theta: np.ndarray, skip: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lists, terms_n, n = self.lists.astype(kind, copy=False), len(self.lists), len(self.ids)
        q = np.zeros((len(queries), terms_n))
        width = min(terms_n, queries.shape[1])
        q[:, :width] = queries[:, :width]
        # ids are in order: rows that are not a query's candidates
        own = np.searchsorted(self.ids, skip, "left"), np.searchsorted(self.ids, skip, "right")
        new = np.flatnonzero(np.isneginf(theta))
        if len(new) and min(n, SEED_ROWS) >= k:
            seed = q[new].astype(kind) @ lists[:, :SEED_ROWS]
            for i in np.flatnonzero((own[1] > own[0])[new]):
                seed[i, own[0][new[i]] : own[1][new[i]]] = -np.inf
            theta[new] = np.partition(seed, seed.shape[1] - k, 1)[:, seed.shape[1] - k]
        bound = np.where(q > 0, q * self.most, q * self.least)
        terms = np.argsort(-bound, 1, kind="stable")
        # rest[:, i]: the most that the terms from the i-th on can add
        rest = np.zeros((len(q), terms_n + 1))
        rest[:, :terms_n] = np.cumsum(np.take_along_axis(bound, terms, 1)[:, ::-1], 1)[:, ::-1]
        # Whole lists cost little in one product, so they are traversed until the others could add but a share of the k-th best score.
        below = rest < np.where(theta > 0, theta * SHARE, theta)[:, None]
        essential = np.where(rest[:, 0] < theta, 0, np.where(below.any(1), below.argmax(1), terms_n))
        live = np.flatnonzero(rest[:, 0] >= theta)
        first = np.zeros((len(live), terms_n))
        np.put_along_axis(first, terms[live], np.take_along_axis(q[live], terms[live], 1) * (np.arange(terms_n) < essential[live, None]), 1)
        total = first.astype(kind) @ lists
        stay = total >= (theta - rest[np.arange(len(q)), essential])[live, None].astype(kind)
        for i in np.flatnonzero((own[1] > own[0])[live]):
            stay[i, own[0][live[i]] : own[1][live[i]]] = False
        at, rows = np.divmod(np.flatnonzero(stay), n)
        total, at = total[at, rows].astype(float), live[at]
        for i in range(int(essential[live].min(initial=terms_n)), terms_n):
            if not len(at):
                break
            t = terms[at, i]
            total = total + np.where(essential[at] <= i, q[at, t] * lists[t, rows], 0.0)
            stay = total + rest[at, np.maximum(i + 1, essential[at])] >= theta[at]
            if not stay.all():
                at, rows, total = at[stay], rows[stay], total[stay]
        order = np.lexsort((rows, -total, at))  # rows are in the order of ids
        at, rows, total = at[order], rows[order], total[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at, "left")
        kth = rank == k - 1
        theta[at[kth]] = np.maximum(theta[at[kth]], total[kth])
        top = rank < k
        return at[top], rows[top], total[top]


def grid(shards: DataFrame, blocks: DataFrame, tasks: int) -> tuple[DataFrame, int]:
    """The rows of both (with a number ``at`` each) in the cells where they meet, and the number of cells.

    About ``tasks`` cells, more if the blocks of a cell would be over HELD_WEIGHTS, in the shape that copies least.
    """
    low = (1 << 33) - 1
    rows = F.count(F.lit(1)).alias("rows")
    weights = F.coalesce(F.sum(F.col("n").cast("long") * (F.col("width") + 1)), F.lit(0)).alias("weights")
    stride = (F.coalesce(F.max(F.col("at").bitwiseAND(F.lit(low))), F.lit(0)) + 1).alias("stride")
    s, b = (t.agg(rows, weights, stride).first() for t in (shards, blocks))
    down = max(1, min(b.rows, max(math.ceil(b.weights / HELD_WEIGHTS), round(math.sqrt(tasks * b.weights / max(1, s.weights))))))
    across = max(1, min(s.rows, math.ceil(tasks / down)))

    def dealt(stride: int, parts: int) -> Column:
        # Tasks hold about the same number of packed rows, so these numbers have few gaps.
        return F.pmod(F.shiftright("at", 33) * stride + F.col("at").bitwiseAND(F.lit(low)), F.lit(parts)).cast("int")

    def copied(t: DataFrame, is_shard: bool, cell: Column) -> DataFrame:
        return t.select("at", "n", "width", "ids", "weights", F.lit(is_shard).alias("is_shard"), cell.alias("cell"))

    return copied(shards, True, F.explode(F.transform(F.sequence(F.lit(0), F.lit(down - 1)), lambda y: y * across + dealt(s.stride, across)))).unionByName(
        copied(blocks, False, F.explode(F.transform(F.sequence(F.lit(0), F.lit(across - 1)), lambda x: dealt(b.stride, down) * across + x)))), across * down


def search(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best other vectors, of
    frames (id, w); scores descend, ties go to the smaller id."""
    # Numbered before they are stored: equal blocks stay separate queries.
    shards, blocks = (stored(pack(rows).withColumn("at", F.monotonically_increasing_id())) for rows in (vectors, queries))
    cells, tasks = grid(shards, blocks, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        cell, held = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["cell"] != cell:
                    cell, held = r["cell"], []
                if not r["is_shard"]:
                    held.append((r["at"], np.frombuffer(r["ids"], "<i8"), _matrix(r["weights"], r["n"], r["width"]), np.full(r["n"], -np.inf)))
                    continue
                shard = Shard(r["ids"], r["weights"], r["n"], r["width"])
                for block, qids, weights, theta in held:
                    places, rows, total = shard.best(weights, k, theta, qids)
                    yield {"query_id": qids[places], "vec_id": shard.ids[rows], "score": total, "block": np.full(len(places), block), "place": places.astype("<i4")}

    dealt = cells.repartitionById(tasks, F.col("cell")).sortWithinPartitions("cell", "is_shard")
    found = by_stream(dealt, [F.col(c) for c in ("cell", "is_shard", "at", "n", "width", "ids", "weights")],
                      "query_id long, vec_id long, score long, block long, place int", run)
    order = Window.partitionBy("query_id", "block", "place").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op5_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best other vectors of every vector whose id is divisible by 50."""
    rows = quantise(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return search(rows, rows.filter(F.col("id") % 50 == 0), 5)


ORACLE = """
WITH v AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.id AS query_id, c.id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.id % 50 = 0 AND c.id <> q.id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
