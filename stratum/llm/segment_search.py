"""Exact top-k search by inner product with multi-resolution segment statistics.

Vectors are cut into 1, 2, 4, ... equal segments.  With a segment's mean ``m``
and deviation ``s`` (population, length ``w``), Cauchy-Schwarz bounds the part
of an inner product that falls into it by ``w * (mx * my + sx * sy)``; summed
over segments this bounds the whole (equivalently, it bounds the distance
``|x|^2 + |y|^2 - 2 x.y`` from below), ever tighter with more segments, up to
half as many as components.  A task walks its candidates in blocks.  Of a block
the most promising ones, by the coarse bound, are multiplied first, which raises
the queries' k-th best; then, from coarse to fine, a level's bounds drop the
pairs of query and candidate that are below it; exact integer products are made
for the pairs that are left.  Bounds keep a small margin for rounding, so no
result is lost.

Queries are dealt into passes of at most ``pass_queries``; a pass broadcasts
its queries (bounded), scans all candidates once and is written, so that one
pass's queries are held at a time.  Tasks return their k best per query, and an
aggregate merges them.

Components become ``floor(256 * x)``, ``x`` as double, of any finite size:
products that doubles would round are made of longs, and those that may not
fit a long of Python integers.  A result whose score does not fit a long is an
error.  Defined cases: vectors that are null, or hold null or non-finite
components take no part; an empty vector's products are 0; vectors
meet only vectors of their own length; a null ``vec_id`` takes no part; rows
with the query's ``vec_id`` are no candidates of it; repeated rows of a query
are one query (different vectors under one id share one list), repeated
candidate rows each count; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import table, written

#: Components under this are searched apart from larger ones.
LIMIT = 1 << 24
#: Squares of larger components could leave the range of a double.
BOUNDED = 2.0 ** 400


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, v: array of doubles) of the vectors that take part; ``v`` is
    ``floor(256 * x) / 256``, which a double holds for every finite ``x``."""
    whole = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    sound = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return whole.where(sound).select("vec_id", F.transform("e", lambda x: F.when(
        F.abs(x) < 2.0 ** 45, F.floor(x * 256).cast("double") / 256).otherwise(x)).alias("v"))


def matrices(ids: pa.Array, vectors: pa.Array, rows: int = 2048):
    """(ids, matrix of whole numbers) blocks of equal vector length and like
    size, ids ascending."""
    ids = ids.to_numpy(zero_copy_only=False)
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else np.empty(0, np.int64)
    for size in np.unique(lengths):
        same = np.flatnonzero(lengths == size)
        same = same[np.argsort(ids[same], kind="stable")]
        high = np.zeros(len(same))
        for lo in range(0, len(same), rows):
            high[lo:lo + rows] = np.abs(flat[starts[same[lo:lo + rows], None] + np.arange(size)]).max(axis=1, initial=0)
        tier = np.digitize(high, [LIMIT / 256, 2.0 ** 1015])
        for t in np.unique(tier):
            own = same[tier == t]
            for lo in range(0, len(own), rows):
                at = own[lo:lo + rows]
                # 256 times the largest doubles is a long double only
                x = flat[starts[at, None] + np.arange(size)].astype(np.longdouble if t == 2 else np.float64)
                yield ids[at], x * 256


def highest(x: np.ndarray) -> float:
    return max(np.abs(x).max(initial=0), 1)


def products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of rows, exact wherever they fit a long; others are some
    number beyond the longs, of the right sign."""
    high_x, high_c, dims = highest(x), highest(c), max(x.shape[1], 1)
    if np.longdouble(high_x) * high_c * dims < 2.0 ** 53:
        return x @ c.T
    if np.longdouble(high_x) * high_c * dims < 2.0 ** 63:  # doubles would round
        return (x.astype(np.int64) @ c.T.astype(np.int64)).astype(np.longdouble)
    with np.errstate(over="ignore", invalid="ignore"):
        near = x @ c.T
        slack = (np.abs(x) @ np.abs(c).T) * (dims * 2.0 ** -50)
        score = near.astype(np.longdouble)
        unsure = ~(np.abs(near) - slack > 2.0 ** 64)
        if max(high_x, high_c) < 2.0 ** 63:
            # longs wrap around, so a sum that fits is right
            fits = np.abs(near) + slack < 2.0 ** 62
            score[fits] = (x.astype(np.int64) @ c.T.astype(np.int64))[fits]
            unsure &= ~fits
    whole: dict[tuple[int, int], list[int]] = {}

    def numbers(side: int, row: int) -> list[int]:
        if (side, row) not in whole:
            whole[side, row] = [int(v) for v in (x, c)[side][row]]
        return whole[side, row]
    for q, r in np.argwhere(unsure).tolist():
        exact = sum(a * b for a, b in zip(numbers(0, q), numbers(1, r)))
        score[q, r] = np.longdouble(max(min(exact, 1 << 64), -(1 << 64)))
    # an overflow to infinity is still a candidate, and too large
    return np.clip(score, -np.longdouble(2) ** 64, np.longdouble(2) ** 64)


class Resolution:
    """Segment means and deviations of vectors, scaled by the root of the
    segment's length: inner products of rows are the bounds."""

    def __init__(self, x: np.ndarray, segments: int):
        edges = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
        width = np.diff(edges).astype(np.float64)
        sums = np.add.reduceat(x, edges[:-1], axis=1)
        mean = sums / width
        # squares of the differences: those of large components would cancel out
        rest = x - np.repeat(mean, np.diff(edges), axis=1)
        spread = np.sqrt(np.add.reduceat(rest * rest, edges[:-1], axis=1) / width)
        self.rows = np.concatenate([mean, spread], axis=1) * np.sqrt(np.concatenate([width, width]))


def levels_for(dims: int) -> list[int]:
    """Numbers of segments, coarse to fine: 1, 4, 16, ..., half the components."""
    out, s = [], 1
    while s < dims // 2:
        out.append(s)
        s *= 4
    return out + [dims // 2] if dims >= 2 else out


#: Candidates of a block that are multiplied before any bound is asked.
FIRST = 128
#: Share of a block's pairs up to which they are multiplied one by one.
SPARSE = 0.1


class Best:
    """The k best (score, vec_id) so far of each query of one length.  ``offered``
    and ``multiplied`` count pairs: all, and those no bound has dropped."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int):
        self.ids, self.x, self.k = ids, x, k
        self.bounded = highest(x) < BOUNDED
        self.levels = [(s, Resolution(x, s).rows) for s in levels_for(x.shape[1])] if self.bounded else []
        self.norm = np.sqrt((x * x).sum(axis=1)) if self.bounded else None
        self.score = np.full((len(ids), k), -np.inf, np.longdouble)
        self.vec = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.offered = self.multiplied = 0

    def meet(self, ids: np.ndarray, c: np.ndarray) -> None:
        """Offer candidates (ids ascending)."""
        self.offered += len(self.ids) * len(ids)
        if not (self.bounded and self.levels and highest(c) < BOUNDED):
            self._multiply(ids, c, None)
            return
        coarse = (self.levels[0][1] @ Resolution(c, self.levels[0][0]).rows.T).max(axis=0)
        first = np.zeros(len(ids), bool)
        first[np.argsort(-coarse, kind="stable")[:FIRST]] = True
        self._multiply(ids[first], c[first], None)
        ids, c = ids[~first], c[~first]
        edge = self.score[:, -1].astype(np.float64)
        wanted = np.ones((len(self.ids), len(ids)), bool)
        for segments, mine in self.levels:
            if not len(ids):
                return
            bound = mine @ Resolution(c, segments).rows.T
            bound += 1e-9 * self.norm[:, None] * np.sqrt((c * c).sum(axis=1)) + 1
            # the edge as a double may have been rounded up
            wanted &= bound >= edge[:, None] - np.abs(edge[:, None]) * 2.0 ** -50
            some = wanted.any(axis=0)
            ids, c, wanted = ids[some], c[some], wanted[:, some]
        if len(ids):
            self._multiply(ids, c, wanted)

    def _multiply(self, ids: np.ndarray, c: np.ndarray, wanted: np.ndarray | None) -> None:
        """Exact products of the wanted pairs (None: all), and the new k best."""
        n = len(self.ids) * len(ids) if wanted is None else int(wanted.sum())
        self.multiplied += n
        if not n:
            return
        small = max(highest(self.x), 1) * max(highest(c), 1) * max(c.shape[1], 1) < 2.0 ** 53
        if wanted is not None and small and n <= SPARSE * wanted.size:
            q, r = np.nonzero(wanted)
            score = np.full(wanted.shape, -np.inf, np.longdouble)
            for lo in range(0, n, 1 << 16):
                i, j = q[lo:lo + (1 << 16)], r[lo:lo + (1 << 16)]
                score[i, j] = np.einsum("ij,ij->i", self.x[i], c[j])
        else:
            score = products(self.x, c)
            if wanted is not None:
                score = np.where(wanted, score, -np.inf)
        score = np.where(self.ids[:, None] == ids[None, :], -np.inf, score)
        edge = self.score[:, -1]
        hopeful = np.flatnonzero((score >= edge[:, None]).any(axis=1))
        for q in hopeful.tolist():
            at = np.flatnonzero(score[q] >= edge[q])
            at = at[np.isfinite(score[q][at])]
            if not len(at):
                continue
            if len(at) > self.k:
                cut = np.partition(score[q][at], -self.k)[-self.k]
                above = at[score[q][at] > cut]
                at = np.concatenate([above, at[score[q][at] == cut][:self.k - len(above)]])
            s = np.concatenate([self.score[q], score[q][at]])
            v = np.concatenate([self.vec[q], ids[at]])
            top = np.lexsort((v, -s))[:self.k]
            self.score[q], self.vec[q] = s[top], v[top]


def _search(shared, k: int):
    def rows(batches):
        best = {x.shape[1]: [Best(*b, k) for b in shared.value if b[1].shape[1] == x.shape[1]]
                for _, x in shared.value}
        for batch in batches:
            for ids, c in matrices(batch.column(0), batch.column(1)):
                for own in best.get(c.shape[1], ()):
                    own.meet(ids, c)
        for group in best.values():
            for b in group:
                q, r = np.nonzero(np.isfinite(b.score))
                score, low, high = b.score[q, r], np.iinfo(np.int64).min, np.iinfo(np.int64).max
                above, below = score > np.longdouble(high), score < np.longdouble(low)
                longs = np.where(above | below, 0, score).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b.ids[q]), pa.array(b.vec[q, r]),
                     pa.array(np.where(above, high, np.where(below, low, longs))), pa.array(~(above | below))],
                    ["query_id", "vec_id", "score", "fits"])
    return rows


def top_k(vectors: DataFrame, is_query, k: int = 5, pass_queries: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` candidates of highest integer
    inner product per query, ties to the smaller ``vec_id``."""
    spark = vectors.sparkSession
    all_ = quantised(vectors)
    queries = all_.where(is_query).distinct()
    n = queries.count()
    passes = -(-n // pass_queries)
    parts = None
    for p in range(max(1, passes)):
        own = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == p) if passes > 1 else queries
        got = own.toArrow()
        blocks = [(i, x) for i, x in matrices(got.column(0).combine_chunks(), got.column(1).combine_chunks(), 1024)] \
            if got.num_rows else []
        shared = spark.sparkContext.broadcast(blocks)
        found = written(all_.mapInArrow(_search(shared, k), "query_id bigint, vec_id bigint, score bigint, fits boolean"),
                        "search-pass")
        shared.destroy()
        parts = found if parts is None else parts.union(found)
    too_high = ~F.col("fits") & (F.col("score") > 0)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), too_high.desc(), F.col("fits").desc(), "vec_id")
    score = F.when(F.col("fits"), F.col("score")).otherwise(F.raise_error(F.lit("a score does not fit a long")).cast("bigint"))
    return parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", score.alias("score"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all ``embeddings`` for each whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % 50 == 0)


OP10_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings WHERE embedding IS NOT NULL
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""
