"""Exact top-k search by inner product of whole-number vectors.

Method: columnar branch and bound.  Candidates lie in vertical layout, one row of a block for each dimension.  Scores add up
a few dimensions at a time; after each step what the remaining dimensions can still add is at most the product of both
remaining norms (the remaining mass), and candidates whose bound stays under every query's k-th best score so far are
compacted away.  Each task keeps k candidates for each query, and the k best of those are the result.

Components are floor(SCALE * x).  Sums stay below 2**53 where both norms allow it, and are then exact in doubles; other
blocks add up 64-bit integers, which wrap around as a long does.

Spark deals out the work: candidates in slices and queries in blocks, both of bounded size, meet as pairs (slice, block), one
group each, and the k best of every group are merged by query.  So nothing that grows with the data is broadcast, gathered or
read by one task.

Defined results.  Vectors that are null or hold null or non-finite components take no part.  Rows with a null id are candidates
for nobody and ask nothing.  Vectors of different length compare as if the shorter had zeros behind it.  Rows with one vec_id
never match each other; as candidates each of them counts, as a query the smallest of their vectors does.  Ties go to the smaller
vec_id.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.chunks import ship
from shelfcast.llm.graph import stored

SCALE = 1024
STEP = 16
"""Dimensions added between two prunings."""
BLOCK = 2048
TILE = 64
"""Queries that share one pruning."""
ROUND_BYTES, SLICE_BYTES = 16 << 20, 32 << 20
"""Vectors of a block of queries, and of a slice of candidates."""
EXACT = float(1 << 53)
_ROWS = "query_id long, vec_id long, score long"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and whole-number vectors of the rows that take part."""
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad) \
        .select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def _vertical(vectors: list, width: int) -> np.ndarray:
    """One row for each dimension, one column for each vector; zeros where a vector is shorter."""
    out = np.zeros((width, len(vectors)), dtype=np.int64)
    for i, vector in enumerate(vectors):
        out[:len(vector), i] = vector
    return out


def remaining(columns: np.ndarray) -> np.ndarray:
    """Norm of what lies behind each step of dimensions: one row for each step, rounded up."""
    squares = np.square(columns.astype(np.float64))
    steps = np.add.reduceat(squares, np.arange(0, len(columns), STEP), axis=0) if len(columns) else squares
    behind = np.cumsum(steps[::-1], axis=0)[::-1]
    return np.sqrt(np.vstack((behind[1:], np.zeros((1, columns.shape[1]))))) * (1 + 1e-9)


class Best:
    """The k best candidates so far of some queries."""

    def __init__(self, ids: np.ndarray, columns: np.ndarray, k: int):
        self.ids, self.columns, self.k = ids, columns, k
        self.behind = remaining(columns)
        self.longest = float(np.sqrt(np.square(columns.astype(np.float64)).sum(axis=0)).max(initial=0))
        self.score = [np.zeros(0, dtype=np.int64) for _ in ids]
        self.vec = [np.zeros(0, dtype=np.int64) for _ in ids]
        self.least = np.full(len(ids), -np.inf)

    def offer(self, ids: np.ndarray, columns: np.ndarray, behind: np.ndarray) -> None:
        """Score a block of candidates; drop those that cannot reach any query's k-th score on the way."""
        whole = self.longest * float(np.sqrt(np.square(columns.astype(np.float64)).sum(axis=0)).max(initial=0)) >= EXACT
        kind = np.int64 if whole else np.float64
        left = np.arange(len(ids))
        sums = np.zeros((len(self.ids), len(ids)), dtype=kind)
        mine = self.columns.astype(kind)
        for step, low in enumerate(range(0, len(columns), STEP)):
            part = columns[low:low + STEP] if len(left) == len(ids) else columns[low:low + STEP, left]
            sums += mine[low:low + STEP].T @ part.astype(kind)
            if low + STEP < len(columns) and not whole:
                bound = sums + self.behind[step][:, None] * behind[step][left][None, :]
                alive = (bound >= self.least[:, None]).any(axis=0)
                if not alive.all():
                    left, sums = left[alive], sums[:, alive]
                if not len(left):
                    return
        sums, ids = sums.astype(np.int64), ids[left]
        hopeful = sums >= self.least[:, None]
        for i in np.flatnonzero(hopeful.any(axis=1)).tolist():
            at = np.flatnonzero(hopeful[i] & (ids != self.ids[i]))
            score, vec = np.append(self.score[i], sums[i, at]), np.append(self.vec[i], ids[at])
            order = np.lexsort((vec, -score))[:self.k]
            self.score[i], self.vec[i] = score[order], vec[order]
            if len(order) == self.k:
                self.least[i] = score[order[-1]]


def _flat(values) -> tuple[np.ndarray, np.ndarray]:
    """All components of a column of vectors, and n + 1 offsets."""
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    ends = np.array(values.offsets, dtype=np.int64)
    return np.array(values.values, dtype=np.int64)[ends[0]:ends[-1]], ends - ends[0]


def _search(k: int):
    """One slice of candidates against one block of queries."""
    def search(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        tiles: list[Best] = []
        if len(candidates) and len(asked):
            ids, (query, bounds) = np.array(asked["vec_id"], dtype=np.int64), _flat(asked["v"])
            vectors = [query[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            flat, ends = _flat(candidates["v"])
            vec_ids, copies = np.array(candidates["vec_id"], dtype=np.int64), np.array(candidates["copies"], dtype=np.int64)
            width = max(len(v) for v in vectors)
            widest = max(width, int(np.diff(ends).max()))
            tiles = [Best(ids[i:i + TILE], _vertical(vectors[i:i + TILE], max(width, 1)), k) for i in range(0, len(ids), TILE)]
            for low in range(0, len(vec_ids), BLOCK):
                high = min(len(vec_ids), low + BLOCK)
                sizes = np.diff(ends[low:high + 1])
                if (sizes == widest).all():
                    columns = flat[ends[low]:ends[high]].reshape(high - low, widest).T
                else:
                    columns = _vertical([flat[ends[i]:ends[i + 1]] for i in range(low, high)], widest)
                # What lies behind the longest query meets zeros.
                columns = np.ascontiguousarray(columns[:max(width, 1)]) if widest else np.zeros((1, high - low), dtype=np.int64)
                columns = np.repeat(columns, copies[low:high], axis=1)
                behind = remaining(columns)
                for tile in tiles:
                    tile.offer(np.repeat(vec_ids[low:high], copies[low:high]), columns, behind)
        found = [(np.repeat(tile.ids, [len(s) for s in tile.score]), np.concatenate(tile.vec), np.concatenate(tile.score)) for tile in tiles]
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, dtype=np.int64)] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])
    return search


def top_k(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score for every row whose vec_id is divisible by ``every``, against all other rows."""
    spark = vectors.sparkSession
    ship(spark)
    # Equal rows are one row with its number: more than k of them never appear.
    rows = stored(usable(vectors).groupBy("vec_id", "v").agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("copies")), "vectors")
    is_query = F.col("vec_id") % every == 0
    cells, query_cells = rows.agg(F.sum(F.size("v")), F.sum(F.when(is_query, F.size("v")))).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices, blocks = max(parts, -(-8 * int(cells or 0) // SLICE_BYTES)), max(1, -(-8 * int(query_cells or 0) // ROUND_BYTES))
    asked = rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v")) \
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")) \
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    candidates = rows.withColumn("slice", F.pmod(F.xxhash64("vec_id", "v"), F.lit(slices)).cast("int")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = candidates.groupBy("slice", "block").cogroup(asked.groupBy("slice", "block")).applyInArrow(_search(k), _ROWS)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
