"""Hard negatives of anchor vectors: rows of another label that score nearly as high as a row of the anchor's own label.

Method: anchor-clustered shared lists.  Anchors are clustered by angle.  For each cluster the candidates are sorted once, by the
largest score that any member could give them: their norm times the cosine of their angle to the centre, less the angle of
the cluster's widest member.  Every member walks that one list, tile by tile, and is done when the bound of what is left,
times its own norm, is below what it still needs.  So the list ends early for most members, and what a member has not seen is
certified to be too low.  There are two walks: over rows of the member's own label for its positives, then over all others for the
rows whose score lies in the band of each positive.

Spark deals out the work: candidates in slices and anchors in blocks of whole clusters, both of bounded size, meet as pairs (slice,
block), one group each; a group walks its part of the lists, and what the groups found is merged by anchor.  A cluster
with more members than a block holds is split.  The centres are fitted on a bounded sample, SAMPLE anchors; every anchor is
assigned, and the bounds hold whatever the centres are.

Defined results.  Rows with a null id, label or vector, or a null or non-finite component, take no part.  Rows of one vec_id count
as one, with the smallest label and vector of them, so equal rows never meet.  Vectors of different length compare as if the
shorter had zeros behind it.  Ties go to the smaller vec_id.  An anchor without another row of its label, or a positive without a
row in its band, has no row in the result; a band below zero is empty.  Empty table: no rows.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.chunks import ship
from shelfcast.llm.graph import stored

SCALE = 256
EVERY = 50
POSITIVES = 5
NEGATIVES = 3
LEAST, MOST = 50, 95
"""A negative's score lies within these percents of the positive's."""
SAMPLE = 2048
MEMBERS = 128
"""Anchors that a cluster should have, as long as there are no more than MOST_CLUSTERS."""
MOST_CLUSTERS = 256
SLICE_BYTES, BLOCK_BYTES = 32 << 20, 8 << 20
TILE = 512
SLACK = 1e-6
EXACT = float(1 << 53)
_FOUND = "anchor_id long, positive_id long, vec_id long, positive_score long, score long"


def usable(vectors: DataFrame, relabel: Column | None = None) -> DataFrame:
    """vec_id, label and whole-number vector of the rows that take part, one for each vec_id."""
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    label = F.col("label").cast("long") if relabel is None else relabel
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad) \
        .select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), whole.alias("v"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row")).select("vec_id", "row.label", "row.v")


def matrix(values: pa.ListArray, width: int = 0) -> np.ndarray:
    """One row for each vector, zeros where it is shorter than the longest or than ``width``."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    ends = np.array(values.offsets, dtype=np.int64)
    flat, ends = np.array(values.values, dtype=np.int64)[ends[0]:ends[-1]], ends - ends[0]
    sizes = np.diff(ends)
    width = max(width, int(sizes.max(initial=0)))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(ends[:-1], sizes)] = flat
    return out


def norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(rows.astype(np.float64)).sum(axis=1))


def directions(rows: np.ndarray) -> np.ndarray:
    size = norms(rows)
    return rows / np.where(size > 0, size, 1.0)[:, None]


def centres_of(rows: np.ndarray, n: int) -> np.ndarray:
    """Unit vectors in the middle of ``n`` groups of directions, by some rounds of spherical k-means."""
    if not len(rows):
        return np.zeros((1, rows.shape[1]))
    units = directions(rows)
    centres = units[np.linspace(0, len(units) - 1, min(n, len(units))).astype(int)]
    for _ in range(8):
        nearest = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        size = np.sqrt(np.square(sums).sum(axis=1))
        centres = np.where(size[:, None] > 0, sums / np.where(size > 0, size, 1.0)[:, None], centres)
    return centres


def angles(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Angle of every row to a unit vector; a row without length points the same way."""
    size = norms(rows)
    return np.where(size > 0, np.arccos(np.clip(rows @ centre / np.where(size > 0, size, 1.0), -1.0, 1.0)), 0.0)


class SharedList:
    """Candidates in the order of what the widest member of a cluster could give them, at unit length."""

    def __init__(self, candidates: np.ndarray, members: np.ndarray):
        width = max(candidates.shape[1], members.shape[1])
        self.candidates, self.members = _wide(candidates, width), _wide(members, width)
        centre = directions(self.members).sum(axis=0)
        size = np.sqrt(np.square(centre).sum())
        centre = centre / size if size > 0 else centre
        if size > 0:
            reach = angles(self.members, centre).max(initial=0.0) + SLACK
            closest = np.maximum(angles(self.candidates, centre) - reach - SLACK, 0.0)
            bound = norms(self.candidates) * np.cos(closest)
        else:
            bound = norms(self.candidates)
        # Never below the true score: a bound under zero is for candidates that point away.
        self.order = np.argsort(-bound, kind="stable")
        self.bound = bound[self.order] + SLACK * (np.abs(bound[self.order]) + 1.0)
        self.lengths = norms(self.members)
        longest = self.lengths.max(initial=0.0) * norms(self.candidates).max(initial=0.0)
        self.kind = np.float64 if longest < EXACT else np.int64

    def most(self, place: int, of: np.ndarray) -> np.ndarray:
        """No candidate from ``place`` on scores above this for the members ``of``."""
        return np.where(self.bound[place] >= 0, self.bound[place] * self.lengths[of] * (1 + SLACK), 0.0)

    def scores(self, of: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (self.members[of].astype(self.kind) @ self.candidates[at].astype(self.kind).T).astype(np.int64)


def _wide(rows: np.ndarray, width: int) -> np.ndarray:
    return rows if rows.shape[1] == width else np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


class Best:
    """The k highest scores so far, ties to the smaller id."""

    def __init__(self, k: int):
        self.k, self.score, self.vec = k, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def offer(self, scores: np.ndarray, vecs: np.ndarray) -> None:
        score, vec = np.append(self.score, scores), np.append(self.vec, vecs)
        order = np.lexsort((vec, -score))[:self.k]
        self.score, self.vec = score[order], vec[order]

    @property
    def least(self) -> float:
        return float(self.score[-1]) if len(self.score) == self.k else -np.inf


def positives(ids, labels, shared: SharedList, anchor_ids, anchor_labels, k: int) -> list[tuple[int, Best]]:
    """The k best candidates of its own label for every member, from one walk for each label."""
    found, least = [Best(k) for _ in anchor_ids], np.full(len(anchor_ids), -np.inf)
    walk_labels = labels[shared.order]
    for label in np.unique(anchor_labels):
        places, alive = np.flatnonzero(walk_labels == label), np.flatnonzero(anchor_labels == label)
        for low in range(0, len(places), TILE):
            alive = alive[shared.most(places[low], alive) >= least[alive]]
            if not len(alive):
                break
            at = shared.order[places[low:low + TILE]]
            scores = shared.scores(alive, at)
            for row in np.flatnonzero((scores >= least[alive, None]).any(axis=1)).tolist():
                i = int(alive[row])
                hopeful = (scores[row] >= least[i]) & (ids[at] != anchor_ids[i])
                if hopeful.any():
                    found[i].offer(scores[row, hopeful], ids[at][hopeful])
                    least[i] = found[i].least
    return list(enumerate(found))


def negatives(ids, labels, shared: SharedList, anchor_ids, anchor_labels, wanted: list[np.ndarray], k: int) -> list[list[Best]]:
    """For every member and each of its positive scores, the k best candidates of other labels within the band."""
    found = [[Best(k) for _ in scores] for scores in wanted]

    def needed(i: int) -> float:
        """What a candidate must score at least to matter to member i."""
        return min((max(best.least, LEAST * int(score) / 100) for best, score in zip(found[i], wanted[i]) if score >= 0), default=np.inf)

    alive = np.arange(len(anchor_ids))
    need = np.array([needed(i) for i in alive.tolist()])
    for low in range(0, len(ids), TILE):
        alive = alive[shared.most(low, alive) >= need[alive]]
        if not len(alive):
            break
        at = shared.order[low:low + TILE]
        scores = shared.scores(alive, at)
        for row in np.flatnonzero((scores >= need[alive, None]).any(axis=1)).tolist():
            i = int(alive[row])
            mine, other = scores[row], labels[at] != anchor_labels[i]
            for best, score in zip(found[i], wanted[i].tolist()):
                inside = other & (100 * mine >= LEAST * score) & (100 * mine <= MOST * score) & (mine >= best.least)
                if inside.any():
                    best.offer(mine[inside], ids[at][inside])
            need[i] = needed(i)
    return found


def _pair(first_walk: bool, k: int):
    """One slice of candidates against one block of anchors, cluster after cluster."""
    def walk(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        rows = []
        if len(candidates) and len(anchors):
            order = np.argsort(np.array(candidates["vec_id"], dtype=np.int64))
            ids, labels = np.array(candidates["vec_id"])[order], np.array(candidates["label"])[order]
            vectors = matrix(candidates["v"])[order]
            anchor_ids, anchor_labels = np.array(anchors["vec_id"]), np.array(anchors["label"])
            members, clusters = matrix(anchors["v"]), np.array(anchors["cluster"])
            for cluster in np.unique(clusters):
                of = np.flatnonzero(clusters == cluster)
                shared = SharedList(vectors, members[of])
                if first_walk:
                    for i, best in positives(ids, labels, shared, anchor_ids[of], anchor_labels[of], k):
                        rows += [(anchor_ids[of[i]], None, vec, None, score) for vec, score in zip(best.vec.tolist(), best.score.tolist())]
                else:
                    own = [anchors["positives"][int(i)].as_py() for i in of]
                    wanted = [np.array([p["score"] for p in each], dtype=np.int64) for each in own]
                    found = negatives(ids, labels, shared, anchor_ids[of], anchor_labels[of], wanted, k)
                    for i, bests in enumerate(found):
                        for positive, best in zip(own[i], bests):
                            rows += [(anchor_ids[of[i]], positive["vec_id"], vec, positive["score"], score)
                                     for vec, score in zip(best.vec.tolist(), best.score.tolist())]
        names = ["anchor_id", "positive_id", "vec_id", "positive_score", "score"]
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.table([pa.array(column, pa.int64()) for column in columns], names=names)
    return walk


def _walked(candidates: DataFrame, anchors: DataFrame, slices: int, blocks: int, first_walk: bool, k: int) -> DataFrame:
    """Every slice against every block: each pair is a group of its own, of bounded size."""
    left = candidates.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = anchors.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return left.groupBy("slice", "block").cogroup(right.groupBy("slice", "block")).applyInArrow(_pair(first_walk, k), _FOUND)


def _assigning(shared):
    def rows(batches):
        centres = shared.value
        for batch in batches:
            if not len(batch):
                continue
            units = directions(matrix(batch["v"], centres.shape[1]))
            # A vector longer than all of the sample's is assigned by its first components.
            nearest = (units[:, :centres.shape[1]] @ centres.T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest, pa.int32())], names=[*batch.schema.names, "cluster"])
    return rows


def clustered(anchors: DataFrame) -> tuple[DataFrame, int]:
    """Anchors with their ``cluster`` and ``block``, and the number of blocks.  Clusters share blocks or fill several."""
    spark = anchors.sparkSession
    count, cells = anchors.agg(F.count(F.lit(1)), F.sum(F.size("v"))).first()
    n = max(1, min(MOST_CLUSTERS, count // MEMBERS))
    sample = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    longest = max((len(r.v) for r in sample), default=1)
    rows = np.zeros((len(sample), max(longest, 1)), dtype=np.int64)
    for i, r in enumerate(sample):
        rows[i, :len(r.v)] = r.v
    shared = spark.sparkContext.broadcast(centres_of(rows, n))
    assigned = stored(anchors.mapInArrow(_assigning(shared), "vec_id long, label long, v array<bigint>, cluster int"), "anchors")
    room = max(MEMBERS, int(BLOCK_BYTES // (8 * max(1, int(cells or 0) // max(1, count)))))
    sizes = {r.cluster: r["count"] for r in assigned.groupBy("cluster").count().collect()}
    first, parts, block, filled = {}, {}, 0, 0
    for cluster, size in sorted(sizes.items()):
        if filled and filled + size > room:
            block, filled = block + 1, 0
        first[cluster], parts[cluster] = block, -(-size // room)
        filled = filled + size
        if parts[cluster] > 1:
            block, filled = block + parts[cluster], 0

    def of(values: dict) -> Column:
        pairs = [F.lit(x) for pair in (values or {0: 1}).items() for x in pair]
        return F.element_at(F.create_map(*pairs), F.col("cluster"))

    blocked = assigned.withColumn("block", of(first) + F.pmod(F.xxhash64("vec_id"), of(parts)).cast("int"))
    return blocked, block + 1


def hard_negatives(vectors: DataFrame, relabel: Column | None = None, every: int = EVERY) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for anchors with vec_id divisible by ``every``."""
    spark = vectors.sparkSession
    ship(spark)
    rows = stored(usable(vectors, relabel), "vectors")
    cells = rows.agg(F.sum(F.size("v"))).first()[0]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = max(parts, -(-8 * int(cells or 0) // SLICE_BYTES))
    anchors, blocks = clustered(rows.filter(F.col("vec_id") % every == 0))
    candidates = rows.withColumn("slice", F.pmod(F.xxhash64("vec_id"), F.lit(slices)).cast("int"))
    best = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "vec_id")
    own = _walked(candidates, anchors, slices, blocks, True, POSITIVES) \
        .withColumn("place", F.row_number().over(best)).filter(F.col("place") <= POSITIVES) \
        .groupBy("anchor_id").agg(F.collect_list(F.struct("vec_id", "score")).alias("positives"))
    with_own = stored(anchors.join(own.withColumnRenamed("anchor_id", "vec_id"), "vec_id"), "anchors")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("score").desc(), "vec_id")
    return _walked(candidates, with_own, slices, blocks, False, NEGATIVES) \
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= NEGATIVES) \
        .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                F.col("score").alias("negative_score"))
