"""Approximate nearest neighbours by an inverted multi-index.

Each vector's two halves are quantised apart, so K centroids a half make K * K cells. A query visits
cells in the order of the summed distances of their two centroids, popped from a heap, until they
hold enough entries; those are reranked by exact distance. How many entries are enough is read off
the training sample, whose neighbours are farther apart than those of all rows. Entries and queries
meet in bounded blocks, so that a cell with very many vectors is spread over tasks.
"""

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import map_arrow, sampled, stored

#: Vectors that the centroids are fitted on at most, and sampled queries that set the effort.
SAMPLE_ROWS, SAMPLE_QUERIES = 8_000, 200
#: Recall that the effort is set to reach on the sample.
SAMPLE_RECALL = 0.95
MAX_CENTROIDS, ROUNDS = 64, 10
ENTRY_BLOCK, QUERY_BLOCK = 4096, 1024
NEIGHBOURS = 10


def squared(a, b):
    """Squared distances of all rows of `a` to all rows of `b`."""
    return np.maximum((a**2).sum(1)[:, None] - 2 * a @ b.T + (b**2).sum(1), 0)


def centroids(points, k, rounds=ROUNDS):
    """k-means from evenly spaced points of the sample; empty clusters keep their centre."""
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        nearest = squared(points, centres).argmin(axis=1)
        counts = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def traverse(first, second, counts, enough):
    """Cells (i, j) by growing first[i] + second[j] until they hold `enough` entries."""
    rows, columns = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, held = [(first[rows[0]] + second[columns[0]], 0, 0)], 0
    while heap and held < enough:
        _, x, y = heapq.heappop(heap)
        i, j = int(rows[x]), int(columns[y])
        held += int(counts[i, j])
        yield i, j
        # (x, y) is pushed by its left neighbour, or in the first column by the one above it
        if y + 1 < len(columns):
            heapq.heappush(heap, (first[rows[x]] + second[columns[y + 1]], x, y + 1))
        if y == 0 and x + 1 < len(rows):
            heapq.heappush(heap, (first[rows[x + 1]] + second[columns[0]], x + 1, 0))


class Index:
    """Centroids of both halves and, once counted, the entries per cell."""

    def __init__(self, sample, rows):
        self.half = sample.shape[1] // 2
        k = int(min(MAX_CENTROIDS, max(1, math.sqrt(rows) / 4), len(sample)))
        self.first = centroids(sample[:, : self.half], k)
        self.second = centroids(sample[:, self.half :], k)
        self.counts = np.zeros((k, k), np.int64)
        self.effort = self._effort(sample)

    def cells(self, vectors):
        return (
            squared(vectors[:, : self.half], self.first).argmin(axis=1),
            squared(vectors[:, self.half :], self.second).argmin(axis=1),
        )

    def distances(self, vectors):
        return (
            squared(vectors[:, : self.half], self.first),
            squared(vectors[:, self.half :], self.second),
        )

    def visited(self, first, second, enough):
        """The visited cells of a query as a matrix of booleans."""
        out = np.zeros(self.counts.shape, bool)
        for i, j in traverse(first, second, self.counts, enough):
            out[i, j] = True
        return out

    def _effort(self, sample):
        """The share of entries to visit so that sampled queries find SAMPLE_RECALL of theirs."""
        i, j = self.cells(sample)
        counts = np.zeros(self.counts.shape, np.int64)
        np.add.at(counts, (i, j), 1)
        chosen = np.linspace(0, len(sample) - 1, min(SAMPLE_QUERIES, len(sample))).astype(int)
        near = squared(sample[chosen], sample)
        near[np.arange(len(chosen)), chosen] = np.inf
        near = near.argsort(axis=1)[:, :NEIGHBOURS]
        needed = []
        for row, a, b in zip(near, *self.distances(sample[chosen]), strict=True):
            order = (a[:, None] + b[None]).ravel().argsort(kind="stable")
            before = np.empty(len(order))
            before[order] = np.cumsum(counts.ravel()[order])
            needed += before[i[row] * counts.shape[1] + j[row]].tolist()
        return min(1.0, float(np.quantile(needed, SAMPLE_RECALL)) / len(sample)) if needed else 1.0


def _matrix(column):
    """An Arrow list column of equal lengths as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _assign(index):
    def run(batches):
        for batch in batches:
            if len(batch):
                cells = [pa.array(c.astype(np.int32)) for c in index.cells(_matrix(batch["vec"]))]
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"], batch["vec"], *cells], ["vec_id", "vec", "c1", "c2"]
                )

    return run


def _plan(index, enough):
    """Queries to one row per shard (first centroid) with the second centroids visited there."""

    def run(batches):
        for batch in batches:
            rows = []
            distances = index.distances(_matrix(batch["vec"])) if len(batch) else ([], [])
            for n, (a, b) in enumerate(zip(*distances, strict=True)):
                seen = index.visited(a, b, enough)
                rows += [(n, c, np.packbits(seen[c]).tobytes()) for c in np.flatnonzero(seen.any(1))]
            if rows:
                take, shards, cells = zip(*rows, strict=True)
                take = pa.array(take, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"].take(take), batch["vec"].take(take),
                     pa.array(shards, pa.int32()), pa.array(cells, pa.binary())],
                    ["query_id", "query", "c1", "cells"],
                )

    return run


def _rerank(found):
    """Best entries of a block for each query of a block, by exact distance and then vec_id."""

    def run(queries, entries):
        out = ([], [], [])
        if queries.num_rows and entries.num_rows:
            q = _matrix(queries["query"].combine_chunks())
            e = _matrix(entries["vec"].combine_chunks())
            ids = np.array([math.inf if v is None else v for v in entries["vec_id"].to_pylist()], object)
            second = entries["c2"].to_numpy()
            near, norms = squared(q, e), (e**2).sum(1).max() + (q**2).sum(1)
            for n, (name, cells) in enumerate(
                zip(queries["query_id"].to_pylist(), queries["cells"].to_pylist(), strict=True)
            ):
                seen = np.unpackbits(np.frombuffer(cells, np.uint8))[second] > 0
                seen &= ids != name
                rows = np.flatnonzero(seen)
                if len(rows) > found:  # all that rounding could place among the first
                    bound = np.partition(near[n, rows], found - 1)[found - 1]
                    rows = rows[near[n, rows] <= bound + 1e-9 * norms[n]]
                exact = np.sqrt(((e[rows] - q[n]) ** 2).sum(axis=1))
                order = sorted(zip(exact.tolist(), ids[rows].tolist(), strict=True))[:found]
                out[0].extend([name] * len(order))
                out[1].extend(None if v == math.inf else v for _, v in order)
                out[2].extend(s for s, _ in order)
        return pa.table(
            {"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()),
             "score": pa.array(out[2], pa.float64())}
        )

    return run


def usable(vectors):
    """(vec_id, vec) of the vectors that take part: of the most frequent length, not null or zero,
    without null or non-finite components."""
    vec = F.col("embedding")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).where(
        "vec IS NOT NULL AND exists(vec, x -> x <> 0)"
        " AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    )
    sizes = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n"))
    best = sizes.orderBy(F.desc("n"), "d").first()
    return rows.where(F.size("vec") == best["d"]) if best else rows


def neighbours(vectors, is_query, found=NEIGHBOURS):
    """The `found` nearest vectors of each query: query_id, rank, vec_id, score (Euclidean).

    `is_query` is a condition on vec_id. A query's own row, and any row that repeats its vec_id,
    is no candidate; ties go to the smaller vec_id, a null one last; a row with a null vec_id is a
    candidate but no query. Queries that repeat a vec_id count once, by the least vector. See
    `usable` for the vectors that take part.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    total = rows.count()
    sample = [r[0] for r in sampled(rows, "vec", SAMPLE_ROWS, total).select("vec").collect()]
    sample = sorted(sample) or [r[0] for r in rows.select("vec").limit(SAMPLE_ROWS).collect()]
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    points, kind = np.array(sample, np.float64), rows.schema["vec"].dataType.simpleString()
    if points.shape[1] == 1:  # a second half that tells nothing apart
        points = np.column_stack([points, 0 * points])
        rows = rows.withColumn("vec", F.concat("vec", F.array(F.element_at("vec", 1) * 0)).cast(kind))
    index = Index(points, total)
    entries = stored(
        map_arrow(rows, _assign(index), f"vec_id long, vec {kind}, c1 int, c2 int"), "ann-entries"
    )
    sizes = entries.groupBy("c1", "c2").agg(F.count("*").alias("n")).collect()  # K * K at most
    for r in sizes:
        index.counts[r["c1"], r["c2"]] = r["n"]
    enough = max(found + 1, math.ceil(index.effort * total))

    blocks = -(-index.counts.sum(axis=1) // ENTRY_BLOCK)
    shards = spark.createDataFrame(
        [(i, max(1, int(b))) for i, b in enumerate(blocks)], "c int, blocks int"
    )
    asked = entries.where(is_query & F.col("vec_id").isNotNull())
    asked = asked.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    groups = max(1, -(-asked.count() // QUERY_BLOCK))
    schema = f"query_id long, query {kind}, c1 int, cells binary"
    planned = map_arrow(asked, _plan(index, enough), schema).join(
        F.broadcast(shards), F.col("c1") == F.col("c")
    )
    planned = planned.select(
        "c1", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int").alias("group"),
        "query_id", "query", "cells",
    )
    held = entries.join(F.broadcast(shards), F.col("c1") == F.col("c")).select(
        "c1", F.pmod(F.xxhash64("vec_id", "vec"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "vec_id", "vec", "c2",
    )
    key = ["c1", "block", "group"]
    near = planned.groupBy(*key).cogroup(held.groupBy(*key)).applyInArrow(
        _rerank(found), "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy("score", F.col("vec_id").asc_nulls_last())
    return (
        near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= found)
        .select("query_id", "rank", "vec_id", "score")
    )
