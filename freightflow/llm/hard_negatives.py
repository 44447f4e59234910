"""Hard negatives by an inverted multi-index whose visits end on certified windows.

Vectors are split in two halves, and each half has a codebook; two codewords form a cell. The radius of
a codeword is the greatest distance of a half from it, so that the inner product of an anchor's half with
any half of the codeword is bounded by that with the codeword itself and the radius. A heap over both
sorted lists of half bounds yields the cells of an anchor by falling sum of the two (multi-sequence).

A search asks for the first rows of score windows and takes two rounds. The first visits cells until
they hold a share of the rows. What it finds is a floor for each window: no cell whose bound lies below
can change the answer. The second goes on with the heap down to the floor, so every answer is exact.
"""

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import map_arrow, sampled, send_package, stored
from .multi_index import centroids, squared

#: Rows that the codebooks are fitted on at most; every row is indexed.
SAMPLE_ROWS = 8_000
MAX_CODEWORDS = 64
#: Rows of a block of cells, and anchors that are compared with it at once.
ENTRY_BLOCK, ANCHOR_BLOCK = 4096, 1024
#: The first round visits cells until they hold this share of the rows, and this many at least.
FIRST_SHARE, FIRST_ROWS = 0.05, 256
POSITIVES = NEGATIVES = 5
#: A negative scores this share of its positive at least, in hundredths.
LEAST_SHARE = 80
#: Scaled components beyond are out of range: their inner products could leave 64 bits.
MOST = 1 << 24
_FAR = 1 << 62


def traverse(first, second):
    """(bound, i, j) of all cells by falling bound first[i] + second[j]."""
    rows, columns = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap = [(-(first[rows[0]] + second[columns[0]]), 0, 0)]
    while heap:
        bound, x, y = heapq.heappop(heap)
        yield -bound, int(rows[x]), int(columns[y])
        # (x, y) is pushed by its left neighbour, or in the first column by the one above it
        if y + 1 < len(columns):
            heapq.heappush(heap, (-(first[rows[x]] + second[columns[y + 1]]), x, y + 1))
        if y == 0 and x + 1 < len(rows):
            heapq.heappush(heap, (-(first[rows[x + 1]] + second[columns[0]]), x + 1, 0))


def packs(counts, size):
    """For each cell of a matrix of counts its pack, the first block of that and their number.

    Cells that follow each other share a pack, which is one block, until they hold `size`; a larger cell
    is a pack of its own and has several blocks.
    """
    pack, block = np.zeros(counts.shape, np.int64), np.zeros(counts.shape, np.int64)
    many, held, last, next_block, alone = np.ones(counts.shape, np.int64), 0, -1, 0, True
    for cell in np.ndindex(counts.shape):
        n = int(counts[cell])
        if alone or held + n > size:
            last, held, alone, blocks = last + 1, 0, n > size, max(1, -(-n // size))
            next_block += blocks
        pack[cell], many[cell], block[cell] = last, blocks, next_block - blocks
        held += n
    return pack, block, many


class Index:
    """Codebooks, radii and cell sizes; bounded by MAX_CODEWORDS, whatever the number of rows."""

    def __init__(self, sample, rows):
        self.half = -(-sample.shape[1] // 2)
        k = int(min(MAX_CODEWORDS, max(1, math.sqrt(rows) / 4), len(sample)))
        self.first = centroids(sample[:, : self.half], k)
        self.second = centroids(sample[:, self.half :], k)
        self.radii = [np.zeros(k), np.zeros(k)]
        self.counts = np.zeros((k, k), np.int64)

    def assign(self, vectors):
        """(cell, radius) of the first halves and of the second ones."""
        out = []
        for half, book in ((vectors[:, : self.half], self.first), (vectors[:, self.half :], self.second)):
            cell = squared(half, book).argmin(axis=1)
            out.append((cell, np.sqrt(((half - book[cell]) ** 2).sum(axis=1))))
        return out

    def close(self, blocks):
        self.pack, self.block, self.many = packs(self.counts, blocks)
        held = np.bincount(self.pack.ravel(), weights=self.counts.ravel())
        self.held = held.astype(np.int64)

    def visit(self, vector, enough, floor, skip=frozenset()):
        """Packs of cells in the order of the heap: until they hold `enough` rows, or with a `floor` all
        whose bound reaches it, but for those in `skip`."""
        a, b = vector[: self.half], vector[self.half :]
        first = self.first @ a + np.sqrt(a @ a) * self.radii[0]
        second = self.second @ b + np.sqrt(b @ b) * self.radii[1]
        # more than rounding can take away from a bound
        slack = 1e-9 * (np.abs(first).max() + np.abs(second).max() + vector @ vector) + 1e-6
        seen, held, total = {}, 0, self.counts.sum()
        for bound, i, j in traverse(first, second):
            if floor is None and held >= min(enough, total) or floor is not None and bound + slack < floor:
                break
            pack = int(self.pack[i, j])
            if self.counts[i, j] and pack not in seen:
                seen[pack] = None
                held += int(self.held[pack])
        return [p for p in seen if p not in skip]


def _matrix(column):
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def usable(vectors):
    """(row, vec_id, label, vec) of the rows that take part: with a label, without null or non-finite
    components, of the most frequent length, and in range (see MOST). `vec` holds floor(256 * x) of every
    component, the label of a vec_id that 7 divides moves on by one modulo 10. `row` tells rows apart."""
    vec = F.col("embedding").cast("array<double>")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), moved.alias("label"), vec.alias("vec")
    ).where(
        "label IS NOT NULL AND vec IS NOT NULL AND size(vec) > 0"
        " AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    )
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "label",
        F.transform("vec", lambda x: F.floor(256 * x)).alias("vec"),
    ).where(f"forall(vec, x -> x BETWEEN -{MOST} AND {MOST})")
    rows = stored(rows.withColumn("vec", F.col("vec").cast("array<int>")), "mining-rows")
    sizes = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n"))
    best = sizes.orderBy(F.desc("n"), "d").first()
    return rows.where(F.size("vec") == best["d"]) if best else rows


def _assign(index):
    def run(batches):
        for batch in batches:
            if len(batch):
                (i, r), (j, s) = index.assign(_matrix(batch["vec"]))
                columns = [batch[n] for n in ("row", "vec_id", "label", "vec")]
                columns += [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(r), pa.array(s)]
                yield pa.RecordBatch.from_arrays(
                    columns, ["row", "vec_id", "label", "vec", "c1", "c2", "r1", "r2"]
                )

    return run


def build(rows):
    """(index, entries) of the rows of `usable`; None without any. `entries` adds pack and block."""
    spark, total = rows.sparkSession, rows.count()
    drawn = sampled(rows, "row", SAMPLE_ROWS, total).select("vec").collect()
    sample = sorted(r["vec"] for r in drawn) or [r["vec"] for r in rows.select("vec").limit(SAMPLE_ROWS).collect()]
    if not sample:
        return None
    index = Index(np.array(sample, np.float64), total)
    schema = "row long, vec_id long, label long, vec array<int>, c1 int, c2 int, r1 double, r2 double"
    cells = stored(map_arrow(rows, _assign(index), schema), "mining-cells")
    sizes = cells.groupBy("c1", "c2").agg(  # MAX_CODEWORDS squared at most
        F.count("*").alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")
    )
    for r in sizes.collect():
        index.counts[r["c1"], r["c2"]] = r["n"]
        index.radii[0][r["c1"]] = max(index.radii[0][r["c1"]], r["r1"])
        index.radii[1][r["c2"]] = max(index.radii[1][r["c2"]], r["r2"])
    index.close(ENTRY_BLOCK)
    return index, stored(_placed(spark, cells, index.pack, index.block, index.many), "mining-entries")


def _placed(spark, cells, pack, block, many):
    """Rows with the pack and the block of their cell; the table of cells is as bounded as the index."""
    table = spark.createDataFrame(
        [(i, j, int(pack[i, j]), int(block[i, j]), int(many[i, j])) for i, j in np.ndindex(pack.shape)],
        "i int, j int, pack long, block long, many long",
    )
    same = (F.col("c1") == F.col("i")) & (F.col("c2") == F.col("j"))
    spread = F.col("block") + F.pmod(F.xxhash64("row"), F.col("many"))
    return cells.join(F.broadcast(table), same).select(
        "row", "vec_id", "label", "vec", "c1", "c2", "pack", spread.alias("block")
    )


def _visits(index, enough, certified):
    """Anchors to one row per pack that they visit in this round."""
    def run(batches):
        for batch in batches:
            take, found = [], []
            vectors = _matrix(batch["vec"]) if len(batch) else []
            floors = batch["floors"].to_pylist() if certified else [None] * len(batch)
            for n, (vector, floor) in enumerate(zip(vectors, floors, strict=True)):
                visited = index.visit(vector, enough, None)
                if certified:
                    visited = index.visit(vector, enough, min(floor), frozenset(visited))
                take += [n] * len(visited)
                found += visited
            if take:
                rows = batch.take(pa.array(take, pa.int64()))
                names = [n for n in batch.schema.names if n != "floors"]
                yield pa.RecordBatch.from_arrays(
                    [*(rows[n] for n in names), pa.array(found, pa.int64())], [*names, "pack"]
                )

    return run


def _best(found, same):
    """The first `found` rows of a block for each window of each anchor."""
    def run(anchors, entries):
        out = ([], [], [], [], [])
        if anchors.num_rows and entries.num_rows:
            a = _matrix(anchors["vec"].combine_chunks())
            e = _matrix(entries["vec"].combine_chunks())
            if np.abs(a).max() * np.abs(e).max() * a.shape[1] >= 1 << 53:
                a, e = a.astype(np.int64), e.astype(np.int64)
            names = entries["vec_id"].to_numpy(zero_copy_only=False)
            null = np.isnan(names) if names.dtype.kind == "f" else np.zeros(len(names), bool)
            exact = entries["vec_id"].fill_null(0).to_numpy()
            rows, labels = entries["row"].to_numpy(), entries["label"].to_numpy()
            order = np.lexsort((rows, exact, null))  # ties
            e, exact, null, rows, labels = e[order], exact[order], null[order], rows[order], labels[order]
            scores = (a @ e.T).astype(np.int64)
            whose, kinds = anchors["row"].to_pylist(), anchors["label"].to_pylist()
            for n, (low, high) in enumerate(
                zip(anchors["lows"].to_pylist(), anchors["highs"].to_pylist(), strict=True)
            ):
                fits = ((labels == kinds[n]) == same) & (rows != whose[n])
                fits &= (scores[n] >= min(low)) & (scores[n] <= max(high))
                fits = np.flatnonzero(fits)
                fits = fits[np.argsort(-scores[n, fits], kind="stable")]
                ranked = scores[n, fits]
                for t, (least, most) in enumerate(zip(low, high, strict=True)):
                    start = np.searchsorted(-ranked, -most, side="left")
                    stop = np.searchsorted(-ranked, -least, side="right")
                    chosen = fits[start : min(stop, start + found)]
                    out[0].extend([whose[n]] * len(chosen))
                    out[1].extend([t] * len(chosen))
                    out[2].extend(rows[chosen].tolist())
                    out[3].extend(None if null[i] else int(exact[i]) for i in chosen)
                    out[4].extend(scores[n, chosen].tolist())
        return pa.table({
            "anchor": pa.array(out[0], pa.int64()), "target": pa.array(out[1], pa.int32()),
            "row": pa.array(out[2], pa.int64()), "vec_id": pa.array(out[3], pa.int64()),
            "score": pa.array(out[4], pa.int64()),
        })

    return run


_FOUND = "anchor long, target int, row long, vec_id long, score long"


def _first(found, n):
    order = Window.partitionBy("anchor", "target").orderBy(
        F.desc("score"), F.col("vec_id").asc_nulls_last(), "row"
    )
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def search(index, entries, anchors, found, same):
    """The first `found` rows of each window: anchor, target, rank, row, vec_id, score.

    `anchors` (row, label, vec, block, lows, highs) hold the windows of inner products [low, high] of an
    anchor, numbered by target; rows of its own label count if `same`, else those of others, and never
    the anchor's row itself. Higher scores come first, then smaller vec_ids, a null one last.
    """
    total = int(index.counts.sum())
    enough = max(FIRST_ROWS, math.ceil(FIRST_SHARE * total))
    send_package(anchors.sparkSession)

    def round_of(asked, certified, name):
        columns = [c for c in asked.columns if c != "floors"]
        schema = ", ".join(f"{c} {asked.schema[c].dataType.simpleString()}" for c in columns)
        visits = stored(
            map_arrow(asked, _visits(index, enough, certified), f"{schema}, pack long"), f"{name}-visits"
        )
        visits = visits.withColumnRenamed("block", "group")
        # Blocks go only to the groups of anchors that visit them.
        needed = visits.select(F.col("group").alias("g"), F.col("pack").alias("p")).distinct()
        held = entries.join(needed, F.col("pack") == F.col("p")).select(
            F.col("g").alias("group"), "block", "row", "vec_id", "label", "vec"
        )
        blocks = F.explode(F.sequence(F.col("start"), F.col("start") + F.col("many") - 1)).alias("block")
        seen = sorted({(int(p), int(b), int(m)) for p, b, m in zip(
            index.pack.ravel(), index.block.ravel(), index.many.ravel(), strict=True)})
        table = anchors.sparkSession.createDataFrame(seen, "p long, start long, many long")
        wanted = visits.join(F.broadcast(table), F.col("pack") == F.col("p")).select(
            "group", blocks, "row", "label", "vec", "lows", "highs"
        )
        keys = ["group", "block"]
        near = wanted.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(_best(found, same), _FOUND)
        return stored(_first(near, found).drop("rank"), name)

    one = round_of(anchors, False, "mining-first")
    floors = one.groupBy("anchor", "target").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    full = floors.where(F.col("n") == found).groupBy("anchor").agg(
        F.map_from_entries(F.collect_list(F.struct("target", "least"))).alias("_full")
    )
    raised = F.transform("lows", lambda low, t: F.coalesce(F.try_element_at("_full", t), low))
    # A window without as many rows yet keeps its own end as the floor.
    asked = anchors.join(full, F.col("row") == F.col("anchor"), "left").withColumn("floors", raised)
    two = round_of(asked.drop("anchor", "_full"), True, "mining-second")
    return _first(one.unionByName(two), found)


def mine(vectors, is_anchor, positives=POSITIVES, negatives=NEGATIVES):
    """One row per anchor, positive and negative: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    Scores are integer inner products of the scaled vectors. An anchor's positives are its first other
    rows of the same label, its negatives the first rows of other labels that score between LEAST_SHARE
    hundredths of the positive and the positive itself; a negative positive_score leaves no room. Ties
    go to the smaller vec_id. `is_anchor` is a condition on vec_id; a row with a null vec_id is no anchor
    but may be found, after all others of its score. Repeated rows are rows of their own, as anchors
    too. See `usable` for the rows that take part. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    made = build(usable(vectors))
    if made is None:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
            "negative_score long",
        )
    index, entries = made
    asked = entries.where(is_anchor & F.col("vec_id").isNotNull())
    # Anchors of neighbouring cells are compared with a block together.
    sizes = np.zeros_like(index.counts)
    for r in asked.groupBy("c1", "c2").agg(F.count("*").alias("n")).collect():
        sizes[r["c1"], r["c2"]] = r["n"]
    groups = packs(sizes, ANCHOR_BLOCK)
    anchors = stored(_placed(spark, asked.drop("pack", "block"), *groups), "mining-anchors").select(
        "row", "vec_id", "label", "vec", "block"
    )
    whole = anchors.drop("vec_id").withColumns({
        "lows": F.array(F.lit(-_FAR)), "highs": F.array(F.lit(_FAR))
    })
    alike = stored(search(index, entries, whole, positives, True), "mining-positives")
    alike = alike.select(
        F.col("anchor").alias("a"), (F.col("rank") - 1).alias("t"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    ).where("positive_score >= 0")
    # The least n with 80 * positive <= 100 * n
    low = F.expr(f"({LEAST_SHARE} * positive_score + 99) DIV 100").alias("low")
    targets = alike.groupBy("a").agg(
        F.sort_array(F.collect_list(F.struct("t", low, F.col("positive_score").alias("high")))).alias("w")
    )
    windowed = anchors.drop("vec_id").join(targets, F.col("row") == F.col("a")).select(
        "row", "label", "vec", "block", F.col("w.low").alias("lows"), F.col("w.high").alias("highs")
    )
    unlike = search(index, entries, stored(windowed, "mining-windows"), negatives, False)
    unlike = unlike.select(
        "anchor", "target", "rank", F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    same = (F.col("anchor") == F.col("a")) & (F.col("target") == F.col("t"))
    ids = anchors.select(F.col("row").alias("_row"), F.col("vec_id").alias("anchor_id"))
    return unlike.join(alike, same).join(ids, F.col("anchor") == F.col("_row")).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
