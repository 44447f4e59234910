"""Mixing sources to target weights by Pfair scheduling.

With weight w, block k of a source may be placed from slot floor(k / w) on and must be placed
before slot ceil((k + 1) / w). Earliest deadline first then meets all deadlines, so at every
moment each source is less than one block away from its share. Weights are whole parts of a
period, after which the schedule repeats: one period is scheduled on the driver, whatever the
number of documents, and every block finds its slot by arithmetic.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import whole_div
from .common import map_arrow, small_side, stored

#: Documents of a block.
BLOCK = 16
#: Slots of a period, at least; a source's weight is a whole number of them, at least one.
PERIOD = 1000
SLOTS_PER_SOURCE = 8
#: Default target weights: the size of the source to this power.
TEMPERATURE = 0.5
#: Partitions of an ordered mixture times sources at most.
BOUNDS = 1 << 20


def quanta(weights, period):
    """Whole parts of `period` per source, at least one each, nearest to the weights.

    `weights` is {source: weight}; weights that are null, negative or not finite count as zero.
    """
    clean = {s: w if w is not None and 0 < w < float("inf") else 0.0 for s, w in weights.items()}
    total = sum(clean.values())
    if total <= 0:
        clean = dict.fromkeys(clean, 1.0)
        total = float(len(clean))
    spare = period - len(clean)
    share = {s: w / total * spare for s, w in clean.items()}
    parts = {s: 1 + int(x) for s, x in share.items()}
    order = sorted(share, key=lambda s: (int(share[s]) - share[s], s is None, str(s)))
    for s in order[: period - sum(parts.values())]:
        parts[s] += 1
    return parts


def schedule(parts):
    """One period by earliest deadline first: (source, k, release, deadline, slot) per block."""
    period = sum(parts.values())
    names = sorted(parts, key=lambda s: (s is None, str(s)))

    def window(i, k):
        a = parts[names[i]]
        return k * period // a, -(-(k + 1) * period // a)

    waiting = [(0, window(i, 0)[1], i, 0) for i in range(len(names))]  # release first
    heapq.heapify(waiting)
    ready, out = [], []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, deadline, i, k = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, i, k))
        deadline, i, k = heapq.heappop(ready)
        out.append((names[i], k, window(i, k)[0], deadline, slot))
        if k + 1 < parts[names[i]]:
            release, later = window(i, k + 1)
            heapq.heappush(waiting, (release, later, i, k + 1))
    return out


def _number(batches):
    """Rows sorted by source get their number within the source and partition."""
    source, count = object(), 0
    for batch in batches:
        names = batch["source"].to_pylist()
        numbers = np.empty(len(names), np.int64)
        for i, name in enumerate(names):
            if name != source:
                source, count = name, 0
            numbers[i] = count
            count += 1
        columns = [batch[n] for n in batch.schema.names] + [pa.array(numbers)]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "number"])


def keyed(docs, *columns):
    """source, k and t of every row, and `columns`. Within their source rows are ordered by (k, t): by a
    hash of doc_id, and rows that share a doc_id by their place in `docs`."""
    return docs.select(
        F.col("source").cast("string").alias("source"),
        F.xxhash64(F.col("doc_id").cast("long")).alias("k"),
        F.monotonically_increasing_id().alias("t"), *columns,
    )


def numbered(rows):
    """(doc_id, source, k, t, number): the rows of `keyed` counted within their source. A hot source spans
    many partitions of the sort, and so does a hot doc_id."""
    spread = rows.repartitionByRange("source", "k", "t").sortWithinPartitions("source", "k", "t")
    ordered = spread.select("doc_id", "source", "k", "t", F.spark_partition_id().alias("p"))
    schema = "doc_id long, source string, k long, t long, p int, number long"
    local = stored(map_arrow(ordered, _number, schema), "mix-numbers")
    sizes = local.groupBy("source", "p").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("source").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    # One row per source and partition that it spans.
    starts = stored(
        sizes.select(F.col("source").alias("s"), F.col("p").alias("q"),
                     F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")),
        "mix-starts",
    )
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("p") == F.col("q"))
    joined = local.join(small_side(starts), same)
    return joined.select("doc_id", "source", "k", "t", (F.col("start") + F.col("number")).alias("number"))


def _planned(counted, weights, period, temperature):
    """(sizes, parts, period) of the sources of `counted`, which are listed on the driver, as weights
    given by hand would be."""
    sizes = {r["source"]: r["n"] for r in
             counted.groupBy("source").agg(F.count("*").alias("n")).collect()}
    wanted = {s: (weights or {}).get(s, 0.0) if weights else n**temperature
              for s, n in sizes.items()}
    period = max(period, SLOTS_PER_SOURCE * len(sizes))
    return sizes, quanta(wanted, period) if sizes else {}, period


def mix(docs, weights=None, block=BLOCK, period=PERIOD, temperature=TEMPERATURE):
    """One row per document: doc_id, source, weight, block, release, deadline, slot, place.

    Reading by (slot, place) gives the mixture; the deviation from the weights is below one block
    until a source runs out, and its later slots stay empty. Every row is placed once, repeated rows
    each for themselves. Null is a source of its own. `weights` is {source: weight}; a source without
    one gets the least. By default a source weighs its number of documents to the power `temperature`.
    Texts and other columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = keyed(docs, F.col("doc_id").cast("long").alias("doc_id"))
    counted = stored(numbered(rows), "mix-rows")
    _, parts, period = _planned(counted, weights, period, temperature)
    plan = [(s, parts[s], k, r, d, at) for s, k, r, d, at in schedule(parts)] if parts else []
    table = spark.createDataFrame(plan, "s string, a long, k long, r long, d long, at long")
    shares = spark.createDataFrame(list(parts.items()), "s string, a long")
    blocks = counted.join(F.broadcast(shares), F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "a", (F.col("number") % block).alias("place"),
        F.floor(F.col("number") / block).alias("block"),
    )
    # The plan has one row per slot of a period.
    rounds = (F.col("block") - F.col("block") % F.col("t.a")) / F.col("t.a")
    start = rounds.cast("long") * period
    same = (
        F.col("source").eqNullSafe(F.col("t.s"))
        & ((F.col("block") % F.col("b.a")) == F.col("t.k"))
    )
    return blocks.alias("b").join(F.broadcast(table.alias("t")), same).select(
        "doc_id", "source", (F.col("t.a") / period).alias("weight"), "block",
        (start + F.col("r")).alias("release"), (start + F.col("d")).alias("deadline"),
        (start + F.col("at")).alias("slot"), "place",
    )


class _Slots:
    """The slots of every source's blocks, and how many of its rows come before a slot."""

    def __init__(self, sizes, parts, period, block):
        self.names = sorted(parts, key=lambda s: (s is None, str(s)))
        at = {s: [] for s in self.names}
        for s, _, _, _, slot in schedule(parts):
            at[s].append(slot)
        self.at = {s: np.array(x, np.int64) for s, x in at.items()}
        self.sizes, self.period, self.block = sizes, period, block

    def before(self, slot):
        """Rows of each source, in the order of `names`, in front of `slot`."""
        rounds, rest = divmod(slot, self.period)
        return [
            min(self.sizes[s], (rounds * len(self.at[s]) + int(np.searchsorted(self.at[s], rest))) * self.block)
            for s in self.names
        ]

    def bounds(self, count):
        """`before` of slots that cut the mixture in `count` parts of about as many rows."""
        total, out = sum(self.sizes.values()), []
        last = self.period * (1 + max(self.sizes[s] // (len(self.at[s]) * self.block) for s in self.names))
        for i in range(1, count):
            low, high = 0, last
            while low < high:
                middle = (low + high) // 2
                if sum(self.before(middle)) * count < total * i:
                    low = middle + 1
                else:
                    high = middle
            out.append(self.before(low))
        return out


def placed(docs, weights=None, block=BLOCK, period=PERIOD, temperature=TEMPERATURE):
    """(doc, slot, place): all rows of `docs` as structs, sorted by slot and place across partitions.

    A partition holds the rows between two slots. Which row opens a source's share of it is known from
    the numbered keys, so each row finds its partition by its own key: rows are exchanged once, neither
    joined with their places nor sampled, and numbered there by a window, without a Python worker. `docs`
    is read twice, and rows that repeat a doc_id must then stand in the same order, as those of a stored
    table do. Other options, nulls, repeated rows and empty tables as in `mix`; columns of any names come
    along.
    """
    spark = docs.sparkSession
    rows = keyed(docs, F.col("doc_id").cast("long").alias("doc_id"))
    counted = stored(numbered(rows), "mix-rows")
    sizes, parts, period = _planned(counted, weights, period, temperature)
    whole = F.struct("*").alias("doc")
    if not parts:
        nothing = F.lit(0).cast("long")
        return docs.select(whole, nothing.alias("slot"), nothing.alias("place"))
    slots = _Slots(sizes, parts, period, block)
    count = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(1, BOUNDS // len(parts)))
    starts = np.array([[0] * len(parts), *slots.bounds(count)]).T.tolist()
    # Both tables are bounded by BOUNDS.
    openers = spark.createDataFrame(
        [(s, i, n) for s, ns in zip(slots.names, starts, strict=True)
         for i, n in enumerate(ns) if i and n < sizes[s]],
        "s string, i int, n long",
    )
    first = (F.col("source").eqNullSafe(F.col("s"))) & (F.col("number") == F.col("n"))
    keys = counted.join(F.broadcast(openers), first).groupBy("source").agg(
        F.sort_array(F.collect_list(F.struct("i", F.struct("k", "t").alias("key")))).alias("keys")
    )
    known = spark.createDataFrame(list(zip(slots.names, starts, strict=True)), "s string, starts array<long>")
    limits = known.join(keys, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "s", "starts", F.col("keys.key").alias("keys")
    )
    # A binary search for the last partition whose first key of the source is not above the row's.
    bits = F.array(*[F.lit(1 << b) for b in reversed(range(count.bit_length()))])

    def step(low, bit):
        there = F.get("keys", low + bit - 1) <= F.struct("k", "t")
        return F.when(F.coalesce(there, F.lit(False)), low + bit).otherwise(low)

    found = keyed(docs, whole).join(F.broadcast(limits), F.col("source").eqNullSafe(F.col("s")))
    found = found.withColumn("i", F.aggregate(bits, F.lit(0), step))
    dealt = found.select("doc", "source", "k", "t", "i", F.get("starts", "i").alias("start"))
    # The window takes the exchange by `i` for its own, as its groups lie within these partitions.
    within = Window.partitionBy("i", "source").orderBy("k", "t")
    ranked = dealt.repartitionById(count, "i").select(
        "doc", "source", (F.col("start") + F.row_number().over(within) - 1).alias("number")
    )
    # One row per source with its slots in a period, of which each row takes one.
    table = spark.createDataFrame([(s, slots.at[s].tolist()) for s in slots.names], "s string, at array<long>")
    turn = whole_div("number", block)
    rounds, at = whole_div(turn, F.size("at")), F.get("at", (turn % F.size("at")).cast("int"))
    located = ranked.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("s"))).select(
        "doc", (rounds * period + at).alias("slot"), (F.col("number") % block).alias("place")
    )
    return located.sortWithinPartitions("slot", "place")


def in_mixed_order(docs, **options):
    """All rows of `docs` with their columns, sorted by slot and place across partitions, so that
    files written from it hold the mixture in order. See `placed`."""
    return placed(docs, **options).select("doc.*")
