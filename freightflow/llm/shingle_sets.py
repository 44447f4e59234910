"""Links between texts whose sets of word shingles have a Jaccard similarity of at least a bound.

At similarity 0.8 two SimHash fingerprints of any width differ in about 15 of 100 bits, so that
hardly any run of bytes is shared and an inverted index over them either misses pairs or holds
very long lists. Candidates are therefore found by minima: under one order of the shingles two sets
have the same least shingle with the probability of their similarity. BANDS keys of ROWS minima
each miss a pair at 0.8 with probability (1 - 0.8^6)^32, below 0.0001, and fewer above. The texts
that the SimHash index groups (`simhash_dedup.print_lists`) are candidates besides.

All links are verified by the whole sets, and only verified links connect. First every text of a
list (the texts of one key or of one SimHash group) meets the centre of the list, ROUNDS times with other centres. Lists
whose texts are connected then are done. In the others the largest connected part is not compared
within itself: only the rest of the list is, with it and among itself, in pairs of blocks.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from .common import map_arrow, send_package, small_side, stored
from .components import components

BANDS, ROWS = 32, 6
#: Texts and shingles of a block; lists beyond are compared in pairs of blocks.
BLOCK, BLOCK_SHINGLES = 256, 1 << 20
#: How often the texts of a list meet its centre before the rest is compared in blocks.
ROUNDS = 2
#: Shingles whose minima are taken at once.
SLICE = 1024
_ODD = np.random.default_rng(42).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.random.default_rng(43).integers(0, 1 << 63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text, width):
    """The sorted distinct XXH64 values (seed 42) of the shingles of a text (str or None).

    Words are those of `simhash_dedup.simhash`. Fewer words than a shingle are one shingle; no
    words give the empty set.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII case and space
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    width = min(width, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array(
        [digest(joined[a:b], 42) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)],
        np.uint64,
    ))


def set_name(hashes):
    """A number for the set, as a signed long; the empty set is zero."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), 7)).view(np.int64)) if len(hashes) else 0


def band_keys(hashes):
    """BANDS signed longs, each over ROWS minima; none for the empty set."""
    if not len(hashes):
        return np.empty(0, np.int64)
    least = np.full(len(_ODD), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), SLICE):
        np.minimum(least, (_ODD[:, None] * hashes[at : at + SLICE]).min(axis=1), out=least)
    keys = (least.reshape(BANDS, ROWS) * _MIX).sum(axis=1, dtype=np.uint64)
    keys ^= keys >> np.uint64(31)
    return (keys * _MIX[:, 0] + _MIX[:, 1]).view(np.int64)


def _set_rows(width, simhash):
    def run(batches):
        for batch in batches:
            sets = [shingle_set(t.as_py(), width) for t in batch["text"]]
            prints = np.array([simhash(t.as_py()) for t in batch["text"]], np.uint64).view(np.int64)
            bands = [band_keys(x) for x in sets]
            offsets = pa.array(np.cumsum([0, *map(len, bands)]), pa.int32())
            flat = pa.array(np.concatenate([np.empty(0, np.int64), *bands]), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([set_name(x) for x in sets], pa.int64()),
                 pa.array([len(x) for x in sets], pa.int64()), pa.ListArray.from_arrays(offsets, flat),
                 pa.array(prints)],
                ["doc_id", "fp", "size", "bands", "print"],
            )

    return run


def set_rows(docs, width, simhash):
    """(doc_id, fp, size, bands, print) per row; fp names the shingle set, size counts its shingles,
    and print is the fingerprint that the function `simhash` gives the text, as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, fp long, size long, bands array<long>, print long"
    return map_arrow(rows, _set_rows(width, simhash), schema)


def _members(width):
    def run(batches):
        for batch in batches:
            for text in batch["text"]:
                x = shingle_set(text.as_py(), width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_name(x)], pa.int64()), pa.array([x.tobytes()], pa.binary())],
                    ["fp", "hashes"],
                )

    return run


def linked(sets, similarity, block, within, labels=None):
    """Pairs (i, j) that connect the sets which link; pairs connected already, as those of equal
    `labels`, are not compared.

    Sets of different `block` only are compared unless `within`.
    """
    sizes = np.array([len(x) for x in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(ids, kind="stable")
    holders, starts = owner[order], np.concatenate([[0], np.cumsum(np.bincount(ids))])
    at, out = np.concatenate([[0], np.cumsum(sizes)]), []
    label = np.arange(len(sets)) if labels is None else np.unique(labels, return_inverse=True)[1]
    for i in range(len(sets)):
        other = label != label[i]
        other[: i + 1] = False
        other &= np.minimum(sizes, sizes[i]) >= similarity * np.maximum(sizes, sizes[i]) - 1e-6
        if not within:
            other &= block != block[i]
        if not other.any():
            continue
        mine = ids[at[i] : at[i + 1]]
        shared = np.bincount(
            np.concatenate([holders[starts[x] : starts[x + 1]] for x in mine.tolist()]), minlength=len(sets)
        )
        other &= shared >= similarity * (sizes + sizes[i] - shared) - 1e-6
        for j in np.flatnonzero(other).tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                out.append((i, j))
    return out


def _compare(similarity):
    def run(table):
        # The centre, or the block with the smaller part of the list, comes first.
        table = table.sort_by([("block", "ascending"), ("fp", "ascending")])
        names, block, roots = (table[c].to_numpy() for c in ("fp", "block", "root"))
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["hashes"]]
        within = table["i"][0].as_py() == table["j"][0].as_py()
        pairs = linked(sets, similarity, block, within, roots) if len(sets) > 1 else []
        a, b = np.array(pairs, np.int64).reshape(-1, 2).T
        return pa.table({"a": pa.array(names[a], pa.int64()), "b": pa.array(names[b], pa.int64())})

    return run


def _compared(work, sets, similarity):
    """(a, b): verified links of `work`, stored rows (key, i, j, block, fp, root): the sets of one
    (key, i, j) are compared, across blocks, or within the block if i = j."""
    named = stored(work.select("fp").distinct(), "sets-named")
    # Texts with one set twice are rare; the set is taken once.
    known = sets.join(small_side(named), "fp", "left_semi").groupBy("fp").agg(F.first("hashes").alias("hashes"))
    return known.join(work, "fp").groupBy("key", "i", "j").applyInArrow(
        _compare(similarity), "a long, b long"
    )


def _with_roots(lists, edges):
    """`lists` with the root that each set has under `edges`; a set without edges is its own."""
    if edges is None:
        return lists.withColumn("root", F.col("fp"))
    roots = stored(components(edges).withColumnRenamed("root", "_root"), "sets-roots")
    joined = lists.join(small_side(roots), F.col("fp") == F.col("vertex"), "left")
    return joined.select(*lists.columns, F.coalesce("_root", "fp").alias("root"))


def _unconnected(rooted, *more):
    """Per key whose sets have several roots: key and the aggregates `more`."""
    keys = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), *more)
    return stored(keys.where("low <> high").drop("low", "high"), "sets-keys")


def _blocks(block):
    """How many blocks the rows of a group need, by their number and by their shingles."""
    return F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int")


def _stars(lists, edges, similarity, block, number):
    """Work in which every set meets one centre: of the lists it is in whose centre has another root
    and a size that allows a link. Each centre is repeated for every block of its sets."""
    rooted = _with_roots(lists, edges)
    order = F.xxhash64("fp", F.lit(number))
    centre = F.min_by(F.struct("fp", "root", "size"), order).alias("c")
    keys = _unconnected(rooted, centre)
    smaller, larger = F.least("size", "c.size"), F.greatest("size", "c.size")
    met = rooted.join(small_side(keys), "key").where(
        (F.col("root") != F.col("c.root")) & (smaller >= similarity * larger - 1e-6)
    )
    one = F.min_by("c", F.xxhash64("c.fp", F.lit(number))).alias("c")
    pairs = stored(met.groupBy("fp", "root", "size").agg(one), "sets-pairs")
    counts = stored(
        pairs.groupBy(F.col("c.fp").alias("key"), F.col("c.root").alias("centre_root")).agg(_blocks(block).alias("n")),
        "sets-centres",
    )
    slot = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    around = pairs.withColumn("key", F.col("c.fp")).join(small_side(counts), "key").select(
        "key", slot.alias("i"), F.lit(-1).alias("j"), F.lit(1).alias("block"), "fp", "root"
    )
    centres = counts.select(
        "key", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"), F.lit(-1).alias("j"),
        F.lit(0).alias("block"), F.col("key").alias("fp"), F.col("centre_root").alias("root"),
    )
    return stored(around.unionByName(centres), "sets-work")


def _rest(lists, edges, block):
    """Work in which the sets of each list that are outside its largest connected part meet each
    other and that part, in pairs of blocks."""
    rooted = stored(_with_roots(lists, edges), "sets-rooted")
    keys = _unconnected(rooted)
    open_lists = rooted.join(small_side(keys), "key")
    # Texts that share several keys make lists of the same texts, of which one is enough.
    same = [F.count("*").alias("m"), *(F.bit_xor(F.xxhash64("fp", F.lit(n))).alias(f"x{n}") for n in range(2))]
    alike = stored(open_lists.groupBy("key").agg(*same), "sets-alike")
    keys = stored(alike.groupBy("m", "x0", "x1").agg(F.min("key").alias("key")).select("key"), "sets-keys")
    open_lists = stored(rooted.join(small_side(keys), "key"), "sets-open")
    parts = open_lists.groupBy("key", "root").agg(F.count("*").alias("m"))
    largest = stored(
        parts.groupBy("key").agg(F.max(F.struct("m", "root"))["root"].alias("bulk")), "sets-bulk"
    )
    sides = stored(
        open_lists.join(small_side(largest), "key")
        .withColumn("rest", F.col("root") != F.col("bulk")).drop("bulk"),
        "sets-sides",
    )
    counts = sides.groupBy("key", "rest").agg(_blocks(block).alias("n"))
    counts = stored(counts.join(open_lists.groupBy("key").agg(_blocks(block).alias("all")), "key")
    .groupBy("key").agg(
        F.max("all").alias("all"), F.max(F.when(F.col("rest"), F.col("n"))).alias("small"),
        F.max(F.when(~F.col("rest"), F.col("n"))).alias("large"),
    ), "sets-blocks")
    # Blocks from 0 hold the rest, those from `small` the largest part.
    number = F.when(
        F.col("rest"), F.pmod(F.xxhash64("fp"), F.col("small"))
    ).otherwise(F.col("small") + F.pmod(F.xxhash64("fp"), F.col("large"))).cast("int")
    last = F.when(F.col("rest"), F.col("small") + F.col("large")).otherwise(F.col("small")) - 1
    # A list that fits one block is compared at once.
    number, last = (F.when(F.col("all") > 1, x).otherwise(F.lit(0)) for x in (number, last))
    work = sides.join(small_side(counts), "key").withColumn("block", number)
    work = work.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return stored(work.select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "fp", "root",
    ), "sets-work")


def links(docs, rows, more, width, similarity, block=BLOCK):
    """(a, b): edges between the sets of `docs` which link, enough to connect them.

    `rows` are the stored `set_rows` of docs, `more` further lists of candidates: (key, fp, size).
    """
    distinct = stored(rows.where("size > 0").groupBy("fp").agg(
        F.min("doc_id").alias("first"), F.max("size").alias("size"), F.first("bands").alias("bands")
    ), "sets-distinct")
    banded = distinct.select(F.explode("bands").alias("key"), "fp", "size")
    entries = stored(banded.unionByName(more), "sets-entries")
    several = stored(
        entries.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
        .where("low <> high").select("key"),
        "sets-several",
    )
    lists = stored(entries.join(small_side(several), "key"), "sets-lists")
    # One text of each set of a list is read again for its shingles.
    near = stored(lists.select("fp").distinct(), "sets-near")
    ids = stored(
        distinct.join(small_side(near), "fp", "left_semi").select(F.col("first").alias("_ff_id")).distinct(),
        "sets-ids",
    )
    same = docs["doc_id"].cast("long").eqNullSafe(ids["_ff_id"])
    texts = docs.join(small_side(ids), same, "left_semi").select("text")
    sets = stored(map_arrow(texts, _members(width), "fp long, hashes binary"), "sets-members")
    send_package(docs.sparkSession)
    edges = None
    for number in range(ROUNDS):
        work = _stars(lists, edges, similarity, block, number)
        if edges is not None and work.isEmpty():
            break
        found = stored(_compared(work, sets, similarity), "sets-links")
        edges = found if edges is None else edges.unionByName(found)
    rest = stored(_compared(_rest(lists, edges, block), sets, similarity), "sets-links")
    return edges.unionByName(rest)
