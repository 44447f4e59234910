"""Near-deduplication by SimHash with an inverted index over byte positions.

A fingerprint has eight positional bytes. Three differing bits touch at most three of them, so
linked fingerprints share at least five positional bytes. A posting list of one byte would hold a
256th of all fingerprints and its pairs would grow with the square of the corpus. The index is
therefore keyed by sets of four positional bytes, chosen so that any five positions contain one of
the sets: each pair that can reach the minimum meets in some list, and lists are 2^32 times
shorter. Pairs of a list have their shared positional bytes counted, those with fewer than five
are dropped, and the rest are verified by their differing bits.
"""

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from . import shingle_sets
from .common import map_arrow, small_side, stored
from .components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
MIN_SHARED = 8 - MAX_BITS
#: Posting lists longer than this are compared in pairs of blocks by several tasks.
BLOCK = 1024
#: Links of a batch that are held before they are reduced to stars.
PAIRS = 1 << 20
#: Hashes whose bits are counted at once.
HASHES = 1 << 16


def _cover():
    """Sets of four of eight positions such that any five positions contain one of them.

    Split the positions in two halves and each half's pairs in three matchings. Of five positions
    either four fill a half, or three lie in one half and two in the other; the two are a pair of
    some matching, and the three contain a pair of the same matching of their half.
    """
    matchings = [[(0, 1), (2, 3)], [(0, 2), (1, 3)], [(0, 3), (1, 2)]]
    sets = [(0, 1, 2, 3), (4, 5, 6, 7)]
    for pairs in matchings:
        sets += [(*p, *(x + 4 for x in q)) for p, q in product(pairs, pairs)]
    return sets


COVER = _cover()


def simhash(text):
    """The fingerprint of a text (str or None) as an unsigned integer.

    Each bit is set when it is set in over half of the XXH64 values (seed 42) of the shingles,
    repeats included. Fewer words than a shingle are one shingle; no words give zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII case and space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    width = min(SHINGLE_WORDS, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - width + 1].tolist()
    stops = ends[width - 1 :].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), HASHES):
        hashes = np.array(
            [digest(joined[a:b], 42)
             for a, b in zip(starts[at : at + HASHES], stops[at : at + HASHES], strict=True)],
            "<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > len(starts)).tolist()))


def _fingerprint_rows(batches):
    for batch in batches:
        values = [simhash(t.as_py()) for t in batch["text"]]
        prints = np.array(values, np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(prints)], ["doc_id", "fp"])


def fingerprints(docs):
    """(doc_id, fp) per row; fp holds the 64 bits as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(rows, _fingerprint_rows, "doc_id long, fp long")


def postings(prints):
    """(s, key, fp): one row per fingerprint and covering set of positions."""
    def byte(i):
        return F.expr(f"shiftrightunsigned(fp, {8 * i}) & 255")

    keys = [
        F.struct(
            F.lit(s).alias("s"),
            sum((byte(i) * (1 << (8 * at)) for at, i in enumerate(positions)), F.lit(0))
            .cast("long").alias("key"),
        )
        for s, positions in enumerate(COVER)
    ]
    return prints.select("fp", F.inline(F.array(*keys))).select("s", "key", "fp")


def _linked(a, b, s):
    """Which pairs of fingerprints link and have set `s` as the first one they share."""
    differing = a ^ b
    same = differing[:, None].view(np.uint8).reshape(-1, 8) == 0
    out = same.sum(axis=1) >= MIN_SHARED
    out[out] = np.bitwise_count(differing[out]) <= MAX_BITS
    # A pair meets in every list of a set it shares; it counts in the first of them only.
    for k, positions in enumerate(COVER):
        live = np.flatnonzero(out)
        if not len(live):
            break
        out[live[(s[live] > k) & same[live][:, positions].all(axis=1)]] = False
    return out


def _labels(size, left, right):
    """The least member of each vertex's component under the links left[i]-right[i]."""
    label = np.arange(size)
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _link_lists(batches):
    """Rows sorted by list (s, key, i, j) to the edges of each list.

    A list is compared against itself when i = j, else its rows of block i against those of j.
    Rows of a list are compared at growing distance, so all short lists of a batch go together.
    """
    held = None
    names = ("s", "key", "i", "j", "block", "fp")

    def edges(rows):
        ids = np.zeros(len(rows["s"]), np.int64)
        if len(ids) < 2:
            return None
        change = np.zeros(len(ids) - 1, bool)
        for n in ("s", "key", "i", "j"):
            change |= rows[n][1:] != rows[n][:-1]
        ids[1:] = np.cumsum(change)
        sizes = np.bincount(ids)
        rest = np.flatnonzero(sizes[ids] > 1)
        last = np.concatenate([np.flatnonzero(change), [len(ids) - 1]])[ids]
        fp, block, s = rows["fp"].view(np.uint64), rows["block"], rows["s"]
        within = rows["i"] == rows["j"]
        lefts, rights, step = [], [], 1
        while len(rest := rest[rest + step <= last[rest]]):
            there = rest + step
            pairs = within[rest] | (block[rest] != block[there])
            a, b = rest[pairs], there[pairs]
            good = _linked(fp[a], fp[b], s[a])
            lefts.append(a[good])
            rights.append(b[good])
            step += 1
            if sum(map(len, lefts)) > PAIRS:  # only what they connect is needed from here on
                label = _labels(len(ids), np.concatenate(lefts), np.concatenate(rights))
                moved = np.flatnonzero(label != np.arange(len(ids)))
                lefts, rights = [moved], [label[moved]]
        if not lefts:
            return None
        a, b = np.concatenate(lefts), np.concatenate(rights)
        label = _labels(len(ids), a, b)
        moved = np.flatnonzero(label != np.arange(len(ids)))
        ends = [pa.array(rows["fp"][moved]), pa.array(rows["fp"][label[moved]])]
        return pa.RecordBatch.from_arrays(ends, ["a", "b"]) if len(moved) else None

    for batch in batches:
        rows = {n: batch[n].to_numpy(zero_copy_only=False) for n in names}
        if held is not None:
            rows = {n: np.concatenate([held[n], rows[n]]) for n in names}
        size = len(rows["s"])
        if not size:
            continue
        tail = np.ones(size, bool)
        for n in ("s", "key", "i", "j"):
            tail &= rows[n] == rows[n][-1]
        cut = size if not (~tail).any() else np.flatnonzero(~tail)[-1] + 1
        cut = 0 if cut == size else cut
        held = {n: v[cut:] for n, v in rows.items()}
        if cut and (out := edges({n: v[:cut] for n, v in rows.items()})) is not None:
            yield out
    if held is not None and (out := edges(held)) is not None:
        yield out


def links(prints, block=BLOCK):
    """(a, b): edges that connect the distinct fingerprints `prints` (fp) which link, directly or
    through others of a list; not every pair of a large group is given."""
    entries = stored(postings(prints), "simhash-postings")
    sizes = entries.groupBy("s", "key").agg(F.count("*").alias("m"))
    long_lists = stored(sizes.where(F.col("m") > block), "simhash-long-lists")
    zero = F.lit(0)
    if long_lists.isEmpty():
        work = entries.select("s", "key", zero.alias("i"), zero.alias("j"), zero.alias("block"), "fp")
    else:
        names = ["s", "key"]
        work = entries.join(long_lists, names, "left").withColumn(
            "blocks", F.coalesce(F.ceil(F.col("m") / block), F.lit(1)).cast("int")
        )
        work = work.withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        work = work.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        work = work.select(
            "s", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
            "block", "fp",
        )
    lists = ["s", "key", "i", "j"]
    # The first row of a list is the centre of its star: in the order of fp, a retried task agrees.
    grouped = work.repartition(*lists).sortWithinPartitions(*lists, "fp")
    return map_arrow(grouped, _link_lists, "a long, b long")


def print_lists(rows, block=BLOCK):
    """(key, fp, size) for each set of `rows`, stored `shingle_sets.set_rows`, that has shingles: sets of
    equal key have fingerprints which link, directly or through others."""
    sets = rows.where("size > 0").select("fp", "size", "print").distinct()
    sets = stored(sets, "simhash-sets")
    prints = stored(sets.select(F.col("print").alias("fp")).distinct(), "simhash-prints")
    roots = stored(components(links(prints, block)), "simhash-print-roots")
    joined = sets.join(small_side(roots), F.col("print") == F.col("vertex"), "left")
    return joined.select(F.coalesce("root", "print").alias("key"), "fp", "size").distinct()


def near_groups(docs, block=BLOCK, words=None, similarity=None):
    """One row per document: doc_id, fp, component_id, group_size.

    With `similarity`, texts link when their sets of shingles of `words` words have at least that
    Jaccard similarity, and fp names the set. Texts without words have the same set. Candidates are
    the texts whose fingerprints link and those that share minima of their sets; all are verified by
    the whole sets. Else, as follows.

    Fingerprints at three or fewer differing bits link; component_id is the smallest doc_id that
    is reachable, null only if no row reached has one. Texts without words, null included, have
    fingerprint zero and link like any other. Repeated rows count each. Other columns are not
    read.
    """
    if similarity is None:
        rows = stored(fingerprints(docs), "simhash-rows")
    else:
        rows = stored(shingle_sets.set_rows(docs, words, simhash), "simhash-rows")
    distinct = stored(
        rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")),
        "simhash-distinct",
    )
    if similarity is None:
        edges = links(distinct.select("fp"), block)
    else:
        alike = print_lists(rows, block)
        edges = shingle_sets.links(docs, rows, alike, words, similarity, min(block, shingle_sets.BLOCK))
    roots = components(edges)
    joined = distinct.join(roots, F.col("fp") == F.col("vertex"), "left")
    rooted = stored(
        joined.select("fp", "first", "n", F.coalesce("root", "fp").alias("root")), "simhash-roots"
    )
    groups = stored(
        rooted.groupBy("root").agg(
            F.min("first").alias("component_id"), F.sum("n").alias("group_size")
        ),
        "simhash-groups",
    )
    placed = stored(
        rooted.join(groups, "root").select("fp", "component_id", "group_size"), "simhash-placed"
    )
    return rows.join(placed, "fp").select("doc_id", "fp", "component_id", "group_size")


def keep_one(docs, words=None, similarity=None):
    """The rows of `docs` whose doc_id is the smallest of its group, with all their columns.

    Rows that share a doc_id stand or fall together: they stay if one of them stays.
    See `near_groups` for `words` and `similarity`.
    """
    stays = F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("stays")
    gone = stored(
        near_groups(docs, words=words, similarity=similarity).groupBy("doc_id").agg(stays).where("NOT stays")
        .select(F.col("doc_id").alias("_ff_id")),
        "simhash-gone",
    )
    same = docs["doc_id"].cast("long").eqNullSafe(gone["_ff_id"])
    return docs.join(small_side(gone), same, "left_anti")
