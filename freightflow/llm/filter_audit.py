"""How filters interact: what each removes in every order in which they could be applied.

Words are encoded by one dictionary of the whole corpus, and the documents become shards of a sparse
document-term matrix in compressed rows. Row sums are the words of a document and nonzero cells its
distinct words, which decide the filters of length and repetition; the other flags are attached to the
rows. A document then is the set of filters that it fails, and all orders follow from the number of
documents with each set.
"""

import hashlib
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from . import shards
from .common import map_arrow, small_side, stored, text_batches, whole_text

FILTERS = "ABCDE"
#: A: words at least. B: distinct words of a hundred at least. C: capitals of a hundred characters at most.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2
SYMBOLS = r"[#$%&*|]"
#: Bytes of text in a shard.
SHARD_BYTES = 1 << 24
#: Bytes of text whose words are split at once.
SLICE_BYTES = 1 << 20

_LOCAL = (
    "shard long, doc_id long, part string, digest binary, points long, capitals long, symbols boolean, "
    "terms array<int>, counts array<int>, names array<string>"
)


def _capitals(texts):
    """Letters A to Z of each text."""
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if not len(texts) or data is None or at[0] == at[-1]:
        return np.zeros(len(texts), np.int64)
    flat = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    capital = (flat - np.uint8(65)) < 26
    out, some = np.zeros(len(texts), np.int64), np.flatnonzero(at[1:] > at[:-1])
    out[some] = np.add.reduceat(capital, at[some] - at[0], dtype=np.int64)
    return out


def _slices(texts, size):
    """(start, rows) of runs of neighbours with at most `size` bytes; a larger text stands alone."""
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    start = 0
    while start < len(texts):
        end = max(int(np.searchsorted(at, int(at[start]) + size, "right")) - 1, start + 1)
        yield start, end - start
        start = end


def _cells(texts):
    """(words, terms, counts, capitals): the distinct words of some texts, their nonzero cells, and the
    capitals of each text."""
    split = pc.ascii_split_whitespace(texts)
    words, owner = split.flatten(), pc.list_parent_indices(split)
    some = pc.greater(pc.binary_length(words), 0)
    coded, owner = words.filter(some).dictionary_encode(), owner.filter(some)
    terms, counts = shards.sparse(
        owner.to_numpy().astype(np.int64), coded.indices.to_numpy(), len(texts), len(coded.dictionary)
    )
    return coded.dictionary, terms, counts, _capitals(texts)


def _shard(rows, number):
    """The rows of a shard, and one more with its vocabulary.

    The occurrences of a few texts are held at once; of the others their cells alone.
    """
    texts = rows["text"].combine_chunks()
    found = [_cells(texts.slice(*s)) for s in _slices(texts, SLICE_BYTES)]
    words, terms, counts, capitals = zip(*found, strict=True)
    coded = pa.concat_arrays(words).dictionary_encode()
    place, before = coded.indices, np.cumsum([0, *map(len, words)]).tolist()
    terms = [
        pa.ListArray.from_arrays(t.offsets, place.slice(a, len(w)).take(t.values))
        for t, w, a in zip(terms, words, before, strict=False)
    ]
    digests = [hashlib.sha256(t.as_buffer()).digest() for t in texts]
    columns = [
        pa.array(np.full(len(texts), number)), rows["doc_id"].combine_chunks(),
        rows["part"].combine_chunks(), pa.array(digests, pa.binary()),
        pc.utf8_length(texts).cast(pa.int64()), pa.array(np.concatenate(capitals)),
        pc.match_substring_regex(texts, SYMBOLS), pa.concat_arrays(terms), pa.concat_arrays(counts),
        pa.nulls(len(texts), pa.list_(pa.string())),
    ]
    fields = ["shard", "doc_id", "part", "digest", "points", "capitals", "symbols", "terms", "counts", "names"]
    out = pa.RecordBatch.from_arrays(columns, fields)
    yield out
    listed = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
    empty = [pa.array([number])] + [pa.nulls(1, f.type) for f in out.schema][1:-1]
    yield pa.RecordBatch.from_arrays([*empty, listed], fields)


def _local_shards(size):
    def run(batches):
        base = None

        def seen():
            nonlocal base
            for batch in batches:
                if base is None and len(batch):
                    base = batch["p"][0].as_py() << 32
                yield batch

        for i, rows in enumerate(shards.cut(seen(), "text", size)):
            yield from _shard(rows, base + i)

    return run


def _ranked(batches):
    """Rows sorted by word get the number of distinct words before theirs; the word stays at its first."""
    before, rank = None, -1
    for batch in batches:
        if not len(batch):
            continue
        words = batch["name"]
        new = np.ones(len(words), bool)
        new[1:] = pc.not_equal(words.slice(1), words.slice(0, len(words) - 1)).to_numpy(zero_copy_only=False)
        new[0] = before is None or words[0].as_py() != before
        ranks = rank + np.cumsum(new)
        before, rank = words[-1].as_py(), int(ranks[-1])
        first = pc.if_else(pa.array(new), words, pa.scalar(None, words.type))
        yield pa.RecordBatch.from_arrays(
            [batch["p"], batch["shard"], batch["place"], pa.array(ranks), first],
            ["p", "shard", "place", "rank", "word"],
        )


def _encoded(local):
    """(shard, place, value, word): the number that every word of a shard has in the whole corpus, dense
    from 0 on; `word` stands at one row of each number."""
    spread = shards.names(local).repartition("name").sortWithinPartitions("name", "shard")
    spread = spread.select("name", "shard", "place", F.spark_partition_id().alias("p"))
    ranked = stored(
        map_arrow(spread, _ranked, "p int, shard long, place int, rank long, word string"), "audit-words"
    )
    # One row per partition of the sort.
    sizes = ranked.groupBy("p").agg((F.max("rank") + 1).alias("words"))
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("p").alias("_p"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start")
    )
    joined = ranked.join(F.broadcast(starts), F.col("p") == F.col("_p"))
    return joined.select("shard", "place", (F.col("start") + F.col("rank")).alias("value"), "word")


def matrix(docs, part="source", size=SHARD_BYTES):
    """(rows, words): the document-term matrix and its dictionary.

    `rows` has one row per document: shard, doc_id, part, the SHA-256 of the text, points (its code
    points), capitals, symbols (whether it has any), and the nonzero cells as `terms`, numbers of the
    dictionary, and `counts`. `words` is (value, word). Words are what stands between ASCII white space,
    in their case. Null texts are empty and have no cells, a null part is the empty string.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        whole_text().alias("text"), F.spark_partition_id().alias("p"),
    )
    with text_batches(docs.sparkSession):
        local = stored(map_arrow(rows, _local_shards(size), _LOCAL), "audit-shards")
    encoded = _encoded(local)
    return shards.with_values(local, encoded, "bigint"), encoded.where("word IS NOT NULL").select("value", "word")


def failures(docs, part="source"):
    """One row per document: doc_id, part, and `mask`, whose bit i says that it fails filter i of FILTERS.

    E, a text that a smaller doc_id has: a null doc_id is neither smaller nor has any smaller one, and
    rows that repeat a doc_id with its text do not fail by each other.
    """
    rows, _ = matrix(docs, part)
    words = F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n)
    counted = stored(
        rows.select("doc_id", "part", "digest", "points", "capitals", "symbols", words.alias("words"),
                    F.size("terms").cast("long").alias("distinct")),
        "audit-rows",
    )
    copies = counted.groupBy(F.col("digest").alias("_digest")).agg(
        F.min("doc_id").alias("first"), F.count("*").alias("n")
    )
    copies = stored(copies.where("n > 1").drop("n"), "audit-copies")
    joined = counted.join(small_side(copies), F.col("digest") == F.col("_digest"), "left")
    fails = [
        F.col("words") < LEAST_WORDS,
        100 * F.col("distinct") < LEAST_DISTINCT * F.col("words"),
        100 * F.col("capitals") > MOST_CAPITALS * F.col("points"),
        F.col("symbols"),
        F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False)),
    ]
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    return joined.select("doc_id", "part", mask.alias("mask"))


def _label_flags(labels):
    """(doc_id, good, toxic) of the documents that any label calls so."""
    def any_one(name):
        return F.max(F.when(F.col(name) == 1, 1).otherwise(0)).alias(name)

    flags = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        any_one("quality"), any_one("toxic")
    )
    return flags.where("quality = 1 OR toxic = 1")


def audit(docs, labels, part="source"):
    """One row per part, order of the filters and step: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley.

    `kept` counts the documents left after the step, `removed` those that go in it, `redundant` those
    that fail its filter and went before, `unique_fails` those that fail its filter only. good_lost and
    toxic_lost are those of the removed that a label (doc_id, quality, toxic) calls so. `shapley` sums
    what its filter removes over all orders. An empty table has no parts and gives no rows. A document
    with a null doc_id has no label; one with several labels is good or toxic if any says so. Other
    columns are not read.
    """
    spark = docs.sparkSession
    flags = stored(_label_flags(labels), "audit-labels")
    failed = stored(failures(docs, part), "audit-failures")
    joined = failed.join(small_side(flags), F.col("doc_id") == F.col("_id"), "left")
    one = F.lit(1).cast("long")
    sets = joined.groupBy("part", "mask").agg(
        F.count("*").alias("n"),
        F.sum(F.when(F.col("quality") == 1, one).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic") == 1, one).otherwise(0)).alias("bad"),
    )
    # Every filter behind every set of filters before it: 5 * 16 cases.
    full = (1 << len(FILTERS)) - 1
    cases = [
        F.struct(F.lit(s).alias("prior"), F.lit(1 << f).alias("own"))
        for f in range(len(FILTERS)) for s in range(full + 1) if not s >> f & 1
    ]
    each = sets.select("*", F.inline(F.array(*cases)))
    has, gone = F.expr("mask & own") != 0, F.expr("mask & prior") != 0

    def total(name, condition):
        return F.sum(F.when(condition, F.col(name)).otherwise(0))

    by_case = each.groupBy("part", "prior", "own").agg(
        total("n", ~has & ~gone).alias("kept"), total("n", has & ~gone).alias("removed"),
        total("n", has & gone).alias("redundant"),
        total("n", F.col("mask") == F.col("own")).alias("unique_fails"),
        total("good", has & ~gone).alias("good_lost"), total("bad", has & ~gone).alias("toxic_lost"),
    )
    weights = [factorial(k) * factorial(len(FILTERS) - 1 - k) for k in range(len(FILTERS))]
    orders = F.get(F.array(*map(F.lit, weights)), F.bit_count("prior"))
    same = Window.partitionBy("part", "own")
    shared = by_case.withColumn("shapley", F.sum(F.col("removed") * orders).over(same))
    # Every step of the 120 orders: 600 rows.
    steps = [
        ("".join(FILTERS[f] for f in p), i + 1, sum(1 << f for f in p[:i]), 1 << p[i])
        for p in permutations(range(len(FILTERS))) for i in range(len(FILTERS))
    ]
    table = spark.createDataFrame(steps, "filter_order string, step int, _prior int, _own int")
    matches = (F.col("prior") == F.col("_prior")) & (F.col("own") == F.col("_own"))
    return shared.join(F.broadcast(table), matches).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
        "toxic_lost", "shapley",
    )
