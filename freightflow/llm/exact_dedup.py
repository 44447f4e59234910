"""Exact deduplication by composable polynomial fingerprints.

A text is the polynomial of its UTF-8 bytes modulo two primes. Chunk hashes combine by
H(ab) = H(a) * B^|b| + H(b), so the pieces of a huge document are hashed by different tasks and
summed with the shift that the bytes behind them ask for. Rows of equal fingerprint and length are
then compared chunk by chunk: each chunk is a grouping key, so equal chunks collapse in the map
task, and a chunk with two contents exposes a collision.
"""

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import map_arrow, small_side, stored, whole_text

#: The two largest primes below 2^31, and a base for each.
MODULI = (2147483647, 2147483629)
BASES = (911382323, 972663749)
CHUNK = 1 << 16
#: A text beyond this many bytes is hashed in pieces of this size by several tasks.
PIECE = 8 << 20


@cache
def _powers(base, modulus):
    """B^(CHUNK-1) ... B^0."""
    out = np.ones(CHUNK, np.uint64)
    for i in range(1, CHUNK):
        out[i] = int(out[i - 1]) * base % modulus
    return out[::-1].copy()


def polynomial(data, moduli=MODULI):
    """The hashes of `data` (bytes) modulo each prime, combined from its chunks."""
    values = np.frombuffer(data, np.uint8)
    out = []
    for base, modulus in zip(BASES, moduli, strict=True):
        powers, total = _powers(base, modulus), 0
        for at in range(0, len(values), CHUNK):
            chunk = values[at : at + CHUNK].astype(np.uint64)
            # bytes below 2^8, powers below 2^31 and 2^16 terms: the sum stays below 2^55
            part = int(np.dot(chunk, powers[CHUNK - len(chunk) :])) % modulus
            total = (total * pow(base, len(chunk), modulus) + part) % modulus
        out.append(total)
    return out


def _hash_rows(moduli):
    """(row columns ..., data, behind) to (row columns ..., h1, h2): each hash is shifted over
    the `behind` bytes that follow the piece in its text."""

    def run(batches):
        for batch in batches:
            rest = [n for n in batch.schema.names if n not in ("data", "behind")]
            hashes = [[], []]
            for data, behind in zip(batch["data"], batch["behind"], strict=True):
                for i, h in enumerate(polynomial(data.as_buffer(), moduli)):
                    shift = pow(BASES[i], behind.as_py(), moduli[i])
                    hashes[i].append(h * shift % moduli[i])
            columns = [batch[n] for n in rest] + [pa.array(h, pa.int64()) for h in hashes]
            yield pa.RecordBatch.from_arrays(columns, [*rest, "h1", "h2"])

    return run


def fingerprints(docs, moduli=MODULI, piece=PIECE):
    """(doc_id, sha, h, n) per row: SHA-256, fingerprint and length in bytes of the whole text."""
    data = whole_text().cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), data.alias("data"),
        F.octet_length(data).cast("long").alias("n"),
        F.unhex(F.sha2(data, 256)).alias("sha"),
    )
    schema = "doc_id long, sha binary, n long, h1 long, h2 long"
    plain = rows.where(F.col("n") <= piece).withColumn("behind", F.lit(0).cast("long"))
    plain = plain.select("doc_id", "sha", "n", "data", "behind")
    plain = map_arrow(plain, _hash_rows(moduli), schema)

    numbered = rows.where(F.col("n") > piece).withColumn("row", F.monotonically_increasing_id())
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {piece}")))
    start = F.col("part") * piece
    pieces = numbered.withColumn("part", part).select(
        "row", "doc_id", "sha", "n", "part",
        F.substring("data", (start + 1).cast("int"), F.lit(piece)).alias("data"),
        F.greatest(F.col("n") - start - piece, F.lit(0)).alias("behind"),
    )
    keys = ["row", "doc_id", "sha", "n"]
    spread = pieces.repartition("row", "part").select(*keys, "data", "behind")
    summed = (
        map_arrow(spread, _hash_rows(moduli), "row long, " + schema)
        .groupBy(*keys)
        .agg(*[(F.sum(c) % m).alias(c) for c, m in zip(("h1", "h2"), moduli, strict=True)])
    )
    both = plain.unionByName(summed.drop("row"))
    return both.select("doc_id", "sha", F.expr("shiftleft(h1, 31) | h2").alias("h"), "n")


def collisions(docs, prints):
    """The (h, n) under which different texts meet, found by comparing chunks.

    Only rows whose fingerprint occurs twice are read again.
    """
    counted = prints.groupBy("h", "n").count()
    shared = stored(counted.where("count > 1").drop("count"), "exact-shared")
    repeated = stored(prints.join(small_side(shared), ["h", "n"], "left_semi"), "exact-repeated")
    suspects = stored(repeated.distinct().withColumnRenamed("doc_id", "id"), "exact-suspects")
    data = whole_text().cast("binary")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), data.alias("data"))
    found = texts.join(
        small_side(suspects),
        F.col("doc_id").eqNullSafe(F.col("id")) & (F.unhex(F.sha2("data", 256)) == F.col("sha")),
    )
    number = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"greatest(n - 1, 0) div {CHUNK}")))
    chunk = F.substring("data", (F.col("i") * CHUNK + 1).cast("int"), F.lit(CHUNK))
    chunks = found.withColumn("i", number).select("h", "n", "i", chunk.alias("chunk")).distinct()
    return chunks.groupBy("h", "n", "i").count().where("count > 1").select("h", "n").distinct()


def copy_groups(docs, moduli=MODULI, piece=PIECE):
    """One row per document: doc_id, keep_id, group_size, kept, sha.

    Texts are equal when identical; null is the empty text. The row with the largest doc_id
    stays; a null doc_id is smaller than any other. Rows that repeat both doc_id and text count
    each, and one of them stays. An empty table gives an empty result. Columns other than doc_id
    and text are not read.
    """
    prints = stored(fingerprints(docs, moduli, piece), "exact-prints")
    clash = stored(collisions(docs, prints), "exact-collisions")
    # A fingerprint under which texts differ is told apart by SHA-256; nearly always there is none.
    marked = prints.withColumn("clash", F.lit(False))
    if not clash.isEmpty():
        met = small_side(clash.withColumn("clash", F.lit(True)))
        marked = stored(prints.join(met, ["h", "n"], "left"), "exact-marked")
    variant = F.when(F.col("clash"), F.col("sha")).otherwise(F.unhex(F.lit("")))
    rows = stored(
        marked.withColumn("v", variant).groupBy("h", "n", "v", "doc_id", "sha")
        .agg(F.count("*").alias("rows")),
        "exact-rows",
    )
    groups = stored(
        rows.groupBy("h", "n", "v").agg(
            F.max("doc_id").alias("keep_id"), F.sum("rows").alias("group_size")
        ),
        "exact-groups",
    )
    # Groups hold one row per key, so a hot group is split on the side of the rows.
    joined = rows.join(groups, ["h", "n", "v"])
    each = joined.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return each.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("i") == 1)).alias("kept"),
        "sha",
    )


def drop_copies(docs):
    """The rows of `docs` that stay, with all their columns. See `copy_groups`."""
    groups = copy_groups(docs).select(
        F.col("doc_id").alias("_ff_id"), F.col("sha").alias("_ff_sha"), "kept"
    )
    verdicts = stored(
        groups.groupBy("_ff_id", "_ff_sha")
        .agg(F.max("kept").alias("kept"), F.count("*").alias("rows")).where("NOT kept OR rows > 1"),
        "exact-verdicts",
    )

    def same_row(found):
        sha = F.unhex(F.sha2(F.coalesce(docs["text"], F.lit("")).cast("binary"), 256))
        return docs["doc_id"].cast("long").eqNullSafe(found["_ff_id"]) & (sha == found["_ff_sha"])

    gone = verdicts.select("_ff_id", "_ff_sha")
    left = docs.join(small_side(gone), same_row(gone), "left_anti")
    repeated = verdicts.where("kept").select("_ff_id", "_ff_sha")
    if repeated.isEmpty():
        return left
    once = docs.join(small_side(repeated), same_row(repeated), "left_semi")
    return left.unionByName(once.dropDuplicates(["doc_id", "text"]))
