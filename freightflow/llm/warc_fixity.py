"""WARC archives and a Merkle audit of their replicas.

Pages are written as WARC shards. Reading a shard gives a leaf per record: its place and the hash
of its bytes. Groups of consecutive records hash into nodes that cover their offset range, level by
level up to one root a shard; consecutive shards hash on to one root of the archive. Two replicas
are compared from the root down: only children of nodes that differ are looked at.
"""

import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from ..session import work_folder
from .common import map_arrow, small_side, stored

FANOUT = 16
END = "\r\n\r\n"
#: Bytes of records that are handed on at once.
ROW_BYTES = 1 << 22
DATE = "2024-01-01T00:00:00Z"
#: The number of a shard: of its folder in a copy, else of the task that wrote it.
SHARD = re.compile(r"shard=(\d+)/|/part-(\d+)")
LENGTH = re.compile(rb"\r\nContent-Length: (\d+)\r\n")
PAGE = re.compile(rb"\r\nWARC-Page-Id: (-?\d+)\r\n")


def record(html="html", url="url", page_id="page_id", date=DATE):
    """A page as the text of a WARC record, without the empty lines that close it. Nulls are empty."""
    body, target = F.coalesce(F.col(html), F.lit("")), F.coalesce(F.col(url), F.lit(""))
    target = F.regexp_replace(target, "[\r\n]", " ")
    page = F.col(page_id).cast("string")
    key = F.md5(F.concat_ws("|", page, target, F.sha2(body, 256)))
    uuid = F.concat_ws("-", *[F.substring(key, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    lines = [
        F.lit("WARC/1.0"), F.lit("WARC-Type: resource"), F.concat(F.lit("WARC-Target-URI: "), target),
        F.lit(f"WARC-Date: {date}"), F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), uuid, F.lit(">")),
        F.concat(F.lit("WARC-Page-Id: "), page),  # null without a page_id, and then left out
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.sha2(body, 256)),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), body)


def write(pages, path):
    """Write shards in ascending page_id, one compressed file per task, and return `path`.

    Spark's text writer closes each record with the two line ends that the format asks for.
    """
    ordered = pages.repartitionByRange("page_id").sortWithinPartitions("page_id", "url")
    lines = ordered.select(record().alias("value"))
    lines.write.option("lineSep", END).option("compression", "gzip").text(path)
    return path


def split_records(content):
    """(offset, bytes) of each record; bytes that are no record are one to the end of the file.

    The length in the header leads to the next record; if that is damaged, the next header does.
    """
    at, size, end = 0, len(content), END.encode()
    while at < size:
        head = content.find(end, at)
        length = LENGTH.search(content, at, head + 2) if head >= 0 else None
        stop = head + len(end) + int(length[1]) if length else size
        if content[stop : stop + len(end)] != end:
            after = content.find(end + b"WARC/1.0\r\n", at)
            stop = after if after >= 0 else max(at, size - len(end))
        yield at, content[at:stop]
        at = stop + len(end)


def _shard_number(path):
    return int("".join(SHARD.findall(path)[0]))


def _leaf_rows(batches):
    for batch in batches:
        for path, packed in zip(batch["path"], batch["content"], strict=True):
            shard = _shard_number(path.as_py())
            content = zlib.decompress(packed.as_py(), wbits=31) if len(packed.as_buffer()) else b""
            rows = []
            for n, (at, raw) in enumerate(split_records(content)):
                page = PAGE.search(raw, 0, raw.find(END.encode()) + 2)
                rows.append((shard, n, at, len(raw), hashlib.sha256(raw).digest(),
                             int(page[1]) if page else None))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                names = ["shard", "n", "start", "length", "digest", "page_id"]
                yield pa.RecordBatch.from_arrays(columns, names)


def leaves(spark, path):
    """(shard, n, start, length, digest, page_id) of every record of an archive; offsets are those
    of the uncompressed shard."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    schema = "shard long, n long, start long, length long, digest binary, page_id long"
    return map_arrow(files.where("length > 0").select("path", "content"), _leaf_rows, schema)


def _parents(nodes, *key):
    """Nodes of the next level: a hash of FANOUT neighbours' hashes and places, in order."""
    child = F.struct("n", "digest", "start", "stop")
    grouped = nodes.groupBy(*key, F.expr(f"n div {FANOUT}").alias("up")).agg(
        F.sort_array(F.collect_list(child)).alias("c"), F.min("start").alias("start"),
        F.max("stop").alias("stop"),
    )
    text = F.array_join(F.transform("c", lambda x: F.concat_ws(
        ":", x["n"].cast("string"), F.hex(x["digest"]), x["start"].cast("string"),
        x["stop"].cast("string"),
    )), ",")
    return grouped.select(*key, F.col("up").alias("n"), F.unhex(F.sha2(text, 256)).alias("digest"),
                          "start", "stop")


def tree(records, name):
    """Levels of the tree as stored tables (shard, n, digest, start, stop): those within the shards
    from the records to the shard roots, and those above, whose shard is null and the first of which
    numbers the shard roots. The number of levels follows the number of records."""

    def is_root(level):
        return (level.agg(F.max("n")).first()[0] or 0) == 0

    stop = (F.col("start") + F.col("length")).alias("stop")
    inner = [stored(records.select("shard", "n", "digest", "start", stop), f"{name}-0")]
    while not is_root(inner[-1]):
        inner.append(stored(_parents(inner[-1], "shard"), f"{name}-{len(inner)}"))
    nowhere = F.lit(None).cast("long").alias("shard")
    roots = inner[-1].select(nowhere, F.col("shard").alias("n"), "digest", "start", "stop")
    above = [stored(roots, f"{name}-roots")]
    while not is_root(above[-1]):
        up = _parents(above[-1].drop("shard"))
        above.append(stored(up.select(nowhere, *up.columns), f"{name}-above-{len(above)}"))
    return inner, above


def mismatches(left, right):
    """(shard, n) of the records in which two trees differ, missing ones included.

    Level by level from the root, the children of differing nodes are joined and compared; equal
    branches are not read. Replicas of different height are compared from the level that both have.
    """
    inner, above = (min(len(a), len(b)) for a, b in zip(left, right, strict=True))
    left, right = ([*low[:inner], *high[:above]] for low, high in (left, right))
    suspects = None
    for depth in range(len(left) - 1, -1, -1):
        if depth == inner - 1 and suspects is not None:  # from shard roots to the top nodes within
            parent = suspects.select(F.col("n").alias("_shard")).distinct()
            on = F.col("shard") == F.col("_shard")
        elif suspects is not None:
            parent = suspects.select(F.col("shard").alias("_shard"), F.col("n").alias("_n"))
            on = F.col("shard").eqNullSafe(F.col("_shard")) & (F.expr(f"n div {FANOUT}") == F.col("_n"))
        sides = []
        for levels in (left, right):
            nodes = levels[depth].select("shard", "n", "digest", "start", "stop")
            if suspects is not None:
                nodes = nodes.join(small_side(parent), on, "left_semi")
            sides.append(nodes)
        a, b = sides[0].alias("a"), sides[1].alias("b")
        both = a.join(b, F.col("a.shard").eqNullSafe(F.col("b.shard")) & (F.col("a.n") == F.col("b.n")), "full")
        same = F.coalesce(
            (F.col("a.digest") == F.col("b.digest")) & (F.col("a.start") == F.col("b.start"))
            & (F.col("a.stop") == F.col("b.stop")), F.lit(False),
        )
        suspects = stored(
            both.where(~same).select(F.coalesce("a.shard", "b.shard").alias("shard"),
                                     F.coalesce("a.n", "b.n").alias("n")),
            "warc-suspects",
        )
        if suspects.isEmpty():
            break
    return suspects


def audit(spark, path, replica):
    """One row per record of the archive `path`: shard, n, start, length, digest, page_id, corrupt
    (whether the replica's record differs or is missing)."""
    mine = leaves(spark, path)
    ours, theirs = tree(mine, "warc-tree"), tree(leaves(spark, replica), "warc-replica")
    bad = mismatches(ours, theirs).select(
        F.col("shard").alias("_shard"), F.col("n").alias("_n"), F.lit(True).alias("_bad")
    )
    same = (F.col("shard") == F.col("_shard")) & (F.col("n") == F.col("_n"))
    joined = mine.join(small_side(bad), same, "left")
    return joined.withColumn("corrupt", F.coalesce("_bad", F.lit(False))).drop("_shard", "_n", "_bad")


def _record_rows(batches):
    for batch in batches:
        for path, packed in zip(batch["path"], batch["content"], strict=True):
            shard = _shard_number(path.as_py())
            rows, size = [], 0
            for n, (_, raw) in enumerate(split_records(zlib.decompress(packed.as_py(), wbits=31))):
                page = PAGE.search(raw, 0, raw.find(END.encode()) + 2)
                rows.append((shard, n, int(page[1]) if page else None, raw.decode("utf-8", "replace")))
                size += len(raw)
                if size > ROW_BYTES:
                    yield _record_batch(rows)
                    rows, size = [], 0
            if rows:
                yield _record_batch(rows)


def _record_batch(rows):
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["shard", "n", "page_id", "value"])


def damaged_copy(spark, path, copy, damaged):
    """Copy an archive shard by shard, flipping the first character of the page in the records on
    which the condition `damaged` on page_id holds, and leaving their headers as they were: what an
    audit has to find."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    schema = "shard long, n long, page_id long, value string"
    rows = map_arrow(files.where("length > 0").select("path", "content"), _record_rows, schema)
    at = F.instr("value", END) + len(END)
    other = F.when(F.substr("value", at, F.lit(1)) == "#", "!").otherwise("#")
    flipped = F.concat(F.substr("value", F.lit(1), at - 1), other, F.substr("value", at + 1))
    hit = F.coalesce(damaged, F.lit(False)) & (F.length("value") >= at)
    rows = rows.withColumn("value", F.when(hit, flipped).otherwise(F.col("value")))
    lines = rows.sortWithinPartitions("shard", "n").select("shard", "value")
    writer = lines.write.option("lineSep", END).option("compression", "gzip")
    writer.partitionBy("shard").text(copy)
    return copy


def audit_pages(pages, damaged):
    """`audit` of an archive of `pages` (page_id, url, html) against a damaged copy.

    Nulls are empty; a page without page_id has no such header. Rows that repeat a page are
    records each. Other columns are not read. Without pages there are no records.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    path = write(rows, work_folder(spark, "warc"))
    return audit(spark, path, damaged_copy(spark, path, work_folder(spark, "warc-copy"), damaged))
