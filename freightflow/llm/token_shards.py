"""Token ids in binary shards, with a minimal perfect hash from document keys to their offsets.

A shard is one file: the ids of its documents in ascending doc_id order as raw little-endian
integers, each document closed by the end id, and behind them a footer with the index. The index
gives every key a slot of its own by a minimal perfect hash; the slot holds a fingerprint of the
key, which turns away foreign keys, and the place of the document's ids. Spark's text writer puts
the rows out, so shards go to any file system that Spark reaches, under its commit protocol: a row
is one document's ids, and the line separator is the end id.
"""

import zlib
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import work_folder
from .common import map_arrow, stored, whole_text

END_ID = 1
MAGIC = 0x5844494E454B4F54
FINGERPRINT_BITS = 32
#: Bits per key of a level of the hash, and levels before the last keys are listed.
GAMMA, LEVELS = 2, 48
#: Bytes of text that are encoded at once, and encoded cores of words that are kept for later batches.
BATCH_BYTES, CACHE_WORDS, CHUNK_WORDS = 1 << 22, 600_000, 256


# ---------------------------------------------------------------- keys

def _mix(x):
    """A bijective scrambling of unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hashes(doc_ids, is_null, occurrence):
    """One 64-bit key per document: its id, whether that is null, and its place among equal ids."""
    with np.errstate(over="ignore"):
        base = np.where(is_null, np.uint64(0x9E3779B97F4A7C15), doc_ids.astype(np.int64).view(np.uint64))
        return _mix(base ^ _mix(occurrence.astype(np.uint64) * np.uint64(2) + is_null))


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys.

    Each level is a bit array in which a key keeps its bit if no other key of the level falls on
    it; the others go on to the next. The slot of a key is the number of bits set before its own.
    """

    def __init__(self, levels, rest):
        self.levels, self.rest = levels, rest  # arrays of 64-bit words; sorted keys left over
        counts = [np.bitwise_count(w).astype(np.int64) for w in levels]
        starts = np.cumsum([0, *(c.sum() for c in counts)])
        self.before = [s + np.cumsum(c) - c for s, c in zip(starts, counts, strict=False)]
        self.listed = int(starts[-1])

    @staticmethod
    def _places(keys, level, words):
        with np.errstate(over="ignore"):
            return _mix(keys + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(words * 64)

    @classmethod
    def build(cls, keys):
        levels, left = [], keys
        while len(left) and len(levels) < LEVELS:
            words = -(-GAMMA * len(left) // 64)
            places = cls._places(left, len(levels), words).astype(np.int64)
            alone = np.bincount(places, minlength=words * 64) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8").astype(np.uint64))
            left = left[~alone[places]]
        return cls(levels, np.sort(left))

    def slots(self, keys):
        """The slot of each key, or -1 where the key has none; foreign keys may get any slot."""
        out = np.full(len(keys), -1, np.int64)
        open_rows = np.arange(len(keys))
        for level, (words, before) in enumerate(zip(self.levels, self.before, strict=True)):
            if not len(open_rows):
                break
            places = self._places(keys[open_rows], level, len(words))
            word, bit = (places >> np.uint64(6)).astype(np.int64), places & np.uint64(63)
            value = words[word]
            here = (value >> bit) & np.uint64(1) == 1
            below = value & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_rows[here]] = before[word[here]] + np.bitwise_count(below[here]).astype(np.int64)
            open_rows = open_rows[~here]
        if len(self.rest) and len(open_rows):
            at = np.minimum(np.searchsorted(self.rest, keys[open_rows]), len(self.rest) - 1)
            same = self.rest[at] == keys[open_rows]
            out[open_rows[same]] = self.listed + at[same]
        return out


def _fingerprint(keys):
    with np.errstate(over="ignore"):
        return (_mix(keys ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - FINGERPRINT_BITS)).astype(np.uint32)


# ---------------------------------------------------------------- shards

def footer(shard, width, doc_ids, is_null, lengths):
    """The index of a shard as bytes: keys in file order, hash levels and slots."""
    size = len(lengths)
    occurrence = np.zeros(size, np.int64)
    if size:  # equal ids are neighbours, nulls first
        new = np.ones(size, bool)
        new[1:] = (doc_ids[1:] != doc_ids[:-1]) | (is_null[1:] != is_null[:-1])
        first = np.flatnonzero(new)
        occurrence = np.arange(size) - first[np.cumsum(new) - 1]
    keys = key_hashes(doc_ids, is_null, occurrence)
    table = PerfectHash.build(keys)
    slots = table.slots(keys)
    starts = np.cumsum(lengths) - lengths
    by_slot = np.empty(size, [("print", "<u4"), ("start", "<u8"), ("ids", "<u8")])
    by_slot["print"][slots] = _fingerprint(keys)
    by_slot["start"][slots], by_slot["ids"][slots] = starts, lengths
    parts = [doc_ids.astype("<i8").tobytes(), is_null.astype("u1").tobytes()]
    parts += [w.astype("<u8").tobytes() for w in table.levels]
    parts += [table.rest.astype("<u8").tobytes(), by_slot.tobytes()]
    shape = [shard, width, size, len(table.rest), len(table.levels), *map(len, table.levels)]
    body = b"".join(parts) + np.array(shape, "<u8").tobytes()
    tail = np.array([len(shape), len(body) + 24, MAGIC], "<u8").tobytes()
    return body + tail


class Shard:
    """A shard file's bytes: constant-time access by key, and enumeration of its documents."""

    def __init__(self, content, end_id=END_ID):
        self.content = content
        end = len(content)
        for width in (2, 4):  # the writer closes the footer like a document, with an end id
            at = end - width - 24
            if at >= 0 and int.from_bytes(content[at + 16 : at + 24], "little") == MAGIC:
                end -= width
                break
        else:
            raise ValueError("not a shard of token ids")
        n_shape, n_footer, _ = np.frombuffer(content, "<u8", 3, end - 24).tolist()
        shape = np.frombuffer(content, "<u8", n_shape, end - 24 - 8 * n_shape).astype(int).tolist()
        self.number, self.width, size, n_rest, _, *words = shape
        self.payload = end - n_footer
        at = self.payload

        def take(kind, count):
            nonlocal at
            out = np.frombuffer(content, kind, count, at)
            at += out.nbytes
            return out

        self.doc_ids, self.is_null = take("<i8", size), take("u1", size).astype(bool)
        levels = [take("<u8", n) for n in words]
        self.hash = PerfectHash(levels, take("<u8", n_rest))
        self.slots = take([("print", "<u4"), ("start", "<u8"), ("ids", "<u8")], size)

    def find(self, keys):
        """(start, ids) of each 64-bit key in ids of this shard; start is -1 for unknown keys."""
        slot = self.hash.slots(keys)
        known = slot >= 0
        if len(self.slots):
            known[known] = self.slots["print"][slot[known]] == _fingerprint(keys[known])
        start, count = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        start[known] = self.slots["start"][slot[known]]
        count[known] = self.slots["ids"][slot[known]]
        return start, count

    def ids(self, start, count):
        """`count` ids from `start` on, as unsigned 32-bit integers."""
        raw = np.frombuffer(self.content, f"<u{self.width}", count, start * self.width)
        return raw.astype("<u4")

    def get(self, doc_id, occurrence=0):
        """The ids of a document with its end id, or None."""
        null = doc_id is None
        key = key_hashes(np.array([0 if null else doc_id]), np.array([null]), np.array([occurrence]))
        start, count = self.find(key)
        return None if start[0] < 0 else self.ids(int(start[0]), int(count[0]))

    def keys(self):
        """The key of every document in file order."""
        new = np.ones(len(self.doc_ids), bool)
        new[1:] = (self.doc_ids[1:] != self.doc_ids[:-1]) | (self.is_null[1:] != self.is_null[:-1])
        first = np.flatnonzero(new)
        occurrence = np.arange(len(new)) - first[np.cumsum(new) - 1] if len(new) else first
        return key_hashes(self.doc_ids, self.is_null, occurrence)


# ---------------------------------------------------------------- encoding

class Encoder:
    """Encodes texts word by word with a tokenizer that drops white space and marks word ends.

    Words between ASCII white space are encoded apart, new ones many at a time, and cut at the
    tokens that end a pre-token; the pattern tells how many pre-tokens a word has. Words that could
    be counted wrongly (special tokens, unusual characters) are encoded one by one.
    """

    PRETOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    PLAIN = r"^[!-;=?-~À-ſ]+$"  # no "<" or ">" of special tokens
    STOPS = ".,;:!?"
    STOPPED = r"[0-9A-Za-zÀ-ÖØ-öø-įı-ſ][.,;:!?]+$"  # not "İ": its small form ends in a mark

    def __init__(self, tokenizer_file, end_id=END_ID):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values()) + 1
        if end_id >= 128:
            raise ValueError("the end id must be below 128, as its bytes separate text rows")
        self.kind = "<u2" if size <= 1 << 16 else "<u4"
        self.ends = np.zeros(size, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known = {}

    def _ids(self, texts):
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind) for e in found]

    def _together(self, words):
        """Ids of plain words, many words in one call; those that can't be cut apart are left out."""
        out = {}
        for at in range(0, len(words), CHUNK_WORDS):
            chunk = words[at : at + CHUNK_WORDS]
            # letters only, also in lower case, are one pre-token
            counts = np.array(
                [1 if w.lower().isalpha() else len(self.PRETOKENS.findall(w.lower())) for w in chunk]
            )
            ids = self._ids([" ".join(chunk)])[0]
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != counts.sum() or (len(ends) and ends[-1] != len(ids)):
                continue
            cuts = np.concatenate([[0], ends[np.cumsum(counts) - 1]]).tolist()
            raw, width = ids.tobytes(), ids.itemsize
            for w, a, b in zip(chunk, cuts, cuts[1:], strict=False):
                out[w] = raw[a * width : b * width]
        return out

    def _cores(self, cores):
        """Ids of distinct cores as binary, null for those that can't be cut apart."""
        cores = cores.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, cores))
        missing = [c for c, x in zip(cores, found, strict=True) if x is None]
        if missing:
            new = self._together(missing)
            found = [new.get(c) if x is None else x for c, x in zip(cores, found, strict=True)]
            # cores seen first are the frequent ones; they stay
            self.known |= dict(islice(new.items(), max(0, CACHE_WORDS - len(self.known))))
        return pa.array(found, pa.binary())

    def _words(self, words):
        """Ids of distinct words as binary. Stops behind a letter or digit are pre-tokens of their own,
        and ASCII capitals are read as small letters, so such words are encoded once."""
        plain = pc.match_substring_regex(words, self.PLAIN)
        stopped = pc.and_(plain, pc.match_substring_regex(words, self.STOPPED))
        core = pc.if_else(stopped, pc.ascii_rtrim(words, self.STOPS), words)
        core = pc.if_else(pc.string_is_ascii(core), pc.ascii_lower(core), core)
        at = np.flatnonzero(stopped)
        tails = pc.replace_substring_regex(words.take(pa.array(at)), "^.*[^" + self.STOPS + "]", "")
        parts = pa.concat_arrays([core.filter(plain), tails]).dictionary_encode()
        coded = self._cores(parts.dictionary).take(parts.indices)
        # per word: the core or null, and behind it the tail or nothing
        size, plain = len(words), plain.to_numpy(zero_copy_only=False)
        place = np.zeros(size, np.int64)
        place[plain] = np.arange(plain.sum())
        ids = coded.take(pa.array(place, mask=~plain))
        if len(at):
            place[:] = 0
            place[at] = plain.sum() + np.arange(len(at))
            behind = coded.take(pa.array(place, mask=~stopped.to_numpy(zero_copy_only=False)))
            behind = pc.if_else(stopped, behind, pa.scalar(b"", pa.binary()))
            ids = pc.binary_join_element_wise(ids, behind, pa.scalar(b"", pa.binary()))
        others = ids.is_null()
        alone = words.filter(others).to_pylist()
        if alone:
            ids = pc.replace_with_mask(ids, others, pa.array([x.tobytes() for x in self._ids(alone)], pa.binary()))
        return ids

    def encode(self, texts):
        """The ids of each text of an Arrow array without nulls as binary, without end id."""
        split = pc.ascii_split_whitespace(texts)
        limits, words = split.offsets.to_numpy(), split.values
        coded = words.dictionary_encode()
        ids = self._words(coded.dictionary).take(coded.indices)
        starts = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]
        starts = starts if len(ids) else np.zeros(1, np.int32)
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(starts[limits]), ids.buffers()[2]])


@cache
def encoder(tokenizer_file, end_id):
    """One encoder per Python worker, which serves many tasks."""
    return Encoder(tokenizer_file, end_id)


def _shard_rows(tokenizer_file, end_id, width):
    """Sorted (doc_id, text, shard) to the rows of one file: the documents' ids, then the footer."""

    def slices(texts, size=0, start=0):
        for i, t in enumerate(texts):
            n = len(t.as_buffer()) if t.is_valid else 0
            if size and size + n > BATCH_BYTES:
                yield start, i
                start, size = i, 0
            size += n
        yield start, len(texts)

    def run(batches):
        code = encoder(tokenizer_file, end_id)
        doc_ids, nulls, lengths, shard = [], [], [], None
        for batch in batches:
            if not len(batch):
                continue
            shard, names = batch["shard"][0].as_py(), batch["doc_id"]
            nulls.append(names.is_null().to_numpy(zero_copy_only=False))
            doc_ids.append(names.fill_null(0).to_numpy())
            for a, b in slices(batch["text"]):
                ids = code.encode(batch["text"].slice(a, b - a).fill_null(""))
                lengths.append(pc.binary_length(ids).to_numpy().astype(np.int64) // width + 1)
                yield pa.RecordBatch.from_arrays([ids], ["value"])
        if shard is not None:
            row = footer(shard, width, *(np.concatenate(x) for x in (doc_ids, nulls, lengths)))
            yield pa.RecordBatch.from_arrays([pa.array([row], pa.binary())], ["value"])

    return run


def write(docs, tokenizer_file, path, end_id=END_ID):
    """Write the shards of `docs` (doc_id, text) to `path` and return it.

    Shards follow each other in ascending doc_id, null first; null texts are empty and hold their
    end id only. Rows that repeat a doc_id are stored each, side by side in the order of their
    texts. Texts are encoded behind the sort, because finding its bounds reads its input twice.
    """
    width = np.dtype(Encoder(tokenizer_file, end_id).kind).itemsize
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered = ordered.select("doc_id", "text", F.spark_partition_id().alias("shard"))
    lines = map_arrow(ordered, _shard_rows(tokenizer_file, end_id, width), "value binary")
    separator = end_id.to_bytes(width, "little").decode()
    lines.select(F.col("value").cast("string")).write.option("lineSep", separator).text(path)
    return path


def _read_rows(batches):
    for batch in batches:
        for content in batch["content"]:
            shard = Shard(content.as_py())
            start, count = shard.find(shard.keys())
            crc = [zlib.crc32(shard.ids(a, n)) for a, n in zip(start.tolist(), count.tolist(), strict=True)]
            names = pa.array(shard.doc_ids, pa.int64(), mask=shard.is_null)
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(np.full(len(crc), shard.number)), pa.array(start), pa.array(count),
                 pa.array(crc, pa.int64())],
                ["doc_id", "shard", "shard_start", "n_tokens", "ids_crc32"],
            )


def read(spark, path):
    """(doc_id, shard, shard_start, n_tokens, ids_crc32, start) of every document of the files,
    each found through the index by its key. `start` counts the ids of all documents before it."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    schema = "doc_id long, shard long, shard_start long, n_tokens long, ids_crc32 long"
    found = stored(map_arrow(files, _read_rows, schema), "token-places")
    # One row per shard, far fewer than there are documents.
    ends = found.groupBy("shard").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(
        F.col("shard").alias("_shard"), F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before")
    )
    joined = found.join(F.broadcast(starts), F.col("shard") == F.col("_shard"))
    return joined.withColumn("start", F.col("before") + F.col("shard_start")).drop("_shard", "before")


def round_trip(docs, tokenizer_file, end_id=END_ID):
    """Write shards to the shared work folder and read them back."""
    spark = docs.sparkSession
    path = work_folder(spark, "token-shards")
    return read(spark, write(docs, tokenizer_file, path, end_id))
