"""SentencePiece encoding and decoding by a Viterbi search that shares word prefixes.

A text is the sequence of its words between single spaces, each marked with U+2581 in front. The
distinct marked words of a batch are sorted, which lists the trie of their characters depth first:
each word keeps the forward scores of the prefix it shares with the word before it and extends
them by its own characters. Pieces score by Zipf's law on their rank in the vocabulary. Characters
without a piece fall back to bytes, so decoding gives back every text exactly.
"""

import math
import zlib
from functools import cache
from itertools import islice
from string import punctuation
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import map_arrow

MARK = "▁"
#: What a fallback byte scores below the rarest piece.
BYTE_PENALTY = 2.0
#: Characters of text whose words are searched together.
BATCH_CHARACTERS = 1 << 19
#: Encoded words that are kept for later batches.
CACHE_WORDS = 120_000


class Vocabulary:
    """Pieces of a SentencePiece model file: {piece: (id, score)}, ids of bytes, texts by id."""

    def __init__(self, model_file):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        self.pieces, self.bytes, self.texts = {}, {}, [""] * size
        self.byte_of = {}
        normal = []
        for i in range(size):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:5], 16)
                self.bytes[value], self.byte_of[i] = i, value
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                normal.append(i)
        for rank, i in enumerate(normal):
            piece = model.id_to_piece(i)
            self.pieces[piece] = (i, -math.log(rank + 2))
            self.texts[i] = piece.replace(MARK, " ")
        self.byte_score = -math.log(len(normal) + 2) - BYTE_PENALTY
        #: Neighbouring characters within pieces; no piece spans a place between any others.
        self.pairs = {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}
        self.lines = not any("\n" in p for p in self.pieces)
        #: Pieces by their characters from the last to the first; "" holds the piece that ends.
        self.backwards = {}
        for piece, found in self.pieces.items():
            node = self.backwards
            for character in reversed(piece):
                node = node.setdefault(character, {})
            node[""] = found


def search(words, vocabulary):
    """Ids of each word of a sorted sequence: {word: [id, ...]}; see `searched`."""
    return dict(searched(words, vocabulary))


def searched(words, vocabulary):
    """(word, [id, ...]) of each word of a sorted sequence, one by one. The best sum of scores wins; of
    equal ones the segmentation with the longer last piece, then the one before it, and so on.

    U+2581 counts as a piece's character in front only; elsewhere it is spelt in bytes.
    """
    backwards = vocabulary.backwards
    best, came, before = [0.0], [None], ""
    for word in words:
        shared, most = 0, min(len(word), len(before))
        while shared < most and word[shared] == before[shared]:
            shared += 1
        del best[shared + 1 :], came[shared + 1 :]
        for end in range(shared, len(word)):
            top, where, node, start = -math.inf, None, backwards, end
            inner = end > 0 and word[end] == MARK
            while not inner and start >= 0:
                node = node.get(word[start])
                if node is None or (word[start] == MARK and start):
                    break
                found = node.get("")
                if found and best[start] + found[1] >= top:
                    top, where = best[start] + found[1], (start, found[0])
                start -= 1
            if where is None:
                spelt = [vocabulary.bytes[b] for b in word[end].encode("utf-8", "surrogatepass")]
                top, where = best[end] + vocabulary.byte_score * len(spelt), (end, spelt)
            best.append(top)
            came.append(where)
        ids, end = [], len(word)
        while end:
            end, part = came[end]
            if part.__class__ is int:
                ids.append(part)
            else:
                ids.extend(reversed(part))
        before = word
        yield word, ids[::-1]


class Coder:
    """Encodes and decodes texts; keeps the words of earlier batches up to a limit."""

    def __init__(self, model_file):
        self.vocabulary, self.known = Vocabulary(model_file), {}

    def _parts(self, word):
        """The marked word cut where no piece can span: at line ends and before punctuation at its end."""
        if MARK in word or not self.vocabulary.lines:
            return [MARK + word]
        parts = []
        for i, line in enumerate(f"{MARK}{word}".split("\n")):
            if i:
                parts.append("\n")
            core = line.rstrip(punctuation)
            at = len(core)
            if core and line[at - 1 : at + 1] not in self.vocabulary.pairs:
                parts += [core, line[at:]]
            else:
                parts.append(line)
        return [p for p in parts if p]

    def encode(self, texts):
        """Ids of each text as little-endian unsigned 32-bit bytes. An empty text has none."""
        known, new = self.known, set()
        for text in texts:
            new.update([w for w in text.split(" ") if w not in known] if text else ())
        # Texts are split and words cut a second time: to keep the parts would take several times the batch.
        parts = sorted({p for w in new for p in self._parts(w)})
        coded = {p: pack(f"<{len(ids)}I", *ids) for p, ids in searched(parts, self.vocabulary)}
        del parts
        found = {w: b"".join([coded[p] for p in self._parts(w)]) for w in new}
        del coded, new
        # Words seen first are the frequent ones; they stay.
        known.update(islice(found.items(), CACHE_WORDS - len(known)))
        get = known.get
        return [b"".join([get(w) or found[w] for w in t.split(" ")]) if t else b"" for t in texts]

    def decode(self, ids):
        """The text of ids given as bytes."""
        texts, byte_of = self.vocabulary.texts, self.vocabulary.byte_of
        numbers = np.frombuffer(ids, "<u4").tolist()
        if byte_of.keys().isdisjoint(numbers):
            return "".join(map(texts.__getitem__, numbers))[1:]
        parts = [bytes([byte_of[i]]) if i in byte_of else texts[i].encode() for i in numbers]
        return b"".join(parts).decode("utf-8", "surrogatepass")[1:]


@cache
def coder(model_file):
    """One coder per Python worker, which serves many tasks."""
    return Coder(model_file)


def _slices(column):
    """Parts of a text column with BATCH_CHARACTERS bytes at most, or one text: (start, end)."""
    sizes = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in column], np.int64)
    start, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if size and size + n > BATCH_CHARACTERS:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield start, len(sizes)


def _encode_rows(model_file):
    def run(batches):
        code = coder(model_file)
        for batch in batches:
            for a, b in _slices(batch["text"]):
                part = batch.slice(a, b - a)
                ids = code.encode([t or "" for t in part["text"].to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(ids, pa.binary())], ["doc_id", "ids"]
                )

    return run


def _decode_rows(model_file):
    def run(batches):
        code = coder(model_file)
        for batch in batches:
            for a, b in _slices(batch["ids"]):
                part = batch.slice(a, b - a)
                ids = part["ids"].to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                        pa.array([code.decode(x) for x in ids], pa.string()),
                    ],
                    ["doc_id", "n_pieces", "ids_crc32", "decoded"],
                )

    return run


def _round_trip_rows(model_file):
    encoded, decoded = _encode_rows(model_file), _decode_rows(model_file)
    return lambda batches: decoded(encoded(batches))


def _training_rows(model_file, also):
    """(doc_id, text, also ...) to (doc_id, ids as a list, n_pieces, also ...); fails if a text does
    not come back."""

    def run(batches):
        code = coder(model_file)
        for batch in batches:
            for a, b in _slices(batch["text"]):
                part = batch.slice(a, b - a)
                texts = [t or "" for t in part["text"].to_pylist()]
                ids = code.encode(texts)
                for name, text, x in zip(part["doc_id"], texts, ids, strict=True):
                    if code.decode(x) != text:
                        raise ValueError(f"document {name} does not decode to its text")
                counts = np.array([len(x) // 4 for x in ids], np.int32)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                values = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.ListArray.from_arrays(offsets, values), pa.array(counts, pa.int64()),
                     *[part[n] for n in also]],
                    ["doc_id", "ids", "n_pieces", *also],
                )

    return run


def encode(docs, model_file):
    """(doc_id, ids): the pieces of each whole text as little-endian unsigned 32-bit numbers.

    Null and empty texts have no ids. Repeated rows are encoded each; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(rows, _encode_rows(model_file), "doc_id long, ids binary")


def decode(coded, model_file):
    """(doc_id, n_pieces, ids_crc32, decoded) from (doc_id, ids). Without ids: the empty text."""
    rows = coded.select("doc_id", F.coalesce("ids", F.unhex(F.lit(""))).alias("ids"))
    schema = "doc_id long, n_pieces long, ids_crc32 long, decoded string"
    return map_arrow(rows, _decode_rows(model_file), schema)


def round_trip(docs, model_file):
    """`decode` of `encode` in one pass, by one worker for each task."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n_pieces long, ids_crc32 long, decoded string"
    return map_arrow(rows, _round_trip_rows(model_file), schema)


def training_rows(docs, model_file, also=()):
    """(doc_id, ids as an array, n_pieces) of each whole text, each decoded and compared with it.

    The columns `also` follow as they are, and rows stay in their order.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *also)
    kinds = [f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in also]
    schema = ", ".join(["doc_id long, ids array<int>, n_pieces long", *kinds])
    return map_arrow(rows, _training_rows(model_file, also), schema)
