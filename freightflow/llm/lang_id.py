"""Language identification in two steps: the family, then the language within it.

A text is a vector of hashed byte n-grams of its letters. A linear support vector machine per
family (one against the rest) picks the family; within it one machine per pair of languages votes.
"""

import math
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import crc_mod, map_arrow

#: Documents that the machines are fitted on at most, shared evenly by the languages.
SAMPLE_ROWS = 6_000
BITS, LONGEST = 12, 4
#: Bytes whose n-grams are counted at once.
SLICE = 1 << 20
HELD_OUT = (3, 1)
UNKNOWN = "und"

# ISO 639-1 codes by family. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is fo lb fy yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "indic": "hi ur bn pa mr gu ne",
    "iranian": "fa ku ps tg",
    "semitic": "ar he mt am",
    "malayic": "id ms",
}
FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}

OTHERS = re.compile(r"[\W\d_]+")
LETTER = re.compile(r"[^\W\d_]")


def features(text):
    """Unit vector of the square roots of hashed n-gram counts, or None without a letter."""
    if not text or not LETTER.search(text):
        return None
    data = f" {OTHERS.sub(' ', text.lower())} ".encode("utf-8", "surrogatepass")
    values = np.frombuffer(data, np.uint8)
    counts = np.zeros(1 << BITS, np.int64)
    for at in range(0, len(values), SLICE):
        part = values[at : at + SLICE + LONGEST - 1].astype(np.uint32)
        grams = np.zeros(min(SLICE, len(values) - at), np.uint32)
        for n in range(LONGEST):
            grams = grams[: len(part) - n]
            grams = grams * np.uint32(257) + part[n : n + len(grams)] + np.uint32(1)
            slots = (grams * np.uint32(2654435761)) >> np.uint32(32 - BITS)
            counts += np.bincount(slots, minlength=1 << BITS)
    vector = np.sqrt(counts, dtype=np.float64)
    return (vector / np.linalg.norm(vector)).astype(np.float32)


def fit_machine(x, positive, penalty=1e-4, epochs=20, batch=64):
    """A linear support vector machine by averaged subgradient steps: weights with the bias last.

    Both classes weigh the same in the hinge loss.
    """
    y = np.where(positive, 1.0, -1.0)
    cost = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum())) * len(y)
    x = np.column_stack([x, np.ones(len(x), x.dtype)])
    w, mean = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    rng, step = np.random.default_rng(7), 0
    for epoch in range(epochs):
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
            step += 1
            rate = 1 / (penalty * (step + 1000))
            active = rows[y[rows] * (x[rows] @ w) < 1]
            w *= 1 - rate * penalty
            if len(active):
                w += rate * (y[active] * cost[active]) @ x[active] / len(rows)
            if epoch >= epochs // 2:
                mean += w
    return mean / max(1, step - step // 2)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Classifier:
    """Machines for families and for pairs of languages; picklable."""

    def __init__(self, x, languages):
        self.languages = sorted(set(languages))
        names = np.array(languages, object)
        family = np.array([FAMILY_OF.get(n, n) for n in languages], object)
        self.families = sorted(set(family))
        self.of_family = [
            np.array([i for i, n in enumerate(self.languages) if FAMILY_OF.get(n, n) == f])
            for f in self.families
        ]
        self.family_machines = np.array([fit_machine(x, family == f) for f in self.families])
        self.pairs = [p for group in self.of_family for p in combinations(group.tolist(), 2)]
        self.pair_machines = []
        for a, b in self.pairs:
            rows = (names == self.languages[a]) | (names == self.languages[b])
            self.pair_machines.append(fit_machine(x[rows], names[rows] == self.languages[a]))
        self.pair_machines = np.array(self.pair_machines).reshape(len(self.pairs), x.shape[1] + 1)

    def predict(self, x):
        """Language index and score (0 to 1) of each row."""
        x = np.column_stack([x, np.ones(len(x), x.dtype)])
        margin = x @ self.family_machines.T
        family = margin.argmax(axis=1)
        sure = np.ones(len(x))
        if len(self.families) > 1:
            ranked = np.sort(margin, axis=1)
            sure = _sigmoid(2 * (ranked[:, -1] - ranked[:, -2]))
        votes = np.zeros((len(x), len(self.languages)))
        trust = np.zeros_like(votes)
        if self.pairs:
            duels = x @ self.pair_machines.T
            for n, (a, b) in enumerate(self.pairs):
                wins = _sigmoid(2 * duels[:, n])
                votes[:, a] += duels[:, n] >= 0
                votes[:, b] += duels[:, n] < 0
                trust[:, a] += wins
                trust[:, b] += 1 - wins
        best, score = np.zeros(len(x), int), np.zeros(len(x))
        for f, members in enumerate(self.of_family):
            rows = np.flatnonzero(family == f)
            # most votes, then the greater sum of the machines' trust
            ballot = (votes + trust / (len(self.languages) + 1))[np.ix_(rows, members)]
            chosen = members[ballot.argmax(axis=1)]
            best[rows] = chosen
            duels = len(members) - 1
            within = trust[rows, chosen] / duels if duels else 1.0
            score[rows] = sure[rows] * within
        return best, score


def _feature_rows(batches):
    for batch in batches:
        rows = [features(t.as_py()) for t in batch["text"]]
        packed = [None if r is None else r.astype(np.float16).tobytes() for r in rows]
        yield pa.RecordBatch.from_arrays([batch["lang"], pa.array(packed, pa.binary())],
                                         ["lang", "vector"])


def _predict_rows(classifier):
    def run(batches):
        for batch in batches:
            size = len(batch)
            names, scores = [UNKNOWN] * size, np.zeros(size)
            for at in range(0, size if classifier else 0, 1024):
                texts = batch["text"].slice(at, 1024)
                rows = [(at + i, v) for i, t in enumerate(texts)
                        if (v := features(t.as_py())) is not None]
                if rows:
                    best, score = classifier.predict(np.array([v for _, v in rows]))
                    for (i, _), k, s in zip(rows, best, score, strict=True):
                        names[i], scores[i] = classifier.languages[k], s
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(names), pa.array(scores)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def fit(docs, sample_rows=SAMPLE_ROWS):
    """A `Classifier` from the documents with a language that are not held out, or None.

    Each language gives about an equal share of the sample, chosen by a hash of doc_id, so that
    rare ones are learned too. Texts without a letter teach nothing.
    """
    modulus, out = HELD_OUT
    known = docs.where(F.col("lang").isNotNull() & (crc_mod("doc_id", modulus) != out))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return None
    quota = max(1, sample_rows // len(sizes))
    scale = 1 << 30
    limits = F.create_map(*[
        F.lit(v) for lang, n in sizes.items()
        for v in (lang, math.ceil(scale * min(1.0, quota / n)))
    ])
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < limits[F.col("lang")])
    rows = map_arrow(chosen.select("lang", "text"), _feature_rows, "lang string, vector binary")
    rows = sorted((r["lang"], bytes(r["vector"])) for r in rows.collect() if r["vector"] is not None)
    if not rows:
        return None
    x = np.array([np.frombuffer(v, np.float16) for _, v in rows], np.float32)
    return Classifier(x, [lang for lang, _ in rows])


def identify(docs):
    """One row per document: doc_id, held_out, lang_pred, score.

    `und` with score 0 for a null text, one without a letter, or when nothing could be learned.
    A null doc_id is neither learned from nor held out. Repeated rows are predicted each.
    """
    modulus, out = HELD_OUT
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(crc_mod("doc_id", modulus) == out, F.lit(False)).alias("held_out"), "text",
    )
    schema = "doc_id long, held_out boolean, lang_pred string, score double"
    return map_arrow(rows, _predict_rows(fit(docs)), schema)
