"""Toxicity by a weighted finite-state grammar over clauses.

Words are read as symbols: insult, threat, target, negation, reporting verb, quotation mark, clause
boundary or other. Small transducers track the scope of a negation, reported speech and whether the
clause addresses someone; their composition decides in which class each insult or threat of a
clause counts. A document is scored from its matched clauses alone, not from isolated words.
Insult words and stems with their weights, and the weight of each class, are learned from labels.
"""

import math
import re
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from .common import crc_mod, map_arrow, sampled, send_package, stored, whole_text

#: Labelled documents that the model is fitted on at most.
SAMPLE_ROWS = 12_000
STEM_LETTERS = (3, 12)
#: Least log-odds of a lexicon entry, less one standard error, and documents it must occur in.
LEAST_WEIGHT, LEAST_DOCUMENTS = 2.5, 3
REJECT_SCORE = 0.3
HELD_OUT = (4, 2)

# Function words of the grammar.
TARGETS = frozenset(
    "you your yours yourself du dich dir dein deine ihr euch tu te toi vous ton votre tú ti usted "
    "ustedes vosotros vuestro".split()
)
NEGATIONS = frozenset(
    "not no never none nobody nicht kein keine nie niemals pas jamais aucun ne nunca jamás ningún".split()
)
REPORTS = frozenset(
    "said says say wrote writes called calls claimed quoted sagte sagt schrieb nannte dit disait "
    "écrit appelait dijo dice escribió llamó".split()
)
# Threats as stem and endings, in English, German, French and Spanish.
THREATS = (
    ("kill hurt destroy beat punish shoot", "- s es ed en ing er"),
    ("töt schlag vernicht", "en e est st et t ete eten"),
    ("tu frapp", "er ez erai era erons eront ant"),
    ("détrui", "re s t sez rai ra rons ront"),
    ("mat golpe", "ar aré ará aremos arán ando aste"),
    ("destru", "ir iré irá iremos irán yo ye"),
)

TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n]|[\"“”„«»]")
BOUNDARIES, QUOTES = frozenset(".!?;\n"), frozenset("\"“”„«»")
NEGATION_WORDS = 3
CLASSES = ("plain", "targeted", "threat", "negated", "reported")
#: Classes in which the author speaks for themselves.
OPEN = CLASSES[:3]
THREAT_WORDS = frozenset(
    stem + ending.strip("-")
    for stems, endings in THREATS for stem in stems.split() for ending in endings.split()
)


def _negation(state, symbol):
    """Words that are still in the scope of a negation."""
    return 0 if symbol == "B" else NEGATION_WORDS if symbol == "N" else max(0, state - 1)


def _reported(state, symbol):
    """Whether the words are someone else's: after a reporting verb, or inside quotation marks."""
    if symbol == "B":
        return "quote" if state == "quote" else ""
    if symbol == "Q":
        return "" if state == "quote" else "quote"
    return "verb" if symbol == "R" and not state else state


def _target(state, symbol):
    return False if symbol == "B" else state or symbol == "Y"


def compose(machines, symbols="ITYNRQBO"):
    """The product of machines (start, step) as {(state, symbol): state}, states as tuples."""
    start = tuple(m[0] for m in machines)
    arcs, todo = {}, [start]
    while todo:
        state = todo.pop()
        for symbol in symbols:
            after = tuple(step(s, symbol) for (_, step), s in zip(machines, state, strict=True))
            if (state, symbol) not in arcs:
                arcs[state, symbol] = after
                todo.append(after)
    return start, arcs


START, ARCS = compose([(0, _negation), ("", _reported), (False, _target)])


def clauses(symbols):
    """The clauses of a sequence of (symbol, weight): weight per class that it matched, and words."""
    state, held, words = START, [], 0

    def closed(addressed):
        totals = {}
        for kind, weight in held:
            if kind == "threat" and not addressed:
                continue  # a threat needs someone it is directed at
            kind = "targeted" if kind == "plain" and addressed else kind
            totals[kind] = totals.get(kind, 0.0) + weight
        return totals, words

    for symbol, weight in symbols:
        if symbol == "B":
            yield closed(state[2])
            held, words = [], 0
        elif symbol != "Q":
            words += 1
        if symbol in "IT":
            negation, reported, _ = state
            kind = "negated" if negation else "reported" if reported else None
            held.append((kind or ("plain" if symbol == "I" else "threat"), weight))
        state = ARCS[state, symbol]
    yield closed(state[2])


def matched(symbols):
    """Weight per class of a sequence of (symbol, weight)."""
    totals = dict.fromkeys(CLASSES, 0.0)
    for clause, _ in clauses(symbols):
        for kind, weight in clause.items():
            totals[kind] += weight
    return totals


class Grammar:
    """Symbols and features of texts for a lexicon {stem or word + '$': weight}."""

    CACHE = 100_000

    def __init__(self, lexicon):
        self.lexicon, self.known = lexicon, {}

    def symbol(self, token):
        found = self.known.get(token)
        if found is None:
            found = self._symbol(token)
            if len(self.known) < self.CACHE:
                self.known[token] = found
        return found

    def _symbol(self, token):
        for symbol, words in (("B", BOUNDARIES), ("Q", QUOTES), ("N", NEGATIONS), ("R", REPORTS),
                              ("Y", TARGETS)):
            if token in words:
                return symbol, 1.0
        get, (low, high) = self.lexicon.get, STEM_LETTERS
        stems = [get(token[:k], 0.0) for k in range(low, min(high, len(token)) + 1)]
        weight = max([*stems, get(f"{token}$", 0.0)])
        if token in THREAT_WORDS:
            return "T", max(weight, 1.0)
        return ("I", weight) if weight > 0 else ("O", 0.0)

    def features(self, text):
        """Of the clauses that match: log of the weight of each class, number of those that speak
        for the author and of those that deny or report, greatest weight of one that speaks for
        the author, and the weight of these per 100 words."""
        tokens = TOKEN.findall(text.lower())
        if not any(self.symbol(t)[0] in "IT" for t in set(tokens)):
            return [0.0] * (len(CLASSES) + 4)
        totals = dict.fromkeys(CLASSES, 0.0)
        spoken = others = words = 0
        greatest = 0.0
        for clause, size in clauses(map(self.symbol, tokens)):
            words += size
            if not clause:
                continue
            for kind, weight in clause.items():
                totals[kind] += weight
            own = sum(clause.get(kind, 0.0) for kind in OPEN)
            spoken += own > 0
            others += any(kind not in OPEN for kind in clause)
            greatest = max(greatest, own)
        return [
            *(math.log1p(totals[c]) for c in CLASSES), math.log1p(spoken), math.log1p(others),
            greatest, 100 * sum(totals[c] for c in OPEN) / (words + 20),
        ]


class Model:
    """A grammar and a logistic regression on its features; picklable."""

    def __init__(self, lexicon, mean, scale, weights):
        self.lexicon, self.mean, self.scale, self.weights = lexicon, mean, scale, weights

    @cached_property
    def grammar(self):
        """One for each worker, so that its words are kept from batch to batch."""
        return Grammar(self.lexicon)

    def scores(self, texts):
        rows = np.array([self.grammar.features(t) for t in texts]).reshape(-1, len(self.mean))
        z = (rows - self.mean) / self.scale @ self.weights[1:] + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(rows, labels, penalty=1.0, rounds=30):
    """Regularised logistic regression by Newton steps: intercept and weights."""
    x = np.column_stack([np.ones(len(rows)), rows])
    ridge = np.diag([1e-6, *[penalty] * rows.shape[1]])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) + ridge @ w
        w -= np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, gradient)
    return w


def lexicons(sample):
    """Three of {stem or word + '$': weight} from (text, toxic, half): learned without half 0,
    without half 1, and from all. Weights are log-odds of toxic documents, less a standard error,
    by distinct words of each document.

    Entries that a shorter stem outweighs are left out, as a word has its greatest weight.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,}"), 0))
    toxic = F.col("toxic")

    def counts(of):
        return [
            F.sum(F.when(of(half), value)).alias(name)
            for half in (0, 1) for name, value in ((f"t{half}", toxic), (f"c{half}", 1 - toxic))
        ]

    counted = sample.select(F.explode(words).alias("word"), "toxic", "half").groupBy("word").agg(
        *counts(lambda half: F.col("half") == half)
    )
    low, high = STEM_LETTERS
    stems = F.expr(
        f"transform(sequence({low}, least(length(word), {high})), k -> left(word, k))"
    )
    parts = F.explode(F.concat(stems, F.array(F.concat("word", F.lit("$")))))
    names = ["t0", "c0", "t1", "c1"]
    sums = stored(
        counted.select(parts.alias("part"), *names).groupBy("part")
        .agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names))
        .where(F.col("t0") + F.col("t1") >= LEAST_DOCUMENTS),
        "toxicity-parts",
    )
    totals = sample.agg(*counts(lambda half: F.col("half") == half)).first()
    return [_entries(sums, totals, halves) for halves in ((1,), (0,), (0, 1))]


def _entries(sums, totals, halves):
    n_toxic, n_clean = (sum(totals[f"{c}{h}"] or 0 for h in halves) for c in "tc")
    t, c = (sum((F.col(f"{x}{h}") for h in halves), F.lit(0)) for x in "tc")
    odds = F.log((t + 0.5) / (n_toxic + 1)) - F.log((c + 0.5) / (n_clean + 1))
    error = F.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
    kept = sums.where(t >= LEAST_DOCUMENTS).select("part", (odds - error).alias("weight"))
    found = {r["part"]: r["weight"] for r in kept.where(F.col("weight") >= LEAST_WEIGHT).collect()}
    return {
        part: weight for part, weight in found.items()
        if all(found.get(part[:k], 0.0) < weight for k in range(STEM_LETTERS[0], len(part)))
    }


def _feature_rows(lexicons):
    def run(batches):
        grammars = [Grammar(entries) for entries in lexicons]
        for batch in batches:
            pairs = zip(batch["text"], batch["half"].to_pylist(), strict=True)
            rows = [grammars[half].features(text.as_py()) for text, half in pairs]
            yield pa.RecordBatch.from_arrays(
                [batch["toxic"], pa.array(rows, pa.list_(pa.float64()))], ["toxic", "features"]
            )

    return run


def fit(docs, labels, sample_rows=SAMPLE_ROWS):
    """A `Model` from the labels (doc_id, toxic) whose document is not held out.

    Labels that are not 0 or 1 are ignored; a document with both counts as toxic. Without toxic or
    without clean examples there is no model (None). The class weights are learned from features
    that each half of the sample has under the lexicon of the other, which it has not shaped; the
    lexicon of the model is learned from both halves.
    """
    modulus, out = HELD_OUT
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.where(crc_mod("doc_id", modulus) != out)
    known = known.groupBy(F.col("doc_id").cast("long").alias("_ff_id")).agg(
        F.max("toxic").cast("int").alias("toxic")
    )
    # Bounded by `sample_rows`, so the broadcast is.
    chosen = F.broadcast(sampled(known, "_ff_id", sample_rows, known.count()))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = texts.join(chosen, F.col("doc_id") == F.col("_ff_id"))
    half = F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("half")
    sample = rows.groupBy("text").agg(F.max("toxic").alias("toxic")).select("text", "toxic", half)
    sample = stored(sample, "toxicity-sample")
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    *crossed, entries = lexicons(sample)
    schema = "toxic int, features array<double>"
    found = map_arrow(sample.repartition(16), _feature_rows(crossed), schema).collect()
    found.sort(key=lambda r: (r["toxic"], r["features"]))
    x = np.array([r["features"] for r in found])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    weights = _logistic((x - mean) / scale, np.array([r["toxic"] for r in found], float))
    return Model(entries, mean, scale, weights)


def score_column(spark, model, text="text"):
    """The score of a text column, null as the empty text; 0 without a model."""
    if model is None:
        return F.lit(0.0)
    send_package(spark)

    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.to_list()))

    return F.pandas_udf(score, "double")(whole_text(text))


def scores(docs, labels):
    """One row per document: doc_id, held_out, score, predicted.

    `held_out` is null for a null doc_id. Empty and null texts get the score of a text without any
    match, as do texts without a matched clause; texts of any length are read whole. Repeated rows
    are scored each, equal texts alike; no tie is to be broken. An empty table gives no rows. Other
    columns of `docs` are not read.
    """
    model = fit(docs, labels)
    modulus, out = HELD_OUT
    scored = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (crc_mod("doc_id", modulus) == out).alias("held_out"),
        score_column(docs.sparkSession, model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= REJECT_SCORE).cast("int"))


def drop_toxic(docs, labels):
    """The rows of `docs` that score below REJECT_SCORE, with all their columns."""
    model = fit(docs, labels)
    return docs.where(score_column(docs.sparkSession, model) < REJECT_SCORE)
