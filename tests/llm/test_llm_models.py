"""Language identification and toxicity: held-out accuracy, grammar, odd rows."""

import zlib

import numpy as np
import pytest
from freightflow.llm import lang_id, toxicity
from freightflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_languages(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op3_lang_id"](spark, SF).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(docs[r.doc_id] == r.lang_pred for r in held) > 0.97 * len(held) > 200
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd_rows(spark, odd_docs, no_docs):
    rows = {(r.doc_id, r.held_out): r for r in lang_id.identify(odd_docs).collect()}
    by_id = {k[0]: r for k, r in rows.items()}
    assert by_id[4].lang_pred == by_id[5].lang_pred == by_id[8].lang_pred == "und"
    assert by_id[4].score == 0.0 and not by_id[None].held_out
    assert by_id[6].lang_pred in {"en", "de", "fr"}
    assert lang_id.identify(odd_docs).count() == odd_docs.count()
    assert lang_id.identify(no_docs).count() == 0
    unlabelled = odd_docs.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    assert {r.lang_pred for r in lang_id.identify(unlabelled).collect()} == {"und"}


def test_one_language_is_always_found(spark):
    docs = spark.createDataFrame([(i, "abc def", "xx") for i in range(9)], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in lang_id.identify(docs).collect()} == {("xx", 1.0)}


def test_features_do_not_depend_on_slices(monkeypatch):
    text = "Ein längerer Text über gar nichts. " * 50
    whole = lang_id.features(text)
    monkeypatch.setattr(lang_id, "SLICE", 100)
    assert np.array_equal(whole, lang_id.features(text))


def test_toxicity(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES["op10_toxicity"](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(labels[r.doc_id] == r.predicted for r in held) > 0.93 * len(held) > 50


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.scores(odd_docs, nothing).collect()} == {0.0}
    labels = spark.createDataFrame(
        [(1, 0), (2, 0), (3, 1), (3, None), (None, 1), (6, 1), (7, 1), (8, 0), (9, 0), (99, 1), (4, 7)],
        "doc_id long, toxic int",
    )
    scored = toxicity.scores(odd_docs, labels)
    assert scored.count() == odd_docs.count()
    assert toxicity.scores(no_docs, labels).count() == 0
    kept = toxicity.drop_toxic(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.count() <= odd_docs.count()


@pytest.mark.parametrize("symbols, kind", [
    ("OIO", "plain"), ("YOIO", "targeted"), ("IOY", "targeted"), ("YBI", "plain"),
    ("NOI", "negated"), ("NOOOOI", "plain"), ("NBI", "plain"), ("ROI", "reported"),
    ("RBI", "plain"), ("QOBIQ", "reported"), ("QOQI", "plain"), ("YT", "threat"), ("TBY", None),
    ("NTY", "negated"),
])
def test_clauses(symbols, kind):
    totals = toxicity.matched([(s, 1.0) for s in symbols])
    assert {k for k, v in totals.items() if v} == ({kind} if kind else set())


def test_stems_are_found():
    grammar = toxicity.Grammar({"foo": 3.0, "bar$": 2.0})
    assert grammar.symbol("foolish") == ("I", 3.0)
    assert grammar.symbol("bar") == ("I", 2.0) and grammar.symbol("bars")[0] == "O"
    assert grammar.features("Nothing here.") == grammar.features("") == [0.0] * 9


def plain_words(text):
    """Clauses as lists of (word, inside quotation marks), by scanning characters."""
    found, word, quoted = [[]], "", False
    for c in text.lower() + "\n":
        if c.isalpha():
            word += c
            continue
        if word:
            found[-1].append((word, quoted))
            word = ""
        if c in toxicity.QUOTES:
            quoted = not quoted
        elif c in toxicity.BOUNDARIES:
            found.append([])
    return found[:-1] if not found[-1] else found


def plain_features(text, lexicon, threats):
    """What a clause matches, from the words around each insult instead of transducers."""
    def weight(word):
        return max([v for k, v in lexicon.items() if word.startswith(k) or word + "$" == k], default=0.0)

    totals, spoken, others, greatest, words = dict.fromkeys(toxicity.CLASSES, 0.0), 0, 0, 0.0, 0
    for clause in plain_words(text):
        words += len(clause)
        addressed, mine = any(w in toxicity.TARGETS for w, _ in clause), {}
        for i, (w, quoted) in enumerate(clause):
            if w in toxicity.TARGETS | toxicity.NEGATIONS | toxicity.REPORTS:
                continue
            threat = w in threats
            value = max(weight(w), 1.0) if threat else weight(w)
            near = {x for x, _ in clause[max(0, i - toxicity.NEGATION_WORDS): i]}
            if near & toxicity.NEGATIONS:
                kind = "negated"
            elif quoted or any(x in toxicity.REPORTS and not q for x, q in clause[:i]):
                kind = "reported"
            elif threat:
                kind = "threat" if addressed else None
            else:
                kind = "targeted" if addressed else "plain"
            if value and kind:
                mine[kind] = mine.get(kind, 0.0) + value
        for kind, value in mine.items():
            totals[kind] += value
        own = sum(mine.get(k, 0.0) for k in ("plain", "targeted", "threat"))
        spoken, greatest = spoken + (own > 0), max(greatest, own)
        others += any(k in mine for k in ("negated", "reported"))
    own = totals["plain"] + totals["targeted"] + totals["threat"]
    return [*np.log1p(list(totals.values())), np.log1p(spoken), np.log1p(others), greatest, 100 * own / (words + 20)]


def test_clauses_against_brute_force():
    rng, lexicon = np.random.default_rng(7), {"foo": 3.0, "bar$": 2.5, "foolis": 4.0}
    words = ["foo", "foolish", "bar", "bars", "killing", "schlagt", "tuera", "you", "not", "word", "thing"]
    grammar = toxicity.Grammar(lexicon)

    def clause():
        chosen = [str(w) for w in rng.choice(words, rng.integers(0, 12))]
        form = rng.integers(0, 3)
        if form == 1:
            chosen.insert(rng.integers(0, len(chosen) + 1), "said")
        elif form == 2:  # a quotation mark is no word, so negations next to it are left to other tests
            chosen = [w for w in chosen if w != "not"]
            a, b = sorted(rng.integers(0, len(chosen) + 1, 2))
            chosen = [*chosen[:a], '"', *chosen[a:b], '"', *chosen[b:]]
        return " ".join(chosen)

    for _ in range(400):
        text = "".join(clause() + rng.choice([". ", "; ", "! "]) for _ in range(rng.integers(1, 8)))
        want = plain_features(text, lexicon, {"killing", "schlagt", "tuera"})
        assert np.allclose(grammar.features(text), want), text


def test_features_come_from_clauses_alone():
    grammar = toxicity.Grammar({"foo": 3.0})
    denied, spoken = (grammar.features(t) for t in ("they are not foo.", "they are just foo."))
    assert denied[3] > 0 and denied[6] > 0 and denied[0] == denied[5] == denied[7] == denied[8] == 0
    assert spoken[0] > 0 and spoken[5] > 0 and spoken[7] == 3.0 and spoken[8] > 0
    assert grammar.features("he kills time.") == [0.0] * 9 and grammar.features("he kills you.")[2] > 0
    assert toxicity.Grammar({"kill": 3.0}).symbol("killed") == ("T", 3.0)


def test_lexicons(spark):
    long = "x" * 60
    rows = [(f"foolish{i % 2} {long} calm{i}", 1, i % 2) for i in range(200)]
    rows += [(f"quiet words{i}", 0, i % 2) for i in range(200)]
    without0, without1, whole = toxicity.lexicons(spark.createDataFrame(rows, "text string, toxic int, half int"))
    # A word of any length is learned whole; what a shorter stem says as strongly is left out.
    for entries in (without0, without1, whole):
        assert {"foo", "xxx", "cal"} <= set(entries) and "foolish" not in entries
        grammar = toxicity.Grammar(entries)
        assert grammar.symbol(long)[0] == "I" and grammar.symbol("quiet")[0] == "O"
    assert without0["foo"] == without1["foo"] < whole["foo"]
