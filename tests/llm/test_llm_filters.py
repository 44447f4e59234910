"""The filter audit and the URL filter."""

import math
import tracemalloc
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, differences
from freightflow.llm import filter_audit, shards, url_filter
from freightflow.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
LABELS = "doc_id long, quality int, toxic int"


def test_audit_query(spark):
    df = QUERIES["op11_filter_audit"](spark, SF)
    assert differences(df, connect(SF), ORACLE["op11_filter_audit"]) is None


def plain_audit(docs, labels):
    """The audit by its definition, document by document and order by order."""
    good = {r[0] for r in labels if r[0] is not None and r[1] == 1}
    toxic = {r[0] for r in labels if r[0] is not None and r[2] == 1}
    rows = []
    for d, text, source in docs:
        text = text or ""
        words = [w for w in text.encode().replace(b"\x0b", b" ").split() if w]
        capitals = sum("A" <= c <= "Z" for c in text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * capitals > 2 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": any(t == text and e is not None and d is not None and e < d for e, t in
                     ((e, t or "") for e, t, _ in docs)),
        }
        rows.append((source or "", {k for k, v in fails.items() if v}, d))
    out, shapley = [], Counter()
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            for step, f in enumerate(order, 1):
                failing = [r for r in rows if r[0] == part and f in r[1]]
                removed = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[part, f] += len(removed)
                out.append((
                    part, "".join(order), step, len(left), len(removed), len(failing) - len(removed),
                    sum(r[1] == {f} for r in failing), sum(r[2] in good for r in removed),
                    sum(r[2] in toxic for r in removed), f,
                ))
    return sorted((*r[:-1], shapley[r[0], r[-1]]) for r in out)


def test_audit_of_odd_rows(spark, odd_docs, no_docs):
    many = " ".join(f"w{i}" for i in range(300))
    more = [(30, many, "a"), (31, many + " A$", "b"), (29, many, "a"), (32, "one " * 250, "a"),
            (33, "x\x0by\u00a0z " * 210, None), (30, many, "a")]
    docs = odd_docs.select("doc_id", "text", "source").union(
        spark.createDataFrame(more, "doc_id long, text string, source string")
    )
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (29, 1, 0), (30, 1, 1), (None, 1, 1), (99, 1, 1), (31, None, None)]
    rows = docs.collect()
    got = filter_audit.audit(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert sorted(map(tuple, got)) == plain_audit([tuple(r) for r in rows], labels)
    assert filter_audit.audit(no_docs, spark.createDataFrame([], LABELS)).count() == 0


def test_matrix_is_that_of_a_plain_count(spark, odd_docs):
    # shards of a few bytes, so that words are spread over many
    rows, words = filter_audit.matrix(odd_docs.repartition(3), size=40)
    names = {r.value: r.word for r in words.collect()}
    assert sorted(names) == list(range(len(names))) and len(set(names.values())) == len(names)
    got = [(str(r.doc_id), sorted((names[t], n) for t, n in zip(r.terms, r.counts, strict=True)))
           for r in rows.collect()]
    want = [(str(r.doc_id), sorted(Counter(w.decode() for w in (r.text or "").encode().split()).items()))
            for r in odd_docs.collect()]
    assert sorted(got) == sorted(want)


def test_shards_are_cut_by_size():
    rows = [str(i) * (i % 5) for i in range(50)]
    batches = [pa.RecordBatch.from_arrays([pa.array(rows[a : a + 7])], ["text"]) for a in range(0, 50, 7)]
    tables = list(shards.cut(iter(batches), "text", 12))
    assert [t for x in tables for t in x["text"].to_pylist()] == rows and len(tables) > 5
    assert list(shards.cut(iter([]), "text", 12)) == []


def test_a_shard_is_split_in_slices(monkeypatch):
    texts = ["", " ", "a b a", "X" * 50, *(f"w{i % 997} B{i % 13} x\u00e9 " * 9 for i in range(9000)), "a c", "\t"]
    rows = pa.table({"doc_id": range(len(texts)), "part": ["p"] * len(texts), "text": texts})
    sizes = []
    plain = filter_audit._cells
    monkeypatch.setattr(filter_audit, "_cells", lambda t: sizes.append(t.nbytes) or plain(t))
    monkeypatch.setattr(filter_audit, "SLICE_BYTES", 1 << 16)
    tracemalloc.start()
    documents, listed = filter_audit._shard(rows, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    size = sum(len(t.encode()) for t in texts)
    assert peak < 4 * size and len(sizes) > size / (1 << 16)
    names = listed["names"][0].as_py()
    assert len(set(names)) == len(names)
    for row, text in zip(documents.to_pylist(), texts, strict=True):
        cells = {names[t]: n for t, n in zip(row["terms"], row["counts"], strict=True)}
        assert cells == Counter(text.split()) and len(cells) == len(row["terms"])
        assert row["capitals"] == sum("A" <= c <= "Z" for c in text)


URLS = [
    ("https://a.Example.net/en/x?q=1#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("http://example.net/de/", "example.net", "/de/", "net/", "block"),
    ("http://net/", "net", "/", "net/", "block"),
    ("http://planet/", "planet", "/", None, None),
    ("http://example.net", "example.net", "", None, None),
    ("http://example.net?x=/", "example.net", "", None, None),
    ("http://example.com/de/1", "example.com", "/de/1", "example.com/de/", "block"),
    ("http://myexample.com/de/1", "myexample.com", "/de/1", None, None),
    ("x://W.ORG/fr/://y", "w.org", "/fr/://y", "org/fr/", "allow"),
    ("http://É.org/fr/#://", "É.org", "/fr/", "org/fr/", "allow"),
    ("no scheme/net/", "", "", None, None), (None, "", "", None, None), ("", "", "", None, None),
    ("://", "", "", None, None), ("http://u:p@example.net:80/en/", "u:p@example.net:80", "/en/", None, None),
]


def test_rules(spark):
    pages = spark.createDataFrame([(i, u[0], "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    got = [tuple(r) for r in url_filter.parsed(pages).orderBy("page_id").drop("url").collect()]
    assert got == [(i, *u[1:]) for i, u in enumerate(URLS)]
    tie = [("allow", "b.net", "/"), ("block", "net", "/xx")]
    one = spark.createDataFrame([(1, "http://b.net/xx")], "page_id long, url string")
    assert url_filter.parsed(one, tie).first()["rule"] == "b.net/"


class PlainModel:
    """A character model by dictionaries, one context at a time."""

    def __init__(self, urls):
        self.counts = defaultdict(Counter)
        for u in urls:
            for context, c in self.steps(u):
                for k in range(url_filter.ORDER + 1):
                    self.counts[k, context[url_filter.ORDER - k :]][c] += 1

    @staticmethod
    def steps(url):
        padded = bytes([url_filter.BEFORE]) * url_filter.ORDER + url.encode() + bytes([url_filter.END])
        return [(padded[i - url_filter.ORDER : i], padded[i]) for i in range(url_filter.ORDER, len(padded))]

    def log(self, url):
        total = 0.0
        for context, c in self.steps(url):
            p = 1 / url_filter.SYMBOLS
            for k in range(url_filter.ORDER + 1):
                seen = self.counts[k, context[url_filter.ORDER - k :]]
                if seen:
                    p = (seen[c] + len(seen) * p) / (sum(seen.values()) + len(seen))
            total += math.log(p)
        return total / (len(url.encode()) + 1)


def test_scores_are_those_of_plain_models(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    more = spark.createDataFrame(
        [(-i, u[0]) for i, u in enumerate(URLS)] + [(None, "http://é.net/x"), (7, "http://a/" + "ab" * 5000)], pages.schema
    )
    pages = pages.union(more).repartition(3)
    url = {}
    for r in pages.collect():
        url.setdefault(r.page_id, set()).add(r.url or "")
    got = url_filter.scored(pages).withColumnRenamed("host", "h").collect()
    held = {r.url or "": r.held for r in url_filter.parsed(pages).selectExpr(
        "url", f"pmod(xxhash64(url), {url_filter.CALIBRATED}) = 0 AS held").collect()}
    ruled = {r.url: r.ruled for r in url_filter.parsed(pages).collect()}
    learnt = [u for r in pages.collect() if not held[u := r.url or ""] and ruled[u]]
    models = {v: PlainModel([u for u in learnt if ruled[u] == v]) for v in ("allow", "block")}
    want = {u: models["allow"].log(u) - models["block"].log(u) for us in url.values() for u in us}
    assert len(got) == pages.count()
    for r in got:
        assert any(abs(r.score - want[u]) < 1e-9 for u in url[r.page_id])


def test_url_query(spark):
    rows = QUERIES["op12_url_filter"](spark, "/root/testdata/sf0.1").collect()
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    assert sorted(r.page_id for r in rows) == sorted(r.page_id for r in pages.select("page_id").collect())
    ruled = {r.page_id: r.ruled for r in url_filter.parsed(pages).collect()}
    assert all(r.verdict == ruled[r.page_id] for r in rows if ruled[r.page_id])
    free = [r.verdict for r in rows if not r.rule]
    assert set(free) == {"allow", "block"}


def test_models_judge_unseen_urls_as_the_rules_do(spark):
    found = url_filter.stored(url_filter.scored(spark.read.parquet("/root/testdata/sf0.1/pages.parquet")), "t")
    least = url_filter.threshold(found)
    held = found.where("held AND ruled IS NOT NULL").collect()
    right = np.mean([(r.score >= least) == (r.ruled == "allow") for r in held])
    assert len(held) > 100 and right > 0.97


@pytest.mark.parametrize("urls", [[], [(1, None)], [(1, "http://a.net/x"), (1, "http://a.net/x"), (2, "zz")]])
def test_few_urls(spark, urls):
    pages = spark.createDataFrame(urls, "page_id long, url string")
    got = url_filter.judge(pages).collect()
    assert len(got) == len(urls) and {r.verdict for r in got if r.rule} <= {"block"}
