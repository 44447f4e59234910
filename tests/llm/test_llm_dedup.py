"""Exact and near deduplication against brute force."""

from collections import defaultdict

import numpy as np
import pytest
import xxhash
from compare import connect, differences
from conftest_values import union_find
from freightflow.llm import exact_dedup, shingle_sets, simhash_dedup
from freightflow.llm.components import components
from freightflow.llm.queries import ORACLE, QUERIES
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_exact_query(spark):
    df = QUERIES["op1_exact_dedup"](spark, SF)
    assert differences(df, connect(SF), ORACLE["op1_exact_dedup"]) is None


def groups(df):
    return sorted(
        ((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()), key=lambda r: str(r)
    )


ODD_GROUPS = [
    (1, 2, 3, False), (2, 2, 3, False), (2, 2, 3, True), (3, 3, 1, True), (4, 5, 2, False),
    (5, 5, 2, True), (6, 7, 2, False), (7, 7, 2, True), (8, 8, 1, True), (9, 9, 1, True),
    (None, None, 2, False), (None, None, 2, True),
]


@pytest.mark.parametrize("moduli", [exact_dedup.MODULI, (2, 3)])
def test_exact_odd_rows_and_collisions(odd_docs, moduli):
    assert groups(exact_dedup.copy_groups(odd_docs, moduli, piece=100_000)) == sorted(
        ODD_GROUPS, key=lambda r: str(r)
    )


def test_pieces_combine_to_the_same_fingerprint(odd_docs):
    whole = exact_dedup.fingerprints(odd_docs).collect()
    pieces = exact_dedup.fingerprints(odd_docs, piece=7).collect()
    assert sorted(map(str, whole)) == sorted(map(str, pieces))


def test_polynomial_is_the_plain_polynomial():
    data = bytes(range(256)) * 700  # several chunks
    for got, base, modulus in zip(
        exact_dedup.polynomial(data), exact_dedup.BASES, exact_dedup.MODULI, strict=True
    ):
        want = 0
        for b in data:
            want = (want * base + b) % modulus
        assert got == want


def test_collision_within_one_length(spark):
    docs = spark.createDataFrame([(1, "ab"), (2, "ba"), (3, "ab")], "doc_id long, text string")
    got = groups(exact_dedup.copy_groups(docs, moduli=(1, 1)))
    assert got == [(1, 3, 2, False), (2, 2, 1, True), (3, 3, 2, True)]


def test_exact_drop_keeps_columns(odd_docs, no_docs):
    kept = exact_dedup.drop_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "5", "7", "8", "9", "None"]
    assert exact_dedup.drop_copies(no_docs).count() == 0
    assert exact_dedup.copy_groups(no_docs).count() == 0


def plain_simhash(text):
    words = [w for w in _words(text) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    bits = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for i in range(64):
            bits[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * bits[i] > len(shingles))


def _words(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).split(" ")


def brute_components(rows):
    """component_id per row of (doc_id, fingerprint)."""
    prints = sorted({f for _, f in rows})
    values = np.array(prints, np.uint64)
    links = [
        (i, int(j)) for i, v in enumerate(values)
        for j in np.flatnonzero(np.bitwise_count(values ^ v) <= 3)
    ]
    root = dict(zip(prints, union_find(len(prints), links), strict=True))
    least = defaultdict(lambda: None)
    for d, f in rows:
        if d is not None and (least[root[f]] is None or d < least[root[f]]):
            least[root[f]] = d
    return [least[root[f]] for _, f in rows]


def check_near(df, texts):
    rows = [(r.doc_id, int(r.fp) % (1 << 64), r.component_id) for r in df.collect()]
    want = sorted(((d, plain_simhash(t or "")) for d, t in texts), key=str)
    assert sorted(((d, f) for d, f, _ in rows), key=str) == want
    assert [c for *_, c in rows] == brute_components([(d, f) for d, f, _ in rows])


def test_near_groups(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check_near(simhash_dedup.near_groups(docs), docs.select("doc_id", "text").collect())
    check_near(simhash_dedup.near_groups(odd_docs), odd_docs.select("doc_id", "text").collect())
    assert simhash_dedup.near_groups(no_docs).count() == 0


def test_hash_is_the_one_of_spark(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("ab cd ef")).alias("h")).first()
    assert row.h % (1 << 64) == simhash_dedup.simhash("AB cd\tef")


@pytest.mark.parametrize("block", [4, 1024])
def test_links_in_long_lists(spark, block):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    prints = set()
    for c in centres:  # chains of changes, so that groups reach far beyond three bits
        v = int(c)
        for _ in range(60):
            v ^= 1 << int(rng.integers(64))
            prints.add(v)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = {r.vertex: r.root for r in components(simhash_dedup.links(df, block)).collect()}
    rows = [(i, p % (1 << 64)) for i, p in enumerate(signed)]
    by_root = defaultdict(list)
    for i, p in enumerate(signed):
        by_root[roots.get(p, p)].append(i)
    got = {i: min(members) for members in by_root.values() for i in members}
    assert [got[i] for i, _ in rows] == brute_components(rows)


def test_cover_meets_every_five_positions():
    from itertools import combinations

    for five in combinations(range(8), 5):
        assert any(set(s) <= set(five) for s in simhash_dedup.COVER)


def test_components_of_a_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(900, 901), (7, None)], "a long, b long")
    found = components(edges).collect()
    assert len(found) == n + 3 and len({r.root for r in found}) == 2
    assert components(edges.limit(0)).count() == 0


def test_near_drop(spark, odd_docs, no_docs):
    kept = simhash_dedup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").distinct().collect()) == [
        "1", "4", "6", "8", "9", "None"
    ]
    assert simhash_dedup.keep_one(no_docs).count() == 0


def test_components_of_edges_that_turn_when_read_again(spark):
    def turned(batches):  # each edge in a direction that changes with every evaluation
        import os

        import numpy
        import pyarrow as pa

        for batch in batches:
            turn = numpy.frombuffer(os.urandom(len(batch)), numpy.uint8) % 2 == 1
            a, b = batch["a"].to_numpy(), batch["b"].to_numpy()
            ends = [pa.array(numpy.where(turn, b, a)), pa.array(numpy.where(turn, a, b))]
            yield pa.RecordBatch.from_arrays(ends, ["a", "b"])

    edges = spark.createDataFrame([(2 * i, 2 * i + 1) for i in range(200)], "a long, b long")
    found = components(edges.mapInArrow(turned, "a long, b long")).collect()
    root = {r.vertex: r.root for r in found}
    assert len(root) == 400 and all(root[2 * i] == root[2 * i + 1] for i in range(200))


def test_links_do_not_depend_on_the_order_of_rows(spark):
    prints = [7 ^ (1 << i) for i in range(40)]
    edges = [
        sorted(tuple(r) for r in simhash_dedup.links(
            spark.createDataFrame([(p,) for p in order], "fp long").coalesce(1)).collect())
        for order in (prints, prints[::-1])
    ]
    assert edges[0] == edges[1]


def jaccard(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.split(), b.split()))
    return len(a & b) / len(a | b)


def test_pipeline_stage_drops_near_copies_from_similarity_point_eight(spark):
    import corpus_pipeline

    rng = np.random.default_rng(11)
    docs, fits = [], {}
    for n in range(120):
        words = [f"w{x}" for x in rng.integers(0, 5000, 200)]
        docs.append((10 * n, " ".join(words)))
        for k in range(1, 4):  # 1 to 6 changed words, each in up to five shingles
            copy = list(words)
            for at in rng.choice(200, int(rng.integers(1, 7)), replace=False):
                copy[at] = f"x{rng.integers(10**9)}"
            docs.append((10 * n + k, " ".join(copy)))
    texts = dict(docs)
    for n in range(120):  # groups by brute force
        ids = [10 * n + k for k in range(4)]
        pairs = [(i, j) for i in range(4) for j in range(i) if jaccard(texts[ids[i]], texts[ids[j]]) >= 0.8]
        fits |= {ids[i]: ids[r] for i, r in enumerate(union_find(4, pairs))}
    df = spark.createDataFrame(docs + [(5000, "a b"), (5001, "A  b"), (5002, ""), (5003, None)], "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, df, None).collect()}
    low = [jaccard(texts[10 * n], texts[10 * n + k]) for n in range(120) for k in range(1, 4)]
    assert sum(0.8 <= j < 0.95 for j in low) > 50 and sum(j < 0.8 for j in low) > 20
    assert kept == {i for i, r in fits.items() if i == r} | {5000, 5002}
    split = simhash_dedup.near_groups(df, block=2, words=5, similarity=0.8)
    assert {r.doc_id for r in split.collect() if r.doc_id == r.component_id} == kept


def five_word_links(texts, near=lambda i, j: True):
    """Pairs of texts whose sets of runs of five words have Jaccard similarity 0.8 or more."""
    runs = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.lower().split() for t in texts)]
    return [
        (i, j) for i, a in enumerate(runs) for j, b in enumerate(runs[:i])
        if a and b and 4 * max(len(a), len(b)) <= 5 * min(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b)
    ]


def test_near_copies_of_one_template_and_in_a_chain(spark):
    """Variants of a template, most linked only through others, a chain of drifting texts, and texts
    that share keys without being similar enough; blocks are far smaller than the lists."""
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(4000)]
    base = [words[i] for i in rng.integers(0, 4000, 100)]
    texts = []
    for edits in (1, 2, 3, 4):
        for _ in range(60):
            variant = list(base)
            for at in rng.integers(0, 100, edits):
                variant[at] = words[rng.integers(0, 4000)]
            texts.append(" ".join(variant))
    drift = [words[i] for i in rng.integers(0, 4000, 360)]
    texts += [" ".join(drift[3 * i : 3 * i + 60]) for i in range(100)]
    texts += [" ".join(drift[12 * i : 12 * i + 50]) + f" end {i}" for i in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = union_find(len(texts), five_word_links(texts))
    got = simhash_dedup.near_groups(df, block=7, words=5, similarity=0.8).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(want))


def test_recall_of_near_copies(spark):
    """All links of the documents by brute force end in one group, and no others do."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = sorted({(r.doc_id, r.text or "") for r in docs.collect()})
    links = five_word_links([t for _, t in rows])
    want = union_find(len(rows), links)
    got = {r.doc_id: r.component_id for r in simhash_dedup.near_groups(docs, words=5, similarity=0.8).collect()}
    together = sum(got[rows[i][0]] == got[rows[j][0]] for i, j in links)
    assert links and together >= 0.9 * len(links)
    assert together == len(links) and all(got[d] == rows[w][0] for (d, t), w in zip(rows, want, strict=True) if t.split())


def test_pipeline_stage_runs_the_simhash_index(spark, monkeypatch):
    """Every text goes through the fingerprints and the index of op2, and what they group is compared."""
    import corpus_pipeline

    rng = np.random.default_rng(5)
    texts = []
    for n in range(30):
        words = [f"w{x}" for x in rng.integers(0, 5000, 300)]
        texts += [" ".join(words), " ".join([*words[:-1], f"x{n}"])]
    # Fingerprints that link without similar sets: the words of a run again and again, another end.
    run = [f"r{x}" for x in range(13)]
    texts += [" ".join(run * 40), " ".join(run * 40 + [f"t{x}" for x in range(9)])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen, links = [], simhash_dedup.links

    def spy(prints, *args):
        seen.extend(int(r.fp) % (1 << 64) for r in prints.collect())
        return links(prints, *args)

    monkeypatch.setattr(simhash_dedup, "links", spy)
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, df, None).collect()}
    prints = [plain_simhash(t) for t in texts]
    assert sorted(seen) == sorted(set(prints))
    want = union_find(len(texts), five_word_links(texts))
    assert kept == set(want) and len(kept) < len(texts)

    near = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    assert (61, 60) in near and want[61] == 61  # grouped by the index, but not similar
    rows = shingle_sets.set_rows(df, 5, simhash_dedup.simhash)
    no_minima = F.array().cast("array<long>")
    rows = simhash_dedup.stored(rows.withColumn("bands", no_minima), "test-rows")
    alike = simhash_dedup.print_lists(rows)
    edges = shingle_sets.links(df, rows, alike, 5, 0.8)
    root = {r.vertex: r.root for r in components(edges).collect()}
    names = {r.doc_id: r.fp for r in rows.collect()}
    both = [(i, j) for i, j in near if want[i] == want[j]]
    assert len(both) > 10 and all(root[names[i]] == root[names[j]] for i, j in both)
