"""Hard negatives."""

import numpy as np
from compare import connect, differences
from freightflow.llm import hard_negatives
from freightflow.llm.queries import ORACLE, QUERIES
from pyspark.sql import functions as F

COLUMNS = "vec_id long, embedding array<float>, label int"


def test_mining_query(spark):
    for sf in ("sf0.001", "sf0.1"):
        sf = f"/root/testdata/{sf}"
        df = QUERIES["op13_hard_negatives"](spark, sf)
        assert differences(df, connect(sf), ORACLE["op13_hard_negatives"]) is None


def plain(rows):
    """Every window by comparing all rows."""
    rows = [
        (v, (label + 1) % 10 if v is not None and v % 7 == 0 else label, [int(np.floor(256 * float(np.float32(x)))) for x in e])
        for v, e, label in rows
        if label is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)
    ]
    size = max((len(r[2]) for r in rows), key=lambda n: (sum(len(r[2]) == n for r in rows), -n))
    rows = [r for r in rows if len(r[2]) == size]
    out = []

    def order(x):
        return (-x[0], x[1] is None, x[1] or 0)

    for i, (v, label, a) in enumerate(rows):
        if v is None or v % 100:
            continue
        scored = [(sum(x * y for x, y in zip(a, e)), w, other == label) for j, (w, other, e) in enumerate(rows) if i != j]
        for s, w, _ in sorted((x for x in scored if x[2]), key=order)[:5]:
            near = sorted((x for x in scored if not x[2] and 80 * s <= 100 * x[0] <= 100 * s), key=order)[:5]
            out += [(v, w, n + 1, x[1], s, x[0]) for n, x in enumerate(near)]
    return sorted(map(str, out))


def mined(df):
    return sorted(str(tuple(r)) for r in hard_negatives.mine(df, F.col("vec_id") % 100 == 0).collect())


def test_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).round(2).tolist(), i % 4) for i in range(450)]
    rows += [(v, [0.5] * 6, 2) for v in range(1000, 1200)]  # one hot vector, anchors among them
    rows += [(300, rows[300][1], 3), (300, rows[300][1], rows[300][2]), (300, rows[300][1], rows[300][2])]
    rows += [(None, rows[100][1], 1), (None, rows[0][1], 0), (2000, [0.0] * 6, 1), (2100, None, 1), (2200, [1.0] * 6, None)]
    rows += [(2300, [float("nan")] * 6, 1), (2400, [float("inf"), *[1.0] * 5], 1), (2500, [None, *[1.0] * 5], 1)]
    rows += [(2600, [1.0] * 5, 1), (2700, [], 1), (-100, [-0.3] * 6, -1)]
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)
    assert mined(df) == plain(rows)


def test_small_blocks_and_few_visits(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ENTRY_BLOCK", 16)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 2)
    monkeypatch.setattr(hard_negatives, "FIRST_ROWS", 20)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 4)) * 3
    rows = [(i, (centres[i % 12] + rng.normal(size=4) / 9).round(3).tolist(), i % 10) for i in range(900)]
    assert mined(spark.createDataFrame(rows, COLUMNS)) == plain(rows)


def test_few_vectors(spark):
    assert mined(spark.createDataFrame([], COLUMNS)) == []
    assert mined(spark.createDataFrame([(0, None, 1), (100, [], 1)], COLUMNS)) == []
    for rows in ([(0, [1.0], 1)], [(0, [1.0], 1), (1, [2.0], 1), (2, [1.5], 3), (3, [1e30], 1)]):
        assert mined(spark.createDataFrame(rows, COLUMNS)) == plain([r for r in rows if r[1] != [1e30]])


def test_traverse_falls_and_bounds_hold():
    rng = np.random.default_rng(6)
    first, second = rng.normal(size=9), rng.normal(size=7)
    cells = list(hard_negatives.traverse(first, second))
    assert len({c[1:] for c in cells}) == 63 and [c[0] for c in cells] == sorted((c[0] for c in cells), reverse=True)
    assert all(np.isclose(b, first[i] + second[j]) for b, i, j in cells)


def test_packs():
    counts = np.array([[3, 0, 9], [25, 1, 1], [0, 0, 12]])
    pack, block, many = hard_negatives.packs(counts, 10)
    assert pack.tolist() == [[0, 0, 1], [2, 3, 3], [3, 3, 4]]
    assert block.tolist() == [[0, 0, 1], [2, 5, 5], [5, 5, 6]] and many.tolist() == [[1, 1, 1], [3, 1, 1], [1, 1, 2]]


def test_clustered_vectors_are_pruned():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 8)) * 500
    vectors = np.floor(centres[rng.integers(0, 40, 20_000)] + rng.normal(size=(20_000, 8)) * 5)
    index = hard_negatives.Index(vectors[:4000], len(vectors))
    (i, r), (j, s) = index.assign(vectors)
    np.add.at(index.counts, (i, j), 1)
    np.maximum.at(index.radii[0], i, r)
    np.maximum.at(index.radii[1], j, s)
    index.close(64)
    shares = []
    for a in vectors[::500]:
        scores = vectors @ a
        fifth = np.sort(scores)[-6]
        seen = index.visit(a, 0, fifth)
        assert np.isin(index.pack[i, j][scores >= fifth], seen).all()
        shares.append(index.held[seen].sum() / len(vectors))
    assert np.mean(shares) < 0.2
