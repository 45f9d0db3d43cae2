import random

import numpy as np

from locus.llm.components import components
from locus.llm.jaccard_join import bands_and_rows, jaccard_join, shingles


def brute(rows, n=5, similarity=0.8):
    sets = [frozenset(shingles(t or "", n).tolist()) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted(((i, least.get(root(k)), links[k]) for k, (i, _) in enumerate(rows)), key=repr)


def check(df, rows, **how):
    got = jaccard_join(df, **how).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=repr) == brute(rows)
    assert all(r.set_id is None or r.class_id is None or r.set_id >= r.class_id for r in got)


def copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10_000)}"
        out.append(" ".join(w))
    return out


def test_odd_rows(frame, odd):
    check(frame(odd), odd)


def test_empty_table(frame):
    assert jaccard_join(frame([])).count() == 0


def test_near_copies_among_others(frame, prose):
    rng = random.Random(1)
    texts = prose(80, 120, vocabulary=5000)
    for k in range(6):
        texts += copies(rng, [f"b{k}_{i}" for i in range(90)], 12, 4)
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    check(frame(rows).repartition(5), rows)


def test_a_large_group_in_blocks(frame):
    """Blocks far smaller than the group: links are found over all pairs of blocks and size classes."""
    rng = random.Random(2)
    rows = list(enumerate(copies(rng, [f"b{i}" for i in range(60)], 120, 5) + copies(rng, [f"b{i}" for i in range(50)], 40, 3)))
    check(frame(rows).repartition(4), rows, block_sets=8)


def test_a_core_around_a_pivot(frame):
    """Most sets are near the pivot and aren't compared; those around them are."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(150)]
    texts = copies(rng, base, 90, 1) + copies(rng, base, 60, 6) + copies(rng, base[:120], 30, 2)
    rows = list(enumerate(texts))
    check(frame(rows).repartition(4), rows, block_sets=8)
    check(frame(rows).repartition(4), rows, block_sets=64)


def test_a_similarity_of_one(frame):
    rows = [(i, " ".join(f"w{j}" for j in range(k, k + 9))) for i, k in enumerate([0, 0, 1, 2, 2, 2])]
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join(frame(rows), similarity=1.0).collect()}
    assert got == {0: (0, 1), 1: (0, 1), 2: (2, 0), 3: (3, 2), 4: (3, 2), 5: (3, 2)}


def test_bands_and_rows_reach_the_recall():
    for s, recall in ((0.8, 0.999), (0.5, 0.95), (0.9, 0.99)):
        b, r = bands_and_rows(s, recall)
        assert 1 - (1 - s**r) ** b >= recall and b * r <= 400


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(200 + rng.randrange(30), 200 + rng.randrange(30)) for _ in range(25)] + [(7, 7)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r.v: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {v: root(v) for v in list(parent) if root(v) != v}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_shingles_of_short_texts():
    assert len(shingles("", 5)) == 0 and len(shingles(" \n", 5)) == 0
    assert len(shingles("a b", 5)) == 1 and len(shingles("a b c d e", 5)) == 1
    assert not np.array_equal(shingles("a b", 5), shingles("b a", 5))
