import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from sieveyard.llm.components import connected_components
from sieveyard.llm.ngram_join import jaccard_components, prefix, shingle_set

from .helpers import docs, shingles


def brute(rows):
    """Components over all pairs; rows of one id belong together."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            parent[find(i)] = find(j)
    out = []
    for i, (id_, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((id_, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def got(df):
    return sorted(((r[0], r.n_shingles, r.component_id) for r in df.collect()), key=str)


def edited(r, words, share):
    return " ".join(w if r.random() > share else f"e{r.randrange(10**6)}" for w in words)


def test_against_brute_force(spark):
    r = random.Random(3)
    rows, common = [], [f"c{i}" for i in range(60)]
    for g in range(25):
        base = [f"g{g}w{r.randrange(400)}" for _ in range(r.choice((4, 5, 6, 30, 120)))]
        if g % 3 == 0:
            base = base + common  # a passage that many share
        rows += [edited(r, base, r.choice((0, 0.005, 0.02, 0.04))) for _ in range(r.choice((1, 2, 8)))]
    rows = [(i, t) for i, t in enumerate(rows)]
    assert got(jaccard_components(docs(spark, rows))) == brute(rows)
    assert got(jaccard_components(docs(spark, rows), rounds=1, sketch_bits=8)) == brute(rows)


def test_edge_rows(spark):
    out = got(jaccard_components(docs(spark)))
    from .helpers import TEXTS

    assert out == brute(TEXTS)


def test_threshold_is_exact(spark):
    base = [f"w{i}" for i in range(104)]  # 100 shingles
    for cut in (10, 11, 12):  # 100 * 90 >= 80 * 110 no; sizes 100 and 100
        rows = [(1, " ".join(base)), (2, " ".join(base[:-cut] + [f"x{i}" for i in range(cut)]))]
        assert got(jaccard_components(docs(spark, rows))) == brute(rows)


def test_large_near_group_has_few_pairs(spark):
    r = random.Random(1)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, edited(r, base, 0.01)) for i in range(400)]
    assert got(jaccard_components(docs(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert jaccard_components(docs(spark, [])).collect() == []


def test_prefixes_of_linked_sets_meet():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 50, 1 << 10).astype(np.uint16)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.1], rng.integers(0, 2**64, int(rng.integers(0, 3)), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if both and 100 * both >= 80 * (len(a) + len(b) - both):
            assert set(prefix(a, counts, 10, 80).tolist()) & set(prefix(b, counts, 10, 80).tolist())
    assert len(shingle_set(None, 5)) == 0 and len(shingle_set("a b", 5)) == 1 and len(shingle_set("a b c d e f", 5)) == 2


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (7, 7), (200, 150)], "a long, b long")
    out = {r.node: r.comp for r in connected_components(edges).collect()}
    assert out == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 200: 150, 150: 150}
    assert connected_components(edges.filter(F.lit(False))).count() == 0
    r = random.Random(14)
    pairs = [(r.randrange(400), r.randrange(400)) for _ in range(260)]
    parent = {i: i for p in pairs for i in p}

    def find(i):
        return i if parent[i] == i else find(parent[i])

    for a, b in pairs:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got_ = {x.node: x.comp for x in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got_ == {i: find(i) for i in parent}
