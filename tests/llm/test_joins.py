import random
import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from scorelab.llm import impact_topk, jaccard_join
from scorelab.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def shingle_set(t, k=4):
    w = WORD.findall((t or "").translate(FOLD))
    return frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[i : i + k]) for i in range(len(w) - k + 1)])


def brute_components(docs):
    """docs: (doc_id, text); the least doc_id reachable over linked rows and rows that share a doc_id."""
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [shingle_set(t) for _, t in docs]
    for i, j in combinations(range(len(docs)), 2):
        o = len(sets[i] & sets[j])
        if o and 100 * o >= 85 * (len(sets[i]) + len(sets[j]) - o) or docs[i][0] == docs[j][0] and docs[i][0] is not None and sets[i] == sets[j]:
            root[find(i)] = find(j)
    out = {}
    for i, (d, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if find(j) == find(i) and docs[j][0] is not None]
        out.setdefault((d, docs[i][1]), min(ids, default=None))
    return out, {(d, t): len(s) for (d, t), s in zip(docs, sets)}


@pytest.fixture(scope="module")
def near_copies():
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(400)]
    line = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage = line(40)
    texts = [None, "", " \n", "One", "ONE", "one two", "one  two", "a b c", "a b c d", "A\tb c D e"]
    for _ in range(25):
        base = line(rng.choice([8, 12, 30, 60, 120]))
        if rng.random() < 0.5:
            base += passage
        for _ in range(rng.choice([1, 2, 5])):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice([*vocab, "UPPER"])
            texts.append(" ".join(w if rng.random() < 0.8 else w[: -rng.randint(1, 4)]))
    hot = line(90)
    for _ in range(60):  # a large group of copies, all different
        w = list(hot)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        texts.append(" ".join(w))
    texts += [" ".join(hot)] * 5
    texts.append(" ".join(line(20_000)))
    ids = rng.sample(range(-50, 2000), len(texts))
    docs = list(zip(ids, texts))
    docs += [docs[20], docs[20], (None, texts[40]), (None, "nothing like it at all here")]
    return docs


@pytest.mark.parametrize("rare", [64, 3])
def test_components_equal_brute_force(spark, near_copies, rare):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in near_copies], "doc_id long, text string, n string, node int").repartition(4)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(df, rare=rare).collect()]
    roots, sizes = brute_components(near_copies)
    want = [(d, sizes[d, t], roots[d, t]) for d, t in near_copies]
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_jaccard_of_empty_table(spark):
    assert jaccard_join.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_prefixes_of_linked_sets_meet():
    """Whatever the order and frequencies, two sets that link share a key whose positions allow the link."""
    rng = random.Random(4)
    for _ in range(400):
        n = rng.randint(7, 150)
        order = list(range(1000, 1000 + 3 * n))
        freq = {t: f for t, f in zip(order, sorted(rng.choice([2, 3, 50, 200, 900]) for _ in order))}
        a = set(rng.sample(order, n))
        b = set(a)
        for t in rng.sample(sorted(a), rng.randint(0, max(1, n // 10))):
            b.discard(t)
            if rng.random() < 0.6:
                b.add(rng.choice(order))
        o = len(a & b)
        if 100 * o < 85 * (len(a) + len(b) - o):
            continue
        keys = []
        for s in (a, b):
            tokens = sorted(s, key=lambda t: (freq[t], t))
            keys.append(dict(jaccard_join.prefix_keys(tokens, [freq[t] for t in tokens], len(s), 85, 64)))
        need = 85 * (len(a) + len(b))
        assert any(185 * (len(a) - keys[0][k]) >= need and 185 * (len(b) - keys[1][k]) >= need for k in keys[0].keys() & keys[1].keys())


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(129, 200), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 100}
    assert components(df.limit(0)).count() == 0


def brute_top(vectors, k=5):
    import math

    rows = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    asked = {}
    for i, v in rows:
        if i % 50 == 0:
            asked[i] = min(asked.get(i, v), v)
    for i, q in asked.items():
        scored = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(q, v)))), j) for j, v in rows if j != i)
        out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("scale", [1.0, 300.0, 1e9])
def test_top_k_equals_brute_force(spark, scale):
    rng = random.Random(6)
    vectors = [(i, [rng.gauss(0, 0.2) * scale for _ in range(12)]) for i in range(-200, 500)]
    vectors += [(1000 + i, vectors[i][1]) for i in range(30)]  # ties
    vectors += [(2000, None), (2050, [1.0, None]), (2100, [float("nan")] * 12), (2150, [float("inf")] * 12), (None, [1.0] * 12), (2200, []), (2250, [0.5]), (2300, [0.0] * 12)]
    vectors += [vectors[205], vectors[200], (0, [-0.25 * scale] * 12)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in vectors], "vec_id long, embedding array<double>, v int, score string").repartition(3)
    got = [tuple(r) for r in impact_topk.top_k(df).collect()]
    assert len(got) == len(set(got)) or scale > 1e6
    want = brute_top(vectors)
    assert {(q, r, s) for q, r, _, s in got} == {(q, r, s) for q, r, _, s in want}
    assert set(got) == want


def test_top_k_of_few_or_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (50, [2.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in impact_topk.top_k(df).collect()) == [(0, 1, 50, 256 * 512), (50, 1, 0, 256 * 512)]
    assert impact_topk.top_k(df.where(F.lit(False))).count() == 0


def test_search_stops_with_a_proof():
    """A block's possible members always hold the true best rows."""
    import numpy as np

    rng = np.random.default_rng(8)
    v = np.floor(rng.normal(0, 40, (600, 16))).astype(np.int64)
    q = np.floor(rng.normal(0, 40, (20, 16))).astype(np.int64)
    level = np.abs(v) // impact_topk.STEP
    row, dim = (x.ravel() for x in np.indices(v.shape))
    order = np.lexsort((row, v.ravel() < 0, dim, -level.ravel()))
    key = np.stack([level.ravel(), dim, v.ravel() < 0])[:, order]
    edge = np.flatnonzero(np.concatenate([[True], (np.diff(key, axis=1) != 0).any(0)]))
    block = impact_topk.Block({"n": 600, "dims": 16, "ids": np.arange(600).tobytes(), "vectors": v.tobytes(), "segments": np.ascontiguousarray(key[:, edge]).astype(np.int64).tobytes(), "starts": edge.astype(np.int64).tobytes(), "rows": row[order].astype(np.uint16).tobytes()})
    rows, cols = block.possible(q, np.full(20, -np.inf), 6)
    exact = v @ q.T
    for c in range(20):
        best = np.argsort(-exact[:, c], kind="stable")[:6]
        assert set(best) <= set(rows[cols == c])
    assert len(rows) < 600 * 20 / 4
