from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from runway.llm import jaccard, queries

from .cases import ODD, docs, empty


def brute_set(text, words=3):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def brute(rows, percent=90, words=3):
    """(doc_id, n, component) of the rows, by all pairs."""
    sets = [brute_set(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            root[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(least.get(top(i), doc), doc)
    return [(doc, len(s), least.get(top(i))) for i, ((doc, _), s) in enumerate(zip(rows, sets))]


def order(rows):
    return sorted(rows, key=lambda r: tuple(-1 if v is None else v for v in r))


def texts(seed, bases=12, copies=9, length=(3, 160), common=40):
    """Groups of near copies at all distances around the limit, chains of them, shared passages, and short texts."""
    rng = np.random.default_rng(seed)
    word = lambda: f"w{rng.integers(0, 5000)}"
    passage = [word() for _ in range(common)]
    out = []
    for b in range(bases):
        base = [word() for _ in range(rng.integers(*length))]
        if b % 3 == 0:
            base = passage + base
        for c in range(copies):
            t = list(base)
            for _ in range(rng.integers(0, 1 + max(1, len(t) // 12))):
                t[rng.integers(0, len(t))] = word()
            out.append(t)
            if c % 4 == 3:
                base = t  # a chain
    rng.shuffle(out)
    return [(i, " ".join(t)) for i, t in enumerate(out)]


@pytest.mark.parametrize("seed,percent,rare,hot,block", [(0, 90, 8, 64, 1024), (1, 90, 2, 4, 4), (2, 75, 3, 6, 8), (3, 100, 2, 4, 8)])
def test_components_equal_brute_force(spark, monkeypatch, seed, percent, rare, hot, block):
    monkeypatch.setattr(jaccard, "RARE", rare)
    monkeypatch.setattr(jaccard, "HOT", hot)
    monkeypatch.setattr(jaccard, "GATHER", 3000)
    rows = texts(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard.join(df, percent=percent, block=block).select("doc_id", "n_shingles", "component_id").collect()
    assert order(map(tuple, got)) == order(brute(rows, percent))


def test_near_copies_whose_least_one_is_no_partner(spark, monkeypatch):
    # All share most words, but each differs from the first too much: what the first round leaves is compared in cells.
    monkeypatch.setattr(jaccard, "RARE", 2)
    monkeypatch.setattr(jaccard, "HOT", 4)
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(60):
        t = list(base)
        for _ in range(int(rng.integers(0, 4))):
            t[int(rng.integers(0, 100))] = f"x{rng.integers(0, 60)}"
        rows.append((i, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard.join(df, block=7).select("doc_id", "n_shingles", "component_id").collect()
    assert order(map(tuple, got)) == order(brute(rows))


@pytest.mark.parametrize("percent", [60, 75, 90, 97])
def test_similar_sets_share_a_key(percent):
    """Of views at one level, for any frequencies: pairs that reach the similarity have a key in common."""
    rng = np.random.default_rng(percent)
    rule = jaccard.Rule(percent)
    for trial in range(300):
        n = int(rng.integers(2, 600))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        gone = int(rng.integers(0, len(a) // 5 + 1))
        b = np.unique(np.concatenate([rng.permutation(a)[gone:], rng.integers(0, 1 << 63, int(rng.integers(0, gone + 1))).astype(np.uint64)]))
        if not rule.links(len(np.intersect1d(a, b)), len(a), len(b)) or np.array_equal(a, b):
            continue
        levels = set(rule.levels(len(a))) & set(rule.levels(len(b)))
        assert max(len(a), len(b)).bit_length() - 1 in levels
        level = max(len(a), len(b)).bit_length() - 1
        many = {}
        keys = []
        for tokens in (a, b):
            hashes, first = jaccard.at_level(tokens, level)
            keys.append(hashes[:max(first, rule.longest_prefix(len(tokens), level))])
        shared = set(keys[0].tolist()) & set(keys[1].tolist())
        for t in set(keys[0].tolist()) | set(keys[1].tolist()):
            many[t] = int(rng.choice([2, 3, 10, 70])) if t in shared else int(rng.choice([1, 1, 2, 70]))
        found = []
        for tokens, hashes in zip((a, b), keys):
            known = np.array([t for t in rng.permutation(hashes) if many[int(t)] > 1], dtype=np.uint64)
            frequency = np.minimum([many[int(t)] for t in known], jaccard.HOT).astype(int)
            found.append(set(jaccard.prefix_keys(len(tokens), level, jaccard.at_level(tokens, level)[1], known, frequency, rule).tolist()))
        assert found[0] & found[1], (trial, len(a), len(b))


def test_parity_never_exceeds_the_difference():
    rng = np.random.default_rng(3)
    rule = jaccard.Rule(90)
    sets = [np.unique(rng.integers(0, 400, 200).astype(np.uint64)) for _ in range(30)]
    sets += [s[1:] for s in sets[:10]]
    bits = np.stack([jaccard.parity(s, 7) for s in sets])
    sizes = np.array([len(s) for s in sets])
    i, j, d = jaccard.passing_pairs(bits, sizes, bits, sizes, rule)
    passed = set(zip(i.tolist(), j.tolist()))
    for a in range(len(sets)):
        for b in range(len(sets)):
            if rule.links(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b])):
                assert (a, b) in passed
    for a, b, x in zip(i, j, d):
        assert x <= len(np.setxor1d(sets[a], sets[b]))


def test_forests():
    left, right = np.array([1, 2, 3, 1]), np.array([2, 3, 1, 2])
    assert sorted(jaccard.forests(left, right, np.array([3, 1, 2, 4]), 1).tolist()) == [1, 2]
    assert sorted(jaccard.forests(left, right, np.array([3, 1, 2, 4]), 9).tolist()) == [0, 1, 2, 3]


def test_token_sets():
    column = pa.array([t for _, t, *_ in ODD])
    found = dict(jaccard.token_sets(column, 3))
    for i, (_, text, *_) in enumerate(ODD):
        assert len(found.get(i, [])) == len(brute_set(text))


def test_odd_rows(spark):
    got = jaccard.join(docs(spark)).select("doc_id", "n_shingles", "component_id").collect()
    assert order(map(tuple, got)) == order(brute([(d, t) for d, t, *_ in ODD]))
    assert jaccard.join(empty(spark)).count() == 0


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert order(map(tuple, queries.op13_jaccard(spark, sf).collect())) == order(brute(rows))
