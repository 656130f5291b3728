import numpy as np
import pytest
from pyspark.sql import functions as F

from runway.llm import negatives

NAN = float("nan")
LAST = np.iinfo(np.int64).max


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for c in ("v", "row", "of", "block", "chunk", "cell", "score", "place", "n", "a", "anchor"):
        df = df.withColumn(c, F.lit("clash"))
    return df.repartition(3)


def brute(rows, step, positives=5, k=3):
    rows = [r for r in rows if r[1] is not None and r[2] is not None and len(r[1]) == len(rows[0][1]) and all(x is not None and x == x for x in r[1])]
    x = np.floor(256 * np.array([r[1] for r in rows], dtype=np.float64)).astype(np.int64)
    ids = [LAST if r[0] is None else r[0] for r in rows]
    out = []
    for a, (i, _, label) in enumerate(rows):
        if i is None or i % step:
            continue
        order = sorted((int(-s), ids[b], b) for b, s in enumerate(x @ x[a]) if b != a)
        same = [(p, -s) for s, p, b in order if rows[b][2] == label][:positives]
        for p, ps in same:
            others = [(c, -s) for s, c, b in order if rows[b][2] != label and 50 * ps <= -100 * s <= 95 * ps][:k]
            out += [(i, None if p == LAST else p, r + 1, None if c == LAST else c, ps, ns) for r, (c, ns) in enumerate(others)]
    return out


def rows(n, dim, labels, seed=0, clustered=False):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    if clustered:
        x = rng.normal(size=(6, dim))[rng.integers(0, 6, n)] * 3 + x / 10
    x[40:90] = x[40]  # a group of equal vectors, of several labels
    y = np.where(rng.random(n) < 0.4, 0, rng.integers(0, labels, n))  # one label has more than a third of the rows
    found = [(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x.astype(np.float32), y))]
    odd = [(1000, None, 1), (1020, [1.0], 1), (1040, [NAN] * dim, 1), (1060, [1.0] + [None] * (dim - 1), 1) if dim > 1 else (1060, [None], 1),
           (1080, found[3][1], None), (None, found[5][1], found[5][2]), found[20], found[20], (20, found[7][1], 1)]
    return found + odd


@pytest.mark.parametrize("n,dim,labels,clustered,chunk,block", [(300, 8, 4, False, 512, 1 << 14), (300, 8, 4, True, 3, 70),
                                                               (150, 1, 2, False, 4, 50), (200, 64, 40, True, 5, 64)])
def test_negatives_equal_brute_force(spark, monkeypatch, n, dim, labels, clustered, chunk, block):
    monkeypatch.setattr(negatives, "TILE", 32)
    data = rows(n, dim, labels, clustered=clustered)
    got = negatives.mine(frame(spark, data), F.col("vec_id") % 20 == 0, F.col("label"), chunk=chunk, block=block)
    key = lambda r: tuple(LAST if v is None else v for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(data, 20), key=key)


def test_empty_and_single_rows(spark):
    data = [(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [0.5, 1.0], 2)]
    whole = frame(spark, data)
    mine = lambda df: negatives.mine(df, F.col("vec_id") % 50 == 0, F.col("label"))
    assert [tuple(r) for r in mine(whole).collect()] == [(0, 1, 1, 2, 5 * 2 ** 16, 5 * 2 ** 15)]
    for few in (whole.limit(0), whole.where("vec_id > 0"), whole.where("vec_id = 0"), whole.where("vec_id < 2"), whole.where("vec_id != 1")):
        assert mine(few).count() == 0


def test_tree_bounds_leave_most_candidates_alone():
    rng = np.random.default_rng(1)
    centre = rng.normal(size=64)
    q = np.floor(256 * (centre + rng.normal(size=(60, 64)) / 200)).astype(np.int64)
    c = np.floor(256 * rng.normal(size=(2000, 64))).astype(np.int64)
    tree = negatives.spanning_tree(q)
    assert sorted(n for n, _, _ in tree) == list(range(60))
    seen = {-1}
    for node, parent, _ in tree:
        assert parent in seen
        seen.add(node)
    truth, hits = q @ c.T, 0
    least = np.sort(truth, axis=1)[:, -5]

    def wanted(a, low, high):
        assert (low <= truth[a]).all() and (truth[a] <= high).all()
        return high >= least[a]

    def found(a, chosen, score):
        nonlocal hits
        hits += (score >= least[a]).sum()
        assert (score == truth[a][chosen]).all()

    computed = negatives.descend(tree, negatives.Scores(q, c), np.sqrt((c.astype(float) ** 2).sum(axis=1)), wanted, found)
    assert hits == (truth >= least[:, None]).sum() and computed < 0.2 * truth.size


def test_large_components_are_scored_in_integers():
    q, c = np.array([[2 ** 40, 1], [3, 2 ** 30]]), np.array([[2 ** 20 + 1, 7], [5, 2 ** 21]])
    s = negatives.Scores(q, c)
    assert s.of(0, np.arange(2)).tolist() == (c @ q[0]).tolist() and s.of(1, np.array([1])).tolist() == [c[1] @ q[1]]
    assert negatives.windows([101, -3, 0], 50, 95) == [(51, 95), (-1, -3), (0, 0)]
