import numpy as np
import pytest
from pyspark.sql import functions as F

from runway.llm import imi, queries, topk

NAN, INF = float("nan"), float("inf")


def table(spark, n=700, dim=16, seed=0, copies=250):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x[50:50 + copies] = x[50]  # one very common vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(10_000, None), (10_050, [1.0] * 3), (10_100, [NAN] * dim), (10_150, [1.0, None] * (dim // 2)), (10_200, [INF] + [0.0] * (dim - 1)),
           (10_250, []), (None, [1.0] * dim), (100, rows[100][1])]
    zero = [(10_300, [0.0] * dim)]
    df = spark.createDataFrame(rows + odd + zero, "vec_id long, embedding array<float>")
    for c in ("v", "block", "chunk", "cell", "grp", "score", "rank"):
        df = df.withColumn(c, F.lit("clash"))
    return df, dict(rows), dict(zero)


def brute_products(vectors, step, k):
    ids = sorted(vectors)
    x = np.floor(256 * np.array([vectors[i] for i in ids], dtype=np.float64)).astype(np.int64)
    out = set()
    for a, i in enumerate(ids):
        if i % step == 0:
            s = x @ x[a]
            order = [b for b in np.lexsort((ids, -s)) if ids[b] != i][:k]
            out |= {(i, r + 1, ids[b], int(s[b])) for r, b in enumerate(order)}
    return out


@pytest.mark.parametrize("dim,chunk,block", [(16, 512, 1 << 14), (7, 3, 90), (64, 4, 200), (1, 4, 200), (2, 4, 100)])
def test_topk_equals_brute_force(spark, monkeypatch, dim, chunk, block):
    df, vectors, zero = table(spark, dim=dim)
    monkeypatch.setattr(topk, "TILE", 128)
    got = topk.search(df, F.col("vec_id") % 50 == 0, k=5, chunk=chunk, block=block).collect()
    want = brute_products(vectors | zero, 50, 5)
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(4)
    c = np.cumsum(rng.integers(-40, 41, (3000, 64)), axis=1)  # smooth rows
    q = c[:20]
    for s in topk.resolutions(64):
        assert (topk.statistics(q.astype(float), s) @ topk.statistics(c.astype(float), s).T >= q @ c.T - 1e-3).all()
    ids = np.arange(3000)
    i, j, score = topk.top_of_tile(q, ids[:20], c, ids, 5, np.full(20, -np.inf))
    assert len(i) < 0.05 * q.shape[0] * c.shape[0]


def test_fewer_candidates_than_asked(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (50, [2.0, 1.0]), (7, [0.5, -1.0])], "vec_id long, embedding array<float>")
    assert topk.search(df, F.col("vec_id") % 50 == 0).count() == 4
    assert sorted(tuple(r)[:3] for r in imi.search(df, F.col("vec_id") % 50 == 0).collect()) == [(0, 1, 50), (0, 2, 7), (50, 1, 0), (50, 2, 7)]
    for module in (topk, imi):
        assert module.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
        assert module.search(df.where("vec_id = 0"), F.col("vec_id") % 50 == 0).count() == 0


def test_walk_visits_cells_in_order_of_summed_distance():
    rng = np.random.default_rng(2)
    for _ in range(20):
        a, b = rng.random(9), rng.random(7)
        counts = rng.integers(0, 4, 63)
        cells = imi.walk(a, b, counts, 10_000)
        total = (a[:, None] + b[None]).ravel()
        assert sorted(cells.tolist()) == np.flatnonzero(counts).tolist()
        assert (np.diff(total[cells]) >= 0).all()
        few = imi.walk(a, b, counts, 20)
        assert few.tolist() == cells[:len(few)].tolist() and counts[few].sum() >= 20 > counts[few[:-1]].sum()


def brute_nearest(vectors, step, k):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids], dtype=np.float64)
    out = {}
    for a, i in enumerate(ids.tolist()):
        if i % step == 0:
            d = np.sqrt(((x - x[a]) ** 2).sum(axis=1))
            out[i] = [(int(ids[b]), d[b]) for b in np.lexsort((ids, d)) if ids[b] != i][:k]
    return out


def test_the_whole_index_gives_exact_neighbours(spark):
    df, vectors, _ = table(spark)
    got = imi.search(df, F.col("vec_id") % 20 == 0, share=1.0, centroids=8, chunk=7, block=60).collect()
    want = brute_nearest(vectors, 20, 10)
    assert len(got) == sum(map(len, want.values()))
    for r in got:
        vec, d = want[r["query_id"]][r["rank"] - 1]
        assert r["vec_id"] == vec and r["score"] == pytest.approx(d, abs=1e-12)


def test_recall(spark):
    sf = "/root/testdata/sf0.1"
    vectors = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()}
    want = brute_nearest(vectors, 100, 10)
    got = queries.op7_multi_index(spark, sf).collect()
    hits = sum(r["vec_id"] in {v for v, _ in want[r["query_id"]]} for r in got)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert all(len([1 for r in got if r["query_id"] == q]) == 10 for q in want)
