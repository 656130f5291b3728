"""Operator 7: approximate nearest neighbours with an inverted multi-index.

Both halves of the vectors are quantised by codebooks of their own, fitted by k-means on a bounded sample
(``sample`` vectors); every vector is indexed under its pair of centroids.  A query walks the pairs in the order of
the summed distances of its halves to the two centroids, with a heap over the two sorted lists, until the pairs hold
``share`` of all vectors (at least ``least``); their entries are reranked by exact distance.

Cells are dealt to groups of about ``block`` rows; a cell larger than that is split over several groups.  A query goes
to the groups that hold a cell it visits.  Chunks of queries meet groups in cogroups of bounded size, and each returns
at most k rows for a query.  Codebooks and cell counts are bounded by ``centroids`` and its square.

Defined cases: see ``vectors.usable`` for vectors that take no part (zero ones neither); equal distances go to the
smaller vec_id; a query gets all candidates if there are fewer than k; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import heapq
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import stage
from .vectors import best, in_chunks, matrix, usable


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of y (a codebook)."""
    return np.maximum((x ** 2).sum(axis=1)[:, None] + (y ** 2).sum(axis=1)[None] - 2 * x @ y.T, 0)


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """At most k centroids, starting from distinct rows."""
    distinct = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    centres = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)]
    for _ in range(rounds):
        near = squared(x, centres).argmin(axis=1)
        count = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def walk(a: np.ndarray, b: np.ndarray, counts: np.ndarray, want: int) -> np.ndarray:
    """Cells in order of a[i] + b[j], until their ``counts`` add up to ``want``; ties to the smaller places.

    Pairs enter the heap when both their left and upper neighbour in the sorted lists have left it.
    """
    ia, ib = np.argsort(a, kind="stable").tolist(), np.argsort(b, kind="stable").tolist()
    sa, sb = a[ia].tolist(), b[ib].tolist()
    width, held = len(ib), 0
    passed = [0] * (len(ia) + 1)  # how many columns of a row have left the heap
    heap, cells = [(sa[0] + sb[0], 0, 0)], []
    while heap and held < want:
        _, i, j = heapq.heappop(heap)
        cell = ia[i] * width + ib[j]
        passed[i] = j + 1
        if counts[cell]:
            held += counts[cell]
            cells.append(cell)
        if i + 1 < len(ia) and passed[i + 1] == j:
            heapq.heappush(heap, (sa[i + 1] + sb[j], i + 1, j))
        if j + 1 < width and (i == 0 or passed[i - 1] > j + 1):
            heapq.heappush(heap, (sa[i] + sb[j + 1], i, j + 1))
    return np.array(cells, dtype=np.int32)


@dataclass
class Index:
    """Codebooks of the halves, rows of each cell, and the cells' groups: first one and their number."""
    halves: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray
    first: np.ndarray
    groups: np.ndarray

    def cells(self, x: np.ndarray) -> np.ndarray:
        h = self.halves[0].shape[1]
        return squared(x[:, :h], self.halves[0]).argmin(axis=1) * len(self.halves[1]) + squared(x[:, h:], self.halves[1]).argmin(axis=1)


def _fit(length: int, centroids: int):
    def run(batches):
        parts = [(b.column(0).to_numpy(), matrix(b.column(1), length)) for b in batches if b.num_rows]
        if parts:
            ids, x = (np.concatenate(p) for p in zip(*parts))
            x = x[np.argsort(ids)]
            books = (kmeans(x[:, :length // 2], centroids), kmeans(x[:, length // 2:], centroids))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(books)], pa.binary())], ["books"])
    return run


def _assign(index, length: int):
    def run(batches):
        for batch in batches:
            cells = np.concatenate([np.zeros(0, int), *(index.value.cells(matrix(batch.column(1).slice(at, 8192), length))
                                                        for at in range(0, batch.num_rows, 8192))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells.astype(np.int32))], ["vec_id", "v", "cell"])
    return run


def group_cells(counts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """First group and number of groups of each cell: runs of cells of about ``block`` rows; larger cells by themselves."""
    parts = np.maximum(1, -(-counts // block))
    first, group, held = np.zeros(len(counts), dtype=np.int32), 0, 0
    for cell, n in enumerate(counts.tolist()):
        if held and held + n > block:
            group, held = group + 1, 0
        first[cell] = group
        if parts[cell] > 1:
            group, held = group + int(parts[cell]), 0
        else:
            held += n
    return first, parts.astype(np.int32)


def _route(index, length: int, want: int):
    """Queries to (group, cells to visit there)."""
    def run(batches):
        ix = index.value
        h = length // 2
        for batch in batches:
            x = matrix(batch.column(1), length)
            out = [], [], []
            for row, (a, b) in enumerate(zip(squared(x[:, :h], ix.halves[0]), squared(x[:, h:], ix.halves[1]))):
                cells = walk(a, b, ix.counts, want)
                parts = ix.groups[cells]  # a split cell is visited in all its groups
                nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
                groups, spread = np.repeat(ix.first[cells], parts) + nth, np.repeat(cells, parts)
                order = np.argsort(groups, kind="stable")
                names, heads = np.unique(groups[order], return_index=True)
                for name, part in zip(names, np.split(spread[order], heads[1:])):
                    out[0].append(row)
                    out[1].append(int(name))
                    out[2].append(np.sort(part).astype(np.int32).tobytes())
            take = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(take) for i in range(3)), pa.array(out[1], pa.int32()),
                                              pa.array(out[2], pa.binary())], ["vec_id", "v", "chunk", "grp", "cells"])
    return run


def _rerank(length: int, k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = [], [], []
        if rows.num_rows and queries.num_rows:
            c, c_ids, cell = matrix(rows["v"], length), rows["vec_id"].to_numpy(), rows["cell"].to_numpy()
            q = matrix(queries["v"], length)
            for x, own, cells in zip(q, queries["vec_id"].to_pylist(), queries["cells"].to_pylist()):
                at = np.flatnonzero(np.isin(cell, np.frombuffer(cells, np.int32)) & (c_ids != own))
                d = ((c[at] - x) ** 2).sum(axis=1)
                if len(at) > k:
                    near = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
                    at, d = at[near], d[near]
                order = np.lexsort((c_ids[at], np.sqrt(d)))[:k]
                out[0].extend([own] * len(order))
                out[1].extend(c_ids[at[order]].tolist())
                out[2].extend(np.sqrt(d[order]).tolist())
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})
    return run


def search(df: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", centroids: int = 128,
           share: float = 0.4, least: int = 200, sample: int = 1 << 14, chunk: int = 256, block: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) of the k nearest found for the rows where ``queries`` holds."""
    spark = df.sparkSession
    rows, n, length = usable(df, id_col, vector_col, zero=False)
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)
    books = pickle.loads(chosen.repartition(1).mapInArrow(_fit(length, centroids), "books binary").first()["books"])
    kind = dict(rows.dtypes)["v"]
    n_cells = len(books[0]) * len(books[1])
    none = np.zeros(n_cells, dtype=np.int64)
    cellular = stage(rows.mapInArrow(_assign(spark.sparkContext.broadcast(Index(books, none, none, none)), length),
                                     f"vec_id long, v {kind}, cell int"), "imi_cells")
    counts = none.copy()
    for row in cellular.groupBy("cell").count().collect():  # at most centroids squared
        counts[row["cell"]] = row["count"]
    index = spark.sparkContext.broadcast(Index(books, counts, *group_cells(counts, block)))
    # Every row to its group; a split cell's rows by their id's hash.
    cells = spark.createDataFrame([(i, int(f), int(g)) for i, (f, g) in enumerate(zip(index.value.first, index.value.groups)) if counts[i]],
                                  "_cell int, first int, parts int")
    dealt = cellular.join(F.broadcast(cells), F.col("cell") == F.col("_cell"))
    dealt = dealt.select("vec_id", "v", "cell", (F.col("first") + F.pmod(F.xxhash64("vec_id", F.lit(5)), F.col("parts"))).cast("int").alias("grp"))
    asked, n_chunks = in_chunks(rows.where(queries), "vec_id", chunk)
    routed = asked.mapInArrow(_route(index, length, max(least, int(share * n))), f"vec_id long, v {kind}, chunk int, grp int, cells binary")
    left = dealt.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    pairs = left.groupBy("grp", "chunk").cogroup(routed.groupBy("grp", "chunk"))
    return best(pairs.applyInArrow(_rerank(length, k), "query_id long, vec_id long, score double"), k, True)
