"""Operator 4: exact top-k inner products of integer vectors, by multi-resolution segment statistics.

Every vector is cut into 1, 4, 16 and more equal segments; of each segment the mean and the deviation are kept.
|q - c|^2 of two segments is at least length * ((mean - mean)^2 + (deviation - deviation)^2), which is the same as:
their inner product is at most length * (mean * mean + deviation * deviation).  Summed over the segments that
bounds the score from above, tighter with every finer resolution.  In a block of candidates the few with the best
finest bounds are scored first; a query's k-th best score then discards, coarse to fine, all whose bound is below,
and only survivors are multiplied out, in 64-bit integers.

Chunks of queries meet blocks of rows in cogroups of bounded size, so work is spread whatever the number of queries;
each returns at most k rows for a query.

Defined cases: see ``vectors.usable`` for vectors that take no part; equal scores go to the smaller vec_id; an empty
table gives an empty result; scores beyond 64 bits wrap; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectors import best, in_chunks, matrix, usable

#: Candidates compared at once, and those scored first for a query's threshold.
TILE, FIRST = 4096, 4


def quantised(x: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(scale * x).astype(np.int64)


def resolutions(length: int) -> list[int]:
    """Numbers of segments, coarse to fine; the finest leaves two components in a segment."""
    found, n = [1], 4
    while n * 2 < length:
        found.append(n)
        n *= 4
    return [*found, length // 2] if length >= 4 and length // 2 > found[-1] else found


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments times the root of their lengths: products of two rows bound the score."""
    edges = np.linspace(0, x.shape[1], segments + 1).round().astype(int)
    lengths = np.diff(edges)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / lengths
    square = np.add.reduceat((x - np.repeat(mean, lengths, axis=1)) ** 2, edges[:-1], axis=1)
    return np.concatenate([mean * np.sqrt(lengths), np.sqrt(square)], axis=1)


def top_of_tile(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of the pairs that may be among a query's k best; ``floor``: scores that k others reach."""
    qf, cf = q.astype(np.float64), c.astype(np.float64)
    slack = 1e-9 * np.sqrt((qf ** 2).sum(axis=1))[:, None] * np.sqrt((cf ** 2).sum(axis=1)).max(initial=0) + 1e-6
    own = q_ids[:, None] == c_ids[None]
    levels = [(statistics(qf, s), statistics(cf, s)) for s in resolutions(q.shape[1])]
    finest = levels[-1][0] @ levels[-1][1].T
    finest[own] = -np.inf
    first = min(len(c), k + FIRST)
    likely = np.argpartition(-finest, first - 1, axis=1)[:, :first]
    scores = np.einsum("qd,qfd->qf", q, c[likely])
    scores[np.take_along_axis(own, likely, axis=1)] = np.iinfo(np.int64).min
    if first >= k:
        floor = np.maximum(floor, -np.partition(-scores.astype(np.float64), k - 1, axis=1)[:, k - 1])
    least = floor[:, None] - slack
    # Coarse to fine: a candidate goes once its bound is below for all queries, a pair once it is for one.
    at, pairs = np.arange(len(c)), ~own
    for a, b in levels[:-1]:
        pairs = pairs & (a @ b[at].T >= least)
        some = pairs.any(axis=0)
        if not some.all():
            at, pairs = at[some], pairs[:, some]
    pairs = pairs & (finest[:, at] >= least)
    i, j = np.nonzero(pairs)
    j = at[j]
    score = np.empty(len(i), dtype=np.int64)
    for s in range(0, len(i), 1 << 16):
        score[s:s + (1 << 16)] = (q[i[s:s + (1 << 16)]] * c[j[s:s + (1 << 16)]]).sum(axis=1)
    keep = score >= floor[i]
    return i[keep], j[keep], score[keep]


def _first_k(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k best of each query: highest score, then smallest id."""
    order = np.lexsort((ids, -score, query))
    heads = np.flatnonzero(np.diff(query[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(heads, np.diff(heads, append=len(order)))
    return order[rank < k]


def _search(length: int, k: int, scale: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        q_ids, c_ids = queries["vec_id"].to_numpy(), rows["vec_id"].to_numpy()
        found = [np.zeros(0, dtype=np.int64)] * 3
        if len(q_ids) and len(c_ids):
            q, c = quantised(matrix(queries["v"], length), scale), quantised(matrix(rows["v"], length), scale)
            floor = np.full(len(q), -np.inf)
            for at in range(0, len(c), TILE):
                i, j, s = top_of_tile(q, q_ids, c[at:at + TILE], c_ids[at:at + TILE], k, floor)
                found = [np.concatenate(x) for x in zip(found, (i, c_ids[at + j], s))]
                kept = _first_k(*found, k)
                found = [x[kept] for x in found]
                full = np.flatnonzero(np.bincount(found[0], minlength=len(q)) == k)
                ends = np.searchsorted(found[0], full, side="right") - 1
                floor[full] = found[2][ends]
        return pa.table({"query_id": pa.array(q_ids[found[0]] if len(q_ids) else found[0], pa.int64()),
                         "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(found[2], pa.int64())})
    return run


def search(df: DataFrame, queries: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
           chunk: int = 512, block: int = 1 << 14) -> DataFrame:
    """query_id, rank, vec_id, score: for the rows where ``queries`` (over vec_id) holds, the k rows with the largest
    inner product of floor(scale * x), the query's own left out."""
    rows, n, length = usable(df, id_col, vector_col, zero=True)
    if not n:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    asked, n_chunks = in_chunks(rows.where(queries), "vec_id", chunk)
    blocks = -(-n // block)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(blocks)).cast("int"))
    left = dealt.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    right = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pairs = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk"))
    return best(pairs.applyInArrow(_search(length, k, scale), "query_id long, vec_id long, score long"), k, False)
