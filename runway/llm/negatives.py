"""Operator 11: hard negatives, by score bounds along a spanning tree of the anchors.

Anchors are dealt to chunks of near ones.  In a chunk a minimum spanning tree joins them.  The root's scores with a tile
of candidates are computed; a child's score with candidate c differs from its parent's by at most the edge's length
times |c|, so it lies in an interval around it.  Only candidates whose interval overlaps what the child still looks for
are scored, in 64-bit integers; the others hand their interval, wider by the next edge, on to the child's children.

First the positives: chunks of anchors of one label meet blocks of rows of that label, looking for scores from the k-th
best found on.  Then the negatives: each positive opens a window of scores, chunks of anchors meet blocks of all rows,
looking for rows of other labels in a window, from the third best found in it on.  Both run in cogroups of bounded
size, and a block returns at most k rows for an anchor, or for an anchor and positive; a label that most rows
have is many blocks.

Defined cases: see ``vectors.whole`` for vectors that take no part, nor do rows with a NULL label; a repeated row is
another row, also to its own copy; a row with a NULL id is no anchor and comes last among equal scores; a positive
with a negative score has an empty window; an empty table gives an empty result; scores beyond 64 bits wrap; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stage
from .topk import quantised
from .vectors import matrix, whole

#: Candidates of a tile; the intervals of a chunk of anchors with a tile are held at once.
TILE = 2048
#: Cells by which anchors are dealt to chunks, at most.
PIVOTS = 64
_LAST = np.iinfo(np.int64).max


def spanning_tree(q: np.ndarray) -> list[tuple[int, int, float]]:
    """(node, parent, distance) of a minimum spanning tree over the rows, parents first; the root's parent is -1."""
    left = np.arange(1, len(q))
    parent = np.zeros(len(left), dtype=int)
    square = ((q[left] - q[0]).astype(np.float64) ** 2).sum(axis=1)
    tree = [(0, -1, 0.0)]
    while len(left):
        i = int(square.argmin())
        node = int(left[i])
        tree.append((node, int(parent[i]), float(np.sqrt(square[i]))))
        left, parent, square = np.delete(left, i), np.delete(parent, i), np.delete(square, i)
        d = ((q[left] - q[node]).astype(np.float64) ** 2).sum(axis=1)
        nearer = d < square
        parent[nearer], square[nearer] = node, d[nearer]
    return tree


class Scores:
    """Integer inner products of chosen rows; through doubles where these hold all sums exactly."""

    def __init__(self, q: np.ndarray, c: np.ndarray):
        peak = (int(np.abs(q).max(initial=0)) + 1) * (int(np.abs(c).max(initial=0)) + 1) * q.shape[1]
        kind = np.float64 if peak < 1 << 53 else np.int64
        self.q, self.c = q.astype(kind), c.astype(kind)

    def of(self, anchor: int, chosen: np.ndarray) -> np.ndarray:
        rows = self.c if len(chosen) == len(self.c) else self.c[chosen]
        return (rows @ self.q[anchor]).astype(np.int64)


def descend(tree, scores: Scores, norms: np.ndarray, wanted, found) -> int:
    """Walk the tree over one tile of candidates; returns how many scores were computed.

    ``wanted(anchor, low, high)`` marks the candidates to score, ``found(anchor, chosen, score)`` takes them.
    """
    m, n = len(tree), len(norms)
    middle, radius = np.empty((m, n)), np.empty((m, n))
    computed = 0
    for node, parent, edge in tree:
        if parent < 0:
            mid, rad = np.zeros(n), np.full(n, np.inf)
        else:
            mid = middle[parent]
            # The slack covers the rounding of distances, norms and of scores beyond 2**53.
            rad = radius[parent] + (edge * norms) * (1 + 1e-9) + np.abs(mid) * 1e-12 + 1e-6
        chosen = np.flatnonzero(wanted(node, mid - rad, mid + rad))
        exact = scores.of(node, chosen)
        computed += len(chosen)
        middle[node], radius[node] = mid, rad
        middle[node, chosen], radius[node, chosen] = exact, 0.0
        if parent < 0 and len(chosen) < n:  # children need finite intervals
            rest = np.flatnonzero(np.isinf(radius[node]))
            middle[node, rest], radius[node, rest] = scores.of(node, rest), 0.0
            computed += len(rest)
        found(node, chosen, exact)
    return computed


def _best(held: tuple, ids: np.ndarray, rows: np.ndarray, score: np.ndarray, k: int) -> tuple:
    """The k best of those held and the new ones: highest score, then smallest id, then row."""
    ids, rows, score = (np.concatenate(x) for x in zip(held, (ids, rows, score)))
    order = np.lexsort((rows, ids, -score))[:k]
    return ids[order], rows[order], score[order]


def _nothing() -> tuple:
    return (np.zeros(0, dtype=np.int64),) * 3


def _columns(table: pa.Table, length: int, scale: int):
    ids = table["vec_id"].combine_chunks().fill_null(_LAST).to_numpy()
    return ids, table["row"].to_numpy(), quantised(matrix(table["v"], length), scale)


def _tiles(q, c):
    tree = spanning_tree(q)
    for at in range(0, len(c), TILE):
        part = c[at:at + TILE]
        yield at, tree, Scores(q, part), np.sqrt((part.astype(np.float64) ** 2).sum(axis=1))


def _positives(length: int, scale: int, k: int):
    """Rows and anchors of one label: the k best other rows of each anchor."""
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [], [], [], []
        if rows.num_rows and anchors.num_rows:
            _, a_rows, q = _columns(anchors, length, scale)
            ids, c_rows, c = _columns(rows, length, scale)
            held = [_nothing() for _ in q]
            for at, tree, scores, norms in _tiles(q, c):
                t_ids, t_rows = ids[at:at + TILE], c_rows[at:at + TILE]

                def wanted(a, low, high):
                    other = t_rows != a_rows[a]
                    least = held[a][2][-1] if len(held[a][2]) == k else -np.inf
                    if other.sum() >= k:
                        least = max(least, np.partition(np.where(other, low, -np.inf), -k)[-k])
                    return other & (high >= least)

                def found(a, chosen, score):
                    if len(held[a][2]) == k:
                        keep = score >= held[a][2][-1]
                        chosen, score = chosen[keep], score[keep]
                    if len(chosen):
                        held[a] = _best(held[a], t_ids[chosen], t_rows[chosen], score, k)

                descend(tree, scores, norms, wanted, found)
            for a, (i, r, s) in enumerate(held):
                for column, values in zip(out, ([a_rows[a]] * len(i), i, r, s)):
                    column.extend(values)
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("anchor", "vec_id", "row", "score"), out)})
    return run


def windows(scores: list[int], low: int, high: int) -> list[tuple[int, int]]:
    """Scores s with low * score <= 100 * s <= high * score, for each score."""
    return [(-(-low * s // 100), high * s // 100) for s in scores]


def _negatives(length: int, scale: int, k: int, low: int, high: int):
    """Rows of other labels: for each window of each anchor the k best in it."""
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [], [], [], [], []
        if rows.num_rows and anchors.num_rows:
            _, a_rows, q = _columns(anchors, length, scale)
            a_label, positives = anchors["label"].to_pylist(), anchors["positives"].to_pylist()
            ids, c_rows, c = _columns(rows, length, scale)
            code = {x: i for i, x in enumerate(sorted({*a_label, *rows["label"].unique().to_pylist()}))}
            label = np.array([code[x] for x in rows["label"].to_pylist()])
            # Equal scores of an anchor's positives open the same window.
            asked = [sorted({p["score"] for p in found}) for found in positives]
            bounds = [windows(s, low, high) for s in asked]
            held = [[_nothing() for _ in s] for s in asked]
            for at, tree, scores, norms in _tiles(q, c):
                t_ids, t_rows, t_label = ids[at:at + TILE], c_rows[at:at + TILE], label[at:at + TILE]

                def wanted(a, lo, hi):
                    some = np.zeros(len(lo), dtype=bool)
                    for (least, most), best in zip(bounds[a], held[a]):
                        if least <= most:
                            some |= (hi >= (best[2][-1] if len(best[2]) == k else least)) & (lo <= most)
                    return some & (t_label != code[a_label[a]])

                def found(a, chosen, score):
                    for w, (least, most) in enumerate(bounds[a]):
                        best = held[a][w]
                        at_least = best[2][-1] if len(best[2]) == k else least
                        inside = np.flatnonzero((score >= at_least) & (score <= most))
                        if len(inside) > 64:  # ties at the k-th stay
                            inside = inside[score[inside] >= np.partition(score[inside], -k)[-k]]
                        if len(inside):
                            held[a][w] = _best(best, t_ids[chosen[inside]], t_rows[chosen[inside]], score[inside], k)

                descend(tree, scores, norms, wanted, found)
            for a, found in enumerate(positives):
                for p in found:
                    i, r, s = held[a][asked[a].index(p["score"])]
                    for column, values in zip(out, ([a_rows[a]] * len(i), [p["place"]] * len(i), i, r, s)):
                        column.extend(values)
        return pa.table({n: pa.array(x, t) for n, x, t in zip(("anchor", "place", "vec_id", "row", "score"), out,
                                                              (pa.int64(), pa.int32(), *[pa.int64()] * 3))})
    return run


def _cells(pivots: np.ndarray, length: int, scale: int):
    """Nearest pivot of each anchor."""
    def run(batches):
        for batch in batches:
            x = quantised(matrix(batch.column(batch.schema.get_field_index("v")), length), scale).astype(np.float64)
            cell = ((pivots ** 2).sum(axis=1)[None] - 2 * x @ pivots.T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], [*batch.schema.names, "cell"])
    return run


def _spread(column: str, parts: Column, salt: int) -> Column:
    return F.pmod(F.xxhash64(column, F.lit(salt)), parts).cast("int")


def _numbers(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), (parts - 1).cast("int")))


def _ranked(found: DataFrame, group: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def mine(df: DataFrame, anchors: Column, label: Column, positives: int = 5, k: int = 3, low: int = 50, high: int = 95, scale: int = 256,
         id_col: str = "vec_id", vector_col: str = "embedding", chunk: int = 512, block: int = 1 << 14) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is a condition over vec_id.  Its positives are the best rows of the same label; for each, the ``k`` best
    rows of other labels with low * positive_score <= 100 * negative_score <= high * positive_score.
    """
    spark = df.sparkSession
    columns = {"vec_id": F.col(id_col).cast("long"), "label": label}
    rows, n, length = whole(df.where(label.isNotNull()), columns, vector_col, "negatives_rows")
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    asked = rows.where(anchors)
    pivots = asked.orderBy(F.xxhash64("row"), "row").limit(PIVOTS).collect() if n else []
    if not pivots:
        return empty

    # Positives: within each label.
    labels = rows.groupBy("label").agg(F.count("*").alias("n"), F.count_if(anchors).alias("a")).where("a > 0")
    labels = labels.select(F.col("label").alias("of"), F.ceil(F.col("n") / block).alias("blocks"), F.ceil(F.col("a") / chunk).alias("chunks"))
    labels = stage(labels, "negatives_labels")
    own = F.col("label") == F.col("of")
    left = rows.join(labels, own).withColumn("block", _spread("row", F.col("blocks"), 5)).withColumn("chunk", _numbers(F.col("chunks")))
    right = asked.join(labels, own).withColumn("chunk", _spread("row", F.col("chunks"), 3)).withColumn("block", _numbers(F.col("blocks")))
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # columns of its own, not those of ``left``
    key = ["of", "chunk", "block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_positives(length, scale, positives),
                                                                       "anchor long, vec_id long, row long, score long")
    best = stage(_ranked(found, ["anchor"], positives).select("anchor", "place", "vec_id", "score"), "negatives_positives")

    # Negatives: near anchors in a chunk, in the windows of their positives.
    n_pivots = max(1, min(len(pivots), -(-asked.count() // chunk)))
    centres = quantised(np.array([p["v"] for p in pivots[:n_pivots]], dtype=np.float64), scale).astype(np.float64)
    kinds = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    celled = asked.mapInArrow(_cells(centres, length, scale), f"{kinds}, cell int")
    wanted = best.groupBy("anchor").agg(F.collect_list(F.struct("place", "score")).alias("positives"))  # at most ``positives`` of them
    celled = stage(celled.join(wanted, F.col("row") == F.col("anchor")).drop("anchor"), "negatives_anchors")
    counts = {r["cell"]: r["count"] for r in celled.groupBy("cell").count().collect()}  # at most PIVOTS
    if not counts:
        return empty
    parts = {cell: -(-c // chunk) for cell, c in counts.items()}
    first = {cell: sum(p for other, p in parts.items() if other < cell) for cell in parts}
    lookup = [F.create_map(*[F.lit(x) for pair in m.items() for x in pair])[F.col("cell")] for m in (first, parts)]
    blocks = -(-n // block)
    left = rows.withColumn("block", _spread("row", F.lit(blocks), 5)).withColumn("chunk", _numbers(F.lit(sum(parts.values()))))
    right = celled.withColumn("chunk", lookup[0] + _spread("row", lookup[1], 3)).withColumn("block", _numbers(F.lit(blocks)))
    found = left.groupBy("chunk", "block").cogroup(right.groupBy("chunk", "block")).applyInArrow(
        _negatives(length, scale, k, low, high), "anchor long, place int, vec_id long, row long, score long")
    chosen = _ranked(found.withColumnRenamed("place", "nth"), ["anchor", "nth"], k)
    chosen = chosen.select("anchor", "nth", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = best.select(F.col("anchor").alias("a"), F.col("place").alias("p"), F.col("vec_id").alias("positive_id"),
                        F.col("score").alias("positive_score"))
    names = asked.select(F.col("row").alias("r"), F.col("vec_id").alias("anchor_id"))
    result = chosen.join(pairs, (F.col("anchor") == F.col("a")) & (F.col("nth") == F.col("p"))).join(names, F.col("anchor") == F.col("r"))
    nameless = [F.nullif(F.col(c), F.lit(int(_LAST))).alias(c) for c in ("positive_id", "negative_id")]
    return result.select("anchor_id", nameless[0], "rank", nameless[1], "positive_score", "negative_score")
