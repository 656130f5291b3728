"""Operator 3: quality classifier of supervised subword embeddings.

Words and byte n-grams are hashed to buckets; each bucket has a learned vector, a document is the average of the
vectors of all its features, and a softmax layer gives the score.  Vectors and layer are trained together by
stochastic gradient descent in numpy, in one task, on a bounded sample of labelled documents (``per_class`` of
each label).  Scoring is spread over all tasks and reads whole texts: as the layer is linear in the average, each
bucket's vector is first reduced to its share of the logit.

Defined cases: an empty, NULL or blank text has no feature and the average zero, so its score is that of the
layer's bias (the odds of the sample); repeated rows get equal scores; without
labelled rows of both classes every score is 0.5; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .features import feature_blocks, labelled_sample
from .tables import give_back, lean

BITS, GRAMS, DIM = 16, (3, 4), 12
#: So many features of weight zero stand in every average: a text of a few words hardly leaves the constant.
NEUTRAL = 10


@dataclass
class Model:
    """vectors: one row for each bucket; layer: two rows of weights; bias of each label."""
    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    def logits(self) -> tuple[np.ndarray, float]:
        """Each bucket's share of logit(label 1) - logit(label 0), and the constant."""
        w = self.layer[1] - self.layer[0]
        return (self.vectors @ w).astype(np.float32), float(self.bias[1] - self.bias[0])


def train(docs: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 10, rate: float = 0.3, faster: float = 20.0, seed: int = 1) -> Model:
    """Stochastic gradient descent over (buckets, counts, label); vectors, whose gradients are thin, learn faster."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM))
    layer, bias = np.zeros((2, DIM)), np.zeros(2)
    docs = [(buckets, counts / (counts.sum() + NEUTRAL), y) for buckets, counts, y in docs]
    if len({y for *_, y in docs}) < 2:
        return Model(0 * vectors.astype(np.float32), layer, bias)
    steps, step = epochs * len(docs), 0
    for _ in range(epochs):
        for k in rng.permutation(len(docs)):
            buckets, share, y = docs[k]
            lr = rate * (1 - step / steps)
            step += 1
            rows = vectors[buckets]
            hidden = share @ rows
            slope = _softmax(layer @ hidden + bias)
            slope[y] -= 1
            if abs(slope[y]) < 1e-5:
                continue
            back = slope @ layer
            layer -= lr * np.outer(slope, hidden)
            bias -= lr * slope
            vectors[buckets] = rows - faster * lr * np.outer(share, back)
    return Model(vectors.astype(np.float32), layer, bias)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def _bags(batches):
    """Documents to their buckets and counts."""
    for batch in batches:
        bags: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
        for block, _ in feature_blocks(batch.column(1), BITS, GRAMS, False):
            at, bucket = block.features()
            cuts = np.searchsorted(at, block.starts[1:])
            for i, part in enumerate(np.split(bucket, cuts)):
                bags[block.row + i].append(part)
        found = [np.unique(np.concatenate(b), return_counts=True) for b in bags]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array([b.astype(np.int32).tobytes() for b, _ in found], pa.binary()),
             pa.array([c.astype(np.int32).tobytes() for _, c in found], pa.binary())], ["doc_id", "label", "buckets", "counts"])


def _trained(batches):
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["doc_id"])
    docs = [(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["counts"], np.int32), r["label"]) for r in rows]
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(docs).__dict__)], pa.binary())], ["model"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", learn: Column | None = None, per_class: tuple[int, int] = (1500, 4500)) -> Model:
    """Learn from at most ``per_class`` documents of labels 0 and 1; the model is 3 MB whatever the input."""
    sample = labelled_sample(docs, labels, label, F.lit(True) if learn is None else learn, per_class)
    bags = sample.mapInArrow(lean(_bags), "doc_id long, label int, buckets binary, counts binary")
    found = bags.repartition(1).mapInArrow(lean(_trained), "model binary").collect()  # the bounded sample: one task
    return Model(**pickle.loads(found[0]["model"])) if found else train([])


def scorer(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """A column function: text to score, the probability of label 1."""
    table, constant = model.logits()
    table = spark.sparkContext.broadcast(table)  # 256 KB

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            total, count = np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int64)
            for block, _ in feature_blocks(texts, BITS, GRAMS, False):
                v, c = block.weigh(table.value)
                total[block.row:block.row + block.n] += np.add.reduceat(v, block.starts)
                count[block.row:block.row + block.n] += np.add.reduceat(c, block.starts)
            z = constant + total / (count + NEUTRAL)
            yield pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))
        give_back()

    return score
