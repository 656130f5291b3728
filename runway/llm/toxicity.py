"""Operator 9: toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's score is a logistic function of its hashed words and byte
n-grams; the document's score is their noisy-or, 1 - (1 - s1)(1 - s2)...: one offending sentence is enough.  Only
documents are labelled: numpy gradient steps on the likelihood of the documents' labels push the sentences that explain a positive label up and all sentences of negative documents down.  It
learns in one task from a bounded sample (``per_class`` documents of each label); scoring is spread over all
tasks and reads whole texts.  ``locate`` then gives the sentences that offend.

Sentences end behind '.', '!', '?' and line feeds; one that spans two blocks of a text of over 256 KB counts as two.

Defined cases: an empty, NULL or blank text has no sentence and scores 0; repeated rows get equal scores; without
labelled rows of both classes every score is 0; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .features import Block, feature_blocks, labelled_sample

BITS, GRAMS = 20, (5, 7)

_ENDS = np.zeros(256, dtype=bool)
_ENDS[list(b".!?\n")] = True


@dataclass
class Model:
    """weights of the buckets and the constant of a sentence; trained says whether there were labels of both kinds."""
    weights: np.ndarray
    bias: float
    trained: bool = True


def sentences(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """First position of every sentence of the block, and whether it has more than ends and white space."""
    first = np.zeros(len(block.x), dtype=bool)
    first[1:] = _ENDS[block.x[:-1]]
    first[block.starts] = True
    starts = np.flatnonzero(first)
    return starts, np.add.reduceat((~block.space & ~_ENDS[block.x]).astype(np.int64), starts) > 0


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def telling(docs: list[tuple[np.ndarray, np.ndarray, int]], least: float) -> np.ndarray:
    """Which buckets stand in more of the documents labelled 1 than chance allows: likelihood ratio G2 of ``least`` or more."""
    n = [sum(y == k for *_, y in docs) for k in (0, 1)]
    seen = np.zeros((2, 1 << BITS))
    for buckets, _, y in docs:
        seen[y, np.unique(buckets)] += 1
    def entropy(x):
        return x * np.log(np.maximum(x, 1e-12))
    both, total = seen.sum(axis=0), n[0] + n[1]
    g2 = 2 * (entropy(seen[0]) + entropy(seen[1]) + entropy(n[0] - seen[0]) + entropy(n[1] - seen[1])
              - entropy(both) - entropy(total - both) - entropy(n[0]) - entropy(n[1]) + entropy(total))
    return (g2 >= least) & (seen[1] * n[0] > seen[0] * n[1])


def train(docs: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 8, rate: float = 0.5, start: float = -4.0,
          least: float = 20.0, seed: int = 1) -> Model:
    """From (buckets of all features, first feature of each sentence, label) of each document.

    Only telling buckets take part, so rare ones aren't learned by heart.
    """
    rng = np.random.default_rng(seed)
    weights, bias = np.zeros(1 << BITS), start
    docs = [d for d in docs if len(d[1])]
    if len({y for *_, y in docs}) < 2:
        return Model(weights.astype(np.float32), -50.0, False)
    used, bags = telling(docs, least), []
    for buckets, starts, y in docs:
        sentence = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(buckets)))
        keep = used[buckets]
        bags.append((buckets[keep], sentence[keep], len(starts), y))
    steps, step = epochs * len(bags), 0
    for _ in range(epochs):
        for k in rng.permutation(len(bags)):
            buckets, sentence, n, y = bags[k]
            lr = rate * (1 - step / steps)
            step += 1
            z = np.bincount(sentence, weights[buckets], n) + bias
            slope = 1 / (1 + np.exp(-np.clip(z, -60, 60)))  # of the sentences' share in -log(1 - p)
            if y:
                p = max(-np.expm1(-_softplus(z).sum()), 1e-9)
                slope = -slope * (1 - p) / p
            np.subtract.at(weights, buckets, lr * slope[sentence])
            bias -= 0.05 * lr * slope.sum()
    return Model(weights.astype(np.float32), float(bias))


def sentence_logits(block: Block, table: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, row and logit of the block's sentences that have words."""
    starts, worded = sentences(block)
    value, _ = block.weigh(table)
    ends = np.append(starts[1:], len(block.x))
    rows = np.searchsorted(block.starts, starts, side="right") - 1
    z = np.add.reduceat(value, starts) + bias
    return starts[worded], ends[worded], rows[worded], z[worded]


def _bags(batches):
    """Documents to the buckets of their features, and where each sentence's features begin."""
    for batch in batches:
        buckets: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
        heads: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
        for block, _ in feature_blocks(batch.column(1), BITS, GRAMS, True):
            at, bucket = block.features()
            starts, worded = sentences(block)
            sentence = np.searchsorted(starts, at, side="right") - 1
            at, bucket, sentence = (a[worded[sentence]] for a in (at, bucket, sentence))
            begins = np.diff(sentence, prepend=-1) != 0
            edges = [*np.searchsorted(at, block.starts), len(at)]
            for i, (a, b) in enumerate(zip(edges, edges[1:])):
                r = block.row + i
                heads[r].append(np.flatnonzero(begins[a:b]) + sum(map(len, buckets[r])))
                buckets[r].append(bucket[a:b])
        joined = [[np.concatenate(x).astype(np.int32).tobytes() for x in both] for both in (buckets, heads)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array(x, pa.binary()) for x in joined)],
                                         ["doc_id", "label", "buckets", "starts"])


def _trained(batches):
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["doc_id"])
    docs = [(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["starts"], np.int32), r["label"]) for r in rows]
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(docs).__dict__)], pa.binary())], ["model"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", learn: Column | None = None, per_class: tuple[int, int] = (6000, 3000)) -> Model:
    """Learn from at most ``per_class`` documents of labels 0 and 1; the model is 4 MB whatever the input."""
    sample = labelled_sample(docs, labels, label, F.lit(True) if learn is None else learn, per_class)
    bags = sample.mapInArrow(_bags, "doc_id long, label int, buckets binary, starts binary")
    found = bags.repartition(1).mapInArrow(_trained, "model binary").collect()  # the bounded sample: one task
    return Model(**pickle.loads(found[0]["model"])) if found else train([])


def scorer(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """A column function: text to the noisy-or of its sentences."""
    table, bias = spark.sparkContext.broadcast(model.weights), model.bias  # 4 MB

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            total = np.zeros(len(texts))
            for block, _ in feature_blocks(texts, BITS, GRAMS, True):
                *_, rows, z = sentence_logits(block, table.value, bias)
                total[block.row:block.row + block.n] += np.bincount(rows, _softplus(z), block.n)
            yield pa.array(-np.expm1(-total))

    return score


def locate(docs: DataFrame, model: Model, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, sentence (trimmed) and score of the sentences that reach the threshold, in no order."""
    table, bias = docs.sparkSession.sparkContext.broadcast(model.weights), model.bias

    def run(batches):
        for batch in batches:
            ids, texts, scores = [], [], []
            for block, _ in feature_blocks(batch.column(1), BITS, GRAMS, True):
                starts, ends, rows, z = sentence_logits(block, table.value, bias)
                p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                for i in np.flatnonzero(p >= threshold):
                    ids.append(batch.column(0)[block.row + int(rows[i])].as_py())
                    texts.append(block.raw[starts[i]:ends[i]].tobytes().decode(errors="replace").strip())
                    scores.append(float(p[i]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(scores, pa.float64())],
                                             ["doc_id", "sentence", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, sentence string, score double")
