"""Held-out accuracy on the given labels, and odd rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from runway.llm import features, quality, queries, toxicity
from runway.llm.tables import crc32_mod

from .cases import ODD, docs, empty

SF = "/root/testdata/sf0.1"


def outcomes(spark, query, label):
    rows = query(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out")
    return {(r[0], r[1]): r[2] for r in rows.groupBy(label, "predicted").count().collect()}


def test_held_out_quality(spark):
    got = outcomes(spark, queries.op3_quality, "quality")
    assert got.get((1, 0), 0) <= 0.01 * (got[1, 1] + got.get((1, 0), 0))
    assert got[0, 0] >= 0.93 * (got[0, 0] + got.get((0, 1), 0))


def test_held_out_toxicity(spark):
    got = outcomes(spark, queries.op9_toxicity, "toxic")
    assert got[1, 1] >= 0.8 * (got[1, 1] + got[1, 0])
    assert got.get((0, 1), 0) <= 0.01 * got[0, 0]


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows(spark, module, label):
    given = docs(spark)
    rows = [(1, 1, 0), (2, 0, 1), (2, 0, 1), (7, 1, 0), (8, None, None), (9, 1, 0), (9, 0, 1), (None, 1, 1), (777, 1, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    for marked in (labels, labels.limit(0)):
        model = module.fit(given, marked, label=label)
        got = given.select("doc_id", "text", module.scorer(spark, model)("text").alias("score")).collect()
        assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
        same = {r["score"] for r in got if r["doc_id"] == 2}
        assert len(same) == 1
    assert empty(spark).select(module.scorer(spark, model)("text").alias("score")).count() == 0
    module.fit(empty(spark), labels, label=label)


def test_sample_is_bounded_and_leaves_held_out_rows_alone(spark):
    given = spark.createDataFrame([(i % 200, f"text {i}") for i in range(600)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    got = features.labelled_sample(given, labels, "quality", crc32_mod(F.col("doc_id"), 4) != 2, (30, 50)).collect()
    assert sum(r["label"] == 0 for r in got) == 30 and sum(r["label"] == 1 for r in got) == 50
    import zlib
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 for r in got)


def test_features_do_not_depend_on_the_other_rows():
    texts = ["One two two.", "", None, " ... ", "É über x", "One two two."]
    both = pa.array(texts)
    table = np.random.default_rng(0).normal(size=1 << 16)

    def sums(column):
        return [x for b, _ in features.feature_blocks(column, 16, (3, 4), True) for x in np.add.reduceat(b.weigh(table)[0], b.starts)]
    assert np.allclose(sums(both), [sums(pa.array([t], pa.string()))[0] for t in texts])
    block, _ = next(features.feature_blocks(both, 16, (3, 4), True))
    at, bucket = block.features()
    assert np.allclose(np.bincount(np.searchsorted(block.starts, at, side="right") - 1, table[bucket], len(texts)), sums(both))


def test_offending_sentences_are_located(spark):
    clean = ["The day was fine.", "We walked home!", "Nothing else happened, I think?", "Rain fell on the roof."]
    rows = []
    for i in range(400):
        sentences = [clean[(i + j) % 4] for j in range(3)]
        if i % 2:
            sentences.insert(i % 3, f"You are a {['rotter', 'blighter'][i % 4 // 2]}, {i}.")
        rows.append((i, " ".join(sentences)))
    given = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int")
    model = toxicity.fit(given, labels)
    scores = given.select("doc_id", toxicity.scorer(spark, model)("text").alias("score")).collect()
    assert all((r["score"] >= 0.5) == (r["doc_id"] % 2 == 1) for r in scores)
    found = toxicity.locate(given, model).collect()
    assert {r["doc_id"] for r in found} == set(range(1, 400, 2)) and all("You are a" in r["sentence"] for r in found)
