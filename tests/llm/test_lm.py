import math
import os
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from runway.llm import lm, queries
from runway.llm.tables import crc32_mod

from .cases import LONG, ODD, docs, empty


def tokens(text):
    return [*(text or "").encode().lower().split(), "</s>"]


class Brute:
    """The same model from its definition, over dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        grams = Counter()
        for t in texts:
            seq = ["<s>"] * (order - 1) + tokens(t)
            grams.update(tuple(seq[i - order + 1:i + 1]) for i in range(order - 1, len(seq)))
        self.level = {order: grams}
        for n in range(order - 1, 0, -1):
            self.level[n] = Counter()
            for g, c in self.level[n + 1].items():
                self.level[n][g[1:]] += c if g[1] == "<s>" else 1
        self.raw = Counter(w for t in texts for w in tokens(t))
        self.d = {n: lm.discounts(*(sum(c == k for c in g.values()) for k in (1, 2, 3, 4))) for n, g in self.level.items()}
        self.by_context = {n: defaultdict(list) for n in self.level}
        for n, g in self.level.items():
            for k, c in g.items():
                self.by_context[n][k[:-1]].append(c)

    def p(self, gram):
        n = len(gram)
        lower = self.p(gram[1:]) if n > 1 else 1 / (len(self.raw) + 1)
        counts = self.by_context[n][gram[:-1]]
        if not counts:
            return lower
        take = lambda c: self.d[n][min(c, 3)]
        return (self.level[n][gram] - take(self.level[n][gram]) + sum(map(take, counts)) * lower) / sum(counts)

    def score(self, text):
        seq = ["<s>"] * (self.order - 1) + tokens(text)
        return sum(math.log10(self.p(tuple(seq[i - self.order + 1:i + 1]))) for i in range(self.order - 1, len(seq)))

    def base(self, text):
        bottom = sum(self.raw.values()) + 0.5 * (len(self.raw) + 1)
        return sum(math.log10((self.raw[w] + 0.5) / bottom) for w in tokens(text))


@pytest.mark.parametrize("order", [2, 3])
def test_scores_equal_the_definition(spark, order):
    rng = np.random.default_rng(order)
    words = [f"w{int(x)}" for x in rng.zipf(1.4, 4000) if x < 500]
    rows = [(i, " ".join(words[i * 20:i * 20 + int(rng.integers(0, 21))]), None, None) for i in range(150)]
    rows += [r if len(r[1] or "") < 10_000 else (r[0], r[1][:3000], *r[2:]) for r in ODD] + [(500, "never seen before", None, None)]
    given = docs(spark, rows)
    model = lm.fit(given, learn=F.coalesce(F.col("doc_id"), F.lit(0)) % 3 != 1, order=order)
    learned = [t for i, t, *_ in rows if (i or 0) % 3 != 1]
    brute = Brute(learned, order)
    assert (model.tokens, model.words) == (sum(brute.raw.values()), len(brute.raw))
    got = lm.score(given, model).collect()
    want = sorted((i or 0, len(tokens(t)), sum(brute.raw[w] > 0 for w in tokens(t)), brute.base(t), brute.score(t)) for i, t, *_ in rows)
    assert len(got) == len(want)
    for g, w in zip(sorted((r[0] or 0, r[1], r[2], r[3], r[4]) for r in got), want):
        assert g[:3] == w[:3] and g[3] == pytest.approx(w[3]) and g[4] == pytest.approx(w[4])


def test_probabilities_add_up_to_one():
    brute = Brute(["a b a c a b", "b b c", "d a b e f"], 2)
    for context in ("a", "<s>", "never"):
        seen = sum(brute.p((context, w)) for w in brute.raw)
        assert seen + brute.p((context, "?")) == pytest.approx(1)


def test_slices_and_blocks_do_not_change_the_counts(spark, monkeypatch):
    given = spark.createDataFrame([(i, LONG[i * 3000:i * 3000 + 4000]) for i in range(12)], "doc_id long, text string")
    whole = lm.fit(given, bits=4)
    monkeypatch.setattr(lm, "SLICE", 100)
    assert lm.fit(given.repartition(5), bits=7).totals == whole.totals


def test_empty_tables(spark):
    model = lm.fit(empty(spark))
    assert (model.tokens, model.words) == (0, 0)
    assert [r["score"] for r in lm.score(docs(spark).where("doc_id = 9"), model).collect()] == [0.0]
    assert lm.score(empty(spark), lm.fit(docs(spark))).count() == 0


def test_held_out_texts_are_likelier_than_under_the_base(spark):
    rows = queries.op5_language_model(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


def test_the_query_knows_two_words_before(spark, tmp_dir):
    texts = {i: "b a c" if i % 2 else "d a e" for i in range(40)}
    docs(spark, [(i, t, "en", "x") for i, t in texts.items()]).write.parquet(f"{tmp_dir}/documents.parquet")
    rows = queries.op5_language_model(spark, tmp_dir).collect()
    learned = [t for i, t in texts.items() if not any(r["held_out"] for r in rows if r["doc_id"] == i)]
    brute = Brute(learned, 3)
    for r in rows:
        assert r["score"] == pytest.approx(brute.score(texts[r["doc_id"]]))


def test_packed_words_come_back():
    rng = np.random.default_rng(1)
    for most in (9, 1 << 48):
        words, counts = [rng.integers(0, most, 500).astype(np.uint64) for _ in range(3)], [rng.integers(1, 1 << 40, 500).astype(np.uint64)]
        got = lm._unpack(lm._pack(words, counts))
        assert all((a == b).all() for x, y in zip(got, (words, counts)) for a, b in zip(x, y))


def test_blocks_come_in_the_order_of_their_first_words():
    rng = np.random.default_rng(2)
    words, n = [rng.integers(0, 300, 20000).astype(np.uint64) for _ in range(3)], [np.ones(20000, dtype=np.uint64)]
    keys, words, n = lm.summed(lm.gram_hash(words), words, n)
    got = [lm._unpack(d) for d in lm._blocks("gram", 3, 2, keys, words, n).column("data").to_pylist()]
    assert sorted(zip(*words, *n)) == sorted(r for w, c in got for r in zip(*w, *c))
    assert all((w[0][1:] >= w[0][:-1]).all() for w, _ in got)


def test_frequent_words_in_all_blocks_do_not_change_the_scores(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.5, 40) if x < 300), None, None) for i in range(60)]
    brute = Brute([t for _, t, *_ in rows], 3)
    given = docs(spark, rows)
    assert not len(lm._frequent(empty(spark).select("text"), 3, 4))
    monkeypatch.setattr(lm, "SOUGHT", 1.0)
    frequent = lm._frequent(given.select("text"), 3, 4)
    assert 0 < len(frequent) <= 16
    for chosen in (frequent, np.sort(np.append(frequent, lm.START)), np.zeros(0, np.uint64)):
        monkeypatch.setattr(lm, "_frequent", lambda *_: chosen)
        for r in lm.score(given, lm.fit(given, order=3)).collect():
            assert r["score"] == pytest.approx(brute.score(rows[r["doc_id"]][1]))


def test_one_short_text_is_learned(spark):
    given = docs(spark, [(1, "a", None, None), (2, "b a", None, None)])
    brute = Brute(["a"], 3)
    got = {r["doc_id"]: r["score"] for r in lm.score(given, lm.fit(given, learn=F.col("doc_id") == 1, order=3)).collect()}
    assert got == pytest.approx({1: brute.score("a"), 2: brute.score("b a")})


def test_files_keep_a_few_bytes_of_an_n_gram(spark, tmp_dir, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.integers(0, 3000, 1000)), None, None) for i in range(60)]
    monkeypatch.setattr(lm, "shared_uri", lambda *_: f"file:{tmp_dir}/lm")
    model = lm.fit(docs(spark, rows), order=3, bits=2)
    size = sum(os.path.getsize(f"{tmp_dir}/lm/{f}") for f in os.listdir(f"{tmp_dir}/lm"))
    assert size < 8 * (model.totals[3][4] + model.totals[2][4])


def test_slices_go_over_batches(monkeypatch):
    monkeypatch.setattr(lm, "SLICE", 100)
    batches = [pa.RecordBatch.from_arrays([pa.array(["a b c", None, "d"] * 3)], ["text"]) for _ in range(20)]
    got = list(lm._slices(iter(batches), 3))
    assert all(len(full) == len(short) for full, short in got) and all(len(full) >= 100 for full, _ in got[:-1])
    assert len(got) <= 7 and sum(int((full != lm.START).sum()) for full, _ in got) == 20 * 3 * 7


def test_arrays_give_back_all_counts(tmp_dir):
    rng = np.random.default_rng(5)
    for size in (1, 7, 5000):
        keys = np.unique(rng.integers(0, 1 << 62, size, dtype=np.uint64))  # all in the first of four blocks
        counts = [rng.zipf(1.3, len(keys)).clip(1, 1 << 33).astype(np.uint64) for _ in range(2)]
        lm._write(f"file:{tmp_dir}/{size}-0", 2, keys, counts)
        found = lm.HashArrays(f"file:{tmp_dir}/{size}", 2, 2)
        for got, want in zip(found.find(keys[::-1]), counts):
            assert (got == want[::-1]).all()
        assert not any(x.any() for x in found.find(keys ^ np.uint64(1 << 63)) + found.find(keys ^ np.uint64(1 << 30)))
