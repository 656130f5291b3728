import re
from collections import defaultdict

import pytest

from runway.llm import mixing

from .cases import ODD, docs, empty


def targets(sizes):
    """Water level by bisection: an independent way to the targets."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, lo, hi = sum(sizes.values()), 0.0, 3.0 * sum(sizes.values()) + 1
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(3 * sizes[s], mid * weight[s]) for s in sizes) < total else (lo, mid)
    return {s: min(3 * sizes[s], hi * weight[s]) for s in sizes}


def size(text):
    return len(re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode()))


def check(rows, given):
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, _, source in given:
        sizes[source] += size(text)
    want = targets(sizes)
    assert len(rows) == len(given)
    assert sorted((r["doc_id"] or -1, r["size"]) for r in rows) == sorted((d or -1, size(t)) for d, t, *_ in given)
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9, abs=1e-6)
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5001


def test_odd_rows(spark):
    check(mixing.mix(docs(spark)).collect(), ODD)
    assert mixing.mix(empty(spark)).count() == 0


def test_a_hot_source_and_a_rerun(spark):
    given = [(i, "w " * (i % 37 + 1), "en", "hot" if i % 3 else f"s{i % 5}") for i in range(700)] + [(9000, None, None, None)]
    a = mixing.mix(docs(spark, given)).collect()
    check(a, given)
    b = mixing.mix(docs(spark, given).repartition(7)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in a) == sorted((r["doc_id"], r["taken"]) for r in b)


def test_mixed_documents_follow_the_plan(spark):
    given = [(i, f"a{i} b\tc{i}  d\n e" * (i % 3 + 1), "en", "xyz"[i % 3 % (i % 2 + 1)]) for i in range(60)] + [(61, None, None, "x"), (5, "same", "en", "x"), (5, "same", "en", "x")]
    df = docs(spark, given)
    plan = mixing.mix(df).collect()
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    words = defaultdict(int)
    for r in out.collect():
        words[r["doc_id"], r["source"]] += size(r["text"])
        assert r["n_chars"] == len(r["text"])
    want = defaultdict(int)
    for r in plan:
        want[r["doc_id"], r["source"]] += r["taken"]
    for k in want:
        assert abs(words[k] - want[k]) <= 1, k
    assert mixing.mixed_documents(empty(spark)).count() == 0


def test_equal_rows_take_the_whole_budget(spark):
    given = [(5, "same", "en", "x")] * 10 + [(6, "a b c", "en", "x")] + [(i, "one two three four", "en", "y") for i in range(20, 23)] + [(30, "u v", "en", "z")]
    df = docs(spark, given).drop("taken")
    plan = mixing.mix(df).cache()
    want, got = defaultdict(int), defaultdict(int)
    for r in plan.collect():
        want[r["doc_id"]] += r["taken"]
    for r in mixing.mixed_documents(df, plan).collect():
        got[r["doc_id"]] += size(r["text"])
    assert want[5] % 10
    assert got == {k: v for k, v in want.items() if v}
