import numpy as np
import pytest
import xxhash

from runway.llm import simhash

from .cases import ODD, docs, empty


def brute_print(text, words=3):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, radius):
    root = list(range(len(prints)))
    for _ in root:
        changed = False
        for i in range(len(prints)):
            for j in range(len(prints)):
                if bin(prints[i] ^ prints[j]).count("1") <= radius and root[j] < root[i]:
                    root[i], changed = root[j], True
        if not changed:
            break
    return root


def test_fingerprint_is_the_majority_of_shingle_hashes():
    for _, text, *_ in ODD:
        assert simhash.fingerprint(text) & (1 << 64) - 1 == brute_print(text)
    assert simhash.fingerprint("a b c d e f g", step=2) == simhash.fingerprint("a b c d e f g")


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
@pytest.mark.parametrize("same", [True, False])
def test_bit_sliced_links_equal_all_distances(radius, same):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 70, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for _ in range(70)], dtype=np.uint64)
    a = np.concatenate([base, base ^ flips])
    b = a if same else np.concatenate([base[::3] ^ np.uint64(1), a[:9]])
    i, j = simhash.bit_sliced_links(a, b, radius, same)
    want = {(x, y) for x in range(len(a)) for y in range(len(b)) if (not same or x < y) and bin(int(a[x] ^ b[y])).count("1") <= radius}
    assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)


@pytest.mark.parametrize("block", [1024, 4])
def test_components_equal_brute_force(spark, block):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 25, dtype=np.uint64).tolist()
    prints = list(base)
    for p in base[:8]:  # chains of near copies, and one crowded neighbourhood
        q = p
        for _ in range(6):
            for b in rng.choice(64, rng.integers(1, 4), replace=False):
                q ^= 1 << int(b)
            prints.append(q)
    prints += [base[0] ^ 1 << b for b in range(30)]
    prints = list(dict.fromkeys(prints))
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    found = simhash.components(simhash.links(df, 3, 5, block)).collect()
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    of = {r["node"]: r["root"] for r in found}
    got = [of.get(p, p) for p in signed]
    want = brute_components(prints, 3)
    assert len({(a, b) for a, b in zip(got, want)}) == len(set(got)) == len(set(want))


def test_odd_rows(spark):
    got = simhash.near_duplicates(docs(spark)).collect()
    assert len(got) == len(ODD)
    component = {(r["doc_id"], r["fp"]): r["component_id"] for r in got}
    prints = [brute_print(t) for _, t, *_ in ODD]
    roots = brute_components(prints, 3)
    for (doc, *_), p, root in zip(ODD, prints, roots):
        least = min((d for (d, *_), r in zip(ODD, roots) if r == root and d is not None), default=None)
        assert component[(doc, p - (1 << 64) if p >> 63 else p)] == least
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_one_row_of_each_class_stays(spark):
    kept = simhash.one_of_each(docs(spark))
    assert kept.columns == docs(spark).columns
    assert sorted((r["doc_id"] or -1, len(r["text"] or "")) for r in kept.collect()) == sorted(
        [(1, 44), (3, 0), (-1, 16), (7, len(ODD[7][1])), (8, len(ODD[8][1])), (9, 4), (10, 200_000), (10, 27)])
    assert simhash.one_of_each(empty(spark)).count() == 0
