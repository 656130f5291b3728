import numpy as np
import pyarrow as pa

from runway.llm import words


def test_words_that_differ_have_different_hashes():
    texts = [f"W{i % 977}x{i % 13} {'long' * 9}{i}" for i in range(12701)]
    found = np.concatenate([h for _, _, h, _ in words.word_hashes(pa.array(texts))])
    expected = [w for t in texts for w in t.lower().split()]
    assert len(found) == len(expected) and len(set(zip(found.tolist(), expected))) == len(set(found.tolist())) == len(set(expected))


def test_powers_are_exact():
    base = int(words._BASE)
    assert [int(x) for x in words._powers(40)] == [pow(base, k, 1 << 64) for k in range(41)]
