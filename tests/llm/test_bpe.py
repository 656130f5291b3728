import hashlib

import public_tokenizers
import pytest
import tiktoken

from runway.llm import bpe, queries

from .cases import LONG, ODD, docs, empty

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def whole():
    import base64
    with open(queries.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [LONG[:9000], "x" * 5000, "a b " * 700, "it's they'll 're " * 300, " \n" * 900 + "z", "漢字" * 800 + "。x" * 700, "ab\n\n  cd" * 600,
         ("y" * 700 + " ") * 9, "'r" * 999, "<|endoftext|> " * 200]


@pytest.mark.parametrize("chunk,overlap", [(1 << 16, 1 << 10), (300, 40), (64, 64), (50, 9)])
def test_chunked_ids_equal_those_of_the_whole_text(spark, whole, chunk, overlap):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(99, TEXTS[0]), (1, TEXTS[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = bpe.encode(df, queries.RANKS, PATTERN, chunk=chunk, overlap=overlap)
    assert sorted((r["doc_id"], r["ids"]) for r in got.collect()) == sorted((i, whole.encode_ordinary(t)) for i, t in rows)
    if chunk == 300:
        back = bpe.decode(got, queries.RANKS, PATTERN).select("doc_id", "decoded").collect()
        assert sorted((r[0], bytes(r[1]).decode()) for r in back) == sorted(rows)


def test_stitched_pieces_resynchronise():
    import regex
    split = regex.compile(PATTERN).findall
    text = LONG[:4000]
    parts = [bpe.overlap_boundaries(split, text[k * 100:k * 100 + 130], 100, 30) for k in range(40)]
    cuts = bpe.stitch(parts, 100)
    assert len(cuts) == 40 and cuts == sorted(set(cuts))


def test_digests_of_odd_rows(spark, whole):
    got = bpe.encode(docs(spark), queries.RANKS, PATTERN, digests=True)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = []
    for i, t, *_ in ODD:
        ids = whole.encode_ordinary(t or "")
        want.append((i or 0, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((r[0] or 0, *r[1:]) for r in got.collect()) == sorted(want)
    assert bpe.encode(empty(spark), queries.RANKS, PATTERN).count() == 0
