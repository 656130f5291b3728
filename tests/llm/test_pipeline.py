"""The pipeline's rows against its stages done by hand on a small table."""

import hashlib
import random
from collections import Counter, defaultdict

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from runway.llm import queries
from runway.llm.tables import stage

from .cases import ODD
from .test_mixing import size, targets
from .test_simhash import brute_components, brute_print


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """documents: clean ones in three sources, shouted ones, copies, near copies and a shared passage; labels for all."""
    rng = random.Random(11)
    base = [f"{a}{b}" for a in "ka lo mi nu re so ta vi wo za".split() for b in "ber dan fil gor hes".split()]

    def prose(n):
        return " ".join(" ".join(rng.choice(base) for _ in range(9)).capitalize() + "." for _ in range(n))
    rows, bad = [], set()
    shared = " ".join(f"{w}{i}" for i, w in enumerate(base + base[:20]))
    for i in range(160):
        text = prose(rng.randrange(12, 30))
        if i % 5 == 4:
            text, bad = "!! ".join(text.upper().split()) + "!!", bad | {i}
        if i in (20, 21, 31):
            text += "\n" + shared
        if i in (50, 51, 52):
            text = rows[40][1]
        rows.append((i, text, "en", f"s{rng.randrange(3)}"))
    rows += [rows[40], rows[41], (201, None, None, None), (None, prose(15), "en", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    path = str(tmp_path_factory.mktemp("corpus"))
    df.withColumn("score", F.lit("clash")).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i not in bad), 0) for i in range(160)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows, bad, shared


def test_stages_by_hand(spark, folder):
    path, rows, bad, shared = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    key = lambda r: (r["doc_id"] or -1, r["text"])
    given = docs.collect()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "passages", "mixing", "tokens"]
    out = {}
    for name, apply in corpus_pipeline.STAGES:
        before, docs = docs, stage(apply(spark, docs, path), "test")
        out[name] = docs.collect()
        if name != "tokens":
            assert docs.columns == before.columns
    kept = [r for r in given if r["doc_id"] not in bad]
    assert Counter(map(key, out["quality"])) - Counter(map(key, kept)) == Counter()
    assert {r["doc_id"] for r in kept} - {r["doc_id"] for r in out["quality"]} <= {201}  # an empty text may go

    before = sorted(out["quality"], key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    roots = brute_components([brute_print(r["text"]) for r in before], 3)
    assert Counter(map(key, out["near_duplicates"])) == Counter(key(before[r]) for r in set(roots))

    text = {r["doc_id"]: r["text"] for r in out["passages"]}
    assert len(out["passages"]) == len([r for r in out["near_duplicates"]])
    holders = [i for i in (20, 21, 31) if i in text]
    assert shared in text[holders[0]] and all(len(text[i].split()) < len(dict((r[0], r[1]) for r in rows)[i].split()) - 60 for i in holders[1:])
    assert all(r["text"] == text[r["doc_id"]] for r in out["near_duplicates"] if r["doc_id"] not in holders[1:])
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in out["passages"])

    sizes, mixed = defaultdict(int), defaultdict(int)
    for r in out["passages"]:
        sizes[r["source"]] += size(r["text"])
    for r in out["mixing"]:
        mixed[r["source"]] += size(r["text"])
        assert (text[r["doc_id"]] or "").startswith(r["text"])
    for s, want in targets(sizes).items():
        assert abs(mixed[s] - want) <= 1

    import base64
    with open(queries.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in out["mixing"]:
        ids = whole.encode_ordinary(r["text"] or "")
        want[r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in out["tokens"]) == want
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, path).collect()) == want


def test_odd_rows_and_empty_tables_pass_all_stages(spark, folder, tmp_path):
    path, *_ = folder
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    for rows in (df, df.limit(0)):
        for _, apply in corpus_pipeline.STAGES[1:]:
            rows = stage(apply(spark, rows, path), "test")
        rows.collect()
    labels = spark.read.parquet(f"{path}/labels.parquet")
    labels.limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    df.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
