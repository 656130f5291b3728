"""Operator 2: byte-level BPE encoding and decoding.

Texts are cut into overlapping chunks that are pre-tokenised in parallel, each from its own start.  Two
neighbouring chunks agree from the first pre-token boundary that both have in their overlap; there the text is
stitched into pieces, and each piece is encoded by itself.  A chunk that shares no boundary with the next one (a
run of letters longer than the overlap) goes into one piece with it.  Decoding concatenates the raw bytes of the
ids.  A text of one chunk is one piece and stays in the task that reads it; longer texts are spread over tasks.

The pattern must match every character, and must not match a white-space character after any other (all public
patterns of this kind keep both).  Encoding a single pre-token is left to tiktoken.

Defined cases: a NULL text counts as the empty one (no ids); repeated rows give repeated results; rows of an
empty table none; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import lean, stage

#: Pre-tokens up to this length are remembered, up to this many in a worker.
CACHED_CHARS, CACHED = 48, 200_000


class Coder:
    """Encoder and decoder of single pieces, built from the lines of a rank file."""

    def __init__(self, rank_lines: bytes, pattern: str):
        import regex
        import tiktoken

        pairs = (line.split() for line in rank_lines.splitlines() if line)
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.split = regex.compile(pattern).findall
        self.bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.token = dict(zip(ranks.values(), ranks))
        self.decimal = {i: str(i) for i in self.token}
        self.known: dict[str, list[int]] = {}

    def encode(self, text: str) -> list[int]:
        known, bpe = self.known, self.bpe
        if len(known) > CACHED:
            known.clear()
        pieces = self.split(text)
        ids = []
        for piece in pieces:
            found = known.get(piece)
            if found is None:
                found = bpe(piece)
                if len(piece) <= CACHED_CHARS:
                    known[piece] = found
            ids.append(found)
        return list(chain.from_iterable(ids))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    def digests(self, ids: list[int]) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of their decimal text and of the decoded bytes."""
        text = ",".join(map(self.decimal.__getitem__, ids))
        return len(ids), hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(self.decode(ids)).hexdigest()


def overlap_boundaries(split, text: str, chunk: int, overlap: int) -> tuple[list[int], list[int], bool]:
    """Boundaries of a chunk's pre-tokens in its first ``overlap`` characters, and in those behind ``chunk`` (counted
    from there); whether a boundary that no starting point can shift lies before ``chunk``.

    Only boundaries behind a character that isn't white space count: a piece that ends there has the same pre-tokens
    alone as in the text.  The last tokens and characters may change with the text behind the chunk and don't count.
    """
    ends = list(accumulate(map(len, split(text))))
    settled = [p for p in ends[:-2] if p <= len(text) - 8 and not text[p - 1].isspace()]
    sure = any(text[p].isspace() for p in settled if p < chunk)
    return [p for p in settled if p < overlap], [p - chunk for p in settled if p >= chunk], sure


def stitch(chunks: list[tuple[list[int], list[int], bool]], chunk: int) -> list[int]:
    """Starts of the pieces, from the boundaries of all chunks of one text in order."""
    cuts, right = [0], True
    for k, ((_, tails, _), (heads, _, sure)) in enumerate(zip(chunks, chunks[1:])):
        common = set(tails).intersection(heads) if right else ()
        if common:
            cuts.append((k + 1) * chunk + min(common))
        # Behind a shared boundary the next chunk's pre-tokens are the text's; else only behind one that can't shift.
        right = bool(common) or sure
    return cuts


def _strings(batch: pa.RecordBatch, i: int) -> Iterator[str]:
    return (x or "" for x in batch.column(i).to_pylist())


def _ids_column(lists: list[list[int]]) -> pa.Array:
    return pa.array([np.asarray(x, dtype=np.int32) for x in lists], pa.list_(pa.int32()))


def _plain(ranks, pattern: str, digests: bool):
    """Encode whole texts: (doc_id, text) to (doc_id, ids) or (doc_id, digests)."""
    def run(batches):
        coder = Coder(ranks.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = map(coder.encode, _strings(part, 1))
                yield _result([part.column(0)], ["doc_id"], found, coder, digests)
    return run


def _result(keys, names, ids, coder, digests) -> pa.RecordBatch:
    if not digests:
        return pa.RecordBatch.from_arrays([*keys, _ids_column(list(ids))], [*names, "ids"])
    n, a, b = zip(*map(coder.digests, ids))
    return pa.RecordBatch.from_arrays([*keys, pa.array(n, pa.int64()), pa.array(a), pa.array(b)],
                                      [*names, "n_tokens", "ids_sha256", "decoded_sha256"])


def _scan(pattern: str, chunk: int, overlap: int):
    def run(batches):
        import regex
        split = regex.compile(pattern).findall
        for batch in batches:
            heads, tails, sure = zip(*[overlap_boundaries(split, t, chunk, overlap) for t in _strings(batch, 2)]) if batch.num_rows else ([],) * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(heads, pa.list_(pa.int32())),
                                              pa.array(tails, pa.list_(pa.int32())), pa.array(sure, pa.bool_())],
                                             ["key", "k", "heads", "tails", "sure"])
    return run


def _pieces(ranks, pattern: str):
    def run(batches):
        coder = Coder(ranks.value, pattern)
        for batch in batches:
            ids = [np.asarray(coder.encode(t), dtype=np.int32).tobytes() for t in _strings(batch, 2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], ["key", "k", "ids"])
    return run


def _gathered(ranks, pattern: str, digests: bool):
    def run(batches):
        coder = Coder(ranks.value, pattern)
        for batch in batches:
            for at in range(batch.num_rows):
                parts = batch.column(1)[at].as_py()
                ids = np.frombuffer(b"".join(p["ids"] for p in sorted(parts, key=lambda p: p["k"])), dtype=np.int32).tolist()
                yield _result([batch.column(0).slice(at, 1)], ["key"], [ids], coder, digests)
    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           digests: bool = False, chunk: int = 1 << 16, overlap: int = 1 << 10) -> DataFrame:
    """doc_id and ids of every text; with ``digests``, their number and the digests of ids and decoded bytes instead."""
    spark = docs.sparkSession
    with open(ranks_path, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())  # the vocabulary: about 1 MB, whatever the input
    out = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    fits = F.coalesce(F.length("text"), F.lit(0)) <= chunk
    short = rows.where(fits).mapInArrow(lean(_plain(ranks, pattern, digests)), f"doc_id long, {out}")

    # Longer texts, each once: repeated texts share key and result.
    keyed = rows.where(~fits).withColumn("key", F.sha2("text", 256))
    ids = keyed.select("doc_id", "key")
    texts = stage(keyed.groupBy("key").agg(F.any_value("text").alias("text")), "bpe_long")
    starts = texts.select("key", "text", F.explode(F.sequence(F.lit(0), F.ceil(F.length("text") / chunk).cast("int") - 1)).alias("k"))
    chunks = starts.select("key", "k", F.substring("text", F.col("k") * chunk + 1, F.lit(chunk + overlap)).alias("text"))
    scanned = chunks.repartition("key", "k").mapInArrow(
        lean(_scan(pattern, chunk, overlap)), "key string, k int, heads array<int>, tails array<int>, sure boolean")

    @F.pandas_udf("array<int>")
    def cuts(parts: pd.Series) -> pd.Series:
        ordered = (sorted(p, key=lambda x: x["k"]) for p in parts)
        return pd.Series([stitch([(list(x["heads"]), list(x["tails"]), x["sure"]) for x in p], chunk) for p in ordered])

    joints = scanned.groupBy("key").agg(F.collect_list(F.struct("k", "heads", "tails", "sure")).alias("parts"))
    joints = stage(joints.select("key", cuts("parts").alias("cuts")), "bpe_joints")
    cut = texts.join(joints, "key").select("key", "text", "cuts", F.posexplode("cuts").alias("k", "start"))
    end = F.coalesce(F.get("cuts", F.col("k") + 1), F.length("text"))
    pieces = cut.select("key", "k", F.substring("text", F.col("start") + 1, end - F.col("start")).alias("text"))
    coded = pieces.repartition("key", "k").mapInArrow(lean(_pieces(ranks, pattern)), "key string, k int, ids binary")
    gathered = coded.groupBy("key").agg(F.collect_list(F.struct("k", "ids")).alias("parts"))
    long = gathered.mapInArrow(lean(_gathered(ranks, pattern, digests)), f"key string, {out}")
    return short.unionByName(ids.join(long, "key").drop("key"))


def decode(rows: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with the bytes of their ids; they need not be valid UTF-8 for any list of ids, so they stay binary."""
    with open(ranks_path, "rb") as f:
        ranks = rows.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("binary")
    def joined(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = Coder(ranks.value, pattern)
        for ids in batches:
            yield ids.map(lambda x: None if x is None else coder.decode(list(x)))
    return rows.withColumn(out_col, joined(F.col(ids_col)))
