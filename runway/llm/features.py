"""Hashed word and character n-gram features of Arrow text columns, and the bounded sample of labelled rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import LOWER, SPACE, blocks, span_hashes, text_bytes

#: Bytes of a plain word: letters, digits and every byte of a character beyond ASCII.
_PLAIN = np.array([chr(b).isalnum() or b >= 128 for b in range(256)])
_MULTIPLIERS = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 32, 16, dtype=np.uint32) | np.uint32(1)


class Block:
    """Some rows of a text column with a space before each row, and their features as buckets.

    Each feature stands at a byte position of ``x``; 2**bits buckets hold words (runs of plain bytes, A-Z
    lower-cased) and byte n-grams that hold no white space but at their ends.
    """

    def __init__(self, row: int, buf: np.ndarray, offsets: np.ndarray, bits: int, grams: tuple[int, ...], lower: bool):
        self.row, self.n = row, len(offsets) - 1
        x = np.full(len(buf) + self.n + max(grams), 32, dtype=np.uint8)
        text = np.ones(len(x), dtype=bool)
        self.starts = offsets[:-1] + np.arange(self.n)  # of the rows, each at its leading space
        text[self.starts] = False
        text[len(buf) + self.n:] = False
        x[text] = buf
        self.raw, self.x, self.space = x, LOWER[x] if lower else x, SPACE[x]
        self.bits, self.grams = bits, grams

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Position and bucket of every plain word, and again of every word that repeats the one before it.

        Of all word pairs only those repeats are features; they share bucket 0, whatever the word.
        """
        plain = _PLAIN[self.x]
        edge = np.diff(plain.astype(np.int8), prepend=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        hashes = span_hashes(self.x, starts, ends)
        row = np.searchsorted(self.starts, starts, side="right")
        again = 1 + np.flatnonzero((hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1]))
        bucket = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        return np.concatenate([starts, starts[again]]), np.concatenate([bucket, np.zeros(len(again), dtype=np.int64)])

    def ngrams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each n: the bucket at every position, and which positions count."""
        x = np.where(self.space, np.uint8(32), self.x).astype(np.uint32)
        for n in self.grams:
            size = len(x) - n + 1
            h = np.full(size, np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF))
            for j in range(n):
                h += x[j:j + size] * _MULTIPLIERS[j]
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            inside = np.zeros(size, dtype=bool)
            for j in range(1, n - 1):
                inside |= self.space[j:j + size]
            yield (h >> np.uint32(32 - self.bits)).astype(np.int64), ~inside

    def weigh(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """At each position the sum of the table's values and the number of its features."""
        value, count = np.zeros(len(self.x)), np.zeros(len(self.x), dtype=np.int64)
        at, bucket = self.words()
        np.add.at(value, at, table[bucket])
        np.add.at(count, at, 1)
        for bucket, valid in self.ngrams():
            # An n-gram that begins with the space between two words counts where the second begins.
            value[1:len(bucket) + 1] += np.where(valid, table[bucket], 0)
            count[1:len(bucket) + 1] += valid
        return value, count

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Position and bucket of every feature, in order of positions."""
        found = [self.words()]
        for bucket, valid in self.ngrams():
            at = np.flatnonzero(valid)
            found.append((at + 1, bucket[at]))
        at, bucket = (np.concatenate(a) for a in zip(*found))
        order = np.argsort(at, kind="stable")
        return at[order], bucket[order]


def feature_blocks(column: pa.Array, bits: int, grams: tuple[int, ...], lower: bool) -> Iterator[tuple[Block, bool]]:
    """Blocks of a column, and whether the block ends its last row; only blocks of one row can end inside it."""
    for row, buf, offsets, ended in blocks(*text_bytes(column), 1 << 18):
        yield Block(row, buf, offsets, bits, grams, lower), ended


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: tuple[int, int]) -> DataFrame:
    """doc_id, text and label (0 or 1) of at most ``per_class`` documents of labels 0 and 1.

    ``learn`` says which rows of ``labels`` may be used.  A document with contradicting labels is left out.  Ids are
    taken in the order of a hash, so the sample is the same on every run and spread over the whole table.
    """
    known = labels.where(learn & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min(label).cast("int").alias("_label"), F.max(label).cast("int").alias("_most")).where("_label = _most")
    spread = known.withColumn("_spread", F.xxhash64("doc_id"))
    chosen = [spread.where(F.col("_label") == y).orderBy("_spread", "doc_id").limit(per_class[y]) for y in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1]).select(F.col("doc_id").alias("_id"), "_label")
    rows = docs.select(F.col("doc_id"), F.col("text")).where(F.col("text").isNotNull())
    # At most sum(per_class) ids, so the broadcast is bounded; of repeated ids one text stays.
    joined = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    return joined.groupBy("doc_id").agg(F.max("text").alias("text"), F.first("_label").alias("label"))
