"""Operator 1: SimHash near-duplicates, by bit-sliced comparison of fingerprints.

Fingerprints: every bit is set where more than half of the XXH64 hashes of a text's shingles set it.  Two texts
are linked if their fingerprints differ in at most ``radius`` bits; classes are the connected components.

Distinct fingerprints are cut into ``bands`` bands of bits.  Two within the radius agree in at least
``bands - radius`` of them, so they meet under one of the keys made of that many bands.  Fingerprints of the
same keys are packed into blocks; in a block one side is stored as 64 bit planes, each word holding one bit of 64
fingerprints.  XOR with a query's bit gives 64 differences at once, carry-save counters add them up plane by
plane, and a word is abandoned once all of its 64 counters have run over the radius.  A key of more than
``block`` fingerprints is compared as a grid of blocks, in different tasks.  A block returns a spanning forest of
its links, not all pairs.

Defined cases: a NULL text counts as the empty one, whose fingerprint is zero and linked like any other; a text
of fewer words than a shingle is one shingle; repeated rows each give a row; a row with NULL doc_id gets a
fingerprint and a component, and is never the smallest; an empty table gives an empty result; other columns
aren't read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import group_starts, grouped_stream, lean, packed, stage, unpacked

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, words: int = 3, step: int = 1 << 18) -> int:
    """The 64-bit SimHash of a text; bounded memory beside the text and its word bounds."""
    import xxhash

    data = b" ".join((text or "").encode().lower().split())
    if not data:
        return 0
    gaps = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 32)
    starts = np.concatenate([[0], gaps + 1])
    ends = np.concatenate([gaps, [len(data)]])[words - 1:]
    if not len(ends):
        starts, ends = starts[:1], np.array([len(data)])
    n, digest, counts = len(ends), xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, n, step):
        spans = zip(starts[at:min(n, at + step)].tolist(), ends[at:at + step].tolist())
        h = np.array([digest(data[a:b], 42) for a, b in spans], dtype="<u8")
        for part in range(0, len(h), 1 << 14):
            bits = np.unpackbits(h[part:part + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def _fingerprints(words: int):
    def run(batches):
        for batch in batches:
            found = [fingerprint(t.as_py(), words) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())],
                                             ["doc_id", "digest", "fp"])
    return run


def band_keys(bands: int, radius: int) -> list[tuple[int, int]]:
    """(number, mask) of every choice of ``bands - radius`` bands."""
    edges = [round(i * 64 / bands) for i in range(bands + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [(i, sum(chosen)) for i, chosen in enumerate(combinations(masks, bands - radius))]


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """64 rows of words; bit i of row p is bit p of print i, padded with zeros."""
    bits = np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    packed = np.zeros((64, -(-len(prints) // 64) * 8), dtype=np.uint8)
    packed[:, :-(-len(prints) // 8)] = np.packbits(bits, axis=1, bitorder="little")
    return packed.view(np.uint64)


def bit_sliced_links(a: np.ndarray, b: np.ndarray, radius: int, same: bool, look: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (i, j) with a[i] and b[j] within ``radius`` bits; i < j only if ``same``."""
    planes = bit_planes(b)
    width = planes.shape[1]
    query = np.where(np.unpackbits(a.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool), _ALL, np.uint64(0))
    i = np.repeat(np.arange(len(a)), width)
    w = np.tile(np.arange(width), len(a))
    over = np.zeros(len(i), dtype=np.uint64)  # lanes that have run over the radius, or don't count
    if len(b) % 64:
        over[w == width - 1] = _ALL << np.uint64(len(b) % 64)
    if same:
        over[w * 64 + 63 <= i] = _ALL
        cut = w == i // 64
        over[cut] |= _ALL >> (np.uint64(63) - (i[cut] % 64).astype(np.uint64))
    # Counters start so that the carry out of the highest bit comes with difference radius + 1.
    n_bits = (radius + 1 - 1).bit_length() or 1
    first = (1 << n_bits) - (radius + 1)
    count = [np.full(len(i), _ALL if first >> k & 1 else 0, dtype=np.uint64) for k in range(n_bits)]
    for p in range(64):
        if p % look == 0:
            alive = np.flatnonzero(over != _ALL)
            if len(alive) < len(i):
                i, w, over = i[alive], w[alive], over[alive]
                count = [c[alive] for c in count]
            if not len(i):
                break
        carry = planes[p][w] ^ query[i, p]
        for k in range(n_bits):
            count[k], carry = count[k] ^ carry, count[k] & carry
        over |= carry
    lanes = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, lane = np.nonzero(lanes)
    return i[at], w[at] * 64 + lane


def forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star from each node to the least node of its component, in place of the links (i, j)."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = np.flatnonzero(root != np.arange(n))
    return moved, root[moved]


def _compare(radius: int, pack: int):
    """Cells (key, lo, hi) of prints, side 0 or 1, to a spanning forest of the links inside each block."""
    def emit(prints, i, j):
        a, b = forest(len(prints), i, j)  # none if there is no link
        s = prints.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(s[a]), pa.array(s[b])], ["u", "v"])

    def run(batches):
        for table in grouped_stream(batches, ["key", "lo", "hi"], 1 << 14):
            fp, side = table["fp"].to_numpy().view(np.uint64), table["side"].to_numpy()
            lo, hi = table["lo"].to_numpy(), table["hi"].to_numpy()
            bounds = [*group_starts(table, ["key", "lo", "hi"]), len(fp)]
            packed: list[np.ndarray] = []  # prints of small cells: comparing across cells finds true links or none
            held = 0
            for s, e in zip(bounds, bounds[1:]):
                if lo[s] == hi[s]:
                    packed.append(fp[s:e])
                    held += e - s
                    if held >= pack:
                        prints = np.unique(np.concatenate(packed))
                        yield emit(prints, *bit_sliced_links(prints, prints, radius, True))
                        packed, held = [], 0
                else:
                    a, b = fp[s:e][side[s:e] == 0], fp[s:e][side[s:e] == 1]
                    i, j = bit_sliced_links(a, b, radius, False)
                    yield emit(np.concatenate([a, b]), i, j + len(a))
            if packed:
                prints = np.unique(np.concatenate(packed))
                yield emit(prints, *bit_sliced_links(prints, prints, radius, True))
    return run


def links(prints: DataFrame, radius: int = 3, bands: int = 5, block: int = 1024) -> DataFrame:
    """Pairs (u, v) whose connected components are those of all pairs of ``fp`` within ``radius`` bits."""
    keys = F.array(*[F.struct(F.lit(n).alias("n"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("bits"))
                     for n, m in band_keys(bands, radius)])
    # The band numbers are hashed in; unequal keys that collide only share a block.
    keyed = prints.select("fp", F.explode(keys).alias("k")).select("fp", F.xxhash64("k.n", "k.bits").alias("key"))
    shared = stage(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "simhash_keys")
    met = keyed.join(shared, "key").withColumn("grid", F.ceil(F.col("n") / block).cast("int"))
    met = met.withColumn("mine", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("grid")).cast("int"))
    cells = met.select("key", "fp", "mine", F.explode(F.sequence(F.lit(0), F.col("grid") - 1)).alias("other"))
    cells = cells.select("key", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "fp",
                         (F.col("mine") > F.col("other")).cast("int").alias("side"))
    dealt = cells.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return dealt.mapInArrow(lean(_compare(radius, block)), "u long, v long")


def _digest(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 3,
                    bands: int = 5, block: int = 1024) -> DataFrame:
    """doc_id, digest of the text, fp (signed long), class_fp (least of the class) and component_id of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _digest(text_col).alias("digest"), F.col(text_col))
    rows = stage(rows.mapInArrow(lean(_fingerprints(words)), "doc_id long, digest long, fp long"), "simhash_rows")
    prints = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least_doc")), "simhash_prints")
    found = stage(links(prints, radius, bands, block).distinct(), "simhash_links")
    roots = stage(components(found), "simhash_roots")
    classed = prints.join(roots, prints["fp"] == roots["node"], "left")
    classed = classed.select("fp", F.coalesce("root", "fp").alias("class_fp"), "least_doc")
    least = classed.groupBy("class_fp").agg(F.min("least_doc").alias("component_id"))
    classes = stage(classed.select("fp", "class_fp").join(least, "class_fp"), "simhash_classes")
    return rows.join(classes, "fp").select("doc_id", "digest", "fp", "class_fp", "component_id")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with one document of each class: that with the smallest doc_id (NULL is the largest).

    Rows that repeat that doc_id within the class are reduced to one of them.
    """
    classes = stage(near_duplicates(docs, **options), "simhash_classed")
    least = classes.groupBy("class_fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("k"))
    least = least.select(F.col("k.doc_id").alias("_id"), F.col("k.digest").alias("_digest")).distinct()
    copies = classes.groupBy(F.col("doc_id").alias("c_id"), F.col("digest").alias("c_digest")).agg(F.count("*").alias("_copies"))
    same = F.col("_id").eqNullSafe(F.col("c_id")) & (F.col("_digest") == F.col("c_digest"))
    kept = stage(least.join(copies, same).select("_id", "_digest", "_copies"), "simhash_kept")
    rows = packed(docs, doc=F.col("doc_id"), text_digest=_digest("text"))
    found = rows.join(kept, F.col("doc").eqNullSafe(F.col("_id")) & (F.col("text_digest") == F.col("_digest")))
    once = found.where("_copies = 1").select("row")
    again = found.where("_copies > 1").groupBy("_id", "_digest").agg(F.min("row").alias("row"))
    return unpacked(once.unionByName(again.select("row")), docs.columns)
