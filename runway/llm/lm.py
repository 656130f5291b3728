"""Operator 5: language-model scoring with an interpolated modified Kneser-Ney model.

Counting: tasks hash words, count the n-grams of a slice of their documents, and send them on in blocks by the
last word but one.  An n-gram's context and the n-gram one word shorter, whose count is the number of words seen
before it, share that word with it.  So the task that gets a block has all that its orders down to 2 need: it adds
up the n-grams of each and writes them and the sums of their contexts.  Words that would fill a block alone (found
in a sample of the rows; which they are does not change the results) are spread over all blocks by the word behind
them; the sums of their contexts and the counts of single words are sent on once more.  Only the sample's most
frequent words and totals of the blocks come to the driver.

Model: for each order compact arrays of hashes with counts and of contexts with their sums, in the shared folder,
one file for each block.  A context behind which one word stands once is not listed: it is an n-gram itself, of the
order below, so one that is an n-gram and not in the list is such a context.  Scoring tasks map the files into memory
and look up sorted keys.

Tokens are words (A-Z lower-cased), then one end; start marks stand before a text as context only.  Words enter
n-grams as 48 bits of their hash; the counts of single words use all 64.  A word never seen gets its share of the
mass that the lowest order keeps for words outside its vocabulary.

Defined cases: an empty, NULL or blank text is the end token alone; repeated rows count, and are scored, each; a
NULL doc_id is scored like any other; without training documents every probability is 1; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared_files import mapped, put, shared_uri
from .words import mix64, word_hashes

#: Start mark and end token, as words of 48 bits; and the end among words of 64 bits.
START, END = np.uint64(1), np.uint64(2)
#: Tokens that a task counts before it sends them on, and tokens scored at once.
SLICE = 1 << 21
SCORED = 1 << 20
#: Share of the rows in which frequent words are looked for.
SOUGHT = 0.02

_ROWS = "kind string, level int, block int, data binary"
_FOLD = np.uint64(0x9FB21C651E98DF25)


def gram_hash(columns: list[np.ndarray]) -> np.ndarray:
    """64-bit hash of n-grams given as columns of words."""
    h = mix64(columns[0] + np.uint64(len(columns)))
    for c in columns[1:]:
        h = mix64(h * _FOLD + c)
    return h


def _among(words: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Whether each word is in the sorted list."""
    if not len(listed):
        return np.zeros(len(words), dtype=bool)
    return listed[np.minimum(np.searchsorted(listed, words), len(listed) - 1)] == words


def _routed(route: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    """Hashes whose first bits, the block's number, are replaced by those of the route."""
    rest = np.uint64(64 - bits)
    return (route >> rest << rest) | (h >> np.uint64(bits))


def gram_keys(columns: list[np.ndarray], frequent: np.ndarray, bits: int) -> np.ndarray:
    """Keys of n-grams of two words or more: the block is that of the last word but one, of a frequent one that of it and the last."""
    route, many = mix64(columns[-2]), np.flatnonzero(_among(columns[-2], frequent))
    route[many] = gram_hash([c[many] for c in columns[-2:]])
    return _routed(route, gram_hash(columns), bits)


def token_rows(column: pa.Array, order: int, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, 64-bit tokens, 48-bit tokens, offsets) of runs of rows of about ``most`` tokens.

    Each row is order - 1 start marks, its words and the end.
    """
    def joined(held):
        h, n = np.concatenate([x[2] for x in held]), np.concatenate([x[3] for x in held])
        offsets = np.concatenate([[0], np.cumsum(n + order)])
        at = np.arange(len(h)) + np.repeat(np.arange(len(n)) * order + order - 1, n)
        full, short = np.full(offsets[-1], START), np.full(offsets[-1], START)
        full[at], short[at] = h, (h >> np.uint64(16)) | np.uint64(1 << 47)  # no word is a mark
        full[offsets[1:] - 1] = short[offsets[1:] - 1] = END
        return held[0][0], held[-1][1], full, short, offsets
    held, n = [], 0
    for part in word_hashes(column):
        held.append(part)
        n += len(part[2])
        if n >= most:
            yield joined(held)
            held, n = [], 0
    if held:
        yield joined(held)


def summed(keys: np.ndarray, columns: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Sorted distinct keys, their columns and the sums of their counts."""
    order = np.argsort(keys)
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else order
    first = order[heads]
    sums = [np.add.reduceat(c[order], heads) if len(heads) else c for c in counts]
    return keys[heads], [c[first] for c in columns], sums


def _planes(column: np.ndarray) -> bytes:
    return column.astype(np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes()


def _pack(words: list[np.ndarray], counts: list[np.ndarray]) -> bytes:
    """48-bit words and counts as compressed columns; words that recur as places in the sorted list of them.

    Of the first column the differences are kept, which are small where the rows come in its order.
    """
    n = len(words[0])
    listed, places = np.unique(np.concatenate(words), return_inverse=True)
    if 2 * len(listed) > n * len(words):
        listed, columns = listed[:0], words
    else:
        columns = [places[j * n:(j + 1) * n].astype(np.uint64) for j in range(len(words))]
    columns = [np.diff(columns[0], prepend=np.uint64(0)), *columns[1:]]
    parts = [np.array([n, len(words), len(counts), len(listed)], dtype=np.int64).tobytes(), _planes(np.diff(listed, prepend=np.uint64(0)))]
    raw = b"".join([*parts, *map(_planes, columns), *map(_planes, counts)])
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> tuple[list[np.ndarray], list[np.ndarray]]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    n, n_words, n_counts, n_listed = np.frombuffer(raw, np.int64, 4)
    at, columns = 32, []
    for size in [n_listed] + [n] * (n_words + n_counts):
        columns.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * size, at).reshape(8, size).T).view(np.uint64)[:, 0])
        at += 8 * size
    listed, words, counts = np.cumsum(columns[0]), [np.cumsum(columns[1]), *columns[2:1 + n_words]], columns[1 + n_words:]
    return [listed[w] for w in words] if n_listed else words, counts


def _split64(h: np.ndarray) -> list[np.ndarray]:
    """A 64-bit hash as two words of 48 bits or less."""
    return [h >> np.uint64(32), h & np.uint64(0xFFFFFFFF)]


def _blocks(kind: str, level: int, bits: int, keys: np.ndarray, words: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
    """Rows of sorted keys, cut by their first bits; n-grams in the order of their first two words, in which they pack best."""
    cuts = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    rows = []
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(keys)])):
        if b > a:
            order = a + np.lexsort([w[a:b] for w in words[1::-1]]) if kind == "gram" else slice(a, b)
            rows.append((i, _pack([w[order] for w in words], [c[order] for c in counts])))
    return _rows(kind, level, [i for i, _ in rows], [d for _, d in rows])


def _rows(kind: str, level: int, blocks: list[int], data: list[bytes]) -> pa.RecordBatch:
    n = len(blocks)
    return pa.RecordBatch.from_arrays([pa.array([kind] * n, pa.string()), pa.array([level] * n, pa.int32()), pa.array(blocks, pa.int32()),
                                       pa.array(data, pa.binary())], ["kind", "level", "block", "data"])


def _frequent(texts: DataFrame, order: int, bits: int) -> np.ndarray:
    """Sorted words, start marks included, behind which stand as many tokens of a sample as a block has on average."""
    def run(batches):
        for batch in batches:
            for _, _, full, short, _ in token_rows(batch.column(0), order, SLICE):
                words, n = np.unique(short[np.flatnonzero(full != START) - 1], return_counts=True)
                total = n.sum()
                words, n = words[n << bits + 1 >= total], n[n << bits + 1 >= total]
                yield pa.RecordBatch.from_arrays([pa.array(np.append(words, np.uint64(0)).astype(np.int64)), pa.array(np.append(n, total))], ["word", "n"])
    # At most 2 << bits words of a slice; 0, no word's hash, has the number of all tokens.
    rows = texts.sample(SOUGHT, seed=5).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    n = {row["word"]: row["n"] for row in rows}
    total = n.pop(0, 0)
    return np.array(sorted(w for w in n if n[w] << bits >= total), dtype=np.uint64)


def _slices(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The 64-bit and 48-bit tokens of runs of rows, of ``SLICE`` tokens or more but for the last."""
    held, n = [], 0
    for batch in batches:
        for _, _, full, short, _ in token_rows(batch.column(0), order, SLICE):
            held.append((full, short))
            n += len(full)
            if n >= SLICE:
                yield tuple(map(np.concatenate, zip(*held)))
                held, n = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _count(order: int, bits: int, frequent: np.ndarray):
    def run(batches):
        for full, short in _slices(batches, order):
            at = np.flatnonzero(full != START)
            keys, _, (n,) = summed(mix64(full[at]), [], [np.ones(len(at), dtype=np.uint64)])
            del full
            yield _blocks("word", 0, bits, keys, _split64(keys), [n])
            columns = [short[at - order + 1 + j] for j in range(order)]
            keys, columns, (n,) = summed(gram_keys(columns, frequent, bits), columns, [np.ones(len(at), dtype=np.uint64)])
            yield _blocks("gram", order, bits, keys, [columns[-2], *columns[:-2], columns[-1]], [n])
    return run


def _counts_of_counts(n: np.ndarray) -> list[int]:
    return [int((n == k).sum()) for k in (1, 2, 3, 4)] + [len(n), int(n.sum())]


def _total(level: int, block: int, n: np.ndarray) -> pa.RecordBatch:
    return _rows("total", level, [block], [np.array(_counts_of_counts(n), np.int64).tobytes()])


def _repeated(keys: np.ndarray, sums: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The contexts behind which more stands than one word once."""
    more = sums[0] > 1
    return keys[more], [s[more] for s in sums]


def _orders(folder: str, bits: int, frequent: np.ndarray, block: int, words: list[np.ndarray], n: np.ndarray):
    """Write the n-grams of a block and, order by order down to 2, the shorter ones in them, and the sums of their contexts."""
    for level in range(len(words), 1, -1):
        keys, words, (n,) = summed(gram_keys(words, frequent, bits), words, [n])
        _write(f"{folder}/gram-{level}-{block}", bits, keys, [n])
        yield _total(level, block, n)
        kinds = [n, *((n == k).astype(np.uint64) for k in (1, 2)), (n > 2).astype(np.uint64)]
        contexts, many = gram_hash(words[:-1]), _among(words[-2], frequent)
        near = ~many
        keys, _, sums = summed(_routed(mix64(words[-2][near]), contexts[near], bits), [], [k[near] for k in kinds])
        _write(f"{folder}/near-{level}-{block}", bits, *_repeated(keys, sums))
        keys, _, sums = summed(contexts[many], [], [k[many] for k in kinds])
        yield _blocks("far", level, bits, keys, _split64(keys), sums)
        # One for each word seen before; behind a start mark nothing else stands, so texts count.
        n = np.where(words[1] == START, n, 1).astype(np.uint64)
        words = words[1:]
    keys, words, (n,) = summed(gram_hash(words), words, [n])
    yield _blocks("gram", 1, bits, keys, words, [n])


def _add_up(folder: str, bits: int, frequent: np.ndarray):
    """Blocks of the same kind, level and number to sorted arrays in files, and what is sent on."""
    def run(batches):
        held = defaultdict(list)
        for batch in batches:
            for row in batch.to_pylist():
                held[row["kind"], row["level"], row["block"]].append(row["data"])
        for (kind, level, block), parts in held.items():
            if kind == "total":
                for data in parts:
                    yield _rows(kind, level, [block], [data])
                continue
            words, counts = zip(*map(_unpack, parts))
            parts.clear()
            words, counts = [np.concatenate(x) for x in zip(*words)], [np.concatenate(x) for x in zip(*counts)]
            if kind == "gram" and level > 1:
                yield from _orders(folder, bits, frequent, block, [*words[1:-1], words[0], words[-1]], counts[0])
                continue
            keys = gram_hash(words) if kind == "gram" else words[0] << np.uint64(32) | words[1]
            keys, _, counts = summed(keys, [], counts)
            if kind == "far":
                _write(f"{folder}/far-{level}-{block}", bits, *_repeated(keys, counts))
                continue
            _write(f"{folder}/{kind}-{level}-{block}", bits, keys, counts)
            yield _total(level, block, counts[0])
    return run


#: Bits of a key that are kept behind those of its block and its bucket; keys of a bucket, at least, on average.
_KEPT, _IN_BUCKET = 40, 8


def _bucketed(keys: np.ndarray, bits: int, more: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each key, which is the ``more`` bits behind the block's, and the bits kept."""
    keys = keys << np.uint64(bits)
    return keys >> np.uint64(64 - more), keys << np.uint64(more) >> np.uint64(64 - _KEPT)


def _write(uri: str, bits: int, keys: np.ndarray, counts: list[np.ndarray]) -> None:
    """Sorted keys of a block: where the buckets begin, 5 bytes of each key, and one byte for its counts.

    The byte is a place in the list of the most frequent counts, or 255 for a key in the list of exceptions.
    """
    if not len(keys):
        return
    more = max(1, (len(keys) // _IN_BUCKET).bit_length() - 1)
    bucket, kept = _bucketed(keys, bits, more)
    starts = np.searchsorted(bucket, np.arange((1 << more) + 1, dtype=np.uint64))
    # Counts below 2**16 as one number, which is 0 for none of them.
    fits = np.all([c < (1 << 16) for c in counts], axis=0)
    joined = np.zeros(len(keys), dtype=np.uint64)
    for j, c in enumerate(counts):
        joined |= c.astype(np.uint64) << np.uint64(16 * j)
    joined[~fits] = 0
    values, place, n = np.unique(joined, return_inverse=True, return_counts=True)
    n[values == 0] = 0
    most = np.argsort(-n, kind="stable")[:255]
    most = most[n[most] > 0]
    codes = np.full(len(values), 255, dtype=np.uint8)
    codes[most] = np.arange(len(most))
    codes = codes[place]
    others = np.flatnonzero(codes == 255)
    kind = np.min_scalar_type(max((int(c[others].max(initial=0)) for c in counts), default=0))
    listed = [(values[most] >> np.uint64(16 * j) & np.uint64(0xFFFF)) for j in range(len(counts))]
    put(uri, [np.array([len(keys), len(counts), more, len(most), len(others), np.dtype(kind).itemsize], dtype=np.int64), *listed, starts.astype(np.uint32),
              (kept >> np.uint64(8)).astype(np.uint32), others.astype(np.uint32), kept.astype(np.uint8), codes, *(c[others].astype(kind) for c in counts)])


class HashArrays:
    """Sorted keys and their counts in mapped files, one for each value of the keys' first bits."""

    def __init__(self, prefix: str, bits: int, values: int):
        self.prefix, self.bits, self.values, self.open = prefix, bits, values, {}

    def _block(self, i: int):
        if i not in self.open:
            raw = mapped(f"{self.prefix}-{i}")
            self.open[i] = raw and self._arrays(raw)
        return self.open[i]

    def _arrays(self, raw: memoryview):
        n, k, more, listed, others, size = (int(x) for x in np.frombuffer(raw, np.int64, 6))
        at, out = 48, []
        for kind, length in [("u8", listed)] * k + [("u4", (1 << more) + 1), ("u4", n), ("u4", others), ("u1", n), ("u1", n)] + [(f"u{size}", others)] * k:
            out.append(np.frombuffer(raw, kind, length, at))
            at += length * np.dtype(kind).itemsize
        return more, out[:k], *out[k:k + 5], out[k + 5:]

    def find(self, keys: np.ndarray) -> list[np.ndarray]:
        """The values of each key as floats, 0 where there is none."""
        order = np.argsort(keys)
        sought = keys[order]
        cuts = np.searchsorted(sought, np.arange(1, 1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits))
        out = [np.zeros(len(keys)) for _ in range(self.values)]
        for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(keys)])):
            if b > a and (block := self._block(i)) is not None:
                more, listed, starts, high, others, low, codes, rest = block
                at, hit = self._places(more, starts, high, low, sought[a:b])
                code = codes[at]
                few = np.flatnonzero(code < 255)
                to, many = order[a + hit], np.flatnonzero(code == 255)
                place = np.searchsorted(others, at[many])
                for values, wide, found in zip(listed, rest, out):
                    found[to[few]] = values[code[few]]
                    found[to[many]] = wide[place]
        return out

    def _places(self, more: int, starts: np.ndarray, high: np.ndarray, low: np.ndarray, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in a block the sought keys that it has are, and which these are: halving in all buckets at once."""
        bucket, kept = _bucketed(sought, self.bits, more)
        a, b = starts[bucket].astype(np.int64), starts[bucket + np.uint64(1)].astype(np.int64)
        end, last = b, len(high) - 1
        def at(i):
            return high[i].astype(np.uint64) << np.uint64(8) | low[i]
        for _ in range(int((b - a).max()).bit_length()):
            middle = a + b >> 1
            below = (at(np.minimum(middle, last)) < kept) & (a < b)
            a, b = np.where(below, middle + 1, a), np.where(below, b, middle)
        hit = np.flatnonzero((a < end) & (at(np.minimum(a, last)) == kept))
        return a[hit], hit


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """What is taken from counts 0, 1, 2 and above; halves where too few n-grams are seen to tell."""
    if not (n1 and n2 and n3 and n4):
        return np.array([0, 0.5, 0.75, 1.0])
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0, *(min(max(x, 0.05), k + 0.95) for k, x in enumerate(d))])


@dataclass
class Model:
    """Where the arrays are, and the totals: by order the numbers of n-grams counted 1 to 4 times, of all, and the sum."""
    folder: str
    bits: int
    order: int
    frequent: np.ndarray
    totals: dict[int, list[int]]

    @property
    def tokens(self) -> int:
        return self.totals[0][5]

    @property
    def words(self) -> int:
        return self.totals[0][4]


def fit(docs: DataFrame, learn: Column | None = None, text_col: str = "text", order: int = 2, bits: int | None = None) -> Model:
    """Count the documents where ``learn`` holds, and write the arrays to the shared folder.

    2**bits blocks (at least as many as shuffle partitions, unless given) share the n-grams of an order.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = docs.sparkSession
    folder = shared_uri(spark, "lm")
    bits = bits or max(4, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    texts = docs.where(F.lit(True) if learn is None else learn).select(text_col)
    frequent = _frequent(texts, order, bits)
    rows = texts.mapInArrow(_count(order, bits, frequent), _ROWS)
    for _ in range(2):
        rows = rows.repartition("kind", "level", "block").mapInArrow(_add_up(folder, bits, frequent), _ROWS)
    totals = {level: [0] * 6 for level in range(order + 1)}
    for row in rows.collect():  # six numbers for each block
        totals[row["level"]] = [a + int(b) for a, b in zip(totals[row["level"]], np.frombuffer(row["data"], np.int64))]
    return Model(folder, bits, order, frequent, totals)


class Scorer:
    """Probabilities of tokens in a task."""

    def __init__(self, model: Model):
        self.m = model
        self.word = HashArrays(f"{model.folder}/word-0", model.bits, 1)
        self.gram = {n: HashArrays(f"{model.folder}/gram-{n}", model.bits, 1) for n in range(1, model.order + 1)}
        self.near, self.far = ({n: HashArrays(f"{model.folder}/{kind}-{n}", model.bits, 4) for n in range(2, model.order + 1)} for kind in ("near", "far"))
        self.discount = {n: discounts(*model.totals[n][:4]) for n in self.gram}

    def counts(self, full: np.ndarray) -> np.ndarray:
        """How often each token stands in the training texts."""
        words, back = np.unique(full, return_inverse=True)
        return self.word.find(mix64(words))[0][back]

    def _kept(self, n: int, count: np.ndarray) -> np.ndarray:
        return count - self.discount[n][np.minimum(count, 3).astype(np.int64)]

    def _contexts(self, words: list[np.ndarray]) -> list[np.ndarray]:
        """The sum of the counts behind each context seen, and the numbers of counts 1, 2 and above."""
        keys, many = gram_hash(words), _among(words[-1], self.m.frequent)
        out = [np.zeros(len(keys)) for _ in range(4)]
        near, far = np.flatnonzero(~many), np.flatnonzero(many)
        for arrays, at, sought in ((self.near, near, _routed(mix64(words[-1][near]), keys[near], self.m.bits)), (self.far, far, keys[far])):
            for values, found in zip(arrays[len(words) + 1].find(sought), out):
                found[at] = values
        once = out[0] == 0
        out[0][once] = out[1][once] = 1
        return out

    def probabilities(self, short: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of the tokens at the given places, each behind order - 1 others."""
        m = self.m
        words, back = np.unique(short[at], return_inverse=True)
        d, (n1, n2, _, _, kinds, total) = self.discount[1], m.totals[1]
        free = d[1] * n1 + d[2] * n2 + d[3] * (kinds - n1 - n2)
        count = self.gram[1].find(gram_hash([words]))[0]
        p = (self._kept(1, count) + free / (kinds + 1)) / total if total else np.ones(len(words))
        p, count = p[back], count[back]
        for n in range(2, m.order + 1):
            # A context is seen if it ends a training text's n-gram one word shorter, or is of start marks alone.
            ends = np.full(len(short), m.tokens > 0)
            ends[at] = count > 0
            seen = np.flatnonzero(ends[at - 1])
            columns = [short[at[seen] - n + 1 + j] for j in range(n)]
            total, n1, n2, n3 = self._contexts(columns[:-1])
            d = self.discount[n]
            free = d[1] * n1 + d[2] * n2 + d[3] * n3
            count = np.zeros(len(at))
            count[seen] = self.gram[n].find(gram_keys(columns, m.frequent, m.bits))[0]
            p[seen] = (self._kept(n, count[seen]) + free * p[seen]) / total
        return p


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score (log10 probabilities of the text) and perplexity of every row."""
    def run(batches):
        scorer = Scorer(model)
        bottom = model.tokens + 0.5 * (model.words + 1)
        for batch in batches:
            for a, b, full, short, offsets in token_rows(batch.column(1), model.order, SCORED):
                at = np.flatnonzero(full != START)
                heads = offsets[:-1] - np.arange(b - a) * (model.order - 1)
                count = scorer.counts(full[at])
                base = np.add.reduceat(np.log10((count + 0.5) / bottom), heads)
                logs = np.add.reduceat(np.log10(scorer.probabilities(short, at)), heads)
                n = np.diff(heads, append=len(at))
                known = np.add.reduceat((count > 0).astype(np.int64), heads)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n.astype(np.int64)), pa.array(known), pa.array(base), pa.array(logs),
                     pa.array(10 ** (-logs / n))], ["doc_id", "n_tokens", "n_known", "base_score", "score", "perplexity"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double, perplexity double")
