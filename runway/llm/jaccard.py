"""Operator 13: n-gram Jaccard join by token-combination prefixes.

A document's set holds the 64-bit hashes of its distinct shingles; equal sets are one class from the start.  Sets of n
shingles that reach the similarity have sizes within its ratio, so each set is compared at the level floor(log2 n) and,
if a partner may lie beyond it, at the next.  A level orders its tokens: first those of a fixed share of the hash range by
frequency (number of sets, counted to ``HOT``) and hash, then the others by hash.  If a set needs ``o`` tokens
in common with a partner, of its first l tokens at least l - (n - o) are shared by both sets' prefixes.

Tokens are of class 1 (rare), 2 or 3 (frequent); classes 2 and 3 are dealt by hash to subclasses, as many as keep
few tokens of a prefix in each.  A prefix is extended until l - (n - o) is more than the sum over its subclasses of
min(tokens in it, class - 1); then partners share ``class`` tokens of some subclass.  Single tokens of class 1, pairs of
class 2 and triples of class 3, within a subclass, are the keys under which sets meet.  A set with more than n - o tokens
of its own has no partner, and no key.

Sets that meet are verified by intersecting whole sets.  First each with the least of its key, so groups of near
copies become components in one round; then, for keys that still hold several components (first each set's most frequent
key, then the others), in blocks: parity bitmaps bound the symmetric difference of two sets from below, and spanning forests of
the pairs that pass, over components, are verified, eight times as many forests each round, until every such pair is verified or within a component.  So no link is
lost and no group emits all of its pairs unless most of them pass the bound and fail the check.

Frequencies are counted in blocks of the hash range; a token that many sets of one map task hold is marked there and not
sent once per set, so a very frequent token costs one entry per task.

Defined cases: a text of fewer words than a shingle is one shingle; texts that are NULL or without words have the
empty set, linked with nothing; repeated rows each give a row; a row with NULL doc_id gets a component and is never
the smallest; an empty table gives an empty result; other columns are not read.  Distinct shingles or sets may
share a hash with a probability of 2**-64 a pair.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import group_starts, grouped_stream, stage
from .words import mix64, word_hashes

#: Number of sets from which a token is of class 2, and of class 3 (counted no further).
RARE, HOT = 8, 64
#: Tokens that a map task gathers before it sends them on.
GATHER = 1 << 19
_U = np.uint64
_PRIMES = [_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)]


def _salt(level: int, prime: int) -> np.uint64:
    return _U((level + 1) * int(_PRIMES[prime]) & (1 << 64) - 1)


def token_sets(column: pa.Array, words: int):
    """(row, sorted distinct shingle hashes) of every row that has words."""
    for row, _, hashes, counts in word_hashes(column):
        ends = np.cumsum(counts)
        for i in np.flatnonzero(counts):
            h = hashes[ends[i] - counts[i]:ends[i]]
            k = min(words, len(h))
            grams = np.full(len(h) - k + 1, _U(k), dtype=np.uint64)
            for j in range(k):
                grams = grams * _PRIMES[0] + h[j:len(h) - k + 1 + j]  # words' hashes are mixed already
            yield row + int(i), np.unique(mix64(grams))


def set_id(tokens: np.ndarray) -> int:
    mixed = mix64(tokens ^ _PRIMES[1])
    return int(mix64(mixed.sum(dtype=np.uint64).reshape(1) + _U(len(tokens))).view(np.int64)[0])


class Rule:
    """What a similarity of ``percent`` / 100 asks of sets of n tokens."""

    def __init__(self, percent: int):
        if not 50 < percent <= 100:
            raise ValueError("percent must be over 50, so that partners are of at most twice the size")
        self.percent = percent

    def overlap(self, n: int) -> int:
        return -(-self.percent * n // 100)

    def levels(self, n: int) -> list[int]:
        largest = 100 * n // self.percent
        if largest == n and self.overlap(n) == n:
            return []  # only equal sets reach the similarity
        return list(range(n.bit_length() - 1, largest.bit_length()))

    @staticmethod
    def subclasses(level: int) -> tuple[int, int, int]:
        """Of classes 1, 2 and 3."""
        return 1, max(1, (1 << level) // 32), max(1, (1 << level) // 24)

    def longest_prefix(self, n: int, level: int) -> int:
        _, twos, threes = self.subclasses(level)
        return min(n, n - self.overlap(n) + 1 + twos + 2 * threes)

    def links(self, shared: int, a: int, b: int) -> bool:
        return 100 * shared >= self.percent * (a + b - shared)


def by_frequency(hashes: np.ndarray, level: int) -> np.ndarray:
    """Whether a token's hash lies in the part of the range that is ordered by frequency."""
    return hashes >> _U(62) < (1 if level >= 8 else 2 if level >= 6 else 4)


def at_level(tokens: np.ndarray, level: int) -> tuple[np.ndarray, int]:
    """The tokens' hashes at a level, those ordered by frequency first, the others by hash; and how many the former are."""
    hashes = mix64(tokens + _salt(level, 2))
    first = by_frequency(hashes, level)
    return np.concatenate([hashes[first], np.sort(hashes[~first])]), int(first.sum())


def view_id(sid: int, level: int) -> np.ndarray:
    return mix64(np.array([sid], dtype=np.int64).view(np.uint64) + _salt(level, 0))


def _rows(words: int, rule: Rule):
    """Set, size, views (a set at a level) and number of tokens ordered by frequency in each."""
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            out = {c: [None] * n for c in ("sid", "v1", "r1", "v2", "r2")}
            size = np.zeros(n, dtype=np.int64)
            for i, tokens in token_sets(batch.column(2), words):
                out["sid"][i], size[i] = set_id(tokens), len(tokens)
                for v, r, level in zip(("v1", "v2"), ("r1", "r2"), rule.levels(len(tokens))):
                    out[v][i] = int(view_id(out["sid"][i], level).view(np.int64)[0])
                    out[r][i] = int(by_frequency(mix64(tokens + _salt(level, 2)), level).sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size), *(pa.array(x, pa.int64()) for x in out.values())],
                                             ["doc_id", "digest", "n", *out])
    return run


def _entries(words: int, rule: Rule, parts: int):
    """(part, blob) of pairs (token, view) sorted by token; frequent tokens go past the count, in parts below zero."""
    def flush(held):
        token, view = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(token, kind="stable")
        token, view = token[order], view[order]
        heads = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        runs = np.diff(np.append(heads, len(token)))
        hot = np.repeat(runs >= HOT, runs)
        marks = token[heads[runs >= HOT]]
        rows = []
        if hot.any():
            rows.append((-1 - int(view[hot][0] % _U(parts)), np.stack([token[hot], view[hot]])))
        token, view = np.concatenate([token[~hot], marks]), np.concatenate([view[~hot], np.zeros(len(marks), np.uint64)])
        part = (mix64(token) % _U(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        heads = np.flatnonzero(np.diff(part[order], prepend=-1))
        for chosen in np.split(order, heads[1:]) if len(order) else []:
            rows.append((int(part[chosen[0]]), np.stack([token[chosen], view[chosen]])))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1].tobytes() for r in rows], pa.binary())],
                                          ["part", "blob"])

    def run(batches):
        held, size, seen = [], 0, set()
        for batch in batches:
            for _, tokens in token_sets(batch.column(0), words):
                sid = set_id(tokens)
                levels = rule.levels(len(tokens))
                if sid in seen or not levels:
                    continue
                seen.add(sid)
                for level in levels:
                    hashes, first = at_level(tokens, level)
                    hashes = hashes[:max(first, rule.longest_prefix(len(tokens), level))]
                    held.append((hashes, np.repeat(view_id(sid, level), len(hashes))))
                    size += len(hashes)
                if size >= GATHER:
                    yield flush(held)
                    held, size, seen = [], 0, set()
        if held:
            yield flush(held)
    return run


def _counts(batches):
    """(view, token, frequency) of the tokens that several views hold; parts come one after the other."""
    def emit(token, view, frequency):
        return pa.RecordBatch.from_arrays([pa.array(view.view(np.int64)), pa.array(token.view(np.int64)), pa.array(frequency.astype(np.int32))],
                                          ["view", "token", "df"])

    def count(blobs):
        token, view = (np.concatenate(x) for x in zip(*blobs))
        order = np.lexsort((view, token))
        token, view = token[order], view[order]
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (view[1:] != view[:-1])])
        token, view = token[new], view[new]
        heads = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        runs = np.diff(np.append(heads, len(token)))
        frequency = np.repeat(np.where(view[heads] == 0, HOT, np.minimum(runs, HOT)), runs)  # a mark is the least view
        some = (frequency > 1) & (view != 0)
        return emit(token[some], view[some], frequency[some])

    part, blobs = None, []
    for batch in batches:
        for p, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
            pairs = np.frombuffer(blob.as_buffer(), dtype=np.uint64).reshape(2, -1)
            if p < 0:
                yield emit(pairs[0], pairs[1], np.full(pairs.shape[1], HOT))
                continue
            if p != part and blobs:
                yield count(blobs)
                blobs = []
            part = p
            blobs.append(pairs)
    if blobs:
        yield count(blobs)


def prefix_keys(n: int, level: int, ordered: int, token: np.ndarray, frequency: np.ndarray, rule: Rule) -> np.ndarray:
    """Keys of a view, from its tokens that others hold too; ``ordered`` of all its tokens are ordered by frequency."""
    first = by_frequency(token, level)
    slack, n_first = n - rule.overlap(n), int(first.sum())
    length, needed = ordered - n_first, 0  # the tokens that no other set holds come first
    if length > slack:
        return np.zeros(0, dtype=np.uint64)
    kind = np.where(frequency < RARE, 1, np.where(frequency < HOT, 2, 3))
    sub = (token >> _U(7)) % np.array([1, *rule.subclasses(level)], dtype=np.uint64)[kind]
    members: dict[tuple[int, int], list[int]] = {}
    for place, i in enumerate(np.lexsort((token, np.where(first, frequency, 0), ~first)).tolist()):
        # Of the tokens ordered by hash only, those that others hold too are known: all or none are taken.
        if place <= n_first and length - slack > needed:
            break
        of = members.setdefault((int(kind[i]), int(sub[i])), [])
        of.append(int(token[i]))
        length += 1
        needed += int(len(of) < kind[i])
    keys = []
    for (k, _), of in members.items():
        if len(of) >= k:
            chosen = np.array(list(combinations(sorted(of), k)), dtype=np.uint64)
            keys.append(mix64(sum((chosen[:, j] * _PRIMES[j] for j in range(k)), np.full(len(chosen), _U(k)))))
    # The last bits name the level, so sets of one key have bitmaps of one width.
    return np.unique(np.concatenate(keys) & ~_U(63) | _U(level)) if keys else np.zeros(0, dtype=np.uint64)


def _keys(rule: Rule):
    def run(batches):
        for batch in batches:
            lists = batch.column(4)
            pairs, offsets = lists.flatten(), lists.offsets.to_numpy()
            token = pairs.field("token").to_numpy().view(np.uint64)
            frequency = pairs.field("df").to_numpy()
            offsets = offsets - offsets[0]
            columns = [batch.column(c).to_pylist() for c in range(4)]
            rows, keys = [], []
            for i, (_, n, level, ordered) in enumerate(zip(*columns)):
                found = prefix_keys(n, level, ordered, token[offsets[i]:offsets[i + 1]], frequency[offsets[i]:offsets[i + 1]], rule)
                rows.append(np.full(len(found), i))
                keys.append(found)
            take = pa.array(np.concatenate(rows)) if rows else pa.array([], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)) if keys else pa.array([], pa.int64()),
                                              *(batch.column(c).take(take) for c in range(3))], ["key", "sid", "n", "level"])
    return run


def _tokens(words: int):
    def run(batches):
        for batch in batches:
            found = {i: tokens.tobytes() for i, tokens in token_sets(batch.column(1), words)}
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([found.get(i, b"") for i in range(batch.num_rows)], pa.binary())],
                                             ["sid", "tokens"])
    return run


def _linked(rule: Rule):
    def run(batches):
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = (np.frombuffer(t.as_buffer(), dtype=np.uint64) for t in (x, y))
                at = np.searchsorted(y, x)
                shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                if rule.links(shared, len(x), len(y)):
                    keep.append(i)
            take = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take)], ["u", "v"])
    return run


def parity(tokens: np.ndarray, level: int) -> np.ndarray:
    """A bit for each of 2**level (at least 64) hash buckets: whether it holds an odd number of tokens."""
    bits = 1 << max(level, 6)
    odd = np.bincount((mix64(tokens ^ _PRIMES[2]) % _U(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool))


def _bitmaps(batches):
    for batch in batches:
        found = [parity(np.frombuffer(t.as_buffer(), dtype=np.uint64), level) for t, level in zip(batch.column(2), batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f.tobytes() for f in found], pa.binary())],
                                         ["sid", "level", "bits"])


def passing_pairs(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray, rule: Rule):
    """(i, j, differing bits) of the bitmap rows that may belong to sets of the wanted similarity."""
    a, b = a.view(np.uint64), b.view(np.uint64)
    out = ([np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)])
    for i in range(len(a)):
        d = np.bitwise_count(b ^ a[i]).sum(axis=1, dtype=np.int64)
        j = np.flatnonzero(d * (100 + rule.percent) <= (100 - rule.percent) * (na[i] + nb))
        for column, x in zip(out, (np.full(len(j), i), j, d[j])):
            column.append(x)
    return tuple(np.concatenate(x) for x in out)


def forests(left: np.ndarray, right: np.ndarray, weight: np.ndarray, many: int) -> np.ndarray:
    """Indexes of the edges of up to ``many`` edge-disjoint spanning forests, lightest edges first."""
    rest, chosen = np.argsort(weight, kind="stable"), []
    for _ in range(many):
        root: dict[int, int] = {}
        kept = np.zeros(len(rest), dtype=bool)
        for at, (x, y) in enumerate(zip(left[rest].tolist(), right[rest].tolist())):
            while root.get(x, x) != x:
                root[x] = root.get(root[x], root[x])
                x = root[x]
            while root.get(y, y) != y:
                root[y] = root.get(root[y], root[y])
                y = root[y]
            if x != y:
                root[max(x, y)] = min(x, y)
                kept[at] = True
        if not kept.any():
            break
        chosen.append(rest[kept])
        rest = rest[~kept]
    return np.concatenate(chosen) if chosen else np.zeros(0, dtype=int)


def _cells(rule: Rule, many: int):
    """Sets of cells (key, lo, hi), on side 0 or 1, with the smaller sets that each has failed against; to pairs worth verifying."""
    def run(batches):
        names = ["key", "lo", "hi"]
        for table in grouped_stream(batches, names, 1 << 12):
            bounds = [*group_starts(table, names), table.num_rows]
            for s, e in zip(bounds, bounds[1:]):
                sets = table.slice(s, e - s).combine_chunks()
                if sets.num_rows < 2:
                    continue
                sid, n, root, side = (sets[c].to_numpy() for c in ("sid", "n", "root", "side"))
                bits = np.frombuffer(b"".join(x.as_buffer() for x in sets["bits"]), dtype=np.uint8).reshape(len(sid), -1)
                cell = [sets[c][0].as_py() for c in names]
                whole = cell[1] == cell[2]
                one, two = (np.arange(len(sid)),) * 2 if whole else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
                i, j, d = passing_pairs(bits[one], n[one], bits[two], n[two], rule)
                i, j = one[i], two[j]
                open_ = (root[i] != root[j]) & ((sid[i] < sid[j]) if whole else True)
                i, j, d = i[open_], j[open_], d[open_]
                known = sets["known"].combine_chunks()
                if len(i) and len(known.flatten()):
                    here = {x: at for at, x in enumerate(sid.tolist())}
                    gone = {(at, here[u]) for at, us in enumerate(known.to_pylist()) for u in us or () if u in here}
                    larger, smaller = np.where(sid[i] > sid[j], i, j).tolist(), np.where(sid[i] > sid[j], j, i).tolist()
                    open_ = np.array([p not in gone for p in zip(larger, smaller)])
                    i, j, d = i[open_], j[open_], d[open_]
                if not len(i):
                    continue
                chosen = forests(root[i], root[j], d, many)
                u, v = sid[i[chosen]], sid[j[chosen]]
                m = len(chosen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, cell[0])), pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["key", "u", "v"])
    return run


def _verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (u, v) whose whole sets reach the similarity."""
    one = sets.select(F.col("sid").alias("s1"), F.col("tokens").alias("t1"))
    two = sets.select(F.col("sid").alias("s2"), F.col("tokens").alias("t2"))
    both = pairs.join(one.hint("merge"), F.col("v") == F.col("s1")).join(two.hint("merge"), F.col("u") == F.col("s2"))
    return stage(both.select("u", "v", "t1", "t2").mapInArrow(_linked(rule), "u long, v long"), "jaccard_links")


def _signatures(docs: DataFrame, text_col: str, sets: DataFrame, words: int, rule: Rule) -> DataFrame:
    """(key, sid, n, level) of the sets that may have partners."""
    total = sets.agg(F.sum("n")).first()[0] or 0
    parts = max(1, total // (2 * GATHER))
    entries = docs.select(text_col).mapInArrow(_entries(words, rule, parts), "part long, blob binary")
    counted = entries.repartition("part").sortWithinPartitions("part").mapInArrow(_counts, "view long, token long, df int")
    held = counted.groupBy("view").agg(F.collect_set(F.struct("token", "df")).alias("tokens"))
    level = (F.length(F.bin("n")) - 1).cast("int")
    views = sets.select("sid", "n", F.explode(F.array(F.struct(F.col("v1").alias("of"), F.col("r1").alias("ordered"), level.alias("level")),
                                                      F.struct(F.col("v2").alias("of"), F.col("r2").alias("ordered"), (level + 1).alias("level")))).alias("x"))
    views = views.select("sid", "n", "x.*").where("of IS NOT NULL")
    met = views.join(held.hint("merge"), F.col("of") == F.col("view"))
    return met.select("sid", "n", "level", "ordered", "tokens").mapInArrow(_keys(rule), "key long, sid long, n long, level int")


def _whole_sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(sid, tokens) of the wanted sets, each from one document."""
    found = rows.join(wanted.select(F.col("sid").alias("w")), F.col("sid") == F.col("w"), "left_semi")
    chosen = found.groupBy("sid").agg(F.min(F.struct("doc_id", "digest")).alias("k"))
    copies = found.groupBy(F.col("sid").alias("c"), F.col("doc_id").alias("c_id"), F.col("digest").alias("c_digest")).agg(F.count("*").alias("copies"))
    same = (F.col("sid") == F.col("c")) & F.col("k.doc_id").eqNullSafe(F.col("c_id")) & (F.col("k.digest") == F.col("c_digest"))
    chosen = chosen.join(copies, same).select("sid", F.col("k.doc_id").alias("rep"), F.col("k.digest").alias("rep_digest"), "copies")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    met = texts.join(chosen.hint("merge"), F.col("doc_id").eqNullSafe(F.col("rep")) & (F.xxhash64("text") == F.col("rep_digest")))
    met = stage(met.select("sid", "text", "copies").mapInArrow(_with_copies(words), "sid long, tokens binary, copies long"), "jaccard_tokens")
    again = met.where("copies > 1").groupBy("sid").agg(F.min("tokens").alias("tokens"))
    return met.where("copies = 1").select("sid", "tokens").unionByName(again)


def _with_copies(words: int):
    tokens = _tokens(words)

    def run(batches):
        for batch in batches:
            for found in tokens(iter([batch])):
                yield pa.RecordBatch.from_arrays([*found.columns, batch.column(2)], ["sid", "tokens", "copies"])
    return run


def _links(keyed: DataFrame, sets: DataFrame, rule: Rule, block: int) -> DataFrame:
    """(node, root) of all sets that reach another, through verified pairs of sets that share a key."""
    hubs = keyed.groupBy("key").agg(F.min(F.struct("sid", "n")).alias("hub")).withColumnRenamed("key", "k")
    others = keyed.join(hubs, F.col("key") == F.col("k")).where(F.col("sid") != F.col("hub.sid"))
    others = stage(others.select("key", "sid", "n", "level", F.col("hub.sid").alias("hub"), F.col("hub.n").alias("hub_n")), "jaccard_others")
    fits = 100 * F.least("n", "hub_n") >= rule.percent * F.greatest("n", "hub_n")
    tried = stage(others.where(fits).select(F.col("hub").alias("u"), F.col("sid").alias("v")).distinct(), "jaccard_pairs")
    links = _verified(tried, sets, rule)
    # What is left: keys whose sets beside the least one lie in several components.  First every set's most frequent key,
    # under which most of its partners meet, then the others: so few pairs are asked for under several keys.
    sizes = others.groupBy("key").agg(F.count("*").alias("size")).select(F.col("key").alias("k"), "size")
    sizes = stage(sizes, "jaccard_sizes")
    largest = others.join(sizes, F.col("key") == F.col("k")).groupBy("sid").agg(F.max(F.struct("size", "k")).alias("most"))
    active, covering, many = stage(largest.select(F.col("most.k").alias("k")).distinct(), "jaccard_active"), True, 8
    roots = stage(components(links), "jaccard_roots")
    while True:
        asked = _asked(others.join(active, F.col("key") == F.col("k"), "left_semi"), sets, links, roots, tried, rule, block, many)
        if asked is None or asked.isEmpty():
            if not covering:
                return roots
            active, covering, many = sizes.select("k"), False, 8
            continue
        new = stage(asked.select("u", "v").distinct(), "jaccard_new")
        tried, found = tried.unionByName(new), _verified(new, sets, rule)
        if not found.isEmpty():
            links = stage(links.unionByName(found), "jaccard_links")
            roots = stage(components(links), "jaccard_roots")
        # A cell that asked for nothing has nothing left to ask.
        active = stage(asked.select(F.col("key").alias("k")).distinct(), "jaccard_active")
        many *= 8


def _asked(others: DataFrame, sets: DataFrame, links: DataFrame, roots: DataFrame, tried: DataFrame, rule: Rule, block: int,
           many: int) -> DataFrame | None:
    """(key, u, v) of pairs worth verifying, among sets that share a key and lie in different components; None if none do."""
    rooted = others.join(roots, F.col("sid") == F.col("node"), "left").select("key", "sid", "n", "level", F.coalesce("root", "sid").alias("root"))
    split = rooted.groupBy("key").agg(F.count("*").alias("size"), F.min("root").alias("a"), F.max("root").alias("b")).where("a != b")
    split = stage(split.select(F.col("key").alias("k"), F.ceil(F.col("size") / block).cast("int").alias("grid")), "jaccard_split")
    if split.isEmpty():
        return None
    met = stage(rooted.join(split, F.col("key") == F.col("k")).drop("k"), "jaccard_met")
    bitmaps = met.select("sid", "level").distinct().join(sets.withColumnRenamed("sid", "of").hint("merge"), F.col("sid") == F.col("of"))
    bitmaps = bitmaps.select("sid", "level", "tokens").mapInArrow(_bitmaps, "sid long, level int, bits binary")
    # Failed pairs are kept with their larger set, which has a few of them for each of its keys.
    failed = tried.join(links, ["u", "v"], "left_anti").groupBy(F.col("v").alias("w")).agg(F.collect_set("u").alias("known"))
    about = stage(bitmaps.join(failed.hint("merge"), F.col("sid") == F.col("w"), "left").select("sid", "level", "bits", "known"), "jaccard_bitmaps")
    about = about.select(F.col("sid").alias("of"), F.col("level").alias("at"), "bits", "known")
    met = met.join(about.hint("merge"), (F.col("sid") == F.col("of")) & (F.col("level") == F.col("at")))
    met = met.withColumn("mine", F.pmod(F.xxhash64("sid", F.lit(1)), F.col("grid")).cast("int"))
    met = met.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("grid") - 1)))
    met = met.select("key", F.least("mine", "with").alias("lo"), F.greatest("mine", "with").alias("hi"), "sid", "n", "root",
                     (F.col("mine") > F.col("with")).cast("int").alias("side"), "bits", "known")
    dealt = met.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return stage(dealt.mapInArrow(_cells(rule, many), "key long, u long, v long"), "jaccard_cells")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, percent: int = 90, block: int = 1024) -> DataFrame:
    """doc_id, n_shingles, sid (set, NULL if empty) and component_id of every row."""
    rule = Rule(percent)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("digest"), F.col(text_col))
    rows = stage(rows.mapInArrow(_rows(words, rule), "doc_id long, digest long, n long, sid long, v1 long, r1 long, v2 long, r2 long"), "jaccard_rows")
    sets = stage(rows.where("n > 0").groupBy("sid", "n", "v1", "r1", "v2", "r2").agg(F.min("doc_id").alias("least_doc")), "jaccard_sets")
    keyed = stage(_signatures(docs, text_col, sets, words, rule), "jaccard_keys")
    # Of keys under which the same sets meet, one is enough.
    groups = keyed.groupBy("key").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("sid", F.lit(1))).alias("x"), F.bit_xor(F.xxhash64("sid", F.lit(2))).alias("y"))
    shared = groups.where("c > 1").groupBy("c", "x", "y").agg(F.min("key").alias("k"))
    keyed = stage(keyed.join(shared, F.col("key") == F.col("k"), "left_semi"), "jaccard_shared")
    whole = _whole_sets(docs, rows, keyed.select("sid").distinct(), id_col, text_col, words)
    roots = _links(keyed, whole, rule, block)
    classed = sets.join(roots, F.col("sid") == F.col("node"), "left").select("sid", F.coalesce("root", "sid").alias("class"), "least_doc")
    least = classed.groupBy("class").agg(F.min("least_doc").alias("component_id")).withColumnRenamed("class", "of")
    classes = stage(classed.join(least, F.col("class") == F.col("of")).select(F.col("sid").alias("s"), "component_id"), "jaccard_classes")
    found = rows.where("n > 0").join(classes, F.col("sid") == F.col("s")).select("doc_id", F.col("n").alias("n_shingles"), "sid", "component_id")
    return found.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), "sid", F.col("doc_id").alias("component_id")))
