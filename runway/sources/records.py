"""Records that do not end with a line, read by several tasks.

Spark's text scan cuts a file into splits and hands every task whole pieces between separators.  Where a piece ends
inside a record (a line break within quotes, a brace within a string or a nested object), the state at its start
depends on all that comes before it in the file.  So a first pass reduces every split to what it does to that
state, whatever the state is; the few numbers of each split are composed in file order; and a second pass, in which each task
knows the state at its start, cuts its pieces into records.  A record over two or more splits comes in fragments,
which are put together by file and the split in which it begins.

The first pass returns one row per split (``spark.sql.files.maxPartitionBytes``), the only thing that reaches the driver.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUOTE, BACKSLASH, OPEN, CLOSE = (ord(c) for c in '"\\{}')
#: Depth changes by these characters, outside strings.
_STEP = np.zeros(256, dtype=np.int8)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1
#: What may stand between the records of an array.
_BETWEEN = b" \t\r\n,[]"
_STRAY = np.ones(256, dtype=bool)
_STRAY[list(_BETWEEN)] = False
_FAR = 1 << 40

RECORD_SCHEMA = "file string, opener long, start long, nth long, text binary"


def pieces(spark: SparkSession, files: list[str], separator: str | None = None) -> DataFrame:
    """(value, file, start of the split, size of the file) of the pieces between separators (default: line ends)."""
    reader = spark.read.option("lineSep", separator) if separator else spark.read
    return reader.text(files).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
                                     F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("size"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, list[bytes], bool]]:
    """(file, start, size, pieces, whether they are the split's first) of consecutive pieces of one split."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start, size = batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()
        value = batch.column(0).to_pylist()
        at = 0
        while at < len(value):
            end = at + 1
            while end < len(value) and file[end] == file[at] and start[end] == start[at]:
                end += 1
            yield file[at], start[at], size[at], value[at:end], last != (file[at], start[at])
            last = file[at], start[at]
            at = end


def strings(buf: np.ndarray, inside: int) -> tuple[np.ndarray, int]:
    """Whether each byte lies in a JSON string (by the quotes up to it), and whether the next one will."""
    quote = buf == QUOTE
    back = buf == BACKSLASH
    if back.any():
        # A quote after an odd number of backslashes is part of its string.
        place = np.arange(len(buf))
        other = np.maximum.accumulate(np.where(back, -1, place))
        after = np.flatnonzero(quote[1:] & back[:-1]) + 1
        quote[after[(after - 1 - other[after - 1]) % 2 == 1]] = False
    state = (np.cumsum(quote, dtype=np.int64) + inside) & 1
    return state, int(state[-1]) if len(state) else inside


# ------------------------------------------------------------------ arrays of JSON objects

def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each split does, started outside a string or inside one: depth it adds, least depth at a closing brace."""
    def row(key, s):
        return pa.RecordBatch.from_pylist([{"file": key[0], "start": key[1], "size": key[2], **s}], schema=_SUMMARY)

    key, s = None, {}
    for file, start, size, values, first in _runs(batches):
        if first:
            if key:
                yield row(key, s)
            key = file, start, size
            s = {"parity": 0, "d0": 0, "m0": _FAR, "d1": 0, "m1": _FAR, "bytes": 0, "opens": ""}
        # The separator goes before its piece; the first piece of a file has none.
        text = (b"" if first and start == 0 else b"}") + b"}".join(values)
        s["bytes"] += sum(map(len, values)) + len(values)
        if start == 0 and not s["opens"]:
            s["opens"] = text.lstrip(b"\xef\xbb\xbf \t\r\n")[:1].decode("latin-1")
        buf = np.frombuffer(text, dtype=np.uint8)
        state, ended = strings(buf, s["parity"])
        for h in (0, 1):
            step = np.where(state == h, _STEP[buf], 0).cumsum(dtype=np.int64)
            closing = step[(buf == CLOSE) & (state == h)]
            if len(closing):
                s[f"m{h}"] = min(s[f"m{h}"], s[f"d{h}"] + int(closing.min()))
            s[f"d{h}"] += int(step[-1]) if len(step) else 0
        s["parity"] = ended
    if key:
        yield row(key, s)


_SUMMARY = pa.schema([("file", pa.string()), ("start", pa.int64()), ("size", pa.int64()), *((n, pa.int64()) for n in ("parity", "d0", "m0", "d1", "m1", "bytes")),
                      ("opens", pa.string())])


def opening_states(splits: list[dict]) -> tuple[dict, bool]:
    """(file, start) -> (in a string, depth, depth between records, split where the open record begins, what the scan has
    left off after the split if it is the file's last, else None); and whether some file has several splits."""
    files = defaultdict(list)
    for s in splits:
        files[s["file"]].append(s)
    states = {}
    for file, parts in files.items():
        parts.sort(key=lambda s: s["start"])
        base = int(parts[0]["opens"] == "[")
        inside, depth, opener = 0, 0, parts[0]["start"]
        for s in parts:
            if not inside and depth <= base:
                opener = s["start"]
            states[file, s["start"]] = [inside, depth, base, opener, None]
            if depth + s[f"m{inside}"] <= base:
                opener = s["start"]
            inside, depth = inside ^ s["parity"], depth + s[f"d{inside}"]
        # The scan does not tell a brace at the very end from none; the number of bytes (less a mark of byte order) does.
        total, size = sum(s["bytes"] for s in parts), parts[0]["size"]
        if total - 1 in (size, size - 3):
            ending = b""
        else:  # of a compressed file the bytes tell nothing, but an open record does
            ending = b"}" if total in (size, size - 3) or (inside, depth) == (0, base + 1) else b""
        states[file, parts[-1]["start"]][4] = ending
    return states, len(states) > len(files)


class _Cutter:
    """Cuts the text of one split into records."""

    def __init__(self, file: str, start: int, state: tuple):
        self.file, self.start, self.out, self.nth = file, start, [], 0
        self.inside, self.depth, self.base, self.opener, self.ending = state
        self.head, self.rest = bool(self.inside or self.depth > self.base), b""

    def emit(self, text: bytes, opener: int | None) -> None:
        self.out.append((self.file, opener, self.start, self.nth, text))
        self.nth += 1

    def feed(self, text: bytes) -> None:
        text = self.rest + text
        buf = np.frombuffer(text, dtype=np.uint8)
        state, ended = strings(buf, self.inside)
        outside = state == 0
        depth = self.depth + np.where(outside, _STEP[buf], 0).cumsum(dtype=np.int64)
        closes = np.flatnonzero((buf == CLOSE) & outside & (depth == self.base))
        opens = np.flatnonzero((buf == OPEN) & outside & (depth == self.base + 1))
        if self.head:
            if not len(closes):  # still within the record of an earlier split
                if text:
                    self.emit(text, self.opener)
                self.inside, self.depth, self.rest = ended, int(depth[-1]) if len(depth) else self.depth, b""
                return
            self.emit(text[:closes[0] + 1], self.opener)
            self.head = False
            at, closes = int(closes[0]) + 1, closes[1:]
        else:
            at = 0
        stray = np.concatenate([[0], np.cumsum(_STRAY[buf] | ~outside)])
        begins = iter(opens[opens >= at].tolist())
        begin = next(begins, len(text))
        for end in closes.tolist():
            if begin > end:  # a brace that closes no object
                self.emit(text[at:end + 1], None)
            else:
                if stray[begin] > stray[at]:
                    self.emit(text[at:begin].strip(b" \t\r\n,"), None)
                self.emit(text[begin:end + 1], None)
            at = end + 1
            while begin < at:
                begin = next(begins, len(text))
        # What is left begins between two records.
        if at:
            self.inside, self.depth = 0, self.base
        self.rest = text[at:]

    def finish(self) -> list[tuple]:
        if self.ending:
            self.feed(self.ending)
        if self.ending is None:
            if self.rest:
                self.emit(self.rest, self.start)
        elif rest := self.rest.strip(_BETWEEN):  # nothing follows: text that is no whole object
            self.emit(rest, None)
        return self.out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of RECORD_SCHEMA."""
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["file", "opener", "start", "nth", "text"])


def _cut(states):
    def run(batches):
        cutter = None
        for file, start, _, values, first in _runs(batches):
            if first:
                if cutter and (rows := cutter.finish()):
                    yield _batch(rows)
                cutter = _Cutter(file, start, states.value[file, start])
            cutter.feed((b"" if first and start == 0 else b"}") + b"}".join(values))
            if cutter.out:
                yield _batch(cutter.out)
                cutter.out = []
        if cutter and (rows := cutter.finish()):
            yield _batch(rows)
    return run


def array_records(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file, text) of the objects in files that hold one JSON array, or objects one after the other.

    Text between objects (numbers in the array, say) comes as a row of its own, and so does a cut record.  A file of any size is cut
    by as many tasks as Spark makes splits of it.
    """
    from runway.sources.sinks import materialize

    cells = pieces(spark, files, "}")
    splits = [r.asDict() for r in cells.mapInArrow(
        _summaries, "file string, start long, size long, parity long, d0 long, m0 long, d1 long, m1 long, bytes long, opens string").collect()]
    states, several = opening_states(splits)
    cut = cells.mapInArrow(_cut(spark.sparkContext.broadcast(states)), RECORD_SCHEMA)
    text = F.col("text").cast("string").alias("text")
    if not several:
        return cut.select("file", text)
    cut = materialize(cut, "json-records")  # read twice: whole records and fragments
    return cut.where("opener IS NULL").select("file", text).unionByName(_put_together(cut))


def _put_together(cut: DataFrame) -> DataFrame:
    """The records that come in fragments; what stands between records goes."""
    parts = F.array_sort(F.collect_list(F.struct("start", "nth", "text")))
    whole = cut.where("opener IS NOT NULL").groupBy("file", "opener").agg(parts.alias("parts"))
    text = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["text"])).cast("string")
    text = F.ltrim(text, F.lit(" \t\r\n,["))
    text = F.when(text.startswith("{"), text).otherwise(F.trim(text, F.lit(_BETWEEN.decode())))
    return whole.select("file", text.alias("text")).where("text != ''")


# ------------------------------------------------------------------ CSV with line breaks inside quotes

def _join_lines(states):
    """Lines to records: a record ends with the line after which the number of quotation marks is even."""
    def run(batches):
        held = {"key": None, "opener": None, "nth": 0, "odd": False, "lines": []}

        def rows(text, opener):
            held["nth"] += 1
            return held["key"][0], opener, held["key"][1], held["nth"], text

        for file, start, _, values, first in _runs(batches):
            out = []
            if first:
                if held["lines"]:
                    out.append(rows(b"\n".join(held["lines"]), held["opener"]))
                odd, opener = states.value[file, start]
                # Lines of an earlier split's record up to its end are a fragment of it.
                held = {"key": (file, start), "opener": opener if odd else start, "nth": 0, "odd": odd, "head": odd, "lines": []}
            for line in values:
                if not held["odd"] and not held["lines"] and QUOTE not in line:
                    out.append(rows(line, None))
                    continue
                held["lines"].append(line)
                held["odd"] ^= line.count(b'"') % 2 == 1
                if not held["odd"]:
                    out.append(rows(b"\n".join(held["lines"]), held["opener"] if held["head"] else None))
                    held.update(lines=[], head=False, opener=start)
            if out:
                yield _batch(out)
        if held["lines"]:
            yield _batch([rows(b"\n".join(held["lines"]), held["opener"])])
    return run


def quote_summaries(spark: SparkSession, files: list[str]) -> list[dict]:
    """One row per split: whether its quotation marks are odd in number, and whether those of some line are."""
    quotes = F.regexp_count(F.col("value").cast("string"), F.lit('"')) % 2
    splits = pieces(spark, files).groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"), F.max(quotes).alias("broken"))
    return [r.asDict() for r in splits.collect()]


def quoted_records(spark: SparkSession, files: list[str], splits: list[dict]) -> DataFrame:
    """(file, start, nth, text) of the records of CSV files whose quoted cells hold line breaks, each file cut by
    several tasks; line breaks inside quotes become ``\\n``.  ``splits`` are the summaries of exactly these files."""
    from runway.sources.sinks import materialize

    by_file = defaultdict(list)
    for s in splits:
        by_file[s["file"]].append((s["start"], bool(s["odd"]), bool(s["broken"])))
    states = {}
    for file, parts in by_file.items():
        odd, opener = False, None
        for start, flips, broken in sorted(parts):
            states[file, start] = odd, opener
            if not odd or broken:  # a record may begin here
                opener = start
            odd ^= flips
    cut = pieces(spark, files).mapInArrow(_join_lines(spark.sparkContext.broadcast(states)), RECORD_SCHEMA)
    cut = materialize(cut, "csv-records")
    whole = cut.where("opener IS NULL").select("file", "start", "nth", F.col("text").cast("string").alias("text"))
    parts = F.array_sort(F.collect_list(F.struct("start", "nth", "text")))
    joined = cut.where("opener IS NOT NULL").groupBy("file", "opener").agg(parts.alias("parts"))
    # Fragments are cut at line ends.
    text = F.array_join(F.transform("parts", lambda p: p["text"].cast("string")), "\n")
    first = F.col("parts")[0]
    return whole.unionByName(joined.select("file", first["start"].alias("start"), first["nth"].alias("nth"), text.alias("text")))
