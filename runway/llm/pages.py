"""Operator 8: main text of HTML pages, by nearest-URL page differencing over marked-up blocks.

A page becomes a list of lines: the texts of its blocks in page order, each with what its markup says: boilerplate
(menus, forms, adverts and the like), article (inside ``article`` or ``main``) or open.  Within each host pages are
put in the order of their URL paths, and neighbours that share most of their open text are one run of copies; a page
is paired with the end of the run before or after its own that shares the longer start of the path, their lines are aligned by longest common subsequence, and open lines that both share are deleted: they belong to
the site.  What stays is the article, or all open lines that stay if a page marks none.  Markup decides first because
sites fill their menus and adverts differently on every page, and because neighbouring articles may quote the same
paragraph; differencing finds the unmarked rest.  A copy or near copy (another query string, date or counter) says
nothing about the site: only a line that a really different page of the host has too is deleted.

Neighbours are found by a distributed running count over the sorted paths, so a host of any size is spread over
tasks; hashes of lines, not texts, travel to the neighbour.

Defined cases: NULL or blank html gives the empty text; a NULL or host-less URL has no neighbours, a page without text is none; repeated rows each
give a row, and count once as neighbours; unclosed and cut-off markup ends with the page; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lcs import common_places
from .tables import running_totals, stage

# Names of HTML elements and of roles, and words common in class and id attributes.
RAW = frozenset("script style textarea title iframe noscript noembed noframes xmp".split())
BOILERPLATE = frozenset("head nav footer aside form button select menu dialog template svg object audio video canvas map".split())
INLINE_END = frozenset("p li dt dd option".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
MARKS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar menu nav navbar navigation
    breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices banner popup modal overlay newsletter subscribe subscription
    comment comments commentlist reply replies respond disqus share sharing social related recommended widget login signup masthead
    toolbar pagination pager skip""".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"']+)|([^\s=\"'/]+)")
_WORD = re.compile(r"[a-z]+")

OPEN, ARTICLE, BOILER = 0, 1, 2
#: Share of the open characters from which on two pages are copies, and places whose pages share a row of a neighbour.
COPY, PIECE = 0.8, 1024


def _marked(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element is boilerplate by its name, role, class, id or because it is hidden."""
    if name in BOILERPLATE or name == "header" and not inside:
        return True
    if not attributes.strip():
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = (m[1] or m[3]).lower(), (m[2] or "").strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in ROLES:
            return True
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True
        if key in ("class", "id"):
            words = set(_WORD.findall(value))
            if words & MARKS or "header" in words and not inside:
                return True
    return False


def lines(html: str | None) -> list[tuple[str, int]]:
    """(text, kind) of every block with text, in page order; kind is OPEN, ARTICLE or BOILER."""
    html = html or ""
    found: list[tuple[str, int]] = []
    held: list[str] = []
    article = 0  # depth of article and main elements
    skip, depth = "", 0  # the boilerplate element that is open, and elements of its name in it

    def end_block() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            found.append((text, BOILER if skip else ARTICLE if article else OPEN))

    at = 0
    while True:
        m = _TOKEN.search(html, at)
        held.append(html[at:m.start()] if m else html[at:])
        if not m:
            break
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            continue
        closing = bool(m[1])
        if name in BLOCKS:
            end_block()
        elif name in ("br", "td", "th", "option"):
            held.append(" ")
        if skip in INLINE_END and name in BLOCKS:
            skip = ""
        if name in RAW and not closing:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = close.end() if close else len(html)
            continue
        if skip:
            if name == skip:
                depth += -1 if closing else 1
                if not depth:
                    end_block()
                    skip = ""
        elif not closing and name not in VOID and not m[3].rstrip().endswith("/") and _marked(name, m[3], article > 0):
            end_block()
            skip, depth = name, 1
        elif name in ("article", "main"):
            article = max(0, article + (-1 if closing else 1))
    end_block()
    return found


def shared_open_lines(page: list[tuple[int, int]], other: list[int]) -> list[int]:
    """Places of the open lines that the page shares with its neighbour; none if it shares them all."""
    shared = [i for i, _ in common_places([h for h, _ in page], other) if page[i][1] == OPEN]
    return [] if len(shared) == sum(kind == OPEN for _, kind in page) else shared


def near_copy(page: list[int], sizes: list[int], other: list[int], other_open: int) -> bool:
    """Whether two pages share most of their open text; ``sizes`` has the characters of open lines, 0 for others."""
    most = max(sum(sizes), other_open)
    return most > 0 and sum(sizes[i] for i, _ in common_places(page, other)) >= COPY * most


def main_text(html: str | None, deleted: set[int] = frozenset()) -> str:
    """The page's article, or its open lines, without the lines at the given places; joined by blank lines."""
    page = [(i, text, kind) for i, (text, kind) in enumerate(lines(html)) if kind != BOILER and i not in deleted]
    kind = ARTICLE if any(k == ARTICLE for *_, k in page) else OPEN
    return "\n\n".join(text for _, text, k in page if k == kind)


def _outline(batches):
    """(key, url, html) to host, path, the lines' hashes, kinds and sizes, and the smallest hash of an open line, of the
    pages that have a host and text."""
    for batch in batches:
        rows = []
        for key, url, html in zip(*(c.to_pylist() for c in batch.columns)):
            try:
                parts = urlsplit(url or "")
                host = parts.hostname
            except ValueError:
                continue
            if host and (page := lines(html)):
                hashes = [xxhash.xxh3_64_intdigest(t.encode()) - (1 << 63) for t, _ in page]
                rows.append((key, host, parts.path, hashes, [k for _, k in page], [len(t) if k == OPEN else 0 for t, k in page],
                             min((h for h, (_, k) in zip(hashes, page) if k == OPEN), default=0)))
        key, host, path, hashes, kinds, sizes, least = zip(*rows) if rows else [()] * 7
        yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(host, pa.string()), pa.array(path, pa.string()),
                                          pa.array(hashes, pa.list_(pa.int64())), pa.array(kinds, pa.list_(pa.int32())),
                                          pa.array(sizes, pa.list_(pa.int32())), pa.array(least, pa.int64())],
                                         ["key", "host", "path", "hashes", "kinds", "sizes", "least"])


def _start(a: str, b: str) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _heads(batches):
    """Pages beside the page before them to their places, and 1 if they begin a run of copies."""
    for batch in batches:
        rows = batch.to_pylist()
        new = [int(r["last_hashes"] is None or not near_copy(r["hashes"], r["sizes"], r["last_hashes"], r["last_open"])) for r in rows]
        yield pa.RecordBatch.from_arrays([pa.array([r["place"] for r in rows], pa.int64()), pa.array(new, pa.int64())], ["place", "new"])


def _difference(batches):
    """Pages beside their neighbours to the places of deleted lines."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            near = [(row[f"{side}_path"], row[f"{side}_hashes"]) for side in ("last", "next") if row[f"{side}_hashes"] is not None
                    and not near_copy(row["hashes"], row["sizes"], row[f"{side}_hashes"], row[f"{side}_open"])]
            if near:
                _, other = max(near, key=lambda x: _start(row["path"], x[0]))
                if deleted := shared_open_lines(list(zip(row["hashes"], row["kinds"])), other):
                    out.append((row["key"], deleted))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([d for _, d in out], pa.list_(pa.int32()))],
                                         ["key", "deleted"])


def _texts(batches):
    for batch in batches:
        found = [main_text(h.as_py(), set(d.as_py() or ())) for h, d in zip(batch.column(2), batch.column(3))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()),
                                          pa.array(np.array([len(t) for t in found], dtype=np.int64))], ["page_id", "url", "text", "n_chars"])


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    rows = rows.withColumn("key", F.xxhash64("page_id", "url", "html"))
    outline = rows.select("key", "url", "html").mapInArrow(_outline, "key long, host string, path string, hashes array<long>, kinds array<int>, sizes array<int>, least long")
    outline = outline.dropDuplicates(["key"]).withColumn("one", F.lit(1).cast("long"))
    # Within a path by the smallest open line, so that most near copies are neighbours.
    placed = stage(running_totals(outline, [], ["host", "path", "least", "key"], {"place": "one"}).drop("one", "least"), "pages_placed")
    # Only pages with an open line can lose one.
    is_open = F.array_contains("kinds", OPEN)
    open_chars = F.aggregate("sizes", F.lit(0).cast("long"), lambda x, y: x + y)

    def beside(at, side: str) -> list:
        return [at.alias(f"{side}_at"), F.col("host").alias(f"{side}_host"), F.col("path").alias(f"{side}_path"),
                F.col("hashes").alias(f"{side}_hashes"), open_chars.alias(f"{side}_open")]

    before = placed.where(is_open).select(*beside(F.col("place") + 1, "last"))
    heads = placed.where(is_open).join(before, (F.col("place") == F.col("last_at")) & (F.col("host") == F.col("last_host")), "left")
    heads = heads.select("place", "hashes", "sizes", "last_hashes", "last_open").mapInArrow(_heads, "place long, new long")
    heads = heads.union(placed.where(~is_open).select("place", F.lit(1).cast("long")))
    runs = running_totals(heads, [], ["place"], {"run": "new"})
    runs = stage(runs.select("place", (F.col("run") + F.col("new")).alias("run")), "pages_runs")
    ends = stage(runs.groupBy("run").agg(F.min("place").alias("first"), F.max("place").alias("last")), "pages_ends")
    asked = placed.where(is_open).join(runs.withColumnRenamed("place", "_place"), F.col("place") == F.col("_place"))
    asked = asked.withColumn("piece", F.floor(F.col("place") / PIECE))
    # A neighbour's row goes once to every PIECE pages of a run, so that a run of any length is spread.
    pieces = ends.select(F.col("run").alias("to_run"), F.explode(F.sequence(F.floor(F.col("first") / PIECE), F.floor(F.col("last") / PIECE))).alias("to_piece"))
    for side, step in (("last", 1), ("next", -1)):
        end = ends.select((F.col("run") + step).alias("for_run"), F.col("last" if side == "last" else "first").alias("end_place"))
        near = placed.select(*beside(F.col("place"), side)).join(end, F.col(f"{side}_at") == F.col("end_place"))
        near = near.join(pieces, F.col("for_run") == F.col("to_run")).drop("for_run", "end_place", f"{side}_at")
        asked = asked.join(near, (F.col("run") == F.col("to_run")) & (F.col("piece") == F.col("to_piece")) & (F.col("host") == F.col(f"{side}_host")), "left")
        asked = asked.drop("to_run", "to_piece", f"{side}_host")
    asked = asked.select("key", "path", "hashes", "kinds", "sizes", "last_path", "last_hashes", "last_open", "next_path", "next_hashes", "next_open")
    deleted = stage(asked.mapInArrow(_difference, "key long, deleted array<int>"), "pages_deleted").withColumnRenamed("key", "_key")
    with_lines = rows.join(deleted, F.col("key") == F.col("_key"), "left").select("page_id", "url", "html", "deleted")
    return with_lines.mapInArrow(_texts, "page_id long, url string, text string, n_chars long")
