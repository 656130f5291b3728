"""Source readers.

Every reader returns a DataFrame with the declared columns and types.  Records
that cannot be read go to a second DataFrame and are never dropped silently.  A
disabled or missing source yields an empty DataFrame of the source schema, so
downstream stages always run.
"""

from __future__ import annotations

import csv
import logging
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runway.functions.expr import missing_to_null, parse_cell
from runway.sources import records

log = logging.getLogger(__name__)

SKIP, FAIL = "skip", "fail"


class SourceError(RuntimeError):
    pass


# ------------------------------------------------------------------ JDBC

def jdbc_options(conf: dict) -> dict[str, str]:
    """Reader options for a PostgreSQL table, split into parallel range reads.

    With ``partition_column`` and bounds the scan becomes ``num_partitions``
    concurrent queries (without bounds see ``read_jdbc``); filters and projections
    on the DataFrame are pushed into the SQL the JDBC source generates.
    """
    url = conf.get("url") or f"jdbc:postgresql://{conf['host']}:{conf['port']}/{conf['database']}"
    opts = {
        "url": url,
        "dbtable": conf.get("table", "raw_bookings"),
        "user": conf.get("user", ""),
        "password": conf.get("password", ""),
        "driver": conf.get("driver", "org.postgresql.Driver"),
        "fetchsize": str(conf.get("fetchsize", 10_000)),
    }
    if conf.get("partition_column") and "lower_bound" in conf and "upper_bound" in conf:
        opts.update({
            "partitionColumn": conf["partition_column"],
            "lowerBound": str(conf["lower_bound"]),
            "upperBound": str(conf["upper_bound"]),
            "numPartitions": str(conf.get("num_partitions", 64)),
        })
    return opts


#: Rows that one task of a JDBC scan reads, about, where no bounds are configured.
JDBC_TASK_ROWS = 500_000
#: Range reads of one scan, at most: each is a query to the database.
JDBC_MOST_TASKS = 10_000


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def jdbc_profile_query(table: str, column: str) -> str:
    """One row: least and greatest key, and how many rows there are."""
    key = _quoted(column)
    return f"(SELECT min({key}) AS lo, max({key}) AS hi, count(*) AS n FROM {table}) AS profile"


def jdbc_sample_query(table: str, column: str, rows: int, tasks: int) -> str:
    """Cut points: keys at equal steps of a sample of whole blocks, about 100 rows for each task."""
    key, percent = _quoted(column), min(100.0, 100.0 * 100 * tasks / max(rows, 1))
    return (f"(SELECT max(k) AS cut FROM (SELECT {key} AS k, ntile({tasks}) OVER (ORDER BY {key}) AS part "
            f"FROM {table} TABLESAMPLE SYSTEM ({percent:.6f}) WHERE {key} IS NOT NULL) AS s GROUP BY part ORDER BY cut) AS cuts")


def jdbc_cuts(lo: int, hi: int, tasks: int) -> list[int]:
    """Keys that cut [lo, hi] into equal parts."""
    return sorted({lo + (hi - lo + 1) * i // tasks for i in range(1, tasks)} - {lo})


def jdbc_predicates(column: str, cuts: list[int]) -> list[str]:
    """Conditions of the range reads: every row meets exactly one, rows without a key the first."""
    key, cuts = _quoted(column), sorted(set(cuts))
    if not cuts:
        return []
    first = f"{key} < {cuts[0]} OR {key} IS NULL"
    return [first, *[f"{key} >= {a} AND {key} < {b}" for a, b in zip(cuts, cuts[1:])], f"{key} >= {cuts[-1]}"]


def plan_jdbc_scan(read, table: str, column: str) -> list[str]:
    """Conditions for a scan in parallel; ``read`` runs a query and returns its rows.

    The number of tasks follows the number of rows.  Dense keys are cut into equal ranges; where keys leave gaps
    (fewer rows than half of the range), the cuts come from a sample of the table.
    """
    row = read(jdbc_profile_query(table, column))[0]
    if row["lo"] is None:
        return []
    lo, hi, n = int(row["lo"]), int(row["hi"]), int(row["n"])
    tasks = min(JDBC_MOST_TASKS, -(-n // JDBC_TASK_ROWS))
    if tasks < 2:
        return []
    if 2 * n >= hi - lo + 1:
        return jdbc_predicates(column, jdbc_cuts(lo, hi, tasks))
    cuts = [int(r["cut"]) for r in read(jdbc_sample_query(table, column, n, tasks)) if r["cut"] is not None]
    return jdbc_predicates(column, cuts[:-1] if len(cuts) > 1 else jdbc_cuts(lo, hi, tasks))


def read_jdbc(spark: SparkSession, conf: dict) -> DataFrame:
    """A table read by range queries in parallel.

    Without configured bounds they come from the table itself (``plan_jdbc_scan``), over ``partition_column`` or an integer
    column ``id``; a table without either is read by one task.
    """
    opts = jdbc_options(conf)
    reader = lambda table: spark.read.format("jdbc").options(**{**opts, "dbtable": table}).load()
    whole = reader(opts["dbtable"])
    if "partitionColumn" in opts:
        return whole
    integers = [f.name for f in whole.schema.fields if isinstance(f.dataType, (T.IntegralType, T.DecimalType))]
    column = conf.get("partition_column") or next((c for c in integers if c.lower() == "id"), None)
    if column is None:
        log.warning("%s has no integer column id and no partition_column: one task reads it", opts["dbtable"])
        return whole
    predicates = plan_jdbc_scan(lambda query: reader(query).collect(), opts["dbtable"], column)
    if not predicates:
        return whole
    properties = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(opts["url"], opts["dbtable"], predicates=predicates, properties=properties)


# ------------------------------------------------------------------ structure check

def validate_columns(columns: list[str], expected: list[str]) -> tuple[bool, list[str], list[str]]:
    """(ok, missing, extra); missing columns reject a file, extra ones only warn."""
    missing = sorted(set(expected) - set(columns))
    extra = sorted(set(columns) - set(expected))
    return not missing, missing, extra


def select_expected(df: DataFrame, expected: list[str]) -> DataFrame:
    ok, missing, extra = validate_columns(df.columns, expected)
    if not ok:
        raise SourceError(f"missing columns: {missing}")
    if extra:
        log.warning("extra columns ignored: %s", extra)
    return df.select(*expected)


# ------------------------------------------------------------------ file listing

def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def list_files(spark: SparkSession, paths: list[str], on_error: str = SKIP) -> list[str]:
    """Expand globs and directories into data files; missing paths skip or fail."""
    out = []
    for path in paths:
        fs, p = _hadoop_fs(spark, path)
        statuses = fs.globStatus(p)
        if not statuses:
            if on_error == FAIL:
                raise SourceError(f"file not found: {path}")
            log.error("file not found, skipped: %s", path)
            continue
        for st in statuses:
            if st.isDirectory():
                it = fs.listFiles(st.getPath(), True)
                while it.hasNext():
                    f = it.next().getPath()
                    name = f.getName()
                    if not name.startswith(("_", ".")):
                        out.append(f.toString())
            else:
                out.append(st.getPath().toString())
    return out


def _arrow_uri(path: str) -> str:
    """Hadoop scheme names that Arrow knows by another name."""
    for old in ("s3a://", "s3n://"):
        if path.startswith(old):
            return "s3://" + path[len(old):]
    return path


def _without_mark(head: bytes) -> bytes:
    """A file's beginning without a mark of byte order, blank lines and white space."""
    return head.removeprefix(b"\xef\xbb\xbf").lstrip()


def _first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Read the first line of each file that is not blank, whatever its length (runs inside tasks); NULL for a file Arrow cannot open."""
    from pyarrow import fs as pafs
    for pdf in batches:
        headers = []
        for path in pdf["path"]:
            try:
                filesystem, inner = pafs.FileSystem.from_uri(_arrow_uri(path))
                with filesystem.open_input_stream(inner) as f:
                    head = b""
                    while not any(c in _without_mark(head) for c in b"\r\n") and (block := f.read(1 << 16)):
                        head = _without_mark(head + block)
                headers.append((head.decode("utf-8", errors="replace").splitlines() or [""])[0])
            except Exception:  # no client for that store on the executors: read through Spark instead
                headers.append(None)
        yield pd.DataFrame({"path": pdf["path"], "header": headers})


def read_headers(spark: SparkSession, files: list[str]) -> dict[str, str | None]:
    """Header line of every file, read in parallel by the executors (one row per file comes back)."""
    if not files:
        return {}
    paths = spark.createDataFrame([(f,) for f in files], "path string")
    n = max(1, min(len(files), spark.sparkContext.defaultParallelism * 4))
    got = paths.repartition(n).mapInPandas(_first_lines, "path string, header string").collect()
    headers = {r["path"]: r["header"] for r in got}
    unread = [p for p, h in headers.items() if h is None]
    if unread:
        headers.update(_headers_through_spark(spark, unread))
    return headers


def _headers_through_spark(spark: SparkSession, files: list[str]) -> dict[str, str | None]:
    """Header lines read by Spark's own text scan, of the files Arrow cannot open: the first line of each first block."""
    try:
        lines = spark.read.text(files).select("value", F.col("_metadata.file_path").alias("file"),
                                              F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"))
        firsts = lines.where("at = 0 AND length(trim(regexp_replace(value, '\ufeff', ''))) > 0").groupBy("file").agg(F.min_by("value", "n").alias("line")).collect()
    except Exception as exc:  # unreadable: the files are reported as lacking the columns
        log.error("cannot read %s: %s", files, exc)
        return dict.fromkeys(files)
    by_path = {_plain(r["file"]): r["line"].lstrip("\ufeff") for r in firsts}
    return {f: by_path.get(_plain(f)) for f in files}


def _plain(path: str) -> str:
    """A file's path without the variants of writing it (``file:/x``, ``file:///x``, ``/x``, escaped characters)."""
    from urllib.parse import unquote
    return re.sub(r"^file:/+", "/", unquote(path))


# ------------------------------------------------------------------ CSV

def _split_header(header: str, sep: str) -> list[str]:
    return [h.strip() for h in next(csv.reader([header], delimiter=sep), [])]


_CORRUPT, _MORE = "_corrupt_record", "_more_cells"


def _corrupt_text(cell: str) -> Column:
    """The text of a record that did not parse, else NULL.  Spark refuses queries that need no other column than
    that (a count, say), so the expression also reads a cell."""
    return F.nullif(F.concat_ws("", F.col(_CORRUPT), F.substring(F.col(cell), 1, 0)), F.lit(""))


def _quoted_cells(spark: SparkSession, files: list[str], splits: list[dict], wider: str, options: dict) -> DataFrame:
    """(file, text, cells) of the records after the header, of files with line breaks inside quotes."""
    found = records.quoted_records(spark, files, splits).where(F.length(F.trim("text")) > 0)
    headers = found.groupBy("file").agg(F.min(F.struct("start", "nth")).alias("h")).select("file", "h.*")
    cells = found.join(headers, ["file", "start", "nth"], "left_anti").withColumn("cells", F.from_csv("text", wider, options))
    return cells.select("file", "text", "cells.*")


def read_csv_parts(spark: SparkSession, paths: list[str], expected: list[str], schema: T.StructType,
                   on_error: str = SKIP, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """Multi-file CSV with a per-file header check: (rows of all files by name, rejected records).

    Files are grouped by header; each group is one parallel scan of text cells
    (RFC 4180 quoting), projected to the expected columns and parsed cell by
    cell: a cell that does not parse is NULL, and so are the usual texts for
    missing values.  Files are split between tasks; of those with line breaks
    inside quotes, the parity of the quotation marks before each split says
    where its records start (``records``).  A file whose header lacks an expected
    column is skipped or fails the read; blank lines are no records.  Records
    with more cells than the header go to the rejects (file, record); missing
    cells at the end of a record are NULL, as in pandas.
    """
    files = list_files(spark, paths, on_error)
    headers = read_headers(spark, files)
    typed = {f.name: f.dataType for f in schema.fields}
    groups: dict[tuple, list[str]] = defaultdict(list)
    checked = []
    for path in files:
        header = headers.get(path)
        cols = _split_header(header, sep) if header else []
        ok, missing, extra = validate_columns(cols, expected)
        if not ok:
            if on_error == FAIL:
                raise SourceError(f"{path}: missing columns {missing}")
            log.error("%s: missing columns %s, file skipped", path, missing)
            continue
        if extra:
            log.warning("%s: extra columns ignored: %s", path, extra)
        checked.append((path, tuple(cols)))
    splits = records.quote_summaries(spark, [p for p, _ in checked]) if checked else []
    broken = {_plain(x["file"]) for x in splits if x["broken"]}
    for path, cols in checked:
        groups[cols, _plain(path) in broken].append(path)
    rows, rejects = [], []
    for (cols, multi_line), group in groups.items():
        # Names are positions, so that a header may repeat names or differ only in case.
        cells = [f"c{i}" for i in range(len(cols))]
        options = {"sep": sep, "quote": '"', "escape": '"'}
        wider = ", ".join(f"{c} string" for c in [*cells, _MORE])
        at = {name: cells[i] for i, name in reversed(list(enumerate(cols)))}
        if multi_line:
            # Where Spark splits a file depends on all files of the scan, so a part of them is summed up anew.
            mine = splits if len(group) == len(checked) else records.quote_summaries(spark, group)
            df = _quoted_cells(spark, group, mine, wider, options)
            too_wide, record = F.col(_MORE).isNotNull(), F.col("text")
        else:
            text = T.StructType([T.StructField(c, T.StringType()) for c in [*cells, _CORRUPT]])
            df = (spark.read.schema(text).options(**options).option("header", True).option("mode", "PERMISSIVE")
                  .option("columnNameOfCorruptRecord", _CORRUPT).option("columnPruning", False).csv(group))
            too_wide = F.coalesce(F.from_csv(_corrupt_text(cells[0]), wider, options)[_MORE].isNotNull(), F.lit(False))
            df, record = df.withColumn("file", F.col("_metadata.file_path")), F.col(_CORRUPT)
        rows.append(df.where(~too_wide).select(*[parse_cell(missing_to_null(at[c]), typed[c]).alias(c) for c in expected]))
        rejects.append(df.where(too_wide).select("file", record.alias("record")))
    if not rows:
        return spark.createDataFrame([], T.StructType([T.StructField(c, typed[c]) for c in expected])), _no_rejects(spark)
    return reduce(DataFrame.unionByName, rows), _checked(reduce(DataFrame.unionByName, rejects), on_error)


def read_csv_files(spark: SparkSession, paths: list[str], expected: list[str], schema: T.StructType,
                   on_error: str = SKIP, sep: str = ",") -> DataFrame:
    """The rows of ``read_csv_parts``."""
    return read_csv_parts(spark, paths, expected, schema, on_error, sep)[0]


def _no_rejects(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "file string, record string")


def _checked(rejects: DataFrame, on_error: str) -> DataFrame:
    """S7 for errors that show only when files are read: under ``fail`` any rejected record fails the read now."""
    if on_error == FAIL:
        first = rejects.first()
        if first is not None:
            raise SourceError(f"{first['file']}: cannot read record {first['record'][:200]!r}")
    return rejects


# ------------------------------------------------------------------ JSON

#: Fields beyond the declared ones that get a column of their own; any more share the column ``other_fields``.
MOST_FIELDS = 1000


def field_names(declared: list[str], found: list[str]) -> list[str]:
    """Column names for other fields, given in the order in which the data have them.

    Spark tells names apart without regard to case and takes dots and backticks as syntax, so those become ``_``,
    and a name already taken gets the next free number: ``Level`` beside ``level`` is ``Level_2``.
    """
    taken, out = {d.lower() for d in declared}, []
    for name in found:
        plain = re.sub(r"[.`]", "_", name) or "_"
        column, n = plain, 2
        while column.lower() in taken:
            column, n = f"{plain}_{n}", n + 1
        taken.add(column.lower())
        out.append(column)
    return out


def _last(entries: Column, name: str) -> Column:
    """Value of a field: of its last occurrence if a record repeats it, as in Python's json."""
    return F.try_element_at(F.transform(F.filter(entries, lambda e: e["key"] == name), lambda e: e["value"]), F.lit(-1))


def _json_records(spark: SparkSession, files: list[str], json_array: bool) -> DataFrame:
    """(file, text, fields) of every record; fields are the name-value entries, NULL if the text is no object."""
    if json_array:
        lines = records.array_records(spark, files)
    else:
        lines = spark.read.text(files).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
        lines = lines.where(F.length(F.trim("text", F.lit(" \t\r"))) > 0)
    one = F.array(F.from_json("text", "map<string,string>"))
    if json_array:
        parsed = lines.select("file", "text", one[0].alias("m"))
    else:  # a line may hold an array of records
        many = F.when(F.ltrim(F.col("text"), F.lit(" \t")).startswith("["), F.from_json("text", "array<map<string,string>>"))
        parsed = lines.select("file", "text", F.explode_outer(F.coalesce(many, one)).alias("m"))
    return parsed.select("file", "text", F.map_entries("m").alias("fields"))


def read_json_parts(spark: SparkSession, paths: list[str], schema: T.StructType, on_error: str = SKIP,
                    json_array: bool = True) -> tuple[DataFrame, DataFrame]:
    """JSON records: (declared columns, typed, then every other field as text; rejected records).

    A record is parsed once, into the entries of its names and values, so names may differ only in case, hold any
    character or occur twice, and no record can change how another is read.  The entries are staged; the names of
    the fields that are not declared come from an aggregate over the staged table and become columns
    (``field_names``), in alphabetical order.  Cells are text parsed one by one, so a cell of another type costs that cell
    only.  A line, or an element of an array, that is no JSON object goes to the rejects (file, record).  ``json_array``
    reads files that hold one top-level array, split between tasks like line-delimited files (``json_array=False``).
    """
    from runway.sources.sinks import materialize

    files = list_files(spark, paths, on_error)
    if not files:
        return spark.createDataFrame([], schema), _no_rejects(spark)
    fields = F.col("fields")
    cells = [parse_cell(_last(fields, f.name), f.dataType).alias(f"c{i}") for i, f in enumerate(schema.fields)]
    other = F.filter(fields, lambda e: ~e["key"].isin(*schema.names))
    parsed = _json_records(spark, files, json_array)
    staged = materialize(parsed.select("file", F.when(fields.isNull(), F.col("text")).alias("bad"), *cells, other.alias("other")), "json-fields")
    # In the order of their first occurrence: by file, place in the file, place in the record.
    at = staged.where(F.size("other") > 0).select("file", F.monotonically_increasing_id().alias("n"), F.posexplode("other").alias("nth", "e"))
    found = at.groupBy(F.col("e.key").alias("name")).agg(F.min(F.struct("file", "n", "nth")).alias("first")).orderBy("first").limit(MOST_FIELDS + 1)
    names = [r["name"] for r in found.collect()]
    more, names = len(names) > MOST_FIELDS, names[:MOST_FIELDS]
    extra = sorted(zip(field_names(schema.names, names), names))
    columns = [_last(F.col("other"), name).alias(column) for column, name in extra]
    if more:
        log.warning("more than %d fields, the others are kept in one column", MOST_FIELDS)
        rest = F.filter("other", lambda e: ~e["key"].isin(*names))
        columns.append(F.when(F.size(rest) > 0, F.to_json(rest)).alias(field_names([*schema.names, *(c for c, _ in extra)], ["other_fields"])[0]))
    good = F.col("bad").isNull()
    rows = staged.where(good).select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(schema.names)], *columns)
    rejects = staged.where(~good).select("file", F.col("bad").alias("record"))
    return rows, _checked(rejects, on_error)


def read_json(spark: SparkSession, paths: list[str], schema: T.StructType, on_error: str = SKIP,
              json_array: bool = True) -> DataFrame:
    """The rows of ``read_json_parts``."""
    return read_json_parts(spark, paths, schema, on_error, json_array)[0]


# ------------------------------------------------------------------ parquet (S9) and SQL

def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def sql(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """A SQL string over DataFrames passed by name (``{name}`` in the text)."""
    return spark.sql(query, **frames)


# ------------------------------------------------------------------ switch and policy

def extract_sources(spark: SparkSession, config: dict, schemas: dict[str, T.StructType],
                    rejects: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Read every configured source; disabled or unreadable ones become empty frames.

    ``config['sources'][name]`` holds ``enabled`` and ``format`` (``jdbc``,
    ``csv``, ``json``, ``parquet``) plus the format's own keys;
    ``config['processing']['on_validation_error']`` is ``skip`` or ``fail``.
    ``rejects``, if given, gets the rejected records of each file source.
    """
    on_error = config.get("processing", {}).get("on_validation_error", SKIP)
    out = {}
    for name, schema in schemas.items():
        conf = config.get("sources", {}).get(name, {})
        if not conf.get("enabled", False):
            log.info("source %s disabled", name)
            out[name] = spark.createDataFrame([], schema)
            continue
        fmt = conf.get("format")
        # Maintenance files are always skipped on error, as in the reference.
        policy = SKIP if name == "maintenance" else on_error
        bad = None
        try:
            if fmt in ("jdbc", "parquet"):
                df = read_jdbc(spark, conf) if fmt == "jdbc" else read_parquet(spark, conf["path"])
                df = select_expected(df, schema.names).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
            elif fmt == "csv":
                df, bad = read_csv_parts(spark, conf["files"], schema.names, schema, policy)
            elif fmt == "json":
                df, bad = read_json_parts(spark, conf["files"], schema, policy, conf.get("json_array", True))
            else:
                raise SourceError(f"unknown format {fmt!r} for {name}")
        except Exception as exc:
            if policy == FAIL or isinstance(exc, SourceError) and fmt not in ("csv", "json", "jdbc", "parquet"):
                raise
            log.error("source %s failed, using empty input: %s", name, exc)
            df = spark.createDataFrame([], schema)
            if fmt in ("csv", "json"):
                lost = [(f, f"unread: {exc}"[:1000]) for f in list_files(spark, conf.get("files", []))]
                bad = spark.createDataFrame(lost, "file string, record string")
        if rejects is not None and bad is not None:
            rejects[name] = bad
        out[name] = df
    return out
