"""Records over several lines and splits: JSON arrays and quoted CSV cells read by many tasks, odd names, blank lines."""

import json
import os
import random

import pandas as pd
import pytest
from pyspark.sql import types as T

from runway import schemas as S
from runway.sources import readers, records
from tests.fixtures import write_text

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in (SPLIT, "spark.sql.files.openCostInBytes")}
    spark.conf.set(SPLIT, "397")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])
ODD = ['plain', 'brace } in { text', 'quote \\" and } { [', 'back\\\\', '\\\\\\"}', 'line\nbreak', '[]', '', 'Ä€', "},{", 'x' * 400]


def odd_records(n, seed):
    rng = random.Random(seed)
    return [{"id": i, "text": rng.choice(ODD), **({"deep": {"a": [{"b": "}"}, 1]}} if rng.random() < 0.2 else {})} for i in range(n)]


def parts(spark, path, **kw):
    rows, rejects = readers.read_json_parts(spark, [path], SCHEMA, **kw)
    return sorted((r.id, r.text) for r in rows.collect()), [r.record for r in rejects.collect()]


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("ending", ["", "\n", "  \n\n"])
def test_array_file_over_many_splits(spark, tmp_dir, small_splits, indent, ending):
    want = odd_records(120, len(ending))
    path = write_text(os.path.join(tmp_dir, "a.json"), json.dumps(want, indent=indent, ensure_ascii=False) + ending)
    assert records.pieces(spark, [path], "}").rdd.getNumPartitions() > 8
    got, rejects = parts(spark, path)
    assert got == [(r["id"], r["text"]) for r in want] and not rejects
    deep = readers.read_json(spark, [path], SCHEMA).where("deep IS NOT NULL")
    assert {json.dumps(json.loads(r.deep)) for r in deep.collect()} == {'{"a": [{"b": "}"}, 1]}'}


def test_every_cut_of_a_file_loses_at_most_its_last_record(spark, tmp_dir, small_splits):
    want = odd_records(9, 5)
    whole = json.dumps(want, ensure_ascii=False).encode()
    for at in random.Random(1).sample(range(len(whole)), 12):
        path = os.path.join(tmp_dir, f"cut{at}.json")
        with open(path, "wb") as f:
            f.write(whole[:at])
        got, rejects = parts(spark, path)
        assert got == [(r["id"], r["text"]) for r in want][:len(got)]
        assert len(rejects) <= 1 and whole[:at].count(b'"id"') <= len(got) + 1


@pytest.mark.parametrize("text,ids,rejected", [
    ('[{"id": 1}, 7, {"id": 2}, "x}", [{"id": 9}], {"id": 3}]', [1, 2, 3], 2), ("[]", [], 0), ("", [], 0), (" \n", [], 0), ("17", [], 1),
    ('{"id": 1}', [1], 0), ('{"id": 1}\n{"id": 2}', [1, 2], 0), ('[{"id": 1}, {"id": 2', [1], 1), ('[{"id": 1}}, {"id": 2}]', [1], 1),
    ('﻿[{"id": 4}]', [4], 0), ("null", [], 1)])
def test_text_between_records_is_rejected_and_records_stay(spark, tmp_dir, text, ids, rejected):
    got, rejects = parts(spark, write_text(os.path.join(tmp_dir, "x.json"), text))
    assert [i for i, _ in got] == ids and len(rejects) == rejected, rejects


@pytest.mark.parametrize("array", [True, False])
def test_names_that_differ_in_case_or_hold_any_character(spark, tmp_dir, array):
    lines = [{"level": "info", "timestamp": "2024-02-01 10:00"} for _ in range(100)]
    lines.append({"Level": "warn", "a`b": 1, "a.b": 2, "": 3, "LEVEL": "x", "select *": 4, "Note": "n"})
    text = json.dumps(lines) if array else "\n".join(map(json.dumps, lines)) + '\n{"level": "a", "level": "b", "x": 1, "x": 2}\n'
    path = write_text(os.path.join(tmp_dir, "l.json"), text)
    rows, rejects = readers.read_json_parts(spark, [path], S.LOGS, json_array=array)
    assert rows.count() == (101 if array else 102) and rejects.count() == 0
    new = ["LEVEL_3", "Level_2", "Note", "_", "a_b", "a_b_2", "select *"]
    assert rows.columns == [*S.LOGS.names, *sorted(new if array else [*new, "x"])]
    odd = rows.where("Level_2 IS NOT NULL").first().asDict()
    assert [odd[c] for c in ("level", "Level_2", "a_b", "a_b_2", "_", "LEVEL_3", "select *")] == [None, "warn", "1", "2", "3", "x", "4"]
    assert rows.where("level = 'info'").count() == 100
    if not array:
        assert rows.where("x = '2' AND level = 'b'").count() == 1  # the last of a repeated name, as in Python


def test_field_names_are_numbered_in_order_of_occurrence():
    assert readers.field_names(["level"], ["Level", "LEVEL", "Level_2", "a.b", "a`b", "", "_"]) == [
        "Level_2", "LEVEL_3", "Level_2_2", "a_b", "a_b_2", "_", "__2"]


def test_fields_beyond_the_limit_share_a_column(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(readers, "MOST_FIELDS", 3)
    path = write_text(os.path.join(tmp_dir, "l.json"), "\n".join(json.dumps({"id": i, f"k{i}": i}) for i in range(6)))
    rows, _ = readers.read_json_parts(spark, [path], SCHEMA, json_array=False)
    assert rows.columns == ["id", "text", "k0", "k1", "k2", "other_fields"]
    assert [json.loads(r.other_fields) for r in rows.orderBy("id").collect() if r.other_fields] == [[{"key": f"k{i}", "value": str(i)}] for i in (3, 4, 5)]


def test_lines_that_hold_arrays(spark, tmp_dir):
    path = write_text(os.path.join(tmp_dir, "l.json"), '[{"id": 1}, {"id": 2}]\n\n  \n{"id": 3}\n[\n')
    got, rejects = parts(spark, path, json_array=False)
    assert [i for i, _ in got] == [1, 2, 3] and rejects == ["["]


def test_odd_names_reach_the_cleaned_logs(spark, tmp_dir):
    from runway.plans import cleaning, job
    logs = write_text(os.path.join(tmp_dir, "l.json"), '{"level": " info", "a`b": 1}\n{"Level": "x", "a.b": 2}\n{"a b": 3}\n')
    config = {"sources": {"logs": {"enabled": True, "format": "json", "files": [logs], "json_array": False}}}
    raw = job.extract_raw(spark, config, os.path.join(tmp_dir, "run"))
    assert cleaning.transform_logs(raw["logs"]).clean.count() == 3


def quoted_csv(n, seed):
    rng = random.Random(seed)
    cells = ['plain', 'a,b', 'say "hi"', 'two\nlines', 'three\n\n"lines"\n', '""', 'x' * 150, 'end "']
    quote = lambda c: '"' + c.replace('"', '""') + '"' if set(c) & set(',"\n') else c
    want = [(i, rng.choice(cells)) for i in range(n)]
    return want, "".join(f"{i},{quote(c)}\n" for i, c in want)


@pytest.mark.parametrize("head", ["id,text\n", "\n\n  \nid,text\n", "﻿id,text\n", "﻿\nid,text\n"])
def test_quoted_line_breaks_over_many_splits(spark, tmp_dir, small_splits, head):
    want, text = quoted_csv(150, len(head))
    path = write_text(os.path.join(tmp_dir, "q.csv"), head + text)
    assert records.pieces(spark, [path]).rdd.getNumPartitions() > 8
    rows, rejects = readers.read_csv_parts(spark, [path], SCHEMA.names, SCHEMA)
    assert sorted((r.id, r.text) for r in rows.collect()) == want and rejects.count() == 0


@pytest.mark.parametrize("beside", ["id,text\n", "id,text\n" + "7000,plain\n" * 300, "text,id\n" + '"a\nb",7000\n' * 300])
def test_quoted_line_breaks_beside_other_files(spark, tmp_dir, small_splits, beside):
    # Splits of a size that depends on the sum of the files of a scan.
    spark.conf.set(SPLIT, str(1 << 20))
    want, text = quoted_csv(400, 3)
    paths = [write_text(os.path.join(tmp_dir, n), t) for n, t in (("q.csv", "id,text\n" + text), ("p.csv", beside))]
    rows, rejects = readers.read_csv_parts(spark, paths, SCHEMA.names, SCHEMA)
    other = [(7000, "a\nb" if "a" in beside.split(",", 2)[1] else "plain")] * beside.count("7000")
    assert sorted((r.id, r.text) for r in rows.collect()) == sorted(want + other) and rejects.count() == 0


@pytest.mark.parametrize("quoted", [True, False])
def test_blank_lines_as_pandas_reads_them(spark, tmp_dir, quoted):
    text = "\n\nid,text\n\n1,a\n   \n2,b\n\n" + ('3,"c\nd"\n' if quoted else "3,c\n")
    path = write_text(os.path.join(tmp_dir, "b.csv"), text)
    rows, rejects = readers.read_csv_parts(spark, [path], SCHEMA.names, SCHEMA)
    want = pd.read_csv(path)
    assert sorted((r.id, r.text) for r in rows.collect()) == list(want.itertuples(index=False, name=None)) and rejects.count() == 0


def test_a_source_that_cannot_be_read_leaves_a_row_per_file(spark, tmp_dir, monkeypatch):
    path = write_text(os.path.join(tmp_dir, "l.json"), '{"level": "x"}')

    def broken(*args, **kw):
        raise OSError("gone")

    monkeypatch.setattr(readers, "read_json_parts", broken)
    rejects = {}
    config = {"sources": {"logs": {"enabled": True, "format": "json", "files": [path]}}}
    out = readers.extract_sources(spark, config, {"logs": S.LOGS}, rejects)
    assert out["logs"].count() == 0 and [(r.file.endswith("l.json"), r.record) for r in rejects["logs"].collect()] == [(True, "unread: gone")]
