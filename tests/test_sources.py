"""Scans of lines and objects, and the committed outputs."""

import json

import pytest
from pyspark.sql import functions as F

from patchloom.operators import triage
from patchloom.sinks import files
from patchloom.sources import advisories, jsonl


def test_bad_lines_are_error_rows_with_physical_numbers(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('﻿{"a": 1}\n\n[{"a": 2}]\n{"a": 3} trailing\n{"a": 4}\n', encoding="utf-8")
    rows = {r.source_line: r for r in jsonl.read_tolerant(spark, str(path), "a int").collect()}
    assert sorted(rows) == [1, 3, 4, 5] and rows[1].record.a == 1 and rows[5].error is None
    assert rows[3].error == "not an object" and rows[4].error == "JSONDecodeError"
    with pytest.raises(Exception):
        jsonl.read_strict(spark, str(path), "a int").collect()
    assert jsonl.read_strict(spark, str(tmp_path / "none"), "a int", missing_is_empty=True).count() == 0


def test_maps_lines_and_last_record(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"c1": "CWE-1", "c2": ["CWE-2", "CWE-3"]}))
    assert sorted(jsonl.read_map(spark, str(tmp_path / "m.json")).collect()) == [("c1", "CWE-1"), ("c2", "CWE-2"), ("c2", "CWE-3")]
    (tmp_path / "e.jsonl").write_text('{"file_change_id": 1, "p": "a"}\n{"file_change_id": 1, "p": "b"}\n')
    assert [tuple(r) for r in jsonl.read_enrichment(spark, str(tmp_path / "e.jsonl"), "file_change_id long, p string").collect()] == [("1", "b")]


def test_jsonl_keeps_nulls(spark, tmp_path):
    files.write_jsonl(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "o"), single_file=True)
    assert [json.loads(r.value) for r in spark.read.text(str(tmp_path / "o")).collect()] == [{"a": 1, "b": None}]


def test_candidates_and_links(spark):
    rows = [("G1", [("CWE-79",)], ["https://github.com/o/r/commit/" + "a" * 40]), ("G2", [("CWE-79",)], ["https://x.y"]), ("G3", [("CWE-1",)], [])]
    df = spark.createDataFrame(rows, "ghsa_id string, cwes array<struct<cwe_id:string>>, references array<string>")
    got = {r.ghsa_id: r.candidate_status for r in advisories.candidates(df, "CWE-79").collect()}
    assert got == {"G1": "READY_FOR_EXTRACTION", "G2": "NEEDS_FIX_COMMIT", "G3": "REJECTED_CWE_MISMATCH"}
    header = '<https://a/1>; rel="prev", <https://a/3>; rel="next"'
    assert spark.range(1).select(advisories.next_link(F.lit(header)).alias("n")).first().n == "https://a/3"


def test_answers(spark):
    said = spark.createDataFrame([('{"answer": "2"}',), ("{'answer':3}",), ("maybe",), (None,)], "s string")
    got = [r.r for r in said.select(triage.route(triage.answer(F.col("s"))).alias("r")).collect()]
    assert got == ["answer_2", "answer_3", "invalid", "invalid"]
