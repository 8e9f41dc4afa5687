"""Behaviour of the chunk, dataset, recovery, extraction and split plans, and of
the command line, on small literals."""

import json

import pytest
from pyspark.sql import functions as F

from patchloom import cli
from patchloom.functions.tokens import approx_offsets
from patchloom.operators import findings, methods, numbering, summaries
from patchloom.plans import chunking, curation, dataset, recovery, registry_code, splitting
from patchloom.sources import caches, jsonl

URL = "https://github.com/o/r/commit/" + "a" * 40
GOOD, FIX = "def f(x):\n    return x\n", "def f(x):\n    return int(x)\n"
ROW = {"commit": URL, "cwe": "CWE-79", "function_name": "f", "code_before": GOOD, "code_after": FIX, "programming_language": "Python", "file_path": "src/a.py"}


def filtered(spark, tmp_path, tokens):
    path = tmp_path / "rows.jsonl"
    path.write_text("\n".join([json.dumps(ROW), "", "{bad", json.dumps(ROW | {"file_path": "src/b.py"}), json.dumps(ROW | {"function_name": None, "method_name": "g", "code_before": "x = 1\n", "programming_language": "C", "file_path": "b.c"})]))
    none = [spark.createDataFrame([], s) for s in ("key string, value string", "file_change_id string, file_path string")]
    rows = curation.filter_file(spark, str(path), cli.FUNCTION, none[0], spark.createDataFrame([(URL,)], "value string"), none[1], tokens)
    return {r.source_line: r for r in rows.collect()}


def test_every_line_is_emitted_and_estimates_are_never_accepted(spark, tmp_path):
    exact = filtered(spark, tmp_path, (F.lit(9), F.lit(9)))
    assert {i: r.status for i, r in exact.items()} == {1: "ACCEPTED", 3: "REJECTED", 4: "REJECTED", 5: "REJECTED"}
    assert exact[3].reason_codes == ["rejected_invalid_json"] and exact[3].sample_id == "INVALID_000003" and exact[3].code_before is None
    assert exact[4].reason_codes == ["rejected_duplicate"] and "rejected_non_python" in exact[5].reason_codes
    assert [r.sample_id for i, r in sorted(exact.items()) if i != 3] == ["CWE_79_000001", "CWE_79_000002", "CWE_79_000003"]
    for tokens in (None, (F.lit(9), F.lit(None).cast("int"))):
        assert filtered(spark, tmp_path, tokens)[1].status == "MANUAL_REVIEW"


def test_chunks_keep_the_patch_and_both_sides(spark):
    before = "".join(f"a{i} b{i}\n" for i in range(30))
    rows = [("s1", ["CWE-79"], [chunking.LONG], before, before.replace("a15 b15", "c15 d15")), ("s2", ["CWE-79"], [chunking.LONG, "other"], before, before + "x"), ("s3", ["CWE-79"], [chunking.LONG], before, " "), ("s4", [], [chunking.LONG], before, before)]
    df = spark.createDataFrame(rows, "sample_id string, cwes array<string>, reason_codes array<string>, code_before string, code_after string")
    made = chunking.chunk_records(df, approx_offsets, "t", max_tokens=20, overlap=5)
    chunks = made.chunks.collect()
    assert all(c.chunk_token_count <= 20 and len(c.chunk_code) == c.char_end - c.char_start for c in chunks) and {c.parent_sample_id for c in chunks} == {"s1"}
    assert {c.variant for c in chunks if c.eligible_for_training} == {"before", "after"} and all("15" in c.chunk_code for c in chunks if c.eligible_for_training)
    assert {r.sample_id: r.chunking_reason_codes[0] for r in made.remaining.collect()} == {"s2": "manual_review_chunk_other_reasons", "s3": "manual_review_chunk_missing_pair", "s4": "manual_review_chunk_patch_not_found"}
    with pytest.raises(ValueError):
        chunking.chunk_records(df, approx_offsets, "t", max_tokens=20, overlap=18)


def test_opposite_labels_of_one_code_remove_both(spark):
    base = dict(pair_id="p", source_dataset="d", repository="o/r", commit_id="c", file_path="a.py", function_name="f", cwes=["CWE-79"], labels=["XSS"], tokenizer="t", token_count_before=5, token_count_after=6)
    rows = [base | dict(sample_id="s1", source_line=1, code_before="same", code_after="same"), base | dict(sample_id="s2", source_line=2, code_before="b", code_after="c"), base | dict(sample_id="s3", source_line=3, code_before="b", code_after=None), base | dict(sample_id="s4", source_line=4, code_before="z", code_after="y", file_path="a.c")]
    built = dataset.build([spark.createDataFrame(rows)], [])
    ids = {n: sorted(r.model_sample_id for r in f.collect()) for n, f in built._asdict().items()}
    assert ids == {"kept": ["s2:after", "s2:before"], "duplicates": ["s3:before"], "conflicts": ["s1:after", "s1:before"], "invalid": ["s4:after", "s4:before"]}
    assert built.duplicates.first().duplicate_of == "s2:before"


def test_paths_resolve_to_the_production_file_only(spark):
    functions = spark.createDataFrame([(1, URL, "1", "f", GOOD, FIX, "Python"), (2, URL, "2", "g", "def g():\n    return 7\n", "def g():\n    return 8\n", "Python")], "source_line int, commit string, file_change_id string, function_name string, code_before string, code_after string, programming_language string")
    hunk = "@@ -1,2 +1,2 @@\n def f(x):\n-    return x\n+    return int(x)\n"
    diff = f"diff --git a/src/a.py b/src/a.py\n--- a/src/a.py\n+++ b/src/a.py\n{hunk}diff --git a/t.txt b/t.txt\n--- a/t.txt\n+++ b/t.txt\n{hunk}"
    cwe_map = spark.createDataFrame([(URL, "CWE-1", 0), (URL, "CWE-79", 1)], "key string, value string, ordinal int")
    found = recovery.recover(functions, cwe_map, spark.createDataFrame([("o/r@" + "a" * 40, diff)], "join_key string, diff_text string"))
    assert [(r.file_change_id, r.file_path, r.cwes) for r in found.resolved.collect()] == [("1", "src/a.py", ["CWE-79"])]
    assert [(r.file_change_id, r.reason) for r in found.unresolved.collect()] == [("2", "no_code_match")]
    assert {r.metric: r.value for r in found.counters.collect()}["resolved_groups"] == 1


def samples(spark, cwe="CWE-22"):
    rows = [(f"{c}-{k}:{v}", "O/R", f"{c}{k}", "a.py", "f", "code", v, v == "before", [c], 5, "t") for c in (cwe, "CWE-78") for k in range(4) for v in ("before", "after")]
    return spark.createDataFrame(rows, "model_sample_id string, repository string, commit_id string, file_path string, function_name string, code string, variant string, is_vulnerable boolean, cwes array<string>, token_count int, tokenizer string")


def test_commits_stay_in_one_split_and_bad_rows_fail(spark):
    labels = ("SAFE", "CWE-22", "CWE-78")
    made = splitting.split_samples(samples(spark), labels=labels)
    splitting.check_split(made.rows, labels)
    assert made.rows.groupBy("split_group_id").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    assert splitting.split_samples(samples(spark, "CWE-798"), labels=labels).excluded.count() == 8
    for bad in ({"file_path": F.lit("a.c")}, {"token_count": F.lit(900)}, {"code": F.lit("")}):
        with pytest.raises(Exception):
            splitting.split_samples(samples(spark).withColumns(bad), labels=labels).rows.collect()
    with pytest.raises(ValueError):
        splitting.check_split(made.rows, (*labels, "CWE-89"))


def test_command_line(spark, tmp_path):
    labels = [c for c in splitting.LABELS if c != "SAFE"]
    rows = [json.dumps(dict(model_sample_id=f"{c}-{k}:{v}", repository="o/r", commit_id=f"{c}{k}", file_path="a.py", function_name="f", code="x", variant=v, is_vulnerable=v == "before", cwes=[c], token_count=5, tokenizer="t")) for c in labels for k in range(4) for v in ("before", "after")]
    (tmp_path / "in.jsonl").write_text("\n".join(rows))
    out = tmp_path / "out"
    assert cli.main(["split", "--input", str(tmp_path / "in.jsonl"), "--output-dir", str(out)], spark) == 0
    assert json.loads((out / "label_map.json").read_text()) == splitting.label_map()
    assert (out / "split_summary.csv").read_bytes().startswith("﻿split,label".encode()) and spark.read.text(str(out / "samples")).count() == len(rows)
    assert cli.main(["split", "--input", str(tmp_path / "none.jsonl"), "--output-dir", str(out)], spark) == 2


def test_numbers_do_not_depend_on_buckets(spark, monkeypatch):
    monkeypatch.setattr(numbering, "WIDTH", 10)
    df = spark.range(0, 200, 3).withColumn("key", F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 2))
    got = numbering.rank_within(df, ["key"], [F.col("id")], numbering.by_number("id"), "n").collect()
    for key in {r.key for r in got}:
        mine = sorted((r.id, r.n) for r in got if r.key == key)
        assert [n for _, n in mine] == list(range(1, len(mine) + 1))
    assert [r.n for r in numbering.sequence(df, "id", "n").orderBy("id").collect()] == list(range(1, df.count() + 1))


def test_line_numbers_across_blocks(spark, tmp_path):
    text = "".join(f'{{"a": {i}}}\n' + "\n" * (i % 3) for i in range(400))
    (tmp_path / "x.jsonl").write_text("﻿" + text, encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        rows = jsonl.read_strict(spark, str(tmp_path / "x.jsonl"), "a int").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [n for n, line in enumerate(text.split("\n"), 1) if line]
    assert [r.source_line for r in sorted(rows, key=lambda r: r.a)] == want


def test_listing_ends_and_the_last_payload_holds(spark):
    pages = {"1": ('[{"k": "a", "v": 1}, {"k": "b", "v": 2}]', "2"), "2": ('[{"k": "a", "v": 3}]', "1")}
    assert sorted(map(tuple, caches.listing(spark, "1", pages.__getitem__, "k string, v int", "k").collect())) == [("a", 3), ("b", 2)]
    requests, cache = spark.createDataFrame([("a",), ("b",), ("c",)], "k string"), spark.createDataFrame([("a", "held")], "k string, payload string")

    def fetch(row):
        if row["k"] == "c":
            raise OSError("no")
        return row["k"] + "!"

    got = {r.k: (r.payload, r.error) for r in caches.through_cache(requests, cache, ["k"], fetch).collect()}
    assert got == {"a": ("held", None), "b": ("b!", None), "c": (None, "OSError: no")}


def test_missing_lookups_fail_and_many_rules_are_joined(spark, monkeypatch):
    rows, table = spark.createDataFrame([("a",), ("z",)], "k string"), spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(Exception):
        findings.looked_up(rows, table, "k", "v").collect()
    rules = spark.createDataFrame([(1, "ab", ["c"]), (2, "b", ["d"])], "ordinal int, rule string, cwes array<string>")
    texts = spark.createDataFrame([("xaby",), ("b",), ("q",)], "t string")
    few = {r.t: [h.ordinal for h in r._hits] for r in findings.contained_rules(texts, "t", rules).collect()}
    monkeypatch.setattr(findings, "ARRAY_RULES", 1)
    assert few == {r.t: [h.ordinal for h in r._hits] for r in findings.contained_rules(texts, "t", rules).collect()} == {"xaby": [1, 2], "b": [2], "q": []}


def test_references_and_fixed_code(spark):
    df = spark.createDataFrame([(["https://github.com/o/r/commit/1", "https://x"], "https://github.com/o/r", "")], "refs array<string>, repo string, code_after string")
    assert df.select(methods.links_of_repository(F.col("refs"), F.col("repo")).alias("x")).first().x == ["https://github.com/o/r/commit/1"]
    assert methods.with_fixed_code(df).count() == 0


@pytest.mark.parametrize("name", ["chunk_remaining", "chunk_plan", "chunk_summary"])
def test_records_are_spread_and_parsed_once(spark, name):
    made = getattr(registry_code, name)(spark, "/root/testdata/sf0.001")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("[patch_regions(") == 1 and "REPARTITION_BY_NUM" in plan
    # no text is built again where a filter reads it, nor in the loops over chunks
    assert plan.count("format_string") <= 4


def test_a_total_counts_a_row_once_and_stands_alone_without_rows(spark):
    rows = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "TOTAL"]), (4, None), (8, [None])], "n int, keys array<string>")
    counts = {"n": F.coalesce(F.sum("n"), F.lit(0)), "rows": F.count(F.lit(1))}
    got = {(r.key, r.n, r.rows) for r in summaries.with_total(rows, "key", F.col("keys"), counts).collect()}
    assert got == {("a", 3, 2), ("b", 1, 1), ("TOTAL", 2, 1), (None, 8, 1), ("TOTAL", 15, 4)}
    assert [tuple(r) for r in summaries.with_total(rows.where("n > 9"), "key", F.col("keys"), counts).collect()] == [("TOTAL", 0, 0)]
