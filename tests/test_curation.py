"""Behaviour of the filter plans on small literals."""

import collections

from pyspark.sql import functions as F

from patchloom.functions import keys as K
from patchloom.functions import pycode
from patchloom.functions.diffs import line_numbers, line_sets, regions
from patchloom.operators import chunks, dedup, joins, splits
from patchloom.plans import curation
from patchloom.plans.extraction import changed_functions

URL = "https://github.com/o/r/commit/" + "a" * 40
GOOD, FIX = "def f(x):\n    return x\n", "def f(x):\n    return int(x)\n"
PRIMARY = "source_line int, commit string, cwe string, function_name string, code_before string, code_after string, programming_language string, file_change_id long, file_path string"


def primary(spark, rows):
    df = spark.createDataFrame(rows, PRIMARY)
    cwe_map = spark.createDataFrame([(URL, "CWE-79")], "key string, value string")
    index = spark.createDataFrame([(URL,)], "value string")
    metadata = spark.createDataFrame([(4, "lib/z.py")], "file_change_id long, file_path string")
    prepared = curation.prepare_primary(df, cwe_map, index, metadata, tokens=(F.lit(1), F.lit(1)))
    return {r.source_line: r for r in curation.filter_primary(prepared).collect()}


def test_accepts_one_and_rejects_duplicate_and_other_language(spark):
    got = primary(spark, [(1, URL, "CWE-79", "f", GOOD, FIX, "Python", 1, "src/a.py"), (2, URL, "CWE-79", "f", GOOD, FIX, "Python", 2, "src/b.py"), (3, URL, "CWE-79", "g", "int x;", "int y;", "JavaScript", 3, "src/b.js")])
    assert [got[i].status for i in (1, 2, 3)] == ["ACCEPTED", "REJECTED", "REJECTED"]
    assert got[1].sample_id == "CWE_79_000001" and [s.source_line for s in got[1].duplicate_sources] == [2]
    assert got[3].reason_codes == ["rejected_non_python"]


def test_path_comes_from_enrichment_and_unchanged_is_rejected(spark):
    got = primary(spark, [(1, URL, None, "f", GOOD, GOOD, "Python", 4, None)])
    assert got[1].path == "lib/z.py" and got[1].cwes == ["CWE-79"] and got[1].reason_codes == ["rejected_unchanged_pair"]


def test_repeated_commit_url(spark):
    url = "https://github.com/o/r/pull/2/commits/aaaaaaa1 https://github.com/o/r/pull/2/commits/bbbbbbb2"
    row = spark.range(1).select(K.commit_parts(F.lit(url)).alias("c"), K.normalize_cwes(F.lit("cwe_0798, CWE-79 CWE 22 CWE-79")).alias("w")).first()
    assert (row.c.repository, row.c.commit_id) == ("o/r", "bbbbbbb2") and row.w == ["CWE-22", "CWE-79", "CWE-798"]


EXTERNAL = "source_line int, schema_version string, sample_id string, source_dataset string, source_dataset_url string, source_record_id string, repository string, commit_id string, commit_url string, file_path string, function_name string, language string, cwes array<string>, code_before string, code_after string"


def test_credential_evidence(spark):
    common = ("1.0", "s", "d", "u", "r", "o/r", "a" * 40, URL, "a.py")
    removed = (1, *common, "f", "Python", ["CWE-798"], 'def f():\n    password = "hunter22"\n', 'def f():\n    password = os.environ["P"]\n')
    without = (2, *common, "g", "Python", ["CWE-798"], "def g():\n    return 1\n", "def g():\n    return 2\n")
    left = (3, *common, "h", "Python", ["CWE-798"], 'def h():\n    password = "hunter22"\n    api_key = "abcdef"\n', 'def h():\n    password = p()\n    api_key = "abcdef"\n')
    rows = curation.filter_external(spark.createDataFrame([removed, without, left], EXTERNAL), tokens=(F.lit(9), F.lit(9))).collect()
    got = {r.source_line: (r.status, r.reason_codes) for r in rows}
    assert got[1][0] == "ACCEPTED"
    assert got[2] == ("MANUAL_REVIEW", ["manual_review_cwe798_semantic_evidence"])
    assert got[3] == ("MANUAL_REVIEW", ["manual_review_cwe798_residual_hardcoded_credential"])


def test_environment_default_and_alias_are_credentials():
    tree, _ = pycode.parse('import os\n_D = "devsecret"\nJWT_SECRET = os.environ.get("J", _D)\nuser = "bob"\n')
    assert pycode.credentials(tree) == [("jwt_secret", "devsecret")]


def test_nested_function_names_and_module_slice():
    spans = pycode.function_spans("class App:\n    @d\n    def build(self):\n        pass\n")
    assert [(s[0], s[1], s[2]) for s in spans] == [("App.build", 2, 4)]
    source = "def helper():\n    return 1\n\nother = 2\nA = helper()\nif other:\n    A = 3\n"
    name, start, end, _, parts = pycode.module_slice(source, "A")
    assert (name, start, end) == ("A", 1, 7) and parts == [[1, 2], [4, 4], [5, 5], [6, 7]][:1] + [[5, 5], [6, 7]]


DIFF = """diff --git a/src/a.py b/src/a.py
--- a/src/a.py
+++ b/src/a.py
@@ -1,3 +1,3 @@
 def f(x):
-    return x
+    return int(x)
 # end
diff --git a/tests/t.py b/tests/t.py
--- a/tests/t.py
+++ b/tests/t.py
@@ -0,0 +1 @@
+assert f(1)
"""


def test_diff_parsers():
    first, second = line_sets(DIFF)
    assert (first["deleted"], first["added"], first["context"]) == (["return x"], ["return int(x)"], ["def f(x):"])
    assert second["new_path"] == "tests/t.py"
    numbers = line_numbers(DIFF)
    assert (numbers[0]["old_lines"], numbers[0]["new_lines"]) == ([2], [2]) and (numbers[1]["old_lines"], numbers[1]["new_lines"]) == ([], [1])


def test_regions():
    before, after = regions("a\nb\nc\n", "a\nB\nc\n")
    assert len(before) == len(after) == 1 and before[0]["line_start"] == after[0]["line_start"] == 2


def test_changed_functions(spark):
    diffs = spark.createDataFrame([("c1", DIFF)], "commit string, diff_text string")
    sources = spark.createDataFrame([("c1", "src/a.py", GOOD, FIX)], "commit string, path string, before string, after string")
    rows = changed_functions(diffs, sources).collect()
    assert [(r.path, r.qname) for r in rows] == [("src/a.py", "f")]


def test_windows_and_dominance(spark):
    words = F.array(*[F.lit(str(i)) for i in range(20)])
    got = spark.range(1).select(chunks.windows(words, 10, 5).alias("w")).first().w
    assert [(w.token_start, w.token_end) for w in got] == [(0, 10), (5, 15), (10, 20)]
    rows = [(1, 1, 0, 50, [(5, 9), (20, 30)]), (1, 2, 10, 60, [(5, 9), (20, 30)])]
    df = spark.createDataFrame(rows, "parent int, chunk_index int, char_start int, char_end int, regions array<struct<char_start:int,char_end:int>>")
    assert [r.chunk_index for r in chunks.prune_dominated(df, ["parent"], "regions").collect()] == [1]


def test_components_do_not_depend_on_order(spark):
    rows = [(i, f"k{i // 2}") for i in range(20)] + [(i, f"l{(i + 1) // 2}") for i in range(1, 9)] + [(30, None)]
    df = spark.createDataFrame(rows, "row int, key string")
    one = dict(dedup.components(df, "row", "key").collect())
    two = dict(dedup.components(df.repartition(3), "row", "key").collect())
    assert one == two and one[9] == 0 and one[30] == 30 and one[12] == 12


def test_groups_stay_in_one_split(spark):
    rows = [(g, g % 2) for g in range(40)]
    split = splits.allocate_groups(spark.createDataFrame(rows, "g int, label int"), "label", "g")
    assert splits.split_violations(split.withColumn("label", F.col("label").cast("string")), "g", "label", ["0", "1"]).count() == 0
    assert split.groupBy("g").count().where("count > 1").count() == 0


def test_shared_counts_are_all_pairs_and_a_large_group_is_dealt_over_tasks(spark):
    groups = {"common": range(60), "even": range(0, 60, 2), "two": [3, 50], "lone": [7]}
    rows = [(i, "s", g) for g, ids in groups.items() for i in ids] + [(None, "s", "common"), (8, None, "common"), (61, "s", None)]
    df = spark.createDataFrame(rows, "id int, source string, line string")
    want = {(a, b): sum(a in ids and b in ids for ids in groups.values()) for a in range(60) for b in range(a + 1, 60)}
    for most in (joins.TASK_PAIRS, 100):
        made = joins.shared_counts(df, "id", ["source", "line"], "other", most)
        got = made.withColumn("task", F.spark_partition_id()).collect()
        assert {(r.id, r.other): r.shared for r in got} == want and len(got) == len(want)
        tasks = collections.Counter(r.task for r in got)
        assert len(tasks) > 1 and (most > 100 or max(tasks.values()) < 800)
