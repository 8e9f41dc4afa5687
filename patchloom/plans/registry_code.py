"""Registered queries of the code plans, over texts that the tables' keys give.

Both sides build the same sources, diffs and facts from keys; the SQL then tells
by arithmetic what the plans have to find.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from patchloom.functions import diffs as D
from patchloom.functions import keys as K
from patchloom.functions import pycode as P
from patchloom.functions.tokens import approx_offsets
from patchloom.operators import joins, rules
from patchloom.plans import chunking, dataset, extraction, recovery, splitting
from patchloom.plans.registry import query, t

_FACTS = r"""CASE n_nationkey % 5 WHEN 0 THEN concat('def f', n_nationkey, '(x):\n    return x\n') WHEN 1 THEN concat('x = ', n_nationkey, '\n') WHEN 2 THEN 'def f(:\n'
  WHEN 3 THEN concat('    def g():\n        password = "secret', n_nationkey, '"\n') ELSE concat('import os\nD = "devsecret', n_nationkey, '"\nAPI_KEY = os.environ.get("A", D)\n') END"""


@query("""
SELECT n_nationkey, m <> 2 AS valid, m IN (0, 3) AS has_function, CASE WHEN m = 2 THEN 'SyntaxError' ELSE '' END AS error, true AS same_without_comments,
  CASE m WHEN 3 THEN 'password=secret' || n_nationkey WHEN 4 THEN 'api_key=devsecret' || n_nationkey ELSE '' END AS credentials FROM (SELECT n_nationkey, n_nationkey % 5 AS m FROM nation)""")
def python_facts(spark, d):
    rows = t(spark, d, "nation").select("n_nationkey", F.expr(_FACTS).alias("code"))
    facts = rows.select("n_nationkey", P.code_facts("code").alias("f"), P.code_facts(F.concat("code", F.lit("# note\n"))).alias("g"))
    named = F.array_join(F.transform("f.credentials", lambda c: F.concat(c["name"], F.lit("="), c["literal"])), ";")
    return facts.select("n_nationkey", "f.valid", "f.has_function", "f.error", (F.col("f.normalized") == F.col("g.normalized")).alias("same_without_comments"), named.alias("credentials"))


@query(r"""
SELECT n_nationkey, x.q AS qname, x.a AS start_line, x.b AS end_line, sha256(x.c) AS code_sha256 FROM (SELECT n_nationkey, unnest([
  {'q': 'C' || n_nationkey || '.m', 'a': 2, 'b': 4, 'c': '    @d' || chr(10) || '    def m(self):' || chr(10) || '        return ' || n_nationkey || chr(10)},
  {'q': 'f' || n_nationkey, 'a': 7, 'b': 10, 'c': 'def f' || n_nationkey || '(x):' || chr(10) || '    def inner():' || chr(10) || '        return x' || chr(10) || '    return inner' || chr(10)},
  {'q': 'f' || n_nationkey || '.inner', 'a': 8, 'b': 9, 'c': '    def inner():' || chr(10) || '        return x' || chr(10)}]) AS x FROM nation)""")
def function_spans(spark, d):
    source = F.expr(r"concat('class C', n_nationkey, ':\n    @d\n    def m(self):\n        return ', n_nationkey, '\n\n\ndef f', n_nationkey, '(x):\n    def inner():\n        return x\n    return inner\n')")
    spans = t(spark, d, "nation").select("n_nationkey", F.explode(P.spans_of(source)).alias("s"))
    return spans.select("n_nationkey", F.col("s.qname").alias("qname"), F.col("s.start").alias("start_line"), F.col("s.end").alias("end_line"), F.sha2("s.code", 256).alias("code_sha256"))


@query(r"""
SELECT n_nationkey, 'A' AS qname, 1 AS start_line, 7 AS end_line, '1-2,5-5,6-7' AS spans, true AS binds_a, false AS binds_b,
  sha256('def helper' || n_nationkey || '():' || chr(10) || '    return ' || n_nationkey || chr(10) || chr(10) || 'A = helper' || n_nationkey || '()' || chr(10) || chr(10) || 'if other:' || chr(10) || '    A = 3') AS code_sha256 FROM nation""")
def module_slice(spark, d):
    source = F.expr(r"concat('def helper', n_nationkey, '():\n    return ', n_nationkey, '\n\nother = \"B = 1\"\nA = helper', n_nationkey, '()\nif other:\n    A = 3\n')")
    cut = t(spark, d, "nation").select("n_nationkey", P.slice_of(source, F.lit("A")).alias("s"), P.binds(source, F.lit("A")).alias("binds_a"), P.binds(source, F.lit("B")).alias("binds_b"))
    spans = F.array_join(F.transform("s.spans", lambda x: F.concat_ws("-", x[0].cast("string"), x[1].cast("string"))), ",")
    return cut.select("n_nationkey", "s.qname", F.col("s.start").alias("start_line"), F.col("s.end").alias("end_line"), spans.alias("spans"), "binds_a", "binds_b", F.sha2("s.code", 256).alias("code_sha256"))


_DIFF = r"""concat('diff --git a/src/m', s_suppkey, '.py b/src/m', s_suppkey, '.py\n--- a/src/m', s_suppkey, '.py\n+++ b/src/m', s_suppkey, '.py\n@@ -', 1 + s_suppkey % 50, ',3 +', 1 + s_suppkey % 50,
  ',3 @@\n def f(x):\n-    return  ', s_suppkey, '\n+    return ', s_suppkey, ' + 1\n # end\ndiff --git "a/d \\303\\251.txt" "b/d \\303\\251.txt"\n--- /dev/null\n+++ "b/d \\303\\251.txt"\n@@ -0,0 +1 @@\n+new\n')"""


@query("""
WITH k AS (SELECT s_suppkey AS k, CAST(2 + s_suppkey % 50 AS VARCHAR) AS line FROM supplier)
SELECT k AS s_suppkey, 'src/m' || k || '.py' AS old_path, 'src/m' || k || '.py' AS new_path, 'return ' || k AS deleted, 'return ' || k || ' + 1' AS added, 'def f(x):' AS context, line AS old_lines, line AS new_lines FROM k
UNION ALL SELECT k, NULL, 'd é.txt', '', 'new', '', '', '1' FROM k""")
def unified_diff_files(spark, d):
    rows = t(spark, d, "supplier").select("s_suppkey", F.expr(_DIFF).alias("diff"))
    sets = rows.select("s_suppkey", F.explode(D.diff_lines("diff")).alias("f")).select("s_suppkey", "f.old_path", "f.new_path", *[F.array_join(f"f.{c}", ";").alias(c) for c in ("deleted", "added", "context")])
    numbers = rows.select("s_suppkey", F.explode(D.diff_numbers("diff")).alias("f")).select("s_suppkey", "f.new_path", *[F.array_join(F.col(f"f.{c}").cast("array<string>"), ",").alias(c) for c in ("old_lines", "new_lines")])
    return sets.join(numbers, ["s_suppkey", "new_path"])


@query("""
SELECT s_suppkey, 2 AS line_start, 2 AS line_end, 2 AS char_start, CAST(4 + length(CAST(s_suppkey AS VARCHAR)) AS INTEGER) AS char_end, 1 AS regions_after,
  s_suppkey % 2 = 0 AS insertion, CASE WHEN s_suppkey % 2 = 0 THEN 2 ELSE 4 + length(CAST(s_suppkey AS VARCHAR)) END AS other_end FROM supplier""")
def line_diff_regions(spark, d):
    before = F.expr(r"concat('a\nb', s_suppkey, '\nc\n')")
    after = F.expr(r"CASE WHEN s_suppkey % 2 = 0 THEN 'a\nc\n' ELSE concat('a\nB', s_suppkey, '\nc\n') END")
    rows = t(spark, d, "supplier").select("s_suppkey", D.patch_regions(before, after).alias("r"))
    one, other = F.get("r.before", F.lit(0)), F.get("r.after", F.lit(0))
    return rows.select("s_suppkey", *[one[c].alias(c) for c in ("line_start", "line_end", "char_start", "char_end")], F.size("r.after").alias("regions_after"), (other["char_start"] == other["char_end"]).alias("insertion"), other["char_end"].cast("long").alias("other_end"))


_K = "p_partkey"
_BASE = f"""WITH b AS (SELECT {_K} AS k, {_K} % 7 AS cwe, ({_K} // 7) % 6 AS bk, ({_K} // 42) % 4 AS ak, ({_K} // 3) % 4 AS lk, {_K} % 5 <> 0 AS bv, {_K} % 11 <> 0 AS bf, {_K} % 13 <> 0 AS av, {_K} % 17 <> 0 AS af,
  {_K} % 19 = 0 AS eq, {_K} % 23 = 0 AS nofn, {_K} % 29 = 0 AS norepo, {_K} % 4 AS pk, {_K} % 31 <> 0 AS idx, {_K} % 2 = 0 AS ex, {_K} % 700 AS tb, ({_K} * 3) % 700 AS ta FROM part),
f AS (SELECT *, bk > 2 AS full, bk <> 0 AND bk < 2 AS blank, ak IN (1, 2) AS after, lk IN (0, 2) AS python FROM b)"""


@query(_BASE + """,
r AS (SELECT k, list_filter([
  CASE WHEN cwe = 1 THEN '1manual_review_label_conflict' END, CASE WHEN cwe = 2 THEN '2rejected_missing_cwe' END, CASE WHEN cwe = 3 THEN '1manual_review_related_cwe' END,
  CASE WHEN cwe = 4 THEN '2rejected_non_target_cwe' END, CASE WHEN cwe = 1 THEN '1manual_review_multiple_cwes' END, CASE WHEN bk = 0 THEN '2rejected_missing_vulnerable_code' END,
  CASE WHEN bk = 1 THEN '2rejected_empty_code' END, CASE WHEN bk = 2 THEN '2rejected_binary_code' END, CASE WHEN lk = 0 THEN '1manual_review_language_conflict' END,
  CASE WHEN lk = 1 THEN '1manual_review_language_unknown' END, CASE WHEN lk = 3 THEN '2rejected_non_python' END,
  CASE WHEN python AND bk > 1 AND (NOT bv OR (after AND NOT av)) THEN '1manual_review_ast_error' END,
  CASE WHEN python AND bk > 1 AND ((bv AND NOT bf) OR (after AND av AND NOT af)) THEN '1manual_review_missing_context' END,
  CASE WHEN nofn THEN '2rejected_missing_function_identifier' END, CASE WHEN norepo OR pk = 0 THEN '1manual_review_missing_provenance' END, CASE WHEN NOT idx THEN '1manual_review_commit_not_indexed' END,
  CASE WHEN pk = 1 THEN '1manual_review_test_or_generated_code' END, CASE WHEN ak = 1 AND bk > 2 THEN '2rejected_unchanged_pair' END,
  CASE WHEN ((ak = 2 AND bk <> 0) OR (ak = 1 AND bk IN (1, 2))) AND eq THEN '1manual_review_nonsemantic_change' END,
  CASE WHEN bk > 1 AND NOT ex THEN '1manual_review_tokenizer_unavailable' END, CASE WHEN tb > 512 OR (after AND ta > 512) THEN '1manual_review_long_code' END], lambda x: x IS NOT NULL) AS x FROM f)
SELECT k AS p_partkey, CASE WHEN len(x) = 0 THEN 'ACCEPTED' WHEN list_max(list_transform(x, lambda y: y[1])) = '2' THEN 'REJECTED' ELSE 'MANUAL_REVIEW' END AS status,
  CASE WHEN len(x) = 0 THEN 'accepted_exact_target_cwe' ELSE array_to_string(list_transform(x, lambda y: y[2:]), ',') END AS reason_codes FROM r""")
def primary_rule_ladder(spark, d):
    k = F.col(_K)

    def pick(number, *values):
        return F.array(*[F.array(*map(F.lit, v)).cast("array<string>") if isinstance(v, tuple) else F.lit(v).cast("string") for v in values])[number.cast("int")]

    cwe, bk, ak, lk = k % 7, F.floor(k / 7) % 6, F.floor(k / 42) % 4, F.floor(k / 3) % 4
    embedded = pick(cwe, ("CWE-79",), ("CWE-79",), (), (), (), (), ("CWE-78",))
    mapped = pick(cwe, (), ("CWE-89",), (), ("CWE-23",), ("CWE-999",), ("CWE-22",), ("CWE-78",))
    norm = F.when(k % 19 == 0, "n1")
    facts = t(spark, d, "part").select(
        _K, embedded.alias("cwes_embedded"), mapped.alias("cwes_mapped"), F.array_union(embedded, mapped).alias("cwes"),
        pick(bk, None, "   ", "x\x01y", "code", "code", "code").alias("code_before"), pick(ak, None, "code", "other", "").alias("code_after"),
        F.struct(lk.isin(0, 2).alias("is_python"), (lk == 0).alias("conflict"), (lk == 1).alias("unknown")).alias("language_is"),
        F.struct((k % 5 != 0).alias("valid"), (k % 11 != 0).alias("has_function"), F.coalesce(norm, F.lit("n2")).alias("normalized")).alias("before_is"),
        F.struct((k % 13 != 0).alias("valid"), (k % 17 != 0).alias("has_function"), F.coalesce(norm, F.lit("n3")).alias("normalized")).alias("after_is"),
        F.when(k % 23 != 0, "f").alias("function_name"), F.struct(F.when(k % 29 != 0, "o/r").alias("repository"), F.lit("abc1234").alias("commit_id"), F.lit("u").alias("raw")).alias("commit"),
        pick(k % 4, None, "tests/a.py", "src/a.py", "src/b.py").alias("path"), (k % 31 != 0).alias("indexed"), (k % 2 == 0).alias("tokens_exact"), (k % 700).alias("tokens_before"), (k * 3 % 700).alias("tokens_after"),
    )
    return rules.apply_rules(facts, rules.primary_rules()).select(_K, "status", F.array_join("reason_codes", ",").alias("reason_codes"))


# lines of two tokens and ten characters, one of them replaced; chunks of twenty tokens that share four
_CHUNKS = """
WITH c AS (SELECT c_custkey AS k, 5 + c_custkey % 40 AS n, c_custkey % (5 + c_custkey % 40) AS m, c_custkey % 11 <> 0 AS long_only FROM customer),
w AS (SELECT *, unnest(range(0, 1 + CAST(greatest(ceil((2 * n - 20) / 16.0), 0) AS BIGINT))) AS i FROM c WHERE long_only),
p AS (SELECT *, 16 * i AS a, least(16 * i + 20, 2 * n) AS b FROM w),
o AS (SELECT *, 5 * a AS cs, 5 * b - 1 AS ce, 10 * m AS low, 10 * m + 10 AS high FROM p),
q AS (SELECT *, cs < high AND ce > low AS patch, cs <= low AND ce >= high AS whole FROM o),
z AS (SELECT *, patch AND EXISTS (SELECT 1 FROM q y WHERE y.k = q.k AND y.i <> q.i AND y.whole AND (NOT q.whole OR y.i < q.i)) AS redundant FROM q)
"""


def _records(spark, d):
    k = F.col("c_custkey")
    n = 5 + k % 40
    line = F.lit("a%03d b%03d\n")

    def text(first: str):
        return F.array_join(F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), lambda i: F.when(i == k % n, F.format_string(first, i, i)).otherwise(F.format_string("a%03d b%03d\n", i, i))), "")

    del line
    reasons = F.when(k % 11 != 0, F.array(F.lit("manual_review_long_code"))).otherwise(F.array(F.lit("manual_review_long_code"), F.lit("manual_review_ast_error")))
    cwes = F.when(k % 3 == 0, F.array(F.lit("CWE-79"), F.lit("CWE-89"))).otherwise(F.array(F.concat(F.lit("CWE-"), (k % 3 + 20).cast("string"))))
    customers = joins.spread(t(spark, d, "customer").select("c_custkey"), "c_custkey")
    return customers.select("c_custkey", F.concat(F.lit("S"), k.cast("string")).alias("sample_id"), cwes.alias("cwes"), reasons.alias("reason_codes"), text("a%03d b%03d\n").alias("code_before"), text("c%03d d%03d\n").alias("code_after"))


def _chunked(spark, d):
    return chunking.chunk_records(_records(spark, d), approx_offsets, "words-and-signs", max_tokens=22, overlap=4)


@query(_CHUNKS + """
SELECT 'S' || k || '_' || upper(v) || '_CHUNK_' || lpad(CAST(i + 1 AS VARCHAR), 3, '0') AS chunk_id, v AS variant, CAST(a AS INTEGER) AS token_start, CAST(b AS INTEGER) AS token_end, CAST(cs AS INTEGER) AS char_start, CAST(ce AS INTEGER) AS char_end,
  CAST(b - a + 2 AS INTEGER) AS chunk_token_count, CAST(count(*) OVER (PARTITION BY k, v) AS INTEGER) AS chunk_count, patch AS contains_patch, patch AND NOT redundant AS eligible_for_training,
  CASE WHEN patch AND NOT redundant THEN 'MODEL_READY' ELSE 'CONTEXT_ONLY' END AS chunk_status,
  CASE WHEN NOT patch THEN 'context_chunk_without_patch' WHEN redundant THEN 'context_redundant_patch_chunk' ELSE 'accepted_chunk_contains_patch' END AS reason
FROM z, (VALUES ('before'), ('after')) AS s(v)""")
def chunk_plan(spark, d):
    made = _chunked(spark, d).chunks
    return made.select("chunk_id", "variant", "token_start", "token_end", "char_start", "char_end", "chunk_token_count", "chunk_count", "contains_patch", "eligible_for_training", "chunk_status", F.array_join("chunk_reason_codes", ",").alias("reason"))


@query("SELECT c_custkey, 'MANUAL_REVIEW' AS chunking_status, 'manual_review_chunk_other_reasons' AS reason FROM customer WHERE c_custkey % 11 = 0")
def chunk_remaining(spark, d):
    return _chunked(spark, d).remaining.select("c_custkey", "chunking_status", F.array_join("chunking_reason_codes", ",").alias("reason"))


@query(_CHUNKS + """,
e AS (SELECT k, n, long_only, unnest(CASE WHEN k % 3 = 0 THEN ['CWE-79', 'CWE-89', 'TOTAL'] ELSE ['CWE-' || (k % 3 + 20), 'TOTAL'] END) AS cwe FROM c),
g AS (SELECT k, 2 * count(*) AS made, 2 * count(*) FILTER (patch AND NOT redundant) AS trained, 2 * count(*) FILTER (NOT patch) AS bare, max(b - a + 2) AS longest FROM z GROUP BY k)
SELECT cwe, CAST(count(*) AS BIGINT) AS input_manual_samples, CAST(count(*) FILTER (long_only) AS BIGINT) AS eligible_long_only_functions, CAST(count(*) FILTER (long_only AND 2 * n + 2 <= 22) AS BIGINT) AS functions_within_limit,
  CAST(count(*) FILTER (long_only AND 2 * n + 2 > 22) AS BIGINT) AS long_functions, CAST(count(*) FILTER (long_only) AS BIGINT) AS chunked_model_ready_functions, CAST(coalesce(sum(made), 0) AS BIGINT) AS chunks_created, CAST(coalesce(sum(trained), 0) AS BIGINT) AS training_chunks,
  CAST(coalesce(sum(bare), 0) AS BIGINT) AS non_patch_chunks, CAST(count(*) FILTER (NOT long_only) AS BIGINT) AS remaining_manual_review, CAST(coalesce(max(longest), 0) AS BIGINT) AS max_chunk_token_count FROM e LEFT JOIN g USING (k) GROUP BY cwe""")
def chunk_summary(spark, d):
    return chunking.chunk_summary(_chunked(spark, d).outcomes)


def _built(spark, d):
    k = F.col("c_custkey")
    name = k.cast("string")
    accepted = t(spark, d, "customer").select(
        F.concat(F.lit("S"), name).alias("sample_id"), k.alias("source_line"), F.concat(F.lit("P"), (k % 400).cast("string")).alias("pair_id"), F.lit("D").alias("source_dataset"), F.lit("o/r").alias("repository"), F.lit("abc").alias("commit_id"),
        F.concat(F.lit("a"), name, F.when(k % 29 == 0, ".js").otherwise(".py")).alias("file_path"), F.lit("f").alias("function_name"), F.array(F.when(k % 13 == 0, "CWE-22").otherwise("CWE-79")).alias("cwes"), F.array(F.lit("L")).alias("labels"), F.lit("T").alias("tokenizer"),
        F.concat(F.lit("old "), (k % 300).cast("string")).alias("code_before"), F.when(k % 7 != 0, F.concat(F.lit("new "), name)).alias("code_after"), F.when(k % 31 != 0, F.lit(9)).alias("token_count_before"), F.lit(10).alias("token_count_after"),
        F.when(k % 5 == 0, "module_block").alias("unit_type"),
    )
    chunks = t(spark, d, "supplier").select(
        F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("chunk_id"), F.col("s_suppkey").alias("source_line"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("parent_sample_id"), F.lit("o/r").alias("repository"), F.lit("abc").alias("commit"),
        F.lit("c.py").alias("file_path"), F.lit("f").alias("function_name"), F.array(F.lit("CWE-79")).alias("cwes"), F.array(F.lit("L")).alias("labels"), F.lit("T").alias("tokenizer"), F.concat(F.lit("chunk "), F.col("s_suppkey").cast("string")).alias("chunk_code"),
        F.lit("before").alias("variant"), F.lit(True).alias("is_vulnerable_for_target_cwe"), F.lit(8).alias("chunk_token_count"), F.lit(1).alias("chunk_index"), F.lit(True).alias("contains_patch"), (F.col("s_suppkey") % 2 == 0).alias("eligible_for_training"), F.lit("MODEL_READY").alias("chunk_status"),
    )
    return dataset.build([accepted], [(chunks, "other")])


_SAMPLES = """
WITH s AS (SELECT 'S' || c_custkey AS parent, 'P' || c_custkey % 400 AS grp, 0 AS ord, c_custkey AS k, v = 'after' AS aft, 'S' || c_custkey || ':' || v AS id, v = 'before' AS vul, CASE WHEN c_custkey % 13 = 0 THEN 'CWE-22' ELSE 'CWE-79' END AS cwe,
    CASE WHEN v = 'before' THEN 'old ' || c_custkey % 300 ELSE 'new ' || c_custkey END AS code, CASE WHEN c_custkey % 5 = 0 THEN 'module_block' ELSE 'full_function' END AS kind, c_custkey % 29 <> 0 AS ok
  FROM customer, (VALUES ('before'), ('after')) AS x(v) WHERE (v = 'before' AND c_custkey % 31 <> 0) OR (v = 'after' AND c_custkey % 7 <> 0)
  UNION ALL SELECT 'S' || s_suppkey, 'S' || s_suppkey, 1, s_suppkey, false, 'C' || s_suppkey, true, 'CWE-79', 'chunk ' || s_suppkey, 'long_chunk', true FROM supplier WHERE s_suppkey % 2 = 0),
j AS (SELECT *, CASE WHEN NOT ok THEN 'invalid' WHEN min(CASE WHEN ok THEN vul || cwe END) OVER (PARTITION BY code) <> max(CASE WHEN ok THEN vul || cwe END) OVER (PARTITION BY code) THEN 'conflict'
  WHEN row_number() OVER (PARTITION BY code, ok ORDER BY ord, k, aft, id) = 1 THEN 'kept' ELSE 'duplicate' END AS verdict FROM s)
"""


@query(_SAMPLES + "SELECT id AS model_sample_id, parent AS parent_sample_id, grp AS group_id, verdict, kind AS source_type, sha256(code) AS code_sha256 FROM j")
def dataset_build(spark, d):
    built = _built(spark, d)
    parts = [rows.select("model_sample_id", "parent_sample_id", "group_id", F.lit(v).alias("verdict"), "source_type", "code_sha256") for v, rows in (("kept", built.kept), ("duplicate", built.duplicates), ("conflict", built.conflicts), ("invalid", built.invalid))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(_SAMPLES + """, u AS (SELECT *, CASE WHEN kind = 'module_block' THEN 'module_block' ELSE 'function' END AS unit FROM j WHERE verdict = 'kept')
SELECT 'model_samples' AS metric, CAST(count(*) AS BIGINT) AS value FROM u UNION ALL SELECT 'unique_parent_functions', count(DISTINCT parent) FILTER (unit = 'function') FROM u
UNION ALL SELECT 'unique_parent_module_blocks', count(DISTINCT parent) FILTER (unit = 'module_block') FROM u UNION ALL SELECT 'unique_parent_units', count(DISTINCT parent) FROM u UNION ALL SELECT 'unique_groups', count(DISTINCT grp) FROM u
UNION ALL SELECT m, count(*) FILTER (verdict = v) FROM j, (VALUES ('duplicates_removed', 'duplicate'), ('label_conflicts_removed', 'conflict'), ('invalid_removed', 'invalid')) AS x(m, v) GROUP BY m
UNION ALL SELECT 'samples_' || cwe, count(*) FROM u GROUP BY cwe""")
def build_summary(spark, d):
    return dataset.build_summary(_built(spark, d))


def _recovered(spark, d):
    k = F.col("s_suppkey").cast("string")
    rows = t(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("https://github.com/o/r"), k, F.lit("/commit/"), F.md5(k)).alias("commit"))
    functions = rows.select(
        F.col("s_suppkey").alias("source_line"), "commit", F.concat(F.lit("F"), k).alias("file_change_id"), F.concat(F.lit("fn"), k).alias("function_name"), F.when(F.col("s_suppkey") % 17 == 0, "Java").otherwise("Python").alias("programming_language"),
        F.concat(F.lit("def fn"), k, F.lit("(x):\n    y = x\n    return x"), k, F.lit("\n")).alias("code_before"), F.concat(F.lit("def fn"), k, F.lit("(x):\n    y = x\n    return y"), k, F.lit("\n")).alias("code_after"),
    )
    cwe_map = rows.select(F.col("commit").alias("key"), F.when(F.col("s_suppkey") % 19 == 0, "CWE-1").otherwise("CWE-79").alias("value"), F.lit(0).alias("ordinal"))

    def file(path: str, minus, plus):
        head = F.concat(*[x for i in ("diff --git a/", " b/") for x in (F.lit(i), F.lit(path))])
        return F.concat(head, F.lit(f"\n--- a/{path}\n+++ b/{path}\n@@ -1,3 +1,3 @@\n"), F.lit(" def fn"), k, F.lit("(x):\n     y = x\n-"), minus, F.lit("\n+"), plus, F.lit("\n"))

    good = file("src/a.py", F.concat(F.lit("    return x"), k), F.concat(F.lit("    return y"), k))
    twice = F.concat(good, file("src/b.py", F.concat(F.lit("    return x"), k), F.concat(F.lit("    return y"), k)))
    text = F.concat(good, file("notes.txt", F.concat(F.lit("    return x"), k), F.concat(F.lit("    return y"), k)))
    other = F.lit("diff --git a/src/c.py b/src/c.py\n--- a/src/c.py\n+++ b/src/c.py\n@@ -1 +1 @@\n-old thing\n+new thing\n")
    context = file("src/d.py", F.lit("    q = 1"), F.lit("    q = 2"))
    kind = F.col("s_suppkey") % 6
    diff = F.when(kind == 0, good).when(kind == 1, twice).when(kind == 2, text).when(kind == 3, other).when(kind == 4, context).otherwise("not a diff")
    diffs = rows.select(K.commit_parts(F.col("commit"))["join_key"].alias("join_key"), diff.alias("diff_text"))
    return recovery.recover(functions, cwe_map, diffs)


_RECOVERY = """
WITH r AS (SELECT s_suppkey AS k, CASE s_suppkey % 6 WHEN 1 THEN 'ambiguous_equal_score' WHEN 3 THEN 'no_code_match' WHEN 4 THEN 'missing_before_or_after_change_match' WHEN 5 THEN 'download_or_parse_error' ELSE 'unique_high_confidence_diff_match' END AS reason
  FROM supplier WHERE s_suppkey % 17 <> 0 AND s_suppkey % 19 <> 0)
"""


@query(_RECOVERY + """
SELECT 'F' || k AS file_change_id, reason, CASE WHEN reason LIKE 'unique%' THEN 'src/a.py' END AS file_path, CASE WHEN reason LIKE 'unique%' THEN 24 END AS score,
  CASE s_suppkey % 6 WHEN 1 THEN 'src/a.py|score=24|del=1|add=1;src/b.py|score=24|del=1|add=1' WHEN 3 THEN 'src/c.py|score=0|del=0|add=0' WHEN 4 THEN 'src/d.py|score=4|del=0|add=0' ELSE '' END AS top_candidates
FROM r JOIN supplier ON s_suppkey = k""")
def path_recovery(spark, d):
    found = _recovered(spark, d)
    good = found.resolved.select("file_change_id", F.col("match_method").alias("reason"), "file_path", F.col("match_evidence.score").alias("score"), F.lit("").alias("top_candidates"))
    return good.unionByName(found.unresolved.select("file_change_id", "reason", F.lit(None).cast("string").alias("file_path"), F.lit(None).cast("int").alias("score"), "top_candidates"))


@query(_RECOVERY + """
SELECT * FROM (SELECT 'input_rows' AS metric, CAST(count(*) AS BIGINT) AS value FROM supplier UNION ALL SELECT m, count(*) FROM r, (VALUES ('selected_groups'), ('selected_commits')) AS x(m) GROUP BY m
  UNION ALL SELECT CASE WHEN reason = 'download_or_parse_error' THEN 'download_or_parse_failures' ELSE 'cached_commits' END, count(*) FROM r GROUP BY 1
  UNION ALL SELECT CASE WHEN reason LIKE 'unique%' THEN 'resolved_groups' ELSE reason END, count(*) FROM r WHERE reason <> 'download_or_parse_error' GROUP BY 1
  UNION ALL SELECT 'resolved_output_rows', count(*) FILTER (reason LIKE 'unique%') FROM r UNION ALL SELECT 'unresolved_output_rows', count(*) FILTER (reason NOT LIKE 'unique%') FROM r)""")
def recovery_counters(spark, d):
    return _recovered(spark, d).counters


def _extracted(spark, d):
    k = F.col("n_nationkey")
    name = k.cast("string")
    kind = k % 8
    sha = F.md5(name)
    fix = F.struct(F.lit("o/r").alias("repository"), sha.alias("commit_id"), F.concat(F.lit("u"), name).alias("commit_url"))
    module = kind.isin(5, 6)
    none = F.array().cast("array<string>")
    candidates = t(spark, d, "nation").select(
        k.cast("long").alias("ordinal"), F.concat(F.lit("G"), name).alias("ghsa_id"), F.when(kind == 7, "NEEDS_FIX_COMMIT").otherwise("READY_FOR_EXTRACTION").alias("candidate_status"),
        F.when(module, "CWE-798").otherwise("CWE-79").alias("target_cwe"), F.array(F.when(kind == 5, "CWE-798").otherwise("CWE-79")).alias("cwes"), F.array(fix).alias("fix_commits"),
        F.when(module, F.array(F.lit("KEY"))).otherwise(none).alias("include_module_bindings"), F.when(kind == 4, F.array(F.lit("nothing"))).otherwise(none).alias("include_functions"),
    )
    rows = t(spark, d, "nation").select(k.alias("k"), name.alias("name"), sha.alias("commit_id"), kind.alias("kind"))
    parents = F.when(F.col("kind") == 1, F.array(F.lit("p1"), F.lit("p2"))).otherwise(F.array(F.concat(F.lit("p"), "name")))
    commits = rows.select(F.lit("o/r").alias("repository"), "commit_id", parents.alias("parents"), F.lit("message").alias("message"))
    path = F.when(F.col("kind") == 2, "tests/test_a.py").otherwise("src/a.py")
    line = F.when(F.col("kind") == 5, 1).otherwise(4).cast("string")
    diff = F.concat(F.lit("diff --git a/"), path, F.lit(" b/"), path, F.lit("\n--- a/"), path, F.lit("\n+++ b/"), path, F.lit("\n@@ -"), line, F.lit(" +"), line, F.lit(" @@\n-x\n+y\n"))
    diffs = rows.where("kind <> 3").select(F.lit("o/r").alias("repository"), "commit_id", diff.alias("diff_text"))

    def source(value: str):
        return F.concat(F.lit(f'KEY = "{value}'), F.col("name"), F.lit(f'"\n\ndef f(x):\n    return "{value}'), F.col("name"), F.lit('"\n'))

    sides = [rows.select(F.lit("o/r").alias("repository"), rev.alias("rev"), path.alias("path"), source(v).alias("source")) for rev, v in ((F.concat(F.lit("p"), "name"), "old"), (F.col("commit_id"), "new"))]
    return extraction.extract(candidates, commits, diffs, sides[0].unionByName(sides[1]))


@query("""
WITH n AS (SELECT n_nationkey AS k, n_nationkey % 8 AS kind FROM nation),
p AS (SELECT *, row_number() OVER (ORDER BY k) AS s FROM n WHERE kind IN (0, 5)),
q AS (SELECT k, CASE kind WHEN 0 THEN 'f' ELSE 'KEY' END AS fn, s, kind FROM p)
SELECT 'GHSA_' || CASE kind WHEN 0 THEN 'CWE79' ELSE 'CWE798' END || '_' || lpad(CAST(s AS VARCHAR), 4, '0') || '_' || substr(sha256('o/r@' || md5(CAST(k AS VARCHAR)) || ':src/a.py:' || fn), 1, 16) AS sample_id, fn AS function_name,
  CASE kind WHEN 0 THEN 'function' ELSE 'module_block' END AS unit_type, CASE kind WHEN 0 THEN 3 ELSE 1 END AS start_line_before, CASE kind WHEN 0 THEN 4 ELSE 1 END AS end_line_after, CASE kind WHEN 0 THEN 'CWE-79' ELSE 'CWE-798' END AS cwes,
  CASE kind WHEN 0 THEN 'XSS' ELSE 'HARDCODED_CREDENTIALS' END AS labels, CASE kind WHEN 0 THEN sha256('def f(x):' || chr(10) || '    return "new' || k || '"' || chr(10)) ELSE sha256('KEY = "new' || k || '"') END AS code_after_sha256 FROM q""")
def extraction_pairs(spark, d):
    pairs = _extracted(spark, d).pairs
    return pairs.select("sample_id", "function_name", "unit_type", "start_line_before", "end_line_after", F.array_join("cwes", ",").alias("cwes"), F.array_join("labels", ",").alias("labels"), F.sha2("code_after", 256).alias("code_after_sha256"))


@query("""
WITH n AS (SELECT 'G' || n_nationkey AS ghsa_id, n_nationkey % 8 AS kind FROM nation)
SELECT ghsa_id, unnest(CASE kind WHEN 1 THEN ['manual_review_non_single_parent_commit'] WHEN 2 THEN ['rejected_no_production_python_file'] WHEN 3 THEN ['manual_review_download_or_parse_error']
  WHEN 4 THEN ['excluded_by_batch_function_allowlist', 'manual_review_commit_produced_no_pair'] WHEN 6 THEN ['rejected_module_scope_without_cwe798_isolation_evidence'] ELSE [] END) AS reason FROM n""")
def extraction_review(spark, d):
    return _extracted(spark, d).review.select("ghsa_id", "reason")


@query("""
WITH n AS (SELECT n_nationkey % 8 AS kind FROM nation)
SELECT 'normalized_function_pairs' AS metric, CAST(count(*) FILTER (kind IN (0, 5)) AS BIGINT) AS value FROM n UNION ALL SELECT 'unique_repositories', 1 UNION ALL SELECT 'unique_commits', count(*) FILTER (kind IN (0, 5)) FROM n
UNION ALL SELECT 'review_records', count(*) FILTER (kind IN (1, 2, 3, 6)) + 2 * count(*) FILTER (kind = 4) FROM n""")
def extraction_summary(spark, d):
    return extraction.extraction_summary(_extracted(spark, d))


_SPLITTING = """
WITH g AS (SELECT DISTINCT 'o/r' || o_custkey % 50 || '@c' || o_custkey AS grp, (['CWE-22', 'CWE-78', 'CWE-79', 'CWE-89', 'CWE-287', 'CWE-798'])[1 + o_custkey % 6] AS label FROM orders),
r AS (SELECT *, count(*) OVER (PARTITION BY label) AS n, row_number() OVER (PARTITION BY label ORDER BY sha256('42|' || grp), grp) AS rk FROM g WHERE label <> 'CWE-798'),
a AS (SELECT grp, CASE WHEN rk <= greatest(1, round_even(n * 0.15, 0)) THEN 'test' WHEN rk <= 2 * greatest(1, round_even(n * 0.15, 0)) THEN 'validation' ELSE 'train' END AS split FROM r),
s AS (SELECT o_orderkey || ':' || v AS id, 'o/r' || o_custkey % 50 AS repo, 'o/r' || o_custkey % 50 || '@c' || o_custkey AS grp, CASE WHEN v = 'after' THEN 'SAFE' ELSE (['CWE-22', 'CWE-78', 'CWE-79', 'CWE-89', 'CWE-287', 'CWE-798'])[1 + o_custkey % 6] END AS label
  FROM orders, (VALUES ('before'), ('after')) AS x(v))
"""


def _split(spark, d):
    k = F.col("o_custkey")
    cwe = F.array(*[F.lit(f"CWE-{c}") for c in (22, 78, 79, 89, 287, 798)])[(k % 6).cast("int")]
    samples = t(spark, d, "orders").select("o_orderkey", "o_custkey", F.explode(F.array(F.lit("before"), F.lit("after"))).alias("variant")).select(
        F.concat_ws(":", F.col("o_orderkey").cast("string"), "variant").alias("model_sample_id"), F.concat(F.lit("O/R"), (k % 50).cast("string")).alias("repository"), F.concat(F.lit("C"), k.cast("string")).alias("commit_id"), F.lit("a.py").alias("file_path"),
        F.lit("f").alias("function_name"), F.lit("code").alias("code"), "variant", (F.col("variant") == "before").alias("is_vulnerable"), F.array(cwe).alias("cwes"), F.lit(5).alias("token_count"), F.lit("T").alias("tokenizer"),
    )
    return splitting.split_samples(samples)


@query(_SPLITTING + "SELECT s.id AS model_sample_id, s.grp AS split_group_id, s.label AS target_label, CAST(list_position(['SAFE', 'CWE-22', 'CWE-78', 'CWE-79', 'CWE-89', 'CWE-287'], s.label) - 1 AS INTEGER) AS label_id, a.split FROM s JOIN a USING (grp)")
def split_plan(spark, d):
    made = _split(spark, d)
    splitting.check_split(made.rows)
    return made.rows.select("model_sample_id", "split_group_id", "target_label", "label_id", "split")


@query(_SPLITTING + "SELECT a.split, s.label, CAST(count(*) AS BIGINT) AS samples, CAST(count(DISTINCT s.grp) AS BIGINT) AS commit_groups, CAST(count(DISTINCT s.repo) AS BIGINT) AS repositories FROM s JOIN a USING (grp) GROUP BY ALL")
def split_plan_summary(spark, d):
    return splitting.split_table(_split(spark, d).rows)
