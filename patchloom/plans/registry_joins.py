"""Registered queries of keys, findings, methods, summaries and scans."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import functions as F

from patchloom.functions import keys as K
from patchloom.operators import findings as R
from patchloom.operators import methods as M
from patchloom.operators import metrics, rules, splits, summaries, triage
from patchloom.plans.registry import query, t
from patchloom.sinks import files
from patchloom.sources import advisories, jsonl


@query("""
WITH k AS (SELECT c_custkey AS k, md5(CAST(c_custkey AS VARCHAR)) AS h, c_custkey % 5 AS m FROM customer)
SELECT k AS c_custkey, CASE WHEN m = 4 THEN 'O/R' || k WHEN m = 3 THEN NULL ELSE 'Own/R' || k END AS repository, CASE WHEN m = 2 THEN NULL ELSE h END AS commit_id,
  CASE m WHEN 2 THEN 'https://github.com/Own/R' || k || '.git' WHEN 3 THEN h WHEN 4 THEN 'https://github.com/O/R' || k || '/commit/' || h ELSE 'https://github.com/Own/R' || k || '/commit/' || h END AS canonical_url,
  CASE m WHEN 2 THEN 'https://github.com/Own/R' || k || '.git' WHEN 3 THEN h WHEN 4 THEN 'o/r' || k || '@' || h ELSE 'own/r' || k || '@' || h END AS join_key FROM k""")
def commit_canonical(spark, d):
    k, m = F.col("c_custkey").cast("string"), F.col("c_custkey") % 5
    own = F.concat(F.lit("https://github.com/Own/R"), k)
    sha = F.md5(k)
    raw = F.when(m == 0, F.concat(own, F.lit("/pull/7/commits/aaaaaaa1/x/commits/"), F.upper(sha), F.lit("?w=1"))).when(m == 1, F.concat(own, F.lit(".git/commit/"), sha)).when(m == 2, F.concat(own, F.lit(".git"))).otherwise(sha)
    other = F.when(m == 4, F.concat(F.lit(" https://github.com/O/R"), k, F.lit(".git/ ")))
    parts = t(spark, d, "customer").select("c_custkey", K.with_repository(K.commit_parts(raw), other).alias("p"))
    return parts.select("c_custkey", "p.repository", "p.commit_id", "p.canonical_url", "p.join_key")


@query("""
WITH k AS (SELECT c_custkey AS k, c_custkey % 6 AS m, c_custkey % 4 AS e FROM customer)
SELECT k AS c_custkey, CASE m WHEN 0 THEN 'a/f' || k || '.py' WHEN 1 THEN 'tests/x.py' WHEN 2 THEN 'src/test_' || k || '.py' WHEN 3 THEN 'docs/a.py' ELSE CASE e WHEN 0 THEN 'e/p.py' WHEN 1 THEN 'e/n.py' END END AS path,
  CASE m WHEN 0 THEN false WHEN 1 THEN true WHEN 2 THEN true WHEN 3 THEN true ELSE false END AS review, m = 5 AS controls FROM k""")
def path_resolution(spark, d):
    k, m, e = F.col("c_custkey").cast("string"), F.col("c_custkey") % 6, F.col("c_custkey") % 4
    own = [F.when(m == 0, F.concat(F.lit(" ././a\\f"), k, F.lit(".py"))).when(m > 3, "./"), F.when(m == 1, "tests/x.py"), F.when(m == 2, F.concat(F.lit("./src/test_"), k, F.lit(".py"))), F.when(m == 3, "docs/a.py")]
    extra = [F.when(e == 0, "e/p.py"), F.lit(""), F.lit(None).cast("string"), F.when(e == 1, "e/n.py")]
    rows = t(spark, d, "customer").select("c_custkey", K.resolve_path(own, extra).alias("path"), K.has_binary_controls(F.when(m == 5, F.lit("a\x07b")).otherwise("a\tb")).alias("controls"))
    return rows.select("c_custkey", "path", K.is_review_path(F.col("path")).alias("review"), "controls")


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE sha256('o/r|' || CASE WHEN c_custkey % 2 = 0 THEN 'abc' ELSE '' END || '|' || CASE c_custkey % 3 WHEN 0 THEN 'a.py' WHEN 1 THEN 'file_change_id:' || c_custkey ELSE '' END || '|f') END AS pair_id,
  sha256('O/R|' || CASE WHEN c_custkey % 2 = 0 THEN 'abc' ELSE '' END || '|' || CASE c_custkey % 3 WHEN 0 THEN 'a.py' ELSE '' END || '|f') AS external_pair_id FROM customer""")
def pair_identity(spark, d):
    k = F.col("c_custkey")
    gone = k % 7 == 0

    def some(c):
        return F.when(~gone, c)

    commit, path = F.when(k % 2 == 0, "abc"), F.when(k % 3 == 0, "a.py")
    own = K.pair_id(some(F.lit("o/r")), some(commit), some(path), some(F.when(k % 3 == 1, k)), some(F.lit("f")))
    return t(spark, d, "customer").select("c_custkey", own.alias("pair_id"), K.external_pair_id(F.lit("O/R"), commit, path, F.lit("f")).alias("external_pair_id"))


@query("""
WITH k AS (SELECT c_custkey, c_custkey % 4 AS m, (c_custkey // 4) % 3 AS s, c_custkey % 5 <> 0 AS v FROM customer), f AS (SELECT *, m < 2 AS known, s > 0 AS suffixed FROM k)
SELECT c_custkey, CASE WHEN known AND suffixed AND (m = 0) <> (s = 1) THEN true WHEN known THEN m = 0 WHEN suffixed THEN s = 1 ELSE v END AS is_python,
  known AND suffixed AND (m = 0) <> (s = 1) AS conflict, NOT known AND NOT suffixed AND NOT v AS unknown FROM f""")
def language_decision(spark, d):
    k = F.col("c_custkey")
    m, s = k % 4, F.floor(k / 4) % 3
    meta = F.when(m == 0, " Py ").when(m == 1, "Java").when(m == 2, "None")
    path = F.when(s == 0, "Makefile").when(s == 1, "a/B.PY").otherwise("a.js")
    return t(spark, d, "customer").select("c_custkey", K.language_decision(meta, path, k % 5 != 0).alias("x")).select("c_custkey", "x.*")


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 10 AS DOUBLE) + 0.5 END AS severity, 'https://github.com/own/r' || c_custkey || '/commit/abc' AS link, 'l2' || chr(10) || 'l3' || chr(10) || 'l4' AS slice,
  'f(a,b' || c_custkey || ')' AS signature, 'https://github.com/o/r' || c_custkey || '/commit/x' AS url, CASE WHEN c_custkey % 2 = 0 THEN 'SAFE' ELSE 'CWE-79' END AS target_label, 'own/r@c' || c_custkey AS split_group,
  CASE WHEN c_custkey % 3 = 0 THEN 'SQL_INJECTION,XSS' ELSE 'XSS' END AS labels, CASE WHEN c_custkey % 3 = 0 THEN 'A05' ELSE 'A05' END AS risk_groups, '0,2,2,' || (2 + length(CAST(c_custkey AS VARCHAR))) AS offsets,
  CASE WHEN c_custkey % 2 = 0 THEN 'GitHub Advisory Database' ELSE 'own' END AS fallback FROM customer""")
def record_normalizers(spark, d):
    from patchloom.plans.dataset import fallback_label

    k, name = F.col("c_custkey"), F.col("c_custkey").cast("string")
    severity = F.when(k % 3 == 0, F.concat(F.lit("High ("), (k % 10).cast("string"), F.lit(".5)"))).when(k % 3 == 1, "High (12.50)").otherwise("none")
    cwes = F.when(k % 3 == 0, F.array(F.lit("CWE-89"), F.lit("CWE-79"), F.lit("CWE-1"))).otherwise(F.array(F.lit("CWE-79")))
    return t(spark, d, "customer").select(
        "c_custkey", K.severity(severity).alias("severity"), K.file_to_commit(F.concat(F.lit("own_r"), name, F.lit("_abc.csv"))).alias("link"), K.source_slice(F.lit("l1\nl2\nl3\nl4\nl5"), F.lit(2), F.lit(3)).alias("slice"),
        K.signature(F.concat(F.lit(" f( a, b"), name, F.lit(" ) "))).alias("signature"), K.commit_link(F.concat(F.lit("https://github.com/o/r"), name, F.when(k % 2 == 0, ".git").otherwise("")), F.lit("x")).alias("url"),
        K.target_label(F.when(k % 2 == 0, "after").otherwise("before"), k % 2 != 0, F.array(F.lit("CWE-79"))).alias("target_label"), K.split_group(F.lit("Own/R"), F.concat(F.lit("C"), name)).alias("split_group"),
        F.array_join(K.labels_of(cwes), ",").alias("labels"), F.array_join(K.labels_of(cwes, 1), ",").alias("risk_groups"), F.array_join(K.line_offsets(F.array(F.lit("ab"), F.lit(""), name)).cast("array<string>"), ",").alias("offsets"),
        fallback_label(F.when(k % 2 == 0, "data/supplement/a.jsonl").otherwise("data/a.jsonl"), "own").alias("fallback"),
    )


_RULES = [(1, "CWE-79 x y error\t"), (2, "CWE-20 x y error\t"), (3, "CWE-22 x y click"), (4, "CWE-89 x y purchase"), (5, "CWE-20 x y view")]
_RULES_SQL = "(VALUES (1, 'error', ['CWE-79', 'CWE-20']), (3, 'click', ['CWE-22']), (4, 'purchase', ['CWE-89']), (5, 'view', ['CWE-20'])) AS r(ord, name, cwes)"


def _rules(spark):
    return R.rule_table(spark.createDataFrame(_RULES, "ordinal int, value string"))


@query("""
SELECT * FROM (VALUES (1, 'error', 'CWE-79,CWE-20'), (3, 'click', 'CWE-22'), (4, 'purchase', 'CWE-89'), (5, 'view', 'CWE-20'), (11, '5001', 'CWE-78,CWE-88'), (12, '5002', 'CWE-79')) AS r(ordinal, rule, cwes)""")
def rule_table_parse(spark, d):
    dashed = R.rule_table(spark.createDataFrame([(11, "5001 - CWE-78, CWE-88 - exec - x"), (12, "5002 - CWE-79 - xss")], "ordinal int, value string"), kind="dashed")
    return _rules(spark).unionByName(dashed).select("ordinal", "rule", F.array_join("cwes", ",").alias("cwes"))


@query(f"SELECT event_id, ord AS ordinal, c.cwe FROM events JOIN {_RULES_SQL} ON event_type = name, unnest(cwes) AS c(cwe)")
def exact_rule_match(spark, d):
    hits = R.exact_rule(t(spark, d, "events").select("event_id", F.col("event_type").alias("code")), "code", _rules(spark))
    return hits.select("event_id", "ordinal", F.explode("cwes").alias("cwe"))


_REPORTED = "(['CWE-79', 'CWE-20', 'CWE-22'])[1 + event_id % 3]"


@query(f"SELECT event_id, {_REPORTED} AS cwe, name AS rules FROM events JOIN {_RULES_SQL} ON contains(event_type, name) AND list_contains(cwes, {_REPORTED})")
def any_rule_match(spark, d):
    reported = F.array(F.lit("CWE-79"), F.lit("CWE-20"), F.lit("CWE-22"))[(F.col("event_id") % 3).cast("int")]
    hits = R.any_rule(t(spark, d, "events").select("event_id", "event_type", reported.alias("cwe")), "event_type", _rules(spark), "cwe")
    return hits.select("event_id", "cwe", F.array_join("rules", ",").alias("rules"))


@query(f"SELECT {_REPORTED} AS cwe, CAST(count(*) AS BIGINT) AS matches FROM events JOIN {_RULES_SQL} ON contains(event_type, name) AND list_contains(cwes, {_REPORTED}) GROUP BY 1")
def matches_by_weakness(spark, d):
    return R.matches_by_weakness(any_rule_match(spark, d), "cwe")


@query("""
SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') THEN 'single' ELSE 'multi' END AS bucket, coalesce(n_name, 'none') AS nation FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey < 12
WHERE c_mktsegment = 'BUILDING' AND c_custkey IN (SELECT o_custkey FROM orders) AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def surviving_cohort(spark, d):
    orders = t(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    customers = t(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    kept = R.cohort(customers, orders, orders.where("o_orderpriority = '1-URGENT'"), "c_custkey", F.col("c_mktsegment") == "BUILDING")
    held = R.membership(kept, orders.where("o_orderstatus = 'F'"), "c_custkey")
    nations = t(spark, d, "nation").where("n_nationkey < 12").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))
    return R.with_default(held, nations, "c_nationkey", "nation", F.lit("none")).select("c_custkey", "bucket", "nation")


@query("SELECT o_orderkey, n_name AS nation FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey")
def lookup_or_raise(spark, d):
    homes = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("o_custkey"), F.col("n_name").alias("nation"))
    return R.looked_up(t(spark, d, "orders").select("o_orderkey", "o_custkey"), homes, "o_custkey", "nation").select("o_orderkey", "nation")


@query("""
WITH q AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id * 1000 + turn) AS pos FROM conversations)
SELECT CAST(pos AS VARCHAR) AS custom_id, conv_id, turn FROM q WHERE pos % 3 = 0""")
def response_by_position(spark, d):
    requests = t(spark, d, "conversations").select("conv_id", "turn", (F.col("conv_id") * 1000 + F.col("turn")).alias("place"))
    n = requests.count()
    responses = spark.range(1, n + 1).where("id % 3 = 0").select(F.col("id").cast("string").alias("custom_id"))
    return R.by_position(responses, requests, "place").select("custom_id", "conv_id", "turn")


@query("""
WITH rows_ AS (SELECT c_custkey FROM customer WHERE c_acctbal > 0), kept AS (SELECT c_custkey FROM rows_ WHERE c_custkey % 50 = 0),
k AS (SELECT count(*) AS n FROM (SELECT * FROM kept LIMIT 40)), o AS (SELECT c_custkey, row_number() OVER (ORDER BY sha256('42|' || c_custkey), c_custkey) AS rk FROM rows_ WHERE c_custkey NOT IN (SELECT c_custkey FROM kept))
SELECT c_custkey, 'kept' AS origin FROM kept UNION ALL SELECT c_custkey, 'new' FROM o, k WHERE rk <= greatest(0, 40 - n)""")
def filled_sample(spark, d):
    rows = t(spark, d, "customer").where("c_acctbal > 0").select("c_custkey")
    before = t(spark, d, "customer").where("c_custkey % 50 = 0").select("c_custkey")
    return R.filled_sample(rows, before, "c_custkey", size=40)


@query("SELECT c_nationkey, CAST(count(*) AS BIGINT) AS n, row_number() OVER (ORDER BY count(*) DESC, c_nationkey) AS place FROM customer GROUP BY 1 QUALIFY place > 1")
def report_groups(spark, d):
    return R.report_groups(t(spark, d, "customer"), "c_nationkey", skip=1).withColumn("place", F.col("place").cast("long"))


@query("""
WITH m AS (SELECT l_orderkey, l_linenumber, 'c' || l_orderkey % 97 AS commit, CASE WHEN l_linenumber % 2 = 0 THEN 'True' ELSE 'False' END AS before_change, CASE l_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'x/test/a.py' ELSE 'src/a.py' END AS old_path,
  CASE WHEN l_partkey % 9 = 0 THEN '(anonymous)' ELSE 'm' END AS name FROM lineitem WHERE l_orderkey < 1000),
k AS (SELECT * FROM m WHERE (old_path IS NULL OR NOT contains(old_path, 'test')) AND name <> '(anonymous)'),
l AS (SELECT commit FROM k GROUP BY commit HAVING count(*) FILTER (before_change = 'True') > 4 OR count(*) FILTER (before_change <> 'True') > 4)
SELECT l_orderkey, l_linenumber, commit FROM k WHERE commit NOT IN (SELECT commit FROM l)""")
def method_filters(spark, d):
    rows = t(spark, d, "lineitem").where("l_orderkey < 1000").select(
        "l_orderkey", "l_linenumber", F.concat(F.lit("c"), (F.col("l_orderkey") % 97).cast("string")).alias("commit"), F.when(F.col("l_linenumber") % 2 == 0, "True").otherwise("False").alias("before_change"),
        F.when(F.col("l_suppkey") % 5 == 1, "x/test/a.py").when(F.col("l_suppkey") % 5 != 0, "src/a.py").alias("old_path"), F.when(F.col("l_partkey") % 9 == 0, "(anonymous)").otherwise("m").alias("name"),
    )
    return M.without_large_commits(M.named(M.without_tests(rows)), "commit", 4).select("l_orderkey", "l_linenumber", "commit")


# files with a method that changed on both sides, one whose kept line went, one that was only added, and one untouched
@query("""
SELECT n_nationkey AS file_change_id, x.name, x.b AS start_before, x.a AS start_after FROM nation, (VALUES ('both', 1, 1), ('lost', 4, NULL), ('lost', NULL, 4), ('added', NULL, 10), ('same', 7, 7)) AS x(name, b, a)""")
def changed_method_pairs(spark, d):
    def side(rows):
        return t(spark, d, "nation").select(F.col("n_nationkey").alias("file_change_id"), F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(s).alias("start_line"), F.lit(e).alias("end_line"), F.lit(c).alias("code")) for n, s, e, c in rows])).alias("m")).select("file_change_id", "m.*")

    def lines(numbers):
        return t(spark, d, "nation").select(F.col("n_nationkey").alias("file_change_id"), F.explode(F.array(*map(F.lit, numbers))).alias("line"))

    before = side([("both", 1, 2, "def both():\n    a = 1"), ("lost", 4, 5, "def lost(x):\n    b = 1"), ("same", 7, 8, "def same():\n    c = 1"), ("idle", 20, 21, "def idle():\n    d = 1")])
    after = side([("both", 1, 2, "def both():\n    a = 2"), ("lost", 4, 5, "def lost(y):\n    b = 2"), ("same", 7, 8, "def same():\n    c = 1"), ("added", 10, 10, "def added(): pass"), ("idle", 20, 21, "def idle():\n    d = 1")])
    return M.changed_pairs(before, after, lines([2, 5, 8]), lines([2, 5, 10]))


@query("""
SELECT 'False' AS before_change, CAST(count(*) AS BIGINT) AS n FROM supplier WHERE s_suppkey % 3 <> 0 UNION ALL SELECT 'True', count(*) FROM supplier WHERE s_suppkey % 4 <> 0""")
def method_rows(spark, d):
    rows = t(spark, d, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 3 == 0, "(anonymous)").otherwise("m").alias("name"))
    before = t(spark, d, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 4 == 0, "(anonymous)").otherwise("m").alias("name"))
    return M.method_rows(before, rows).groupBy("before_change").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH c AS (SELECT o_custkey, o_orderkey, l_linenumber FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_quantity > 30)
SELECT o_orderkey, l_linenumber AS line FROM c""")
def commit_file_rows(spark, d):
    lines = t(spark, d, "lineitem").where("l_quantity > 30").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.struct(F.col("l_linenumber").alias("line"))).alias("commit_files"))
    commits = t(spark, d, "orders").select("o_orderkey").join(lines, "o_orderkey", "left")
    return M.file_rows(commits).select("o_orderkey", "line")


@query("""
SELECT 'S' || s_suppkey AS report_link, 0 AS source_ord, CASE WHEN s_suppkey % 2 = 0 THEN 'own' ELSE CASE WHEN s_suppkey % 3 = 0 THEN 'told' ELSE '' END END AS description FROM supplier
UNION ALL SELECT 'S' || n_nationkey, 1, CASE WHEN n_nationkey % 3 = 0 THEN 'told' ELSE '' END FROM nation""")
def commit_sources(spark, d):
    one = t(spark, d, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("report_link"), F.when(F.col("s_suppkey") % 2 == 0, "own").alias("description"))
    two = t(spark, d, "nation").select(F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("report_link"))
    told = spark.range(0, 100_000, 3).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("report_link"), F.lit("told").alias("description"))
    return M.sources_in_order([one, two], "report_link", told).select("report_link", "source_ord", "description")


_ADVISORIES = """
WITH a AS (SELECT s_suppkey AS k, s_suppkey % 4 AS m, md5(CAST(s_suppkey % 30 AS VARCHAR)) AS h FROM supplier),
s AS (SELECT *, CASE m WHEN 0 THEN 'READY_FOR_EXTRACTION' WHEN 1 THEN 'NEEDS_FIX_COMMIT' WHEN 2 THEN 'REJECTED_CWE_MISMATCH' ELSE 'READY_FOR_EXTRACTION' END AS status FROM a)
"""


def _advisories(spark, d):
    k = F.col("s_suppkey")
    m, sha = k % 4, F.md5((k % 30).cast("string"))
    link = F.concat(F.lit("https://github.com/o/r.git/commit/"), F.upper(sha))
    references = F.when(m.isin(0, 3), F.array(link, F.lit("https://x.y"))).otherwise(F.array(F.lit("https://github.com/o/r/commits")))
    cwes = F.when(m == 2, F.array(F.lit("CWE-1"))).when(m == 3, F.array(F.lit("CWE-79"), F.lit("CWE-1"))).otherwise(F.array(F.lit("CWE-79")))
    first = t(spark, d, "supplier").select(F.concat(F.lit("G"), k.cast("string")).alias("ghsa_id"), F.transform(cwes, lambda c: F.struct(c.alias("cwe_id"))).alias("cwes"), references.alias("references"), F.lit(2).alias("page"))
    stale = first.withColumns({"page": F.lit(1), "references": F.array(F.lit("stale"))})
    return advisories.latest(stale.unionByName(first), "page")


@query(_ADVISORIES + "SELECT 'G' || k AS ghsa_id, status AS candidate_status, CASE WHEN m IN (0, 3) THEN 'o/r@' || h ELSE '' END AS fixes FROM s")
def advisory_candidates(spark, d):
    found = advisories.candidates(_advisories(spark, d), "CWE-79")
    fixes = F.array_join(F.transform("fix_commits", lambda f: F.concat(f["repository"], F.lit("@"), f["commit_id"])), ",")
    return found.select("ghsa_id", "candidate_status", fixes.alias("fixes"))


@query(_ADVISORIES + """SELECT 'advisories_found' AS metric, CAST(count(*) AS BIGINT) AS value FROM s UNION ALL SELECT 'unique_fix_commits', count(DISTINCT h) FILTER (m IN (0, 3)) FROM s UNION ALL SELECT status, count(*) FROM s GROUP BY status""")
def discovery_summary(spark, d):
    return summaries.discovery_summary(advisories.candidates(_advisories(spark, d), "CWE-79"))


@query(_ADVISORIES + "SELECT cwe, CAST(count(DISTINCT k) AS BIGINT) AS n FROM (SELECT k, unnest(CASE m WHEN 2 THEN ['CWE-1'] WHEN 3 THEN ['CWE-79', 'CWE-1'] ELSE ['CWE-79'] END) AS cwe FROM a) GROUP BY cwe")
def advisories_by_weakness(spark, d):
    return advisories.inverted(_advisories(spark, d)).select("cwe", F.size("advisories").cast("long").alias("n"))


@query("SELECT CAST(max(length(text)) AS BIGINT) AS max_length FROM documents")
def longest_text(spark, d):
    return summaries.longest(t(spark, d, "documents"), "text")


@query("""
WITH x AS (SELECT label AS tr, CAST(vec_id % 11 AS INTEGER) AS p FROM embeddings), l AS (SELECT CAST(range AS INTEGER) AS label FROM range(0, 12)),
f AS (SELECT coalesce(2.0 * count(*) FILTER (tr = l.label AND p = l.label) / nullif(count(*) FILTER (tr = l.label) + count(*) FILTER (p = l.label), 0), 0.0) AS f1 FROM l, x GROUP BY l.label)
SELECT (SELECT count(*) FILTER (tr = p) / count(*) FROM x) AS accuracy, (SELECT CAST(count(*) AS BIGINT) FROM x) AS samples, round((SELECT avg(f1) FROM f), 9) AS macro_f1""")
def classification_report(spark, d):
    rows = t(spark, d, "embeddings").select("label", (F.col("vec_id") % 11).cast("int").alias("said"))
    dim = spark.range(12).select(F.col("id").cast("int").alias("label"))
    return metrics.classification(rows, "label", "said", dim).withColumn("macro_f1", F.round("macro_f1", 9))


@query("SELECT doc_id, (['low', 'high'])[1 + quality] AS truth, (['low', 'high'])[1 + CAST(n_chars > 1000 AS INTEGER)] AS prediction, (quality = 1) = (n_chars > 1000) AS correct FROM documents JOIN labels USING (doc_id)")
def prediction_rows(spark, d):
    rows = t(spark, d, "documents").select("doc_id", "n_chars").join(t(spark, d, "labels"), "doc_id").select("doc_id", F.col("quality").cast("int").alias("quality"), (F.col("n_chars") > 1000).cast("int").alias("said"))
    return metrics.predictions(rows, "doc_id", "quality", "said", ["low", "high"])


@query("""
SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN true WHEN 1 THEN false END AS yes_no, CASE turn % 3 WHEN 0 THEN true WHEN 1 THEN false END AS true_false FROM conversations""")
def verdict_parse(spark, d):
    turn = F.col("turn")
    said = F.when(turn % 4 == 0, "YES").when(turn % 4 == 1, "NO").when(turn % 4 == 2, "YES, it is")
    tuned = F.when(turn % 3 == 0, "True").when(turn % 3 == 1, "False").otherwise("true?")
    return t(spark, d, "conversations").select("conv_id", "turn", triage.verdict(said).alias("yes_no"), triage.verdict(tuned, "True", "False").alias("true_false"))


@query("""
SELECT '{"custom_id":"' || row_number() OVER (ORDER BY n_nationkey) || '","method":"POST","url":"/v1/chat/completions","body":{"model":"m","messages":[{"role":"system","content":"S"},{"role":"user","content":"e1"},{"role":"assistant","content":"a1"},{"role":"user","content":"e2"},{"role":"assistant","content":"a2"},{"role":"user","content":"e3"},{"role":"assistant","content":"a3"},{"role":"user","content":"' || n_name || '"}],"temperature":0.0}}' AS value FROM nation""")
def few_shot_requests(spark, d):
    shots = [(f"e{i}", f"a{i}") for i in (1, 2, 3)]
    return triage.few_shot(t(spark, d, "nation").select("n_nationkey", "n_name"), "n_nationkey", "S", shots, F.col("n_name"), "m")


@query("""
WITH s AS (SELECT c_custkey AS k, c_custkey % 5 AS m FROM customer)
SELECT k AS c_custkey, CASE m WHEN 0 THEN '' WHEN 1 THEN 'missing_labels' WHEN 2 THEN 'invalid_variant' WHEN 3 THEN 'invalid_token_count' ELSE 'missing_file_path,non_python_path' END AS errors FROM s""")
def sample_validation(spark, d):
    k, m = F.col("c_custkey"), F.col("c_custkey") % 5
    one = F.array(F.lit("x"))
    base = {c: F.lit("v") for c in rules.SAMPLE_REQUIRED} | {"cwes": one, "labels": F.when(m == 1, F.array().cast("array<string>")).otherwise(one), "file_path": F.when(m != 4, "a.py"), "variant": F.when(m == 2, "both").otherwise("before"), "token_count": F.when(m == 3, 600).otherwise(5)}
    rows = t(spark, d, "customer").select("c_custkey", *[c.alias(n) for n, c in base.items()])
    del k
    return rows.select("c_custkey", F.array_join(rules.sample_errors(rows), ",").alias("errors"))


@query("""
WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('42|' || doc_id), doc_id) AS rk FROM documents)
SELECT doc_id, CASE WHEN rk <= 12 THEN 'train' WHEN rk <= 15 THEN 'validation' ELSE 'test' END AS split FROM r""")
def nested_fixed_split(spark, d):
    return splits.nested_fixed(t(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id", 15, 12).select("doc_id", "split")


@query("""
WITH d AS (SELECT doc_id, 2 * row_number() OVER (ORDER BY doc_id) - 1 AS line FROM documents)
SELECT CAST(line AS INTEGER) AS source_line, CASE WHEN doc_id % 7 NOT IN (0, 1) THEN doc_id END AS doc_id, CASE doc_id % 7 WHEN 0 THEN 'JSONDecodeError' WHEN 1 THEN 'not an object' END AS error FROM d""")
def tolerant_jsonl_scan(spark, d):
    """Lines with blank ones between them are written, numbered and read back."""
    from patchloom.operators.numbering import sequence

    folder = posixpath.join(spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir"), f"scan-{uuid.uuid4().hex}")
    rows = sequence(t(spark, d, "documents").select("doc_id"), "doc_id", "place")
    k = F.col("doc_id").cast("string")
    line = F.when(F.col("doc_id") % 7 == 0, "{bad").when(F.col("doc_id") % 7 == 1, F.concat(F.lit("["), k, F.lit("]"))).otherwise(F.concat(F.lit('{"doc_id": '), k, F.lit("}")))
    files.write_lines(rows.repartitionByRange(1, "place").sortWithinPartitions("place").select(F.concat(line, F.lit("\n")).alias("value")), folder)
    return jsonl.read_tolerant(spark, folder, "doc_id long").select("source_line", "record.doc_id", "error")
