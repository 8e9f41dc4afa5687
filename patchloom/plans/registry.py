"""Registered queries of the core library over the driver's tables.

The tables hold no code diffs, so each operator runs in a query of the same
structure. Every query stands beside the DuckDB SQL that gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.functions import keys as K
from patchloom.operators import chunks, dedup, findings, joins, match, metrics, numbering, rules, samples, splits, summaries, triage

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

LANGS = ("de", "en", "es", "fr", "it")
# a fixed table of finding codes: code, name, weaknesses
FINDINGS = (("E1", "err", "CWE-79"), ("E2", "error", "CWE-79,CWE-20"), ("C1", "click", "CWE-22"), ("P1", "purchase", "CWE-89,CWE-20"), ("V1", "view", "CWE-20"))


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        _QUERIES[fn.__name__] = fn
        if sql:
            _SQL[fn.__name__] = sql
        return fn

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def langs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(x,) for x in LANGS], "lang string")


_LANGS = "(VALUES ('de'), ('en'), ('es'), ('fr'), ('it')) AS dim(lang)"


@query("""
SELECT doc_id, sha256(text) AS code_sha256,
       CASE WHEN row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1 THEN 'kept' ELSE 'duplicate' END AS verdict
FROM documents""")
def exact_hash_dedup(spark, d):
    docs = t(spark, d, "documents").select("doc_id", K.content_hash(F.col("text")).alias("code_sha256"))
    return dedup.conflicts_and_duplicates(docs, F.col("code_sha256"), F.lit(""), [F.col("doc_id")])


@query("""
WITH x AS (SELECT doc_id, sha256(text) AS k, quality FROM documents JOIN labels USING (doc_id))
SELECT doc_id, CASE WHEN min(quality) OVER (PARTITION BY k) <> max(quality) OVER (PARTITION BY k) THEN 'conflict'
  WHEN row_number() OVER (PARTITION BY k ORDER BY doc_id) = 1 THEN 'kept' ELSE 'duplicate' END AS verdict FROM x""")
def label_conflict_elimination(spark, d):
    hashed = t(spark, d, "documents").select("doc_id", K.content_hash(F.col("text")).alias("k"))
    rows = hashed.join(t(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    return dedup.conflicts_and_duplicates(rows, F.col("k"), F.col("quality"), [F.col("doc_id")]).select("doc_id", "verdict")


@query(r"""
SELECT doc_id, row_number() OVER (PARTITION BY lang, sha256(trim(regexp_replace(lower(text), '[ \t\n]+', ' ', 'g'), ' ')) ORDER BY doc_id) = 1 AS is_first
FROM documents""")
def first_wins_keyed_dedup(spark, d):
    code = F.trim(F.regexp_replace(F.lower("text"), r"[ \t\n]+", " "))
    rows = t(spark, d, "documents").select("doc_id", "lang", K.content_hash(code).alias("k"))
    return dedup.first_wins(rows, [F.col("lang"), F.col("k")], [F.col("doc_id")]).select("doc_id", "is_first")


@query("""
WITH RECURSIVE k AS (
  SELECT doc_id, 'code:' || sha256(text) AS key FROM documents UNION ALL
  SELECT doc_id, 'pair:' || sha256(lang || '|' || source || '|' || regexp_replace(lower(text), '[^a-z]+', ' ', 'g')) FROM documents),
e AS (SELECT DISTINCT a.doc_id AS x, b.doc_id AS y FROM k a JOIN k b USING (key)),
r(x, y) AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT x AS doc_id, min(y) AS component FROM r GROUP BY x""")
def component_dedup(spark, d):
    # copies that differ in case, digits, signs or layout, over whole texts
    pair = F.sha2(F.concat_ws("|", "lang", "source", F.regexp_replace(F.lower("text"), "[^a-z]+", " ")), 256)
    keyed = t(spark, d, "documents").select("doc_id", F.explode(F.array(F.concat(F.lit("code:"), K.content_hash(F.col("text"))), F.concat(F.lit("pair:"), pair))).alias("key"))
    return dedup.components(keyed, "doc_id", "key")


@query(r"""
SELECT page_id, nullif(lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)), '') AS host,
       nullif(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]+(/[^?#]*)', 1), '^/+', ''), '') AS path FROM pages""")
def url_canonical_key(spark, d):
    host = F.nullif(F.lower(F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1)), F.lit(""))
    path = F.regexp_replace(F.regexp_extract("url", "^[a-z]+://[^/?#]+(/[^?#]*)", 1), "^/+", "")
    return t(spark, d, "pages").select("page_id", host.alias("host"), K.clean_path(path).alias("path"))


@query("""
WITH n AS (SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
SELECT event_id, CASE WHEN k IS NULL THEN '' WHEN k = 7 THEN 'CWE-7' WHEN k < 7 THEN 'CWE-' || k || ',CWE-7' ELSE 'CWE-7,CWE-' || k END AS cwes FROM n""")
def code_list_normalize(spark, d):
    k = F.get_json_object("props", "$.k")
    spelt = F.concat(F.lit("cwe_000"), k, F.lit(" CWE-7 cwe 007 CWE"), k)
    return t(spark, d, "events").select("event_id", F.array_join(K.normalize_cwes(spelt), ",").alias("cwes"))


@query(r"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '[\pL\pN\pM_]+|[^\pL\pN\pM_\s]')) + 2 AS BIGINT) AS token_count FROM documents""")
def approx_token_count(spark, d):
    return t(spark, d, "documents").select("doc_id", K.approx_tokens(F.col("text")).alias("token_count"))


def _classified(spark, d):
    rows = t(spark, d, "documents").select("doc_id", "lang", "n_chars").join(t(spark, d, "labels"), "doc_id", "left")
    ruled = [
        (rules.MAN, "manual_review_unlabelled", F.col("quality").isNull()),
        (rules.REJ, "rejected_low_quality", F.col("quality") == 0),
        (rules.MAN, "manual_review_toxic", F.col("toxic") == 1),
        (rules.REJ, "rejected_language", ~F.col("lang").isin("en", "de", "fr")),
        (rules.MAN, "manual_review_long", F.col("n_chars") > 4000),
    ]
    return rules.apply_rules(rows, ruled)


_RULES = """
WITH b AS (SELECT d.doc_id, d.lang, quality IS NULL AS r1, coalesce(quality = 0, false) AS r2, coalesce(toxic = 1, false) AS r3,
                  d.lang NOT IN ('en', 'de', 'fr') AS r4, n_chars > 4000 AS r5 FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
s AS (SELECT doc_id, lang, CASE WHEN r2 OR r4 THEN 'REJECTED' WHEN r1 OR r3 OR r5 THEN 'MANUAL_REVIEW' ELSE 'ACCEPTED' END AS status,
  coalesce(nullif(concat_ws(',', CASE WHEN r1 THEN 'manual_review_unlabelled' END, CASE WHEN r2 THEN 'rejected_low_quality' END,
    CASE WHEN r3 THEN 'manual_review_toxic' END, CASE WHEN r4 THEN 'rejected_language' END, CASE WHEN r5 THEN 'manual_review_long' END), ''), 'accepted_exact_target_cwe') AS reason_codes FROM b)
"""


@query(_RULES + "SELECT doc_id, status, reason_codes FROM s")
def status_rules(spark, d):
    return _classified(spark, d).select("doc_id", "status", F.array_join("reason_codes", ",").alias("reason_codes"))


@query(_RULES + f"""
SELECT dim.lang, CAST(count(doc_id) AS BIGINT) AS total, CAST(count(*) FILTER (status = 'ACCEPTED') AS BIGINT) AS accepted,
       CAST(count(*) FILTER (status = 'MANUAL_REVIEW') AS BIGINT) AS manual_review, CAST(count(*) FILTER (status = 'REJECTED') AS BIGINT) AS rejected
FROM {_LANGS} LEFT JOIN s ON dim.lang = s.lang GROUP BY dim.lang""")
def status_summary_dim(spark, d):
    counts = {"total": F.count(F.lit(1))} | {s.lower(): F.count_if(F.col("status") == s) for s in rules.STATUSES}
    return summaries.over_dimension(langs(spark), _classified(spark, d), "lang", counts)


@query("""
WITH x AS (SELECT event_id, value, unnest([event_type, CASE WHEN value > 50 THEN 'high' ELSE 'low' END]) AS kind FROM events)
SELECT kind, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (value > 10) AS BIGINT) AS over_ten FROM x GROUP BY kind
UNION ALL SELECT 'TOTAL', CAST(count(*) AS BIGINT), CAST(count(*) FILTER (value > 10) AS BIGINT) FROM events""")
def status_total_summary(spark, d):
    rows = t(spark, d, "events").select("event_id", "value", "event_type")
    kinds = F.array("event_type", F.when(F.col("value") > 50, "high").otherwise("low"))
    counts = {"n": F.count(F.lit(1)), "over_ten": F.count_if(F.col("value") > 10)}
    return summaries.with_total(rows, "kind", kinds, counts)


@query("""
WITH k AS (SELECT DISTINCT o_orderkey, unnest([o_custkey, o_orderkey % 1500]) AS key FROM orders)
SELECT o.o_orderkey, coalesce(h.hits, '') AS hits, h.hits IS NOT NULL AS indexed FROM orders o LEFT JOIN (
  SELECT o_orderkey, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS hits FROM k JOIN customer ON key = c_custkey AND c_acctbal > 0 GROUP BY o_orderkey) h USING (o_orderkey)""")
def melted_multi_key_lookup(spark, d):
    orders = t(spark, d, "orders").select("o_orderkey", F.array("o_custkey", F.col("o_orderkey") % 1500).alias("keys"))
    table = t(spark, d, "customer").where("c_acctbal > 0").select("c_custkey", "c_mktsegment")
    hit = joins.melted_lookup(orders, "o_orderkey", F.col("keys"), table, "c_custkey", "c_mktsegment")
    return joins.indexed(hit, "o_orderkey", F.col("keys"), table, "c_custkey", "indexed").select("o_orderkey", F.array_join("hits", ",").alias("hits"), "indexed")


@query("""
SELECT c_custkey, o.o_orderkey AS last_order, o.o_orderstatus AS last_status FROM customer LEFT JOIN (
  SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) o ON c_custkey = o.o_custkey""")
def last_wins_enrichment(spark, d):
    orders = t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("last_order"), F.col("o_orderstatus").alias("last_status"), "o_orderdate")
    last = dedup.last_wins(orders, "c_custkey", F.struct("o_orderdate", "last_order")).drop("o_orderdate")
    return t(spark, d, "customer").select("c_custkey").join(last, "c_custkey", "left")


@query("SELECT doc_id, upper(lang) || '_' || lpad(CAST(row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS VARCHAR), 6, '0') AS sample_id FROM documents")
def sequence_ids(spark, d):
    ranked = numbering.rank_within(t(spark, d, "documents").select("doc_id", "lang"), ["lang"], [F.col("doc_id")], numbering.by_number("doc_id"), "number")
    return ranked.select("doc_id", F.format_string("%s_%06d", F.upper("lang"), "number").alias("sample_id"))


@query("""
WITH s AS (SELECT user_id, event_id AS span_id, ts AS start_ts, ts + INTERVAL 30 MINUTE AS end_ts FROM events WHERE event_type = 'purchase')
SELECT s.span_id, e.event_id FROM s JOIN events e ON s.user_id = e.user_id AND e.ts BETWEEN s.start_ts AND s.end_ts""")
def interval_join(spark, d):
    events = t(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    spans = events.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("span_id"), F.col("ts").alias("start_ts"), (F.col("ts") + F.expr("INTERVAL 30 MINUTES")).alias("end_ts"))
    return joins.interval_join(events, spans, ["user_id"], "ts", "start_ts", "end_ts").select("span_id", "event_id")


@query("""
WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem)
SELECT a.l_orderkey, a.l_linenumber, a.l_partkey, coalesce(string_agg(CAST(b.l_partkey AS VARCHAR), ',' ORDER BY b.l_partkey, b.l_linenumber), '') AS others
FROM l a LEFT JOIN l b ON a.l_orderkey = b.l_orderkey AND a.l_partkey <> b.l_partkey GROUP BY ALL""")
def sibling_nest(spark, d):
    lines = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").distinct()
    out = joins.siblings(lines, ["l_orderkey"], "l_partkey", ["l_partkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(F.transform("others", lambda x: x["l_partkey"].cast("string")), ",").alias("others"))


@query("""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS given, o_custkey % 10 AS line_key FROM orders),
i AS (SELECT l_orderkey, max_by(l_partkey, (l_linenumber, l_partkey)) AS v FROM lineitem GROUP BY 1),
k AS (SELECT l_suppkey % 10 AS line_key, max_by(l_partkey, (l_orderkey, l_linenumber, l_partkey)) AS v FROM lineitem GROUP BY 1)
SELECT o.o_orderkey, coalesce(CASE WHEN given IS NOT NULL THEN i.v ELSE k.v END, -1) AS part FROM o LEFT JOIN i ON o.given = i.l_orderkey LEFT JOIN k USING (line_key)""")
def pair_prefer_explicit(spark, d):
    orders = t(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey")).alias("given"), (F.col("o_custkey") % 10).alias("line_key"))
    lines = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_suppkey") % 10).alias("line_key"))
    out = joins.pair_explicit_first(orders, lines, "given", "l_orderkey", ["line_key"], F.struct("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey")
    return out.select("o_orderkey", F.coalesce("paired_l_partkey", F.lit(-1)).cast("long").alias("part"))


@query("""
SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def anti_semi_cohort(spark, d):
    orders = t(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    customers = t(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return findings.cohort(customers, orders.where("o_orderstatus = 'F'"), orders.where("o_orderpriority = '1-URGENT'"), "c_custkey")


@query("""
WITH s AS (SELECT l_orderkey, l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS score FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER w AS rk, lead(score) OVER w AS runner_up FROM s WINDOW w AS (PARTITION BY l_orderkey ORDER BY score DESC, l_suppkey))
SELECT a.l_orderkey, a.l_suppkey, a.score, coalesce(a.runner_up, -1) AS runner_up, coalesce(a.score = a.runner_up, false) AS tied, c.candidates FROM r a JOIN (
  SELECT l_orderkey, string_agg(l_suppkey || '=' || score, ';' ORDER BY rk) AS candidates FROM r WHERE rk <= 5 GROUP BY 1) c USING (l_orderkey) WHERE rk = 1""")
def top1_tie_detection(spark, d):
    scored = t(spark, d, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.sum("l_quantity").cast("long").alias("score"))
    best = match.best_with_ties(scored, ["l_orderkey"], "score", "l_suppkey")
    return best.withColumn("tied", F.coalesce(F.col("score") == F.col("runner_up"), F.lit(False))).select("l_orderkey", "l_suppkey", "score", F.coalesce("runner_up", F.lit(-1)).cast("long").alias("runner_up"), "tied", "candidates")


@query(r"""
WITH l AS (SELECT doc_id, list_distinct(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '[ \t]+', ' ', 'g'), ' ')),
  lambda x: NOT starts_with(x, '#') AND regexp_matches(x, '[A-Za-z0-9_]'))) AS lines, source, lang FROM documents)
SELECT a.doc_id, b.doc_id AS other_id, CAST(10 * len(list_intersect(a.lines, b.lines)) AS BIGINT) AS score
FROM l a JOIN l b ON a.source = b.source AND a.lang = b.lang AND a.doc_id < b.doc_id WHERE len(list_intersect(a.lines, b.lines)) > 0""")
def line_set_score(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "source", "lang", K.code_lines(F.col("text")).alias("lines"))
    # lines meet by equality and are counted for each pair that shares one
    rows = docs.select("doc_id", "source", "lang", F.explode("lines").alias("line"))
    met = joins.shared_counts(rows, "doc_id", ["source", "lang", "line"], "other_id")
    return met.select("doc_id", "other_id", (10 * F.col("shared")).alias("score"))


@query(r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(text, '[ \n\t]+'), lambda x: x <> '') AS words FROM documents),
c AS (SELECT doc_id, words, unnest(range(0, 1 + CAST(greatest(ceil((len(words) - 64) / 48.0), 0) AS BIGINT))) AS i FROM w WHERE len(words) > 0)
SELECT doc_id, CAST(i + 1 AS BIGINT) AS chunk_index, CAST(i * 48 AS BIGINT) AS token_start, CAST(least(i * 48 + 64, len(words)) AS BIGINT) AS token_end,
       sha256(array_to_string(words[i * 48 + 1:i * 48 + 64], ' ')) AS chunk_sha256 FROM c""")
def overlap_windows(spark, d):
    words = F.filter(F.split("text", r"[ \n\t]+"), lambda x: x != "")
    docs = t(spark, d, "documents").select("doc_id", words.alias("words"))
    made = docs.select("doc_id", "words", F.explode(chunks.windows(F.col("words"), 64, 16)).alias("w"))
    code = F.array_join(F.slice("words", F.col("w.token_start") + 1, 64), " ")
    return made.select("doc_id", *[F.col(f"w.{c}").cast("long").alias(c) for c in ("chunk_index", "token_start", "token_end")], F.sha2(code, 256).alias("chunk_sha256"))


@query("""
WITH p AS (SELECT doc_id, length(d.text) AS n, instr(d.text, b.text) - 1 AS low, instr(d.text, b.text) - 1 + length(b.text) AS high FROM documents d JOIN benchmark b ON contains(d.text, b.text)),
g AS (SELECT DISTINCT doc_id, n FROM p),
c AS (SELECT doc_id, i + 1 AS chunk_index, i * 150 AS s, least(i * 150 + 400, n) AS e FROM g, unnest(range(0, 1 + CAST(greatest(ceil((n - 400) / 150.0), 0) AS BIGINT))) AS u(i)),
f AS (SELECT c.doc_id, c.chunk_index, list_sort(list(low) FILTER (s < high AND low < e)) AS touched, list_sort(list(low) FILTER (s <= low AND high <= e)) AS whole FROM c JOIN p USING (doc_id) GROUP BY ALL)
SELECT doc_id, CAST(chunk_index AS BIGINT) AS chunk_index FROM f a WHERE NOT (coalesce(len(touched), 0) > 0 AND EXISTS (SELECT 1 FROM f b WHERE b.doc_id = a.doc_id AND b.chunk_index <> a.chunk_index
  AND list_has_all(coalesce(b.whole, []), a.touched) AND (coalesce(len(b.whole), 0) > coalesce(len(a.whole), 0) OR (coalesce(len(b.whole), 0) = coalesce(len(a.whole), 0) AND b.chunk_index < a.chunk_index))))""")
def window_region_overlap(spark, d):
    items = joins.small(t(spark, d, "benchmark").select(F.col("text").alias("item")))
    found = t(spark, d, "documents").select("doc_id", "text").join(items, F.col("text").contains(F.col("item")))
    low = F.instr("text", F.col("item")) - 1
    region = F.struct(low.alias("char_start"), (low + F.length("item")).alias("char_end"))
    docs = found.groupBy("doc_id").agg(F.max(F.length("text")).alias("n"), F.collect_set(region).alias("regions"))
    last = F.greatest(F.ceil((F.col("n") - 400) / 150), F.lit(0)).cast("int")
    made = docs.select("doc_id", "regions", "n", F.explode(F.sequence(F.lit(0), last)).alias("i"))
    placed = made.select("doc_id", "regions", (F.col("i") + 1).cast("long").alias("chunk_index"), (F.col("i") * 150).alias("char_start"), F.least(F.col("i") * 150 + 400, "n").alias("char_end"))
    return chunks.prune_dominated(placed, ["doc_id"], "regions").select("doc_id", "chunk_index")


@query("""
WITH p AS (SELECT d.doc_id, text, quality, n_chars FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
s AS (SELECT doc_id, 'before' AS variant, true AS is_vulnerable, text AS code, n_chars AS token_count FROM p UNION ALL
      SELECT doc_id, 'after', false, CASE WHEN quality = 1 THEN text || '!' END, n_chars FROM p)
SELECT doc_id, variant, is_vulnerable, token_count, doc_id || ':' || variant AS model_sample_id, sha256(code) AS code_sha256 FROM s WHERE trim(coalesce(code, '')) <> ''""")
def pair_to_samples(spark, d):
    rows = t(spark, d, "documents").select("doc_id", "text", "n_chars").join(t(spark, d, "labels"), "doc_id")
    pairs = rows.select("doc_id", F.col("text").alias("code_before"), F.when(F.col("quality") == 1, F.concat("text", F.lit("!"))).alias("code_after"), F.col("n_chars").alias("token_count_before"), F.col("n_chars").alias("token_count_after"))
    return samples.pair_to_samples(pairs, ["doc_id"]).drop("code")


_SPLIT = """
WITH g AS (SELECT DISTINCT o_custkey, o_custkey % 7 AS label FROM orders),
r AS (SELECT *, count(*) OVER (PARTITION BY label) AS n, row_number() OVER (PARTITION BY label ORDER BY sha256('42|' || o_custkey), o_custkey) AS rk FROM g),
a AS (SELECT o_custkey, label, CASE WHEN rk <= greatest(1, round_even(n * 0.15, 0)) THEN 'test' WHEN rk <= 2 * greatest(1, round_even(n * 0.15, 0)) THEN 'validation' ELSE 'train' END AS split FROM r)
"""


def _split(spark, d):
    groups = t(spark, d, "orders").select("o_custkey", (F.col("o_custkey") % 7).alias("label"))
    return splits.allocate_groups(groups, "label", "o_custkey")


@query(_SPLIT + "SELECT o_custkey, label, split FROM a")
def group_split(spark, d):
    return _split(spark, d)


@query(_SPLIT + """SELECT split, label, CAST(count(*) AS BIGINT) AS samples, CAST(count(DISTINCT o_custkey) AS BIGINT) AS commit_groups, CAST(count(DISTINCT o_orderstatus) AS BIGINT) AS repositories
FROM orders JOIN a USING (o_custkey) GROUP BY split, label""")
def split_summary(spark, d):
    rows = t(spark, d, "orders").select("o_custkey", "o_orderstatus").join(_split(spark, d), "o_custkey")
    return summaries.split_summary(rows, "label", "o_custkey", "o_orderstatus")


@query(_SPLIT + "SELECT 'none' AS violation, 'none' AS detail WHERE false")
def split_invariants(spark, d):
    rows = t(spark, d, "orders").select("o_custkey").join(_split(spark, d), "o_custkey").withColumn("label", F.col("label").cast("string"))
    return splits.split_violations(rows, "o_custkey", "label", [str(i) for i in range(7)])


@query("""
WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('42|' || doc_id), doc_id) AS rk FROM documents)
SELECT doc_id, lang FROM r ORDER BY rk, lang LIMIT 100""")
def stratified_cap(spark, d):
    return splits.stratified_cap(t(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id", 100)


@query("""
WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY sha256('42|' || doc_id), doc_id) AS rk, count(*) OVER (PARTITION BY quality) AS n FROM labels)
SELECT doc_id, quality, CASE WHEN rk <= floor(floor(n * 0.8) * 0.8) THEN 'train' WHEN rk <= floor(n * 0.8) THEN 'validation' ELSE 'test' END AS split FROM r""")
def nested_ratio_split(spark, d):
    return splits.nested_ratio(t(spark, d, "labels").select("doc_id", "quality"), "quality", "doc_id")


_FINDINGS = f"(VALUES {', '.join(f"({i}, '{c}', '{n}', '{w}')" for i, (c, n, w) in enumerate(FINDINGS))}) AS f(ord, code, name, cwes)"


@query(f"""
WITH h AS (SELECT event_id, ord, code, cwes FROM events JOIN {_FINDINGS} ON contains(event_type, name) QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ord) = 1)
SELECT code, cwe, CAST(count(*) AS BIGINT) AS n FROM (SELECT code, unnest(string_split(cwes, ',')) AS cwe FROM h) GROUP BY code, cwe""")
def rule_dim_match(spark, d):
    table = spark.createDataFrame([(i, *f) for i, f in enumerate(FINDINGS)], "ord int, code string, name string, cwes string")
    hits = joins.first_contained(t(spark, d, "events").select("event_id", "event_type"), "event_type", table, "name", "ord")
    return hits.select("code", F.explode(F.split("cwes", ",")).alias("cwe")).groupBy("code", "cwe").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH x AS (SELECT quality = 1 AS tr, CASE WHEN n_chars % 50 = 0 THEN NULL ELSE n_chars > 1000 END AS p FROM documents JOIN labels USING (doc_id)),
c AS (SELECT count(*) FILTER (tr AND p) AS tp, count(*) FILTER (NOT tr AND p) AS fp, count(*) FILTER (NOT tr AND NOT p) AS tn, count(*) FILTER (tr AND NOT p) AS fn, count(*) FILTER (p IS NULL) AS invalid FROM x)
SELECT tp, fp, tn, fn, invalid, (tp + tn) / (tp + fp + tn + fn) AS accuracy, tp / (tp + fp) AS "precision", tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1 FROM c""")
def confusion_metrics(spark, d):
    rows = t(spark, d, "documents").select("doc_id", "n_chars").join(t(spark, d, "labels"), "doc_id")
    said = F.when(F.col("n_chars") % 50 != 0, F.col("n_chars") > 1000)
    return metrics.binary(rows.select((F.col("quality") == 1).alias("truth"), said.alias("said")), "truth", "said")


@query("""
WITH x AS (SELECT label AS tr, CAST(vec_id % 11 AS INTEGER) AS p FROM embeddings), l AS (SELECT CAST(range AS INTEGER) AS label FROM range(0, 12)),
s AS (SELECT l.label, (SELECT count(*) FROM x WHERE tr = l.label AND p = l.label) AS tp, (SELECT count(*) FROM x WHERE tr = l.label) AS support, (SELECT count(*) FROM x WHERE p = l.label) AS found FROM l),
k AS (SELECT count(*) AS n FROM x)
SELECT label, coalesce(tp / nullif(found, 0), 0.0) AS "precision", coalesce(tp / nullif(support, 0), 0.0) AS recall, coalesce(2 * tp / nullif(found + support, 0), 0.0) AS f1, support,
       n / (12 * greatest(support, 1)) AS weight FROM s, k""")
def multiclass_metrics(spark, d):
    rows = t(spark, d, "embeddings").select("label", (F.col("vec_id") % 11).cast("int").alias("said"))
    dim = spark.range(12).select(F.col("id").cast("int").alias("label"))
    return metrics.multiclass(rows, "label", "said", dim).join(metrics.class_weights(rows, "label", dim), "label")


@query("""
WITH b AS (SELECT l_orderkey, CASE WHEN count(*) = 1 THEN 'single' ELSE 'multi' END AS bucket, count(*) AS n FROM lineitem GROUP BY 1)
SELECT bucket, CAST(count(*) AS BIGINT) AS orders, CAST(sum(n) AS BIGINT) AS lines FROM b GROUP BY bucket""")
def size_bucket_groups(spark, d):
    return joins.group_buckets(t(spark, d, "lineitem"), ["l_orderkey"]).groupBy("bucket").agg(F.count(F.lit(1)).alias("orders"), F.sum("n").alias("lines"))


@query("""
WITH a AS (SELECT conv_id, turn, CASE WHEN turn % 6 < 5 THEN turn % 6 END AS n FROM conversations)
SELECT conv_id, turn, CAST(coalesce(n, -1) AS INTEGER) AS answer, CASE WHEN n BETWEEN 1 AND 4 THEN 'answer_' || n ELSE 'invalid' END AS route FROM a""")
def answer_parse_route(spark, d):
    digit = (F.col("turn") % 6).cast("string")
    said = F.when(F.col("turn") % 6 == 5, "no answer").when(F.col("turn") % 2 == 0, F.concat(F.lit('{"answer": '), digit, F.lit("}"))).otherwise(F.concat(F.lit("{'answer' :"), digit, F.lit("}")))
    rows = t(spark, d, "conversations").select("conv_id", "turn", triage.answer(said).alias("answer"))
    return rows.withColumn("route", triage.route(F.col("answer"))).withColumn("answer", F.coalesce("answer", F.lit(-1)))


@query("""
SELECT conv_id, turn, sha256('system:You review code.|user:' || text) AS messages_sha256 FROM conversations WHERE role = 'user'""")
def chat_messages(spark, d):
    messages = triage.chat("You review code.", F.col("text"))
    flat = F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "|")
    return t(spark, d, "conversations").where("role = 'user'").select("conv_id", "turn", F.sha2(flat, 256).alias("messages_sha256"))


@query(r"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '(?i)(password|secret|token|api[_-]?key)[A-Za-z_]*\s*[=:]\s*["'']?[A-Za-z0-9_\-]{3,}')) AS BIGINT) AS found FROM documents""")
def credential_literals(spark, d):
    shape = r"""(?i)(password|secret|token|api[_-]?key)[A-Za-z_]*\s*[=:]\s*["']?[A-Za-z0-9_\-]{3,}"""
    return t(spark, d, "documents").select("doc_id", F.size(F.regexp_extract_all("text", F.lit(shape), F.lit(0))).cast("long").alias("found"))


@query("""
WITH s AS (SELECT count(*) AS samples, count(DISTINCT source) AS sources, count(*) FILTER (lang = 'en') AS english FROM documents)
SELECT metric, CAST(value AS BIGINT) AS value FROM (SELECT * FROM s UNPIVOT (value FOR metric IN (samples, sources, english)))""")
def unpivot_summary(spark, d):
    one = t(spark, d, "documents").agg(F.count(F.lit(1)).alias("samples"), F.count_distinct("source").alias("sources"), F.count_if(F.col("lang") == "en").alias("english"))
    return summaries.metric_table(one, ["samples", "sources", "english"])


@query("""
SELECT 'both' AS part, n FROM (SELECT c_nationkey AS n FROM customer WHERE c_acctbal > 9000 INTERSECT SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'customer_only', n FROM (SELECT c_nationkey AS n FROM customer WHERE c_acctbal > 9000 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
UNION ALL SELECT 'bag', s_nationkey FROM supplier UNION ALL SELECT 'bag', n_nationkey FROM nation""")
def set_ops(spark, d):
    rich = t(spark, d, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("n"))
    suppliers = t(spark, d, "supplier").select(F.col("s_nationkey").alias("n"), "s_acctbal")
    nations = t(spark, d, "nation").select(F.col("n_nationkey").alias("n"))
    both, only = rich.intersect(suppliers.select("n")), rich.subtract(suppliers.where("s_acctbal > 5000").select("n"))
    bag = samples.union_in_order([suppliers.select("n"), nations]).select(F.lit("bag").alias("part"), "n")
    return both.select(F.lit("both").alias("part"), "n").unionByName(only.select(F.lit("customer_only").alias("part"), "n")).unionByName(bag)


from patchloom.plans import registry_code, registry_joins  # noqa: E402, F401  they register more queries
