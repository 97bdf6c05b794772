"""Queries of scans, report projections and the remaining filters, joins and set operations. Lines of sources and mapping records are
derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from changelens.functions import records as R
from changelens.functions import text as X
from changelens.operators import contracts, decisions, evidence, relational, scans
from changelens.plans.more import _relations, _states
from changelens.plans.queries import _SCORED, ORACLE_SQL, _evidence, query

c = F.col


def text_of(*parts):
    return F.concat(*(p if not isinstance(p, str) else F.lit(p) for p in parts))


def pick(number, *values):
    """The value at number modulo their count."""
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


@query("f3_equality", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'")
def f3(t):
    return t("orders").where("o_orderstatus = 'O'").select("o_orderkey")


@query("f5_all_targets_exist", "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size >= 8))")
def f5(t):
    targets = t("lineitem").select(c("l_orderkey").alias("o_orderkey"), c("l_partkey").alias("p_partkey"))
    return relational.all_exist(t("orders").select("o_orderkey"), targets, ["o_orderkey"], "p_partkey", t("part").where("p_size >= 8"))


@query("f12_runtime_changes", """SELECT conv_id, count(*) AS n FROM (SELECT conv_id, CASE turn % 3 WHEN 0 THEN '   ' WHEN 1 THEN ' # ' || role ELSE role || '()' END AS line FROM conversations)
WHERE conv_id % 3 = 0 OR (trim(line) <> '' AND NOT starts_with(ltrim(line), '#')) GROUP BY 1""")
def f12(t):
    line = F.when(c("turn") % 3 == 0, "   ").when(c("turn") % 3 == 1, text_of(" # ", c("role"))).otherwise(text_of(c("role"), "()"))
    path = text_of(c("conv_id").cast("string"), F.when(c("conv_id") % 3 == 0, ".md").otherwise(".py"))
    return t("conversations").where(scans.changes_running_code(path, line)).groupBy("conv_id").agg(F.count("*").alias("n"))


@query("f13_prefix", "SELECT p_partkey FROM part WHERE starts_with(p_type, 'S')")
def f13(t):
    return t("part").where(c("p_type").startswith("S")).select("p_partkey")


@query("f14_exact_profile", "SELECT ['override','same_name_protocol','call','monkey_patch'][l_linenumber % 4 + 1] AS relation, count(*) AS n FROM lineitem WHERE l_linenumber % 4 <> 3 AND l_linestatus = 'F' GROUP BY 1")
def f14(t):
    return scans.of_profile(_relations(t), "relation", "relationship_verified", True, ("monkey_patch",)).groupBy("relation").agg(F.count("*").alias("n"))


@query("f15_core_threshold", f"SELECT l_partkey, count(*) AS n FROM ({_SCORED}) WHERE core AND score >= 50 GROUP BY 1")
def f15(t):
    return _evidence(t).where("core AND score >= 50").groupBy("l_partkey").agg(F.count("*").alias("n"))


@query("f16_introduced_breaks", "SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag <> 'R' AND NOT l_quantity < 30 AND l_partkey IS NOT NULL")
def f16(t):
    found = t("lineitem").where(contracts.range_class(c("l_returnflag") != "R", c("l_quantity") < 30) == "introduced_break")
    return found.select("l_partkey").where("l_partkey IS NOT NULL").distinct()


@query("j5_last_finding", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def j5(t):
    last = t("orders").groupBy(c("o_custkey").alias("c_custkey")).agg(F.max("o_orderkey").alias("o_orderkey"))
    return t("customer").select("c_custkey").join(last, "c_custkey", "left")


@query("j7_module_prefix", """WITH m AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^?#]*)', 1) AS module FROM pages)
SELECT page_id FROM m WHERE EXISTS (SELECT 1 FROM m k WHERE k.page_id % 7 = 0 AND starts_with(m.module || '/', regexp_replace(k.module, '/[^/]*$', '') || '/'))""")
def j7(t):
    pages = t("pages").select("page_id", F.regexp_extract("url", "^[a-z]+://([^?#]*)", 1).alias("module"))
    keys = pages.where("page_id % 7 = 0").select(F.regexp_replace("module", "/[^/]*$", "").alias("key"))
    return relational.under_paths(pages, "module", keys, "key").select("page_id")


@query("j9_module_files", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'm' || p_partkey || '.py' WHEN p_size % 2 = 0 THEN 'm' || p_partkey || '/__init__.py' END AS file FROM part")
def j9(t):
    names = t("part").select("p_partkey", "p_size", text_of("m", c("p_partkey").cast("string")).alias("module"))
    tree = names.where("p_size % 3 = 0").select(text_of(c("module"), ".py").alias("path")).union(names.where("p_size % 2 = 0").select(text_of(c("module"), "/__init__.py")))
    return relational.first_match(names, "module", F.array(text_of(c("module"), ".py"), text_of(c("module"), "/__init__.py")), tree).select("p_partkey", "file")


@query("j10_missing_overrides", """
WITH down AS (SELECT DISTINCT 'S' || s_suppkey AS class, 'N' || s_nationkey AS base, 'm' || x AS method FROM (SELECT *, unnest([s_suppkey % 5, s_suppkey % 7]) AS x FROM supplier))
SELECT class, base, method FROM down d WHERE EXISTS (SELECT 1 FROM customer WHERE 'N' || c_nationkey = base AND 'm' || (c_custkey % 6) = method)
  AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey % 4 = 0 AND 'S' || s_suppkey = class AND 'm' || (s_suppkey % 5) = method)""")
def j10(t):
    class_, method = text_of("S", c("s_suppkey").cast("string")).alias("class"), lambda x: text_of("m", x.cast("string")).alias("method")
    down = t("supplier").select(class_, text_of("N", c("s_nationkey").cast("string")).alias("base"), F.explode(F.array(c("s_suppkey") % 5, c("s_suppkey") % 7)).alias("x")).select("class", "base", method(c("x")))
    up = t("customer").select(text_of("N", c("c_nationkey").cast("string")).alias("class"), method(c("c_custkey") % 6))
    return scans.missing_overrides(down, up, t("supplier").where("s_suppkey % 4 = 0").select(class_, method(c("s_suppkey") % 5)))


@query("j13_rename_aware", "SELECT p_partkey, CASE WHEN p_size < 25 THEN 'f' || p_partkey WHEN p_size <= 40 THEN 'g' || p_partkey END AS resolved FROM part")
def j13(t):
    rows = t("part").select("p_partkey", "p_size", text_of("f", c("p_partkey").cast("string")).alias("file"))
    renames = rows.where("p_size BETWEEN 25 AND 40").select(c("file").alias("old"), text_of("g", c("p_partkey").cast("string")).alias("new"))
    return relational.rename_aware(rows, "file", rows.where("p_size < 25").select(c("file").alias("path")), renames).select("p_partkey", "resolved")


@query("a6_change_totals", "SELECT l_orderkey, CAST(sum(l_linenumber) AS BIGINT) AS additions, count(*) AS files FROM lineitem GROUP BY 1")
def a6(t):
    return t("lineitem").groupBy("l_orderkey").agg(F.sum("l_linenumber").alias("additions"), F.count("*").alias("files"))


@query("a7_thread_totals", "SELECT conv_id, count(*) AS comments, CAST(sum(coalesce(length(text), 0)) AS BIGINT) AS characters FROM conversations GROUP BY 1")
def a7(t):
    return t("conversations").groupBy("conv_id").agg(F.count("*").alias("comments"), F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("characters"))


@query("a11_keyword_union", """SELECT user_id, list(word ORDER BY place) AS words FROM (SELECT user_id, word, min(place) AS place FROM (SELECT user_id, event_type AS word, event_id * 2 AS place FROM events
  UNION ALL SELECT user_id, CASE WHEN value > 100 THEN 'big' ELSE 'small' END, event_id * 2 + 1 FROM events) GROUP BY 1, 2) GROUP BY 1""")
def a11(t):
    words = t("events").select("user_id", "event_id", F.posexplode(F.array("event_type", F.when(c("value") > 100, "big").otherwise("small"))).alias("pos", "word"))
    return relational.occurrences(words.withColumn("at", c("event_id") * 2 + c("pos")), ["user_id"], "at", "word").select("user_id", c("values").alias("words"))


@query("a13_first_with_count", "SELECT o_custkey, o_orderstatus, min(o_orderkey) AS o_orderkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority, count(*) AS duplicates FROM orders GROUP BY 1, 2")
def a13(t):
    return t("orders").groupBy("o_custkey", "o_orderstatus").agg(F.min("o_orderkey").alias("o_orderkey"), F.min_by("o_orderpriority", "o_orderkey").alias("o_orderpriority"), F.count("*").alias("duplicates"))


@query("a17_joined_text", "SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, '/' ORDER BY c_mktsegment) AS segments FROM customer GROUP BY 1")
def a17(t):
    return t("customer").groupBy("c_nationkey").agg(F.array_join(F.array_sort(F.collect_set("c_mktsegment")), "/").alias("segments"))


@query("w6_three_examples", "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn <= 3")
def w6(t):
    return relational.top_with_rest(t("events").select("user_id", "ts", "event_id"), ["user_id"], [c("ts"), c("event_id")], 3).select("user_id", "event_id")


@query("w7_row_parity", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) % 2 = 0 AS shaded FROM orders")
def w7(t):
    from pyspark.sql import Window

    return t("orders").select("o_orderkey", (F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) % 2 == 0).alias("shaded"))


@query("o2_report_order", "SELECT o_orderkey, o_orderpriority, o_orderdate FROM orders ORDER BY coalesce(o_orderpriority, ''), o_orderdate, o_orderkey")
def o2(t):
    return relational.report_order(t("orders").select("o_orderkey", "o_orderpriority", "o_orderdate"), "o_orderpriority", "o_orderdate", "o_orderkey")


@query("o9_first_in_order", "SELECT o_orderkey, o_custkey, (SELECT count(*) FROM orders) > 200 AS truncated FROM orders ORDER BY o_custkey, o_orderkey LIMIT 200")
def o9(t):
    return relational.first_in_order(t("orders").select("o_orderkey", "o_custkey"), [c("o_custkey"), c("o_orderkey")], 200)


@query("u2_engines", """SELECT coalesce(a.k, b.k) AS l_partkey, CASE WHEN a.k IS NULL THEN 'legacy' WHEN b.k IS NULL THEN 'new' ELSE 'common' END AS engine
FROM (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity > 45) a FULL JOIN (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity > 40 AND l_returnflag = 'R') b ON a.k = b.k""")
def u2(t):
    sides = relational.hits_misses_extras(t("lineitem").where("l_quantity > 45"), t("lineitem").where("l_quantity > 40 AND l_returnflag = 'R'"), "l_partkey")
    return sides.select("l_partkey", R.looked_up(c("side"), {"hit": "common", "miss": "legacy", "extra": "new"}).alias("engine"))


@query("u3_equal_sets", "SELECT (SELECT count(*) FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem)) + (SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)) = 0 AS same")
def u3(t):
    return relational.coverage(t("part").select("p_partkey"), t("lineitem").select(c("l_partkey").alias("p_partkey")), "p_partkey").agg((F.count("*") == 0).alias("same"))


@query("u4_not_a_subset", "SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def u4(t):
    return t("lineitem").select("l_suppkey").distinct().join(t("supplier").where("s_acctbal > 0").select(c("s_suppkey").alias("l_suppkey")), "l_suppkey", "left_anti")


@query("u6_distinct_in_order", "WITH s AS (SELECT page_id, string_split(url, '/') AS w FROM pages) SELECT page_id, array_to_string(list_filter(w, lambda x, i: list_position(w, x) = i), '/') AS parts FROM s")
def u6(t):
    return t("pages").select("page_id", F.array_join(F.array_distinct(F.split("url", "/")), "/").alias("parts"))


@query("c19_proximity", """SELECT user_id, CASE WHEN bool_or(value > 200) THEN 'exact' WHEN bool_or(value > 120) THEN 'near' WHEN bool_or(event_type = 'click') THEN 'file' ELSE 'none' END AS proximity FROM events GROUP BY 1""")
def c19(t):
    return t("events").groupBy("user_id").agg(R.best_label([("exact", c("value") > 200), ("near", c("value") > 120), ("file", c("event_type") == "click")], "none").alias("proximity"))


@query("d14_touched_tokens", r"""
WITH r AS (SELECT p_partkey AS id, p_size AS file, CASE p_partkey % 3 WHEN 0 THEN [] WHEN 1 THEN ['alpha' || (p_size % 2)] ELSE ['a.b', 'zeta', '+'] END AS tokens FROM part),
l AS (SELECT s_suppkey % 51 AS file, CASE s_suppkey % 3 WHEN 0 THEN 'x = alpha0 - 1' WHEN 1 THEN 'call(a.b)' ELSE 'alpha12 zeta_' END AS line FROM supplier)
SELECT id, len(tokens) = 0 OR EXISTS (SELECT 1 FROM l JOIN (SELECT id AS i, unnest(tokens) AS token FROM r) k ON k.i = r.id WHERE l.file = r.file
  AND regexp_matches(l.line, '(^|[^A-Za-z0-9_])' || replace(replace(token, '.', '\.'), '+', '\+') || '([^A-Za-z0-9_]|$)')) AS touched FROM r""")
def d14(t):
    none, one, many = F.array().cast("array<string>"), F.array(text_of("alpha", (c("p_size") % 2).cast("string"))), F.array(*map(F.lit, ("a.b", "zeta", "+")))
    records = t("part").select(c("p_partkey").alias("id"), c("p_size").cast("long").alias("file"), F.when(c("p_partkey") % 3 == 0, none).when(c("p_partkey") % 3 == 1, one).otherwise(many).alias("tokens"))
    lines = t("supplier").select((c("s_suppkey") % 51).alias("file"), pick(c("s_suppkey"), "x = alpha0 - 1", "call(a.b)", "alpha12 zeta_").alias("line"))
    return scans.touched_by_tokens(records, lines)


@query("d15_version_guards", """
WITH l AS (SELECT p_partkey AS pos, CASE WHEN p_size % 5 = 0 THEN 'other/' ELSE 'core/' END || p_size AS path, ['  if version_is("1.2.0"):','# since v1.2.0','version_is("1.3.0")','x = "1.2.0"'][p_partkey % 4 + 1] AS line FROM part),
f AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY pos) AS n FROM l WHERE starts_with(path, 'core/') AND contains(line, '1.2.0') AND (contains(line, 'version_is') OR contains(line, 'v1.2.0')))
SELECT path, list(trim(line) ORDER BY n) AS examples FROM f WHERE n <= 3 GROUP BY 1""")
def d15(t):
    line = pick(c("p_partkey"), '  if version_is("1.2.0"):', "# since v1.2.0", 'version_is("1.3.0")', 'x = "1.2.0"')
    path = text_of(F.when(c("p_size") % 5 == 0, "other/").otherwise("core/"), c("p_size").cast("string"))
    return scans.version_guards(t("part").select(path.alias("path"), c("p_partkey").alias("pos"), line.alias("line")), "v1.2.0", "v1.3.0", "version_is", "core/")


@query("d17_stale_endpoints", """
WITH lost AS (SELECT o_orderkey AS id, list(CAST(target AS VARCHAR) ORDER BY pos) AS missing FROM (SELECT o_orderkey, unnest([o_orderkey % 50, o_orderkey % 77 + 100, o_orderkey % 31 + 60]) AS target, unnest([1, 2, 3]) AS pos FROM orders)
  WHERE target NOT IN (SELECT p_partkey FROM part WHERE p_size > 5) GROUP BY 1)
SELECT o_orderkey AS id, o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AS upstream_missing, coalesce(missing, []) AS missing FROM orders LEFT JOIN lost ON id = o_orderkey
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) OR missing IS NOT NULL""")
def d17(t):
    key = c("o_orderkey")
    targets = F.array(key % 50, key % 77 + 100, key % 31 + 60).cast("array<string>")
    records = t("orders").select(key.alias("id"), c("o_custkey").cast("string").alias("file"), targets.alias("targets"))
    return scans.stale_endpoints(records, t("customer").where("c_acctbal > 0").select(c("c_custkey").cast("string").alias("path")), t("part").where("p_size > 5").select(c("p_partkey").cast("string").alias("path")))


@query("g4_patched_contracts", """
WITH RECURSIVE reach AS (SELECT p_partkey AS start, p_partkey AS node, 0 AS hops FROM part WHERE p_size = 50 UNION SELECT r.start, p_partkey, r.hops + 1 FROM reach r JOIN part ON (p_partkey + 1) // 3 = r.node AND p_partkey > r.node),
twins AS (SELECT l_partkey AS node, min(l_suppkey) AS upstream FROM lineitem WHERE l_quantity > 45 GROUP BY 1 HAVING count(DISTINCT l_suppkey) = 1)
SELECT start, upstream, min(hops) AS hops FROM reach JOIN twins USING (node) WHERE upstream IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY 1, 2""")
def g4(t):
    parent = F.floor((c("p_partkey") + 1) / 3)
    calls = t("part").select(parent.alias("src"), c("p_partkey").alias("dst")).where("dst > src")
    twins = t("lineitem").where("l_quantity > 45").select(c("l_partkey").alias("node"), c("l_suppkey").alias("upstream"))
    return scans.patched_contracts(t("part").where("p_size = 50").select(c("p_partkey").alias("node")), calls, twins, t("supplier").where("s_acctbal > 0").select(c("s_suppkey").alias("upstream")))


@query("v7_strict_verdict", f"SELECT count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings, count(*) = 0 AS passed FROM ({ORACLE_SQL['v4_bugfix_matrix']})")
def v7(t):
    found = evidence.violations(_states(t), "id", decisions.bugfix_rules(c("conclusion"), c("source"), c("repair"), c("equivalent"), c("lane"), c("evidence")))
    return found.agg(F.count_if(c("severity") == "error").alias("errors"), F.count_if(c("severity") == "warning").alias("warnings"), (F.count("*") == 0).alias("passed"))


@query("v11_golden_cells", """
WITH a AS (SELECT o_custkey AS ref, o_orderstatus AS value FROM orders), b AS (SELECT o_custkey AS ref, CASE WHEN o_orderpriority = '1-URGENT' THEN 'F' ELSE o_orderstatus END AS value FROM orders)
(SELECT *, 'missing' AS side FROM (FROM a EXCEPT ALL FROM b)) UNION ALL (SELECT *, 'extra' FROM (FROM b EXCEPT ALL FROM a))""")
def v11(t):
    cells = lambda value: t("orders").select(c("o_custkey").alias("ref"), value.alias("value"))
    return relational.one_sided(cells(c("o_orderstatus")), cells(F.when(c("o_orderpriority") == "1-URGENT", "F").otherwise(c("o_orderstatus"))))


@query("v12_manifest", """SELECT CASE WHEN page_id % 11 = 0 THEN '../' ELSE '' END || page_id AS path, CASE WHEN page_id % 11 = 0 THEN 'outside' WHEN page_id % 5 = 0 THEN 'absent' ELSE 'differs' END AS problem
FROM pages WHERE page_id % 11 = 0 OR page_id % 5 = 0 OR page_id % 7 = 0""")
def v12(t):
    name = c("page_id").cast("string")
    found = t("pages").where("page_id % 5 <> 0").select(name.alias("path"), F.sha2("html", 256).alias("sha256"))
    said = t("pages").select(text_of(F.when(c("page_id") % 11 == 0, "../").otherwise(""), name).alias("path"), F.sha2(F.when(c("page_id") % 7 == 0, text_of(c("html"), "!")).otherwise(c("html")), 256).alias("sha256"))
    return relational.manifest_problems(said, found)


@query("v17_benefits", """SELECT CASE WHEN l_returnflag = 'R' OR l_partkey % 3 = 1 THEN '当前不适用' WHEN l_suppkey % 3 = 0 THEN '理论直接继承' WHEN l_orderkey % 3 = 0 THEN '当前不适用'
  WHEN l_partkey % 3 = 0 AND l_suppkey % 3 = 1 AND l_orderkey % 3 = 1 AND l_linenumber % 3 = 0 THEN '需要适配' ELSE '待POC' END AS benefit, count(*) AS n FROM lineitem GROUP BY 1""")
def v17(t):
    three = (decisions.YES, decisions.NO, decisions.UNKNOWN)
    benefit = decisions.benefit_of(c("l_returnflag") == "R", pick(c("l_partkey"), *three), pick(c("l_suppkey"), *three), pick(c("l_orderkey"), *three), pick(c("l_linenumber"), *three))
    return t("lineitem").groupBy(benefit.alias("benefit")).agg(F.count("*").alias("n"))


@query("p1_filled_fields", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, '' AS owner FROM documents")
def p1(t):
    return R.filled(t("documents"), ["doc_id", "lang", "source", "owner"])


@query("p2_conditional_fields", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS priority, CASE WHEN o_orderstatus <> 'O' AND o_orderpriority = '1-URGENT' THEN 'exact' END AS review FROM orders")
def p2(t):
    route, priority = c("o_orderstatus"), c("o_orderpriority")
    return t("orders").select("o_orderkey", F.when(route == "O", priority).alias("priority"), F.when((route != "O") & (priority == "1-URGENT"), "exact").alias("review"))


@query("p3_derived_fields", "SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'first' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'later' END AS status, CASE o_orderstatus WHEN 'F' THEN 'S' WHEN 'O' THEN 'M' ELSE 'L' END AS effort FROM orders")
def p3(t):
    status = F.when(c("o_orderpriority").isin("1-URGENT", "2-HIGH"), "first").when(c("o_orderstatus") == "O", "open").otherwise("later")
    return t("orders").select("o_orderkey", status.alias("status"), R.looked_up(c("o_orderstatus"), {"F": "S", "O": "M"}, "L").alias("effort"))


@query("p4_overridden_flags", "SELECT p_partkey, coalesce(CASE WHEN p_size % 4 = 0 THEN 'given' END, CASE p_brand WHEN 'Brand#11' THEN 'yes' WHEN 'Brand#12' THEN 'no' ELSE 'unknown' END) AS flag FROM part")
def p4(t):
    return t("part").select("p_partkey", R.overridden(F.when(c("p_size") % 4 == 0, "given"), c("p_brand"), {"Brand#11": "yes", "Brand#12": "no"}, "unknown").alias("flag"))


@query("p5_substring_flags", "SELECT p_partkey, contains(p_name, 'ring') OR contains(p_name, 'old') AS worn FROM part")
def p5(t):
    return t("part").select("p_partkey", (c("p_name").contains("ring") | c("p_name").contains("old")).alias("worn"))


@query("p7_commit_records", """SELECT o_orderkey, o_orderpriority || ' (#' || o_orderkey || ')' || chr(10) || chr(10) || o_orderstatus AS message, lower(o_orderstatus) AS status, coalesce(files, 0) AS files, coalesce(additions, 0) AS additions
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS files, CAST(sum(l_linenumber) AS BIGINT) AS additions FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def p7(t):
    sums = a6(t).withColumnRenamed("l_orderkey", "o_orderkey")
    message = text_of(c("o_orderpriority"), " (#", c("o_orderkey").cast("string"), ")\n\n", c("o_orderstatus"))
    rows = t("orders").select("o_orderkey", message.alias("message"), F.lower("o_orderstatus").alias("status")).join(sums, "o_orderkey", "left")
    return rows.fillna(0, ["files", "additions"])


@query("p1_date_or_text", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'soon' ELSE strftime(ts, '%Y-%m-%d') END AS day FROM events")
def p1_date(t):
    text = F.when(c("event_id") % 3 == 0, "soon").otherwise(F.date_format(c("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss"))
    return t("events").select("event_id", R.date_or_text(text).alias("day"))


@query("c10_name_parts", "SELECT page_id, string_split(url, '/')[-1] AS last, string_split(url, '/')[1] AS first FROM pages")
def c10(t):
    return t("pages").select("page_id", X.last_part(c("url"), "/").alias("last"), F.split_part("url", F.lit("/"), F.lit(1)).alias("first"))
