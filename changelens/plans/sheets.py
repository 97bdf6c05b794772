"""Queries that fill the list sheets of a report, and rules of whole records. Orders stand for change records, their lines for reviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from changelens.functions import records as R
from changelens.operators import decisions, evidence, mappings
from changelens.plans.queries import query
from changelens.sources import files

c = F.col


def _pick(key, *texts):
    return F.element_at(F.array(*map(F.lit, texts)), (key % len(texts) + 1).cast("int"))


def _reviewed(t):
    """Orders with what their lines say, as reviews of a record."""
    lines = t("lineitem").groupBy(c("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_reviews"), F.count_if(c("l_returnflag") == "R").alias("n_requests"), F.array_sort(F.collect_set("l_linestatus")).alias("states"), F.max("l_shipdate").alias("last"))
    return t("orders").join(lines, "o_orderkey", "left").withColumn("number", F.concat(F.lit("#"), "o_orderkey"))


_REVIEWED = """(SELECT *, '#' || o_orderkey AS number FROM orders LEFT JOIN (SELECT l_orderkey AS o_orderkey, count(*) AS n_reviews, count(*) FILTER (l_returnflag = 'R') AS n_requests,
  string_agg(DISTINCT l_linestatus, '; ' ORDER BY l_linestatus) AS states, max(l_shipdate) AS last FROM lineitem GROUP BY 1) USING (o_orderkey))"""


@query("p8_skip_sheet", f"SELECT number AS record, strftime(o_orderdate, '%Y-%m-%d') AS merged, o_orderpriority AS category, CASE WHEN o_custkey % 2 = 0 THEN 'no such path here' ELSE 'other hardware' END AS reason, 'keep the method, try it by itself' AS borrow FROM {_REVIEWED} WHERE o_orderstatus = 'P'")
def p8_skip(t):
    rows = _reviewed(t).where("o_orderstatus = 'P'")
    return R.sheet(rows, {"record": "number", "merged": "o_orderdate", "category": "o_orderpriority", "reason": _pick(c("o_custkey"), "no such path here", "other hardware"), "borrow": F.coalesce(F.lit(None).cast("string"), F.lit("keep the method, try it by itself"))})


@query("p8_exact_review_sheet", f"SELECT number AS record, o_orderpriority || ' / ' || o_orderstatus AS conclusion, coalesce(states, '') AS bindings, CASE WHEN n_requests > 0 THEN 'a break is known' WHEN n_reviews > 0 THEN 'none found' ELSE 'not scanned' END AS breaks FROM {_REVIEWED} WHERE o_totalprice > 100000")
def p8_exact(t):
    breaks = R.decided([(c("n_requests") > 0, "a break is known"), (c("n_reviews") > 0, "none found")], "not scanned")
    return R.sheet(_reviewed(t).where("o_totalprice > 100000"), {"record": "number", "conclusion": F.concat_ws(" / ", "o_orderpriority", "o_orderstatus"), "bindings": "states", "breaks": breaks})


@query("p8_test_sheet", f"SELECT number AS record, 'a batch of ' || (o_custkey % 64) || ' on one node' AS conditions, CASE WHEN o_custkey % 3 = 0 THEN 'faster by ' || (o_custkey % 9) ELSE 'no figures given' END AS result, '' AS metric FROM {_REVIEWED} WHERE o_orderstatus = 'O'")
def p8_tests(t):
    result = F.when(c("o_custkey") % 3 == 0, F.concat(F.lit("faster by "), c("o_custkey") % 9))
    conditions = F.concat(F.lit("a batch of "), c("o_custkey") % 64, F.lit(" on one node"))
    return R.sheet(_reviewed(t).where("o_orderstatus = 'O'"), {"record": "number", "conditions": conditions, "result": F.coalesce(result, F.lit("no figures given")), "metric": "no_such_column"})


@query("p8_evidence_sheet", f"SELECT number AS record, coalesce(CAST(n_reviews AS VARCHAR), '') AS reviews, coalesce(CAST(n_requests AS VARCHAR), '') AS requests, coalesce(states, '') AS states, coalesce(strftime(last, '%Y-%m-%d'), '') AS last FROM {_REVIEWED}")
def p8_evidence(t):
    return R.sheet(_reviewed(t), {"record": "number", "reviews": "n_reviews", "requests": "n_requests", "states": "states", "last": "last"})


@query("p8_bugfix_sheet", f"SELECT number AS record, ['crash','wrong result','leak'][o_custkey % 3 + 1] AS category, ['yes','no','unknown'][o_orderkey % 3 + 1] AS reachable, CASE WHEN o_orderkey % 3 = 1 THEN 'dismissed: cannot be reached' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'closed' END AS outcome FROM {_REVIEWED} WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def p8_bugfix(t):
    outcome = R.decided([(c("o_orderkey") % 3 == 1, "dismissed: cannot be reached"), (c("o_orderstatus") == "O", "open")], "closed")
    rows = _reviewed(t).where(c("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return R.sheet(rows, {"record": "number", "category": _pick(c("o_custkey"), "crash", "wrong result", "leak"), "reachable": _pick(c("o_orderkey"), "yes", "no", "unknown"), "outcome": outcome})


@query("p8_feature_sheet", f"SELECT number AS record, o_orderpriority AS category, CASE WHEN o_orderstatus = 'F' THEN 'follow' ELSE 'watch' END AS action FROM {_REVIEWED} WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')")
def p8_feature(t):
    rows = _reviewed(t).where(~c("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return R.sheet(rows, {"record": "number", "category": "o_orderpriority", "action": F.when(c("o_orderstatus") == "F", "follow").otherwise("watch")})


@query("p8_all_records_sheet", f"SELECT number AS record, strftime(o_orderdate, '%Y-%m-%d') AS merged, CAST(o_custkey AS VARCHAR) AS author, 'https://example.org/changes/' || o_orderkey AS link FROM {_REVIEWED}")
def p8_all(t):
    return R.sheet(_reviewed(t), {"record": "number", "merged": "o_orderdate", "author": "o_custkey", "link": F.concat(F.lit("https://example.org/changes/"), "o_orderkey")})


_TESTED = """(SELECT o_orderkey, ['Use it', '8 requests of 512 tokens on one node', 'Summary of what was tried on the whole machine', repeat('on and on ', 30)][o_custkey % 4 + 1] AS conditions,
  ['-', '', 'not measured yet', '12 % faster'][o_orderkey % 4 + 1] AS result, 'E' || (o_orderkey % 5) AS evidence FROM orders)"""


@query("v5_optimization_rules", f"""
SELECT o_orderkey, 'short' AS rule, 'error' AS severity FROM {_TESTED} WHERE length(trim(conditions)) < 20 UNION ALL SELECT o_orderkey, 'long', 'warning' FROM {_TESTED} WHERE length(trim(conditions)) > 220
UNION ALL SELECT o_orderkey, 'prose', 'error' FROM {_TESTED} WHERE split_part(conditions, ' ', 1) IN ('Use', 'Summary')
UNION ALL SELECT o_orderkey, 'claim', 'error' FROM {_TESTED} WHERE result = '12 % faster' AND evidence IN ('E0', 'E1', 'E2') UNION ALL SELECT o_orderkey, 'missing', 'error' FROM {_TESTED} WHERE result IN ('-', '') AND evidence IN ('E3', 'E4')""")
def v5_optimizations(t):
    conditions = _pick(c("o_custkey"), "Use it", "8 requests of 512 tokens on one node", "Summary of what was tried on the whole machine", "on and on " * 30)
    result = _pick(c("o_orderkey"), "-", "", "not measured yet", "12 % faster")
    rules = decisions.optimization_rules(conditions, result, F.concat(F.lit("E"), c("o_orderkey") % 5), ["-", ""], ["not measured"])
    return evidence.violations(t("orders"), "o_orderkey", rules)


@query("v6_common_rules", """
WITH r AS (SELECT o_orderkey, o_orderkey % 7 AS k FROM orders)
SELECT o_orderkey, 'url' AS rule, 'error' AS severity FROM r WHERE k = 1 UNION ALL SELECT o_orderkey, 'hash0', 'error' FROM r WHERE k = 2 UNION ALL SELECT o_orderkey, 'merged', 'error' FROM r WHERE k = 3
UNION ALL SELECT o_orderkey, 'action', 'error' FROM r WHERE k = 4 UNION ALL SELECT o_orderkey, 'gate', 'error' FROM r WHERE k IN (5, 6)""")
def v6(t):
    k = c("o_orderkey") % 7
    url = F.when(k == 1, "ftp://example.org/1").when(k == 2, "").otherwise(F.concat(F.lit("https://example.org/changes/"), "o_orderkey"))
    sha, merged = F.when(k == 2, "xyz").when(k == 3, None).otherwise("0123abcd"), F.when(k == 3, "yesterday").otherwise("2024-01-31T10:00:00Z")
    action = F.when(k == 4, "maybe").when(k >= 5, "modify").otherwise("review")
    rules = decisions.common_rules(url, r"^https://example.org/changes/\d+$", [sha], merged, action, ["modify", "review", "dismiss"], [k != 5, F.when(k != 6, True)])
    return evidence.violations(t("orders"), "o_orderkey", rules)


@query("f17_first_published", """
SELECT file, class, name, idx FROM (SELECT l_suppkey AS file, 'C' || (l_partkey % 9) AS class, CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS name, l_orderkey * 10 + l_linenumber AS idx, l_partkey % 9 AS k FROM lineitem) WHERE k > 0 AND name IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY file, class, name ORDER BY idx) = 1""")
def f17(t):
    k = c("l_partkey") % 9
    rows = t("lineitem").select(c("l_suppkey").cast("string").alias("file"), F.when(k > 0, F.concat(F.lit("C"), k)).otherwise("").alias("class"), F.when(c("l_returnflag") != "R", c("l_returnflag")).alias("name"), (c("l_orderkey") * 10 + c("l_linenumber")).alias("idx"))
    out = mappings.first_published(rows, ["file", "class", "name"], "idx")
    return out.select(c("file").cast("long").alias("file"), "class", "name", "idx")


@query("s5_diff_renames", """
SELECT p_partkey, 'a/' || p_name || '.py' AS old, 'b/' || p_name || '.py' AS new, CAST(50 + p_size AS INTEGER) AS similarity FROM part WHERE p_size >= 20 AND p_partkey % 3 > 0""")
def s5_diffs(t):
    head = F.concat(F.lit("diff --git a/a/"), "p_name", F.lit(".py b/b/"), "p_name", F.lit(".py\n"))
    moved = F.concat(F.lit("similarity index "), 50 + c("p_size"), F.lit("%\nrename from a/"), "p_name", F.lit(".py\nrename to b/"), "p_name", F.lit(".py\n@@ -1 +1 @@\n-rename from x\n+y\n"))
    other = F.lit("diff --git a/z b/z\n@@ -1 +1 @@\n-similarity index 90%\n+z\n")
    text = F.concat(other, head, F.when(c("p_partkey") % 3 > 0, moved).otherwise("@@ -1 +1 @@\n-x\n+y\n"))
    return files.diff_renames(t("part").select("p_partkey", text.alias("text")), "p_partkey")
