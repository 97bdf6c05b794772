"""Queries that apply the operators to the given tables: orders are the change records, their lines the changed
files, parts the symbols, events the log of a run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelens.functions import text as X
from changelens.operators import evidence, graph, relational

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
START, END = dt.datetime(1997, 1, 1), dt.datetime(1998, 1, 1)
PRIORITIES = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"))
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


@query("f1_half_open_window", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'")
def f1(t):
    return relational.half_open(t("orders").select("o_orderkey", "o_orderdate"), "o_orderdate", START, END)


@query("f2_priority_in", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def f2(t):
    return t("orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@query("f4_not_retired", "SELECT o_orderkey FROM orders WHERE lower(trim(coalesce(o_orderstatus, ''))) NOT IN ('f') AND lower(trim(coalesce(o_orderpriority, ''))) NOT IN ('f')")
def f4(t):
    return relational.not_retired(t("orders"), ["o_orderstatus", "o_orderpriority"], ("f",)).select("o_orderkey")


@query("f7_unless_absent", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size < 10)")
def f7(t):
    known = t("part").select(F.col("p_partkey").alias("l_partkey"), (F.col("p_size") >= 10).alias("there"))
    return relational.unless_absent(t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), known, ["l_partkey"], "there")


@query("f8_outside_prefixes", "SELECT p_partkey, replace(p_name, ' ', '.') AS name FROM part WHERE split_part(replace(p_name, ' ', '.'), '.', 1) NOT IN ('red', 'small')")
def f8(t):
    return relational.outside_prefixes(t("part").select("p_partkey", F.translate("p_name", " ", ".").alias("name")), "name", ["red", "small"])


@query("f11_token", r"SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '(^|[^A-Za-z0-9_])ring($|[^A-Za-z0-9_])')")
def f11(t):
    return t("part").where(X.has_token(F.col("p_name"), "ring")).select("p_partkey", "p_name")


@query("j1_orders_with_customer", "SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey")
def j1(t):
    return t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "c_name", "n_name")


@query("j2_coverage", "SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'left' ELSE 'right' END AS side FROM (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_mktsegment <> 'BUILDING') a FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority <> '1-URGENT') b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL")
def j2(t):
    return relational.coverage(t("customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("k")), t("orders").where("o_orderpriority <> '1-URGENT'").select(F.col("o_custkey").alias("k")), "k")


@query("j4_last_wins", "SELECT o_orderkey, coalesce(l_shipdate, TIMESTAMP '1970-01-01') AS last_ship FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS l_shipdate FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey")
def j4(t):
    last = t("lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("ship"))
    return t("orders").join(last, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.coalesce("ship", F.lit("1970-01-01").cast("timestamp_ntz")).alias("last_ship"))


@query("j6_under_paths", "SELECT p_partkey, p_type || '/' || replace(p_name, ' ', '/') AS path FROM part WHERE p_type = 'PROMO' OR p_type || '/' || split_part(p_name, ' ', 1) = 'SMALL/red'")
def j6(t):
    parts = t("part").select("p_partkey", F.concat("p_type", F.lit("/"), F.translate("p_name", " ", "/")).alias("path"))
    roots = parts.select(F.explode(X.ancestors(F.col("path"))).alias("root")).where(F.col("root").isin("PROMO", "SMALL/red"))
    return relational.under_paths(parts, "path", roots, "root")


@query("j8_longest_prefix", "SELECT p_partkey, CASE WHEN p_brand IN (SELECT p_brand FROM part WHERE p_size > 45) THEN p_brand || '.' || split_part(p_name, ' ', 1) END AS resolved FROM part")
def j8(t):
    names = t("part").select("p_partkey", F.concat("p_brand", F.lit("."), F.translate("p_name", " ", ".")).alias("name"))
    big = t("part").where("p_size > 45").select("p_brand").distinct()
    known = t("part").join(big, "p_brand", "left_semi").select(F.explode(F.array("p_brand", F.concat("p_brand", F.lit("."), F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))))).alias("known"))
    return relational.longest_prefix(names, "name", known, "known").select("p_partkey", "resolved")


@query("j12_snapshot_delta", "WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE year(o_orderdate) = 1996 GROUP BY 1), b AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1) SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'removed' WHEN a.k IS NULL THEN 'introduced' WHEN a.n = b.n THEN 'same' ELSE 'changed' END AS delta FROM a FULL JOIN b ON a.k = b.k")
def j12(t):
    year = lambda y: relational.half_open(t("orders"), "o_orderdate", dt.datetime(y, 1, 1), dt.datetime(y + 1, 1, 1)).groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))
    return relational.compare(year(1996), year(1997), ["k"], "n")


@query("a1_count_by", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def a1(t):
    return t("orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("a3_dashboard", "SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'O') AS open, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent, CASE WHEN count(*) = 0 THEN 1.0 ELSE 1 - count(*) FILTER (o_orderstatus = 'O') / count(*) END AS closure FROM orders")
def a3(t):
    n, pending = F.count("*"), F.count_if(F.col("o_orderstatus") == "O")
    closure = F.when(n == 0, F.lit(1.0)).otherwise(1 - pending / n)
    return t("orders").agg(n.alias("total"), pending.alias("open"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"), closure.alias("closure"))


@query("a5_precision_recall", "WITH p AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT'), a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), s AS (SELECT count(p.k) FILTER (a.k IS NOT NULL) AS hits, count(*) FILTER (p.k IS NULL) AS misses, count(*) FILTER (a.k IS NULL) AS extras FROM p FULL JOIN a ON p.k = a.k) SELECT hits, misses, extras, CASE WHEN hits + extras = 0 THEN 0.0 ELSE hits / (hits + extras) END AS precision, CASE WHEN hits + misses = 0 THEN 0.0 ELSE hits / (hits + misses) END AS recall FROM s")
def a5(t):
    k = F.col("o_custkey").alias("k")
    return relational.precision_recall(relational.hits_misses_extras(t("orders").where("o_orderpriority = '1-URGENT'").select(k), t("orders").where("o_orderstatus = 'F'").select(k), "k"))


@query("a8_best_per_key", "SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def a8(t):
    rank = X.rank_of(F.col("o_orderpriority"), PRIORITIES)
    return relational.latest(t("orders").select("o_custkey", "o_orderkey", "o_orderpriority"), ["o_custkey"], [rank.desc(), F.col("o_orderkey").asc()])


@query("a9_occurrences", "SELECT user_id, string_agg(event_type, ',' ORDER BY first_at, event_type) AS types, CAST(sum(n) AS BIGINT) AS n FROM (SELECT user_id, event_type, min(event_id) AS first_at, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1")
def a9(t):
    return relational.occurrences(t("events"), ["user_id"], "event_id", "event_type").select("user_id", F.array_join("values", ",").alias("types"), "n")


@query("a16_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def a16(t):
    return relational.duplicates(t("lineitem"), ["l_orderkey", "l_linenumber"])


def _evidence(t) -> DataFrame:
    table = F.element_at(F.array(*map(F.lit, ["method", "call", "field", "import", "registration", "copied", "guard", "broad"])), (F.pmod("l_suppkey", F.lit(8)) + 1).cast("int"))
    rows = t("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", table.alias("table"), (F.col("l_returnflag") == "R").alias("delta"), (F.col("l_linestatus") == "F").alias("verified"), (F.col("l_quantity") > 40).alias("critical"), (F.col("l_discount") > 0.08).alias("accepted"))
    c = F.col
    return evidence.scored(rows, c("table"), c("delta"), c("verified"), c("critical"), c("accepted"))


_SCORED = """
SELECT *, CASE WHEN kind = 'method' AND d AND v AND a THEN 25 WHEN kind = 'method' AND d AND v THEN 100 WHEN kind = 'method' AND d THEN 40 WHEN kind = 'method' AND c THEN 40 WHEN kind = 'method' THEN 30
  WHEN kind = 'call' AND d AND v AND c THEN 90 WHEN kind = 'call' AND d AND v THEN 80 WHEN kind = 'call' AND d THEN 40 WHEN kind = 'call' THEN 20
  WHEN kind = 'field' AND d AND v AND c THEN 70 WHEN kind = 'field' AND d AND v THEN 60 WHEN kind = 'field' AND d THEN 40 WHEN kind = 'field' THEN 25
  WHEN kind = 'import' AND d AND v THEN 95 WHEN kind = 'import' THEN 30 WHEN kind = 'registration' THEN 25 WHEN kind = 'copied' THEN 45 WHEN kind = 'guard' THEN 50 WHEN kind = 'broad' THEN 10 ELSE 20 END AS score,
  (kind = 'method' AND d AND v AND NOT a) OR (kind IN ('call', 'field', 'import') AND d AND v) OR kind = 'guard' AS core
FROM (SELECT l_orderkey, l_partkey, l_linenumber, ['method','call','field','import','registration','copied','guard','broad'][l_suppkey % 8 + 1] AS kind,
  l_returnflag = 'R' AS d, l_linestatus = 'F' AS v, l_quantity > 40 AS c, l_discount > 0.08 AS a FROM lineitem)"""


@query("a15_scores", f"SELECT score, core, count(*) AS n FROM ({_SCORED}) GROUP BY 1, 2")
def a15(t):
    return _evidence(t).groupBy("score", "core").agg(F.count("*").alias("n"))


@query("a14_tiers", f"""
WITH s AS (SELECT *, CASE kind WHEN 'method' THEN CASE WHEN d AND v AND a THEN 'already compatible override signature' WHEN d AND v THEN 'upstream callable signature changed' WHEN d THEN 'unverified method candidate' ELSE 'method relationship review' END
  WHEN 'call' THEN CASE WHEN d AND v THEN 'verified call keyword delta' WHEN d THEN 'unverified call keyword delta' ELSE 'unverified call protocol candidate' END
  WHEN 'field' THEN CASE WHEN d AND v THEN 'verified upstream field contract delta' WHEN d THEN 'unverified upstream field contract delta' ELSE 'field relationship review' END
  WHEN 'import' THEN CASE WHEN d AND v THEN 'verified imported module relocated' ELSE 'changed directly imported upstream owner' END
  WHEN 'registration' THEN 'registration closure review' WHEN 'copied' THEN 'changed explicitly copied upstream source' WHEN 'guard' THEN 'release compatibility guard' ELSE 'broad mapping observation' END AS label FROM ({_SCORED})),
g AS (SELECT l_orderkey, max(score) AS score, bool_or(core) AS core, count(*) AS n_rows, bool_or(label = 'already compatible override signature') AS fits FROM s GROUP BY 1),
l AS (SELECT l_orderkey, label, min(l_linenumber) AS pos, CASE WHEN label LIKE '%keyword delta' OR label LIKE '%protocol%' OR label LIKE 'upstream callable%' OR label LIKE 'verified imported%' THEN 0
  WHEN label LIKE '%method%' OR label LIKE 'already%' OR label LIKE 'changed%' THEN 1 WHEN label LIKE '%field%' THEN 2 WHEN label LIKE 'release%' THEN 3 WHEN label LIKE 'registration%' THEN 4 ELSE 5 END AS family FROM s GROUP BY 1, 2),
kept AS (SELECT l.* FROM l JOIN g USING (l_orderkey) WHERE NOT (core AND label = 'already compatible override signature')),
f AS (SELECT l_orderkey, string_agg(label, '|' ORDER BY pos, label) AS labels, ['interface','implementation','field','version','registration','observation'][min(family) + 1] AS family FROM kept GROUP BY 1)
SELECT l_orderkey, score, core, n_rows, labels, family, CASE WHEN family <> 'interface' THEN family WHEN score >= 95 THEN 'interface: signature' ELSE 'interface: protocol' END AS tier,
  CASE WHEN fits AND NOT core THEN 'dismiss' ELSE 'review' END AS action FROM g JOIN f USING (l_orderkey)""")
def a14_tiers(t):
    c = F.col
    rows = evidence.labelled(_evidence(t), c("table"), c("delta"), c("verified"), c("accepted"))
    out = evidence.with_tier(evidence.folded(rows, "l_orderkey", "label", "l_partkey", "l_linenumber"))
    return out.select("l_orderkey", "score", "core", "n_rows", F.array_join("labels", "|").alias("labels"), "family", "tier", "action")


@query("a14_evidence_fold", f"""
WITH s AS ({_SCORED}), best AS (SELECT l_partkey, max(score) AS score, bool_or(core) AS core, count(*) AS n_rows FROM s GROUP BY 1),
labels AS (SELECT l_partkey, string_agg(kind, ',' ORDER BY pos, kind) AS labels FROM (SELECT l_partkey, kind, min(l_orderkey) AS pos FROM s GROUP BY 1, 2) GROUP BY 1),
few AS (SELECT l_partkey, string_agg(l_linenumber, ',' ORDER BY rn) AS examples FROM (
  SELECT l_partkey, l_linenumber, row_number() OVER (PARTITION BY l_partkey ORDER BY min(l_orderkey), l_linenumber) AS rn FROM s JOIN best USING (l_partkey, score) GROUP BY 1, 2) WHERE rn <= 3 GROUP BY 1)
SELECT b.l_partkey, b.score, b.core, n_rows, labels, examples, CASE WHEN b.core THEN 'high' WHEN b.score >= 40 THEN 'medium' ELSE 'low' END AS confidence,
  CASE WHEN b.core AND b.score >= 50 THEN 'modify' ELSE 'review' END AS action
FROM best b JOIN labels USING (l_partkey) JOIN few USING (l_partkey)""")
def a14(t):
    out = evidence.folded(_evidence(t), "l_partkey", "table", "l_linenumber", "l_orderkey")
    # this query's SQL has a shorter rule than the operator, by score alone; a14_evidence_actions has the whole one
    out = out.withColumn("action", F.when(F.col("core") & (F.col("score") >= evidence.CORE_SCORE), "modify").otherwise("review"))
    return out.withColumn("labels", F.array_join("labels", ",")).withColumn("examples", F.array_join(F.transform("examples", lambda x: x.cast("string")), ","))


@query("a14_evidence_actions", f"""
WITH s AS (SELECT *, kind = 'method' AND d AND v AND a AS compatible, CASE WHEN l_partkey % 4 > 0 THEN l_partkey % 4 < 3 END AS reachable, l_linenumber <= 4 AS lane,
  ['changed line','near hunk','changed file','same file'][l_partkey % 4 + 1] AS proximity FROM ({_SCORED})),
near AS (SELECT l_orderkey, string_agg(proximity, ',' ORDER BY pos, proximity) AS proximities FROM (SELECT l_orderkey, proximity, min(l_linenumber) AS pos FROM s GROUP BY 1, 2) GROUP BY 1)
SELECT l_orderkey, max(score) AS score, bool_or(core) AS core, count(*) AS n_rows, any_value(proximities) AS proximities,
  CASE WHEN bool_or(compatible) AND NOT bool_or(core) THEN 'dismiss' WHEN count(*) FILTER (WHERE v AND d AND reachable AND lane) > 0 THEN 'modify' ELSE 'review' END AS action
FROM s JOIN near USING (l_orderkey) GROUP BY 1""")
def a14_actions(t):
    c, turn = F.col, F.pmod("l_partkey", F.lit(4))
    near = F.element_at(F.array(*map(F.lit, ["changed line", "near hunk", "changed file", "same file"])), (turn + 1).cast("int"))
    rows = _evidence(t).withColumns({"reachable": F.when(turn > 0, turn < 3), "lane": c("l_linenumber") <= 4, "proximity": near})
    out = evidence.folded(rows, "l_orderkey", "table", "l_partkey", "l_linenumber", proximity="proximity", gates=["verified", "delta", "reachable", "lane"])
    return out.select("l_orderkey", "score", "core", "n_rows", F.array_join("proximities", ",").alias("proximities"), "action")


@query("w4_tier_headings", "SELECT o_custkey, o_orderkey, o_orderpriority, (lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey)) IS DISTINCT FROM o_orderpriority AS heading FROM orders")
def w4(t):
    return relational.with_headings(t("orders").select("o_custkey", "o_orderkey", "o_orderpriority"), "o_orderpriority", ["o_custkey"], [F.col("o_orderpriority"), F.col("o_orderkey")])


@query("w5_top_with_rest", "SELECT o_custkey, o_orderkey, rank, remaining FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank, greatest(count(*) OVER (PARTITION BY o_custkey) - 3, 0) AS remaining FROM orders) WHERE rank <= 3")
def w5(t):
    return relational.top_with_rest(t("orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3).select("o_custkey", "o_orderkey", "rank", "remaining")


@query("u1_hits_misses_extras", "SELECT coalesce(p.k, a.k) AS k, CASE WHEN p.k = a.k THEN 'hit' WHEN p.k IS NULL THEN 'miss' ELSE 'extra' END AS side FROM (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R') p FULL JOIN (SELECT DISTINCT p_partkey AS k FROM part WHERE p_size > 25) a ON p.k = a.k")
def u1(t):
    return relational.hits_misses_extras(t("lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("k")), t("part").where("p_size > 25").select(F.col("p_partkey").alias("k")), "k")


@query("g3_reachable", """
WITH RECURSIVE turns AS (SELECT DISTINCT conv_id * 1000 + turn AS node, conv_id, turn FROM conversations), edges AS (
  SELECT a.node AS src, b.node AS dst FROM turns a JOIN turns b ON a.conv_id = b.conv_id AND b.turn IN (a.turn + 1, a.turn + 2, a.turn - 3)),
walk AS (SELECT node AS start, node, 0 AS hops FROM turns WHERE turn = 0 UNION SELECT start, dst, hops + 1 FROM walk JOIN edges ON node = src WHERE hops < 9)
SELECT start, node, min(hops) AS hops FROM walk GROUP BY 1, 2""")
def g3(t):
    turns = t("conversations").select("conv_id", "turn").distinct()
    node = lambda turn: F.col("conv_id") * 1000 + turn
    steps = turns.withColumn("to", F.explode(F.array(F.col("turn") + 1, F.col("turn") + 2, F.col("turn") - 3)))
    there = turns.select("conv_id", F.col("turn").alias("to"))
    edges = steps.join(there, ["conv_id", "to"]).select(node(F.col("turn")).alias("src"), node(F.col("to")).alias("dst"))
    return graph.reachable(edges, turns.where("turn = 0").select(node(F.lit(0)).alias("node")), 30)


@query("v1_violations", """
SELECT o_orderkey, 'price' AS rule, 'error' AS severity FROM orders WHERE NOT coalesce(o_totalprice > 1000, FALSE)
UNION ALL SELECT o_orderkey, 'status', 'warning' FROM orders WHERE NOT coalesce(o_orderstatus IN ('F', 'O'), FALSE)
UNION ALL SELECT o_orderkey, 'window', 'error' FROM orders WHERE NOT coalesce(o_orderdate < TIMESTAMP '2001-01-01', FALSE)""")
def v1(t):
    c = F.col
    rules = {"price": ("error", c("o_totalprice") > 1000), "status": ("warning", c("o_orderstatus").isin("F", "O")), "window": ("error", c("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz"))}
    return evidence.violations(t("orders"), "o_orderkey", rules)


@query("v2_schema", "SELECT p_partkey, 'p_size minimum' AS rule, 'error' AS severity FROM part WHERE p_size < 5 UNION ALL SELECT p_partkey, 'p_name maxLength', 'error' FROM part WHERE length(p_name) > 11 UNION ALL SELECT p_partkey, 'p_type enum', 'error' FROM part WHERE p_type NOT IN ('PROMO', 'SMALL', 'ECONOMY')")
def v2(t):
    schema = {"required": ["p_name"], "properties": {"p_size": {"minimum": 5}, "p_name": {"maxLength": 11}, "p_type": {"enum": ["PROMO", "SMALL", "ECONOMY"]}}}
    return evidence.violations(t("part"), "p_partkey", evidence.schema_rules(schema))


@query("d19_action_gate", "SELECT l_returnflag, l_linestatus, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity > 25 THEN 'modify' ELSE 'dismiss' END AS action, count(*) AS n FROM lineitem GROUP BY ALL")
def d19(t):
    c = F.col
    action = evidence.gated([c("l_returnflag") == "R", c("l_linestatus") == "F", c("l_quantity") > 25])
    return t("lineitem").withColumn("action", action).groupBy("l_returnflag", "l_linestatus", "action").agg(F.count("*").alias("n"))
