"""Queries of contracts, mappings, decisions and the smaller operators. Sources and mapping rows are derived from parts and order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from changelens.functions import text as X
from changelens.operators import contracts, decisions, evidence, graph, mappings, relational, store
from changelens.plans.queries import _evidence, query

c = F.col


@query("c3_local_day", "SELECT strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1")
def c3(t):
    return t("events").select(X.local_text(c("ts").cast("timestamp"), "+08:00").substr(1, 10).alias("day")).groupBy("day").agg(F.count("*").alias("n"))


@query("s2_json_props", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def s2(t):
    return t("events").select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))


@query("a2_none_group", "SELECT coalesce(CAST(toxic AS VARCHAR), 'None') AS toxic, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def a2(t):
    return t("documents").select("doc_id").join(t("labels"), "doc_id", "left").groupBy(F.coalesce(c("toxic").cast("string"), F.lit("None")).alias("toxic")).agg(F.count("*").alias("n"))


@query("a4_closure_rates", "SELECT o_orderpriority, 1 - count(*) FILTER (o_orderstatus = 'O') / count(*) AS closure, count(*) FILTER (o_totalprice > 200000) AS big FROM orders GROUP BY 1")
def a4(t):
    return t("orders").groupBy("o_orderpriority").agg((1 - X.ratio(F.count_if(c("o_orderstatus") == "O"), F.count("*"))).alias("closure"), F.count_if(c("o_totalprice") > 200000).alias("big"))


@query("a12_count_distinct", "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1")
def a12(t):
    return t("lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"))


@query("a18_files_of_all_tables", "SELECT l_partkey AS k FROM lineitem WHERE l_quantity > 49 UNION SELECT p_partkey FROM part WHERE p_size > 48")
def a18(t):
    return t("lineitem").where("l_quantity > 49").select(c("l_partkey").alias("k")).union(t("part").where("p_size > 48").select("p_partkey")).distinct()


@query("w2_first_wins", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def w2(t):
    return relational.latest(t("events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], [c("ts"), c("event_id")]).drop("ts")


@query("w3_last_wins", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def w3(t):
    return relational.latest(t("events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query("j3_left_default", "SELECT c_custkey, count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def j3(t):
    counts = t("orders").groupBy(c("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"))
    return t("customer").select("c_custkey").join(counts, "c_custkey", "left").fillna(0, ["orders"])


@query("j11_not_mapped", "SELECT p_partkey, p_name FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity >= 45)")
def j11(t):
    return t("part").select("p_partkey", "p_name").join(t("lineitem").where("l_quantity >= 45").select(c("l_partkey").alias("p_partkey")), "p_partkey", "left_anti")


@query("u5_union_by_name", "SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer UNION ALL SELECT s_name, s_nationkey, NULL FROM supplier")
def u5(t):
    a = t("customer").select(c("c_name").alias("name"), c("c_nationkey").alias("nation"), c("c_mktsegment").alias("segment"))
    return a.unionByName(t("supplier").select(c("s_name").alias("name"), c("s_nationkey").alias("nation")), allowMissingColumns=True)


@query("u7_kinds_added_removed", """
WITH s AS (SELECT user_id, list(DISTINCT event_type) FILTER (event_id % 2 = 0) AS a, list(DISTINCT event_type) FILTER (event_id % 2 = 1) AS b FROM events WHERE value > 120 GROUP BY 1)
SELECT user_id, array_to_string(list_sort(list_filter(coalesce(b, []), lambda x: NOT list_contains(coalesce(a, []), x))), ',') AS added,
  array_to_string(list_sort(list_filter(coalesce(a, []), lambda x: NOT list_contains(coalesce(b, []), x))), ',') AS removed FROM s""")
def u7(t):
    sets = t("events").where("value > 120").groupBy("user_id").agg(F.collect_set(F.when(c("event_id") % 2 == 0, c("event_type"))).alias("a"), F.collect_set(F.when(c("event_id") % 2 == 1, c("event_type"))).alias("b"))
    text = lambda x, y: F.array_join(F.array_sort(F.array_except(x, y)), ",")
    return sets.select("user_id", text("b", "a").alias("added"), text("a", "b").alias("removed"))


@query("o7_key_lines_first", "SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag <> 'R', l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn <= 3")
def o7(t):
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    return relational.top_with_rest(lines, ["l_orderkey"], [c("l_returnflag") != "R", c("l_linenumber"), c("l_partkey"), c("l_suppkey")], 3).select("l_orderkey", "l_linenumber", "l_partkey")


@query("o10_bucket_order", "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 9 END AS bucket FROM orders")
def o10(t):
    return t("orders").select("o_orderkey", X.rank_of(c("o_orderpriority"), ["1-URGENT", "2-HIGH", "3-MEDIUM"], 9).alias("bucket"))


@query("c18_changed_lines", r"""
WITH lines AS (SELECT page_id, unnest(string_split(replace(html, '<', chr(10) || '<'), chr(10))) AS line FROM pages), marked AS (
SELECT page_id, CASE WHEN starts_with(line, '<p') THEN '+' || line WHEN starts_with(line, '</p') THEN '-' || line WHEN starts_with(line, '<t') THEN '+++' || line ELSE line END AS line FROM lines)
SELECT page_id, CASE WHEN starts_with(line, '+') THEN '+' ELSE '-' END AS sign, count(*) AS n FROM marked
WHERE (starts_with(line, '+') AND NOT starts_with(line, '+++')) OR (starts_with(line, '-') AND NOT starts_with(line, '---')) GROUP BY 1, 2""")
def c18(t):
    lines = t("pages").select("page_id", F.explode(F.split(F.replace("html", F.lit("<"), F.lit("\n<")), "\n")).alias("line"))
    line = F.when(c("line").startswith("<p"), F.concat(F.lit("+"), "line")).when(c("line").startswith("</p"), F.concat(F.lit("-"), "line")).when(c("line").startswith("<t"), F.concat(F.lit("+++"), "line")).otherwise(c("line"))
    return lines.select("page_id", X.changed_line(line).alias("sign")).where("sign IS NOT NULL").groupBy("page_id", "sign").agg(F.count("*").alias("n"))


@query("a15_thresholds", """
SELECT threshold, count(DISTINCT l_partkey) FILTER (score >= threshold) AS files FROM (SELECT l_partkey, max(CASE WHEN kind IN ('call','field') AND d AND v THEN CASE WHEN kind = 'call' THEN 80 ELSE 60 END + CASE WHEN c THEN 10 ELSE 0 END
  WHEN kind = 'import' AND d AND v THEN 95 WHEN kind = 'method' AND d AND v AND NOT a THEN 100 ELSE 0 END) AS score
FROM (SELECT l_partkey, ['method','call','field','import','registration','copied','guard','broad'][l_suppkey % 8 + 1] AS kind, l_returnflag = 'R' AS d, l_linestatus = 'F' AS v, l_quantity > 40 AS c, l_discount > 0.08 AS a FROM lineitem) GROUP BY 1), (VALUES (55), (60), (70), (80), (90)) x(threshold) GROUP BY 1""")
def a15_thresholds(t):
    best = _evidence(t).groupBy("l_partkey").agg(F.max("score").alias("score"))
    probes = best.select("score", F.explode(F.array(*map(F.lit, (55, 60, 70, 80, 90)))).alias("threshold"))
    return probes.groupBy("threshold").agg(F.count_if(c("score") >= c("threshold")).alias("files"))


def _states(t):
    """Lines as records of a bugfix matrix, its four fields drawn from the keys."""
    pick = lambda key, values: F.element_at(F.array(*map(F.lit, values)), (c(key) % len(values) + 1).cast("int"))
    three = [decisions.YES, decisions.NO, decisions.UNKNOWN]
    conclusion = pick("l_linenumber", [decisions.INHERIT, decisions.ADAPT, decisions.UNAFFECTED, decisions.PENDING])
    return t("lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"), pick("l_partkey", three).alias("source"), pick("l_suppkey", three).alias("repair"),
        pick("l_orderkey", [*three, "不适用"]).alias("equivalent"), F.when(c("l_returnflag") == "R", decisions.NO).otherwise(decisions.YES).alias("lane"), conclusion.alias("conclusion"),
        F.concat(F.lit("E"), (c("l_partkey") % 5).cast("string")).alias("evidence"),
    )


_STATES = """SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, ['是','否','未知'][l_partkey % 3 + 1] AS source, ['是','否','未知'][l_suppkey % 3 + 1] AS repair,
  ['是','否','未知','不适用'][l_orderkey % 4 + 1] AS equivalent, CASE WHEN l_returnflag = 'R' THEN '否' ELSE '是' END AS lane, ['直接继承修复','需要适配','不受影响','待确认'][l_linenumber % 4 + 1] AS conclusion, 'E' || (l_partkey % 5) AS evidence FROM lineitem"""


@query("v4_bugfix_matrix", f"""WITH s AS ({_STATES})
SELECT id, 'inherit' AS rule, 'error' AS severity FROM s WHERE conclusion = '直接继承修复' AND NOT (source = '是' AND repair = '是' AND lane = '是')
UNION ALL SELECT id, 'adapt', 'error' FROM s WHERE conclusion = '需要适配' AND NOT (source = '是' AND repair = '否' AND equivalent = '否' AND lane = '是')
UNION ALL SELECT id, 'unaffected', 'error' FROM s WHERE conclusion = '不受影响' AND NOT (source = '否' OR (source = '是' AND repair = '否' AND equivalent = '是'))
UNION ALL SELECT id, 'pending', 'error' FROM s WHERE conclusion = '待确认' AND '未知' NOT IN (source, repair, equivalent, lane)
UNION ALL SELECT id, 'evidence', 'warning' FROM s WHERE conclusion <> '待确认' AND evidence IN ('E0', 'E1')""")
def v4(t):
    return evidence.violations(_states(t), "id", decisions.bugfix_rules(c("conclusion"), c("source"), c("repair"), c("equivalent"), c("lane"), c("evidence")))


@query("v17_bugfix_conclusions", f"""SELECT CASE WHEN source = '否' THEN '不受影响' WHEN source = '是' AND repair = '是' THEN '直接继承修复' WHEN source = '是' AND repair = '否' AND equivalent = '是' THEN '不受影响'
  WHEN source = '是' AND repair = '否' AND equivalent = '否' THEN '需要适配' ELSE '待确认' END AS conclusion, count(*) AS n FROM ({_STATES}) GROUP BY 1""")
def v17(t):
    return _states(t).groupBy(decisions.bugfix_conclusion(c("source"), c("repair"), c("equivalent")).alias("conclusion")).agg(F.count("*").alias("n"))


@query("v15_categories", "SELECT p_partkey, CASE WHEN starts_with(p_type, 'PROMO') THEN 'core' WHEN starts_with(p_type, 'S') THEN 'small' ELSE 'other' END AS category FROM part")
def v15(t):
    return t("part").select("p_partkey", decisions.category_of(c("p_type"), [("PROMO", "core"), ("S", "small")]).alias("category"))


@query("v16_priorities", """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN 'P0' WHEN o_orderpriority = '1-URGENT' AND o_custkey % 3 = 0 THEN 'P0' WHEN o_orderpriority = '1-URGENT' AND o_custkey % 3 = 1 THEN 'P1'
  WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' THEN 'P1' WHEN o_orderpriority = '2-HIGH' THEN 'P2' WHEN o_orderpriority = '3-MEDIUM' THEN 'P3' WHEN o_orderpriority = '5-LOW' THEN 'skip' END AS priority FROM orders""")
def v16(t):
    value = F.element_at(F.create_map(*map(F.lit, ["1-URGENT", "high", "2-HIGH", "medium", "3-MEDIUM", "low", "5-LOW", "none"])), c("o_orderpriority"))
    change = F.element_at(F.array(*map(F.lit, ["bugfix", "performance", "feature"])), (c("o_custkey") % 3 + 1).cast("int"))
    return t("orders").select("o_orderkey", decisions.priority_of(value, c("o_orderstatus") == "O", change).alias("priority"))


@query("v14_route_differs", """SELECT r AS route, f AS category, count(*) AS n, NOT ((r IN ('auto-inherit', 'cherry-pick') AND f = '直接继承') OR (r = 'skip' AND f = '不可用')) AS differs
FROM (SELECT ['auto-inherit','cherry-pick','skip','config-align'][l_linenumber % 4 + 1] AS r, CASE WHEN l_returnflag = 'R' THEN '不可用' ELSE '直接继承' END AS f FROM lineitem) GROUP BY 1, 2""")
def v14(t):
    route = F.element_at(F.array(*map(F.lit, ["auto-inherit", "cherry-pick", "skip", "config-align"])), (c("l_linenumber") % 4 + 1).cast("int"))
    rows = t("lineitem").select(route.alias("route"), F.when(c("l_returnflag") == "R", "不可用").otherwise("直接继承").alias("category"))
    return rows.groupBy("route", "category").agg(F.count("*").alias("n")).withColumn("differs", decisions.differs(c("route"), c("category")))


def _sources(t, kinds):
    """Symbols of an old and a new source text for each part, both read once; what the new one does to the old depends on the part's size."""
    run = F.concat(F.lit("    def run(self, a, b=1):\n        self.n = a\n        call(a, key="), "p_size", F.lit(")\n        return "), "p_partkey", F.lit("\n"))
    stop = F.lit("    def stop(self):\n        return 0\n")
    text, kind = F.concat(F.lit("class Unit:\n"), run, stop), c("p_size") % 6
    new = (
        F.when(kind == 1, F.replace(text, F.lit("b=1"), F.lit("b"))).when(kind == 2, F.replace(text, F.lit("def run"), F.lit("def begin")))
        .when(kind == 3, F.concat(F.lit("class Unit:\n"), stop)).when(kind == 4, F.lit("x = 1\n"))
        .when(kind == 5, F.concat(text, F.lit("    def extra(self, *rest):\n        return rest\n")))
        .otherwise(F.when(c("p_size") > 25, F.replace(F.replace(text, F.lit("return 0"), F.lit("return 1")), F.lit("key="), F.lit("word="))).otherwise(text))
    )
    sides = t("part").select("p_partkey", F.explode(F.array(F.struct(F.lit(0).alias("side"), text.alias("text")), F.struct(F.lit(1).alias("side"), new.alias("text")))).alias("s")).select("p_partkey", "s.*")
    found = store.written(contracts.symbols(sides, ["p_partkey", "side"], kinds=kinds), "symbols")
    return found.where("side = 0").drop("side"), found.where("side = 1").drop("side")


@query("d2_callable_deltas", """
SELECT p_partkey, 'run' AS name, CASE p_size % 6 WHEN 1 THEN 'signature_changed' WHEN 2 THEN 'renamed' WHEN 3 THEN 'removed' ELSE 'owner_removed' END AS delta, p_size % 6 = 2 AS has_new_name FROM part WHERE p_size % 6 BETWEEN 1 AND 4
UNION ALL SELECT p_partkey, 'stop', 'owner_removed', FALSE FROM part WHERE p_size % 6 = 4
UNION ALL SELECT p_partkey, 'begin', 'introduced', FALSE FROM part WHERE p_size % 6 = 2 UNION ALL SELECT p_partkey, 'extra', 'introduced', FALSE FROM part WHERE p_size % 6 = 5
UNION ALL SELECT p_partkey, unnest(['run', 'stop']), 'body_changed', FALSE FROM part WHERE p_size % 6 = 0 AND p_size > 25""")
def d2(t):
    found = contracts.callable_deltas(*_sources(t, {"callable", "class"}), ["p_partkey"]).where("delta <> 'same'")
    return found.select("p_partkey", "name", "delta", (F.coalesce("renamed_to", F.lit("")) == "begin").alias("has_new_name"))


@query("d4_accepts", "SELECT p_partkey, p_size % 6 IN (0, 5) AS accepted FROM part WHERE p_size % 6 IN (0, 1, 5)")
def d4(t):
    found = contracts.callable_deltas(*_sources(t, {"callable", "class"}), ["p_partkey"]).where("name = 'run' AND old_shape IS NOT NULL AND new_shape IS NOT NULL")
    return found.select("p_partkey", contracts.accepts(c("old_shape"), c("new_shape")).alias("accepted"))


@query("d11_keyword_deltas", """SELECT p_partkey, 'call' AS name, CASE WHEN p_size % 6 = 0 THEN 'word' ELSE '' END AS added, 'key' AS removed FROM part WHERE p_size % 6 IN (3, 4) OR (p_size % 6 = 0 AND p_size > 25)""")
def d11(t):
    found = contracts.keyword_deltas(*_sources(t, {"call"}), ["p_partkey"])
    return found.select("p_partkey", "name", F.array_join("added", ",").alias("added"), F.array_join("removed", ",").alias("removed"))


@query("d12_field_deltas", "SELECT p_partkey, 'Unit' AS owner, 'n' AS name, 'removed' AS delta FROM part WHERE p_size % 6 IN (3, 4)")
def d12(t):
    return contracts.field_deltas(*_sources(t, {"field"}), ["p_partkey"])


@query("d18_range_classes", "SELECT CASE WHEN NOT a THEN CASE WHEN b THEN 'fixed' ELSE 'preexisting' END WHEN b THEN 'compatibility_warning' ELSE 'introduced_break' END AS class, count(*) AS n FROM (SELECT l_returnflag <> 'R' AS a, l_quantity < 30 AS b FROM lineitem) GROUP BY 1")
def d18(t):
    return t("lineitem").groupBy(contracts.range_class(c("l_returnflag") != "R", c("l_quantity") < 30).alias("class")).agg(F.count("*").alias("n"))


def _relations(t):
    """Lines as rows of a mapping table."""
    pick = lambda key, values: F.element_at(F.array(*map(F.lit, values)), (c(key) % len(values) + 1).cast("int"))
    return t("lineitem").select(
        (c("l_orderkey") * 1000000 + c("l_partkey") * 100 + c("l_suppkey") % 10 * 10 + c("l_linenumber")).alias("idx"), c("l_partkey").alias("file"), c("l_suppkey").alias("owner"),
        pick("l_linenumber", ["override", "same_name_protocol", "call", "monkey_patch"]).alias("relation"), pick("l_orderkey", ["low", "medium", "high", "critical"]).alias("risk"),
        (c("l_linestatus") == "F").alias("relationship_verified"), F.when(c("l_returnflag") == "R", "verified").otherwise("candidate").alias("verification_status"),
    )


_RELATIONS = """SELECT l_orderkey * 1000000 + l_partkey * 100 + l_suppkey % 10 * 10 + l_linenumber AS idx, l_partkey AS file, l_suppkey AS owner, l_linenumber % 4 = 1 AS same,
  CASE WHEN l_linenumber % 4 = 1 THEN 0 ELSE l_orderkey % 4 END AS risk, l_linenumber % 4 <> 1 AND l_linestatus = 'F' AND l_returnflag = 'R' AS ok, ['override','same_name_protocol','call','monkey_patch'][l_linenumber % 4 + 1] AS relation
FROM lineitem WHERE EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size >= 10)"""


def _optimized(t):
    rows = _relations(t)
    kept = mappings.existing_only(rows, ["file"], t("part").where("p_size >= 10").select(c("p_partkey").alias("path")))
    return rows, kept, mappings.winners(mappings.downgraded(kept), ["file", "owner"], "idx")


@query("m_optimized_mappings", f"""WITH r AS ({_RELATIONS}), n AS (SELECT file, owner, count(*) AS n_sources, string_agg(DISTINCT relation, ',' ORDER BY relation) AS relations FROM r GROUP BY 1, 2)
SELECT file, owner, ['low','medium','high','critical'][risk + 1] AS risk, ok AS verified, idx, n_sources, relations FROM (SELECT *, row_number() OVER (PARTITION BY file, owner ORDER BY risk DESC, ok DESC, idx) AS rn FROM r) JOIN n USING (file, owner) WHERE rn = 1""")
def m(t):
    out = _optimized(t)[2]
    return out.select("file", "owner", "risk", c("relationship_verified").alias("verified"), "idx", "n_sources", F.array_join("source_relations", ",").alias("relations"))


@query("a19_mapping_statistics", f"SELECT (SELECT count(*) FROM lineitem) AS input_total, count(DISTINCT (file, owner)) AS output_total, (SELECT count(*) FROM lineitem) - count(*) AS removed_total, count(*) - count(DISTINCT (file, owner)) AS deduplicated FROM ({_RELATIONS})")
def a19(t):
    return mappings.statistics(*_optimized(t))


@query("g1_method_owners", """
WITH RECURSIVE walk AS (SELECT c_custkey AS class, c_custkey AS owner, 0 AS hops FROM customer UNION ALL SELECT class, owner // 2, hops + 1 FROM walk WHERE owner > 1)
SELECT class, 'm' AS method, arg_min(owner, hops) AS owner, min(hops) AS hops FROM walk WHERE owner IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1""")
def g1(t):
    customers = t("customer").select(c("c_custkey").alias("class"), "c_mktsegment")
    bases = customers.where("class > 1").select("class", F.floor(c("class") / 2).cast("long").alias("base"), F.lit(0).alias("pos"))
    return contracts.method_owners(customers.select("class"), bases, customers.where("c_mktsegment = 'BUILDING'").select("class", F.lit("m").alias("method")), 40)


@query("g5_maximal_names", "WITH n AS (SELECT DISTINCT p_type || '.' || replace(p_name, ' ', '.') AS name FROM part UNION SELECT DISTINCT p_type FROM part) SELECT name FROM n WHERE NOT EXISTS (SELECT 1 FROM n m WHERE starts_with(m.name, n.name || '.'))")
def g5(t):
    long = t("part").select(F.concat("p_type", F.lit("."), F.translate("p_name", " ", ".")).alias("name"))
    return graph.maximal_names(long.union(t("part").select("p_type")), "name")
