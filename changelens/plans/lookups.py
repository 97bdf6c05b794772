"""Queries of lookups between tables, sheets, whole schemas, and the remaining optimisers and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from changelens.functions import records as R
from changelens.functions import text as X
from changelens.operators import contracts, decisions, evidence, lookups, mappings
from changelens.plans.more import _relations
from changelens.plans.queries import _SCORED, PRIORITIES, _evidence, query
from changelens.plans.reports import pick, text_of

c = F.col


def s(column):
    return c(column).cast("string")


@query("o1_ranked", f"SELECT l_partkey, max(score) AS score FROM ({_SCORED}) GROUP BY 1 ORDER BY 2 DESC, 1")
def o1(t):
    return _evidence(t).groupBy("l_partkey").agg(F.max("score").alias("score")).orderBy(F.desc("score"), "l_partkey")


@query("o3_local_time_order", "SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS merged_local FROM events ORDER BY 2, 1")
def o3(t):
    return t("events").select("event_id", X.local_text(c("ts").cast("timestamp"), "+08:00").substr(1, 19).alias("merged_local")).orderBy("merged_local", "event_id")


@query("o4_input_order", "SELECT page_id, CAST(unnest(range(len(w))) AS INTEGER) AS pos, unnest(w) AS part FROM (SELECT page_id, string_split(url, '/') AS w FROM pages) ORDER BY 1, 2")
def o4(t):
    return t("pages").select("page_id", F.posexplode(F.split("url", "/")).alias("pos", "part")).orderBy("page_id", "pos")


@query("o5_priority_order", "SELECT o_orderkey, CAST(list_position(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'], o_orderpriority) - 1 AS INTEGER) AS rank, o_orderdate FROM orders ORDER BY 2, 3, 1")
def o5(t):
    return t("orders").select("o_orderkey", X.rank_of(c("o_orderpriority"), PRIORITIES[::-1]).alias("rank"), "o_orderdate").orderBy("rank", "o_orderdate", "o_orderkey")


@query("c5_iso_instants", "SELECT event_id, strftime(make_timestamp((1700000000 + event_id * 86399) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS instant FROM events")
def c5(t):
    return t("events").select("event_id", X.iso_instant(1700000000 + c("event_id") * 86399).alias("instant"))


@query("c13_cut", "SELECT doc_id, substring(text, 1, 80) AS head, substring(md5(text), 1, 8) AS short FROM documents")
def c13(t):
    return t("documents").select("doc_id", X.cut(c("text"), 80).alias("head"), X.cut(F.md5(c("text").cast("binary")), 8).alias("short"))


@query("c14_uris", "SELECT page_id, regexp_matches(u, '^[a-z]+://[^/?#]+') AS uri FROM (SELECT page_id, CASE page_id % 4 WHEN 1 THEN 'www.example.org/a' WHEN 2 THEN 'mailto:a@example.org' ELSE url END AS u FROM pages)")
def c14(t):
    url = F.when(c("page_id") % 4 == 1, "www.example.org/a").when(c("page_id") % 4 == 2, "mailto:a@example.org").otherwise(c("url"))
    return t("pages").select("page_id", X.is_uri(url).alias("uri"))


@query("c16_squeezed", r"SELECT conv_id, turn, trim(regexp_replace(text, '[ \t\n\r\f\x0B]+', ' ', 'g')) AS text FROM conversations")
def c16(t):
    return t("conversations").select("conv_id", "turn", X.squeezed(c("text")).alias("text"))


@query("c20_number_suffix", "SELECT c_custkey, CAST(regexp_extract(c_name, '([0-9]+)$', 1) AS BIGINT) AS number, TRY_CAST(c_mktsegment AS DOUBLE) IS NULL AS no_number FROM customer")
def c20(t):
    return t("customer").select("c_custkey", X.number_suffix(c("c_name")).alias("number"), c("c_mktsegment").try_cast("double").isNull().alias("no_number"))


@query("s9_search_lines", "SELECT conv_id || '.py' AS file, turn AS line_number, role || ': ' || conv_id AS line FROM conversations WHERE turn % 5 <> 3")
def s9(t):
    found = F.when(c("turn") % 5 == 3, text_of("Binary file ", s("conv_id"))).otherwise(text_of(s("conv_id"), ".py:", s("turn"), ":", c("role"), ": ", s("conv_id")))
    return t("conversations").select(lookups.grep_lines(found).alias("g")).where("g IS NOT NULL").select("g.*")


@query("p6_all_changes", "SELECT o_orderkey, c_name, c_mktsegment, o_orderpriority FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_totalprice > 1000")
def p6(t):
    rows = t("orders").where("o_totalprice > 1000").withColumnRenamed("o_custkey", "c_custkey")
    return lookups.required(rows, t("customer"), ["c_custkey"]).select("o_orderkey", "c_name", "c_mktsegment", "o_orderpriority")


_MAIN = """SELECT CAST(o_orderkey AS VARCHAR) AS record, strftime(o_orderdate, '%Y-%m-%d') AS merged, coalesce(parts, '') AS files, CASE o_orderstatus WHEN 'O' THEN 'open' ELSE 'done' END AS state, '' AS owner
FROM orders LEFT JOIN (SELECT l_orderkey, string_agg(l_partkey, '; ' ORDER BY l_partkey) AS parts FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) GROUP BY 1) ON l_orderkey = o_orderkey"""


def _changes(t):
    """Orders with the distinct parts of their lines, a list as long as an order has lines."""
    parts = t("lineitem").groupBy(c("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_set("l_partkey")).cast("array<string>").alias("files"))
    return t("orders").join(parts, "o_orderkey", "left")


@query("p8_main_sheet", _MAIN)
def p8(t):
    return R.sheet(_changes(t), {"record": "o_orderkey", "merged": "o_orderdate", "files": "files", "state": F.when(c("o_orderstatus") == "O", "open").otherwise("done"), "owner": "owner"})


@query("p8_action_sheet", f"SELECT record, files FROM ({_MAIN}) WHERE state = 'open'")
def p8_action(t):
    return R.sheet(_changes(t).where("o_orderstatus = 'O'"), {"record": "o_orderkey", "files": "files"})


@query("p8_key_values", "SELECT s_suppkey, 0 AS pos, 's_name' AS item, s_name AS value FROM supplier UNION ALL SELECT s_suppkey, 1, 's_nationkey', CAST(s_nationkey AS VARCHAR) FROM supplier")
def p8_pairs(t):
    return R.key_values(t("supplier").select("s_suppkey", "s_name", "s_nationkey"), "s_suppkey")


@query("p9_raw_and_review", "SELECT CAST(doc_id AS VARCHAR) AS record, coalesce(CAST(toxic AS VARCHAR), '') AS raw, CASE WHEN quality = 1 THEN 'reviewed' ELSE '' END AS review FROM labels")
def p9(t):
    return R.sheet(t("labels"), {"record": "doc_id", "raw": "toxic", "review": F.when(c("quality") == 1, "reviewed")})


@query("p10_first_filled", """SELECT p_partkey, CASE WHEN len(a) > 0 THEN 'verified: ' || array_to_string(a[1:3], ', ') WHEN len(b) > 0 THEN 'patch: ' || array_to_string(b[1:3], ', ') ELSE 'none' END AS bindings
FROM part LEFT JOIN (SELECT l_partkey, list_sort(list(DISTINCT l_suppkey) FILTER (l_quantity > 48)) AS a, list_sort(list(DISTINCT l_suppkey) FILTER (l_quantity > 46)) AS b FROM lineitem GROUP BY 1) ON l_partkey = p_partkey""")
def p10(t):
    some = lambda least: F.array_sort(F.collect_set(F.when(c("l_quantity") > least, c("l_suppkey")))).cast("array<string>")
    lists = t("lineitem").groupBy(c("l_partkey").alias("p_partkey")).agg(some(48).alias("a"), some(46).alias("b"))
    return t("part").select("p_partkey").join(lists, "p_partkey", "left").select("p_partkey", R.first_filled([(c("a"), "verified: "), (c("b"), "patch: ")], "none").alias("bindings"))


@query("p11_endpoint_labels", """SELECT p_partkey, p_type || '.py' || CASE p_partkey % 4 WHEN 0 THEN '::' || CASE WHEN p_size % 2 = 0 THEN p_brand || '.' ELSE '' END || 'run' WHEN 1 THEN '::' || CASE WHEN p_size % 2 = 0 THEN p_brand || '.' ELSE '' END || 'call' ELSE '' END AS label FROM part""")
def p11(t):
    kind = c("p_partkey") % 4
    owner, method, callee = F.when(c("p_size") % 2 == 0, c("p_brand")).otherwise(""), F.when(kind == 0, "run").when(kind == 1, ""), F.when(kind < 2, "call").otherwise("")
    return t("part").select("p_partkey", R.endpoint_label(text_of(c("p_type"), ".py"), owner, [method, callee]).alias("label"))


@query("p12_execution_text", """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'adapt: ' || o_orderstatus WHEN o_orderpriority = '2-HIGH' AND o_custkey % 2 = 0 THEN 'first the interface' WHEN o_orderpriority = '2-HIGH' THEN 'first a trial'
  WHEN o_custkey % 2 = 0 THEN 'no gain' ELSE 'keep' END AS action FROM orders""")
def p12(t):
    kind, needed = c("o_orderpriority"), c("o_custkey") % 2 == 0
    rules = [(kind == "1-URGENT", text_of("adapt: ", c("o_orderstatus"))), ((kind == "2-HIGH") & needed, "first the interface"), (kind == "2-HIGH", "first a trial"), (needed, "no gain")]
    return t("orders").select("o_orderkey", R.decided(rules, "keep").alias("action"))


@query("j1_required", "SELECT l_orderkey, l_linenumber, p_name FROM lineitem JOIN part ON p_partkey = l_partkey")
def j1_required(t):
    return lookups.required(t("lineitem").select("l_orderkey", "l_linenumber", c("l_partkey").alias("p_partkey")), t("part").select("p_partkey", "p_name"), ["p_partkey"]).select("l_orderkey", "l_linenumber", "p_name")


@query("j14_unique_suffix", """WITH tree AS (SELECT DISTINCT p_type || '/' || p_brand || '/' || p_name AS path FROM part), names AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_brand || '/' || p_name WHEN p_partkey % 3 = 1 THEN p_name ELSE 'x/' || p_name END AS name FROM part),
hits AS (SELECT name, min(path) AS file FROM (SELECT DISTINCT name FROM names) n JOIN tree ON path = name OR ends_with(path, '/' || name) GROUP BY 1 HAVING count(*) = 1)
SELECT p_partkey, name, file FROM names LEFT JOIN hits USING (name)""")
def j14(t):
    part = c("p_partkey") % 3
    name = F.when(part == 0, text_of(c("p_brand"), "/", c("p_name"))).when(part == 1, c("p_name")).otherwise(text_of("x/", c("p_name")))
    tree = t("part").select(text_of(c("p_type"), "/", c("p_brand"), "/", c("p_name")).alias("path"))
    return lookups.by_unique_suffix(t("part").select("p_partkey", name.alias("name")), "name", tree).select("p_partkey", "name", "file")


@query("j15_by_target", """SELECT file, count(*) AS records, min(o_orderkey) AS first FROM (SELECT DISTINCT o_orderkey, unnest([o_orderkey % 50, o_orderkey % 77, o_orderkey % 50]) AS file FROM orders) WHERE file IN (SELECT p_partkey FROM part WHERE p_size > 25) GROUP BY 1""")
def j15(t):
    records = t("orders").withColumn("targets", F.array(c("o_orderkey") % 50, c("o_orderkey") % 77, c("o_orderkey") % 50))
    return lookups.by_target(records, "targets", t("part").where("p_size > 25").select(c("p_partkey").alias("file")), F.count("*").alias("records"), F.min("o_orderkey").alias("first"))


@query("g6_registration_closure", """SELECT o_orderkey, o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AS direct, o_orderkey % 900 IN (SELECT p_partkey FROM part WHERE p_size > 40) AS through FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) OR o_orderkey % 900 IN (SELECT p_partkey FROM part WHERE p_size > 40)""")
def g6(t):
    records = t("orders").select("o_orderkey", c("o_custkey").alias("up"), (c("o_orderkey") % 900).alias("registered"))
    fired = lookups.closure(records, "up", "registered", t("customer").where("c_acctbal < 0").select(c("c_custkey").alias("path")), t("part").where("p_size > 40").select(c("p_partkey").alias("path")))
    return fired.select("o_orderkey", "direct", "through")


@query("j17_touching", "SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 0) OR c_custkey % 40 IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 0)")
def j17(t):
    changes = t("customer").select("c_custkey", F.array(c("c_nationkey").cast("long"), c("c_custkey") % 40).alias("files"))
    return lookups.touching(changes, "c_custkey", "files", t("supplier").where("s_acctbal < 0").select(c("s_nationkey").cast("long").alias("file")))


@query("j18_overlap", """WITH a AS (SELECT o_custkey, bool_and(o_orderkey % 9 <> 0) AS ok FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_custkey, bool_and(o_orderkey % 9 <> 0) AS ok FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
SELECT o_custkey, a.ok AND b.ok AS explained FROM a JOIN b USING (o_custkey)""")
def j18(t):
    rows = t("orders").withColumn("reason", F.when(c("o_orderkey") % 9 != 0, "given").otherwise("  "))
    return lookups.overlap(rows.where("o_orderstatus = 'F'"), rows.where("o_orderpriority = '1-URGENT'"), "o_custkey", "reason")


@query("j19_enriched", "SELECT c_custkey, coalesce(reason, 'none') AS reason FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderpriority) AS reason FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) ON o_custkey = c_custkey")
def j19(t):
    reasons = t("orders").where("o_orderstatus = 'O'").groupBy(c("o_custkey").alias("c_custkey")).agg(F.min("o_orderpriority").alias("reason"))
    return lookups.enriched(t("customer").select("c_custkey"), reasons, "c_custkey", "reason", "none")


@query("j20_verified_overrides", """SELECT p_partkey, EXISTS (SELECT 1 FROM customer WHERE c_nationkey = p_size % 25 AND c_custkey % 11 = p_partkey % 11) AND EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = p_size % 25 AND s_suppkey % 5 = p_partkey % 5) AS holds FROM part""")
def j20(t):
    claims = t("part").select("p_partkey", (c("p_size") % 25).alias("class"), (c("p_partkey") % 11).alias("base"), (c("p_partkey") % 5).alias("method"))
    bases = t("customer").select(c("c_nationkey").alias("class"), (c("c_custkey") % 11).alias("base"))
    return lookups.verified_overrides(claims, bases, t("supplier").select(c("s_nationkey").alias("class"), (c("s_suppkey") % 5).alias("method"))).select("p_partkey", "holds")


@query("j20_verified_expressions", r"""SELECT conv_id, turn, role || '  of' AS expression, contains(regexp_replace(coalesce(text, ''), '\s+', '', 'g'), role || 'of') AS holds FROM conversations""")
def j20_expressions(t):
    lines = t("conversations").select("conv_id", "turn", text_of(s("conv_id"), "/", s("turn")).alias("file"), "role", "text")
    claims = lines.select("conv_id", "turn", "file", text_of(c("role"), "  of").alias("expression"))
    return lookups.verified_expressions(claims, lines.select("file", "text")).select("conv_id", "turn", "expression", "holds")


@query("d6_changed_overrides", """WITH m AS (SELECT c_custkey AS class, unnest([0, 1, 2]) AS method, c_custkey % 4 AS v, c_nationkey AS nation FROM customer),
a AS (SELECT class, method, v FROM m WHERE (class + method) % 5 <> 0), b AS (SELECT class, method, CASE WHEN nation > 12 THEN v + 1 ELSE v END AS v FROM m WHERE (class + method) % 7 <> 0),
d AS (SELECT coalesce(a.class, b.class) AS owner, coalesce(a.method, b.method) AS method, CASE WHEN b.class IS NULL THEN 'removed' WHEN a.class IS NULL THEN 'introduced' ELSE 'changed' END AS delta
  FROM a FULL JOIN b ON a.class = b.class AND a.method = b.method WHERE a.v IS NULL OR b.v IS NULL OR a.v <> b.v)
SELECT m.class, d.owner, d.method, d.delta FROM m JOIN d ON d.owner = m.class // 2 AND d.method = m.method WHERE m.class > 1 AND m.class % 3 <> 0 AND NOT (m.class % 10 = 1 AND m.method = 1)""")
def d6(t):
    m = t("customer").select(c("c_custkey").alias("class"), F.explode(F.array(*map(F.lit, range(3)))).alias("method"), (c("c_custkey") % 4).alias("contract"), "c_nationkey")
    old = m.where("(class + method) % 5 <> 0")
    new = m.where("(class + method) % 7 <> 0").withColumn("contract", F.when(c("c_nationkey") > 12, c("contract") + 1).otherwise(c("contract")))
    owners = m.where("class > 1").select("class", "method", F.floor(c("class") / 2).cast("long").alias("owner"), (c("class") % 3 != 0).alias("own"))
    return lookups.changed_overrides(owners, old, new, m.where("class % 10 = 1 AND method = 1"))


@query("d9_copied_from", """SELECT p_partkey AS file, p_size AS line_number, 'a/' || p_size || '.py' AS origin FROM part WHERE p_partkey % 4 < 2 AND p_size < 20""")
def d9(t):
    where = text_of("a/", s("p_size"), ".py")
    line = pick(c("p_partkey"), "  # Copied from https://example.org/o/r/blob/main/", "# adapted from ", "copied from ", "# like ")
    lines = t("part").select(c("p_partkey").alias("file"), c("p_size").alias("line_number"), text_of(line, where, " and more").alias("line"))
    return lookups.copied_from(lines, t("part").where("p_size < 20").select(where.alias("path")))


@query("v2_whole_schema", """
SELECT o_orderkey, 'steps items' AS rule, 'error' AS severity FROM o WHERE len(list_filter(steps, lambda x: length(x) < 3)) > 0
UNION ALL SELECT o_orderkey, 'link format', 'error' FROM o WHERE link IS NOT NULL AND NOT starts_with(link, 'https://')
UNION ALL SELECT o_orderkey, 'amount type', 'error' FROM o
UNION ALL SELECT o_orderkey, 'allOf 0', 'error' FROM o WHERE state = 'O' AND len(steps) < 2
UNION ALL SELECT o_orderkey, 'not 0', 'error' FROM o WHERE state = 'F' AND o_orderkey % 5 = 1
UNION ALL SELECT o_orderkey, 'link required', 'error' FROM o WHERE link IS NULL""".replace(" FROM o ", " FROM (SELECT o_orderkey, o_orderstatus AS state, o_totalprice AS amount, CASE WHEN o_orderkey % 3 = 0 THEN ['ab', 'step'] ELSE ['step'] END AS steps, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'none' ELSE 'https://example.org/' || o_orderkey END AS link FROM orders) o ").replace(" FROM o\n", " FROM (SELECT o_orderkey FROM orders) o\n"))
def v2_whole(t):
    key = c("o_orderkey")
    steps = F.when(key % 3 == 0, F.array(F.lit("ab"), F.lit("step"))).otherwise(F.array(F.lit("step")))
    link = F.when(key % 5 == 1, "none").when(key % 5 > 1, text_of("https://example.org/", s("o_orderkey")))
    rows = t("orders").select("o_orderkey", c("o_orderstatus").alias("state"), c("o_totalprice").alias("amount"), steps.alias("steps"), link.alias("link"))
    schema = {
        "required": ["link"], "properties": {"steps": {"items": {"minLength": 3}}, "link": {"format": "uri"}, "amount": {"type": "string"}},
        "allOf": [{"if": {"properties": {"state": {"const": "O"}}}, "then": {"properties": {"steps": {"minItems": 2}}}}],
        "not": {"properties": {"state": {"const": "F"}, "link": {"const": "none"}}, "required": ["link"]},
    }
    return evidence.violations(rows, "o_orderkey", evidence.schema_rules(schema, rows.schema))


_BENEFITS = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'E' || (l_partkey % 5) AS evidence, ['需要适配','当前不适用','随便'][l_suppkey % 3 + 1] AS way, CASE WHEN l_linenumber = 2 THEN '已获得收益' ELSE '' END AS state, CASE WHEN l_returnflag = 'R' THEN 'dismiss' ELSE 'modify' END AS action FROM lineitem"


@query("v5_benefit_rules", f"""WITH r AS ({_BENEFITS}), v AS (SELECT 'acquisition' AS rule, 'error' AS severity FROM r WHERE way = '随便' UNION ALL SELECT 'obtained', 'error' FROM r WHERE state = '已获得收益' AND evidence <> 'E4'
UNION ALL SELECT 'dismissed', 'warning' FROM r WHERE way = '当前不适用' AND action <> 'dismiss' UNION ALL SELECT 'closed', 'warning' FROM r WHERE way = '需要适配' AND evidence IN ('E0', 'E1')) SELECT rule, severity, count(*) AS n FROM v GROUP BY 1, 2""")
def v5(t):
    way, state = pick(c("l_suppkey"), "需要适配", "当前不适用", "随便"), F.when(c("l_linenumber") == 2, "已获得收益").otherwise("")
    action = F.when(c("l_returnflag") == "R", "dismiss").otherwise("modify")
    rules = decisions.benefit_rules(way, [F.lit("高")], state, action, text_of("E", (c("l_partkey") % 5).cast("string")))
    return evidence.violations(t("lineitem"), "l_orderkey", rules).groupBy("rule", "severity").agg(F.count("*").alias("n"))


@query("v8_record_rules", """WITH r AS (SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) || '00000000' AS hash, o_orderkey % 4 = 0 AS skip, o_orderpriority AS p, o_orderstatus AS st, o_custkey % 3 > 0 AS files FROM orders)
SELECT o_orderkey, 'files' AS rule, 'error' AS severity FROM r WHERE NOT files UNION ALL SELECT o_orderkey, 'priority', 'error' FROM r WHERE p = '4-NOT SPECIFIED' UNION ALL SELECT o_orderkey, 'skip', 'error' FROM r WHERE skip AND NOT (p = '5-LOW' AND st = 'F')
UNION ALL SELECT o_orderkey, 'tests', 'error' FROM r WHERE p IN ('1-URGENT', '2-HIGH') AND st = 'O' UNION ALL SELECT o_orderkey, 'steps', 'error' FROM r WHERE NOT skip AND st = 'F'""")
def v8(t):
    some, none = F.array(F.lit("x")), F.array().cast("array<string>")
    priority, skip = c("o_orderpriority"), c("o_orderkey") % 4 == 0
    rules = decisions.record_rules(
        F.concat(F.md5(s("o_orderkey").cast("binary")), F.lit("00000000")), F.when(c("o_custkey") % 3 > 0, some).otherwise(none), {"priority": (priority, ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"])},
        skip, (priority == "5-LOW") & (c("o_orderstatus") == "F"), F.when(c("o_orderstatus") == "F", none).otherwise(some), priority.isin("1-URGENT", "2-HIGH"), F.when(c("o_orderstatus") == "O", none).otherwise(some),
    )
    return evidence.violations(t("orders"), "o_orderkey", rules)


@query("v9_reconciled", """WITH x AS (SELECT 'parts' AS name, (SELECT count(*) FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 30)) AS missing, (SELECT count(DISTINCT l_partkey) FROM lineitem WHERE l_quantity > 30 AND l_partkey NOT IN (SELECT p_partkey FROM part)) AS extra
UNION ALL SELECT 'customers', (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)), 0 UNION ALL SELECT 'totals', 0, 0) SELECT name, missing, extra, missing + extra = 0 AS passed FROM x""")
def v9(t):
    total = t("orders").agg(F.count("*").alias("n"))
    return lookups.reconciled({
        "parts": (t("part").select("p_partkey"), t("lineitem").where("l_quantity > 30").select(c("l_partkey").alias("p_partkey"))),
        "customers": (t("customer").select("c_custkey"), t("orders").select(c("o_custkey").alias("c_custkey"))), "totals": (total, t("orders").groupBy("o_orderstatus").count().agg(F.sum("count").alias("n"))),
    })


@query("v10_probes", """
WITH n AS (SELECT CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS BIGINT) AS before FROM orders)
SELECT name, delta, passed FROM n, (
  SELECT 'open' AS name, CAST(1 AS BIGINT) AS delta, TRUE AS passed FROM orders WHERE o_orderstatus <> 'O' HAVING count(*) > 0
  UNION ALL SELECT 'close', -1, TRUE FROM orders WHERE o_orderstatus = 'O' HAVING count(*) > 0 UNION ALL SELECT 'same', 0, TRUE FROM orders WHERE o_orderstatus = 'O' HAVING count(*) > 0)""")
def v10(t):
    orders = t("orders").select("o_orderkey", c("o_orderstatus").alias("state"))
    flips = {"open": F.when(c("state") != "O", "O"), "close": F.when(c("state") == "O", "F"), "same": F.when(c("state") == "O", "O")}
    return lookups.probed(orders, "o_orderkey", "state", flips, lambda s: F.when(s == "O", 1).otherwise(0), {"open": 1, "close": -1, "same": 0}).where("delta IS NOT NULL").select("name", c("delta").cast("long").alias("delta"), "passed")


@query("v10_probe_deltas", """
WITH cents AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(round(o_totalprice * 100) AS BIGINT) AS price FROM orders),
total AS (SELECT CAST(sum(price) FILTER (WHERE o_orderstatus = 'O') AS BIGINT) AS before FROM cents),
probe AS (SELECT 'closes' AS name, o_orderkey, -price AS delta FROM cents WHERE o_orderstatus = 'O' UNION ALL SELECT 'opens', o_orderkey, price FROM cents WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
  UNION ALL SELECT 'stays', o_orderkey, 0 FROM cents WHERE o_orderstatus = 'P')
SELECT name, o_orderkey, before, delta, name <> 'opens' AS passed FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY o_orderkey) AS n FROM probe), total WHERE n = 1""")
def v10_deltas(t):
    price = F.round(c("o_totalprice") * 100).cast("long")
    orders = t("orders").withColumn("price", price)
    flips = {"closes": F.when(c("o_orderstatus") == "O", "F"), "opens": F.when((c("o_orderstatus") == "F") & (c("o_orderpriority") == "1-URGENT"), "O"), "stays": F.when(c("o_orderstatus") == "P", "F")}
    # what opens is said not to move the sum, so that probe has not passed
    out = lookups.probed(orders, "o_orderkey", "o_orderstatus", flips, lambda s: F.when(s == "O", c("price")).otherwise(0), {"closes": -c("price"), "opens": 0, "stays": 0})
    return out.where("delta IS NOT NULL")


@query("x6_differing_content", """
WITH a AS (SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders),
b AS (SELECT 'same' AS name, * FROM a UNION ALL SELECT 'changed', o_orderkey, CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM a) THEN 'X' ELSE o_orderstatus END, o_orderdate FROM a
  UNION ALL SELECT 'repeated', * FROM a UNION ALL SELECT 'repeated', * FROM a WHERE o_orderstatus = 'P' UNION ALL SELECT 'fewer', * FROM a WHERE o_orderstatus <> 'P')
SELECT n.name, (SELECT count(*) FROM (SELECT o_orderkey, o_orderstatus, o_orderdate FROM b WHERE b.name = n.name EXCEPT ALL SELECT * FROM a)) = 0 AND count(*) = (SELECT count(*) FROM a) AS same,
  (SELECT count(*) FROM a) AS expected_rows, count(*) AS actual_rows FROM b n GROUP BY n.name""")
def x6_differing(t):
    rows = t("orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    last = rows.agg(F.max("o_orderkey").alias("last"))
    changed = rows.join(F.broadcast(last)).select("o_orderkey", F.when(c("o_orderkey") == c("last"), "X").otherwise(c("o_orderstatus")).alias("o_orderstatus"), "o_orderdate")
    partial = c("o_orderstatus") == "P"
    others = {"same": rows.where(partial).unionByName(rows.where(~partial)).select("o_orderdate", "o_orderstatus", "o_orderkey"), "changed": changed, "repeated": rows.union(rows.where(partial)), "fewer": rows.where(~partial)}
    out = None
    for name, actual in others.items():
        one = lookups.same_content(rows, actual).select(F.lit(name).alias("name"), "same", "expected_rows", "actual_rows").where("actual_rows > 0")
        out = one if out is None else out.unionAll(one)
    return out


@query("x6_same_content", "SELECT TRUE AS same, count(*) AS expected_rows, count(*) AS actual_rows FROM orders")
def x6(t):
    rows = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    again = rows.where("o_orderstatus = 'O'").unionByName(rows.where("o_orderstatus <> 'O' OR o_orderstatus IS NULL").select("o_totalprice", "o_custkey", "o_orderkey", "o_orderstatus"))
    return lookups.same_content(rows, again)


def _named(t):
    """Mapping rows whose files and owners are names."""
    return _relations(t).withColumns({"file": text_of("f", s("file")), "owner": text_of("S", s("owner")), "turn": c("idx") % 3})


def _tree(t):
    return t("part").where("p_size >= 10").select(text_of("f", s("p_partkey")).alias("path"))


_NAMED = """SELECT l_orderkey * 1000000 + l_partkey * 100 + l_suppkey % 10 * 10 + l_linenumber AS idx, 'f' || l_partkey AS file, 'S' || l_suppkey AS owner, l_orderkey % 4 AS risk, l_linestatus = 'F' AS ok,
  ['override','same_name_protocol','call','monkey_patch'][l_linenumber % 4 + 1] AS relation FROM lineitem"""
_TREE = "file IN (SELECT 'f' || p_partkey FROM part WHERE p_size >= 10)"
_BEST = "SELECT file, owner, ['low','medium','high','critical'][risk + 1] AS risk, idx, n AS n_sources FROM (SELECT *, row_number() OVER (PARTITION BY file, owner ORDER BY risk DESC, ok DESC, idx) AS rn, count(*) OVER (PARTITION BY file, owner) AS n FROM r) WHERE rn = 1"


@query("m_fields", f"WITH r AS (SELECT idx, CASE WHEN owner = 'S3' THEN 'f1' ELSE file END AS file, owner, least(risk, 1) AS risk, ok FROM ({_NAMED}) WHERE idx % 3 <> 0), r2 AS (SELECT * FROM r WHERE {_TREE}) {_BEST.replace('FROM r)', 'FROM r2)')}")
def m_fields(t):
    rows = _named(t).withColumn("attribute", F.when(c("turn") == 0, "torch.nn.x").otherwise("self.x"))
    return mappings.optimized_fields(rows, ["file", "owner"], "idx", ["file"], _tree(t), {"S3": "f1"}, "attribute", ["torch"])[1].select("file", "owner", "risk", "idx", "n_sources")


@query("m_calls", f"WITH r AS (SELECT idx, file, owner, CASE WHEN ok THEN risk ELSE least(risk, 1) END AS risk, ok FROM ({_NAMED}) WHERE idx % 3 <> 0 AND {_TREE}) {_BEST}")
def m_calls(t):
    rows = _named(t).withColumns({"callee": F.when(c("turn") == 0, "pkg.Unit").otherwise("pkg.run"), "member": F.lit("forward"), "words": F.array(F.lit("old"))})
    return mappings.optimized_calls(rows, ["file", "owner"], "idx", ["file"], _tree(t), "callee", "member", "words")[1].where("size(words) = 0").select("file", "owner", "risk", "idx", "n_sources")


@query("m_registrations", f"WITH r AS (SELECT idx, file, owner, CASE WHEN relation = 'monkey_patch' THEN 0 ELSE risk END AS risk, ok FROM ({_NAMED}) WHERE {_TREE}) {_BEST}")
def m_registrations(t):
    return mappings.optimized_registrations(_named(t), ["file", "owner"], "idx", ["file"], _tree(t), {"monkey_patch": "build_reference"})[1].select("file", "owner", "risk", "idx", "n_sources")


@query("g2_resolved_bases", "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'pkg.base.Parent' WHEN s_suppkey % 3 = 1 THEN 'pkg.base.Other' ELSE 'Local' END AS base FROM supplier")
def g2(t):
    base = pick(c("s_suppkey"), "P", "m.Other", "Local")
    text = text_of("from pkg.base import Parent as P\nimport pkg.base as m\nclass Unit(", base, "):\n    pass\n")
    return contracts.resolved_bases(contracts.symbols(t("supplier").select("s_suppkey", text.alias("text")), ["s_suppkey"]), ["s_suppkey"]).select("s_suppkey", "base")
