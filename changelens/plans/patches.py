"""Queries over patches, forwarded contracts, adapted copies, calls and renames. Sources are texts made from parts, one module for each size."""

from __future__ import annotations

from pyspark.sql import functions as F

from changelens.operators import contracts, graph, patches, store
from changelens.plans.queries import query
from changelens.sources import renames

c = F.col


def _text(*parts):
    """A text of pieces: names of columns between literals."""
    return F.concat(*(c(p[1:]).cast("string") if p.startswith("$") else F.lit(p) for p in parts))


def _upstream(t):
    """Deltas of the callables of modules up.m<size>: what the new text does to the old depends on the size."""
    modules = t("part").select("p_size", F.concat(F.lit("up.m"), "p_size").alias("module")).distinct()
    run, stop = "    def run(self, a, b=1):\n        return a\n", "    def stop(self):\n        return 0\n"
    kind, old = c("p_size") % 6, F.lit(f"class Unit:\n{run}{stop}def top(a):\n    return a\n")
    unit = (
        F.when(kind == 1, F.lit(f"class Unit:\n{run.replace('b=1', 'b')}{stop}")).when(kind == 2, F.lit(f"class Unit:\n{run.replace('run', 'begin')}{stop}"))
        .when(kind == 3, F.lit(f"class Unit:\n{stop}")).when(kind == 4, F.lit("x = 1\n")).otherwise(F.lit(f"class Unit:\n{run}{stop}"))
    )
    new = F.concat(unit, F.when(c("p_size") % 5 == 0, F.lit("def top(a, more=0):\n    return a\n")).when(c("p_size") % 5 == 1, F.lit("")).otherwise(F.lit("def top(a):\n    return a\n")))
    sides = modules.select("module", F.explode(F.array(F.struct(F.lit(0).alias("side"), old.alias("text")), F.struct(F.lit(1).alias("side"), new.alias("text")))).alias("s")).select("module", "s.*")
    found = store.written(contracts.symbols(sides, ["module", "side"], kinds={"callable", "class"}), "upstream")
    return modules, contracts.callable_deltas(found.where("side = 0").drop("side"), found.where("side = 1").drop("side"), ["module"])


def _downstream(t, kinds):
    """Symbols of a source for each part that patches its size's module."""
    text = _text(
        "import up.m", "$p_size", " as base\nfrom up.m", "$p_size", " import Unit as Base\nfrom mine.m", "$p_size", " import top as inner\nfrom elsewhere import thing\n",
        "class Mine:\n    def begin(self):\n        return 1\n",
        "def helper(x):\n    return deep(x) + len(x)\ndef deep(x):\n    return inner(x)\n",
        "def apply():\n    if ready:\n        if base.level > ", "$p_partkey", ":\n            Base.run = helper\n        else:\n            base.Unit.stop = Mine.begin\n    thing.run = helper\n    base.none = helper\n",
    )
    more = F.when(c("p_partkey") % 2 == 1, F.lit("base.top = helper\n")).otherwise(F.lit("base.top = unknown\n"))
    again = F.when(c("p_partkey") % 4 == 0, F.lit("Base.run = helper\n")).otherwise(F.lit(""))
    return contracts.symbols(t("part").select(c("p_partkey").alias("path"), F.concat(text, more, again).alias("text")), ["path"], kinds=kinds, bodies=False)


_UNIT = "CASE p_size % 6 WHEN 1 THEN 'signature_changed' WHEN 2 THEN 'renamed' WHEN 3 THEN 'removed' WHEN 4 THEN 'owner_removed' END"
_TOP = "CASE p_size % 5 WHEN 0 THEN 'signature_changed' ELSE 'removed' END"


@query("d7_patch_bindings", f"""
SELECT p_partkey AS path, '' AS class, 'helper' AS method, 'up.m' || p_size AS module, 'Unit' AS target_class, 'run' AS target_method, {_UNIT} AS delta, 'up.m' || p_size || '.Unit.run' AS target,
  'apply' AS scope, 'ready and base.level > ' || p_partkey AS guard, CASE WHEN p_partkey % 4 = 0 THEN 'apply,module_import' ELSE 'apply' END AS scopes FROM part WHERE p_size % 6 BETWEEN 1 AND 4
UNION ALL SELECT p_partkey, 'Mine', 'begin', 'up.m' || p_size, 'Unit', 'stop', 'owner_removed', 'up.m' || p_size || '.Unit.stop', 'apply', 'ready', 'apply' FROM part WHERE p_size % 6 = 4
UNION ALL SELECT p_partkey, '', 'helper', 'up.m' || p_size, '', 'top', {_TOP}, 'up.m' || p_size || '.top', 'module_import', '', 'module_import' FROM part WHERE p_size % 5 < 2 AND p_partkey % 2 = 1""")
def d7(t):
    modules, deltas = _upstream(t)
    found = store.written(_downstream(t, patches.PATCH_KINDS), "downstream")
    out = patches.patch_bindings(found, modules.select("module"), deltas)
    scopes = F.array_join(F.transform("occurrences", lambda o: o["scope"]), ",").alias("scopes")
    return out.select("path", "class", "method", "module", "target_class", "target_method", "delta", "target", "scope", "guard", scopes)


@query("d7_enclosing", """
WITH spans AS (SELECT l_suppkey AS file, l_orderkey AS lo, l_orderkey + CAST(l_quantity * l_quantity * l_linenumber AS BIGINT) AS hi FROM lineitem WHERE l_returnflag = 'R')
SELECT l_suppkey AS file, l_orderkey AS at, count(*) AS n, max(lo) AS innermost, min(lo) AS outermost FROM (SELECT DISTINCT l_suppkey, l_orderkey FROM lineitem WHERE l_returnflag = 'N') JOIN spans ON file = l_suppkey AND l_orderkey BETWEEN lo AND hi GROUP BY 1, 2""")
def d7_enclosing(t):
    from changelens.operators.relational import enclosing

    spans = t("lineitem").where("l_returnflag = 'R'").select(c("l_suppkey").alias("file"), c("l_orderkey").alias("lo"), (c("l_orderkey") + (c("l_quantity") * c("l_quantity") * c("l_linenumber")).cast("long")).alias("hi"))
    points = t("lineitem").where("l_returnflag = 'N'").select(c("l_suppkey").alias("file"), c("l_orderkey").alias("at")).distinct()
    return enclosing(points, spans, ["file"]).groupBy("file", "at").agg(F.count("*").alias("n"), F.max("lo").alias("innermost"), F.min("lo").alias("outermost"))


@query("g4_call_closure", f"""
SELECT p_partkey || ':helper' AS start, 'mine.m' || p_size || ':top' AS node, p_partkey || ':helper>' || p_partkey || ':deep>mine.m' || p_size || ':top' AS path, {_TOP} AS delta
FROM part WHERE p_size % 5 < 2 AND (p_size % 6 BETWEEN 1 AND 4 OR p_partkey % 2 = 1)""")
def g4_closure(t):
    modules, deltas = _upstream(t)
    found = store.written(_downstream(t, patches.PATCH_KINDS | patches.CALL_KINDS), "downstream")
    bindings = patches.patch_bindings(found, modules.select("module"), deltas)
    twins = modules.select(F.concat(F.lit("mine.m"), "p_size", F.lit(":top")).alias("node"), "module")
    out = patches.call_closure(bindings, patches.call_edges(found, "mine"), twins, deltas)
    return out.select("start", "node", F.array_join("path", ">").alias("path"), "delta")


@query("d5_already_compatible", """
SELECT p_partkey AS part, p_size % 5 IN (0, 1) AS compatible FROM part""")
def d5(t):
    up_old, up_new, up_hard = (f"class Up:\n    def __init__(self, a, b{x}):\n        self.a = a\n" for x in ("", ", more=None", ", more"))
    # 0: takes the new parameters itself; 1: forwards them over two classes; 2: the class between does not forward; 3: the new parameter is required; 4: forwards without a catch-all of its own
    own = F.when(c("p_size") % 5 == 0, F.lit("a, b, more=1")).when(c("p_size") % 5 == 4, F.lit("a, b")).otherwise(F.lit("x=0, **rest"))
    handed = F.when(c("p_size") % 5 == 0, F.lit("a, b, more=more")).when(c("p_size") % 5 == 4, F.lit("a, b")).otherwise(F.lit("**rest"))
    between = F.when(c("p_size") % 5 == 2, F.lit("a=0, b=0")).otherwise(F.lit("**others"))
    text = F.concat(F.lit("class Mid"), "p_partkey", F.lit("(Up):\n    def __init__(self, y=0, **others):\n        super().__init__("), between, F.lit(")\nclass Low"), "p_partkey", F.lit("(Mid"), "p_partkey", F.lit("):\n    def __init__(self, "), own, F.lit("):\n        super().__init__("), handed, F.lit(")\n"))
    found = store.written(contracts.symbols(t("part").select(c("p_partkey").alias("part"), text.alias("text")), ["part"], kinds={"callable", "base", "forward"}, bodies=False), "overrides")
    sides = t("part").limit(1).select(F.explode(F.array(*(F.struct(F.lit(s).alias("side"), F.lit(x).alias("text")) for s, x in (("old", up_old), ("new", up_new), ("hard", up_hard))))).alias("s")).select("s.*")
    up = contracts.first_callables(store.written(contracts.symbols(sides, ["side"], kinds={"callable"}), "upstream"), ["side"]).select("side", c("owner").alias("class"), c("name").alias("method"), "shape")
    side = lambda s, name: up.where(c("side") == s).select("class", "method", c("shape").alias(name))
    # the class's name says which change it meets
    own_shapes = found.where("kind = 'callable'").select(c("owner").alias("class"), c("name").alias("method"), contracts.shape().alias("shape"))
    shapes = own_shapes.union(side("old", "shape"))
    bases = found.where("kind = 'base'").select(c("owner").alias("class"), c("name").alias("base"), c("line").alias("pos"))
    chains = store.written(contracts.forwarding(shapes, bases, found.where("kind = 'forward'").select(c("owner").alias("class"), c("name").alias("method"))), "chains")
    low = t("part").select("p_partkey", F.concat(F.lit("Low"), "p_partkey").alias("class"), F.lit("Up").alias("base"), F.lit("__init__").alias("method"), (c("p_size") % 5 == 3).alias("hard"))
    judge = lambda rows, new: contracts.already_compatible(rows, shapes, chains, side("old", "old_shape").join(side(new, "new_shape"), ["class", "method"]))
    out = judge(low.where("hard"), "hard").union(judge(low.where("NOT hard"), "new"))
    return out.select(F.expr("substring(class, 4)").cast("long").alias("part"), "compatible")


@query("d10_adapted_callables", """
SELECT p_partkey AS path, 'up/m' || p_size || '.py' AS source, 'top' AS name, CASE p_size % 5 WHEN 0 THEN 'signature_changed' ELSE 'removed' END AS delta FROM part WHERE p_size % 5 < 2 AND p_partkey % 3 > 0 AND p_partkey % 4 <> 2""")
def d10(t):
    mark = F.when(c("p_partkey") % 3 > 0, _text("# Adapted from the project, up/m", "$p_size", ".py, long ago\n")).otherwise(F.lit("# up/m1.py says more\n"))
    bind = F.when(c("p_partkey") % 4 == 2, F.lit("other.top = helper\n")).when(c("p_partkey") % 4 == 1, F.lit("module.top: object = top\n")).otherwise(F.lit("a.b.top = top\n"))
    texts = t("part").select(c("p_partkey").alias("path"), F.concat(mark, F.lit("def top(a):\n    return a\ndef helper(a):\n    return a\n"), bind).alias("text"))
    _, deltas = _upstream(t)
    sources = deltas.withColumn("source", F.concat(F.translate("module", ".", "/"), F.lit(".py")))
    found = store.written(contracts.symbols(texts, ["path"], kinds={"callable", "assign", "annotated"}, bodies=False), "adapted")
    return patches.adapted_callables(patches.source_marks(texts, "up"), found, sources).select("path", "source", "name", "delta")


@query("d10_aligned_callables", """
SELECT p_partkey AS id, p_partkey AS other, CAST(floor(200 * (12 - p_size % 7) / (24 + p_partkey % 3)) AS INTEGER) AS similarity FROM part WHERE floor(200 * (12 - p_size % 7) / (24 + p_partkey % 3)) >= 60""")
def d10_aligned(t):
    # as many of the first statements are others as the size says, and up to two are put in before the last
    statement = lambda mark: F.transform(F.sequence(F.lit(0), F.lit(11)), lambda k: F.concat_ws("/", c("p_partkey").cast("string"), k.cast("string"), mark(k)))
    base, mine = statement(lambda k: F.lit("")), statement(lambda k: F.when(k < c("p_size") % 7, "own").otherwise(""))
    extra = F.transform(F.slice(F.array(F.lit("p"), F.lit("q")), F.lit(1), (c("p_partkey") % 3).cast("int")), lambda x: F.concat(x, c("p_partkey").cast("string")))
    ours = t("part").select(c("p_partkey").alias("id"), F.concat(F.slice(mine, 1, 11), extra, F.slice(mine, 12, 1)).alias("statements"))
    return patches.aligned_callables(ours, t("part").select(c("p_partkey").alias("other"), base.alias("statements")), 60)


@query("g3_paths", """
WITH RECURSIVE edges AS (
  SELECT DISTINCT p_partkey AS src, p_partkey // d AS dst FROM part, (SELECT unnest([2, 3, 5]) AS d) WHERE p_partkey // d > 0 AND p_size <> 7),
reach AS (SELECT p_partkey AS start, p_partkey AS node, 0 AS hops FROM part WHERE p_partkey % 25 = 0 UNION SELECT start, dst, hops + 1 FROM reach JOIN edges ON src = node),
best AS (SELECT start, node, min(hops) AS hops FROM reach GROUP BY 1, 2),
prev AS (SELECT b.start, b.node, min(src) AS before FROM best b JOIN edges ON dst = b.node JOIN best a ON a.start = b.start AND a.node = src AND a.hops = b.hops - 1 WHERE b.hops > 0 GROUP BY 1, 2),
way AS (SELECT start, node, node AS now, [node] AS path FROM best UNION ALL SELECT w.start, w.node, p.before, list_prepend(p.before, w.path) FROM way w JOIN prev p ON p.start = w.start AND p.node = w.now)
SELECT w.start, w.node, hops, array_to_string(path, '>') AS path FROM way w JOIN best b ON b.start = w.start AND b.node = w.node WHERE now = w.start AND len(path) = hops + 1""")
def g3_paths(t):
    edges = t("part").select(c("p_partkey").alias("src"), F.explode(F.array(*(F.floor(c("p_partkey") / d) for d in (2, 3, 5)))).alias("dst")).where("dst > 0")
    starts = t("part").where("p_partkey % 25 = 0").select(c("p_partkey").alias("node"))
    out = graph.paths(edges, starts, t("part").where("p_size = 7").select(c("p_partkey").alias("node")))
    return out.select("start", "node", "hops", F.array_join("path", ">").alias("path"))


@query("s5_renames", """
WITH RECURSIVE files AS (SELECT doc_id, replace(text, '. ', '.' || chr(10)) AS text FROM documents WHERE text <> ''),
gone AS (SELECT 'old/' || doc_id AS path, text FROM files),
fresh AS (SELECT 'new/' || doc_id AS path, CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN text || chr(10) || 'One more line, of document ' || doc_id || '.' ELSE substr(text, 1, length(text) * 9 // 10) END AS text FROM files WHERE doc_id % 5 > 0),
same AS (
  SELECT g.path AS old, f.path AS new FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY path) AS n FROM gone) g JOIN (SELECT *, row_number() OVER (PARTITION BY text ORDER BY path) AS n FROM fresh) f USING (text, n)),
o AS MATERIALIZED (SELECT path, line, count(*) AS times FROM (SELECT path, unnest(string_split(text, chr(10))) AS line FROM gone WHERE path NOT IN (SELECT old FROM same)) GROUP BY 1, 2),
f AS MATERIALIZED (SELECT path, line, count(*) AS times FROM (SELECT path, unnest(string_split(text, chr(10))) AS line FROM fresh WHERE path NOT IN (SELECT new FROM same)) GROUP BY 1, 2),
os AS (SELECT path, sum(times * (strlen(line) + 1)) AS size FROM o GROUP BY 1), fs AS (SELECT path, sum(times * (strlen(line) + 1)) AS size FROM f GROUP BY 1),
pairs AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY similarity DESC, md5(old || '>' || new), old, new) AS k FROM (
    SELECT o.path AS old, f.path AS new, CAST(floor(100 * sum(least(o.times, f.times) * (strlen(line) + 1)) / greatest(os.size, fs.size)) AS INTEGER) AS similarity
    FROM o JOIN f USING (line) JOIN os ON os.path = o.path JOIN fs ON fs.path = f.path GROUP BY o.path, f.path, os.size, fs.size) WHERE similarity >= 70),
walk AS (
  SELECT CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS used, CAST(NULL AS VARCHAR) AS old, CAST(NULL AS VARCHAR) AS new, 0 AS similarity
  UNION ALL SELECT p.k, CASE WHEN list_has_any(used, [p.old, p.new]) THEN used ELSE list_concat(used, [p.old, p.new]) END, CASE WHEN NOT list_has_any(used, [p.old, p.new]) THEN p.old END, p.new, p.similarity FROM walk w JOIN pairs p ON p.k = w.k + 1)
SELECT old, new, 100 AS similarity FROM same UNION ALL SELECT old, new, similarity FROM walk WHERE old IS NOT NULL""")
def s5_renames(t):
    files = t("documents").where("text <> ''").select("doc_id", F.replace("text", F.lit(". "), F.lit(".\n")).alias("text"))
    old = files.select(F.concat(F.lit("old/"), "doc_id").alias("path"), "text")
    kind = c("doc_id") % 3
    text = F.when(kind == 0, c("text")).when(kind == 1, F.concat("text", F.lit("\nOne more line, of document "), "doc_id", F.lit("."))).otherwise(F.substring("text", F.lit(1), F.floor(F.length("text") * 9 / 10).cast("int")))
    new = files.where("doc_id % 5 > 0").select(F.concat(F.lit("new/"), "doc_id").alias("path"), text.alias("text"))
    return renames.renames(old, new)


@query("c17_signatures", """
SELECT p_partkey, 'def run(self,' || coalesce((SELECT string_agg(' a' || k || '=(' || k || ', 1),', '' ORDER BY k) FROM unnest(range(least(p_size, 39))) AS r(k)), '') || CASE WHEN p_size <= 38 THEN ' ) -> int:' ELSE '' END AS signature FROM part""")
def c17(t):
    from changelens.functions.text import signature

    middle = F.transform(F.sequence(F.lit(1), c("p_size")), lambda k: F.concat(F.lit("    a"), k - 1, F.lit("=("), k - 1, F.lit(", 1),")))
    lines = F.concat(F.array(F.lit("@mark(1)"), F.lit("def run(self,")), F.when(c("p_size") > 0, middle).otherwise(F.array().cast("array<string>")), F.array(F.lit("  )  ->  int:"), F.lit("    return (0):"), F.lit("x = 1:")))
    return store.spread(t("part").select("p_partkey", "p_size")).select("p_partkey", signature(lines, F.lit(2)).alias("signature"))


@query("d13_touched", """
SELECT p_partkey, CASE WHEN p_size % 7 = 6 THEN NULL ELSE p_size % 7 IN (1, 2, 4) END AS touched FROM part""")
def d13(t):
    run, other = "class Unit:\n    def run(self, a):\n        return a\n", "class Other:\n    def run(self, a):\n        return 2\n"
    kind = c("p_size") % 7
    new = (
        F.when(kind == 1, F.lit(run.replace("return a", "return a + 1"))).when(kind == 2, F.lit(run.replace("self, a", "self, a, b")))
        .when(kind == 3, F.lit(run + other)).when(kind == 4, F.lit("class Unit:\n    pass\n")).when(kind == 5, F.lit(run.replace("self, a", "self,   a"))).when(kind == 6, F.lit("class Unit(:\n")).otherwise(F.lit(run))
    )
    texts = t("part").select("p_partkey", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.lit(run).alias("text")), F.struct(F.lit(1).alias("side"), new.alias("text")))).alias("s")).select("p_partkey", "s.*")
    found = store.written(contracts.symbols(texts, ["p_partkey", "side"], kinds={"callable"}), "scoped")
    asked = t("part").select("p_partkey", F.lit("Unit").alias("owner"), F.lit("run").alias("name"))
    return contracts.touched(asked, found.where("side = 0").drop("side"), found.where("side = 1").drop("side"), ["p_partkey"]).select("p_partkey", "touched")


@query("d8_import_deltas", """
SELECT p_partkey, 'up.m' || p_size AS module, name, CASE WHEN p_size % 4 = 1 THEN CASE WHEN p_size % 8 = 1 THEN 'module_relocated' ELSE 'module_removed' END
  WHEN name = 'gone' THEN CASE WHEN p_size % 4 = 2 THEN 'symbol_renamed' ELSE 'symbol_removed' END ELSE 'owner_changed' END AS delta FROM part, (SELECT unnest(['gone', 'kept', 'changes']) AS name)
WHERE p_size % 4 = 1 OR (p_size % 4 IN (2, 3) AND name = 'gone') OR (p_size % 4 = 3 AND name = 'changes')""")
def d8(t):
    old = "def gone(a):\n    return 5\ndef kept(a):\n    return 1\nclass changes:\n    def run(self):\n        return 1\n"
    kind = c("p_size") % 4
    new = F.when(kind == 2, F.lit(old.replace("gone", "went"))).when(kind == 3, F.lit("def kept(a):\n    return 1\nclass changes:\n    def run(self):\n        return 2\n")).otherwise(F.lit(old))
    modules = t("part").select("p_size").distinct().select("p_size", F.concat(F.lit("up.m"), "p_size").alias("module"))
    was = contracts.symbols(modules.withColumn("text", F.lit(old)), ["module"], kinds={"callable", "class"})
    now = contracts.symbols(modules.where(kind != 1).withColumn("text", new), ["module"], kinds={"callable", "class"})
    moved = modules.where("p_size % 8 = 1").select(c("module").alias("old_module"), F.concat(F.lit("new."), "module").alias("new_module"))
    imports = t("part").select("p_partkey", F.concat(F.lit("up.m"), "p_size").alias("owner"), F.explode(F.array(F.lit("gone"), F.lit("kept"), F.lit("changes"))).alias("name"))
    was, now = store.written(was, "old-modules"), store.written(now, "new-modules")
    out = contracts.import_deltas(imports, was, now, moved).select("p_partkey", c("owner").alias("module"), "name", "delta")
    return out.union(contracts.owner_deltas(imports, was, now).select("p_partkey", c("owner").alias("module"), "name", "delta"))


@query("s14_set_digest", """
WITH leaves AS (SELECT sha256(CAST(doc_id AS VARCHAR)) AS key, sha256(CAST(doc_id AS VARCHAR)) || sha256(coalesce(text, '')) AS entry FROM documents),
l3 AS (SELECT substr(key, 1, 3) AS p, sha256(string_agg(entry, '' ORDER BY entry)) AS d, count(*) AS n FROM leaves GROUP BY 1),
l2 AS (SELECT substr(p, 1, 2) AS p, sha256(string_agg(p || d, '' ORDER BY p || d)) AS d, sum(n) AS n FROM l3 GROUP BY 1),
l1 AS (SELECT substr(p, 1, 1) AS p, sha256(string_agg(p || d, '' ORDER BY p || d)) AS d, sum(n) AS n FROM l2 GROUP BY 1)
SELECT sha256(coalesce(string_agg(p || d, '' ORDER BY p || d), '')) AS digest, CAST(coalesce(sum(n), 0) AS BIGINT) AS files FROM l1""")
def s14(t):
    from changelens.sources import digests

    files = t("documents").select(c("doc_id").cast("string").alias("path"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha256"))
    return digests.set_digest(files)
