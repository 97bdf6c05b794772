"""Contracts, mappings and decisions on small cases of their own."""

import itertools

import pytest
from pyspark.sql import functions as F

from changelens import registry
from changelens.operators import contracts, decisions, evidence, mappings


def _symbols(spark, *texts, key="path"):
    rows = [(f"f{k}", t) for k, t in enumerate(texts)]
    return contracts.symbols(spark.createDataFrame(rows, f"{key} string, text string"), [key])


def _delta(spark, old, new):
    rows = contracts.callable_deltas(_symbols(spark, old), _symbols(spark, new), ["path"]).collect()
    return {(r.owner, r.name): (r.delta, r.renamed_to) for r in rows if r.delta != "same"}


@pytest.mark.parametrize(
    ("old", "new", "expected"),
    [
        ("class A:\n def f(self, x): return 1\n", "class A:\n def f(self, x): return 1\nclass B:\n def f(self): return 2\n", {("B", "f"): ("introduced", None)}),
        ("class A:\n def f(self): return 1\n", "class A:\n def f(self): return 2\n", {("A", "f"): ("body_changed", None)}),
        ("def f(a): pass\n", "def f(a, b): pass\n", {("", "f"): ("signature_changed", None)}),
        ("def f(a):\n  return a+1\n", "def f( a ):\n    return a + 1\n", {}),
        ("def f(a): return a\n", "def g(a): return a\n", {("", "f"): ("renamed", "g"), ("", "g"): ("introduced", None)}),
        ("def f(a): return a\n", "def g(a): return a\ndef h(a): return a\n", {("", "f"): ("removed", None), ("", "g"): ("introduced", None), ("", "h"): ("introduced", None)}),
        ("class A:\n def f(self): pass\n", "x = 1\n", {("A", "f"): ("owner_removed", None)}),
        ("def f(a): pass\n", "def f(a:\n", {("", "f"): ("unresolved", None)}),
        ("def f(a): pass\ndef f(b): pass\n", "def f(a): pass\n", {}),
    ],
)
def test_callable_deltas(spark, old, new, expected):
    assert _delta(spark, old, new) == expected


def test_accepts(spark):
    cases = [
        ("a", "a", True), ("a", "a, b=1", True), ("a", "a, b", False), ("a, b=1", "a, b", False), ("a", "b", False), ("a, b", "a", False), ("a", "a, *, k=1", True),
        ("a", "a, *, k", False), ("a, *, k", "a, **kw", False), ("a, *, k", "a, *, k=1", True), ("a, *r", "a", False), ("a, *r", "a, *rest", True), ("a, **k", "a", False),
    ]
    expected, actual = (contracts.first_callables(_symbols(spark, *[f"def f({c[k]}): pass\n" for c in cases]), ["path"]).select("path", F.col("shape").alias(n)) for k, n in ((0, "e"), (1, "a")))
    got = {r.path: r.ok for r in expected.join(actual, "path").select("path", contracts.accepts(F.col("e"), F.col("a")).alias("ok")).collect()}
    assert got == {f"f{k}": c[2] for k, c in enumerate(cases)}


def test_symbols_of_odd_texts(spark):
    found = _symbols(spark, "", None, "def broken(", "x = '\u00fc'\n", "import a.b as c\nfrom m import n as o\nfrom . import p\n")
    assert sorted((r.path, r.kind, r.owner, r.name, r.detail) for r in found.collect()) == [("f2", "error", None, None, None), ("f4", "import", "a.b", None, "c"), ("f4", "import", "m", "n", "o")]


def test_keywords_and_fields(spark):
    old = "class A:\n def f(self):\n  self.x = 1\n  self.y = 1\n  g(1, k=2)\n  h(m=1)\n"
    new = "class A:\n def f(self):\n  self.x = 2\n  self.z = 1\n  g(1, j=2)\n  h(m=1); h(m=1)\n"
    a, b = _symbols(spark, old), _symbols(spark, new)
    assert [(r.name, r.added, r.removed) for r in contracts.keyword_deltas(a, b, ["path"]).collect()] == [("g", ["j"], ["k"])]
    assert {(r.name, r.delta) for r in contracts.field_deltas(a, b, ["path"]).collect()} == {("x", "changed"), ("y", "removed"), ("z", "introduced")}


def test_import_deltas(spark):
    texts = lambda *rows: contracts.symbols(spark.createDataFrame(rows, "module string, text string"), ["module"])
    old = texts(("m", "def f(a): return a\ndef g(): pass\ndef k(): return 3\n"), ("gone", "class C: pass\n"), ("moved", "class D: pass\n"))
    new = texts(("m", "def f2(a): return a\ndef k(): return 3\n"), ("here", "class D: pass\n"))
    imports = spark.createDataFrame([("m", "f"), ("m", "g"), ("m", "k"), ("gone", "C"), ("moved", "D"), ("never", "X")], "owner string, name string")
    renames = spark.createDataFrame([("moved", "here")], "old_module string, new_module string")
    got = {(r["owner"], r["name"]): (r["delta"], r["destination"]) for r in contracts.import_deltas(imports, old, new, renames).collect()}
    assert got == {("m", "f"): ("symbol_renamed", "f2"), ("m", "g"): ("symbol_removed", None), ("gone", "C"): ("module_removed", None), ("moved", "D"): ("module_relocated", "here")}


def test_methods_are_found_depth_first(spark):
    # C3 would take D's method from C; depth first, left to right, takes it from A, the base of B
    classes = spark.createDataFrame([(n,) for n in "ABCDX"], "class string")
    bases = spark.createDataFrame([("D", "B", 0), ("D", "C", 1), ("B", "A", 0), ("C", "A", 0), ("X", "X", 0)], "class string, base string, pos int")
    methods = spark.createDataFrame([("A", "m"), ("C", "m"), ("C", "only")], "class string, method string")
    got = {(r["class"], r["method"]): (r["owner"], r["hops"]) for r in contracts.method_owners(classes, bases, methods).collect()}
    assert got == {("A", "m"): ("A", 0), ("B", "m"): ("A", 1), ("C", "m"): ("C", 0), ("C", "only"): ("C", 0), ("D", "m"): ("A", 2), ("D", "only"): ("C", 1)}


MAPPING = "idx long, file string, owner string, callee string, relation string, risk string, relationship_verified boolean, verification_status string"


def test_mappings(spark):
    rows = [
        (0, "a", "o", None, "override", "low", None, None), (1, "a", "o", None, "override", "high", False, None), (2, "a", "o", None, "override", "high", True, "verified"),
        (3, "b", None, None, "same_name_protocol", "critical", True, "verified"), (4, "c", None, None, "call", "odd", None, None), (5, "c", None, None, "call", None, None, None), (6, "x", "o", None, "call", "low", None, None),
    ]
    df = spark.createDataFrame(rows, MAPPING)
    tree = spark.createDataFrame([("a",), ("b",), ("c",)], "path string")
    kept = mappings.existing_only(df, ["file"], tree)
    out = mappings.one_per_key(mappings.downgraded(kept), ["file", "owner"], "idx", ["relation"])
    got = {(r.file, r.owner): (r.idx, r.relation, r.risk, r.confidence, r.source_indexes, len(r.occurrences)) for r in out.collect()}
    assert got == {("a", "o"): (2, "override", "high", "high", [0, 1, 2], 1), ("b", None): (3, "same_name_candidate", "low", "low", [3], 1), ("c", None): (5, "call", None, "medium", [4, 5], 1)}
    assert mappings.statistics(df, kept, out).first().asDict() == {"input_total": 7, "output_total": 3, "removed_total": 1, "deduplicated": 3}
    assert mappings.statistics(*[d.limit(0) for d in (df, kept, out)]).first()["input_total"] == 0
    assert mappings.existing_only(df, ["file"], None) is df
    assert [r.idx for r in mappings.first_published(df, ["file", "owner"], "idx").orderBy("idx").collect()] == [0, 6]


def test_provenance_of_a_hot_key(spark):
    hot = spark.range(3000).select(F.col("id").alias("idx"), F.when(F.col("id") % 3 > 0, F.lit(None)).otherwise(F.col("id")).cast("string").alias("file"), F.lit("o").alias("owner"))
    hot = hot.withColumns({"relation": F.when(F.col("idx") % 2 == 0, "call").otherwise("override"), "risk": F.lit("low"), "relationship_verified": F.col("idx") == 2999, "verification_status": F.lit("verified")})
    keys, rows = ["file", "owner"], mappings.downgraded(hot)
    best = mappings.winners(rows, keys, "idx")
    assert best.count() == 1001
    assert [(r.idx, r.n_sources, r.source_relations) for r in best.where("file IS NULL").collect()] == [(2999, 2000, ["call", "override"])]
    found = mappings.provenance(rows, keys, "idx").where("file IS NULL")
    assert sorted(r.source_index for r in found.collect()) == [k for k in range(3000) if k % 3]
    assert sorted((r.relation, r.source_index) for r in mappings.occurrences(rows, keys, "idx", ["relation"]).where("file IS NULL").collect()) == [("call", 2), ("override", 1)]
    plan = registry.QUERIES["m_optimized_mappings"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "n_sources" in plan


def test_mapping_rewrites(spark):
    df = spark.createDataFrame([("Config", "old.py", "m.Config", "f", "critical"), ("Other", "o.py", "m.call", "f", "odd"), (None, None, "Config", "__init__", None)], "owner string, file string, callee string, member string, risk string")
    assert [r.file for r in mappings.canonical_files(df, "owner", "file", {"Config": "config.py"}).collect()] == ["config.py", "o.py", None]
    assert [r.owner for r in mappings.without_fan_out(df, "callee", "member").collect()] == ["Other", None]
    assert [r[0] for r in df.select(mappings.capped(F.col("risk"), "medium")).collect()] == ["medium", "odd", None]
    assert [r[0] for r in df.select(mappings.risk_rank(F.col("risk"))).collect()] == [3, -1, 0]


def test_whole_bugfix_matrix(spark):
    three = ["是", "否", "未知"]
    grid = [(k, *g) for k, g in enumerate(itertools.product(three, three, [*three, "不适用"], three, ["直接继承修复", "需要适配", "不受影响", "待确认"]))]
    assert len(grid) == 432
    df = spark.createDataFrame(grid, "id int, s string, r string, e string, l string, c string")
    col = F.col
    got = {x.id for x in evidence.violations(df, "id", decisions.bugfix_rules(col("c"), col("s"), col("r"), col("e"), col("l"), F.lit("E2"))).collect()}
    fits = {
        "直接继承修复": lambda s, r, e, lane: (s, r, lane) == ("是", "是", "是"),
        "需要适配": lambda s, r, e, lane: (s, r, e, lane) == ("是", "否", "否", "是"),
        "不受影响": lambda s, r, e, lane: s == "否" or (s, r, e) == ("是", "否", "是"),
        "待确认": lambda s, r, e, lane: "未知" in (s, r, e, lane),
    }
    assert got == {k for k, *state, conclusion in grid if not fits[conclusion](*state)}


def test_optimization_and_common_rules(spark):
    rows = [(0, "x" * 30, "未验证", "E1"), (1, "This is pasted English prose", "快10%", "E1"), (2, "short", "无", "E4"), (3, "y" * 300, "快10%,未验证", "E0")]
    df = spark.createDataFrame(rows, "id int, c string, r string, e string")
    rules = decisions.optimization_rules(F.col("c"), F.col("r"), F.col("e"), ["", "未验证", "无"], ["未验证"])
    assert {(x.id, x.rule) for x in evidence.violations(df, "id", rules).collect()} == {(1, "prose"), (1, "claim"), (2, "short"), (2, "missing"), (3, "long")}
    rows = [(0, "http://h/pull/1", "abcdef0", "2024-01-01T00:00:00Z", "modify", True), (1, "x", "xyz", "never", "other", None), (2, None, "", None, "modify", None)]
    df = spark.createDataFrame(rows, "id int, u string, h string, m string, a string, g boolean")
    rules = decisions.common_rules(F.col("u"), r"^http://h/pull/\d+/?$", [F.col("h")], F.col("m"), F.col("a"), ["modify", "review", "dismiss"], [F.col("g")])
    assert {(x.id, x.rule) for x in evidence.violations(df, "id", rules).collect()} == {(1, "url"), (1, "hash0"), (1, "merged"), (1, "action"), (2, "gate")}


def test_scores_by_relation(spark):
    rows = [("method", True, "same_name", 20, False), ("method", False, "other", 20, False), ("method", True, "", 100, True), ("field", True, "low_signal", 10, False), ("import", True, "owner_changed", 50, False), ("import", True, "symbol_removed", 95, True), ("inheritance", False, "overridden", 30, False), ("inheritance", False, None, 20, False)]
    df = spark.createDataFrame(rows, "t string, d boolean, rel string, want int, want_core boolean")
    out = evidence.scored(df, F.col("t"), F.col("d"), F.lit(True), F.lit(False), F.lit(False), F.col("rel"))
    assert [(r.score, r.core) for r in out.collect()] == [(r[3], r[4]) for r in rows]
