"""What only shows in larger tables: late instants, tables that are no broadcast, work in one task."""

import itertools
import random

from pyspark.sql import functions as F

from changelens import registry
from changelens.functions import text as X
from changelens.operators import contracts, graph, patches, relational, store
from changelens.sources import renames


def test_instants_after_9999(spark):
    want = {0: "1970-01-01T00:00:00Z", -1: "1969-12-31T23:59:59Z", 253402300799: "9999-12-31T23:59:59Z", 253402300800: "10000-01-01T00:00:00Z", 3100000000000: "100205-02-02T15:06:40Z", -62135596801: "0000-12-31T23:59:59Z", 1762061400: "2025-11-02T05:30:00Z", 1762065000: "2025-11-02T06:30:00Z"}
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            assert {r.s: r.t for r in spark.createDataFrame([(s,) for s in want], "s long").select("s", X.iso_instant(F.col("s")).alias("t")).collect()} == want
            assert spark.range(1).select(X.iso_instant(F.lit(None).cast("long"))).first()[0] is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_aligned_callables_send_no_side_to_all_tasks(spark):
    rows = spark.createDataFrame([(k, [f"{k}/{i}" for i in range(12)]) for k in range(20)], "id long, statements array<string>")
    got = patches.aligned_callables(rows, rows.withColumnRenamed("id", "other"), 60)
    assert "Broadcast" not in plan_of(got)
    assert sorted(tuple(r) for r in got.collect()) == [(k, k, 100) for k in range(20)]


def broadcasts(df):
    """The parts of a plan that are sent to all tasks."""
    lines, found = plan_of(df).split("\n"), []
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    for k, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = itertools.takewhile(lambda x: depth(x) > depth(line), lines[k + 1 :])  # noqa: B023
            found.append("\n".join(below))
    return found


PATCH = "import up.core as core\ndef swap(x):\n    return x\nclass Mine:\n    def run(self):\n        pass\ndef apply():\n    if ready:\n        core.free = swap\n        core.Unit.run = Mine.run\n"


def test_patch_bindings_send_no_symbols_to_all_tasks(spark):
    texts = spark.createDataFrame([(f"{k}.py", PATCH) for k in range(9)], "path string, text string")
    found = store.written(contracts.symbols(texts, ["path"], kinds=patches.PATCH_KINDS), "found")
    modules = spark.createDataFrame([("up.core",)], "module string")
    deltas = spark.createDataFrame([("up.core", "", "free", "removed"), ("up.core", "Unit", "run", "renamed")], "module string, owner string, name string, delta string")
    got = patches.patch_bindings(found, modules, deltas)
    assert not [b for b in broadcasts(got) if "kind#" in b]
    assert sorted((r.path, r.method, r.scope, r.guard) for r in got.collect()) == sorted((f"{k}.py", m, "apply", "ready") for k in range(9) for m in ("swap", "run"))


def test_call_closure_sends_no_symbols_or_ways_to_all_tasks(spark, monkeypatch):
    """Nor edges or stops, which are read from tables here."""
    text = "from mine.m import top\nimport up.core as core\ndef swap(x):\n    return deep(x)\ndef deep(x):\n    return top(x)\ncore.free = swap\n"
    texts = spark.createDataFrame([(f"{k}.py", text) for k in range(9)], "path string, text string")
    found = store.written(contracts.symbols(texts, ["path"], kinds=patches.PATCH_KINDS | patches.CALL_KINDS), "found")
    plans, written = [], store.written
    monkeypatch.setattr(store, "written", lambda df, name: plans.append((name, broadcasts(df))) or written(df, name))
    bindings = spark.createDataFrame([(f"{k}.py", "", "swap") for k in range(9)], "path string, class string, method string")
    twins = spark.createDataFrame([("mine.m:top", "up.m")], "node string, module string")
    deltas = spark.createDataFrame([("up.m", "", "top", "removed")], "module string, owner string, name string, delta string")
    got = patches.call_closure(bindings, patches.call_edges(found, "mine"), twins, deltas)
    assert "path-edges" in dict(plans) and not [b for _, sent in plans for b in sent]
    assert not [b for b in broadcasts(got) if "path#" in b]
    assert sorted((r.start, r.path, r.delta) for r in got.collect()) == [(f"{k}.py:swap", [f"{k}.py:swap", f"{k}.py:deep", "mine.m:top"], "removed") for k in range(9)]


def test_adapted_callables_send_no_symbols_to_all_tasks(spark):
    rows = [(f"{k}.py", "# Adapted from up/m.py\ndef top(a):\n    return a\na.b.top = top\n") for k in range(9)]
    texts = store.written(spark.createDataFrame(rows, "path string, text string"), "texts")
    found = store.written(contracts.symbols(texts, ["path"], kinds={"callable", "assign", "annotated"}), "found")
    deltas = spark.createDataFrame([("up/m.py", "", "top", "removed", None)], "source string, owner string, name string, delta string, renamed_to string")
    got = patches.adapted_callables(patches.source_marks(texts, "up"), found, deltas)
    assert not [b for b in broadcasts(got) if "path#" in b]
    assert sorted((r.path, r.delta) for r in got.collect()) == [(f"{k}.py", "removed") for k in range(9)]


def test_touched_sends_no_symbols_to_all_tasks(spark):
    texts = spark.createDataFrame([(k, f"class Unit:\n    def run(self):\n        return {k % 2}\n") for k in range(9)] + [(9, "class Unit(:")], "id long, text string")
    found = store.written(contracts.symbols(texts, ["id"], kinds={"callable"}), "found")
    old = store.written(contracts.symbols(texts.withColumn("text", F.replace("text", F.lit("return 1"), F.lit("return 0"))), ["id"], kinds={"callable"}), "old")
    got = contracts.touched(spark.range(10).select("id", F.lit("Unit").alias("owner"), F.lit("run").alias("name")), old, found, ["id"])
    assert not broadcasts(got)
    assert sorted((r.id, r.touched) for r in got.collect()) == [*((k, k % 2 == 1) for k in range(9)), (9, None)]


def test_enclosing_sends_no_side_to_all_tasks(spark):
    rows = store.written(spark.range(50).select((F.col("id") % 3).alias("file"), "id"), "places")
    got = relational.enclosing(rows.select("file", F.col("id").alias("at")), rows.select("file", F.col("id").alias("lo"), (F.col("id") + 4).alias("hi")), ["file"])
    assert not broadcasts(got)
    assert sorted((r["file"], r["at"], r.lo) for r in got.collect()) == sorted((a % 3, a, b) for a in range(50) for b in range(50) if a % 3 == b % 3 and b <= a <= b + 4)


def test_common_subsequence_of_long_and_missing_texts(spark):
    rng = random.Random(3)
    rows = [([rng.choice(["a", "b", "c", None]) for _ in range(rng.randint(0, 90))], [rng.choice(["a", "b", "c", None]) for _ in range(rng.randint(0, 90))]) for _ in range(20)] + [(None, ["a"]), (["a"], None)]
    for band in (0, 3, 16, 100):
        want = []
        for a, b in rows:
            best = [[0] * (len(b or []) + 1) for _ in range(len(a or []) + 1)]
            for i, x in enumerate(a or []):
                for j, y in enumerate(b or []):
                    best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + 1 if x == y and abs(i - j) <= band else 0)
            want.append(best[-1][-1])
        got = spark.createDataFrame(rows, "a array<string>, b array<string>").coalesce(1).select(patches.common_subsequence(F.col("a"), F.col("b"), band).alias("n")).collect()
        assert [r.n for r in got] == want


def test_signatures_are_read_by_all_cores(spark):
    assert registry.QUERIES["c17_signatures"](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_method_owners_send_no_table_to_all_tasks(spark):
    classes = spark.createDataFrame([(k,) for k in range(1, 9)], "class long")
    bases = spark.createDataFrame([(k, k // 2, 0) for k in range(2, 9)], "class long, base long, pos int")
    got = contracts.method_owners(classes, bases, spark.createDataFrame([(1, "m"), (3, "m")], "class long, method string"))
    assert "Broadcast" not in plan_of(got)
    assert sorted((r["class"], r.owner, r.hops) for r in got.collect()) == [(1, 1, 0), (2, 1, 1), (3, 3, 0), (4, 1, 2), (5, 1, 2), (6, 3, 1), (7, 3, 1), (8, 1, 3)]


def test_paths_are_written_with_their_rounds(spark):
    edges = spark.createDataFrame([(a, b) for a in range(1, 30) for b in (a * 2, a * 3)], "src long, dst long")
    got = graph.paths(edges, spark.createDataFrame([(1,)], "node long"))
    assert "Join" not in plan_of(got) and "Exchange" not in plan_of(got)
    assert {r.node: r.path for r in got.collect()}[12] == [1, 2, 4, 12]


def test_renames_read_texts_once_and_shuffle_none(spark, monkeypatch):
    plans, written = [], store.written
    monkeypatch.setattr(store, "written", lambda df, name: plans.append(plan_of(df)) or written(df, name))
    frame = lambda *rows: spark.createDataFrame(rows, "path string, text string")
    got = renames.renames(frame(("a", "1\n2\n3\n4"), ("b", "5"), ("c", "6")), frame(("x", "1\n2\n3\n4\n5"), ("y", "5"), ("c", "7")))
    assert sorted(tuple(r) for r in got.collect()) == [("a", "x", 80), ("b", "y", 100)]
    of_texts = [p for p in plans if "text#" in p]
    assert len(of_texts) == 1 and "Exchange" not in of_texts[0]


def test_renames_in_a_group_that_shrinks(spark):
    """All files share their lines with very many that are not similar, and each is similar to a few. Blocks that shrink with the group would not all meet."""
    old, new = [], []
    for k, (a, b, c, d) in enumerate(itertools.combinations([f"line {n}" for n in range(8)], 4)):
        old += [(f"o{k}", "\n".join([a, b, c, d])), (f"p{k}", "\n".join([b, a, c, d]))]
        new += [(f"n{k}", "\n".join([c, a, b, d])), (f"m{k}", "\n".join([d, a, b, c]))]
    frame = lambda rows: spark.createDataFrame(rows, "path string, text string")
    got = renames.renames(frame(old), frame(new), 80, 4).collect()
    assert len(got) == len({r.old for r in got}) == len({r.new for r in got}) == 140 and all(r.old[1:] == r.new[1:] and r.similarity == 100 for r in got)


DEEP = """
import a.b as ab
try:
    x.one = f
except E:
    x.two = f
else:
    x.three = f
finally:
    x.four = f
async def outer(p, *, q=1):
    async with p as r:
        match r:
            case 1:
                if p.q[lambda: 2]:
                    x.y.five = z.six = g.h
    while p:
        w = x.seven = f
    else:
        x[0] = x.eight = f
def f():
    return p.q.r(s)(t()).u()
"""


def test_symbols_without_bodies(spark):
    df = spark.createDataFrame([("p", DEEP)], "path string, text string")
    kinds = patches.PATCH_KINDS | patches.CALL_KINDS
    whole, light = (contracts.symbols(df, ["path"], kinds=kinds, bodies=b).collect() for b in (True, False))
    bare = lambda rows: [{k: v for k, v in r.asDict(True).items() if k not in ("body", "statements")} for r in rows]
    assert bare(whole) == bare(light) and all(r.body and r.statements for r in whole if r.kind == "callable") and not any(r.body or r.statements for r in light)
    assert sorted((r.name, r.owner) for r in light if r.kind == "assign") == sorted([
        *((f"x.{n}", f"x.{n} = f") for n in ("one", "two", "three", "four")), ("x.y.five", "x.y.five = z.six = g.h"), ("z.six", "x.y.five = z.six = g.h"),
        ("w", "w = x.seven = f"), ("x.seven", "w = x.seven = f"), ("x.eight", "x[0] = x.eight = f"),
    ])
    assert [r.name for r in light if r.kind == "guard"] == ["p.q[lambda: 2]"] and [r.name for r in light if r.kind == "edge"] == ["p.q.r", "t"]
