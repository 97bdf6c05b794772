"""Patches, forwarded contracts, adapted copies, paths, intervals and renames, against plain versions."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from changelens.operators import contracts, graph, patches
from changelens.operators.relational import enclosing
from changelens.sources import renames


def test_enclosing(spark):
    rng = random.Random(1)
    spans = [(rng.randint(0, 3), lo := rng.randint(-50, 5000), lo + int(rng.paretovariate(0.5)) % 4000, k) for k in range(400)] + [(0, None, 5, -1), (0, 9, None, -2), (0, 9, 8, -3)]
    points = [(rng.randint(0, 4), rng.randint(-60, 9000)) for _ in range(300)] + [(0, None), (1, 77), (1, 77)]
    got = enclosing(spark.createDataFrame(points, "file int, at long"), spark.createDataFrame(spans, "file int, lo long, hi long, id int"), ["file"])
    want = [(f, a, lo, hi, k) for f, a in points for g, lo, hi, k in spans if f == g and None not in (a, lo, hi) and lo <= a <= hi]
    assert sorted(got.select("file", "at", "lo", "hi", "id").collect()) == sorted(want)
    none = spark.createDataFrame([], "file int, lo long, hi long, id int")
    assert enclosing(spark.createDataFrame(points, "file int, at long"), none, ["file"]).count() == 0


SOURCE = """
import up.core as core, up.other
from up.core import Unit as U
from outside import gone

def swap(x):
    return helper(x)

def helper(x):
    other = Made()
    return remote.call(x) + Made().size()

class Made:
    def __init__(self):
        self.n = far()

from mine.parts import far
import mine.parts as remote

class Mine:
    def run(self, a):
        def inner():
            U.run = swap
        if a:
            if not core.ready:
                core.Unit.run = Mine.run
            elif a > 1:
                core.free = swap.wrapped
            else:
                up.other.go = swap
        for _ in a:
            gone.run = swap
            core.Unit.stays = swap
            U.run = a.swap

core.free = swap
U.run = core.free = swap
"""


def found_in(spark, texts, kinds):
    return contracts.symbols(spark.createDataFrame(texts, "path string, text string"), ["path"], kinds=kinds)


def test_patch_bindings(spark):
    found = found_in(spark, [("a.py", SOURCE), ("b.py", "import up.core as core\ncore.free = unknown\n"), ("c.py", "def broken(:\n"), ("d.py", None)], patches.PATCH_KINDS)
    modules = spark.createDataFrame([("up",), ("up.core",), ("up.other",)], "module string")
    deltas = spark.createDataFrame([("up.core", "Unit", "run", "signature_changed"), ("up.core", "", "free", "removed"), ("up.other", "", "go", "renamed"), ("up.core", "Unit", "stays", "same"), ("up.core", "Unit", "body", "body_changed")], "module string, owner string, name string, delta string")
    rows = {(r["class"], r.method, r.module, r.target_class, r.target_method): r for r in patches.patch_bindings(found, modules, deltas).collect()}
    places = {k: [(o.line, o.scope, o.guard) for o in r.occurrences] for k, r in rows.items()}
    line = lambda text, nth=0: [k for k, x in enumerate(SOURCE.split("\n"), 1) if x.strip() == text][nth]
    both = line("U.run = core.free = swap")
    assert places == {
        ("", "swap", "up.core", "Unit", "run"): [(line("U.run = swap"), "inner", ""), (both, "module_import", "")],
        ("Mine", "run", "up.core", "Unit", "run"): [(line("core.Unit.run = Mine.run"), "run", "a and not core.ready")],
        ("", "swap", "up.core", "", "free"): [(line("core.free = swap.wrapped"), "run", "a and a > 1"), (line("core.free = swap"), "module_import", ""), (both, "module_import", "")],
        ("", "swap", "up.other", "", "go"): [(line("up.other.go = swap"), "run", "a")],
    }
    first = rows["", "swap", "up.core", "", "free"]
    assert (first.target, first.replacement, first.scope, first.guard, first.delta, first.path) == ("up.core.free", "swap.wrapped", "run", "a and a > 1", "removed", "a.py")
    known = spark.createDataFrame([("a.py", "", "swap", "up.core", "", "free")], "path string, class string, method string, module string, target_class string, target_method string")
    assert patches.patch_bindings(found, modules, deltas, known=known).count() == 3


def test_call_closure(spark):
    found = found_in(spark, [("a.py", SOURCE)], patches.PATCH_KINDS | patches.CALL_KINDS)
    edges = patches.call_edges(found, "mine")
    assert sorted((r.src, r.dst, r.stop) for r in edges.collect()) == [
        ("a.py:Made.__init__", "mine.parts:far", True), ("a.py:helper", "a.py:Made.__init__", False), ("a.py:helper", "mine.parts:call", True), ("a.py:swap", "a.py:helper", False),
    ]
    deltas = spark.createDataFrame([("up.core", "", "free", "removed"), ("up.parts", "", "far", "signature_changed"), ("up.parts", "", "call", "same")], "module string, owner string, name string, delta string")
    bindings = patches.patch_bindings(found, spark.createDataFrame([("up.core",)], "module string"), deltas)
    twins = spark.createDataFrame([("mine.parts:far", "up.parts"), ("mine.parts:call", "up.parts")], "node string, module string")
    got = patches.call_closure(bindings, edges, twins, deltas).collect()
    assert [(r.start, r.path, r.module, r.name, r.delta) for r in got] == [("a.py:swap", ["a.py:swap", "a.py:helper", "a.py:Made.__init__", "mine.parts:far"], "up.parts", "far", "signature_changed")]
    assert patches.call_closure(bindings, edges, twins.union(spark.createDataFrame([("mine.parts:far", "up.more")])), deltas).count() == 0


def test_paths(spark):
    rng = random.Random(4)
    edges = {(f"n{rng.randint(0, 60)}", f"n{rng.randint(0, 60)}") for _ in range(130)} | {(f"c{k}", f"c{k + 1}") for k in range(20)}
    stops = {"n3", "n17"}
    out = collections.defaultdict(list)
    for a, b in edges:
        if a not in stops:
            out[a].append(b)
    want = {}
    for start in ("n0", "n5", "n3", "c0"):
        level, best = {start: None}, {start: [start]}
        while level:
            found = {}
            for u in level:
                for v in out[u]:
                    if v not in best:
                        found[v] = min(found.get(v, u), u)
            for v, u in found.items():
                best[v] = [*best[u], v]
            level = found
        want |= {(start, v): p for v, p in best.items()}
    frame = spark.createDataFrame([*edges, (None, "n1"), ("n1", None)], "src string, dst string")
    nodes = lambda ns: spark.createDataFrame([(n,) for n in ns], "node string")
    got = graph.paths(frame, nodes(["n0", "n5", "n3", "c0", "c0"]), nodes(stops)).collect()
    assert {(r.start, r.node): r.path for r in got} == want and len(got) == len(want) and all(r.hops == len(r.path) - 1 for r in got)
    assert graph.paths(frame, nodes([])).count() == 0
    with pytest.raises(RuntimeError):
        graph.paths(frame, nodes(["c0"]), depth=5)


CHAIN = """
class Low(Mid):
    def __init__(self, x=0, **rest):
        super().__init__(**rest)
    def go(self, **rest):
        return self.other.go(**rest)
class Mid(Aside, Top):
    def __init__(self, y, *, z=1, **more):
        super(Mid, self).__init__(**more)
        super().__init__(y, **more)
class Aside:
    def other(self):
        pass
class Top(Up):
    pass
class Up:
    def __init__(self, a, b=2, *, x=3, **last):
        pass
class Round(Round):
    def __init__(self, **rest):
        super().__init__(**rest)
"""


def test_forwarding(spark):
    found = found_in(spark, [("p", CHAIN)], {"callable", "base", "forward"})
    shapes = found.where("kind = 'callable'").select(F.col("owner").alias("class"), F.col("name").alias("method"), contracts.shape().alias("shape"))
    bases = found.where("kind = 'base'").select(F.col("owner").alias("class"), F.col("name").alias("base"), F.col("line").alias("pos"))
    forwards = found.where("kind = 'forward'").select(F.col("owner").alias("class"), F.col("name").alias("method"))
    assert sorted(tuple(r) for r in forwards.collect()) == [("Low", "__init__"), ("Mid", "__init__"), ("Round", "__init__")]
    chains = contracts.forwarding(shapes, bases, forwards)
    assert sorted((r["class"], r.to, r.hops) for r in chains.where("method = '__init__'").collect()) == [("Low", "Low", 0), ("Low", "Mid", 1), ("Low", "Up", 2), ("Mid", "Mid", 0), ("Mid", "Up", 1), ("Round", "Round", 0), ("Up", "Up", 0)]
    whole = {r["class"]: r["shape"] for r in contracts.forwarded_shapes(shapes, chains).where("method = '__init__'").collect()}
    names = lambda ps: [(p["name"], p["required"]) for p in ps]
    assert names(whole["Low"]["positional"]) == [("x", False)] and names(whole["Low"]["keyword"]) == [("y", True), ("z", False), ("a", True), ("b", False)] and whole["Low"]["kwarg"] == "last"
    sides = {k: found_in(spark, [("u", f"class Up:\n    def __init__(self, a, b=2, *, x=3{k}, **last):\n        pass\n")], {"callable"}) for k in ("", ", more=1", ", more", ", more=1, x2=2")}
    new = {k: s.select(F.col("owner").alias("class"), F.col("name").alias("method"), contracts.shape().alias("new_shape")) for k, s in sides.items()}
    old = new[""].withColumnRenamed("new_shape", "old_shape")
    overrides = spark.createDataFrame([(x, "Up", "__init__") for x in ("Low", "Mid", "Up", "Round", "Nowhere")], "class string, base string, method string")
    for added, ok in (("", {"Up"}), (", more=1", {"Low", "Mid", "Up"}), (", more", set()), (", more=1, x2=2", {"Low", "Mid", "Up"})):
        got = contracts.already_compatible(overrides, shapes, chains, old.join(new[added], ["class", "method"])).collect()
        assert {r["class"] for r in got if r.compatible} == ok and len(got) == 5, added


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    return row[-1]


def test_alignment(spark):
    rng = random.Random(2)
    rows = [([rng.choice("abcd") for _ in range(rng.randint(0, 9))], [rng.choice("abcd") for _ in range(rng.randint(0, 9))]) for _ in range(60)]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    got = df.select(patches.common_subsequence(F.col("a"), F.col("b"), 10).alias("n")).collect()
    assert [r.n for r in got] == [plain_lcs(a, b) for a, b in rows]
    near = spark.createDataFrame([(list("abcdefgh"), list("xxabcdefgh")), (list("abcdefgh"), list("xxxxxabcdefgh"))], "a array<string>, b array<string>")
    assert [r.n for r in near.select(patches.common_subsequence(F.col("a"), F.col("b"), 2).alias("n")).collect()][0] == 8
    texts = spark.createDataFrame([(list("abcdefg"), list("zzcdefzz")), (list("ab"), list("ab")), ([], [])], "a array<string>, b array<string>")
    prints = [({*r.p}, {*r.q}) for r in texts.select(patches.fingerprints(F.col("a"), 2, 3).alias("p"), patches.fingerprints(F.col("b"), 2, 3).alias("q")).collect()]
    assert prints[0][0] & prints[0][1] and prints[1][0] == prints[1][1] != set() and prints[2] == (set(), set())


def test_adapted(spark):
    texts = [("a", "# Adapted from https://x/up/core/unit.py and others\ndef run(a): pass\ndef idle(): pass\nmodule.run = run\nx.y.idle: int = idle\n"), ("b", "# copied FROM up/core/unit.py\ndef run(a): pass\nmodule.walk = run\n"), ("c", "# see up/core/unit.py\ndef run(a): pass\nm.run = run\n"), ("d", None)]
    df = spark.createDataFrame(texts, "path string, text string")
    deltas = spark.createDataFrame([("up/core/unit.py", "", "run", "renamed", "go"), ("up/core/unit.py", "", "idle", "body_changed", None)], "source string, owner string, name string, delta string, renamed_to string")
    marks = patches.source_marks(df, "up")
    assert sorted(tuple(r) for r in marks.collect()) == [("a", "up/core/unit.py"), ("b", "up/core/unit.py")]
    got = patches.adapted_callables(marks, contracts.symbols(df, ["path"], kinds={"callable", "assign", "annotated"}), deltas).collect()
    assert [tuple(r) for r in got] == [("a", "up/core/unit.py", "run", "renamed", "go")]


def plain_renames(old, new, percent):
    gone, fresh = {p: t for p, t in old if t and p not in dict(new)}, {p: t for p, t in new if t and p not in dict(old)}
    out = []
    for text in {*gone.values()}:
        for a, b in zip(sorted(p for p, t in gone.items() if t == text), sorted(p for p, t in fresh.items() if t == text), strict=False):
            out.append((a, b, 100))
    for a, b, _ in out:
        del gone[a], fresh[b]
    scores = []
    for a, x in gone.items():
        for b, y in fresh.items():
            one, two = collections.Counter(x.split("\n")), collections.Counter(y.split("\n"))
            size = lambda k: sum(n * (len(line.encode()) + 1) for line, n in k.items())
            common = size(one & two)
            if 100 * common >= percent * max(size(one), size(two)):
                scores.append((-(100 * common // max(size(one), size(two))), hashlib.md5(f"{a}>{b}".encode()).hexdigest(), a, b))
    for s, _, a, b in sorted(scores):
        if a in gone and b in fresh:
            out.append((a, b, -s))
            del gone[a], fresh[b]
    return sorted(out)


@pytest.mark.parametrize("percent", [50, 70, 95])
def test_renames(spark, percent):
    rng = random.Random(percent)
    lines = [f"line {k} " + "é" * rng.randint(0, 9) for k in range(12)] + ["", "}", "}"]
    text = lambda: "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 14)))
    old = [(f"o{k}", text()) for k in range(30)]
    new = [(f"n{k}", "\n".join(x for x in t.split("\n") if rng.random() > 0.12) + rng.choice(["", "\nmore"])) for k, (_, t) in enumerate(old)] + [(f"m{k}", old[k % 5][1]) for k in range(7)] + [("o1", "here still"), ("x", None), ("y", "")]
    frame = lambda rows: spark.createDataFrame(rows, "path string, text string")
    got = renames.renames(frame(old), frame(new), percent).collect()
    assert sorted(tuple(r) for r in got) == plain_renames(old, new, percent)
    assert renames.renames(frame(old), frame([])).count() == 0 and renames.renames(frame([]), frame(new)).count() == 0


def test_renames_in_a_large_group(spark):
    """Near copies and copies of one text in great number: each file finds one, in blocks, and no round makes all pairs."""
    body = "\n".join(f"common line {k}" for k in range(30))
    old = [(f"o{k}", f"{body}\nold {k}") for k in range(700)] + [(f"c{k}", "copy\nof one") for k in range(90)] + [(f"x{k}", f"alone {k}") for k in range(20)]
    new = [(f"n{k}", f"{body}\nnew {k}") for k in range(650)] + [(f"d{k}", "copy\nof one") for k in range(100)]
    frame = lambda rows: spark.createDataFrame(rows, "path string, text string")
    got = renames.renames(frame(old), frame(new), 70, 64).collect()
    near = [r for r in got if r.old[0] == "o"]
    assert len({r.old for r in got}) == len({r.new for r in got}) == len(got) == 740 and len(near) == 650 and all(r.new[0] == "n" and 90 < r.similarity < 100 for r in near)
    assert sorted((r.old, r.new) for r in got if r.old[0] == "c") == [*zip(sorted(f"c{k}" for k in range(90)), sorted(f"d{k}" for k in range(100)), strict=False)]


def test_copies_in_parts(spark, monkeypatch):
    monkeypatch.setattr(renames, "COPIES", 7)
    frame = lambda p, n: spark.createDataFrame([(f"{p}{k}", "same text") for k in range(n)], "path string, text string")
    got = renames.renames(frame("o", 50), frame("n", 40)).collect()
    assert len({r.old for r in got}) == len({r.new for r in got}) == 40
