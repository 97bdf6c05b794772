"""Contracts of Python sources: symbols as rows, and what changed between two snapshots as joins over them.

Only the reading of one source text is Python (symbols); first definitions, renames, deltas, acceptance, resolution along base
classes and import checks are DataFrame operations over the rows."""

from __future__ import annotations

import ast
import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelens.operators import graph, store

PARAMETER = "array<struct<name:string,required:boolean>>"
SYMBOL = f"kind string, owner string, name string, line int, positional {PARAMETER}, keyword {PARAMETER}, vararg string, kwarg string, body string, statements array<string>, detail string, at long, until long"
_PARAMETER = pa.list_(pa.struct([("name", pa.string()), ("required", pa.bool_())]))
_ARROW = [
    ("kind", pa.string()), ("owner", pa.string()), ("name", pa.string()), ("line", pa.int32()), ("positional", _PARAMETER), ("keyword", _PARAMETER),
    ("vararg", pa.string()), ("kwarg", pa.string()), ("body", pa.string()), ("statements", pa.list_(pa.string())), ("detail", pa.string()), ("at", pa.int64()), ("until", pa.int64()),
]
_DEFS = (ast.FunctionDef, ast.AsyncFunctionDef)
#: A place in a text is its line times COLUMNS and its column.
COLUMNS = 4096


def _digest(nodes: list[ast.AST]) -> str:
    return hashlib.md5("\n".join(map(ast.dump, nodes)).encode()).hexdigest()


def _walk(node: ast.AST, fields: tuple[str, ...] | None = None) -> Iterator[ast.AST]:
    """The nodes below a node in ast.walk's order, without the contexts of names; with fields, only what lies in these."""
    todo = deque([node])
    while todo:
        node = todo.popleft()
        yield node
        for name in fields or node._fields:
            value = getattr(node, name, None)
            if isinstance(value, list):
                todo.extend(v for v in value if isinstance(v, ast.AST))
            elif name != "ctx" and isinstance(value, ast.AST):
                todo.append(value)


def _callable(node: ast.FunctionDef | ast.AsyncFunctionDef, owner: str | None, bodies: bool) -> dict:
    a = node.args
    places = [*a.posonlyargs, *a.args]
    needed = len(places) - len(a.defaults)
    positional = [{"name": p.arg, "required": k < needed} for k, p in enumerate(places)]
    if owner and positional and positional[0]["name"] in ("self", "cls"):
        positional = positional[1:]
    keyword = [{"name": p.arg, "required": d is None} for p, d in zip(a.kwonlyargs, a.kw_defaults)]
    rest = {"vararg": a.vararg and a.vararg.arg, "kwarg": a.kwarg and a.kwarg.arg}
    if bodies:
        rest |= {"body": _digest([a, *node.body]), "statements": [_digest([s])[:16] for s in node.body]}
    return {"kind": "callable", "owner": owner, "name": node.name, "line": node.lineno, "positional": positional, "keyword": keyword} | rest


def _dotted(node: ast.AST) -> str | None:
    """The name of a chain of attributes of a plain name; None for other expressions."""
    parts = []
    while isinstance(node, ast.Attribute):
        parts.append(node.attr)
        node = node.value
    return ".".join([node.id, *reversed(parts)]) if isinstance(node, ast.Name) else None


def _in_callable(node: ast.FunctionDef | ast.AsyncFunctionDef, owner: str | None) -> Iterator[dict]:
    """What a callable calls (edge), and whether it hands its ** catch-all to the same method of super() (forward)."""
    calls = [c for c in _walk(node) if isinstance(c, ast.Call)]
    for name in dict.fromkeys(filter(None, (_dotted(c.func) for c in calls))):
        yield {"kind": "edge", "owner": f"{owner}.{node.name}" if owner else node.name, "name": name, "line": node.lineno}
    for c in calls:
        to = c.func.value if isinstance(c.func, ast.Attribute) and c.func.attr == node.name else None
        if isinstance(to, ast.Call) and _dotted(to.func) == "super" and node.args.kwarg and any(k.arg is None and _dotted(k.value) == node.args.kwarg.arg for k in c.keywords):
            yield {"kind": "forward", "owner": owner, "name": node.name, "line": c.lineno}
            return


def _extent(first: ast.AST, last: ast.AST) -> dict:
    return {"at": first.lineno * COLUMNS + min(first.col_offset, COLUMNS - 1), "until": last.end_lineno * COLUMNS + min(last.end_col_offset, COLUMNS - 1)}


def _anywhere(node: ast.AST, kinds: set[str]) -> Iterator[dict]:
    """Rows of a node at any depth; some of kinds that are not asked for are left out."""
    if isinstance(node, ast.Call) and isinstance(node.func, (ast.Name, ast.Attribute)):
        words = [k.arg for k in node.keywords if k.arg] or [None]
        yield from ({"kind": "call", "name": ast.unparse(node.func), "line": node.lineno, "detail": w} for w in words)
    elif isinstance(node, ast.ImportFrom) and node.module and not node.level:
        yield from ({"kind": "import", "owner": node.module, "name": a.name, "line": node.lineno, "detail": a.asname or a.name} for a in node.names)
    elif isinstance(node, ast.Import):
        yield from ({"kind": "import", "owner": a.name, "line": node.lineno, "detail": a.asname or a.name} for a in node.names)
    elif isinstance(node, _DEFS):
        yield {"kind": "scope", "name": node.name, "line": node.lineno} | _extent(node, node)
    elif isinstance(node, ast.If) and "guard" in kinds:
        yield {"kind": "guard", "name": ast.unparse(node.test), "line": node.lineno} | _extent(node.body[0], node.body[-1])
    elif isinstance(node, (ast.Assign, ast.AnnAssign)) and kinds & {"assign", "annotated"} and node.value and (value := _dotted(node.value)):
        targets = [*map(_dotted, node.targets if isinstance(node, ast.Assign) else [node.target])]
        plain = isinstance(node, ast.Assign) and None not in targets
        for target in filter(None, targets):
            yield {"kind": "assign" if isinstance(node, ast.Assign) else "annotated", "owner": " = ".join([*targets, value]) if plain else ast.unparse(node), "name": target, "detail": value, "line": node.lineno} | _extent(node, node)


#: Kinds of rows by where they are found.
_TOP, _DEEP = {"callable", "class", "base", "field", "edge", "forward", "bound"}, {"call", "import", "scope", "guard", "assign", "annotated"}


#: Where statements lie below a node. Only calls lie elsewhere.
_BELOW = ("body", "handlers", "orelse", "finalbody", "cases")


def _top_level(node: ast.AST, kinds: set[str], bodies: bool) -> Iterator[dict]:
    if isinstance(node, _DEFS):
        if "callable" in kinds:
            yield _callable(node, None, bodies)
        if kinds & {"edge", "forward"}:
            yield from _in_callable(node, None)
    elif isinstance(node, ast.ClassDef):
        yield {"kind": "class", "name": node.name, "line": node.lineno}
        yield from ({"kind": "base", "owner": node.name, "name": ast.unparse(b), "line": k} for k, b in enumerate(node.bases))
        for m in node.body:
            if isinstance(m, _DEFS):
                if "callable" in kinds:
                    yield _callable(m, node.name, bodies)
                if kinds & {"edge", "forward"}:
                    yield from _in_callable(m, node.name)
        for item in ast.walk(node) if "field" in kinds else ():
            targets = item.targets if isinstance(item, ast.Assign) else [item.target] if isinstance(item, ast.AnnAssign) and item.value else []
            for t in targets:
                if isinstance(t, ast.Attribute) and isinstance(t.value, ast.Name) and t.value.id == "self":
                    yield {"kind": "field", "owner": node.name, "name": t.attr, "line": item.lineno, "detail": ast.dump(item.value)}
    elif isinstance(node, ast.ImportFrom) and node.module:
        yield from ({"kind": "bound", "owner": node.module, "name": a.asname or a.name, "line": node.lineno, "detail": a.name} for a in node.names if a.name != "*")
    elif isinstance(node, ast.Import):
        # without an alias, the first part of the name is bound
        yield from ({"kind": "bound", "owner": a.name if a.asname else a.name.split(".")[0], "name": a.asname or a.name.split(".")[0], "line": node.lineno} for a in node.names)


def _rows(text: str, kinds: set[str], bodies: bool = True) -> Iterator[dict]:
    try:
        tree = ast.parse(text)
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        yield {"kind": "error"}
        return
    if kinds & _TOP:
        for node in tree.body:
            yield from (r for r in _top_level(node, kinds, bodies) if r["kind"] in kinds)
    if kinds & _DEEP:
        for node in _walk(tree, None if "call" in kinds else _BELOW):
            yield from (r for r in _anywhere(node, kinds) if r["kind"] in kinds)


def symbols(df: DataFrame, keys: list[str], text: str = "text", kinds: set[str] | None = None, bodies: bool = True) -> DataFrame:
    """keys and SYMBOL: a row for each callable, class, base class, field assignment, call keyword, import, ... of a source text, of the kinds given
    (default: all but those that patches need).

    Only top-level functions, classes and their direct methods are callables. self and cls are left out of a method's parameters,
    annotations have no part in them. Further kinds: edge (what a callable calls), forward (it hands its ** catch-all to the same method of super()),
    bound (a name that a top-level import binds), scope, guard, assign and annotated (extents of functions and of bodies under an if, and dotted names that are assigned to
    dotted names, with their places at and until). A text that does not parse gives one row of kind error; a null text gives none.
    Without bodies, body and statements of callables are null, which saves most of the time.

    Texts that lie in fewer partitions than there are cores are spread, for reading one is the work here."""
    wanted = kinds or {"callable", "class", "base", "field", "call", "import"}
    kept = df.where(F.col(text).isNotNull()).select(*keys, F.col(text).alias("__text"))
    form = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.drop("__text").schema)
    kept = store.spread(kept)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([*[batch.schema.field(k) for k in keys], *_ARROW])
            rows = ({k: r[k] for k in keys} | found for r in batch.to_pylist() for found in _rows(r["__text"], wanted, bodies))
            yield pa.RecordBatch.from_pylist(list(rows), schema=schema)

    return kept.mapInArrow(read, f"{form}, {SYMBOL}")


def resolved_bases(found: DataFrame, keys: list[str]) -> DataFrame:
    """keys, class, base, pos: base classes by their full names, as far as the source's imports say: an imported name is its module's, a name after
    an imported module's alias stands in that module, others stay."""
    bases = found.where("kind = 'base'").select(*keys, F.col("owner").alias("class"), F.col("name").alias("__b"), F.col("line").alias("pos"), F.split_part(F.col("name"), F.lit("."), F.lit(1)).alias("alias"))
    one = found.where("kind = 'import'").select(*keys, F.col("detail").alias("alias"), F.when(F.col("owner") == F.col("name"), F.col("owner")).otherwise(F.concat_ws(".", "owner", "name")).alias("__full"), "line")
    last = one.groupBy(*keys, "alias").agg(F.max_by("__full", "line").alias("__full"))
    rest = F.expr("substring(__b, length(alias) + 1)")
    return bases.join(last, [*keys, "alias"], "left").select(*keys, "class", F.coalesce(F.concat("__full", rest), F.col("__b")).alias("base"), "pos")


def shape() -> Column:
    """The parameters of a callable's row as one struct."""
    return F.struct("positional", "keyword", "vararg", "kwarg")


def first_callables(found: DataFrame, keys: list[str]) -> DataFrame:
    """The first definition of each callable: keys, owner ('' for functions), name, shape, body."""
    rows = found.where("kind = 'callable'").select(*keys, F.coalesce("owner", F.lit("")).alias("owner"), "name", "line", shape().alias("shape"), "body")
    return rows.groupBy(*keys, "owner", "name").agg(F.min_by(F.struct("shape", "body"), "line").alias("d")).select(*keys, "owner", "name", "d.shape", "d.body")


def callable_deltas(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """keys, owner, name, old_shape, new_shape, renamed_to, delta for every callable of two snapshots' symbols.

    delta: owner_removed (its class is gone), renamed (exactly one callable of the new owner has the same parameters and body), removed,
    introduced, signature_changed, body_changed or same; unresolved where either snapshot's text did not parse."""
    a = first_callables(old, keys).select(*keys, "owner", "name", F.col("shape").alias("old_shape"), F.col("body").alias("old_body"))
    b = first_callables(new, keys).select(*keys, "owner", "name", F.col("shape").alias("new_shape"), F.col("body").alias("new_body"))
    twins = b.groupBy(*keys, "owner", F.col("new_body").alias("old_body")).agg(F.count("*").alias("__n"), F.min("name").alias("renamed_to")).where("__n = 1").drop("__n")
    owners = new.where("kind = 'class'").select(*keys, F.col("name").alias("owner")).distinct().withColumn("__owner", F.lit(True))
    broken = old.where("kind = 'error'").select(*keys).union(new.where("kind = 'error'").select(*keys)).distinct().withColumn("__broken", F.lit(True))
    both = a.join(b, [*keys, "owner", "name"], "full_outer").join(owners, [*keys, "owner"], "left").join(twins, [*keys, "owner", "old_body"], "left").join(broken, keys, "left")
    gone, fresh = F.col("new_shape").isNull(), F.col("old_shape").isNull()
    delta = (
        F.when(F.col("__broken"), "unresolved").when(gone & (F.col("owner") != "") & F.col("__owner").isNull(), "owner_removed")
        .when(gone & F.col("renamed_to").isNotNull(), "renamed").when(gone, "removed").when(fresh, "introduced")
        .when(F.to_json("old_shape") != F.to_json("new_shape"), "signature_changed").when(F.col("old_body") != F.col("new_body"), "body_changed").otherwise("same")
    )
    return both.withColumn("delta", delta).select(*keys, "owner", "name", "old_shape", "new_shape", F.when(F.col("delta") == "renamed", F.col("renamed_to")).alias("renamed_to"), "delta")


def accepts(expected: Column, actual: Column) -> Column:
    """Whether a callable of the actual shape takes every call of the expected shape: same positional names in order, nothing newly required,
    more parameters only if optional. A catch-all for keywords proves nothing. False where actual is null."""
    ep, ap, ek, ak = expected["positional"], actual["positional"], expected["keyword"], actual["keyword"]
    looser = lambda e, a: (e["name"] == a["name"]) & (e["required"] | ~a["required"])
    same_places = F.forall(F.zip_with(ep, F.slice(ap, F.lit(1), F.size(ep)), lambda e, a: F.coalesce(looser(e, a), F.lit(False))), lambda ok: ok)
    optional_rest = F.forall(F.slice(ap, F.size(ep) + 1, F.size(ap)), lambda a: ~a["required"])
    known_words = F.forall(ek, lambda e: F.exists(ak, lambda a: looser(e, a)))
    no_new_words = F.forall(ak, lambda a: ~a["required"] | F.exists(ek, lambda e: e["name"] == a["name"]))
    rest = (expected["vararg"].isNull() | actual["vararg"].isNotNull()) & (expected["kwarg"].isNull() | actual["kwarg"].isNotNull())
    return F.coalesce((F.size(ap) >= F.size(ep)) & same_places & optional_rest & known_words & no_new_words & rest, F.lit(False))


def optional_additions_only(old: Column, new: Column) -> Column:
    """Whether the new shape has all parameters of the old, as they were, and at least one more, all of them optional. False where either is null."""
    was, now = F.concat(old["positional"], old["keyword"]), F.concat(new["positional"], new["keyword"])
    kept = F.forall(was, lambda p: F.exists(now, lambda q: (p["name"] == q["name"]) & (p["required"] == q["required"])))
    more = F.filter(now, lambda q: ~F.exists(was, lambda p: p["name"] == q["name"]))
    same_rest = old["vararg"].eqNullSafe(new["vararg"]) & old["kwarg"].eqNullSafe(new["kwarg"])
    return F.coalesce(kept & (F.size(more) > 0) & F.forall(more, lambda q: ~q["required"]) & same_rest, F.lit(False))


def forwarding(shapes: DataFrame, bases: DataFrame, forwards: DataFrame) -> DataFrame:
    """class, method, to, hops: the classes whose method a class's method hands its ** catch-all to, itself included (hops 0), one super() after another.

    shapes: class, method, shape; bases: class, base, pos; forwards: class, method. super() of a class is its first base class that has the
    method or takes it from its own bases. Each class has one next class at most, so a walk is a chain; chains that return to a class end there."""
    named = lambda cls: F.concat_ws("#", cls, "method")
    every = bases.select("class").union(bases.select("base")).union(shapes.select("class")).distinct()
    owners = method_owners(every, bases, shapes.select("class", "method")).select(F.col("class").alias("base"), "method", "owner")
    after = bases.join(owners, "base").groupBy("class", "method").agg(F.min_by("owner", F.struct("pos", "base")).alias("next"))
    edges = forwards.select("class", "method").distinct().join(after, ["class", "method"]).select(named(F.col("class")).alias("src"), named(F.col("next")).alias("dst"))
    reached = graph.reachable(edges, shapes.select(named(F.col("class")).alias("node")))
    return reached.select(F.substring_index("start", "#", 1).alias("class"), F.substring_index("start", "#", -1).alias("method"), F.substring_index("node", "#", 1).alias("to"), "hops")


def forwarded_shapes(shapes: DataFrame, chains: DataFrame) -> DataFrame:
    """class, method, shape: what a method takes in the end: its own parameters, and as keywords those of the methods that it forwards to that it does not
    name itself; the catch-alls are the last method's. chains: as forwarding() gives them."""
    steps = chains.join(shapes.select(F.col("class").alias("to"), "method", "shape"), ["to", "method"])
    listed = steps.groupBy("class", "method").agg(F.array_sort(F.collect_list(F.struct("hops", "shape"))).alias("all"))

    def merged(done, step):
        s = step["shape"]
        taken = lambda p: F.exists(done["positional"], lambda q: q["name"] == p["name"]) | F.exists(done["keyword"], lambda q: q["name"] == p["name"])
        more = F.filter(F.concat(s["positional"], s["keyword"]), lambda p: ~taken(p))
        return F.struct(done["positional"].alias("positional"), F.concat(done["keyword"], more).alias("keyword"), done["vararg"].alias("vararg"), s["kwarg"].alias("kwarg"))

    whole = F.aggregate(F.slice("all", F.lit(2), F.size("all")), F.element_at("all", 1)["shape"], merged)
    return listed.select("class", "method", whole.alias("shape"))


def already_compatible(overrides: DataFrame, shapes: DataFrame, chains: DataFrame, deltas: DataFrame) -> DataFrame:
    """class, base, method, compatible: whether an override takes what its changed upstream method takes now: it accepts the new shape itself,
    or it is a constructor that forwards its catch-all, over any number of classes, to that upstream class, and the change only adds optional parameters.

    overrides: class, base (upstream), method; shapes: class, method, shape; chains: as forwarding(); deltas: class, method, old_shape, new_shape.
    An override without a shape, or a change without a new one, is not compatible."""
    rows = overrides.join(deltas.select(F.col("class").alias("base"), "method", "old_shape", "new_shape"), ["base", "method"]).join(shapes.select("class", "method", "shape"), ["class", "method"], "left")
    rows = rows.join(chains.select("class", "method", F.col("to").alias("base"), F.lit(True).alias("reaches")), ["class", "method", "base"], "left")
    forwarded = (F.col("method") == "__init__") & F.coalesce("reaches", F.lit(False)) & optional_additions_only(F.col("old_shape"), F.col("new_shape"))
    return rows.select("class", "base", "method", (accepts(F.col("new_shape"), F.col("shape")) | forwarded).alias("compatible"))


def _sets(found: DataFrame, kind: str, by: list[str], name: str) -> DataFrame:
    return found.where(F.col("kind") == kind).groupBy(*by).agg(F.collect_set("detail").alias(name))


def keyword_deltas(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """keys, name (of what is called), added, removed: keywords that calls pass in only one snapshot; a call that was moved or repeated
    with the same keywords is no delta, nor is one that has no counterpart at all without keywords."""
    by = [*keys, "name"]
    both = _sets(old, "call", by, "a").join(_sets(new, "call", by, "b"), by, "full_outer")
    none = F.array().cast("array<string>")
    a, b = F.coalesce("a", none), F.coalesce("b", none)
    out = both.select(*by, F.array_sort(F.array_except(b, a)).alias("added"), F.array_sort(F.array_except(a, b)).alias("removed"))
    return out.where((F.size("added") > 0) | (F.size("removed") > 0))


def field_deltas(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """keys, owner, name of fields whose set of assigned expressions differs, with delta: introduced, removed or changed."""
    by = [*keys, "owner", "name"]
    both = _sets(old, "field", by, "a").join(_sets(new, "field", by, "b"), by, "full_outer")
    delta = F.when(F.col("b").isNull(), "removed").when(F.col("a").isNull(), "introduced").when(F.array_sort("a") != F.array_sort("b"), "changed")
    return both.select(*by, delta.alias("delta")).where("delta IS NOT NULL")


def import_deltas(imports: DataFrame, old: DataFrame, new: DataFrame, renames: DataFrame) -> DataFrame:
    """Adds delta and destination to imports (columns owner: module, name: symbol) whose target was there in old symbols and is not in
    new ones; both carry a column module, renames has old_module and new_module.

    delta: module_relocated (by renames), module_removed, symbol_renamed (one new symbol of the module has its body), symbol_removed."""

    def targets(found: DataFrame) -> DataFrame:
        top = found.where("(kind = 'callable' AND owner IS NULL) OR kind = 'class'")
        return top.groupBy(F.col("module").alias("owner"), "name").agg(F.min("body").alias("body"))

    was, now = targets(old), targets(new)
    twins = now.groupBy("owner", "body").agg(F.count("*").alias("__n"), F.min("name").alias("__twin")).where("__n = 1 AND body IS NOT NULL").drop("__n")
    modules = new.select(F.col("module").alias("owner")).distinct().withColumn("__module", F.lit(True))
    moved = renames.groupBy(F.col("old_module").alias("owner")).agg(F.min("new_module").alias("__moved"))
    rows = imports.join(was, ["owner", "name"]).join(now.select("owner", "name"), ["owner", "name"], "left_anti")
    rows = rows.join(modules, "owner", "left").join(moved, "owner", "left").join(twins, ["owner", "body"], "left")
    lost = F.col("__module").isNull()
    delta = F.when(lost & F.col("__moved").isNotNull(), "module_relocated").when(lost, "module_removed").when(F.col("__twin").isNotNull(), "symbol_renamed").otherwise("symbol_removed")
    goal = F.when(lost, F.col("__moved")).otherwise(F.col("__twin"))
    return rows.withColumn("delta", delta).withColumn("destination", goal).drop("body", "__module", "__moved", "__twin")


def owner_deltas(imports: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """Adds delta ('owner_changed') to imports (owner: module, name) of a top-level class or function that both snapshots have and whose text differs: for a
    function its parameters or body, for a class any of its methods, or the set of them. old and new carry a column module, as in import_deltas."""

    def profiles(found: DataFrame) -> DataFrame:
        rows = found.where("kind IN ('callable', 'class')").select(F.col("module").alias("owner"), F.coalesce("owner", "name").alias("name"), F.when(F.col("owner").isNotNull(), F.col("name")).alias("method"), "body", "line")
        return rows.groupBy("owner", "name").agg(F.sort_array(F.collect_set(F.struct("method", "body"))).alias("profile"))

    both = profiles(old).join(profiles(new).withColumnRenamed("profile", "now"), ["owner", "name"]).where("profile <> now").select("owner", "name", F.lit("owner_changed").alias("delta"))
    return imports.join(both, ["owner", "name"])


def touched(asked: DataFrame, old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """keys, owner, name, touched of the methods asked for: whether the method of just that class differs between two snapshots (parameters or body; also if only
    one has it). The same name in another class does not matter. Null where a text of the keys does not parse, or no owner or name is given; false where neither snapshot has it."""
    # symbols are far larger than their table's estimate by its file, so no side is sent whole to all tasks
    broken = old.union(new).where("kind = 'error'").select(*keys).distinct().withColumn("__broken", F.lit(True)).hint("merge")
    old, new = old.hint("merge"), new.hint("merge")
    side = lambda found, name: first_callables(found, keys).select(*keys, "owner", "name", F.col("body").alias(name))
    rows = asked.join(side(old, "__a"), [*keys, "owner", "name"], "left").join(side(new, "__b"), [*keys, "owner", "name"], "left").join(broken, keys, "left")
    known = F.col("__broken").isNull() & (F.coalesce("owner", F.lit("")) != "") & (F.coalesce("name", F.lit("")) != "")
    return rows.select(*keys, "owner", "name", F.when(known, ~F.col("__a").eqNullSafe(F.col("__b"))).alias("touched"))


def method_owners(classes: DataFrame, bases: DataFrame, methods: DataFrame, depth: int = 20) -> DataFrame:
    """class, method, owner, hops: the class that a method is taken from, base classes being searched depth first, left to right, the first
    hit counting. classes: class; bases: class, base, pos; methods: class, method.

    Each round joins the open paths to their bases. A path is the list of places from the start, and lists compare in just that order,
    so the first hit is a minimum. A class that is on its own path is not entered again; open paths after depth rounds are an error."""
    spark, folder = classes.sparkSession, store.scratch(classes.sparkSession, "owners")
    front = classes.select("class", F.col("class").alias("owner"), F.array().cast("array<int>").alias("path"), F.array("class").alias("seen"))
    # neither edges nor methods are sent whole to all tasks, which each round would do again
    edges = store.written(bases.select(F.col("class").alias("owner"), "base", F.col("pos").cast("int").alias("pos")), "base-edges").hint("merge")
    kept = front.schema
    # rounds are written beside each other, so all of them are one scan
    for hop in range(depth + 1):
        front.write.parquet(f"{folder}/hops={hop}")
        front = spark.read.schema(kept).parquet(f"{folder}/hops={hop}")
        if front.isEmpty():
            break
        step = front.join(edges, "owner").where(~F.array_contains("seen", F.col("base")))
        step = step.select("class", F.col("base").alias("owner"), F.array_append("path", F.col("pos")).alias("path"), F.array_append("seen", F.col("base")).alias("seen"))
        # another way to a class that was reached before in order adds nothing
        front = step.groupBy("class", "owner").agg(F.min_by(F.struct("path", "seen"), "path").alias("p")).select("class", "owner", "p.path", "p.seen")
    else:
        raise RuntimeError(f"base classes are still found after {depth} steps")
    hits = spark.read.schema(kept).parquet(folder).join(methods.select(F.col("class").alias("owner"), "method").hint("merge"), "owner")
    best = hits.groupBy("class", "method").agg(F.min_by(F.struct("owner", "path"), "path").alias("b"))
    return best.select("class", "method", "b.owner", F.size("b.path").alias("hops"))


def range_class(old_ok: Column, new_ok: Column) -> Column:
    """What a range of changes did to a contract that held (or not) before and after; unknown on either side is unresolved."""
    known = F.when(old_ok & ~new_ok, "introduced_break").when(~old_ok & new_ok, "fixed").when(~old_ok & ~new_ok, "preexisting").when(old_ok & new_ok, "compatibility_warning")
    return F.coalesce(known, F.lit("analysis_unresolved"))
