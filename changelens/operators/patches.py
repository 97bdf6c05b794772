"""What downstream sources do to upstream ones: patches that replace callables, calls that they reach, and adapted copies.

All from symbols (contracts.symbols): names are resolved, scopes found and contracts met by joins."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelens.operators import graph, store
from changelens.operators.relational import enclosing, longest_prefix

#: Kinds of symbols that patches and calls are read from.
PATCH_KINDS = {"callable", "class", "bound", "scope", "guard", "assign"}
CALL_KINDS = {"callable", "class", "bound", "edge"}
CHANGED = ("signature_changed", "introduced", "removed", "renamed", "owner_removed")


def placed(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Adds scope and guard to rows (key, at of an assignment in found): the innermost function around it ('module_import' for none), and the conditions of
    all if statements in whose body it is, from outside in ('' for none)."""
    points = found.where("kind = 'assign'").select(key, "at").distinct()
    around = found.where("kind IN ('scope', 'guard')").select(key, F.col("kind").alias("around"), F.col("name").alias("text"), F.col("at").alias("lo"), F.col("until").alias("hi"))
    held = enclosing(points, around, [key]).groupBy(key, "at").agg(
        F.max_by(F.when(F.col("around") == "scope", F.col("text")), F.when(F.col("around") == "scope", F.col("lo"))).alias("scope"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("around") == "guard", F.struct("lo", "text")))), lambda g: g["text"]), " and ").alias("guard"),
    )
    return rows.join(held.hint("merge"), [key, "at"], "left").withColumns({"scope": F.coalesce("scope", F.lit("module_import")), "guard": F.coalesce("guard", F.lit(""))})


def _bound(found: DataFrame, key: str) -> DataFrame:
    """key, alias, module, symbol: what top-level imports bind, the last of a name."""
    return found.where("kind = 'bound'").groupBy(key, F.col("name").alias("alias")).agg(F.max_by(F.struct(F.col("owner").alias("module"), F.col("detail").alias("symbol")), "line").alias("b")).select(key, "alias", "b.*")


def patch_bindings(found: DataFrame, modules: DataFrame, deltas: DataFrame, key: str = "path", known: DataFrame | None = None) -> DataFrame:
    """Assignments of a local callable to an attribute of a changed upstream callable's module or class: key, class, method (of the local one; class '' for a
    function), module, target_class, target_method, delta, target, replacement, scope, guard, occurrences (line, expression, scope, guard; in order).

    found: downstream symbols of PATCH_KINDS by key; modules: module (of the old upstream tree); deltas: module, owner, name, delta. A replacement is a
    top-level function (or an attribute of one), or Class.method. The target's first name is what a top-level import binds; of the full name the longest module counts, the rest names the attribute, and
    the name before it the class; where no changed callable has that class, a function of the module does. One row for each pair of callables; target, replacement, scope and guard
    are of the first occurrence. Rows of known (key, class, method, module, target_class, target_method) are left out."""
    # symbols are far larger than their table's estimate by its file, so joins of them are by key on both sides, and none is sent whole to all tasks
    found = found.hint("merge")
    name = F.split_part("replacement", F.lit("."), F.lit(1))
    sides = found.where("kind = 'assign'").select(key, "at", "line", F.col("name").alias("target"), F.col("detail").alias("replacement"), F.col("owner").alias("expression")).withColumn("first", name)
    there = lambda kind, flag: found.where(kind).select(key, F.col("name").alias("first"), F.lit(True).alias(flag)).distinct()
    sides = sides.join(there("kind = 'callable' AND owner IS NULL", "is_function"), [key, "first"], "left").join(there("kind = 'class'", "is_class"), [key, "first"], "left")
    parts = F.split("replacement", r"\.")
    sides = sides.where(F.col("is_function") | (F.col("is_class") & (F.size(parts) == 2))).withColumns({"class": F.when(F.col("is_function"), "").otherwise(F.col("first")), "method": F.when(F.col("is_function"), F.col("first")).otherwise(F.get(parts, F.lit(1)))})
    rest = F.expr("substring(target, length(alias) + 2)")
    sides = sides.withColumn("alias", F.split_part("target", F.lit("."), F.lit(1))).join(_bound(found, key), [key, "alias"])
    sides = sides.withColumn("reference", F.concat_ws(".", "module", "symbol", F.nullif(rest, F.lit("")))).drop("module", "symbol", "alias")
    sides = longest_prefix(sides, "reference", modules, "module").withColumnRenamed("resolved", "module")
    tail = F.split(F.expr("substring(reference, length(module) + 2)"), r"\.")
    sides = sides.where(F.col("module").isNotNull() & (F.length("reference") > F.length("module"))).withColumns({"target_method": F.element_at(tail, -1), "asked": F.coalesce(F.get(tail, F.size(tail) - 2), F.lit(""))})
    changed = deltas.where(F.col("delta").isin(*CHANGED)).select("module", F.col("name").alias("target_method"), "owner", "delta")
    met = sides.join(changed, ["module", "target_method"]).where((F.col("owner") == F.col("asked")) | (F.col("owner") == ""))
    best = F.max_by(F.struct("owner", "delta"), F.col("owner") == F.col("asked"))
    met = met.groupBy(key, "class", "method", "module", "target_method", "at", "line", "reference", "replacement", "expression").agg(best.alias("m"))
    met = placed(met.select(*[c for c in met.columns if c != "m"], F.col("m.owner").alias("target_class"), "m.delta"), found, key)
    pair = [key, "class", "method", "module", "target_class", "target_method"]
    if known is not None:
        met = met.join(known.select(*pair), pair, "left_anti")
    one = F.struct("at", "line", "expression", "scope", "guard", F.col("reference").alias("target"), "replacement")
    listed = met.groupBy(*pair, "delta").agg(F.array_sort(F.collect_list(one)).alias("all"))
    head = F.element_at("all", 1)
    every = F.transform("all", lambda o: F.struct(*(o[c].alias(c) for c in ("line", "expression", "scope", "guard"))))
    return listed.select(*pair, "delta", *(head[c].alias(c) for c in ("target", "replacement", "scope", "guard")), every.alias("occurrences"))


def call_edges(found: DataFrame, within: str, key: str = "path") -> DataFrame:
    """src, dst, stop of calls between the callables of sources: nodes are `key:name`; a call of a local class goes to its __init__, if it
    has one, a call of a local callable to that, and one of a name that is imported from a module below within to the node `module:symbol`, which is a stop."""
    found = found.hint("merge")  # as in patch_bindings
    node = lambda where, name: F.concat_ws(":", where, name)
    calls = found.where("kind = 'edge'").select(key, "owner", F.col("name").alias("called"), F.split_part("name", F.lit("."), F.lit(1)).alias("alias")).distinct()
    local = found.where("kind = 'callable'").select(key, F.concat_ws(".", "owner", "name").alias("goal")).distinct().withColumn("there", F.lit(True))
    classes = found.where("kind = 'class'").select(key, F.col("name").alias("alias"), F.lit(True).alias("is_class")).distinct()
    calls = calls.join(classes, [key, "alias"], "left").withColumn("goal", F.when(F.col("is_class"), F.concat("alias", F.lit(".__init__"))).otherwise(F.col("called"))).join(local, [key, "goal"], "left")
    inner = calls.where("there").select(node(F.col(key), F.col("owner")).alias("src"), node(F.col(key), F.col("goal")).alias("dst"), F.lit(False).alias("stop"))
    outer = calls.where("there IS NULL AND is_class IS NULL").join(_bound(found, key), [key, "alias"]).where(F.col("module").startswith(within))
    symbol = F.coalesce("symbol", F.element_at(F.split("called", r"\."), -1))
    return inner.union(outer.select(node(F.col(key), F.col("owner")), node(F.col("module"), symbol), F.lit(True))).distinct()


def call_closure(bindings: DataFrame, edges: DataFrame, twins: DataFrame, deltas: DataFrame, key: str = "path") -> DataFrame:
    """start, node, path, module, name, delta: changed upstream functions whose downstream copy (a stop of edges) a patch reaches, with a shortest way there.

    bindings: of patch_bindings; edges: of call_edges; twins: node, module (upstream modules that have a function of the node's name; a node with several says nothing);
    deltas: as there. One row for each patch and copy."""
    starts = bindings.select(F.concat_ws(":", F.col(key), F.concat_ws(".", F.nullif("class", F.lit("")), "method")).alias("node")).distinct()
    edges = store.written(edges, "call-edges").hint("merge")
    ways = graph.paths(edges, starts, edges.where("stop").select(F.col("dst").alias("node")))
    only = twins.groupBy("node").agg(F.min("module").alias("module"), F.max("module").alias("last")).where("module = last").drop("last")
    changed = deltas.where(F.col("delta").isin(*CHANGED) & (F.col("owner") == "")).select("module", "name", "delta")
    # copies meet their changes first, so that the ways, which are never sent whole to all tasks, are shuffled once
    copies = only.withColumn("name", F.element_at(F.split("node", ":"), -1)).join(changed, ["module", "name"])
    return ways.hint("merge").join(copies, "node").select("start", "node", "path", "module", "name", "delta")


def source_marks(texts: DataFrame, project: str, key: str = "path") -> DataFrame:
    """key, source: the upstream files that a text says it is adapted or copied from."""
    mark = rf"(?i)(?:adapt(?:ed)?|copied)\s+from[^\n]*({project}/(?:[A-Za-z0-9_.-]+/)*[A-Za-z0-9_.-]+\.py)"
    return texts.select(key, F.explode(F.regexp_extract_all("text", F.lit(mark), F.lit(1))).alias("source")).distinct()


def adapted_callables(marks: DataFrame, found: DataFrame, deltas: DataFrame, key: str = "path") -> DataFrame:
    """key, source, name, delta, renamed_to: top-level functions that a text keeps from an upstream file which it says it is adapted from, and binds to
    an attribute of the same name (module.name = name), where the upstream function changed its parameters, went, or has one twin under another name.

    marks: of source_marks; found: downstream symbols (callable, assign, annotated); deltas: source, owner, name, delta, renamed_to of callable_deltas. A change of the body alone is none here."""
    found, marks = found.hint("merge"), marks.hint("merge")  # as in patch_bindings
    own = found.where("kind = 'callable' AND owner IS NULL").select(key, "name").distinct()
    bound = found.where("kind IN ('assign', 'annotated') AND detail NOT LIKE '%.%' AND name LIKE '%.%'").where(F.element_at(F.split("name", r"\."), -1) == F.col("detail")).select(key, F.col("detail").alias("name")).distinct()
    changed = deltas.where("owner = '' AND delta IN ('signature_changed', 'renamed', 'removed')").select("source", "name", "delta", "renamed_to")
    return marks.join(changed, "source").join(own, [key, "name"]).join(bound, [key, "name"]).select(key, "source", "name", "delta", "renamed_to")


def _common(a: Sequence[str | None], b: Sequence[str | None], band: int) -> int:
    """A row of the usual table is one number: bit j is unset where b's first j + 1 elements add one to the length."""
    at: dict[str | None, int] = {}
    for j, y in enumerate(b):
        at[y] = at.get(y, 0) | 1 << j
    whole = row = (1 << len(b)) - 1
    for i, x in enumerate(a):
        first = max(0, i - band)
        met = row & at.get(x, 0) & ((1 << (i + band + 1)) - 1) >> first << first
        row = (row + met | row - met) & whole
    return len(b) - row.bit_count()


def common_subsequence(a: Column, b: Column, band: int) -> Column:
    """Length of the longest common subsequence of two arrays of texts, of elements whose places lie at most band apart; 0 where either is null."""

    @F.pandas_udf("int")
    def lengths(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([0 if x is None or y is None else _common(x, y, band) for x, y in zip(a, b)], dtype="int32")

    return lengths(a, b)


def fingerprints(tokens: Column, gram: int, window: int) -> Column:
    """Winnowing: of every window of consecutive gram hashes the least; texts that share gram + window - 1 tokens in a row share one. A short text has the least of all."""
    grams = F.transform(F.sequence(F.lit(0), F.greatest(F.size(tokens) - gram, F.lit(0))), lambda i: F.xxhash64(F.slice(tokens, i + 1, F.lit(gram))))
    least = lambda g: F.transform(F.sequence(F.lit(0), F.greatest(F.size(g) - window, F.lit(0))), lambda i: F.array_min(F.slice(g, i + 1, F.lit(window))))
    # the grams are named in an array of one, so that they are made once, not for each window
    return F.when(F.size(tokens) > 0, F.array_distinct(F.get(F.transform(F.array(grams), least), F.lit(0)))).otherwise(F.array().cast("array<bigint>"))


def aligned_callables(ours: DataFrame, theirs: DataFrame, percent: int, gram: int = 2, window: int = 2, band: int = 16) -> DataFrame:
    """id, other, similarity: callables whose statements agree in order: 200 * longest common subsequence / sum of lengths is percent or more.

    ours: id, statements; theirs: other, statements. Candidates share a winnowed fingerprint; one that very many callables have (the statements of a common
    idiom) costs the product of both sides there. Statements that moved further than band places do not count. Callables without statements align with nothing."""
    ours, theirs = store.spread(ours), store.spread(theirs)
    prints = lambda df, c: df.select(c, F.explode(fingerprints(F.col("statements"), gram, window)).alias("print"))
    # statements are far larger than their table's estimate by its file, so no side is sent whole to all tasks
    pairs = prints(ours, "id").hint("merge").join(prints(theirs, "other"), "print").select("id", "other").distinct()
    both = pairs.join(ours.select("id", F.col("statements").alias("a")).hint("merge"), "id").join(theirs.select("other", F.col("statements").alias("b")).hint("merge"), "other")
    score = F.floor(200 * common_subsequence(F.col("a"), F.col("b"), band) / (F.size("a") + F.size("b"))).cast("int")
    return both.select("id", "other", score.alias("similarity")).where(F.col("similarity") >= percent)
