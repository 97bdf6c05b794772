"""Scoring of evidence, its fold for each file, action gates and rule checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from changelens.functions.text import is_uri

CORE_SCORE = 50


def scored(df: DataFrame, table: Column, delta: Column, verified: Column, critical: Column, accepted: Column, relation: Column | None = None) -> DataFrame:
    """Adds score, core and compatible (an override that accepts its new contract already) to evidence rows by table, delta, verification, risk and, if given, relation.

    delta, verified, critical and accepted are true, false or null (unknown, as false). relation divides tables further: same_name and
    other (method), low_signal (field), owner_changed (import), overridden (inheritance); critical stands for a high risk too where a
    method has no delta."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    d, v, c, a = yes(delta), yes(verified), yes(critical), yes(accepted)
    method, call, field = table == "method", table == "call", table == "field"
    rel = F.coalesce(relation, F.lit("")) if relation is not None else F.lit("")
    weak = (method & (rel == "same_name")) | (field & (rel == "low_signal"))
    owner_only = (table == "import") & (rel == "owner_changed")
    score = (
        F.when(weak, F.when(method, 20).otherwise(10)).when(owner_only, F.when(d & v, 50).otherwise(30)).when(method & ~d & (rel == "other"), 20)
        .when(table == "inheritance", F.when(rel == "overridden", 30).otherwise(20))
        .when(method & d & v & a, 25).when(method & d & v, 100).when(method & d, 40).when(method & c, 40).when(method, 30)
        .when(call & d & v & c, 90).when(call & d & v, 80).when(call & d, 40).when(call, 20)
        .when(field & d & v & c, 70).when(field & d & v, 60).when(field & d, 40).when(field, 25)
        .when((table == "import") & d & v, 95).when(table == "import", 30)
        .when(table == "registration", 25).when(table == "copied", 45).when(table == "guard", 50).when(table == "broad", 10)
        .otherwise(20)
    )
    core = (method & d & v & ~a) | ((call | field | (table == "import")) & d & v) | (table == "guard")
    core = core & ~weak & ~owner_only
    compatible = method & ~weak & d & v & a
    return df.withColumn("score", score).withColumn("core", F.coalesce(core, F.lit(False))).withColumn("compatible", F.coalesce(compatible, F.lit(False)))


def folded(df: DataFrame, key: str, label: str, example: str, order: str, examples: int = 3, proximity: str | None = None, gates: list[str] | None = None) -> DataFrame:
    """One row for each key: the largest score, whether any row is core, labels in order of first appearance, up to three examples
    of the largest score, confidence and action; with proximity, also its distinct values (proximities) in order of first appearance.

    A key whose evidence has a compatible override and is not core is dismissed. 'modify' is given by the gates alone (boolean columns, null if
    unknown): one row must pass them all, and without gates none does. All others are for review.

    Labels, proximities and examples are made distinct before they are listed, and of examples only the first few are kept, so that a hot
    key does not gather its rows."""
    passed = gated([F.col(g) for g in gates]) == "modify" if gates else F.lit(False)
    best = df.groupBy(key).agg(F.max("score").alias("score"), F.bool_or("core").alias("core"), F.count("*").alias("n_rows"), F.bool_or("compatible").alias("__compatible"), F.bool_or(passed).alias("__passed"))

    def in_order(rows: DataFrame, column: str, name: str) -> DataFrame:
        firsts = rows.groupBy(key, column).agg(F.min(order).alias("__at")).groupBy(key)
        return firsts.agg(F.transform(F.array_sort(F.collect_list(F.struct("__at", column))), lambda x: x[column]).alias(name))

    top = df.join(best.select(key, F.col("score").alias("__top")), key).where("score = __top").groupBy(key, example).agg(F.min(order).alias("__at"))
    from pyspark.sql import Window

    few = top.withColumn("__rn", F.row_number().over(Window.partitionBy(key).orderBy("__at", example))).where(F.col("__rn") <= examples)
    few = few.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("__rn", example))), lambda x: x[example]).alias("examples"))
    confidence = F.when(F.col("core"), "high").when(F.col("score") >= 40, "medium").otherwise("low")
    out = best.join(in_order(df, label, "labels"), key).join(few, key)
    if proximity:
        out = out.join(in_order(df.where(F.col(proximity).isNotNull()), proximity, "proximities"), key, "left").withColumn("proximities", F.coalesce("proximities", F.array()))
    action = F.when(F.col("__compatible") & ~F.col("core"), "dismiss").when(F.col("__passed"), "modify").otherwise("review")
    return out.withColumn("confidence", confidence).withColumn("action", action).drop("__compatible", "__passed")


# The labels of evidence, by family, and the families in order of their weight.
COMPATIBLE = "already compatible override signature"
FAMILIES = {
    "interface": (
        "upstream callable signature changed", "upstream callable introduced with incompatible override", "upstream callable exactly renamed", "upstream callable owner removed or consolidated",
        "upstream callable removed or renamed", "verified imported module relocated", "verified imported module removed without exact destination", "verified call keyword delta",
        "unverified call keyword delta", "unverified call protocol candidate",
    ),
    "implementation": (
        "method relationship review", "same-name candidate only", "unverified method candidate", "already compatible override signature", "changed directly imported upstream owner",
        "changed explicitly copied upstream source",
    ),
    "field": ("verified upstream field contract delta", "unverified upstream field contract delta", "field relationship review", "low-signal imported attribute"),
    "version": ("release compatibility guard",),
    "registration": ("registration closure review",),
    "observation": (),
}
SIGNATURE_SCORE = 95


def labelled(df: DataFrame, table: Column, delta: Column, verified: Column, accepted: Column) -> DataFrame:
    """Adds label to evidence rows by their table; flags as in scored()."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    d, v, a = yes(delta), yes(verified), yes(accepted)
    texts = {
        "method": F.when(d & v & a, COMPATIBLE).when(d & v, "upstream callable signature changed").when(d, "unverified method candidate").otherwise("method relationship review"),
        "call": F.when(d & v, "verified call keyword delta").when(d, "unverified call keyword delta").otherwise("unverified call protocol candidate"),
        "field": F.when(d & v, "verified upstream field contract delta").when(d, "unverified upstream field contract delta").otherwise("field relationship review"),
        "import": F.when(d & v, "verified imported module relocated").otherwise("changed directly imported upstream owner"),
        "registration": F.lit("registration closure review"), "copied": F.lit("changed explicitly copied upstream source"), "guard": F.lit("release compatibility guard"),
    }
    label = F.lit("broad mapping observation")
    for name, text in texts.items():
        label = F.when(table == name, text).otherwise(label)
    return df.withColumn("label", label)


def with_tier(df: DataFrame, families: dict[str, tuple[str, ...]] = FAMILIES) -> DataFrame:
    """Sets labels right and adds family and tier to rows of folded(): a core row loses the label of compatible evidence, so that it does not read as
    dismissed; the family is the weightiest that a label belongs to; the interface has two tiers, by score. 'dismiss' goes by the labels that are left."""
    order = list(families)
    labels = F.when(F.col("core"), F.array_remove("labels", COMPATIBLE)).otherwise(F.col("labels"))
    rank = F.lit(len(order) - 1)
    for k, name in reversed([*enumerate(order)]):
        rank = F.when(F.arrays_overlap(F.col("labels"), F.array(*map(F.lit, families[name])).cast("array<string>")), k).otherwise(rank)
    family = F.element_at(F.array(*map(F.lit, order)), rank + 1)
    tier = F.when(F.col("family") != "interface", F.col("family")).when(F.col("score") >= SIGNATURE_SCORE, "interface: signature").otherwise("interface: protocol")
    action = F.when(F.array_contains("labels", COMPATIBLE), "dismiss").when(F.col("action") == "dismiss", "review").otherwise(F.col("action"))
    return df.withColumn("labels", labels).withColumn("family", family).withColumn("tier", tier).withColumn("action", action)


def gated(gates: list[Column]) -> Column:
    """'modify' if all gates are true, 'dismiss' if one is false, 'review' if one is unknown."""
    every, known = F.lit(True), F.lit(True)
    for g in gates:
        every, known = every & g, known & F.coalesce(g, F.lit(True))
    return F.when(every, "modify").when(~known, "dismiss").otherwise("review")


def violations(df: DataFrame, key: str, rules: dict[str, tuple[str, Column]]) -> DataFrame:
    """key, rule, severity for each rule (name: (severity, condition that must hold)) that a row breaks; a condition that is null is broken.
    One pass over the rows, whatever the number of rules."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.struct(F.lit(name).alias("rule"), F.lit(severity).alias("severity"))) for name, (severity, ok) in rules.items()]
    rows = df.select(key, F.explode(F.array_compact(F.array(*broken))).alias("__v"))
    return rows.select(key, "__v.rule", "__v.severity")


#: Keywords of a schema, and how each is tested; null (an absent value) passes all but required.
_TESTS = {
    "enum": lambda c, v: c.isin(*v), "const": lambda c, v: c == F.lit(v), "pattern": lambda c, v: c.rlike(v), "minLength": lambda c, v: F.length(c) >= v, "maxLength": lambda c, v: F.length(c) <= v,
    "minItems": lambda c, v: F.size(c) >= v, "minimum": lambda c, v: c >= v, "format": lambda c, v: is_uri(c),
}
_NESTED = {"type", "required", "properties", "items", "allOf", "if", "then", "not"}
_TYPES = {"string": ("string",), "boolean": ("boolean",), "integer": ("int", "bigint", "smallint", "tinyint"), "number": ("int", "bigint", "smallint", "tinyint", "double", "float", "decimal"), "array": ("array",), "object": ("struct", "map")}


def _admits(schema: dict, value: Column, kind: DataType | None) -> Column:
    """Whether a value satisfies a schema; never null. kind is the value's type where it is known, for types are those of columns."""
    if extra := set(schema) - set(_TESTS) - _NESTED:
        raise ValueError(f"unknown keywords: {sorted(extra)}")
    if schema.get("format", "uri") != "uri":
        raise ValueError(f"unknown format: {schema['format']}")
    parts = [F.coalesce(value.isNull() | _TESTS[word](value, schema[word]), F.lit(False)) for word in schema if word in _TESTS]
    if "type" in schema and kind is not None:
        fits = kind.simpleString().split("<")[0].split("(")[0] in _TYPES[schema["type"]]
        parts.append(F.lit(True) if fits else value.isNull())
    field = lambda name: kind[name].dataType if isinstance(kind, StructType) and name in kind.names else None
    at = lambda name: value[name] if not isinstance(kind, StructType) or name in kind.names else F.lit(None)
    parts += [value.isNull() | at(name).isNotNull() for name in schema.get("required", [])]
    parts += [_admits(sub, at(name), field(name)) for name, sub in schema.get("properties", {}).items()]
    if "items" in schema:
        inner = kind.elementType if isinstance(kind, ArrayType) else None
        parts.append(F.coalesce(F.forall(value, lambda x: _admits(schema["items"], x, inner)), F.lit(True)))
    parts += [_admits(sub, value, kind) for sub in schema.get("allOf", [])]
    if "if" in schema:
        parts.append(~_admits(schema["if"], value, kind) | _admits(schema.get("then", {}), value, kind))
    if "not" in schema:
        parts.append(~_admits(schema["not"], value, kind))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def schema_rules(schema: dict, types: StructType | None = None) -> dict[str, tuple[str, Column]]:
    """A JSON-Schema subset (type, required, properties, items, enum, const, pattern, minLength, maxLength, minItems, minimum, format uri, allOf, if and
    then, not) as rules for violations(), over rows whose columns are the properties. types: the rows' schema, where types are tested.

    A property that is absent (null) passes unless it is required, so an if about it holds. A keyword that is not known is an error."""
    columns = [*(types.names if types else []), *_mentioned(schema)]
    row = F.struct(*(F.col(c) for c in dict.fromkeys(columns)))
    kinds = lambda name: types[name].dataType if types is not None and name in types.names else None
    rules = {f"{c} required": ("error", F.col(c).isNotNull()) for c in schema.get("required", [])}
    for name, sub in schema.get("properties", {}).items():
        for word in sub:
            if word not in ("then",):
                rules[f"{name} {word}"] = ("error", _admits({w: sub[w] for w in sub if w == word or (word == "if" and w == "then")}, F.col(name), kinds(name)))
    for word in ("allOf", "if", "not"):
        for k, sub in enumerate(schema.get(word, []) if word == "allOf" else [schema] if word in schema else []):
            part = sub if word == "allOf" else {w: sub[w] for w in ("if", "then") if w in sub} if word == "if" else {"not": sub["not"]}
            rules[f"{word} {k}"] = ("error", _admits(part, row, types))
    if extra := set(schema) - _NESTED:
        raise ValueError(f"unknown keywords: {sorted(extra)}")
    return rules


def _mentioned(schema: dict) -> list[str]:
    """Columns that a schema of rows speaks of."""
    found = [*schema.get("required", []), *schema.get("properties", {})]
    for sub in [*schema.get("allOf", []), *(schema[w] for w in ("if", "then", "not") if w in schema)]:
        found += _mentioned(sub)
    return found
