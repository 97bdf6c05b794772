"""Joins between records and what they name: files, targets, members, findings, other tables; and checks between tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelens.functions.text import present, squeezed


def required(df: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    """df joined with known, which has one row for each key; a key that known has not is an error when the row is read."""
    met = df.join(known.withColumn("__there", F.lit(True)), on, "left")
    missing = F.concat(F.lit("no row for "), F.concat_ws(", ", *(F.col(c).cast("string") for c in on)))
    return met.withColumn("__there", F.coalesce("__there", F.raise_error(missing).cast("boolean"))).where("__there").drop("__there")


def by_unique_suffix(names: DataFrame, name: str, tree: DataFrame, path: str = "path", mark: str = "/") -> DataFrame:
    """Adds file: the path of the tree that ends with the name's parts, if there is exactly one; else null.

    Only paths whose last part is that of a name are taken apart, so that the tree's suffixes are not all written out."""
    ends = names.select(name).distinct().withColumn("__last", F.element_at(F.split(name, mark), -1))
    parted = tree.select(path).distinct().withColumn("__last", F.element_at(F.split(path, mark), -1)).join(ends.select("__last").distinct(), "__last", "left_semi")
    parts = F.split(path, mark)
    suffixes = parted.select(path, F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, -n, n), mark))).alias(name))
    found = suffixes.join(ends.select(name), name).groupBy(name).agg(F.min(path).alias("file"), F.count("*").alias("__n")).where("__n = 1").drop("__n")
    return names.join(found, name, "left")


def by_target(records: DataFrame, targets: str, files: DataFrame, *about: Column) -> DataFrame:
    """file and the aggregates about its records, for the files (column file) that records name as targets (an array)."""
    named = records.withColumn("file", F.explode(F.array_distinct(targets)))
    return named.join(files.select("file").distinct(), "file", "left_semi").groupBy("file").agg(*about)


def closure(records: DataFrame, upstream: str, registered: str, changed: DataFrame, predicted: DataFrame) -> DataFrame:
    """records with direct (the upstream file has changed) or through (the registered file is predicted already), which fire by one hop; others
    are dropped. changed and predicted have a column path."""
    mark = lambda rows, key, name: rows.select(F.col("path").alias(key)).distinct().withColumn(name, F.lit(True))
    met = records.join(mark(changed, upstream, "direct"), upstream, "left").join(mark(predicted, registered, "through"), registered, "left")
    return met.withColumns({n: F.coalesce(n, F.lit(False)) for n in ("direct", "through")}).where("direct OR through").select(*records.columns, "direct", "through")


def touching(changes: DataFrame, key: str, files: str, findings: DataFrame) -> DataFrame:
    """key of the changes of which a file (files is an array) has a finding (column file)."""
    named = changes.select(key, F.explode(files).alias("file"))
    return named.join(findings.select("file").distinct(), "file", "left_semi").select(key).distinct()


def overlap(one: DataFrame, two: DataFrame, key: str, reason: str) -> DataFrame:
    """key, explained for keys that both tables have: whether every row of either gives a reason. Rows are reduced before they meet."""
    each = lambda rows: rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.bool_and(present(F.col(reason))).alias("ok"))
    return each(one).withColumnRenamed("ok", "__one").join(each(two), key).select(key, (F.col("__one") & F.col("ok")).alias("explained"))


def enriched(df: DataFrame, other: DataFrame, key: str, column: str, default: str) -> DataFrame:
    """df with column from other, which has one row for each key, and default where it has none or a null."""
    return df.join(other.select(key, column), key, "left").withColumn(column, F.coalesce(column, F.lit(default)))


def verified_overrides(claims: DataFrame, bases: DataFrame, methods: DataFrame) -> DataFrame:
    """claims (class, base, method) with holds: whether the tree's class has that base and defines that method."""
    there = lambda rows, on, name: rows.select(*on).distinct().withColumn(name, F.lit(True))
    met = claims.join(there(bases, ["class", "base"], "__b"), ["class", "base"], "left").join(there(methods, ["class", "method"], "__m"), ["class", "method"], "left")
    return met.withColumn("holds", F.coalesce(F.col("__b") & F.col("__m"), F.lit(False))).select(*claims.columns, "holds")


def verified_expressions(claims: DataFrame, sources: DataFrame) -> DataFrame:
    """claims (file, expression and more) with holds: whether the file's text holds the expression, white space aside. A blank expression is in no text."""
    bare = sources.select("file", F.regexp_replace("text", r"\s+", "").alias("__text"))
    wanted = F.regexp_replace("expression", r"\s+", "")
    held = F.coalesce(F.contains(F.col("__text"), wanted) & (wanted != ""), F.lit(False))
    return claims.join(bare, "file", "left").withColumn("holds", held).select(*claims.columns, "holds")


def changed_overrides(owners: DataFrame, old: DataFrame, new: DataFrame, known: DataFrame) -> DataFrame:
    """class, owner, method, delta of methods that a class takes over from an owner along its base classes (owners: class, method, owner, own), defines
    itself (own), whose owner's contract differs between old and new (class, method, contract), and that known (class, method) has not."""
    a = old.select(F.col("class").alias("owner"), "method", F.col("contract").alias("__a"), F.lit(True).alias("__was"))
    b = new.select(F.col("class").alias("owner"), "method", F.col("contract").alias("__b"), F.lit(True).alias("__is"))
    both = a.join(b, ["owner", "method"], "full_outer").where("__was IS NULL OR __is IS NULL OR NOT __a <=> __b")
    delta = F.when(F.col("__is").isNull(), "removed").when(F.col("__was").isNull(), "introduced").otherwise("changed")
    rows = owners.where("own").join(both.withColumn("delta", delta), ["owner", "method"])
    return rows.join(known.select("class", "method"), ["class", "method"], "left_anti").select("class", "owner", "method", "delta")


def copied_from(lines: DataFrame, changed: DataFrame, word: str = "(?:copied|adapted)") -> DataFrame:
    """file, line_number, origin of comment lines that say where a text was copied or adapted from, where that file has changed (column path).

    lines: file, line_number, line. An origin may be a link: what follows the repository's branch counts."""
    said = F.regexp_extract("line", rf"(?i)^\s*#.*\b{word}\s+from\s+(\S+?\.py)\b", 1)
    origin = F.regexp_replace(said, r"^https?://[^/]+/[^/]+/[^/]+/(?:blob|tree)/[^/]+/", "")
    return lines.withColumn("origin", origin).where("origin <> ''").join(changed.select(F.col("path").alias("origin")).distinct(), "origin", "left_semi").select("file", "line_number", "origin")


def reconciled(checks: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """name, missing, extra, passed for each pair of tables (what should be there, what is) of the same columns: a set comparison, nulls equal."""
    rows = None
    for name, (expected, actual) in checks.items():
        columns = expected.columns
        sides = expected.distinct().withColumn("__side", F.lit(1)).union(actual.select(*columns).distinct().withColumn("__side", F.lit(2)))
        counts = sides.groupBy(*columns).agg(F.sum("__side").alias("__side")).agg(F.count_if(F.col("__side") == 1).alias("missing"), F.count_if(F.col("__side") == 2).alias("extra"))
        one = counts.select(F.lit(name).alias("name"), "missing", "extra", (F.col("missing") + F.col("extra") == 0).alias("passed"))
        rows = one if rows is None else rows.unionAll(one)
    return rows


def probed(df: DataFrame, key: str, state: str, flips: dict[str, Column], measure: Callable[[Column], Column], expected: dict[str, Column | int] | None = None) -> DataFrame:
    """name, key, before, delta, passed: how the sum of a measure (of a row's state) moves if the state of one row is changed. flips gives for each
    probe the new state, null for rows that it leaves alone; of the others the first by key is changed.

    A sum moves by what its changed row moves, so no probe sums the table again: one pass gives the sum and each probe's row. expected has, for a probe, the delta that
    it must give (over its row; default: any). A probe without a row has a null key, no delta, and has not passed."""
    known = expected or {}
    parts = [F.coalesce(F.sum(measure(F.col(state))), F.lit(0)).alias("before")]
    for k, (name, change) in enumerate(flips.items()):
        row = F.struct(F.col(key).alias("key"), (F.coalesce(measure(change), F.lit(0)) - F.coalesce(measure(F.col(state)), F.lit(0))).alias("delta"), F.lit(known.get(name)).cast("double").alias("expected"))
        parts.append(F.min_by(F.when(change.isNotNull(), row), F.when(change.isNotNull(), F.col(key))).alias(f"p{k}"))
    one = df.agg(*parts)
    probes = F.array(*(F.struct(F.lit(name).alias("name"), F.col(f"p{k}.key").alias(key), F.col(f"p{k}.delta").alias("delta"), F.col(f"p{k}.expected").alias("expected")) for k, name in enumerate(flips)))
    rows = one.select("before", F.explode(probes).alias("p")).select("p.name", f"p.{key}", "before", "p.delta", "p.expected")
    return rows.select("name", key, "before", "delta", F.coalesce(F.col("delta").isNotNull() & (F.col("expected").isNull() | (F.col("delta").cast("double") == F.col("expected"))), F.lit(False)).alias("passed"))


def grep_lines(text: Column) -> Column:
    """file, line_number, line of a search result, as a struct; a line may hold further colons. Null for other texts."""
    parts = F.split(text, ":", 3)
    return F.when((F.size(parts) == 3) & parts[1].rlike("^[0-9]+$"), F.struct(parts[0].alias("file"), parts[1].cast("long").alias("line_number"), parts[2].alias("line")))


def same_content(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """same, expected_rows, actual_rows: whether two tables hold the same rows, repeats counted, in any order: by sums of two hashes of each row's JSON."""
    digest = lambda rows, p: rows.select(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}).alias("j")).agg(
        F.count("*").alias(f"{p}_rows"), *(F.coalesce(F.sum(F.xxhash64(F.lit(k), "j").cast("decimal(38,0)")), F.lit(0)).alias(f"__{p}{k}") for k in (1, 2)))
    both = digest(expected, "expected").crossJoin(digest(actual, "actual"))
    same = (F.col("expected_rows") == F.col("actual_rows")) & (F.col("__expected1") == F.col("__actual1")) & (F.col("__expected2") == F.col("__actual2"))
    return both.select(same.alias("same"), "expected_rows", "actual_rows")


def searched(text: Column, expression: str) -> Column:
    """Whether a text holds an expression, white space as one blank."""
    return F.contains(squeezed(text), F.lit(" ".join(expression.split())))
