"""Filters, joins, duplicates, set comparison and ranking as DataFrame functions.

None collects rows; every group is reduced before or within a shuffle, and what is broadcast is left to Spark's own
check of its size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changelens.functions.text import ancestors

RETIRED = ("dismiss", "dismissed", "stale")


def half_open(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Rows with start <= ts < end; a start that is not before the end is an error."""
    if not start < end:
        raise ValueError(f"window start {start} is not before its end {end}")
    # as text, so that a time without a zone is not moved by the driver's zone
    kind = df.schema[ts].dataType
    return df.where((F.col(ts) >= F.lit(str(start)).cast(kind)) & (F.col(ts) < F.lit(str(end)).cast(kind)))


def not_retired(df: DataFrame, columns: list[str], retired: tuple[str, ...] = RETIRED) -> DataFrame:
    """Rows of which no status column, trimmed and lower-cased, is retired; nulls pass."""
    keep = [~F.lower(F.trim(F.coalesce(c, F.lit("")))).isin(*retired) for c in columns]
    return df.where(reduce(lambda a, b: a & b, keep))


def unless_absent(df: DataFrame, known: DataFrame, on: list[str], exists: str) -> DataFrame:
    """Drops rows whose key is known not to exist (exists is false); unknown keys and nulls pass."""
    return df.join(known.select(*on, exists), on, "left").where(~F.coalesce(~F.col(exists), F.lit(False))).drop(exists)


def outside_prefixes(df: DataFrame, column: str, prefixes: list[str]) -> DataFrame:
    """Drops rows whose text before the first dot is in a stop list."""
    return df.where(~F.coalesce(F.split_part(F.col(column), F.lit("."), F.lit(1)).isin(*prefixes), F.lit(False)))


def coverage(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Keys that only one side has: key, side ('left' or 'right'). Empty if both sides have the same keys."""
    a = left.select(on).distinct().withColumn("__l", F.lit(True))
    b = right.select(on).distinct().withColumn("__r", F.lit(True))
    return a.join(b, on, "full_outer").where("__l IS NULL OR __r IS NULL").select(on, F.when(F.col("__l"), "left").otherwise("right").alias("side"))


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first by order (best per key, first wins, or last wins with descending orders)."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rn = 1").drop("__rn")


def under_paths(df: DataFrame, path: str, changed: DataFrame, changed_path: str, mark: str = "/") -> DataFrame:
    """Rows whose path equals a changed path or lies below one: the distinct paths' ancestors are expanded, and the join is
    by equality, so no nested loop runs and rows need no number."""
    roots = changed.select(F.col(changed_path).alias("__root")).distinct()
    below = df.select(path).distinct().withColumn("__root", F.explode(ancestors(F.col(path), mark))).join(roots, "__root", "left_semi").select(path).distinct()
    return df.join(below, path, "left_semi").select(*df.columns)


def longest_prefix(df: DataFrame, name: str, known: DataFrame, known_name: str, mark: str = ".") -> DataFrame:
    """Adds resolved: the longest of the known dotted names that is the name itself or a prefix of it; null if none is."""
    names = df.select(name).distinct()
    found = names.withColumn("__p", F.explode(ancestors(F.col(name), mark))).join(known.select(F.col(known_name).alias("__p")).distinct(), "__p", "left_semi")
    best = found.groupBy(name).agg(F.max_by("__p", F.length("__p")).alias("resolved"))
    return df.join(best, name, "left")


def compare(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, delta (removed, introduced, changed, same) of two snapshots; a null value equals a null value."""
    a = old.select(*keys, F.col(value).alias("__old"), F.lit(True).alias("__in_old"))
    b = new.select(*keys, F.col(value).alias("__new"), F.lit(True).alias("__in_new"))
    delta = F.when(F.col("__in_new").isNull(), "removed").when(F.col("__in_old").isNull(), "introduced").when(F.col("__old").eqNullSafe(F.col("__new")), "same").otherwise("changed")
    return a.join(b, keys, "full_outer").select(*keys, delta.alias("delta"))


def hits_misses_extras(predicted: DataFrame, actual: DataFrame, on: str) -> DataFrame:
    """key, side: hit (in both), miss (only actual), extra (only predicted)."""
    a = predicted.select(on).distinct().withColumn("__p", F.lit(True))
    b = actual.select(on).distinct().withColumn("__a", F.lit(True))
    side = F.when(F.col("__p") & F.col("__a"), "hit").when(F.col("__a"), "miss").otherwise("extra")
    return a.join(b, on, "full_outer").select(on, side.alias("side"))


def precision_recall(sides: DataFrame) -> DataFrame:
    """precision, recall and the counts of hits_misses_extras; 0 where there is nothing to divide by."""
    n = {s: F.count_if(F.col("side") == s) for s in ("hit", "miss", "extra")}
    share = lambda rest: F.when(n["hit"] + n[rest] == 0, 0.0).otherwise(n["hit"] / (n["hit"] + n[rest]))
    return sides.agg(n["hit"].alias("hits"), n["miss"].alias("misses"), n["extra"].alias("extras"), share("extra").alias("precision"), share("miss").alias("recall"))


def top_with_rest(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group, with rank and the number of rows that are left out (remaining)."""
    totals = df.groupBy(*group).agg(F.count("*").alias("__n"))
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= k)
    return ranked.join(totals, group).withColumn("remaining", F.greatest(F.col("__n") - k, F.lit(0))).drop("__n")


def with_headings(df: DataFrame, tier: str, partition: list[str], order: list[Column]) -> DataFrame:
    """Adds heading: whether the tier differs from that of the row before."""
    return df.withColumn("heading", ~F.lag(tier).over(Window.partitionBy(*partition).orderBy(*order)).eqNullSafe(F.col(tier)))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def occurrences(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """For each key its distinct values in order of first appearance, and how often it occurs. A value's first place is a
    grouped minimum, so a list has each value once, however often it is repeated."""
    firsts = df.groupBy(*keys, value).agg(F.min(order).alias("__at"), F.count("*").alias("__n"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("__at", value))), lambda x: x[value])
    return firsts.groupBy(*keys).agg(listed.alias("values"), F.sum("__n").alias("n"))


def all_exist(df: DataFrame, targets: DataFrame, keys: list[str], target: str, tree: DataFrame) -> DataFrame:
    """Drops rows of which a target is not in the tree (column of the same name); rows without targets pass."""
    lost = targets.where(F.col(target).isNotNull()).join(tree.select(target), target, "left_anti").select(*keys)
    return df.join(lost, keys, "left_anti")


def first_match(df: DataFrame, name: str, candidates: Column, tree: DataFrame, path: str = "path") -> DataFrame:
    """Adds file: the first of a name's candidate paths that is in the tree; null if none is."""
    tried = df.select(name).distinct().select(name, F.posexplode(candidates).alias("__pos", path))
    found = tried.join(tree.select(path), path, "left_semi").groupBy(name).agg(F.min_by(path, "__pos").alias("file"))
    return df.join(found, name, "left")


def rename_aware(df: DataFrame, path: str, tree: DataFrame, renames: DataFrame) -> DataFrame:
    """Adds resolved: the path if the tree (column path) has it, else what it was renamed to (columns old, new); null if neither."""
    there = tree.select(F.col("path").alias(path)).distinct().withColumn("__there", F.lit(True))
    moved = renames.groupBy(F.col("old").alias(path)).agg(F.max("new").alias("__new"))
    rows = df.join(there, path, "left").join(moved, path, "left")
    return rows.withColumn("resolved", F.when(F.col("__there"), F.col(path)).otherwise(F.col("__new"))).drop("__there", "__new")


def first_in_order(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows by order, with truncated: whether there were more. Each task keeps n + 1 rows at most, and the last one sees no others."""
    few = df.orderBy(*order).limit(n + 1)
    everything = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return few.withColumn("__n", F.row_number().over(Window.orderBy(*order))).withColumn("truncated", F.max("__n").over(everything) > n).where(F.col("__n") <= n).drop("__n")


def one_sided(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows, with repeats, that only one table has, with side: missing or extra."""
    gone, more = expected.exceptAll(actual), actual.exceptAll(expected)
    return gone.withColumn("side", F.lit("missing")).unionByName(more.withColumn("side", F.lit("extra")))


def manifest_problems(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """path, problem (outside, absent, differs) of a manifest's files (path, sha256) against those that are there."""
    there = found.select("path", F.col("sha256").alias("__own"))
    outside = F.col("path").startswith("/") | F.col("path").rlike(r"(^|/)\.\.(/|$)")
    problem = F.when(outside, "outside").when(F.col("__own").isNull(), "absent").when(F.col("__own") != F.col("sha256"), "differs")
    return manifest.join(there, "path", "left").select("path", problem.alias("problem")).where("problem IS NOT NULL")


def report_order(df: DataFrame, *columns: str) -> DataFrame:
    """Rows sorted by columns as text, nulls as empty ones."""
    return df.orderBy(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))


def enclosing(points: DataFrame, intervals: DataFrame, keys: list[str], at: str = "at", lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Each point with each interval of its keys that holds it (both ends included); the intervals' further columns come along.

    An interval lies in bins of a width that suits its length (four times wider on each level), so in two of them, and a point in one bin of each level that occurs. Both meet by
    equality of keys, level and bin: a key with very many rows is spread over its bins, and no pair is tried whose places are far apart. Null ends hold nothing.
    No side is sent whole to all tasks, for bins and levels are not in the estimate of its size."""
    level = F.greatest(F.lit(0), F.ceil(F.log(4.0, F.greatest(F.col(hi) - F.col(lo), F.lit(1)) / 16))).cast("int")
    width = F.expr("shiftleft(16L, 2 * __level)")
    places = intervals.where(F.col(lo) <= F.col(hi)).withColumn("__level", level)
    levels = [r[0] for r in places.select("__level").distinct().collect()]  # 32 at most
    binned = places.withColumn("__bin", F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(F.col(hi) / width))))
    asked = points.withColumn("__level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumn("__bin", F.floor(F.col(at) / width))
    return asked.join(binned.hint("merge"), [*keys, "__level", "__bin"]).where((F.col(lo) <= F.col(at)) & (F.col(at) <= F.col(hi))).drop("__level", "__bin")
