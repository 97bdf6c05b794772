"""Scans of source lines and mapping records: version guards, touched tokens, stale endpoints, overrides that no table has,
helpers that patches reach, and what a changed line means at run time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changelens.functions.text import WORD_CHARACTER
from changelens.operators import graph


def release_version(tag: Column) -> Column:
    """What follows the v of a release tag: parts with dots between, two at least, of which the first two begin with a digit. Null for other tags."""
    return F.nullif(F.regexp_extract(tag, r"^v((?:\d[^.]*)\.(?:\d[^.]*)(?:\..*)?)$", 1), F.lit(""))


def version_guards(lines: DataFrame, old: str, new: str, check: str, root: str, examples: int = 3) -> DataFrame:
    """path, examples of the files below root that still name the old version: in a line with the check's name or the old tag.

    lines: path, pos, line. The first examples of each file by place are kept, trimmed; the limit is applied before lines are
    gathered. Tags that are no releases, or the same one, give an empty table."""
    version, other = release_version(F.lit(old)), release_version(F.lit(new))
    named = (version != other) & F.contains(F.col("line"), version) & (F.col("line").contains(check) | F.col("line").contains(old))
    found = lines.where(F.col("path").startswith(root) & named)
    first = found.withColumn("__n", F.row_number().over(Window.partitionBy("path").orderBy("pos"))).where(F.col("__n") <= examples)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("__n", F.trim("line").alias("line")))), lambda x: x["line"])
    return first.groupBy("path").agg(listed.alias("examples"))


def touched_by_tokens(records: DataFrame, lines: DataFrame) -> DataFrame:
    """id, touched: whether a changed line of the record's file holds one of its tokens as a word of its own; a record without
    tokens counts as touched.

    records: id, file, tokens (array); lines: file, line. A token can only stand where its first run of word characters stands
    as a word, so lines meet tokens by file and that word, and not by file alone; the whole token is then looked for."""
    run = f"{WORD_CHARACTER}+"
    wanted = records.where(F.size("tokens") > 0).select("id", "file", F.explode("tokens").alias("token"))
    wanted = wanted.withColumn("word", F.regexp_extract("token", run, 0))
    words = F.array_union(F.array(F.lit("")), F.regexp_extract_all("line", F.lit(run), F.lit(0)))
    parted = lines.select("file", "line").distinct().select("file", "line", F.explode(words).alias("word"))
    whole = F.concat(F.lit(rf"(?<!{WORD_CHARACTER})\Q"), "token", F.lit(rf"\E(?!{WORD_CHARACTER})"))
    hit = wanted.join(parted, ["file", "word"]).where(F.rlike("line", whole)).select("id").distinct().withColumn("__hit", F.lit(True))
    bare = F.coalesce(F.size("tokens"), F.lit(0)) <= 0
    return records.join(hit, "id", "left").select("id", (bare | F.coalesce("__hit", F.lit(False))).alias("touched"))


def stale_endpoints(records: DataFrame, upstream: DataFrame, downstream: DataFrame, most: int = 3) -> DataFrame:
    """id, upstream_missing, missing of the records with a named file that its tree has not; missing has the first targets of these.

    records: id, file, targets (array); upstream, downstream: path. Empty and null names are no endpoints."""
    gone = records.where("file <> ''").select("id", F.col("file").alias("path")).join(upstream, "path", "left_anti").select("id", F.lit(True).alias("up"))
    named = records.select("id", F.posexplode("targets").alias("pos", "path")).where("path <> ''")
    lost = named.join(downstream, "path", "left_anti").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "path"))).alias("all"))
    lost = lost.select("id", F.transform(F.slice("all", 1, most), lambda x: x["path"]).alias("missing"))
    return gone.distinct().join(lost, "id", "full_outer").select("id", F.coalesce("up", F.lit(False)).alias("upstream_missing"), F.coalesce("missing", F.array().cast("array<string>")).alias("missing"))


def missing_overrides(overrides: DataFrame, upstream: DataFrame, known: DataFrame) -> DataFrame:
    """class, base, method: methods that a class has from an upstream base and defines itself, without a row in known.

    overrides: class, base, method; upstream: class, method; known: class, method."""
    bases = upstream.select(F.col("class").alias("base"), "method").distinct()
    return overrides.select("class", "base", "method").distinct().join(bases, ["base", "method"], "left_semi").join(known, ["class", "method"], "left_anti").select("class", "base", "method")


def patched_contracts(patches: DataFrame, calls: DataFrame, twins: DataFrame, changed: DataFrame) -> DataFrame:
    """start, upstream, hops: changed upstream callables of which a patch reaches a copy; copies with several upstream twins say nothing.

    patches: node; calls: src, dst; twins: node, upstream; changed: upstream. hops is the shortest way."""
    only = twins.groupBy("node").agg(F.min("upstream").alias("upstream"), F.max("upstream").alias("__last")).where("upstream = __last").drop("__last")
    reached = graph.reachable(calls, patches)
    return reached.join(only.join(changed, "upstream", "left_semi"), "node").groupBy("start", "upstream").agg(F.min("hops").alias("hops"))


def changes_running_code(path: Column, line: Column) -> Column:
    """Whether a changed line (without its sign) can matter at run time: not blank and no comment, or in a file that is not Python."""
    return ~path.endswith(".py") | ((F.trim(line) != "") & ~F.ltrim(line).startswith("#"))


def of_profile(df: DataFrame, kind: str, verified: str, exact: bool, loose: tuple[str, ...]) -> DataFrame:
    """Rows that a profile takes: the exact one none of the loose kinds and none that is not verified, the other all."""
    return df.where(~F.coalesce(F.col(kind).isin(*loose), F.lit(False)) & F.coalesce(F.col(verified), F.lit(False))) if exact else df
