"""Renames between two snapshots of files, by content."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changelens.operators import store

#: Files of a block, where very many files share a line; copies of one content that are put in order at once.
BLOCK, COPIES = 256, 4096


def _read(old: DataFrame, new: DataFrame) -> DataFrame:
    """side (0 old, 1 new), path, blob (a hash of the text), size (UTF-8 bytes, a line feed after each line included), lines (hash and bytes of each, repeats
    included; null for a null text). Made where the texts are read, once, so that no text is shuffled."""
    line = lambda x: F.struct(F.xxhash64(x).alias("line"), (F.octet_length(x) + 1).cast("long").alias("bytes"))
    sides = old.select(F.lit(0).alias("side"), "path", "text").unionByName(new.select(F.lit(1).alias("side"), "path", "text"))
    size = (F.octet_length("text") + 1).cast("long").alias("size")
    return store.written(sides.select("side", "path", F.sha2(F.col("text").cast("binary"), 256).alias("blob"), size, F.transform(F.split("text", "\n"), line).alias("lines")), "read-files")


def _files(*parts: DataFrame) -> DataFrame:
    """side, path, size, lines of the files in parts (each of one side), one row for each path."""
    one = [p.groupBy("path").agg(F.first("side").alias("side"), F.sum("size").alias("size"), F.flatten(F.collect_list("lines")).alias("lines")) for p in parts]
    return store.written(one[0].unionByName(one[1]), "files")


def _prefixes(files: DataFrame, percent: int) -> DataFrame:
    """side, path, line, size, from: the lines of each file that stand in its prefix, once each. A file's lines that both sides have stand in one order for all, rare ones first; from is
    the weight of a line and of what comes after it, and after the prefix that is less than percent of the file. So two files that have that much in common share a line of
    their prefixes, and the first one that they share has that much from there on in both."""
    rows = files.select("side", "path", "size", F.inline("lines"))
    often = rows.groupBy("line").agg(F.count("*").alias("files"), F.min("side").alias("least"), F.max("side").alias("most")).where("least < most").select("line", "files")
    by_file = Window.partitionBy("side", "path").orderBy(F.desc("files"), F.desc("line"))
    ranked = rows.join(often, "line").withColumn("from", F.sum("bytes").over(by_file)).withColumn("before", F.lag("line").over(by_file))
    ranked = ranked.where(100 * F.col("from") >= percent * F.col("size")).where("before IS NULL OR before <> line")
    return store.written(ranked.select("side", "path", "line", "size", "from"), "file-prefixes")


def _of(side: int, prefix: DataFrame, name: str) -> DataFrame:
    return prefix.where(F.col("side") == side).withColumnsRenamed({"path": name, "size": f"{name}_size", "from": f"{name}_from"}).drop("side")


def _common(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """old, new, similarity of the pairs (old, new, most, and both files' lines) whose common lines, repeats counted, have at least percent of most bytes."""
    for b in batches:
        if not b.num_rows:
            continue
        row, line = (np.concatenate(x) for x in zip(*((np.repeat(np.arange(b.num_rows), np.diff(b[c].offsets.to_numpy())), b[c].flatten().to_numpy()) for c in ("old_lines", "new_lines")), strict=True))
        sizes = b["bytes"].flatten().to_numpy()
        order = np.lexsort((line, row))
        row, line, is_old = row[order], line[order], order < len(sizes)
        first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (line[1:] != line[:-1])]))
        n_old = np.add.reduceat(is_old.astype(np.int64), first)
        times = np.minimum(n_old, np.diff(np.append(first, len(row))) - n_old)
        first, times = first[times > 0], times[times > 0]  # there the sort, which is stable, has an old file's line first
        common = np.bincount(row[first], times * sizes[order[first]], b.num_rows).astype(np.int64)
        most = b["most"].to_numpy()
        kept = 100 * common >= percent * most
        yield pa.record_batch([b["old"].filter(pa.array(kept)), b["new"].filter(pa.array(kept)), pa.array((100 * common // most)[kept].astype(np.int32))], ["old", "new", "similarity"])


def _scored(pairs: DataFrame, files: DataFrame, percent: int) -> DataFrame:
    """old, new, similarity of the candidate pairs (old, new, their sizes and from) that are similar: what a shared line leaves to both rules out some, of the others all lines are compared."""
    most = F.greatest("old_size", "new_size")
    pairs = pairs.where(100 * F.least("old_from", "new_from") >= percent * most).select("old", "new", most.alias("most")).distinct()
    lines = lambda side, name, *more: files.where(F.col("side") == side).select(F.col("path").alias(name), F.col("lines.line").alias(f"{name}_lines"), *more)
    both = pairs.join(lines(1, "new"), "new").join(lines(0, "old", F.col("lines.bytes").alias("bytes")), "old")
    return both.mapInArrow(lambda it: _common(it, percent), "old string, new string, similarity int")


def similar_files(old: DataFrame, new: DataFrame, percent: int = 70) -> DataFrame:
    """old, new, similarity of all pairs of files (path, text on both sides) of which at least so many percent of the larger one's bytes are lines that both have, repeats
    counted; similarity is rounded down. A null text is no file. As it gives all pairs, the result of a group of copies is the product of its sides; renames() does not need them."""
    rows = _read(old, new).where("lines IS NOT NULL")
    files = _files(rows.where("side = 0"), rows.where("side = 1"))
    prefix = _prefixes(files, percent)
    return _scored(_of(0, prefix, "old").join(_of(1, prefix, "new"), "line"), files, percent)


def matched(pairs: DataFrame, rounds: int = 1000) -> DataFrame:
    """One-to-one: of old, new, similarity the rows that are taken if the best row goes first and takes both its files from all others; of one similarity that with the
    least md5 of its paths.

    In each round all rows go that are the best of both their files, which are those that would be taken in any case, until none is left. As ties are in random order, a
    group of equally similar files takes a few rounds, not one for each file."""
    rank = F.struct(-F.col("similarity"), F.md5(F.concat("old", F.lit(">"), "new").cast("binary")), F.col("old"), F.col("new"))
    out, left = None, store.written(pairs.select("old", "new", "similarity"), "rename-pairs")
    for _ in range(rounds):
        if left.isEmpty():
            return left if out is None else out
        best = lambda side: left.groupBy(side).agg(F.min(rank).alias("r")).select("r.old", "r.new")  # noqa: B023, E731
        taken = store.written(best("old").join(best("new"), ["old", "new"]).join(left, ["old", "new"]), "renames")
        out = taken if out is None else out.unionByName(taken)
        left = store.written(left.join(taken.select("old"), "old", "left_anti").join(taken.select("new"), "new", "left_anti"), "rename-pairs")
    raise RuntimeError(f"files are still matched after {rounds} rounds")


def _turns(df: DataFrame, name: str) -> DataFrame:
    """name, blob, n: each file's number among those of its content, by path; among very many copies by parts of a hash of the path first, so that no task orders all."""
    rows = df.select(F.col("path").alias(name), "blob")
    many = rows.groupBy("blob").agg(F.count("*").alias("copies")).where(F.col("copies") > COPIES).select("blob", F.ceil(F.col("copies") / COPIES).alias("parts"))
    rows = store.written(rows.join(F.broadcast(many), "blob", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64(name), "parts"), F.lit(0))).select(name, "blob", "part"), "blobs")
    before = rows.groupBy("blob", "part").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(Window.partitionBy("blob").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    number = F.row_number().over(Window.partitionBy("blob", "part").orderBy(name)) + F.coalesce("before", F.lit(0))
    return rows.join(before.where("before > 0").drop("n"), ["blob", "part"], "left").select(name, "blob", number.alias("n"))


def _without(df: DataFrame, taken: DataFrame, name: str) -> DataFrame:
    return df.join(taken.select(F.col(name).alias("path")), "path", "left_anti")


def renames(old: DataFrame, new: DataFrame, percent: int = 70, block: int = BLOCK) -> DataFrame:
    """old, new, similarity: files (path, text) that are in one snapshot only and have become one another. Equal texts go first, in order of their paths; what is left
    is matched by the share of common lines (similar_files), the best first (matched). Empty and null texts are not renamed.

    Candidates share a line of their prefixes. A line that so many files of both sides have that their pairs are more than block * block has its files dealt into
    blocks by a hash, and each block of old ones meets one of new ones, others in later rounds, as many at once as make no more pairs than the first round; what matches leaves,
    so of a large group of near copies few are left after the first round, and no round makes all pairs. In such a group a file goes to the best of the blocks that it has
    met; no file is left over that has a similar one left over."""
    rows = _read(old, new)
    was, now = rows.where("side = 0"), rows.where("side = 1")
    gone = _without(was, now.select(F.col("path").alias("other")), "other").where("size > 1")
    fresh = _without(now, was.select(F.col("path").alias("other")), "other").where("size > 1")
    out = store.written(_turns(gone, "old").join(_turns(fresh, "new"), ["blob", "n"]).select("old", "new", F.lit(100).alias("similarity")), "exact-renames")
    files = _files(_without(gone, out, "old"), _without(fresh, out, "new"))
    prefix = _prefixes(files, percent)
    sides = [F.count_if(F.col("side") == 0).alias("n_old"), F.count_if(F.col("side") == 1).alias("n_new")]
    sizes = prefix.groupBy("line").agg(*sides).where("n_old > 0 AND n_new > 0")
    sizes = store.written(sizes.withColumn("blocks", F.when(F.col("n_old") * F.col("n_new") > block * block, F.ceil(F.greatest("n_old", "n_new") / block)).otherwise(1)), "rename-lines")
    most, load = sizes.agg(F.max("blocks"), F.sum(F.col("n_old") * F.col("n_new") / F.col("blocks"))).first()
    if most is None:
        return out
    left, turn, upto = prefix.join(sizes.select("line", "blocks"), "line").withColumn("block", F.pmod(F.xxhash64("path"), "blocks")), 0, 1
    while True:
        step = F.explode(F.sequence(F.lit(turn).cast("long"), F.least(F.lit(upto).cast("long"), "blocks") - 1))
        fresh = _of(1, left, "new").withColumn("step", step).withColumn("block", F.pmod(F.col("block") + F.col("step"), "blocks")).drop("blocks", "step")
        found = store.written(matched(_scored(_of(0, left, "old").join(fresh, ["line", "block"]), files, percent)), "matched")
        out = out.unionByName(found)
        if most <= upto:
            return out
        taken = found.select(F.lit(0).alias("side"), F.col("old").alias("path")).union(found.select(F.lit(1), "new"))
        left = store.written(left.where(F.col("blocks") > upto).join(taken, ["side", "path"], "left_anti"), "file-prefixes")
        each, most = left.groupBy("line", "blocks").agg(*sides).where("n_old > 0 AND n_new > 0").agg(F.sum(F.col("n_old") * F.col("n_new") / F.col("blocks")), F.max("blocks")).first()
        if most is None:
            return out
        turn, upto = upto, min(most, upto + max(1, int(load // each)))
