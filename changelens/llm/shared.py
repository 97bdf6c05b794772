"""What several operators use: written intermediate tables, balanced splits, connected components."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A join gives rows of its own to keys with more rows than this, and at least one in MOST_HOT of all: so there are MOST_HOT such keys at most.
HOT_ROWS, MOST_HOT = 256, 2000
#: Tables of so few rows are joined at once, without a look for hot keys: a task that gets them all has little to do.
FEW_ROWS = 100_000


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir; a temporary one where that is unset and Spark runs on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = getattr(spark.sparkContext, "_changelens_scratch", None)
        if not named:
            named = tempfile.mkdtemp(prefix="spark-changelens-")
            spark.sparkContext._changelens_scratch = named
    return named


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written once to the shared folder and read again: cuts the lineage, so that a lost
    executor repeats only what follows, and everything that reads it sees the same rows."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_hash(df: DataFrame):
    """A hash of all columns of df, which puts rows that agree in other keys in order."""
    return F.xxhash64(*(F.to_json(F.struct(df[c])) if "map<" in kind else df[c] for c, kind in df.dtypes))


def buckets_for(rows: int) -> int:
    """In how many buckets a group of so many rows is ordered: the bucket's rows and the number of buckets, whose
    sums are summed up in one task, both grow with the root of the rows."""
    return max(1, math.ceil(math.sqrt(rows) / 4))


def prefix_offsets(totals: DataFrame, group: list[str], order: str, value: str, name: str) -> DataFrame:
    """Adds name: the sum of value over the earlier rows of the group by order. totals has one row for each bucket."""
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn(name, F.coalesce(F.sum(value).over(w), F.lit(0)).cast("long"))


def split_join(rows: DataFrame, groups: DataFrame, key: str | list[str], size: str, total: int) -> DataFrame:
    """rows joined with groups, a table (a written one, but for few rows) of one row for each key (of one column or several), with its number of rows as size; total is the number of all rows.

    No task gets a hot key whole: the groups of hot keys, MOST_HOT at most whatever the tables' size, are broadcast, and only
    the others are met by a shuffle. Without hot keys it is one join."""
    most = max(HOT_ROWS, total // MOST_HOT)
    if total <= FEW_ROWS or groups.where(F.col(size) > most).isEmpty():
        return rows.join(groups, key)
    hot = F.broadcast(groups.where(F.col(size) > most))
    rest = rows.join(hot.drop(*{*groups.columns}.difference([key] if isinstance(key, str) else key)), key, "left_anti").join(groups.where(F.col(size) <= most), key)
    return rows.join(hot, key).unionByName(rest)


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """Connected components of an undirected graph.

    edges: a, b (long). Returns node, component (the smallest node that can be reached), a row for each node
    that has an edge. Alternates large-star and small-star steps (Kiveris et al. 2014): each is a grouped
    minimum (combined before the shuffle) and a join, split where a node has many edges, and no group is ever gathered in one task.
    Self loops and repeated edges do no harm; an empty table gives an empty one.
    """
    star = written(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before, total = None, 2 * star.count()
    for _ in range(rounds):
        both = star.union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        stored = written if total > FEW_ROWS else lambda df, name: df
        least = stored(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n"), "least")
        large = stored(split_join(both, least, "u", "n", total).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v"), "large-star")
        down = stored(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "down")
        small = split_join(large, down, "u", "n", total).where("v != m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        star = written(small.union(down.select("u", F.col("m").alias("v"))).distinct(), "star")
        now = star.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before, total = now, 2 * now[0]
    else:
        raise RuntimeError(f"components have not converged after {rounds} rounds")
    roots = star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return star.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_groups(tables, keys: list[str]):
    """Cuts a stream of Arrow batches, sorted by keys, into tables that hold each group of equal keys whole.
    Holds one batch and the rows of its last group."""
    import pyarrow as pa
    import pyarrow.compute as pc

    rest = None
    for batch in tables:
        t = pa.Table.from_batches([batch])
        if rest is not None and rest.num_rows:
            t = pa.concat_tables([rest, t]).combine_chunks()
        if not t.num_rows:
            continue
        same = None
        for k in keys:
            eq = pc.equal(t[k], t[k][t.num_rows - 1])
            same = eq if same is None else pc.and_(same, eq)
        cut = pc.index(same, True).as_py()
        if cut:
            yield t.slice(0, cut)
        rest = t.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest
