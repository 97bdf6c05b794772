"""One digest of a set of files, and text files of rows in a canonical form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelens.operators import store


def set_digest(files: DataFrame, digits: int = 3) -> DataFrame:
    """digest, files: one row for a set of files (path, sha256), whatever the order and partitions of the rows.

    A Merkle tree over the hashes of the paths: files whose hash begins with the same digits make a leaf, whose entries (hash of the path, sha256) are joined in order and
    hashed; nodes that share all but the last digit make the node above, up to the root. So a task has the entries of a leaf (all files, by 16 to the power of digits; give more digits for
    more than some millions of files) or 16 nodes, and one changed file changes the nodes on its way alone. The number of digits is part of the digest. Repeated rows count; a null
    path or sha256 is an empty text; the digest of no files is that of nothing."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    of = lambda parts: F.sha2(F.array_join(F.array_sort(F.collect_list(parts)), "").cast("binary"), 256)
    key = F.sha2(text("path").cast("binary"), 256)
    nodes = files.select(F.substring(key, 1, digits).alias("at"), F.concat(key, text("sha256")).alias("entry")).groupBy("at").agg(of(F.col("entry")).alias("digest"), F.count("*").alias("files"))
    for level in range(digits - 1, 0, -1):
        nodes = nodes.groupBy(F.substring("at", 1, level).alias("at")).agg(of(F.concat("at", "digest")).alias("digest"), F.sum("files").alias("files"))
    return nodes.agg(of(F.concat("at", "digest")).alias("digest"), F.coalesce(F.sum("files"), F.lit(0)).cast("long").alias("files"))


def canonical(column: Column, kind: T.DataType) -> Column:
    """A value with the fields of its structs, and the keys of its maps, in order of their names, at any depth."""
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        return F.when(column.isNotNull(), F.struct(*(canonical(column[f.name], f.dataType).alias(f.name) for f in fields)))
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: canonical(x, kind.elementType))
    if isinstance(kind, T.MapType):
        entries = F.array_sort(F.transform(F.map_entries(column), lambda e: F.struct(e["key"].cast("string").alias("key"), canonical(e["value"], kind.valueType).alias("value")))) if _sortable(kind.valueType) else F.transform(F.array_sort(F.map_keys(column)), lambda k: F.struct(k.cast("string").alias("key"), canonical(column[k], kind.valueType).alias("value")))
        return F.map_from_entries(entries)
    return column


def _sortable(kind: T.DataType) -> bool:
    return "map<" not in kind.simpleString()


def canonical_json(df: DataFrame) -> Column:
    """A row as JSON with sorted keys at any depth and nulls kept, the same for the same values."""
    return F.to_json(F.struct(*(canonical(df[f.name], f.dataType).alias(f.name) for f in sorted(df.schema.fields, key=lambda f: f.name))), {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})


def write_canonical(df: DataFrame, path: str, order: list[str], rows_per_file: int = 1_000_000) -> None:
    """Writes the rows as lines of canonical JSON in order of the columns, then of the lines themselves, into folders file=0, file=1, ... of so many rows each, to a path that must not exist.

    Rows are sorted in ranges; a row's number is its place in its range after the sizes of the ranges before it, and says which file it goes to. So the files' contents do not
    depend on the partitions, and a rerun gives the same bytes."""
    lines = df.select(*(F.col(c).alias(f"o{k}") for k, c in enumerate(order)), canonical_json(df).alias("value"))
    by = [*(f"o{k}" for k in range(len(order))), "value"]
    ranged = lines.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("place", F.monotonically_increasing_id()).withColumn("part", F.shiftright("place", 33))
    ranged = store.written(ranged.select("part", "place", "value"), "ranged-lines")
    # one row for each range
    before = ranged.groupBy("part").agg(F.count("*").alias("n"), F.min("place").alias("first")).withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    number = F.col("place") - F.col("first") + F.col("before")
    numbered = ranged.join(F.broadcast(before.drop("n")), "part").select(number.alias("number"), F.floor(number / rows_per_file).cast("long").alias("file"), "value")
    numbered.repartition("file").sortWithinPartitions("file", "number").select("file", "value").write.partitionBy("file").mode("errorifexists").text(path)
