"""Sources and sinks: JSON documents and keyed objects, named texts, listings with hashes, sinks that do not overwrite."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Whole-file JSON documents; a byte-order mark is tolerated, a document against the schema is an error."""
    text = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^﻿", "").alias("value"))
    return text.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("d")).select("d.*")


def keyed_json(spark: SparkSession, path: str, value: T.DataType, key: str = "key") -> DataFrame:
    """A JSON object by id as rows: key (long), value."""
    text = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^﻿", "").alias("value"))
    rows = text.select(F.explode(F.from_json("value", T.MapType(T.StringType(), value), {"mode": "FAILFAST"})).alias("k", "value"))
    return rows.select(F.col("k").cast("long").alias(key), "value")


def named_texts(spark: SparkSession, path: str, name: str) -> DataFrame:
    """kind, number, text of files whose names a regular expression with two groups takes apart."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("f"), F.col("value").alias("text"))
    return rows.where(F.col("f").rlike(name)).select(F.regexp_extract("f", name, 1).alias("kind"), F.regexp_extract("f", name, 2).cast("long").alias("number"), "text")


def _chunks(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, chunk, body: a diff's part for each file."""
    return df.select(key, F.posexplode(F.split(text, r"(?m)(?=^diff --git )")).alias("chunk", "body")).where(F.col("body").startswith("diff --git "))


def diff_renames(df: DataFrame, key: str, text: str = "text", similarity: int = 70) -> DataFrame:
    """key, old, new, similarity of the files that unified diffs rename, from so many percent on. Nulls and diffs without renames give no row."""
    line = lambda words: F.nullif(F.regexp_extract("body", rf"(?m)^{words}$", 1), F.lit(""))
    found = _chunks(df, key, text).select(key, line("rename from (.+)").alias("old"), line("rename to (.+)").alias("new"), line(r"similarity index (\d+)%").cast("int").alias("similarity"))
    return found.where("old IS NOT NULL AND new IS NOT NULL").where(F.col("similarity") >= similarity)


def diff_lines(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, path, pos, sign, line of unified diffs: a chunk for each file, of which the last wins, and its changed lines."""
    from pyspark.sql import Window

    chunks = _chunks(df, key, text).withColumn("path", F.regexp_extract("body", r"^diff --git a/(.*?) b/", 1))
    last = chunks.withColumn("__rn", F.row_number().over(Window.partitionBy(key, "path").orderBy(F.desc("chunk")))).where("__rn = 1")
    from changelens.functions.text import changed_line

    lines = last.select(key, "path", F.posexplode(F.split("body", "\n")).alias("pos", "line")).withColumn("sign", changed_line(F.col("line")))
    return lines.where("sign IS NOT NULL").select(key, "path", "pos", "sign", F.expr("substring(line, 2)").alias("line"))


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, length, sha256 and the blob id (SHA-1 of header and contents) of files, at any depth."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    blob = F.sha1(F.concat(F.encode(F.concat(F.lit("blob "), F.col("length").cast("string")), "utf-8"), F.unhex(F.lit("00")), F.col("content")))
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"), blob.alias("blob_id"))


def write_new(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Writes to a path that must not exist."""
    df.write.mode("errorifexists").format(form).save(path)
