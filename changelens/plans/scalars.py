"""Queries over scalar expressions: instants, paths and modules, chunks of diffs, texts that are there."""

from __future__ import annotations

from pyspark.sql import functions as F

from changelens.functions import text as X
from changelens.plans.queries import query
from changelens.sources import files

c = F.col


@query("c1_instants", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(epoch(date_trunc('second', ts)) AS BIGINT) WHEN 1 THEN CAST(epoch(date_trunc('second', ts)) AS BIGINT) - 28800 END AS seconds FROM events")
def c1(t):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.element_at(F.array(*map(F.lit, ["Z", "+08:00", "", " yesterdayZ"])), (c("event_id") % 4 + 1).cast("int")))
    return t("events").select("event_id", F.unix_seconds(X.instant(text)).alias("seconds"))


@query("c2_instant_or_not", "SELECT event_id, event_id % 8 IN (0, 1, 2, 3) AS valid FROM events")
def c2(t):
    day = F.date_format("ts", "yyyy-MM-dd")
    forms = [day, F.concat(day, F.lit("T10:00")), F.concat(day, F.lit(" 10:00:59.123456+01:00")), F.concat(day, F.lit("T23:59:59Z")), F.concat(day, F.lit("T25:00")), F.lit("2024-02-30"), F.lit(""), F.date_format("ts", "yyyy-MM")]
    return t("events").select("event_id", X.is_instant(F.element_at(F.array(*forms), (c("event_id") % 8 + 1).cast("int"))).alias("valid"))


@query("c8_diff_chunks", "SELECT p_partkey, p_size % 4 AS files, p_size % 4 AS changed FROM part WHERE p_size % 4 > 0")
def c8(t):
    chunk = F.concat(F.lit("diff --git a/f"), "n", F.lit(" b/f"), "n", F.lit("\n@@ -1 +1 @@\n+new\n text with diff --git a/x b/x inside\n"))
    numbers = t("part").select("p_partkey", F.explode(F.sequence(F.lit(0), c("p_size") % 4)).alias("n")).withColumn("chunk", F.when(c("n") == 0, "some head\n").otherwise(chunk))
    texts = numbers.groupBy("p_partkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "chunk"))), lambda x: x["chunk"]), "").alias("text"))
    return files.diff_lines(texts, "p_partkey").groupBy("p_partkey").agg(F.count_distinct("path").cast("int").alias("files"), F.count("*").cast("int").alias("changed"))


@query("c9_paths_and_modules", """
SELECT p_partkey, 'pkg.' || replace(p_name, ' ', '.') AS module, CASE WHEN p_size % 2 = 0 THEN 'pkg/' || replace(p_name, ' ', '/') || '/__init__.py' ELSE 'pkg/' || replace(p_name, ' ', '/') || '.py' END AS path, TRUE AS returns FROM part""")
def c9(t):
    path = F.concat(F.lit("pkg/"), F.translate("p_name", " ", "/"), F.when(c("p_size") % 2 == 0, "/__init__.py").otherwise(".py"))
    rows = t("part").select("p_partkey", path.alias("path"))
    return rows.select("p_partkey", X.module_of(c("path")).alias("module"), "path", F.array_contains(X.paths_of(X.module_of(c("path"))), c("path")).alias("returns"))


@query("c11_present", "SELECT p_partkey, p_partkey % 6 IN (1, 4) AS present FROM part")
def c11(t):
    text = F.element_at(F.array(F.lit(""), F.lit(" x "), F.lit(" \t\n"), F.lit("　 "), c("p_name"), F.lit(None).cast("string")), (c("p_partkey") % 6 + 1).cast("int"))
    return t("part").select("p_partkey", X.present(text).alias("present"))
