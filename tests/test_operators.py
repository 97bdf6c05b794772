import datetime as dt
import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelens.functions import text as X
from changelens.operators import evidence, graph, relational
from changelens.sources import files
from changelens.streaming import windows


def values(df):
    return sorted(tuple(r) for r in df.collect())


def test_window_is_half_open(spark):
    start, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([(1, start), (2, end), (3, start - dt.timedelta(milliseconds=1)), (4, end - dt.timedelta(milliseconds=1))], "k int, ts timestamp_ntz")
    assert values(relational.half_open(df, "ts", start, end).select("k")) == [(1,), (4,)]
    with pytest.raises(ValueError):
        relational.half_open(df, "ts", end, start)


def test_instants_need_an_offset(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("2024-01-01T00:00:00",), ("2024-01-01T08:00:00+08:00",), (None,)], "t string")
    got = [r[0] for r in df.select(X.instant(F.col("t")).isNotNull()).collect()]
    assert got == [True, False, True, False]


def test_text_functions(spark):
    row = spark.range(1).select(
        X.present(F.lit("　 ")).alias("blank"), X.module_of(F.lit("a/b/__init__.py")).alias("m"), X.last_part(F.lit("a.b.c")).alias("l"),
        X.has_token(F.lit("x foo_bar"), "foo").alias("part"), X.has_token(F.lit("(foo)"), "foo").alias("whole"),
        X.rank_of(F.lit("odd"), ["low", "high"]).alias("unknown"), X.ratio(F.lit(0), F.lit(0), 1.0).alias("empty"),
        X.changed_line(F.lit("+++ b")).alias("header"), X.changed_line(F.lit("-x")).alias("minus"),
    ).first()
    assert tuple(row) == (False, "a.b", "c", False, True, -1, 1.0, None, "-")


def test_unknown_is_not_absent(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    known = spark.createDataFrame([("a", True), ("b", False), ("c", None)], "k string, there boolean")
    assert [r[0] for r in relational.unless_absent(df, known, ["k"], "there").orderBy("k").collect()] == [None, "a", "c"]


def test_paths_below(spark):
    df = spark.createDataFrame([("a/b/c",), ("a/bc",), ("a",), (None,)], "p string")
    changed = spark.createDataFrame([("a/b",)], "q string")
    assert values(relational.under_paths(df, "p", changed, "q")) == [("a/b/c",)]


def test_longest_prefix(spark):
    df = spark.createDataFrame([("a.b.c",), ("x.y",)], "n string")
    known = spark.createDataFrame([("a",), ("a.b",), ("a.bc",)], "k string")
    assert values(relational.longest_prefix(df, "n", known, "k").where("resolved IS NOT NULL")) == [("a.b.c", "a.b")]


def test_snapshots(spark):
    old = spark.createDataFrame([("same", None), ("gone", "1"), ("new value", "1")], "k string, v string")
    new = spark.createDataFrame([("same", None), ("here", "1"), ("new value", "2")], "k string, v string")
    assert values(relational.compare(old, new, ["k"], "v")) == [("gone", "removed"), ("here", "introduced"), ("new value", "changed"), ("same", "same")]


def test_precision_of_nothing(spark):
    none = spark.createDataFrame([], "k string")
    assert relational.precision_recall(relational.hits_misses_extras(none, none, "k")).first()["precision"] == 0.0


def test_reach_with_cycle(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 5)], "src int, dst int")
    got = values(graph.reachable(edges, spark.createDataFrame([(1,)], "node int")))
    assert got == [(1, 1, 0), (1, 2, 1), (1, 3, 2)]


def test_maximal_names(spark):
    assert values(graph.maximal_names(spark.createDataFrame([("a",), ("a.b",), ("ab",)], "n string"), "n")) == [("a.b",), ("ab",)]


def test_gates(spark):
    df = spark.createDataFrame([(True, True), (True, None), (None, False)], "a boolean, b boolean")
    assert [r[0] for r in df.select(evidence.gated([F.col("a"), F.col("b")])).collect()] == ["modify", "review", "dismiss"]


def test_fold_actions(spark):
    rows = [
        ("compatible", 1, True, True, True, True, "near"), ("compatible", 2, False, False, False, None, "line"), ("compatible", 3, False, False, False, None, "near"), ("core", 1, True, True, False, None, None),
        ("core", 2, True, True, True, None, None), ("gates", 1, True, True, False, True, "line"), ("apart", 1, True, True, False, False, "line"), ("apart", 2, True, False, False, True, "line"), ("weak", 1, False, True, True, True, None),
    ]
    df = spark.createDataFrame(rows, "file string, n int, delta boolean, verified boolean, accepted boolean, reachable boolean, near string")
    df = evidence.scored(df, F.lit("method"), F.col("delta"), F.col("verified"), F.lit(False), F.col("accepted"))
    got = evidence.folded(df.withColumn("label", F.lit("m")), "file", "label", "n", "n", proximity="near", gates=["delta", "verified", "reachable"])
    assert {r.file: (r.action, r.proximities) for r in got.collect()} == {
        "compatible": ("dismiss", ["near", "line"]), "core": ("review", []), "gates": ("modify", ["line"]), "apart": ("review", ["line"]), "weak": ("review", []),
    }
    alone = evidence.folded(df.withColumn("label", F.lit("m")), "file", "label", "n", "n")
    assert {r.file: r.action for r in alone.collect()} == {"compatible": "dismiss", "core": "review", "gates": "review", "apart": "review", "weak": "review"}


def test_schema_keywords(spark):
    with pytest.raises(ValueError):
        evidence.schema_rules({"properties": {"a": {"oneOf": []}}})
    df = spark.createDataFrame([(1, "x", ["s"]), (2, None, [])], "k int, a string, steps array<string>")
    rules = evidence.schema_rules({"required": ["a"], "properties": {"a": {"enum": ["y"]}, "steps": {"minItems": 1}}})
    assert values(evidence.violations(df, "k", rules).select("k", "rule")) == [(1, "a enum"), (2, "a required"), (2, "steps minItems")]


def test_files(spark, tmp_path):
    (tmp_path / "o.json").write_text("﻿" + json.dumps({"7": ["p", "s"], "12": ["q", "t"]}))
    got = values(files.keyed_json(spark, str(tmp_path / "o.json"), T.ArrayType(T.StringType()), "pr").select("pr", F.col("value")[0]))
    assert got == [(7, "p"), (12, "q")]
    (tmp_path / "merge-5.diff").write_text("diff --git a/x.py b/x.py\n--- a/x.py\n+++ b/x.py\n@@ -1 +1 @@\n-old\n+new\ndiff --git a/x.py b/x.py\n+last\n")
    texts = files.named_texts(spark, str(tmp_path), r"^(\w+)-(\d+)\.diff$")
    assert [(r.number, r.sign, r.line) for r in files.diff_lines(texts, "number").collect()] == [(5, "+", "last")]
    moved = "diff --git a/o b.py b/n.py\nsimilarity index {}%\nrename from o b.py\nrename to n.py\n@@ -1 +1 @@\n-rename to x.py\n+y\ndiff --git a/z b/z\n+rename from z\n"
    diffs = spark.createDataFrame([(1, moved.format(70)), (2, moved.format(69)), (3, None), (4, ""), (5, "diff --git a/a b/a\n+c\n")], "number long, text string")
    assert [tuple(r) for r in files.diff_renames(diffs, "number").collect()] == [(1, "o b.py", "n.py", 70)]
    (tmp_path / "blob").mkdir()
    (tmp_path / "blob/f").write_bytes(b"hello\n")
    assert files.listing(spark, str(tmp_path / "blob")).first()["blob_id"] == "ce013625030ba8dba906f756967f9e9ca394464a"


def test_stream_and_watermark(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([Row(k=1, ts=t), Row(k=1, ts=t), Row(k=2, ts=t)])
    df.write.parquet(str(tmp_path / "in"))
    got = []
    stream = windows.changes(spark, str(tmp_path / "in"), df.schema, "k", "ts")
    windows.run_available(stream, str(tmp_path / "state"), lambda batch, n: got.extend(r.k for r in batch.collect()))
    assert sorted(got) == [1, 2]
    mark, later = str(tmp_path / "mark"), t + dt.timedelta(days=1)
    assert not windows.advance(spark, mark, None, t, [True, False])
    assert windows.advance(spark, mark, None, t, [True]) and windows.advance(spark, mark, t, later, [True])
    assert not windows.advance(spark, mark, t, later, [True])


def test_required_names_what_is_missing(spark):
    from changelens.operators import lookups

    df, known = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(1, "x")], "k int, w string")
    with pytest.raises(Exception, match="no row for 2"):
        lookups.required(df, known, ["k"]).collect()
    assert values(lookups.required(df.where("k = 1"), known, ["k"])) == [(1, "a", "x")]


def test_schema_in_full(spark):
    df = spark.createDataFrame([(1, {"n": 1, "steps": ["ab", "c"]}, "high", "http://h/x"), (2, {"n": -1, "steps": []}, "none", None), (3, None, None, "no uri")], "id int, a struct<n:int,steps:array<string>>, value string, link string")
    schema = {
        "properties": {"a": {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer", "minimum": 0}, "steps": {"type": "array", "minItems": 1, "items": {"type": "string", "minLength": 2}}}}, "link": {"format": "uri"}},
        "allOf": [{"if": {"properties": {"value": {"const": "none"}}}, "then": {"required": ["link"]}}], "not": {"properties": {"value": {"enum": ["low"]}}, "required": ["value"]},
    }
    found = {(r["id"], r["rule"]) for r in evidence.violations(df, "id", evidence.schema_rules(schema, df.schema)).collect()}
    assert found == {(1, "a properties"), (2, "a properties"), (2, "allOf 0"), (3, "link format")}
    with pytest.raises(ValueError, match="oneOf"):
        evidence.schema_rules({"properties": {"a": {"items": {"oneOf": []}}}})


def test_same_content_counts_repeats(spark):
    from changelens.operators import lookups

    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(2, "x"), (1, None), (2, "x")], "k int, v string")
    assert lookups.same_content(a, a.orderBy("v")).first()["same"] and not lookups.same_content(a, b).first()["same"]
    assert lookups.same_content(a.limit(0), a.limit(0)).first()[:] == (True, 0, 0)
