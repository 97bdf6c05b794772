"""Scans, projections, ordered limits and kept results on small tables."""

from pyspark.sql import functions as F

from changelens.functions import records
from changelens.operators import decisions, relational, scans
from changelens.sources.results import remembered


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_release_versions(spark):
    tags = spark.createDataFrame([(k, x) for k, x in enumerate(("v1.2", "v1.2.0rc1", "1.2", "v1", "vx.2", "v1.x", "", None))], "k int, tag string")
    assert [r[0] for r in tags.orderBy("k").select(scans.release_version(F.col("tag"))).collect()] == ["1.2", "1.2.0rc1", None, None, None, None, None, None]


def test_version_guards_keep_three_examples_and_need_two_releases(spark):
    lines = spark.createDataFrame([("a/x.py", k, f" v1.2 line {k}") for k in range(5)] + [("b/x.py", 0, "v1.2"), ("a/y.py", 0, "if is_version('1.2'):"), ("a/z.py", 0, "x = '1.2'")], "path string, pos int, line string")
    assert rows(scans.version_guards(lines, "v1.2", "v1.3", "is_version", "a/")) == [("a/x.py", ["v1.2 line 0", "v1.2 line 1", "v1.2 line 2"]), ("a/y.py", ["if is_version('1.2'):"])]
    for old, new in (("v1.2", "v1.2"), ("main", "v1.3"), ("v1.2", "main")):
        assert not rows(scans.version_guards(lines, old, new, "is_version", "a/"))


def test_tokens_stand_as_words(spark):
    lines = spark.createDataFrame([("f", "call(alpha.beta, x)"), ("f", "a + b"), ("g", "alphabet")], "file string, line string")
    records_ = spark.createDataFrame([(1, "f", ["alpha"]), (2, "f", ["alpha.beta"]), (3, "g", ["alpha"]), (4, "g", []), (5, "f", [".beta"]), (6, "f", ["+"]), (7, "h", ["alpha"]), (8, "f", None), (9, "f", ["lph", "x"])], "id int, file string, tokens array<string>")
    assert rows(scans.touched_by_tokens(records_, lines)) == [(1, True), (2, True), (3, False), (4, True), (5, False), (6, True), (7, False), (8, True), (9, True)]


def test_stale_endpoints(spark):
    r = spark.createDataFrame([(1, "a", ["x", "y"]), (2, "gone", ["x"]), (3, None, ["p", "q", "r", "s"]), (4, "", None)], "id int, file string, targets array<string>")
    up, down = spark.createDataFrame([("a",)], "path string"), spark.createDataFrame([("x",), ("y",)], "path string")
    assert rows(scans.stale_endpoints(r, up, down)) == [(2, True, []), (3, False, ["p", "q", "r"])]


def test_patched_contracts_leave_out_twins_that_are_not_unique(spark):
    calls = spark.createDataFrame([("p", "h"), ("h", "k"), ("k", "p")], "src string, dst string")
    twins = spark.createDataFrame([("h", "U1"), ("k", "U2"), ("k", "U3")], "node string, upstream string")
    changed = spark.createDataFrame([("U1",), ("U2",)], "upstream string")
    assert rows(scans.patched_contracts(spark.createDataFrame([("p",)], "node string"), calls, twins, changed)) == [("p", "U1", 1)]


def test_benefits(spark):
    y, n, u = decisions.YES, decisions.NO, decisions.UNKNOWN
    cases = [(True, y, y, n, y), (False, n, u, u, u), (None, y, y, u, u), (False, y, n, y, y), (False, y, n, n, y), (False, y, n, n, u), (False, u, u, u, u)]
    df = spark.createDataFrame(cases, "reverted boolean, reachable string, enters string, equivalent string, cause string")
    found = [r[0] for r in df.select(decisions.benefit_of(*map(F.col, df.columns))).collect()]
    assert found == ["当前不适用", "当前不适用", "理论直接继承", "当前不适用", "需要适配", "待POC", "待POC"]


def test_projections(spark):
    df = spark.createDataFrame([("2026-01-02T03:04:05Z", None, "yes"), ("soon", "", None)], "day string, flag string, conclusion string")
    assert rows(records.filled(df, ["day", "flag", "other"])) == [("2026-01-02T03:04:05Z", "", ""), ("soon", "", "")]
    assert rows(df.select(records.date_or_text(F.col("day")), records.overridden(F.col("flag"), F.col("conclusion"), {"yes": "y"}, "?"))) == [("2026-01-02", "y"), ("soon", "")]


def test_first_in_order_says_whether_there_were_more(spark):
    df = spark.createDataFrame([(k,) for k in range(4)], "k int")
    assert rows(relational.first_in_order(df, [F.desc("k")], 2)) == [(2, True), (3, True)]
    assert rows(relational.first_in_order(df, [F.col("k")], 4)) == [(k, False) for k in range(4)]
    assert not rows(relational.first_in_order(df.where("false"), [F.col("k")], 2))


def test_manifest_paths_stay_inside(spark):
    said = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1"), ("../d", "1"), ("x/../e", "1"), ("/f", "1"), ("g..h", "1")], "path string, sha256 string")
    found = spark.createDataFrame([("a", "1"), ("b", "2"), ("g..h", "1")], "path string, sha256 string")
    assert rows(relational.manifest_problems(said, found)) == [("../d", "outside"), ("/f", "outside"), ("b", "differs"), ("c", "absent"), ("x/../e", "outside")]


def test_results_are_kept_by_all_inputs(spark, tmp_path):
    runs = []

    def compute():
        runs.append(1)
        return spark.createDataFrame([(len(runs),)], "n int")

    get = lambda inputs, **k: rows(remembered(spark, str(tmp_path), inputs, compute, **k))
    assert get({"a": 1, "b": "x"}) == get({"b": "x", "a": 1}) == [(1,)]
    assert get({"a": 2, "b": "x"}) == [(2,)]
    assert get({"a": 1, "b": "x"}, force=True) == get({"a": 1, "b": "x"}) == [(3,)]
