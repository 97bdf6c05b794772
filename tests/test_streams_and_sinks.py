"""Watermarks of concurrent runs, streams with corrections, digests of sets of files, and canonical text files."""

import datetime as dt
import glob
import hashlib
import json
import random
import threading

from pyspark.sql import Row
from pyspark.sql import functions as F

from changelens.operators import contracts, evidence, lookups
from changelens.sources import digests
from changelens.streaming import windows

T0 = dt.datetime(2024, 1, 1)


def test_one_of_two_runs_advances(spark, tmp_path):
    mark, day = str(tmp_path / "mark"), dt.timedelta(days=1)
    assert windows.watermark(spark, mark) == (0, None)
    for n in range(6):
        start, won, ready = (T0 + n * day if n else None), [], threading.Barrier(4)

        def run(k, start=start, won=won, ready=ready, n=n):
            ready.wait()
            if windows.advance(spark, mark, start, T0 + (n + 1) * day, [True]):
                won.append(k)

        runs = [threading.Thread(target=run, args=(k,)) for k in range(4)]
        [r.start() for r in runs]
        [r.join() for r in runs]
        assert len(won) == 1 and windows.watermark(spark, mark) == (n + 1, T0 + (n + 1) * day)
    assert not windows.advance(spark, mark, None, T0, [True]) and not windows.advance(spark, mark, T0, T0, [True]) and not windows.advance(spark, mark, T0 + 6 * day, T0, [True, False])


def test_replayed_and_shuffled_stream_is_the_batch(spark, tmp_path):
    rng, rows = random.Random(3), []
    for k in range(40):
        for version in range(rng.randint(1, 4)):
            rows.append(Row(k=k, version=version, ts=T0 + dt.timedelta(hours=rng.randint(-30, 60)), text=rng.choice(["a", "b", None])))
    rows += [Row(k=None, version=1, ts=T0, text="x"), Row(k=1, version=None, ts=T0, text="x")]
    schema = "k long, version long, ts timestamp, text string"
    start, end = T0, T0 + dt.timedelta(hours=24)
    sent = rows + rng.sample(rows, 40)
    rng.shuffle(sent)
    for n in range(4):
        spark.createDataFrame(sent[n::4], schema).coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    got = []
    changes = windows.corrected(stream, "k", "version", "ts", start, end)
    changes.writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "state")).foreachBatch(lambda b, _: got.extend(b.collect())).start().awaitTermination()
    sums = {}
    for r in got:
        row = tuple(r)[:4]
        sums[row] = sums.get(row, 0) + r.sign
    last = {}
    for r in rows:
        if r.k is not None and r.version is not None and (r.k not in last or r.version > last[r.k].version):
            last[r.k] = r
    assert {row for row, n in sums.items() if n} == {tuple(r) for r in last.values() if start <= r.ts < end} and set(sums.values()) <= {0, 1}
    assert any(r.sign == -1 for r in got)


def plain_digest(files, digits):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    nodes = {}
    for path, content in files:
        nodes.setdefault(sha(path or "")[:digits], []).append(sha(path or "") + (content or ""))
    nodes = {p: sha("".join(sorted(e))) for p, e in nodes.items()}
    for level in range(digits - 1, -1, -1):
        above = {}
        for p, d in nodes.items():
            above.setdefault(p[:level], []).append(p + d)
        nodes = {p: sha("".join(sorted(e))) for p, e in above.items()}
    return nodes.get("", sha(""))


def test_set_digest(spark):
    files = [(f"dir/f{k}", hashlib.sha256(str(k).encode()).hexdigest()) for k in range(300)] + [("dir/f1", "again"), (None, "x"), ("y", None)]
    df = spark.createDataFrame(files, "path string, sha256 string")
    for digits in (1, 2, 3):
        want = plain_digest(files, digits)
        for parts in (1, 7):
            assert digests.set_digest(df.repartition(parts), digits).first()[:] == (want, 303)
    assert digests.set_digest(df.where("path <> 'dir/f7'")).first()["digest"] != digests.set_digest(df).first()["digest"]
    assert digests.set_digest(df.limit(0)).first()[:] == (hashlib.sha256().hexdigest(), 0)


def test_canonical_files(spark, tmp_path):
    rows = [(k % 5, {"z": [k, None], "a": {"y": 1, "b": None}} if k % 3 else None, {"n": 1, "b": k}, "é\n" if k % 2 else None) for k in range(57)] * 2
    df = spark.createDataFrame(rows, "k int, s struct<z:array<int>,a:struct<y:int,b:string>>, m map<string,int>, t string")
    texts = []
    for run, parts in enumerate((1, 5, 9)):
        digests.write_canonical(df.repartition(parts), str(tmp_path / str(run)), ["k"], 20)
        files = [(n, "".join(open(f).read() for f in sorted(glob.glob(f"{tmp_path}/{run}/file={n}/*.txt")))) for n in range(6)]
        assert [len(t.splitlines()) for _, t in files] == [20] * 5 + [14] and all(len(glob.glob(f"{tmp_path}/{run}/file={n}/*.txt")) == 1 for n in range(6))
        texts.append("".join(t for _, t in files))
    assert len({*texts}) == 1
    want = sorted((k, json.dumps({"k": k, "m": dict(sorted(m.items())), "s": s and {"a": {"b": s["a"]["b"], "y": s["a"]["y"]}, "z": s["z"]}, "t": t}, separators=(",", ":"), ensure_ascii=False)) for k, s, m, t in rows)
    assert texts[0].splitlines() == [line for _, line in want]
    digests.write_canonical(df.limit(0), str(tmp_path / "none"), ["k"])


def test_probes(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "b", 7), (3, None, 9)], "k int, s string, n int")
    s = F.col("s")
    flips = {"to_b": F.when(s == "a", "b"), "off": F.when(s == "b", "c"), "none": F.when(s == "zz", "b"), "wrong": F.when(s.isNull(), "b")}
    got = lookups.probed(df, "k", "s", flips, lambda x: F.when(x == "b", F.col("n")), {"to_b": 5, "off": -7, "none": 0, "wrong": 1}).collect()
    assert [tuple(r) for r in got] == [("to_b", 1, 7, 5, True), ("off", 2, 7, -7, True), ("none", None, 7, None, False), ("wrong", 3, 7, 9, False)]


def test_tiers(spark):
    rows = [(1, [evidence.COMPATIBLE, "verified call keyword delta"], 80, True, "review"), (2, [evidence.COMPATIBLE], 25, False, "dismiss"), (3, ["upstream callable exactly renamed"], 100, True, "modify"), (4, ["nothing known"], 10, False, "review"), (5, [], 0, False, "review"), (6, [evidence.COMPATIBLE], 25, True, "review")]
    df = spark.createDataFrame(rows, "k int, labels array<string>, score int, core boolean, action string")
    assert [(r.k, r.family, r.tier, r.action, len(r.labels)) for r in evidence.with_tier(df).orderBy("k").collect()] == [
        (1, "interface", "interface: protocol", "review", 1), (2, "implementation", "implementation", "dismiss", 1), (3, "interface", "interface: signature", "modify", 1),
        (4, "observation", "observation", "review", 1), (5, "observation", "observation", "review", 0), (6, "observation", "observation", "review", 0),
    ]


def test_touched_is_tri_state(spark):
    one = "class A:\n    def run(self):\n        return 1\n"
    texts = [("same", one, one), ("body", one, one.replace("1", "2")), ("other", one, one + "class B:\n    def run(self):\n        return 3\n"), ("gone", one, "class A:\n    pass\n"), ("broken", one, "class A(:"), ("never", "x = 1\n", "x = 2\n")]
    side = lambda k: contracts.symbols(spark.createDataFrame([(t[0], t[k]) for t in texts], "path string, text string"), ["path"], kinds={"callable"})
    asked = spark.createDataFrame([(p, "A", "run") for p, *_ in texts] + [("same", "", "run"), ("same", None, None)], "path string, owner string, name string")
    got = contracts.touched(asked, side(1), side(2), ["path"]).collect()
    assert {(r.path, r.owner): r.touched for r in got} == {("same", "A"): False, ("body", "A"): True, ("other", "A"): False, ("gone", "A"): True, ("broken", "A"): None, ("never", "A"): False, ("same", ""): None, ("same", None): None}
