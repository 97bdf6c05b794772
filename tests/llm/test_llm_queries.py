"""The registered queries over the smallest tables, against SQL where there is some, and the pipeline against its parts."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import public_tokenizers
import pytest
from test_llm_operators import brute_components, packed_ok, plain_ftrl
from tokenizers import Tokenizer

import corpus_pipeline
from changelens.llm import queries, toxicity

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows
    if sql := queries.ORACLE_SQL.get(name):
        con = duckdb.connect()
        for table in ("documents", "embeddings", "benchmark", "conversations"):
            con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
        want = con.sql(sql)
        columns = sorted(df.columns)
        assert columns == sorted(want.columns)
        at = [want.columns.index(c) for c in columns]
        assert sorted(str([r[c] for c in columns]) for r in rows) == sorted(str([r[k] for k in at]) for r in want.fetchall())


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_stage_toxicity(spark, docs):
    """One part of plain FTRL over the labelled rows that are not held out, in the operator's order; every text scored in plain Python."""
    size = toxicity.FEATURES
    features = toxicity.Features(size)
    of = lambda text: [*features.distinct(text).tolist(), size]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic IS NOT NULL").collect()}
    rows = docs.selectExpr("doc_id", "text", "xxhash64(doc_id, 5) AS turn").orderBy("turn").collect()
    learned = [(of(r["text"]), labels[r["doc_id"]]) for r in rows if r["doc_id"] in labels and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    w = plain_ftrl(learned, toxicity.PASSES * toxicity.ROUNDS, toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2)
    score = {r["doc_id"]: 1 / (1 + math.exp(-sum(w.get(i, 0.0) for i in of(r["text"])))) for r in rows}
    assert min(abs(x - 0.3) for x in score.values()) > 1e-4
    kept = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, x in score.items() if x < 0.3)


def test_stage_near_dedup(spark, docs):
    rows = docs.orderBy("doc_id").collect()
    words = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")) for r in rows]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()) for w in words]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    least = brute_components(len(sets), links)
    want = [tuple(r) for k, r in enumerate(rows) if least[k] == k]
    assert len(want) < len(rows) and sorted(map(tuple, corpus_pipeline.drop_near_copies(spark, docs, SF).collect())) == sorted(want)


def test_stage_mixing(spark, docs):
    rows = docs.collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sums = collections.Counter()
    for r in rows:
        sums[r["source"]] += size(r["text"])
    order = sorted(sums)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, left, free = dict.fromkeys(order, 0.0), float(sum(sums.values())), set(order)
    while left > 1e-9 and free:
        share, w, left = left, sum(weight[s] for s in free), 0.0
        for s in [*free]:
            target[s] += share * weight[s] / w
            if target[s] >= 3 * sums[s]:
                left += target[s] - 3 * sums[s]
                target[s] = 3.0 * sums[s]
                free.discard(s)
    want = collections.Counter()
    for s in order:
        budget = math.floor(target[s] + 1e-9)
        line = sorted((r for r in rows if r["source"] == s), key=lambda r: (hashlib.md5(f"mix:{r['doc_id']}".encode()).hexdigest(), zlib.crc32((r["text"] or "").encode())))
        want.update((r["doc_id"], r["text"]) for r in line if not size(r["text"]))
        for r in line * 3:
            n = min(size(r["text"]), max(0, budget))
            budget -= size(r["text"])
            if n:
                want[r["doc_id"], r["text"] if n == size(r["text"]) else re.match(rf"(?:[\x20\x09-\x0D]*[^\x20\x09-\x0D]+){{{n}}}", r["text"])[0]] += 1
    assert collections.Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.mix_sources(spark, docs, SF).collect()) == want


def test_stage_packing(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for r in docs.collect():
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[r["doc_id"], k, a, b - a, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[a:b]))] += 1
    rows = corpus_pipeline.pack_sequences(spark, docs, SF).collect()
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    assert packed_ok(rows, 1024) >= sum(r["length"] for r in rows) / 1024


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clean = corpus_pipeline.drop_toxic(spark, docs, SF)
    bad = {r["doc_id"] for r in toxicity.toxic_scores(docs, labels).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in docs.collect()} - bad
    alone = corpus_pipeline.drop_near_copies(spark, clean, SF)
    assert alone.count() == alone.select("doc_id").distinct().count() <= clean.count()
    mixed = corpus_pipeline.mix_sources(spark, alone, SF)
    assert mixed.columns == docs.columns
    packed = corpus_pipeline.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == mixed.select("doc_id").distinct().count()
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0
