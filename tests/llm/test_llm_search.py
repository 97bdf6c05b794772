"""Conversation repair, decontamination and ranked search against plain versions."""

import collections
import functools
import hashlib
import itertools
import math
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from changelens.llm import conversations, decontamination, lexical, queries, words

SF = "/root/testdata/sf0.001"
LATTICE = st.lists(st.tuples(st.sampled_from("suat "), st.booleans(), st.booleans()), max_size=7)


def plain_cheapest(rows, entry, ends):
    """Least (cost, audit) by recursion over what is left; more than two inserts in a row never pay."""
    follows = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    @functools.cache
    def rest(i, state, inserts):
        found = [(0, "")] if i == len(rows) and state in ends else []
        go = lambda cost, edit, *to: found.extend((cost + c, edit + a) for c, a in [rest(*to)] if c < math.inf)
        if i < len(rows):
            initial, must, cut = rows[i]
            go(2, "D", i + 1, state, 0)
            if not must:
                for role, to in follows[state].items():
                    if role == initial:
                        go(5 * cut, "K", i + 1, to, 0)
                    elif role != "s":
                        go(1 + 5 * cut, "R", i + 1, to, 0)
        if inserts < 3:
            for role, to in follows[state].items():
                if role != "s":
                    go(5, "I", i, to, inserts + 1)
        return min(found, default=(math.inf, ""))

    return rest(0, entry, 0)


@settings(max_examples=150, deadline=None)
@given(LATTICE, st.integers(0, 3))
def test_cheapest_edits(rows, entry):
    for ends in ((0, 3), (0,), (1,), (2,), (3,)):
        cost, audit = plain_cheapest(tuple(rows), entry, ends)
        assert conversations.cheapest(rows, entry, ends) == ((cost, audit) if cost < math.inf else (conversations.NEVER, ""))


def plain_repair(rows):
    """(turn, role, text) rows of one conversation to gaps, blank, duplicate, truncated, illegal, cost, audit, hash."""
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    seen, faults = set(), []
    for _, role, text in rows:
        last = re.sub(r"[\x20\x09-\x0D]", "", text)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, *_ in rows if t is not None]
    initials = [role[:1] or " " for _, role, _ in rows]
    cost, audit = plain_cheapest(tuple((i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, faults, strict=True)), 0, (0, 3))
    out, at, state = [], 0, ""
    for edit in audit:
        role = "assistant" if state == "u" else "user"
        if edit in "KR":
            out.append((rows[at][1] if edit == "K" else role, rows[at][2]))
        elif edit == "I":
            out.append((role, ""))
        at += edit != "I"
        state = out[-1][0][0] if out else ""
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in out))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    return (gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def same(found, want):
    assert sorted(found, key=str) == sorted(want, key=str)


def test_conversations(spark):
    rng, rows = random.Random(3), []
    for conv in [None, *range(40)]:
        for turn in range(rng.choice([1, 2, 5, 9])):
            for _ in range(rng.choice([1, 1, 1, 2])):
                role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
                text = rng.choice(["Yes.", "No", "What?", "", None, " \n", "日本語", f"text {rng.random()}", f"text {rng.random()}."])
                rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text, 1, "x", 7))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, uid int, place string, gone_ int")
    order = {(r.role, r.text): r.h for r in df.selectExpr("coalesce(role, ' ') AS role", "coalesce(text, ' ') AS text").selectExpr("role", "text", "xxhash64(text) AS h").distinct().collect()}
    by = collections.defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    tidy = lambda rs: sorted(rs, key=lambda r: (r[0] is not None, r[0] or 0, r[1], order[r[1:]]))
    want = [(c, *plain_repair(tidy(rs))) for c, rs in by.items()]
    for block in (3, 256):
        same([tuple(r) for r in conversations.repaired(df, block).collect()], want)
    none = df.where("uid = 2")
    assert conversations.repaired(none).count() == 0 and conversations.repaired(conversations.damaged(none)).count() == 0 and conversations.repair(none).count() == 0
    lines = conversations.repair(df).where("conv_id = 5").orderBy("place").collect()
    assert [r.place for r in lines] == list(range(len(lines)))


def test_damage_and_query(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    odd = spark.createDataFrame([(None, None, None, None), (700, None, "user", "a"), (701, 1, None, None)], table.schema)
    lonely = [c for c in range(2000, 2200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:2]
    lost = spark.createDataFrame([(c, 0, "user", "x.") for c in lonely], table.schema)
    for df, got in ((table, queries.op11_conversations(spark, SF)), (w := table.union(odd).union(lost), conversations.repaired(conversations.damaged(w)))):
        by = {}
        for r in df.collect():
            kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (r.conv_id, r.turn)).encode()) % 20
            role, text = " " if r.role is None else r.role, " " if r.text is None else r.text
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            by.setdefault(r.conv_id, []).extend([] if kind == 0 else [(r.turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3)))
        same([tuple(r) for r in got.collect()], [(c, *plain_repair(sorted(rs, key=lambda r: (r[0] is not None, r[0] or 0)))) for c, rs in by.items()])


def test_long_conversation_in_many_tasks(spark):
    """One conversation with most of the rows, cut by range into many tasks, joined as one search over all rows joins them."""
    rng = random.Random(1)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"{t}{rng.choice(['.', '.', ' '])}") for t in range(3000)] + [(c, t, "user", ".") for c in range(2, 500) for t in range(2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    long = conversations.repaired(df, 100).where("conv_id = 1").collect()
    cost, audit = conversations.cheapest([(r[2][0], False, r[3][-1] == " ") for r in rows[:3000]], 0, (0, 3))
    assert [(r.cost, r.audit) for r in long] == [(cost, audit)]


ITEMS = "item_id long, text string, doc_id int, uid string"
DOCS = "doc_id long, text string, item_id int, spans string, items int, score long"


def some_texts(rng, n, length):
    common = [f"w{k}" for k in range(30)]
    return [" ".join(rng.choice(common) + rng.choice(["", "", "-", ", ", "É"]) for _ in range(rng.randint(0, length))) for _ in range(n)]


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def odd_tables(spark, rng):
    items = [(k, t) for k, t in enumerate(some_texts(rng, 12, 9))] + [(20, None), (21, ""), (22, "W1"), (22, "w2 w3"), (None, "w4 w5"), (23, "--"), (24, "never seen words here")]
    texts = some_texts(rng, 60, 60)
    texts += [" ".join([items[k][1], texts[k], items[(k + 1) % 12][1]]) for k in range(12)]
    docs = [*enumerate(texts), (3, texts[5]), (3, texts[5]), (None, "w4 w5 w1"), (900, None), (901, ""), (902, "w1"), (903, "w1 " * 30_000), (904, " ".join(texts))]
    df = spark.createDataFrame([(i, t, 1, "s", 2, 3) for i, t in docs], DOCS).repartition(3)
    return docs, df, items, spark.createDataFrame([(i, t, 1, "u") for i, t in items], ITEMS)


@pytest.mark.parametrize("item_bytes", [1 << 24, 120])
def test_decontamination(spark, monkeypatch, item_bytes):
    monkeypatch.setattr(words, "ITEM_BYTES", item_bytes)
    docs, df, items, item_df = odd_tables(spark, random.Random(7))
    window, within = 4, 6
    want, near = [], []
    for i, text in docs:
        w = tokens(text)
        hit, held, close = set(), set(), set()
        for item, it in items:
            t = tokens(it)
            for k in range(max(1, len(t) - window + 1) if t else 0):
                g = t[k : k + window]
                places = [p for p in range(len(w) - len(g) + 1) if w[p] == g[0] and w[p : p + len(g)] == g]
                hit.update(p + j for p in places for j in range(len(g)))
                if places:
                    held.add(item)
                if any(set(g) <= set(w[p : p + within]) for p in range(max(1, len(w) - within + 1))):
                    close.add(item)
        names = sorted(str(x) for x in held if x is not None)
        want.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
        near.append((i, len(w), names, sorted(str(x) for x in close if x is not None)))
    same([tuple(r) for r in decontamination.contaminated(df, item_df, window).collect()], want)
    found = decontamination.matches(df, item_df, window, within).collect()
    same([(r.doc_id, r.n_words, r["items"], r.near_items) for r in found], near)
    for r in found:
        assert all(a.start < a.end for a in r.spans) and all(a.end < b.start for a, b in itertools.pairwise(r.spans))
    if item_bytes > 120:
        none, no_items = df.where("score = 0"), item_df.where("uid = ''")
        assert decontamination.contaminated(none, item_df).count() == 0
        assert not any(r.contaminated or r.n_hit or r.n_items for r in decontamination.contaminated(df, no_items).collect())
        assert decontamination.contaminated(df, no_items).count() == len(docs)


@pytest.mark.parametrize(("item_bytes", "bucket"), [(1 << 24, 256), (120, 256)])
def test_ranked_search(spark, monkeypatch, item_bytes, bucket):
    monkeypatch.setattr(words, "ITEM_BYTES", item_bytes)
    docs, df, items, item_df = odd_tables(spark, random.Random(8))
    held = [(i, collections.Counter(tokens(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df_of = collections.Counter(t for _, c in held for t in c)
    want = []
    for item, text in items:
        asked, scores = collections.Counter(tokens(text)), []
        for i, c in held:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // n_terms
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df_of[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, q in asked.items() if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        want += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:10], 1)]
    same([tuple(r) for r in lexical.ranked(df, item_df, 10).collect()], want)
    if item_bytes > 120:
        assert lexical.ranked(df.where("score = 0"), item_df).count() == 0 and lexical.ranked(df, item_df.where("uid = ''")).count() == 0
        assert lexical.ranked(df.where("doc_id IN (900, 901)"), item_df).count() == 0


def test_buckets_are_pruned(monkeypatch):
    """Bounds leave out buckets and documents, and the result is that of scoring everything."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(5)
    texts = [" ".join(f"t{int(rng.paretovariate(0.6))}" for _ in range(rng.randint(1, 60))).encode() for _ in range(3000)]
    known, asked = words.vocabulary(texts[:40])
    batch = pa.RecordBatch.from_arrays([pa.array([0] * 3000), pa.array(range(3000)), pa.array([t.decode() for t in texts])], ["k", "i", "t"])
    rows = list(lexical._vectors(iter([batch]), known))
    df_of = np.bincount(np.concatenate([np.unique(words.numbered(t, known)[words.numbered(t, known) >= 0]) for t in texts]), minlength=len(known))
    weights = np.array([math.floor(1000 * math.log((2 * 3000 + 2) / (2 * n + 1))) for n in df_of], np.int64)
    n_terms = sum(len(t.split()) for t in texts)
    calls = []
    bucket = lexical._bucket
    monkeypatch.setattr(lexical, "_bucket", lambda items, best, top, asked, *rest: (calls.append(len(asked)), bucket(items, best, top, asked, *rest)))
    run = lambda least: [b.to_pydict() for b in lexical._ranked(iter(rows), asked, weights, 3000, n_terms, 10, least, False)][0]
    monkeypatch.setattr(lexical, "BUCKET", 64)
    scored, add = [], lexical.Best.add
    monkeypatch.setattr(lexical.Best, "add", lambda self, item, ids, scores: (scored.append(len(ids)), add(self, item, ids, scores)))
    first = run(np.zeros(40, np.int64))
    pruned, calls[:] = sum(calls), []
    monkeypatch.setattr(lexical.Best, "add", lambda self, item, ids, scores: (self.scores.__setitem__(item, np.concatenate([self.scores[item], scores])), self.ids.__setitem__(item, np.concatenate([self.ids[item], ids]))))
    every = run(np.zeros(40, np.int64))
    assert pruned < sum(calls) and sum(scored) < 0.2 * len(every["score"])
    best = collections.defaultdict(list)
    for item, i, s in zip(every["item"], every["doc_id"], every["score"], strict=True):
        best[item].append((-s, i))
    assert sorted(zip(first["item"], first["doc_id"], first["score"], strict=True)) == sorted((item, i, -s) for item, found in best.items() for s, i in sorted(found)[:10])
