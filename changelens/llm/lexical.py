"""Ranked lexical search in norm buckets: impact vectors in order of length, buckets pruned by the Cauchy-Schwarz
inequality and by their largest coordinates, documents in them by their heaviest coordinates, survivors scored in integers."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import written
from .words import gathered, item_blocks, numbered, vocabulary

#: Documents of a bucket: neighbours in the order of their vectors' lengths.
BUCKET = 256
#: Bounds are floating-point numbers; they count as so much larger.
SLACK = 1 + 1e-9

VECTORS = "docs array<bigint>, counts binary, sizes binary, terms binary, tfs binary, known array<int>, dfs array<bigint>, n_docs long, n_terms long"
RANKED = "item int, doc_id long, score long"


def _vectors(batches: Iterator[pa.RecordBatch], known: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """A row for each block of documents: number of terms, distinct terms of the vocabulary and their occurrences for each that
    holds such a term, and the block's own counts."""
    for block in gathered(batches):
        docs, counts, sizes, terms, tfs, n_docs, n_terms = [], [], [], [], [], 0, 0
        for _, doc, text in block:
            found = numbered(text, known)
            n_docs, n_terms = n_docs + (len(found) > 0), n_terms + len(found)
            term, tf = np.unique(found[found >= 0], return_counts=True)
            if len(term):
                docs.append(doc)
                counts.append(len(found))
                sizes.append(len(term))
                terms.append(term)
                tfs.append(tf)
        flat = np.concatenate(terms) if terms else np.zeros(0, np.int32)
        held, dfs = np.unique(flat, return_counts=True)
        raw = lambda x, kind: pa.array([np.asarray(x, kind).tobytes()], pa.binary())
        yield pa.RecordBatch.from_arrays([
            pa.array([docs], pa.list_(pa.int64())), raw(counts, np.int64), raw(sizes, np.int32), raw(flat, np.int32), raw(np.concatenate(tfs) if tfs else [], np.int32),
            pa.array([held], pa.list_(pa.int32())), pa.array([dfs], pa.list_(pa.int64())), pa.array([n_docs]), pa.array([n_terms]),
        ], ["docs", "counts", "sizes", "terms", "tfs", "known", "dfs", "n_docs", "n_terms"])


class Best:
    """The k best documents of each item so far, ties to smaller ids (a null id is the largest)."""

    def __init__(self, items: int, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.scores, self.ids = [np.zeros(0, np.int64)] * items, [np.zeros(0, np.int64)] * items

    def add(self, item: int, ids: np.ndarray, scores: np.ndarray) -> None:
        s, i = np.concatenate([self.scores[item], scores]), np.concatenate([self.ids[item], ids])
        keep = np.lexsort((i, -s))[: self.k]
        self.scores[item], self.ids[item] = s[keep], i[keep]
        if len(keep) == self.k:
            self.least[item] = max(self.least[item], s[keep[-1]])


NO_ID = np.iinfo(np.int64).max


class Items:
    """The items' terms and how often each has them, as one sparse matrix."""

    def __init__(self, texts: list[np.ndarray]):
        pairs = [np.unique(t, return_counts=True) for t in texts]
        self.sizes = np.array([len(t) for t, _ in pairs], np.int64)
        self.lo = np.cumsum(self.sizes) - self.sizes
        self.terms = np.concatenate([t for t, _ in pairs]).astype(np.int64)
        self.times = np.concatenate([n for _, n in pairs]).astype(np.int64)
        self.row = np.repeat(np.arange(len(pairs)), self.sizes)
        self.length = np.sqrt(np.bincount(self.row, self.times.astype(float) ** 2, len(pairs)))

    def of(self, item: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.lo[item], self.lo[item] + self.sizes[item])
        return self.terms[at], self.times[at]


def _bucket(items: Items, best: Best, top: np.ndarray, asked: np.ndarray, ids: np.ndarray, sizes: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> None:
    """Scores the bucket's documents for the items asked. top: zeros for all terms, and zeros again after."""
    order = np.argsort(terms, kind="stable")
    held, begin = np.unique(terms[order], return_index=True)
    most = np.maximum.reduceat(impacts[order], begin)
    begin = np.append(begin, len(terms))
    doc = np.repeat(np.arange(len(ids)), sizes)
    doc_of, impact_of, first = doc[order], impacts[order], np.cumsum(sizes) - sizes
    top[held] = most
    bound = np.bincount(items.row, (items.times * top[items.terms]).astype(float), len(items.sizes)) * SLACK
    for q in asked[(bound[asked] > 0) & (bound[asked] >= best.least[asked])].tolist():
        q_terms, q_times = items.of(q)
        heavy = np.argsort(-(q_times * top[q_terms]), kind="stable")
        rest = np.cumsum((q_times * top[q_terms])[heavy][::-1].astype(float))[::-1] * SLACK  # what the terms from here on can give at most
        # documents with none of the first terms stay below the least score; one term at least has to be there
        n = int(np.count_nonzero((rest >= best.least[q]) & (rest > 0)))
        focus = heavy[:n]
        where = np.searchsorted(held, q_terms[focus])
        lo, size = begin[where], begin[where + 1] - begin[where]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)
        part = np.bincount(doc_of[at], impact_of[at] * np.repeat(q_times[focus], size).astype(float), len(ids)) * SLACK
        stay = np.flatnonzero((part > 0) & (part + (rest[n] if n < len(rest) else 0.0) >= best.least[q]))
        if len(stay):
            weight = np.zeros(len(top), np.int64)
            weight[q_terms] = q_times
            size = sizes[stay]
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[stay], size)
            scores = np.add.reduceat(weight[terms[at]] * impacts[at], np.cumsum(size) - size)
            good = (scores > 0) & (scores >= best.least[q])
            if good.any():
                best.add(q, ids[stay][good], scores[good])
    top[held] = 0


def _ranked(batches: Iterator[pa.RecordBatch], texts: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, k: int, least: np.ndarray, longest: bool) -> Iterator[pa.RecordBatch]:
    """The k best documents for each item among those of the task; with longest, of each block only the bucket of the longest vectors."""
    items = Items(texts)
    best, top = Best(len(texts), k, least), np.zeros(len(weights), np.int64)
    for batch in batches:
        for row in batch.to_pylist():
            counts, sizes, terms, tfs = (np.frombuffer(row[c], kind) for c, kind in (("counts", np.int64), ("sizes", np.int32), ("terms", np.int32), ("tfs", np.int32)))
            if not len(counts):
                continue
            ids = np.array([NO_ID if i is None else i for i in row["docs"]], np.int64)
            m = 100 - 75 + (75 * counts * n_docs) // n_terms
            tf = tfs.astype(np.int64)
            impacts = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, sizes)))
            first = np.cumsum(sizes, dtype=np.int64) - sizes
            length = np.sqrt(np.add.reduceat(impacts.astype(float) ** 2, first))
            order = np.argsort(-length, kind="stable")
            for at in range(0, len(order), BUCKET):
                asked = np.flatnonzero(items.length * length[order[at]] * SLACK >= best.least)
                if not len(asked):
                    break  # all further vectors are shorter
                docs = order[at : at + BUCKET]
                size = sizes[docs].astype(np.int64)
                entry = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[docs], size)
                _bucket(items, best, top, asked, ids[docs], size, terms[entry].astype(np.int64), impacts[entry])
                if longest:
                    break
    n = [len(s) for s in best.scores]
    ids = np.concatenate(best.ids)
    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(n), dtype=np.int32), n)), pa.array(ids, mask=ids == NO_ID), pa.array(np.concatenate(best.scores))], ["item", "doc_id", "score"])


def ranked(df: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents for each item, with a score above 0; equal scores by ascending doc_id.

    Terms are runs of letters and digits, and of all characters beyond ASCII, after A-Z are lower-cased. N documents have terms, L in
    all; df of them hold a term, whose weight is w = floor(1000 ln((2 N + 2) / (2 df + 1))). In a document of n terms, m = 25 + 75 n N div L, and a
    term that occurs tf times has the impact w (10^9 tf div (1000 tf + 8 m)). The score sums the impacts of the item's terms, with repeats.

    Texts are read once, into vectors of the terms that items hold, in blocks of bounded size, which are never shuffled. Each block has its vectors in
    order of length, in buckets. First the longest of every block are scored, which gives each item a score that k documents reach; then every bucket
    that the bounds do not rule out. Bounds rule out only what cannot reach that score, so the result is exact. Each task gives k rows for an item.

    Items are dealt into blocks of ITEM_BYTES, each of which takes rounds of its own, so what goes to the tasks is bounded. Items without terms
    give no rows; equal item ids in several rows are items of their own; documents without an id rank after all with the same score; repeated rows are
    documents of their own; empty tables give an empty one; other columns are not read."""
    spark = df.sparkSession
    docs = df.select(F.lit(0), df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))
    out = spark.createDataFrame([], f"item_id {items.schema[item_id].dataType.simpleString()}, rank int, doc_id long, score long")
    for block in item_blocks(items, item_id, item_text):
        known, texts = vocabulary([t for _, t in block])
        if not known:
            continue
        vectors = written(docs.mapInArrow(lambda it, known=known: _vectors(it, known), VECTORS), "impact-vectors")
        n_docs, n_terms = vectors.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        if not n_terms:
            continue
        weights = np.zeros(len(known), np.int64)
        for r in vectors.select(F.explode(F.arrays_zip("known", "dfs")).alias("p")).groupBy("p.known").agg(F.sum("p.dfs").alias("df")).collect():
            weights[r["known"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
        search = lambda least, longest: vectors.mapInArrow(lambda it: _ranked(it, texts, weights, n_docs, n_terms, k, least, longest), RANKED)  # noqa: B023, E731
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        ranks = lambda found: found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)  # noqa: B023, E731
        least = np.zeros(len(block), np.int64)
        for r in ranks(search(least, True)).where(F.col("rank") == k).collect():
            least[r["item"]] = r["score"]
        names = spark.createDataFrame(list(enumerate(i for i, _ in block)), "item int, item_id string")
        found = ranks(search(least, False)).join(names, "item")
        out = out.unionByName(found.select(F.col("item_id").cast(out.schema["item_id"].dataType), "rank", "doc_id", "score"))
    return out
