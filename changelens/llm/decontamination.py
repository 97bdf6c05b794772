"""Benchmark decontamination by a positional inverted index: postings of the training texts' words, whose lists
are intersected by offset from each phrase's rarest word on; exact phrases and proximity matches."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written
from .words import gathered, item_blocks, lists, numbered, vocabulary

WINDOW = 10
#: A proximity match has all words of a window, in any order, within so many words.
WITHIN = 15
#: Candidates (a window and a place of its rarest word) that are looked at together.
CHUNK = 1 << 20

INDEX = "uids array<bigint>, docs array<bigint>, counts array<int>, terms array<int>, sizes array<int>, places binary"
FOUND = "uid long, doc_id long, n_words long, spans array<struct<start:int,end:int>>, items array<string>, near_items array<string>"


def _indexed(batches: Iterator[pa.RecordBatch], known: dict[bytes, int], apart: int) -> Iterator[pa.RecordBatch]:
    """A row for each block of documents: the documents with their numbers of words, and a posting list for each word
    of the vocabulary: its places in the block, where documents lie one after another, apart places from each other."""
    for block in gathered(batches):
        texts = [numbered(text, known) for _, _, text in block]
        counts = np.array([len(t) for t in texts], np.int32)
        first = np.cumsum(counts.astype(np.int64) + apart) - counts - apart
        flat = np.concatenate(texts)
        place = np.arange(len(flat)) + np.repeat(first - (np.cumsum(counts) - counts), counts)
        held = np.flatnonzero(flat >= 0)
        order = held[np.argsort(flat[held], kind="stable")]
        terms, sizes = np.unique(flat[order], return_counts=True)
        yield pa.RecordBatch.from_arrays([
            pa.array([[uid for uid, _, _ in block]], pa.list_(pa.int64())), pa.array([[i for _, i, _ in block]], pa.list_(pa.int64())), lists(counts, [len(counts)]),
            lists(terms.astype(np.int32), [len(terms)]), lists(sizes.astype(np.int32), [len(sizes)]), pa.array([place[order].astype(np.int32).tobytes()], pa.binary()),
        ], ["uids", "docs", "counts", "terms", "sizes", "places"])


class Windows:
    """The distinct windows of some items: their words, by place and by rarity, and the items that hold each."""

    def __init__(self, texts: list[np.ndarray], item: np.ndarray, window: int, counts: np.ndarray):
        of: dict[bytes, set[int]] = {}
        for t, i in zip(texts, item.tolist(), strict=True):
            for at in range(max(1, len(t) - window + 1) if len(t) else 0):
                of.setdefault(t[at : at + window].tobytes(), set()).add(i)
        self.length = np.array([len(k) // 4 for k in of], np.int64)
        self.words = np.full((len(of), window), -1, np.int64)
        for row, k in enumerate(of):
            self.words[row, : len(k) // 4] = np.frombuffer(k, np.int32)
        self.items, self.held = np.array([i for s in of.values() for i in sorted(s)], np.int64), np.array([len(s) for s in of.values()], np.int64)
        self.begin = np.cumsum(self.held) - self.held
        how_often = np.where(self.words >= 0, counts[self.words], np.iinfo(np.int64).max)
        #: offsets of a window's words, the rarest word first
        self.order = np.argsort(how_often, axis=1, kind="stable")

    def of_items(self, window: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, place) for each window found at a place and each item that holds the window."""
        n = self.held[window]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return self.items[np.repeat(self.begin[window], n) + nth], np.repeat(place, n)


class Block:
    """Posting lists of a block of documents."""

    def __init__(self, row: dict, terms: int, apart: int):
        self.counts = np.array(row["counts"], np.int64)
        self.first = np.cumsum(self.counts + apart) - self.counts - apart
        self.places = np.frombuffer(row["places"], np.int32).astype(np.int64)
        sizes, held = np.array(row["sizes"], np.int64), np.array(row["terms"], np.int64)
        self.lo, self.n = np.zeros(terms, np.int64), np.zeros(terms, np.int64)
        self.lo[held], self.n[held] = np.cumsum(sizes) - sizes, sizes
        self.apart, self.end = apart, int((self.counts + apart).sum())
        # the lists by place, so that one more list is met by a look at its place; apart empty places before the first and after the last
        self.at = np.full(self.end + 2 * apart, -1, np.int64)
        self.at[self.places + apart] = np.repeat(held, sizes)

    def candidates(self, windows: Windows) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, place of its rarest word), CHUNK at once."""
        rare = windows.words[np.arange(len(windows.words)), windows.order[:, 0]]
        upto = np.cumsum(self.n[rare])
        for start in range(0, int(upto[-1]) if len(upto) else 0, CHUNK):
            nth = np.arange(start, min(start + CHUNK, int(upto[-1])))
            w = np.searchsorted(upto, nth, "right")
            yield w, self.places[self.lo[rare[w]] + nth - (upto[w] - self.n[rare[w]])]

    def phrases(self, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        """(window, first place) of every occurrence: the rarest word's list, less its offset, is cut with the others' in turn."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for w, p in self.candidates(windows):
            start = p - windows.order[w, 0]
            for k in range(1, windows.words.shape[1]):
                offset = windows.order[w, k]
                # offsets beyond a short window are last in order, and hold there
                stay = (k >= windows.length[w]) | (self.at[start + offset + self.apart] == windows.words[w, offset])
                w, start = w[stay], start[stay]
                if not len(w):
                    break
            found.append((w, start))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def near(self, windows: Windows, within: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, place of its rarest word) where all its words are within so many words. Bit j of a mask
        stands for the stretch that begins j places before the rarest word; each further word leaves those that hold it."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for w, p in self.candidates(windows):
            open_ = np.full(len(w), (1 << within) - 1, np.int64)
            for k in range(1, windows.words.shape[1]):
                word = windows.words[w, windows.order[w, k]]
                holds = np.where(word < 0, open_, 0)
                for d in range(1 - within, within):
                    mask = sum(1 << j for j in range(max(0, -d), min(within - 1, within - 1 - d) + 1))
                    holds |= np.where(self.at[p + d + self.apart] == word, mask, 0)
                open_ &= holds
                stay = open_ > 0
                w, p, open_ = w[stay], p[stay], open_[stay]
                if not len(w):
                    break
            found.append((w, p))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def by_document(self, item: np.ndarray, place: np.ndarray, items: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct items of each document, and their number in each."""
        doc = np.searchsorted(self.first, place, "right") - 1
        pairs = np.unique(doc * items + item)
        return pairs % items, np.bincount(pairs // items, minlength=len(self.counts))


def _searched(batches: Iterator[pa.RecordBatch], ids: list[str | None], texts: list[np.ndarray], counts: np.ndarray, window: int, within: int | None, apart: int) -> Iterator[pa.RecordBatch]:
    """A row for each document: merged spans of its hit words, and the items of the phrases and proximity matches in it."""
    windows, names = Windows(texts, np.arange(len(texts)), window, counts), pa.array(ids, pa.string())
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row, len(counts), apart)
            w, start = block.phrases(windows)
            covered = np.zeros(block.end + 1, np.int64)
            np.add.at(covered, start, 1)
            np.add.at(covered, start + windows.length[w], -1)
            edge = np.diff((np.cumsum(covered) > 0).astype(np.int8), prepend=0)
            begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            doc = np.searchsorted(block.first, begins, "right") - 1
            spans = np.bincount(doc, minlength=len(block.counts))
            span = pa.StructArray.from_arrays([pa.array((x - block.first[doc]).astype(np.int32)) for x in (begins, ends)], ["start", "end"])
            named = lambda found: lists(names.take(pa.array(found[0])), found[1])
            items = named(block.by_document(*windows.of_items(w, start), len(texts)))
            near = named(block.by_document(*windows.of_items(*block.near(windows, within)), len(texts))) if within else pa.nulls(len(block.counts), pa.list_(pa.string()))
            arrays = [pa.array(row["uids"], pa.int64()), pa.array(row["docs"], pa.int64()), pa.array(block.counts), lists(span, spans), items, near]
            yield pa.RecordBatch.from_arrays(arrays, ["uid", "doc_id", "n_words", "spans", "items", "near_items"])


def _merged(spans):
    """Spans in order, those that overlap or touch made one."""
    last = lambda done: F.element_at(done, -1)
    join = lambda done, x: F.when((F.size(done) > 0) & (x["start"] <= F.coalesce(F.get(done, F.size(done) - 1)["end"], F.lit(-1))),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last(done)["start"].alias("start"), F.greatest(last(done)["end"], x["end"]).alias("end")))),
    ).otherwise(F.concat(done, F.array(x)))
    return F.aggregate(F.array_sort(spans), F.array().cast("array<struct<start:int,end:int>>"), join)


def matches(df: DataFrame, items: DataFrame, window: int = WINDOW, within: int | None = WITHIN, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row for each row of df: doc_id, n_words, spans (first and end word of each stretch of hit words), items and near_items (ids as strings, sorted).

    A window is so many consecutive words of an item; an item of fewer, but not none, is one window. A document's word is hit if it
    lies in an occurrence of a window, and items has those with such an occurrence. near_items has the items of which a window has
    all its different words within so many words of the document (63 at most), in any order (None: not asked for, null). Words are runs of letters and digits, and of all characters beyond ASCII, after A-Z are lower-cased.

    Documents are indexed in blocks of bounded size; no posting leaves its block, so nothing but counts of words is shuffled. Postings are kept of words that
    the items hold. How often each word occurs in all documents says which word of a window is rarest. Items take part in blocks of ITEM_BYTES, for each of which
    the documents are indexed again, so what goes to the tasks is bounded.

    A null or empty text has no words and no matches; a null or empty item none either. Items with a null id hit words, but are not listed; items of one id are one. Repeated rows of df each give a row, null ids stay; empty tables
    give no rows, or rows without matches; other columns are not read."""
    if within is not None and not window <= within <= 63:
        raise ValueError("within must be from the window's length to 63")
    spark, apart = df.sparkSession, max(window, within or 0)
    docs = df.select(F.monotonically_increasing_id().alias("uid"), df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))
    blocks = item_blocks(items, item_id, item_text)
    first, second = next(blocks, []), next(blocks, None)
    several, parts = second is not None, []
    if several:
        docs = written(docs, "documents")  # the same uid in every round
    for block in chain([first], [second] if several else [], blocks):
        ids, (known, texts) = [i for i, _ in block], vocabulary([t for _, t in block])
        index = written(docs.mapInArrow(lambda it, known=known: _indexed(it, known, apart), INDEX), "postings")
        counts = np.zeros(len(known), np.int64)
        for r in index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("p")).groupBy("p.terms").agg(F.sum("p.sizes").alias("n")).collect():
            counts[r["terms"]] = r["n"]
        found = index.mapInArrow(lambda it, ids=ids, texts=texts, counts=counts: _searched(it, ids, texts, counts, window, within, apart), FOUND)
        parts.append(written(found, "matches") if several else found)
    found = parts[0]
    if several:
        for part in parts[1:]:
            found = found.unionByName(part)
        all_of = lambda c: F.flatten(F.collect_list(c)).alias(c)
        found = found.groupBy("uid").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), all_of("spans"), all_of("items"), all_of("near_items")).withColumn("spans", _merged("spans"))
    tidy = lambda c: F.array_sort(F.array_distinct(F.filter(c, lambda x: x.isNotNull()))).alias(c)
    return found.select("doc_id", "n_words", "spans", tidy("items"), (tidy("near_items") if within else F.lit(None).cast("array<string>")).alias("near_items"))


def contaminated(df: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """A row for each row of df, by exact phrases: doc_id, n_words, n_hit (hit words), n_items, items_sha256 (lowercase hex, of the items' ids
    as strings, in order and joined by commas), contaminated. As matches() for odd rows."""
    found = matches(df, items, window, None)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    sha = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), sha.alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))
