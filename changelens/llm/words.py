"""Words of texts as numbers of a bounded vocabulary, and items (of a benchmark, say) in blocks of bounded size."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: UTF-8 bytes of the items that are worked on at once: they and what is made of them go to every task. Further blocks take further rounds.
ITEM_BYTES = 1 << 24
#: UTF-8 bytes of the texts that a block of documents gathers.
BLOCK_BYTES = 1 << 21

#: Runs of ASCII letters and digits and of all bytes beyond ASCII, after A-Z are lower-cased.
words = re.compile(rb"[0-9a-z\x80-\xff]+").findall


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The items' (id, text as bytes), all in blocks of about ITEM_BYTES, dealt by a hash; one item is never divided."""
    rows = items.select(items[id_col].cast("string").alias("id"), items[text_col].cast("string").cast("binary").alias("text")).where("length(text) > 0")
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = -(-total // ITEM_BYTES)
    for block in range(blocks):
        of = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block) if blocks > 1 else rows
        yield sorted(((r["id"], bytes(r["text"])) for r in of.collect()), key=lambda r: (r[0] is None, r[0] or "", r[1]))


def vocabulary(texts: list[bytes]) -> tuple[dict[bytes, int], list[np.ndarray]]:
    """A number for each word of the texts, and each text's word numbers."""
    known: dict[bytes, int] = {}
    return known, [np.fromiter((known.setdefault(w, len(known)) for w in words(t.lower())), np.int32) for t in texts]


def numbered(text: bytes | None, known: dict[bytes, int]) -> np.ndarray:
    """The numbers of the text's words, -1 for those that are not known."""
    found = words(text.lower()) if text else ()
    return np.fromiter(map(known.get, found, repeat(-1)), np.int32, len(found))


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows (key, id, text as bytes) of three columns, in blocks of about BLOCK_BYTES of text."""
    rows, size = [], 0
    for batch in batches:
        for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
            rows.append(row)
            size += len(row[2] or b"") + 64
            if size >= BLOCK_BYTES:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def lists(values: np.ndarray | pa.Array, counts: np.ndarray) -> pa.ListArray:
    """An Arrow column of lists: so many of the values for each row."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values if isinstance(values, pa.Array) else pa.array(values))
