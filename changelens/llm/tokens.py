"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

import base64
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: A space between two characters that are not white space: a byte-level BPE pre-tokenizer always begins a new
#: piece there, so that the pieces' ids, one after the other, are the ids of the whole text.
SAFE = re.compile(r"(?<=\S) (?=\S)")
#: Pieces without rare characters, for which every Unicode version gives the same letters, digits and white space.
LATIN = "!-~\u00a1-\u00ac\u00ae-\u024f"
PLAIN = re.compile(f"[{LATIN}](?:[\n{LATIN}]*[{LATIN}])?")
#: Begins and ends with a character that is surely no white space.
EDGES = re.compile(r"[!-~](?:.*[!-~])?\Z", re.DOTALL)
#: Further safe boundaries, for pieces that are long: a word or mark before white space, a letter beside a digit, a word before a mark.
#: Only where the text holds no special token's string.
SAFE_TOO = re.compile(r"(?<=[!-~])(?=[ \n\t])|(?<=[A-Za-z])(?=[0-9.,;:!?)])|(?<=[0-9])(?=[A-Za-z.,;:!?)])")
#: UTF-8 bytes of texts that are gathered, and of new pieces that are encoded in one call.
BATCH_BYTES = 1 << 18
#: Pieces a worker remembers (about 200 bytes each).
REMEMBERED, LONGEST = 500_000, 128


class Encoder:
    """Token ids of texts as the library gives them for the whole text.

    Texts are gathered up to BATCH_BYTES and cut at safe boundaries; the pieces of all of them that this worker has not seen are
    encoded together, in calls of about BATCH_BYTES, and others are remembered. Longer texts are taken a window at a time, so memory is held down
    for texts of any length; what no boundary divides is encoded whole. If the vocabulary lies beside the file as ranks (name.tiktoken for
    name.json), new pieces of plain characters are encoded in one string with it, which is faster and gives the same ids; others,
    and those with a special token's string, go to the tokenizer itself. With lengths, only the number of ids is kept of a piece.
    """

    def __init__(self, path: str, lengths: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranks, self.spaced = self._ranks(path.removesuffix(".json") + ".tiktoken")
        self.divisible = not any(SAFE_TOO.search(x) for x in self.special)
        self.value, self.joined, self.nothing = ((lambda raw: len(raw) // 4), sum, 0) if lengths else ((lambda raw: raw), b"".join, b"")
        self.known: dict[str, bytes | int] = {}  # by piece after a space
        self.first: dict[str, bytes | int] = {}  # by piece at a text's start

    def _ranks(self, path: str):
        if not os.path.exists(path):
            return None, None
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        begins = np.zeros(max(ranks.values()) + 1, bool)
        begins[[i for b, i in ranks.items() if b.startswith(b" ")]] = True
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), begins

    def _holds_special(self, text: str) -> bool:
        return any(x in text for x in self.special)

    def _learn(self, new: set[str], special: bool) -> None:
        """new: pieces that stand after a space; special: whether they may hold a special token's string."""
        batch, odd, n = [], [], 0
        for piece in new:
            if self.ranks is None or special and self._holds_special(piece) or not PLAIN.fullmatch(piece):
                odd.append(piece)
                continue
            batch.append(piece)
            n += 2 * len(piece)  # bytes at most, for a plain piece
            if n >= BATCH_BYTES:
                self._by_ranks(batch)
                batch, n = [], 0
        if batch:
            self._by_ranks(batch)
        self.known.update(self._by_library(odd, " "))

    def _by_ranks(self, batch: list[str]) -> None:
        """Each piece has one space, at its start, so its first token is the one that begins with a space."""
        ids = np.array(self.ranks.encode_ordinary(" " + " ".join(batch)), np.uint32)
        at = 4 * np.flatnonzero(self.spaced[ids])
        raw = ids.tobytes()
        for piece, a, b in zip(batch, at.tolist(), [*at[1:].tolist(), len(raw)], strict=True):
            self.known[piece] = self.value(raw[a:b])

    def _by_library(self, pieces: Iterable[str], before: str) -> Iterator[tuple[str, bytes | int]]:
        batch, n = [], 0
        for piece in [*pieces, None]:
            if batch and (piece is None or n >= BATCH_BYTES):
                for p, found in zip(batch, self.tokenizer.encode_batch_fast([before + p for p in batch], add_special_tokens=False), strict=True):
                    yield p, self.value(array("I", found.ids).tobytes())
                batch, n = [], 0
            if piece is not None and len(piece) > BATCH_BYTES and self.divisible and not self._holds_special(piece):
                parts = SAFE_TOO.split(before + piece)
                known = dict(self._by_library({p for p in parts if len(p) <= BATCH_BYTES}, ""))
                for p in parts:
                    if p not in known:  # nothing divides it
                        known[p] = self.value(array("I", self.tokenizer.encode(p, add_special_tokens=False).ids).tobytes())
                yield piece, self.joined(known[p] for p in parts)
            elif piece is not None:
                batch.append(piece)
                n += len(piece.encode())

    def _windows(self, text: str) -> Iterator[str]:
        """The text in parts of about BATCH_BYTES characters, cut before the space of a safe boundary."""
        at = 0
        while len(text) - at > 2 * BATCH_BYTES and (m := SAFE.search(text, at + BATCH_BYTES)):
            yield text[at : m.start()]
            at = m.start()
        yield text[at:] if at else text

    def _together(self, texts: list[str]) -> Iterator[bytes | int]:
        known, first = self.known, self.first
        if len(known) + len(first) > REMEMBERED:
            known.clear()
            first.clear()
        cut, new, starts, special = [], set(), set(), False
        for text in texts:
            parts = text.split(" ")
            unknown = set(parts[1:]).difference(known)
            if any(not p.strip() or p[0].isspace() or p[-1].isspace() for p in (parts[0], *[p for p in unknown if not EDGES.match(p)])):
                parts = SAFE.split(text)
                unknown = set(parts[1:]).difference(known)
            if unknown:
                new |= unknown
                special = special or self._holds_special(text)
            if parts[0] not in first:
                starts.add(parts[0])
            cut.append(parts)
        if new:
            self._learn(new, special)
        if starts:
            first.update(self._by_library(starts, ""))
        for parts in cut:
            yield self.joined(chain((first[parts[0]],), map(known.__getitem__, islice(parts, 1, None))))
        for p in [p for p in new if len(p) > LONGEST]:
            del known[p]
        for p in [p for p in starts if len(p) > LONGEST]:
            del first[p]

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes | int]:
        """For each text its ids as unsigned 32-bit numbers, little-endian as all platforms that Spark runs on, or their number."""
        batch, n = [], 0
        for text in texts:
            text = text or ""
            if len(text) > 2 * BATCH_BYTES:
                yield from self._together(batch)
                batch, n = [], 0
                yield self.joined(x for w in self._windows(text) for x in self._together([w]))
                continue
            batch.append(text)
            n += len(text.encode())
            if n >= BATCH_BYTES:
                yield from self._together(batch)
                batch, n = [], 0
        yield from self._together(batch)

    def ids(self, text: str | None) -> bytes | int:
        return next(self.encode([text]))


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """One row for each row of df: id, n_bytes, n_tokens, over_limit.

    Texts are encoded in batches balanced by bytes, over several texts, and only lengths leave the encoder.
    Tokens of the whole text by the tokenizer file at path, without special tokens added; strings of special
    tokens inside a text are treated as the library does by default. A null text counts as an empty one: 0
    bytes, 0 tokens, not over the limit. A null id stays null, repeated rows each give a row, an empty table
    gives an empty one, and other columns of df are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, lengths=True)
        for b in batches:
            texts = b.column(1)
            n_bytes = [n or 0 for n in pc.binary_length(texts).to_pylist()]
            n_tokens = list(encoder.encode(t.as_py() for t in texts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())], ["id", "n_bytes", "n_tokens", "over_limit"])

    src = df.select(df[id_col].cast("long").alias("id"), df[text_col].cast("string").alias("text"))
    return src.mapInArrow(run, "id long, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)
