"""Best-fit packing: a configuration linear program over the length histogram, solved by multiplicative
weights with knapsack pricing, then rounded."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import buckets_for, prefix_offsets, written
from .tokens import Encoder

#: The share of the tokens that the program leaves to best-fit, and how many sequences' worth it may be.
REST, REST_SEQUENCES = 0.09, 1000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(df: DataFrame, path: str, size: int, end_id: int, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """The pieces of every document: its ids and end_id; longer ones are cut into pieces of size, of which the
    first may be shorter. With keep_ids the ids themselves are a column, else their crc32 alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder(path), int(end_id).to_bytes(4, "little")
        for b in batches:
            rows: list[list] = [[], [], [], [], []]
            ids_out: list[np.ndarray] = []
            for key, found in zip(b.column(0).to_pylist(), encoder.encode(t.as_py() for t in b.column(1)), strict=True):
                ids = memoryview(found + end)
                n = len(ids) // 4
                first = n % size or size
                cuts = [0, *range(first, n + 1, size)]
                for k in range(len(cuts) - 1):
                    part = ids[4 * cuts[k] : 4 * cuts[k + 1]]
                    for column, value in zip(rows, (key, k, cuts[k], cuts[k + 1] - cuts[k], zlib.crc32(part)), strict=True):
                        column.append(value)
                    if keep_ids:
                        ids_out.append(np.frombuffer(part, "<u4").astype(np.int32))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(rows, types, strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                arrays.append(pa.array(ids_out, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    src = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))
    return src.mapInArrow(run, PIECES + (", ids array<int>" if keep_ids else ""))


def _knapsack(value: np.ndarray, lengths: np.ndarray, size: int) -> tuple[dict[int, int], float]:
    """The most valuable multiset of lengths (an index each) that fits into size."""
    worth = np.zeros(size + 1)
    worth[lengths] = value
    best, took = np.zeros(size + 1), np.zeros(size + 1, int)
    for c in range(1, size + 1):
        options = worth[1 : c + 1] + best[c - 1 :: -1]
        k = int(options.argmax())
        best[c], took[c] = options[k], k + 1
    chosen: dict[int, int] = {}
    c, worth_nothing = size, best[size] <= 0
    while c > 0 and not worth_nothing and best[c] > 0:
        length = int(took[c])
        if worth[length] > 0:
            chosen[length] = chosen.get(length, 0) + 1
        c -= length
    return chosen, float(best[size])


def _best_fit(demand: dict[int, int], size: int) -> list[tuple[int, dict[int, int]]]:
    """Best-fit decreasing on counts: (number of sequences, configuration) pairs. Sequences that have the same
    contents are handled together, so the work depends on the number of lengths, not of documents."""
    free: dict[int, list[tuple[int, tuple[tuple[int, int], ...]]]] = {}
    for length in sorted((x for x in demand if demand[x] > 0), reverse=True):
        left = demand[length]
        while left:
            room = min((r for r in free if r >= length), default=None)
            if room is None:
                per = size // length
                full, rest = divmod(left, per)
                for n, k in ((full, per), (1 if rest else 0, rest)):
                    if n:
                        free.setdefault(size - k * length, []).append((n, ((length, k),)))
                left = 0
                break
            n, held = free[room].pop()
            if not free[room]:
                del free[room]
            per = room // length
            full = min(n, left // per)
            if full:
                free.setdefault(room - per * length, []).append((full, (*held, (length, per))))
                left -= full * per
                n -= full
            if n and left and left < per:
                free.setdefault(room - left * length, []).append((1, (*held, (length, left))))
                left, n = 0, n - 1
            if n:
                free.setdefault(room, []).append((n, held))
    return [(n, dict(held)) for groups in free.values() for n, held in groups]


def configuration_program(histogram: dict[int, int], size: int, steps: int = 150, part: float = 0.8, rate: float = 20.0, favour: float = 0.1) -> tuple[list[tuple[int, dict[int, int]]], int, float]:
    """The plan: (number of sequences, {length: copies}) pairs that hold every length as often as the histogram has it; a lower bound of the
    number of sequences that any plan needs; and the share of the items that the program has placed.

    The configuration LP minimises the number of sequences such that each length is covered. Multiplicative weights: a length's
    price rises with the part of its demand that is behind the whole, and falls with what is ahead; pricing is a knapsack by dynamic programming.
    Each step uses its configuration a whole number of times, the amount of the step rounded down to what is left, once at least; after part
    of the demand the program is solved again for what is left, with steps in proportion. What is left in the end, REST of the tokens
    but no more than REST_SEQUENCES, is packed best-fit decreasing.

    Prices y give the bound: no sequence holds more than the knapsack's value, so at least demand * y / value are needed.
    favour prices long items above their share of a sequence, for short ones fit in anywhere later. The histogram has size
    entries at most, and the steps grow with the logarithm of the number of sequences, whatever the number of documents."""
    demand = {k: v for k, v in histogram.items() if v > 0}
    full = demand.pop(size, 0)
    out: list[tuple[int, dict[int, int]]] = [(full, {size: 1})] if full else []
    if not demand:
        return out, full, 1.0
    lengths = np.array(sorted(demand))
    need = np.array([demand[int(x)] for x in lengths])
    left, base = need.copy(), (lengths / size) ** (1 + favour)
    tokens, rest = int((lengths * need).sum()), int(min(REST * (lengths * need).sum(), REST_SEQUENCES * size))
    bound = tokens / size
    now = tokens
    while now > rest:
        asked, begun = np.maximum(left, 1), now
        amount = max(1, int(begun * part / size / steps))
        while now > max(rest, (1 - part) * begun):
            price = np.where(left > 0, base * np.exp(np.clip(rate * (left / asked - now / begun), -1, 1)), 0.0)
            found, value = _knapsack(price, lengths, size)
            bound = max(bound, float((need * price).sum()) / value)
            at = np.searchsorted(lengths, list(found))
            copies = np.minimum(list(found.values()), left[at])  # the knapsack may ask for more than there is
            n = min(amount, int((left[at] // copies).min()))
            left[at] -= n * copies
            now -= n * int((lengths[at] * copies).sum())
            out.append((n, {int(x): int(c) for x, c in zip(lengths[at], copies, strict=True)}))
    placed = full + int((need - left).sum())
    out += _best_fit({int(x): int(n) for x, n in zip(lengths, left, strict=True) if n}, size)
    return out, full + math.ceil(bound - 1e-6), placed / (full + int(need.sum()))


def plan_configurations(histogram: dict[int, int], size: int) -> list[tuple[int, dict[int, int]]]:
    return configuration_program(histogram, size)[0]


def layout(plan: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Where the items of a length go: rows of (length, first rank, sequence base, copies, offset), sorted by
    length and rank. Bounded by the number of configurations, not by the documents."""
    rows, seen, base = [], {}, 0
    for n, held in plan:
        offset = 0
        for length, copies in sorted(held.items(), reverse=True):
            rows.append((length, seen.get(length, 0), base, copies, offset))
            seen[length] = seen.get(length, 0) + n * copies
            offset += length * copies
        base += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, size: int) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32 and more): every piece in
    exactly one sequence of at most size tokens, without gaps, in as few sequences as the plan finds.

    pieces must be a written table, for it is read three times. Pieces of a length are numbered without
    bringing them together: hashed into buckets, numbered in each, and the buckets' counts summed up. Equal
    rows may change places, which gives the same rows. An empty table gives an empty one."""
    spark = pieces.sparkSession
    lengths = pieces.groupBy("length").count().collect()  # size rows at most
    histogram = {int(r["length"]): int(r["count"]) for r in lengths}
    table = layout(plan_configurations(histogram, size)) if histogram else np.zeros((0, 5), np.int64)
    # a row for each length, size at most
    buckets = spark.createDataFrame([(k, buckets_for(v)) for k, v in histogram.items()], "length long, __buckets int")
    keyed = pieces.join(F.broadcast(buckets), "length").withColumn("__bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "__buckets").cast("int")).drop("__buckets")
    offsets = prefix_offsets(keyed.groupBy("length", "__bucket").agg(F.count("*").alias("__n")), ["length"], "__bucket", "__n", "__before").select("length", "__bucket", "__before")
    w = Window.partitionBy("length", "__bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = keyed.withColumn("__rank", F.row_number().over(w) - 1).join(offsets, ["length", "__bucket"]).withColumn("__rank", F.col("__rank") + F.col("__before")).drop("__bucket", "__before")
    held = spark.sparkContext.broadcast(table)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        t = held.value
        shift = np.int64(1) << 44
        at = np.searchsorted(t[:, 0] * shift + t[:, 1], length.to_numpy() * shift + rank.to_numpy(), "right") - 1
        local = rank.to_numpy() - t[at, 1]
        copies = t[at, 3]
        return pd.DataFrame({"sequence_id": t[at, 2] + local // copies, "offset": t[at, 4] + local % copies * length.to_numpy()})

    return ranked.withColumn("__at", place("length", F.col("__rank").cast("long"))).select("*", "__at.sequence_id", "__at.offset").drop("__at", "__rank")


def pack_documents(df: DataFrame, path: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Packs every document of df: a row for each piece: doc_id, piece, start, length, ids_crc32 (and ids with
    keep_ids), sequence_id, offset. A null text is an empty one (its end id alone); null ids and repeated rows
    are packed as they are; other columns are not read."""
    return pack(written(cut_pieces(df, path, size, end_id, id_col, text_col, keep_ids), "pieces"), size)
