"""Approximate nearest neighbours by inner product: score-aware anisotropic product quantisation, four-bit table
scans, and exact reranking."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import whole_groups, written

#: Rows that the codebooks are fitted on at most (in expectation).
SAMPLE_ROWS = 20_000
CENTRES, PART = 16, 2
#: Scores below this part of the largest possible do not matter, so error along the vector weighs more.
THRESHOLD = 0.2
#: Best rows of a table scan, of each block, that are scored exactly.
RERANK = 200
QUERY_BLOCK, DATA_BLOCK, TILE = 8192, 8192, 256
#: Where the product of two lengths has a larger logarithm, sums may leave the range of doubles; such pairs are always scored exactly.
LARGEST = 700.0


class Codebook:
    """Sixteen centres for each pair of dimensions, fitted to the anisotropic loss
    |r|^2 + (weight - 1) (r . x / |x|)^2 of the residual r: error parallel to the vector changes its inner
    products with the queries that it is near to."""

    def __init__(self, dim: int):
        self.dim, self.parts = dim, -(-dim // PART)
        self.weight = max(1.0, (dim - 1) * THRESHOLD**2 / (1 - THRESHOLD**2))
        self.centres = np.zeros((self.parts, CENTRES, PART))

    def _split(self, x: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(x), self.parts * PART))
        padded[:, : self.dim] = x
        return padded.reshape(len(x), self.parts, PART)

    def fit(self, x: np.ndarray, rounds: int = 6) -> Codebook:
        rng = np.random.default_rng(5)
        v = self._split(x)
        for s in range(self.parts):
            self.centres[s] = v[rng.choice(len(v), CENTRES, replace=len(v) < CENTRES), s]
        unit = v / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None, None]
        for _ in range(rounds):
            codes = self.encode(x)
            along = self._along(v, unit, codes)
            total, d = along.sum(1), self.weight - 1
            for s in range(self.parts):
                others = total - along[:, s]
                u, c = unit[:, s], codes[:, s]
                left = np.zeros((CENTRES, PART, PART))
                right = np.zeros((CENTRES, PART))
                np.add.at(left, c, np.eye(PART)[None] + d * u[:, :, None] * u[:, None, :])
                np.add.at(right, c, v[:, s] + d * u * (others + (u * v[:, s]).sum(1))[:, None])
                used = np.bincount(c, minlength=CENTRES) > 0
                self.centres[s][used] = np.linalg.solve(left[used], right[used][:, :, None])[:, :, 0]
                new = (u * (v[:, s] - self.centres[s][c])).sum(1)
                total += new - along[:, s]
                along[:, s] = new
        return self

    def _along(self, v, unit, codes):
        return np.stack([(unit[:, s] * (v[:, s] - self.centres[s][codes[:, s]])).sum(1) for s in range(self.parts)], 1)

    def encode(self, x: np.ndarray, sweeps: int = 2) -> np.ndarray:
        """Codes [row, part]: each part's centre in turn, given the others' error along the vector."""
        v = self._split(x)
        unit = v / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None, None]
        codes = np.zeros((len(x), self.parts), np.int64)
        total, along = np.zeros(len(x)), np.zeros((len(x), self.parts))
        for sweep in range(sweeps):
            for s in range(self.parts):
                r = v[:, s, None, :] - self.centres[s][None]
                p = (unit[:, s, None, :] * r).sum(2)
                rest = total - along[:, s] if sweep else total
                codes[:, s] = ((r * r).sum(2) + (self.weight - 1) * (rest[:, None] + p) ** 2).argmin(1)
                along[:, s] = p[np.arange(len(x)), codes[:, s]]
                total = rest + along[:, s]
        return codes

    def pack(self, codes: np.ndarray) -> np.ndarray:
        """Two four-bit codes in a byte."""
        even = np.zeros((len(codes), codes.shape[1] + codes.shape[1] % 2), np.uint8)
        even[:, : codes.shape[1]] = codes
        return even[:, ::2] * 16 + even[:, 1::2]

    def tables(self, q: np.ndarray) -> np.ndarray:
        """[byte, value of the byte, query]: what a byte of codes adds to the inner product."""
        one = np.einsum("qsp,scp->sqc", self._split(q), self.centres)
        if self.parts % 2:
            one = np.concatenate([one, np.zeros((1, *one.shape[1:]))])
        both = one[::2, :, :, None] + one[1::2, :, None, :]
        return np.ascontiguousarray(both.reshape(len(both), len(q), CENTRES * CENTRES).transpose(0, 2, 1).astype(np.float32))


def _units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the rows and the logarithms of their lengths, for all finite components, however large or small."""
    most = np.abs(x).max(1)
    scaled = x / most[:, None]
    length = np.linalg.norm(scaled, axis=1)
    return scaled / length[:, None], np.log(most) + np.log(length)


def _exact(data: np.ndarray, q: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return np.cumsum(data * q, axis=1)[:, -1]  # in order, as SQL sums


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to smaller ids; NaN is the largest, as in Spark and SQL."""
    odd = np.isnan(scores)
    return np.lexsort((ids, -np.where(odd, np.inf, scores), ~odd))[:k]


def _searched(batches: Iterator[pa.RecordBatch], book: Codebook, k: int) -> Iterator[pa.RecordBatch]:
    """For a block of rows and a block of queries: each query's best k rows of the block."""
    for t in whole_groups(batches, ["block", "qblock"]):
        block, qblock = t["block"].to_numpy(), t["qblock"].to_numpy()
        cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(qblock) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)], strict=True):
            g = t.slice(a, b - a)
            asks, ids = g["asks"].to_numpy(), g["id"].to_numpy()
            v = np.frombuffer(b"".join(g["v"].to_pylist())).reshape(b - a, book.dim)
            rows, qs = np.flatnonzero(~asks), np.flatnonzero(asks)
            if not len(rows) or not len(qs):
                continue
            rows = rows[np.argsort(ids[rows], kind="stable")]
            data, data_ids = v[rows], ids[rows]
            raw = [x for x in g["codes"].to_pylist() if x is not None]
            codes = np.frombuffer(b"".join(raw), np.uint8).reshape(len(rows), -1)[np.argsort(ids[np.flatnonzero(~asks)], kind="stable")]
            out_q, out_i, out_s = [], [], []
            keep = min(max(RERANK, k + 1), len(rows))
            units, lengths = _units(v)
            weight = np.exp(lengths[rows] - lengths[rows].max()).astype(np.float32)[:, None]
            for at in range(0, len(qs), TILE):
                tile = qs[at : at + TILE]
                tables = book.tables(units[tile])
                scores = np.zeros((len(rows), len(tile)), np.float32)
                for s in range(codes.shape[1]):
                    scores += tables[s][codes[:, s]]
                scores *= weight
                beyond = lengths[rows].max() + lengths[tile].max() > LARGEST
                if beyond:
                    scores[lengths[rows][:, None] + lengths[tile][None, :] > LARGEST] = np.inf
                scores = scores.T
                least = np.partition(scores, len(rows) - keep, axis=1)[:, len(rows) - keep]
                for n, q in enumerate(tile):
                    near = np.flatnonzero(scores[n] >= least[n])  # with all that tie
                    near = near[data_ids[near] != ids[q]]
                    exact = _exact(data[near], v[q])
                    best = _best(exact, data_ids[near], k)
                    out_q.append(np.full(len(best), ids[q]))
                    out_i.append(data_ids[near[best]])
                    out_s.append(exact[best])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_q, out_i, out_s)], ["query_id", "vec_id", "score"])


def _compared(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The same without codes, each query with all rows of its length in the block."""
    for t in whole_groups(batches, ["block", "qblock"]):
        block, qblock = t["block"].to_numpy(), t["qblock"].to_numpy()
        cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(qblock) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)], strict=True):
            g = t.slice(a, b - a)
            asks, ids, raw = g["asks"].to_numpy(), g["id"].to_numpy(), g["v"].to_pylist()
            by: dict[int, tuple[list[int], list[int]]] = {}
            for n, v in enumerate(raw):
                by.setdefault(len(v), ([], []))[int(asks[n])].append(n)
            out_q, out_i, out_s = [], [], []
            for rows, qs in by.values():
                if not rows:
                    continue
                data, data_ids = np.frombuffer(b"".join(raw[n] for n in rows)).reshape(len(rows), -1), ids[rows]
                for q in qs:
                    exact = _exact(data, np.frombuffer(raw[q]))
                    best = _best(exact, data_ids, k + 1)
                    best = best[data_ids[best] != ids[q]][:k]
                    out_q.append(np.full(len(best), ids[q]))
                    out_i.append(data_ids[best])
                    out_s.append(exact[best])
            if out_q:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_q, out_i, out_s)], ["query_id", "vec_id", "score"])


def nearest(df: DataFrame, queries: str, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the k rows with the largest inner product (in double precision, on the
    original vectors) for each row that the condition queries (on the column vec_id) picks, ties to the smaller id; a row is no neighbour of itself.

    The codebook is fitted on a bounded sample; every row is encoded. Blocks of rows meet blocks of queries; in
    each meeting a table scan of the four-bit codes picks RERANK rows for each query, and all that tie with the
    last, which are scored exactly. Equal vectors have equal codes, so ties are never split. Each meeting gives k rows for each query.

    Codes are of directions, which the scan weighs with the vectors' lengths, so components of any size do no harm. A score whose sum leaves the range
    of doubles is infinite or NaN, as in SQL, and NaN is the largest. Vectors that are null, empty, zero, or that hold null or non-finite components take no part, nor do rows without an id. A vector meets those of its
    own length; the quantiser is for the most frequent length, and vectors of others, of which there are few, are compared as they are. Rows with the same
    id are one vector, of different ones the first in order; with fewer candidates than k all are returned; an empty table gives an empty one."""
    src = df.select(df[id_col].cast("long").alias("id"), df[vec_col].cast("array<double>").alias("v")).where("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    valid = written(src.where(finite).where(F.exists("v", lambda x: x != 0)).groupBy("id").agg(F.min("v").alias("v")), "search-vectors")
    by_dim = valid.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if by_dim is None:
        return df.sparkSession.createDataFrame([], schema)
    dim, n, total = by_dim["dim"], by_dim["count"], valid.count()
    other, valid = valid.where(F.size("v") != dim), valid.where(F.size("v") == dim)
    part = F.pmod(F.xxhash64("id", F.lit(13)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE_ROWS / n))
    sample = valid.where(part).select("v").toPandas()["v"] if n else []
    book = Codebook(dim)
    if len(sample):
        book.fit(_units(np.stack(sample.to_list()))[0])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                b = batch.slice(at, 4096)
                x = np.stack(b.column(1).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in book.pack(book.encode(_units(x)[0]))], pa.binary())], ["id", "v", "codes"])

    def as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [np.array(v, np.float64).tobytes() for v in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary()), pa.nulls(len(raw), pa.binary())], ["id", "v", "codes"])

    def meetings(rows: DataFrame, count: int) -> DataFrame:
        """Blocks of rows with blocks of queries, each meeting in one task."""
        asked = rows.where(queries.replace("vec_id", "id"))
        blocks, qblocks = -(-count // DATA_BLOCK), max(1, -(-asked.count() // QUERY_BLOCK))
        spread = lambda name, salt, total: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(total)).cast("int").alias(name)
        every = lambda name, total: F.explode(F.sequence(F.lit(0), F.lit(total - 1))).alias(name)
        data = rows.select(spread("block", 1, blocks), every("qblock", qblocks), F.lit(False).alias("asks"), "id", "v", "codes")
        ask = asked.select(every("block", blocks), spread("qblock", 2, qblocks), F.lit(True).alias("asks"), "id", "v", F.lit(None).cast("binary").alias("codes"))
        return data.unionByName(ask).repartition("block", "qblock").sortWithinPartitions("block", "qblock")

    coded, result = "id long, v binary, codes binary", "query_id long, vec_id long, score double"
    found = meetings(written(valid.select("id", "v").mapInArrow(encode, coded), "search-codes"), n).mapInArrow(lambda it: _searched(it, book, k), result)
    if total > n:
        found = found.union(meetings(written(other.select("id", "v").mapInArrow(as_bytes, coded), "search-others"), total - n).mapInArrow(lambda it: _compared(it, k), result))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
