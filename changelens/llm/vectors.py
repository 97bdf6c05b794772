"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations, multiprobe buckets, and verified
pairs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, split_join, whole_groups, written

#: Expected rows of a bucket that the number of hashes of a key aims at.
BUCKET_ROWS = 512
#: A pair just at the threshold is missed once in so many times.
MISSED = 2000
#: Members of a bucket that are compared at once; larger ones are compared block by block.
BLOCK = 1024
SEED = 29


def hadamard(v: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, whose length is a power of two."""
    n, out, h = v.shape[1], v.copy(), 1
    while h < n:
        pairs = out.reshape(len(v), n // (2 * h), 2, h)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(v), n)
        h *= 2
    return out / math.sqrt(n)


def rotate(v: np.ndarray, which: int) -> np.ndarray:
    """A pseudo-random rotation: random signs and a Hadamard transform, three times."""
    rng = np.random.default_rng([SEED, which])
    for _ in range(3):
        v = hadamard(v * rng.choice(np.array([-1.0, 1.0]), v.shape[1]))
    return v


def probes(unit: np.ndarray, tables: int, hashes: int, extra: int) -> np.ndarray:
    """Bucket keys [row, table, 1 + extra]: first the row's own bucket, the nearest vertices of the cross-polytope
    for each of the table's hashes; then those where one hash takes a vertex that is nearly as near."""
    width = 1 << max(1, (unit.shape[1] - 1).bit_length())
    v = np.zeros((len(unit), width))
    v[:, : unit.shape[1]] = unit
    out = np.empty((len(v), tables, 1 + extra), np.int64)
    rank = min(width, 2 + extra // hashes)
    for t in range(tables):
        codes, losses = [], []
        for k in range(hashes):
            y = rotate(v, t * hashes + k)
            order = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :rank]
            top = np.take_along_axis(y, order, 1)
            codes.append(order * 2 + (top > 0))
            losses.append(np.abs(top[:, :1]) - np.abs(top[:, 1:]))
        base = np.zeros(len(v), np.int64)
        for k in range(hashes):
            base = base * (2 * width) + codes[k][:, 0]
        out[:, t, 0] = base
        nearest = np.argsort(np.concatenate(losses, 1), axis=1, kind="stable")
        for p in range(extra):
            pick = nearest[:, min(p, nearest.shape[1] - 1)]
            k, r = pick // (rank - 1), pick % (rank - 1) + 1
            key = base.copy()
            for h in range(hashes):
                at = np.flatnonzero(k == h)
                key[at] += (codes[h][at, r[at]] - codes[h][at, 0]) * (2 * width) ** (hashes - 1 - h)
            out[:, t, 1 + p] = key
    return out


def settings(rows: int, dim: int, cosine: float) -> tuple[int, int, int]:
    """(tables, hashes, extra): as many hashes as keep buckets near BUCKET_ROWS, and as many tables as find all
    but one of MISSED pairs at the threshold, by a trial on random pairs of that cosine."""
    width = 1 << max(1, (dim - 1).bit_length())
    hashes = max(1, round(math.log(max(rows, 1) / BUCKET_ROWS + 1) / math.log(2 * width)))
    extra = 2 * hashes - 1 if hashes < 3 else 2 * hashes
    rng = np.random.default_rng(SEED)
    x = rng.standard_normal((4000, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = rng.standard_normal((4000, dim))
    u -= (u * x).sum(1, keepdims=True) * x
    u /= np.maximum(np.linalg.norm(u, axis=1, keepdims=True), 1e-12)
    y = cosine * x + math.sqrt(max(0.0, 1 - cosine * cosine)) * u
    a, b = probes(x, 2, hashes, extra), probes(y, 2, hashes, extra)
    met = (a == b[:, :, :1]).any(2) | (b == a[:, :, :1]).any(2)
    p = min(0.99, max(0.01, float(met.mean())))
    return max(2, math.ceil(math.log(1 / MISSED) / math.log(1 - p))), hashes, extra


def _unit(vectors: list) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are valid, and the unit vectors of those (all of one length)."""
    ok = np.zeros(len(vectors), bool)
    kept = []
    for i, v in enumerate(vectors):
        if v is None or not len(v) or any(x is None for x in v):
            continue
        a = np.asarray(v, np.float64)
        if not np.isfinite(a).all() or not a.any():
            continue
        norm = np.linalg.norm(a)
        if not 1e-140 < norm < 1e140:  # squares would leave the range of doubles
            a = a / np.abs(a).max()
            norm = np.linalg.norm(a)
        ok[i] = True
        kept.append(a / norm)
    return ok, kept


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ok, kept = _unit(b.column(1).to_pylist())
        units = iter(kept)
        raw = [next(units).tobytes() if x else None for x in ok]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary())], ["id", "unit"])


def _hashed(batches: Iterator[pa.RecordBatch], tables: int, hashes: int, extra: int, dim: int) -> Iterator[pa.RecordBatch]:
    """Each vector with its bucket keys, as a list of tables * (1 + extra) numbers and as bytes. A vector of another length
    has one key alone, by its length."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            b = batch.slice(at, 2000)
            units = b.column("unit").to_pylist()
            same = np.array([len(u) == 8 * dim for u in units], bool)
            keys: list = [np.array([-len(u)], np.int64) for u in units]
            if same.any():
                found = probes(np.frombuffer(b"".join(u for u, s in zip(units, same, strict=True) if s)).reshape(-1, dim), tables, hashes, extra)
                for i, k in zip(np.flatnonzero(same), found, strict=True):
                    keys[i] = k.reshape(-1)
            arrays = [*(b.column(c) for c in ("id", "copies", "unit")), pa.array([k.tobytes() for k in keys], pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "copies", "unit", "probes", "keys"])


def _pairs_here(pi: np.ndarray, pj: np.ndarray, table: int, key: int) -> np.ndarray:
    """Whether this bucket is the first, by table and key, in which the two vectors meet."""
    mine = (pj == pi[:, :, :1]).any(2)  # the first's own bucket is among the other's
    theirs = (pi == pj[:, :, :1]).any(2)
    first = (mine | theirs).argmax(1)
    rows = np.arange(len(pi))
    big = np.iinfo(np.int64).max
    a = np.where(mine[rows, first], pi[rows, first, 0], big)
    b = np.where(theirs[rows, first], pj[rows, first, 0], big)
    return (first == table) & (np.minimum(a, b) == key)


def _linked(batches: Iterator[pa.RecordBatch], tables: int, extra: int, cosine: float) -> Iterator[pa.RecordBatch]:
    """In each bucket, or pair of blocks of a bucket: how many vectors each is linked with (copies counted), each link
    counted in one bucket only, and edges to the smallest id that its links reach there."""
    for t in whole_groups(batches, ["tbl", "key", "x", "y"]):
        tbl, key, x, y, blk, ids, copies, own = (t[c].to_numpy() for c in ("tbl", "key", "x", "y", "blk", "id", "copies", "own"))
        unit, sets = t["unit"].to_pylist(), t["probes"].to_pylist()
        cuts = np.flatnonzero((np.diff(tbl) != 0) | (np.diff(key) != 0) | (np.diff(x) != 0) | (np.diff(y) != 0)) + 1
        out_a, out_b, out_n = [], [], []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)], strict=True):
            if b - a < 2:
                continue
            v = np.frombuffer(b"".join(unit[a:b])).reshape(b - a, -1)
            i_all = np.flatnonzero(blk[a:b] == x[a])
            j_all = np.flatnonzero(blk[a:b] == y[a])
            sim = v[i_all] @ v[j_all].T
            close = (sim >= cosine - 1e-9) & (own[a:b][i_all][:, None] | own[a:b][j_all][None, :]) & (ids[a:b][i_all][:, None] != ids[a:b][j_all][None, :])
            i, j = np.nonzero(close)
            i, j = i_all[i], j_all[j]
            if x[a] == y[a]:
                i, j = i[i < j], j[i < j]
            if not len(i):
                continue
            exact = np.concatenate([(v[i[s : s + 65536]] * v[j[s : s + 65536]]).sum(1) for s in range(0, len(i), 65536)]) >= cosine
            i, j = i[exact], j[exact]
            if key[a] >= 0 and len(i):
                p = np.frombuffer(b"".join(sets[a:b]), np.int64).reshape(b - a, tables, 1 + extra)
                here = np.concatenate([_pairs_here(p[i[s : s + 65536]], p[j[s : s + 65536]], int(tbl[a]), int(key[a])) for s in range(0, len(i), 65536)])
                i, j = i[here], j[here]
            if not len(i):
                continue
            c, own_ids = copies[a:b], ids[a:b]
            links = np.bincount(i, c[j], b - a) + np.bincount(j, c[i], b - a)
            least = own_ids.copy()
            while True:
                before = least.copy()
                np.minimum.at(least, i, before[j])
                np.minimum.at(least, j, before[i])
                if (least == before).all():
                    break
            seen = np.flatnonzero(links > 0)
            out_a.append(own_ids[seen])
            out_b.append(least[seen])
            out_n.append(links[seen].astype(np.int64))
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(z)) for z in (out_a, out_b, out_n)], ["a", "b", "links"])


def near_vectors(df: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """A row for each row of df: vec_id, n_links, component_id, kept.

    Two vectors are linked if their cosine, in double precision, is at least the threshold. Equal vectors form a class, of which the one
    with the smallest id is hashed and compared, and its links count for all. Each key is made of cross-polytope
    hashes after Hadamard rotations; a vector also stands in the buckets next to its own. Buckets are not
    capped: large ones are dealt out in pairs of blocks. Pairs are only counted where they meet, never written.

    Vectors that are null, empty, zero, or hold null or non-finite components have no links and stand alone.
    Very large or small components do no harm: such vectors are scaled first. Vectors of different lengths are never linked. Rows with the same id are one vector, of different ones
    that with the least hashes. A row without an id has no links and
    no component, and is kept. An empty table gives an empty one; other columns are not read."""
    spark = df.sparkSession
    src = df.select(df[id_col].cast("long").alias("id"), df[vec_col].cast("array<double>").alias("v"))
    base = src.mapInArrow(_check, "id long, unit binary")
    base = written(base.withColumn("ha", F.xxhash64("unit")).withColumn("hb", F.xxhash64(F.lit(7), "unit")), "vectors")
    known = base.where("id IS NOT NULL AND unit IS NOT NULL")
    classes = written(known.select("ha", "hb", "id").distinct().groupBy("ha", "hb").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "vector-classes")
    reps = known.join(classes, (known["id"] == classes["rep"]) & (known["ha"] == classes["ha"]) & (known["hb"] == classes["hb"]))
    reps = reps.groupBy("id").agg(F.min_by(F.struct("copies", "unit"), F.struct(known["ha"], known["hb"])).alias("r")).select("id", "r.*")
    reps = written(reps, "vector-reps")
    lengths = reps.groupBy((F.length("unit") / 8).cast("int").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    rows, dim = (lengths["count"], lengths["dim"]) if lengths else (0, 1)
    tables, hashes, extra = settings(rows, dim, cosine)
    hashed = written(reps.mapInArrow(lambda it: _hashed(it, tables, hashes, extra, dim), "id long, copies long, unit binary, probes binary, keys array<bigint>"), "vector-probes")
    thin = hashed.select("id", F.posexplode("keys").alias("pos", "key"))
    thin = thin.select("id", F.floor(F.col("pos") / (1 + extra)).cast("int").alias("tbl"), "key", (F.col("pos") % (1 + extra) == 0).alias("own"))
    sizes = written(thin.groupBy("tbl", "key").agg(F.count("*").alias("n")).where("n > 1"), "bucket-sizes")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows_in = split_join(thin, sizes, ["tbl", "key"], "n", rows * tables * (1 + extra)).withColumn("blk", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows_in = rows_in.select("tbl", "key", F.least("blk", "other").alias("x"), F.greatest("blk", "other").alias("y"), "blk", "id", "own").join(hashed.drop("keys"), "id")
    dealt = rows_in.repartition("tbl", "key", "x", "y").sortWithinPartitions("tbl", "key", "x", "y")
    found = written(dealt.mapInArrow(lambda it: _linked(it, tables, extra, cosine), "a long, b long, links long"), "vector-links")
    joined = components(found.select("a", "b"))
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    of_class = classes.join(joined, classes["rep"] == joined["node"], "left").join(links, classes["rep"] == links["a"], "left")
    of_class = written(of_class.select("ha", "hb", "copies", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component")), "vector-components")
    linked = F.col("unit").isNotNull() & F.col("id").isNotNull()
    total = of_class.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    out = split_join(base.where(linked).select("id", "ha", "hb"), of_class, ["ha", "hb"], "copies", total).select("id", "n_links", "component")
    out = out.unionByName(base.where(~linked).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component")))
    return out.select(F.col("id").alias("vec_id"), F.col("n_links").cast("long").alias("n_links"), F.col("component").alias("component_id"), F.coalesce(F.col("component") == F.col("id"), F.lit(True)).alias("kept"))
