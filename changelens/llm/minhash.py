"""MinHash near-dedup: one-permutation hashing with optimal densification, banded buckets, star-shaped
candidate edges, and links confirmed on the full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import components, row_hash, split_join, whole_groups, written

#: A pair at similarity 0.8 misses all of 28 bands of 4 rows once in 2.5 million, were its bins independent.
BANDS, ROWS = 28, 4
BINS = BANDS * ROWS
#: Members of a bucket that are compared with each other at once; larger buckets are compared block by block.
BLOCK = 1024
#: Of the 112 stored bytes, so many agree at similarity 0.8 but for a chance of one in ten million.
AGREE = 64
#: Sets of so many shingles fill too few bins for that and meet by prefixes, without a chance to miss. Those of up to SMALL_MOST, which may be
#: linked with them, do both.
SMALL, SMALL_MOST = 32, 40
#: Rows of a block that meet all others before the rest do.
PIVOTS = 8
#: A shingle that is in more small sets than this, and in more than one in 2000 of them, comes last in prefixes.
FREQUENT, FREQUENT_SHARE = 1000, 2000
#: Word hashes that a worker remembers, of words of so many bytes at most.
REMEMBERED, LONGEST = 300_000, 64

_A, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(h: np.ndarray) -> np.ndarray:
    s = np.uint64(33)
    h = (h ^ (h >> s)) * _M1
    h = (h ^ (h >> s)) * _M2
    return h ^ (h >> s)


class Words(dict):
    """64-bit hashes of words (bytes), remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        found = xxhash.xxh64_intdigest(word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found


def shingle_set(text: str | None, words: Words, k: int) -> np.ndarray:
    """Sorted distinct hashes of the text's k-word shingles (A-Z lower-cased, words between ASCII white space);
    with fewer words, one hash of all; none without words."""
    found = text.encode().lower().split() if text else []
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    if len(h) < k:
        out = np.full(1 if len(h) else 0, len(h), np.uint64)
        for x in h:
            out = _mix(out * _A + x)
        return out
    n = len(h) - k + 1
    out = h[:n].copy()
    for j in range(1, k):
        out = out * _A + h[j : n + j]
    return np.unique(_mix(out))


def _sums(s: np.ndarray) -> tuple[int, int]:
    """Two hashes of a whole set."""
    return int(s.sum(dtype=np.uint64).astype(np.int64)), int(np.bitwise_xor.reduce(_mix(s + _A)).astype(np.int64)) if len(s) else 0


def _probes() -> np.ndarray:
    """For each bin, the bins to copy from, in order; from a fixed rule, so that all workers agree."""
    tries = np.arange(4 * BINS, dtype=np.uint64)[:, None]
    return (_mix(tries * np.uint64(1_000_003) + np.arange(BINS, dtype=np.uint64)[None, :] * _A + np.uint64(7)) % np.uint64(BINS)).astype(np.int64)


def signature(shingles: np.ndarray, probes: np.ndarray) -> np.ndarray:
    """One permutation: the hash range is cut into bins, each keeps its least hash; an empty bin copies that of
    the first bin of its own random order that is not empty."""
    bins = ((shingles >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    out, filled = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    at = np.flatnonzero(np.diff(bins, prepend=-1))
    out[bins[at]], filled[bins[at]] = shingles[at], True
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = filled[probes[:, empty]]
        source = probes[order.argmax(0), empty]
        source = np.where(order.any(0), source, bins[0])
        out[empty] = out[source]
    return out


def _marks(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    words, probes = Words(), _probes()
    band = np.arange(BANDS, dtype=np.uint64)
    for b in batches:
        n_out, a_out, b_out, keys_out, sig_out, small_out = [], [], [], [], [], []
        with np.errstate(over="ignore"):
            for text in b.column(1):
                s = shingle_set(text.as_py(), words, k)
                n_out.append(len(s))
                a, b2 = _sums(s)
                a_out.append(a)
                b_out.append(b2)
                small_out.append(s.astype(np.int64) if 0 < len(s) <= SMALL_MOST else None)
                if len(s) > SMALL:
                    v = signature(s, probes)
                    keys = band
                    for r in range(ROWS):
                        keys = _mix(keys * _A + v[r::ROWS])
                    keys_out.append(keys.astype(np.int64))
                    sig_out.append((_mix(v) & np.uint64(255)).astype(np.uint8).tobytes())
                else:
                    keys_out.append(np.zeros(0, np.int64))
                    sig_out.append(b"")
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n_out, pa.int64()), pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64()), pa.array(keys_out, pa.list_(pa.int64())), pa.array(sig_out, pa.binary()), pa.array(small_out, pa.list_(pa.int64()))], ["id", "th", "n", "ha", "hb", "keys", "sig", "small"])


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    words = Words()
    for b in batches:
        with np.errstate(over="ignore"):
            sets = [shingle_set(t.as_py(), words, k) for t in b.column(1)]
            ha, hb = zip(*map(_sums, sets), strict=True) if sets else ((), ())
        arrays = [b.column(0), pa.array(map(len, sets), pa.int64()), pa.array(ha, pa.int64()), pa.array(hb, pa.int64()), pa.array([x.astype(np.int64) for x in sets], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["id", "n", "ha", "hb", "shingles"])


def _prefixes(batches: Iterator[pa.RecordBatch], percent: int, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """key, id: a set's first shingles in an order that all sets share, frequent ones last: so many that two linked sets share one of them."""
    for b in batches:
        ids, keys = [], []
        for key, s in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            s = s.values.to_numpy()
            order = np.lexsort((s, np.isin(s, frequent)))
            first = s[order[: len(s) - -(-percent * len(s) // 100) + 1]]
            ids.append(np.full(len(first), key, np.int64))
            keys.append(first)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(ids))], ["key", "id"])


def _forest(n: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest id that the edges i - j reach: a star for each component."""
    least = ids.copy()
    while True:
        before = least.copy()
        np.minimum.at(least, i, before[j])
        np.minimum.at(least, j, before[i])
        if (least == before).all():
            return least


def _stars(batches: Iterator[pa.RecordBatch], pairs) -> Iterator[pa.RecordBatch]:
    """Edges to the smallest id of each local component, for each group's pair of blocks. pairs gives the edges
    among some rows of a table: (table, first rows, second rows) -> (i, j). At most an edge for each row."""
    for t in whole_groups(batches, ["key", "x", "y"]):
        key, x, y, blk, ids = (t[c].to_numpy() for c in ("key", "x", "y", "blk", "id"))
        cuts = np.flatnonzero((np.diff(key) != 0) | (np.diff(x) != 0) | (np.diff(y) != 0)) + 1
        out_key, out_a, out_b = [], [], []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)], strict=True):
            if b - a < 2:
                continue
            one, two = np.flatnonzero(blk[a:b] == x[a]), np.flatnonzero(blk[a:b] == y[a])
            i, j = pairs(t.slice(a, b - a), one, two)
            if len(i):
                least = _forest(b - a, i, j, ids[a:b])
                at = np.flatnonzero(least != ids[a:b])
                out_key.append(np.full(len(at), key[a]))
                out_a.append(ids[a:b][at])
                out_b.append(least[at])
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(z)) for z in (out_key, out_a, out_b)], ["key", "a", "b"])


def _edges(component: np.ndarray, one: np.ndarray, two: np.ndarray, check, chunk: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (i, j) that join rows of one with rows of two as all pairs that pass the check would. check(p, q) gives a matrix.

    Some rows meet all others first; where near copies are many, that joins most of them, and only pairs of different components are left."""
    label, left, right, tried = component.copy(), [], [], set()

    def meet(p: np.ndarray, q: np.ndarray) -> None:
        for start in range(0, len(p), chunk):
            rows = p[start : start + chunk]
            i, j = np.nonzero(check(rows, q) & (rows[:, None] != q[None, :]))
            left.append(rows[i])
            right.append(q[j])

    for _ in range(PIVOTS):
        fresh = next((p for p in one if label[p] not in tried), None)
        if fresh is None:
            break
        meet(np.array([fresh]), two)
        label[np.isin(label, label[right[-1]])] = label[fresh]
        tried.add(label[fresh])
    names, times = np.unique(label[np.concatenate([one, two])], return_counts=True)
    main = names[times.argmax()]
    if len(names) > 1:
        meet(one[label[one] != main], two)
        if one[0] != two[0]:
            meet(two[label[two] != main], one[label[one] == main])
    return np.concatenate(left), np.concatenate(right)


def _sized(n: np.ndarray, p: np.ndarray, q: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(n[p][:, None], n[q][None, :]) >= percent * np.maximum(n[p][:, None], n[q][None, :])


def _signatures(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint8).reshape(-1, BINS)


def _candidates(percent: int):
    """Pairs whose sizes and signatures allow a link."""

    def pairs(t: pa.Table, one: np.ndarray, two: np.ndarray):
        n, sig = t["n"].to_numpy(), _signatures(t)
        check = lambda p, q: _sized(n, p, q, percent) & ((sig[p][:, None, :] == sig[q][None, :, :]).sum(2) >= AGREE)
        return _edges(t["component"].to_numpy(), one, two, check, 64)

    return pairs


def _confirmed(percent: int, by_signature: bool):
    """Pairs whose full sets have 100 * intersection >= percent * union, of those that sizes, and signatures if asked, allow. Intersections
    of many pairs are a product of 0/1 matrices, some columns (shingles) at a time."""

    def pairs(t: pa.Table, one: np.ndarray, two: np.ndarray):
        n, sig = t["n"].to_numpy(), _signatures(t) if by_signature else None
        sets = t["shingles"].combine_chunks()
        values, offsets = sets.values.to_numpy(), sets.offsets.to_numpy()
        known, column = np.unique(values, return_inverse=True)
        row = np.repeat(np.arange(t.num_rows), np.diff(offsets))
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]

        def common(p: np.ndarray, q: np.ndarray) -> np.ndarray:
            if len(p) == 1:
                inside = np.concatenate([[0], np.cumsum(np.isin(values, values[offsets[p[0]] : offsets[p[0] + 1]]))])
                return (inside[offsets[q + 1]] - inside[offsets[q]])[None, :]
            wanted = np.zeros(t.num_rows, bool)
            wanted[p] = True
            has = np.zeros(len(known), bool)
            has[column[wanted[row]]] = True
            keep = has[column]
            at, where = np.cumsum(has)[column[keep]] - 1, row[keep]
            total = np.zeros((len(p), len(q)), np.float32)
            for start in range(0, int(has.sum()), 4096):
                lo, hi = np.searchsorted(at, [start, start + 4096])
                m = np.zeros((t.num_rows, 4096), np.float32)
                m[where[lo:hi], at[lo:hi] - start] = 1
                total += m[p] @ m[q].T
            return total.astype(np.int64)

        def check(p: np.ndarray, q: np.ndarray) -> np.ndarray:
            ok = _sized(n, p, q, percent)
            if sig is not None:
                for start in range(0, len(p), 64):
                    ok[start : start + 64] &= (sig[p[start : start + 64]][:, None, :] == sig[q][None, :, :]).sum(2) >= AGREE
            if ok.sum() <= 4 * len(p) and len(p) > 1:
                for i, j in zip(*np.nonzero(ok), strict=True):
                    a, b = p[i], q[j]
                    both = len(np.intersect1d(values[offsets[a] : offsets[a + 1]], values[offsets[b] : offsets[b + 1]], True))
                    ok[i, j] = 100 * both >= percent * (n[a] + n[b] - both)
            elif ok.any():
                both = common(p, q)
                ok &= 100 * both >= percent * (n[p][:, None] + n[q][None, :] - both)
            return ok

        return _edges(t["component"].to_numpy(), one, two, check, 256)

    return pairs


def _compared(rows: DataFrame, pairs) -> DataFrame:
    """key, a, b: the stars of each pair of blocks (x, y), each in one task. rows: key, x, y, blk, id, component and what pairs reads."""
    dealt = rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    return dealt.mapInArrow(lambda it: _stars(it, pairs), "key long, a long, b long")


def _block(count, first=0):
    """A row's block, by its id, of as many as count rows need."""
    return (F.lit(first) + F.pmod(F.xxhash64("id"), F.ceil(F.col(count) / BLOCK))).cast("int")


def _blocks(count):
    return F.ceil(F.col(count) / BLOCK).cast("int")


def _meeting(rows: DataFrame, others, extra: list[str]) -> DataFrame:
    """Each row once for each block that its own one (blk) meets: those numbers below others."""
    met = rows.withColumn("__other", F.explode(F.sequence(F.lit(0), others - 1)))
    return met.select("key", F.least("blk", "__other").alias("x"), F.greatest("blk", "__other").alias("y"), "blk", "id", "component", *extra)


def links_in_groups(members: DataFrame, about: DataFrame, total: int, pairs) -> DataFrame:
    """a, b: edges whose components are those of all pairs within groups. members: key, id (total rows), about: id and what pairs reads.

    Groups of up to BLOCK rows are compared at once; an edge leaves for each row at most. Of a larger group, each row meets its own block first.
    Then only the smallest ids of what is joined by then meet each other. Only in groups that are not one component after that, rows
    outside the largest one meet all blocks, and those within it only them. So a large group of near copies is sent once, and what grows with
    the square of a group is what does not belong together."""
    extra = [c for c in about.columns if c != "id"]
    sizes = written(members.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "group-sizes")
    placed = split_join(members, sizes, "key", "members", total).withColumn("blk", _block("members")).join(about, "id").withColumn("component", F.col("id"))
    first = written(_compared(placed.select("key", F.col("blk").alias("x"), F.col("blk").alias("y"), "blk", "id", "component", *extra), pairs), "links-in-blocks")
    large = sizes.where(F.col("members") > BLOCK)
    if large.isEmpty():
        return first.select("a", "b")
    rows = written(split_join(members, large, "key", "members", total).join(about, "id"), "large-groups")
    least = rows.join(first.select("key", F.col("a").alias("id")), ["key", "id"], "left_anti").drop("members")
    counts = written(least.groupBy("key").agg(F.count("*").alias("least")), "large-least")
    meet = split_join(least, counts.where("least > 1"), "key", "least", total).withColumn("blk", _block("least")).withColumn("component", F.col("id"))
    second = written(_compared(_meeting(meet, _blocks("least"), extra), pairs), "links-of-least")
    joined = components(first.unionByName(second).select("a", "b"))
    # a group of which only single rows are left has met already
    # groups of more than BLOCK rows are one in BLOCK of all rows at most; the hot ones are broadcast
    still = split_join(rows.drop("members"), written(large.join(counts.where("least > 1"), "key", "left_semi"), "open-groups"), "key", "members", total).join(joined, F.col("id") == F.col("node"), "left").withColumn("component", F.coalesce("component", "id")).drop("node")
    parts = still.groupBy("key", "component").agg(F.count("*").alias("n_part"))
    largest = parts.groupBy("key").agg(F.max_by("component", F.struct("n_part", "component")).alias("main"), F.max("n_part").alias("inside"), F.sum("n_part").alias("all"))
    largest = written(largest.join(counts.withColumnRenamed("least", "n_least"), "key").where("inside < all AND n_least < all").select("key", "main", "inside", (F.col("all") - F.col("inside")).alias("outside"), "all"), "group-parts")
    open_rows = split_join(still.drop("members"), largest, "key", "all", total)
    main, away = F.col("component") == F.col("main"), _blocks("outside")
    open_rows = open_rows.withColumn("blk", F.when(main, away + _block("inside")).otherwise(_block("outside")).cast("int"))
    third = written(_compared(_meeting(open_rows, F.when(main, away).otherwise(away + _blocks("inside")), extra), pairs), "links-of-rest")
    return first.unionByName(second).unionByName(third).select("a", "b")


def near_duplicates(df: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of df: doc_id, n_shingles, component_id, kept.

    Documents whose sets of k-word shingles have 100 * intersection >= percent * union are linked; the component
    is the smallest id that links reach. Documents with equal sets form a class, of which the one with the
    smallest id goes on. Each of these has BANDS bucket keys. In every bucket, signatures tell which members may be
    similar, and each candidate component gives a star of edges to its smallest id, so edges grow with members and not with their
    square. Documents that stars join are a candidate group; there the full sets of pairs that signatures
    do not rule out are compared, and again only stars of confirmed links leave the task. Small sets meet by the prefixes
    of their sets instead, and are compared in full at once. Buckets and groups are not capped: see links_in_groups.

    Documents without words (also null or empty texts) are linked with nothing. Rows without an id stand alone:
    component_id null, kept true. Rows with the same id are one document, for which the text with the least xxhash64 stands.
    Repeated rows each give a row; an empty table gives an empty one; other columns are not read."""
    src = df.select(df[id_col].cast("long").alias("id"), df[text_col].cast("string").alias("text"), _order(df[text_col]).alias("th"))
    marks = written(src.mapInArrow(lambda it: _marks(it, k), "id long, th long, n long, ha long, hb long, keys array<bigint>, sig binary, small array<bigint>"), "marks")
    same = ["n", "ha", "hb"]
    twice = written(marks.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("rows"), F.min("th").alias("first"), F.max("th").alias("last")).where("first < last").select("id", "first"), "ids-of-several-texts")
    several = not twice.isEmpty()
    standing = marks.join(twice.select("id", F.col("first").alias("th"), F.lit(True).alias("stands")), ["id", "th"], "left").join(twice.select("id", F.lit(True).alias("more")), "id", "left").where("more IS NULL OR stands") if several else marks
    classes = written(standing.where("n > 0 AND id IS NOT NULL").groupBy(*same).agg(F.min("id").alias("rep"), F.count("*").alias("rows")), "classes")
    total = classes.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    reps = standing.join(classes, [*(standing[c] == classes[c] for c in same), standing["id"] == classes["rep"]], "left_semi").groupBy("id").agg(F.min_by(F.struct(*same, "keys", "sig", "small"), F.struct(*same)).alias("r"))
    reps = written(reps.select("id", "r.*"), "reps")
    n_large, n_small = reps.agg(F.count_if(F.col("n") > SMALL), F.count("small")).first()

    about = reps.where(F.col("n") > SMALL).select("id", "n", "sig")
    buckets = reps.select(F.explode("keys").alias("key"), "id")
    candidates = written(links_in_groups(buckets, about, BANDS * n_large, _candidates(percent)).distinct(), "candidates")
    groups = written(components(candidates).select(F.col("component").alias("key"), F.col("node").alias("id")), "groups")
    texts = src.join(groups.select("id").hint("shuffle_hash"), "id", "left_semi")
    sets = texts.mapInArrow(lambda it: _sets(it, k), "id long, n long, ha long, hb long, shingles array<bigint>")
    sets = written(sets.join(reps.select("id", *same), ["id", *same], "left_semi").dropDuplicates(["id"]), "sets")
    links = links_in_groups(groups, about.join(sets.select("id", "shingles"), "id"), n_large, _confirmed(percent, True))

    small = reps.where("small IS NOT NULL").select("id", F.col("small").alias("shingles"))
    often = small.select(F.explode("shingles").alias("s")).groupBy("s").count().where(F.col("count") > max(FREQUENT, n_small // FREQUENT_SHARE))
    # every set has SMALL_MOST shingles at most, so that is SMALL_MOST * FREQUENT_SHARE numbers at most
    frequent = np.array([r["s"] for r in often.collect()], np.int64)
    prefixes = written(small.mapInArrow(lambda it: _prefixes(it, percent, frequent), "key long, id long"), "prefixes")
    links = links.union(links_in_groups(prefixes, small.withColumn("n", F.size("shingles").cast("long")), prefixes.count(), _confirmed(percent, False)))

    joined = components(written(links, "links"))
    of_class = written(classes.join(joined, classes["rep"] == joined["node"], "left").select(*same, "rows", F.coalesce("component", "rep").alias("component")), "components")
    with_words = (F.col("n") > 0) & F.col("id").isNotNull()
    linked = split_join(standing.where(with_words).select("id", *same), of_class, same, "rows", total).select("id", "n", "component")
    rows = linked.unionByName(standing.where(~F.coalesce(with_words, F.lit(False))).select("id", "n", F.col("id").alias("component")))
    if several:  # the other texts of an id are where that is which stands
        other = marks.select("id", "th", "n").join(twice, "id").where(F.col("th") > F.col("first")).select("id", "n")
        rows = rows.unionByName(other.join(rows.groupBy("id").agg(F.min("component").alias("component")), "id"))
    return rows.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.coalesce(F.col("component") == F.col("id"), F.lit(True)).alias("kept"))


def _order(text):
    """Of several texts of one id that with the least number stands."""
    return F.xxhash64(text.cast("string"))


def deduplicated(df: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with the columns of df (which has doc_id and text): the one whose id is the
    component's. Of rows with that id the one stays whose text was compared, of equal texts the one with the least hash of all columns. Rows without an id stay."""
    kept = near_duplicates(df.where(df["doc_id"].isNotNull()), k, percent).where("kept").select(F.col("doc_id").alias("id")).distinct()
    rows = df.select(df["doc_id"].cast("long").alias("id"), _order(df["text"]).alias("th"), row_hash(df).alias("all"), F.struct(*(df[c] for c in df.columns)).alias("row"))
    rows = rows.join(kept.hint("shuffle_hash"), "id", "left_semi")
    first = rows.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy("th", "all"))).where("n = 1").select("row")
    return first.unionByName(df.where(df["doc_id"].isNull()).select(F.struct(*(df[c] for c in df.columns)).alias("row"))).select(*(F.col("row")[c].alias(c) for c in df.columns))
