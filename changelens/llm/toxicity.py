"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

#: Hashed features. The weights that are broadcast have this many entries at most (4 bytes each).
FEATURES = 1 << 20
#: Labelled rows that a model is fitted on at most (in expectation); with fewer, all are taken.
SAMPLE_ROWS = 20_000
#: Rows of the sample that one task fits, rounds of fitting and averaging, and passes of a task over its rows.
SHARD_ROWS, ROUNDS, PASSES = 3_334, 2, 6
#: Coordinates whose states are averaged together.
BLOCK = 1 << 14
ALPHA, BETA, L1, L2 = 2.0, 1.0, 5.0, 0.1
#: Of a document's text, features are gathered for so many words at once.
WINDOW_WORDS = 200_000
REMEMBERED, LONGEST = 300_000, 64

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


class Features:
    """Feature numbers of a text: its words, pairs of neighbours, and pairs with one word between."""

    def __init__(self, size: int):
        import re

        import xxhash

        words, most, number = re.compile(r"[^\W_]+").findall, REMEMBERED, xxhash.xxh64_intdigest

        class Known(dict):
            def __missing__(self, word):
                found = number(word)
                if len(word) <= LONGEST:
                    if len(self) >= most:
                        self.clear()
                    self[word] = found
                return found

        self.words, self.known, self.size = words, Known(), np.uint64(size)

    def of(self, text: str | None) -> Iterator[np.ndarray]:
        found = self.words(text.lower()) if text else []
        for at in range(0, len(found), WINDOW_WORDS):
            part = found[max(0, at - 2) : at + WINDOW_WORDS]
            h = np.fromiter(map(self.known.__getitem__, part), np.uint64, len(part))
            with np.errstate(over="ignore"):
                raw = np.concatenate([h, h[:-1] * _A + h[1:] * _B, h[:-2] * _A + h[2:] * _C])
                yield ((raw ^ (raw >> np.uint64(31))) * _A >> np.uint64(32)) % self.size

    def distinct(self, text: str | None) -> np.ndarray:
        parts = [*self.of(text)]
        return np.unique(np.concatenate(parts)).astype(np.int64) if parts else np.zeros(0, np.int64)


class Ftrl:
    """FTRL-proximal (McMahan et al. 2013): a rate for each coordinate, and weights of zero within the L1 bound.
    The last coordinate is the constant."""

    def __init__(self, z: np.ndarray, n: np.ndarray):
        self.z, self.n = z, n

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.full(len(z), L1)
        l1[-1] = 0.0
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, y: int) -> None:
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -30, 30))) - y
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - step * w
        self.n[at] += g * g


def _packed(block: int, at: np.ndarray, z: np.ndarray, n: np.ndarray) -> tuple:
    return block, at.astype("<i4").tobytes(), z.astype("<f4").tobytes(), n.astype("<f4").tobytes()


def _unpacked(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(b"".join(rows[c]), kind) for c, kind in (("at", "<i4"), ("z", "<f4"), ("n", "<f4")))


def fit(texts: DataFrame, size: int = FEATURES) -> tuple[np.ndarray, np.ndarray, float] | None:
    """The model: feature numbers with a weight, their weights, and the constant. texts: doc_id, text, y.

    The sample is cut into parts of about SHARD_ROWS, each a partition of its own and learned by one task. Of a coordinate that rows of a part touch, the
    task gives its whole state (z and n), and Spark averages them over the parts that saw it, a block of coordinates at a time; the next round begins
    from there. With one part that is plain FTRL. What comes to the driver is 12 bytes for each feature at most, in size / BLOCK rows,
    whatever the number of documents. None if there is nothing to learn from."""
    spark = texts.sparkSession
    sample = written(texts.select("doc_id", "text", "y"), "toxic-sample")
    parts = max(1, round(sample.count() / SHARD_ROWS))
    part = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(parts)).cast("int")
    dealt = sample.select(part.alias("part"), F.xxhash64("doc_id", F.lit(5)).alias("turn"), "text", "y").repartitionById(parts, "part")
    state = None
    for k in range(ROUNDS):
        start = spark.sparkContext.broadcast(state)

        def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            rows = pd.concat([*batches] or [pd.DataFrame()])  # of one part
            if not len(rows):
                return
            features, model, touched = Features(size), Ftrl(np.zeros(size + 1), np.zeros(size + 1)), np.zeros(size + 1, bool)
            if start.value is not None:
                at, z, n = start.value
                model.z[at], model.n[at] = z, n
            seen = []
            for t, y in rows.sort_values(["turn", "y", "text"])[["text", "y"]].itertuples(index=False):
                at = np.append(features.distinct(t), size).astype(np.int32)
                touched[at] = True
                seen.append((at, int(y)))
            for _ in range(PASSES):
                for at, y in seen:
                    model.learn(at, y)
            at = np.flatnonzero(touched).astype(np.int32)
            yield pd.DataFrame([_packed(int(some[0]) // BLOCK, some, model.z[some], model.n[some]) for some in np.split(at, np.flatnonzero(np.diff(at // BLOCK)) + 1)], columns=["block", "at", "z", "n"])

        last = k == ROUNDS - 1

        def average(group: pd.DataFrame) -> pd.DataFrame:
            at, z, n = _unpacked(group)
            known, place, times = np.unique(at, return_inverse=True, return_counts=True)
            z, n = np.bincount(place, z) / times, np.bincount(place, n) / times
            keep = (np.abs(z) > L1) | (known == size) if last else times > 0  # no other coordinate has a weight in the end
            return pd.DataFrame([_packed(int(group["block"].iloc[0]), known[keep], z[keep], n[keep])], columns=["block", "at", "z", "n"])

        packed = "block int, at binary, z binary, n binary"
        rows = dealt.mapInPandas(learn, packed).groupBy("block").applyInPandas(average, packed).toPandas()
        start.unpersist()
        if not len(rows):
            return None
        state = _unpacked(rows)
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    z[state[0]], n[state[0]] = state[1], state[2]
    w = Ftrl(z, n).weights(np.arange(size + 1))
    at = np.flatnonzero(w[:-1])
    return at, w[at].astype(np.float32), float(w[-1])


def held_out(doc_id) -> F.Column:
    """Rows that are never learned from: crc32 of the id as text has the remainder 2 by 4."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_rows(df: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, y of the labelled rows to learn from: at most about SAMPLE_ROWS, by a hash of the id; rows held out, without an id
    or without a label are not among them. A document labelled twice counts by its largest label."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("y"))
    known = known.where(~held_out(F.col("doc_id")))
    rows = known.count()
    if rows > SAMPLE_ROWS:
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) < int((1 << 30) * SAMPLE_ROWS / rows))
    # a broadcast of SAMPLE_ROWS rows of 12 bytes, whatever the size of the tables
    return df.select("doc_id", "text").join(F.broadcast(known), "doc_id")


def score(df: DataFrame, model, text_col: str = "text", name: str = "score", size: int = FEATURES) -> DataFrame:
    """df with the score, 0 to 1, of each whole text; columns of df stay as they are. A null text is an empty
    one and has the constant's score; without a model the score is 0."""
    if model is None:
        return df.withColumn(name, F.lit(0.0))
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at, w, constant = held.value
        table = np.zeros(size, np.float32)
        table[at] = w
        features = Features(size)
        for texts in batches:
            out = []
            for t in texts:
                seen = [h[table[h] != 0] for h in (p.astype(np.int64) for p in features.of(t))]
                s = constant + (float(table[np.unique(np.concatenate(seen))].sum(dtype=np.float64)) if seen else 0.0)
                out.append(1.0 / (1.0 + np.exp(-min(30.0, max(-30.0, s)))))
            yield pd.Series(out, dtype="float64")

    return df.withColumn(name, scored(df[text_col]))


def toxic_scores(df: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """A row for each row of df: doc_id, held_out, score, predicted. Only the text is an input of the score.
    Null ids are not held out; repeated rows each give a row; empty tables give an empty table, and scores of
    0 where only labels are missing."""
    scored = score(df.select("doc_id", "text"), fit(training_rows(df, labels)))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(df: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of df that are not toxic, with their columns."""
    scored = score(df, fit(training_rows(df, labels)), name="__score")
    return scored.where(F.col("__score") < threshold).select(*df.columns)
