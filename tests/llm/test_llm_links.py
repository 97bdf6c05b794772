"""Links of vectors and of documents that are planted, against all pairs."""

import numpy as np
import pandas as pd
import pytest

from changelens.llm import vectors


def planted(rng, rows, pairs, hub, dim=64):
    """Random unit vectors; pairs with cosines from 0.9 to 0.95, drawn toward 0.9; a hub of vectors around one."""
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    base = unit(rng.standard_normal((rows, dim)))

    def near(x, cosine):
        u = rng.standard_normal(x.shape)
        u = unit(u - (u * x).sum(1, keepdims=True) * x)
        return cosine[:, None] * x + np.sqrt(1 - cosine**2)[:, None] * u

    close = near(base[:pairs], 0.9 + 0.05 * rng.random(pairs) ** 3 + 1e-12)
    around = near(np.repeat(base[-1:], hub, 0), 0.93 + 0.05 * rng.random(hub))
    return np.concatenate([base, close, around])


@pytest.mark.parametrize(("bucket", "hashes"), [(512, 1), (4, 2)])
def test_planted_links(spark, monkeypatch, bucket, hashes):
    monkeypatch.setattr(vectors, "BUCKET_ROWS", bucket)
    v = planted(np.random.default_rng(bucket), 16_000, 3_000, 1_500)
    assert vectors.settings(len(v), 64, 0.9)[1] == hashes
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    truth = np.zeros(len(v), np.int64)
    for at in range(0, len(v), 2000):
        truth[at : at + 2000] = (unit[at : at + 2000] @ unit.T >= 0.9).sum(1) - 1
    assert truth.sum() > 200_000 and (truth > 0).sum() > 7_000
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(v)), "embedding": v.tolist()}), "vec_id long, embedding array<double>").repartition(4)
    got = vectors.near_vectors(df, 0.9).toPandas().sort_values("vec_id")["n_links"].to_numpy()
    assert len(got) == len(v) and (got <= truth).all()
    pairs = np.r_[0:3_000, 16_000:19_000]
    assert got.sum() >= 0.999 * truth.sum() and got[pairs].sum() >= 0.998 * truth[pairs].sum(), (got.sum() / truth.sum(), got[pairs].sum() / truth[pairs].sum())
