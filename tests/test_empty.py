"""Every query of the library over tables without rows: its columns, no error, and whole tables of counts where it counts."""

import os

import pytest

from changelens import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for f in os.listdir(SF):
        spark.read.parquet(f"{SF}/{f}").limit(0).write.parquet(f"{folder}/{f}")
    return str(folder)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_rows(spark, empty, name):
    df = registry.QUERIES[name](spark, empty)
    rows = df.collect()
    assert df.columns and len(rows) <= 6 and all(set(r.asDict()) == set(df.columns) for r in rows)


def test_dashboards_are_zero(spark, empty):
    r = registry.QUERIES["a3_dashboard"](spark, empty).first()
    assert (r["total"], r["open"], r["urgent"], r["closure"]) == (0, 0, 0, 1.0)
