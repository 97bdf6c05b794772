"""Results kept by all inputs that they depend on."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def remembered(spark: SparkSession, folder: str, inputs: dict, compute: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """The rows of compute, written once to folder for each set of inputs (what JSON can say) and read from there after.

    A hit needs the stored inputs to be equal, not their hash alone. The note of what is stored is written after the rows, so
    a run that broke off is no hit; force computes anew, and rows that others are reading stay."""
    text = json.dumps(inputs, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
    note = f"{folder}/{hashlib.sha256(text.encode()).hexdigest()}/note"
    if not force:
        try:
            stored = spark.read.parquet(note).first()
        except AnalysisException:
            stored = None
        if stored and stored["inputs"] == text:
            return spark.read.parquet(stored["rows"])
    rows = f"{note.removesuffix('/note')}/rows-{uuid.uuid4().hex}"
    compute().write.parquet(rows)
    spark.createDataFrame([(text, rows)], "inputs string, rows string").coalesce(1).write.mode("overwrite").parquet(note)
    return spark.read.parquet(rows)
