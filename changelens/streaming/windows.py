"""Incremental runs: a stream of change records without repeats, and a watermark that only moves after success."""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState


def changes(spark: SparkSession, path: str, schema, key: str, ts: str, late: str = "1 day") -> DataFrame:
    """A stream of the files at path, in which a key that comes again within the allowed lateness is dropped."""
    return spark.readStream.schema(schema).parquet(path).withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def run_available(stream: DataFrame, state: str, each: Callable[[DataFrame, int], None]) -> None:
    """Runs all that is there now through each(batch, number); a batch counts as done only when each returns."""
    stream.writeStream.trigger(availableNow=True).option("checkpointLocation", state).foreachBatch(each).start().awaitTermination()


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a new file; False if there is one already. Of several writers one succeeds: a local file appears whole under its name by a hard link, other file systems
    create without overwriting."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getScheme() == "file":
        name = target.toUri().getPath()
        os.makedirs(os.path.dirname(name), exist_ok=True)
        own = f"{os.path.dirname(name)}/.{uuid.uuid4().hex}"
        with open(own, "x") as f:
            f.write(text)
        try:
            os.link(own, name)
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
        return True
    try:
        out = fs.create(target, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in str(e.java_exception):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def watermark(spark: SparkSession, path: str) -> tuple[int, dt.datetime | None]:
    """(version, cutoff) of the stored watermark: the version's file with the largest number; (0, None) for none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(target)] if fs.exists(target) else []
    last = max((n for n in names if n.isdigit()), default=None)
    if last is None:
        return 0, None
    text = spark.read.text(f"{path}/{last}", wholetext=True).first()
    return int(last), dt.datetime.fromisoformat(text[0]) if text and text[0] else None


def advance(spark: SparkSession, path: str, start: dt.datetime | None, end: dt.datetime, gates: list[bool]) -> bool:
    """Moves the stored watermark from start to end if all gates passed and it still is start (None: there is none yet).

    A log of versions, one file each: the next version is created only where no file has its number, so of runs that read the same version one alone
    advances, and the others get False. A version that another run is just writing counts as moved."""
    if not all(gates):
        return False
    version, now = watermark(spark, path)
    if now != start:
        return False
    return _create(spark, f"{path}/{version + 1:012d}", end.isoformat())


def corrected(stream: DataFrame, key: str, version: str, ts: str, start: dt.datetime, end: dt.datetime, late: str = "7 days") -> DataFrame:
    """A stream of records that come late, again, in any order and corrected, as changes: the columns of the stream and sign, 1 for a row that counts from now on and -1 for
    one that no longer does.

    Of each key the row with the largest version counts (of one version the first that came), if its time is in the half-open window; so a correction takes back the row before it, also where it moves it
    out of the window. The sum of signs by row is what a batch over all rows gives. Each key's last row is kept as state, until the watermark is later than its time by as much as late;
    what comes after that is a record of its own. Rows without a key, a version or a time are left out."""
    fields = [f.name for f in stream.schema.fields]
    k, v, t = fields.index(key), fields.index(version), fields.index(ts)
    schema = T.StructType([*stream.schema.fields, T.StructField("sign", T.IntegerType())])
    wait = int(pd.Timedelta(late).total_seconds() * 1000)

    def change(_, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = was = tuple(state.get) if state.exists else None
        for batch in batches:
            for row in batch.astype(object).where(batch.notna(), None).itertuples(index=False, name=None):
                row = tuple(x.to_pydatetime() if isinstance(x, pd.Timestamp) else x for x in row)
                if held is None or row[v] > held[v]:
                    held = row
        counts = lambda row: row is not None and start <= row[t] < end
        out = [(*was, -1)] if counts(was) and held != was else []
        out += [(*held, 1)] if counts(held) and held != was else []
        state.update(held)
        state.setTimeoutTimestamp(max(int(pd.Timestamp(held[t]).timestamp() * 1000), state.getCurrentWatermarkMs()) + wait)
        if out:
            yield pd.DataFrame(out, columns=schema.names)

    known = stream.where(F.col(key).isNotNull() & F.col(version).isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, late)
    return known.groupBy(key).applyInPandasWithState(change, schema, stream.schema, "append", "EventTimeTimeout")
