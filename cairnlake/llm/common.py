"""Small helpers that the operators of this package share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

if TYPE_CHECKING:
    import pyarrow as pa

#: Text that a Python worker turns into strings at once.
SLICE_BYTES = 2_000_000
#: The tables saved in the innermost scratch() of the running context; None outside any.
_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors see: spark.checkpoint.dir.

    Where the setting is missing on one machine (tests), a temporary folder is made once, set
    as checkpoint folder, and removed when Python ends. On a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    place = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not place:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            place = current.get()
        elif sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        else:
            place = "file://" + tempfile.mkdtemp(prefix="cairnlake-")
            atexit.register(shutil.rmtree, place[7:], ignore_errors=True)
            sc.setCheckpointDir(place)
    return place.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/cairnlake/{name}-{uuid.uuid4().hex}"


def saved_at(df: DataFrame, name: str, parts: int | None = None) -> tuple[DataFrame, str]:
    """df as a Parquet table in the shared folder, and the table's folder: cuts the lineage, outlives lost executors.

    parts: at most so many files, for tables much smaller than the shuffle that makes them.
    """
    path = fresh_path(df.sparkSession, name)
    (df.coalesce(parts) if parts else df).write.parquet(path)
    if (own := _owned.get()) is not None:
        own.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def saved(df: DataFrame, name: str, parts: int | None = None) -> DataFrame:
    return saved_at(df, name, parts)[0]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Within it, tables that operators save belong to it, and they are dropped at its end: write results before. Tables of other callers stay.

    Outside any scratch() saved tables stay in the shared folder, as results read them whenever they are run.
    """
    own: list[str] = []
    before = _owned.set(own)
    try:
        yield own
    finally:
        _owned.reset(before)
        drop_saved(spark, own)


def drop_saved(spark: SparkSession, paths: list[str]) -> None:
    """Deletes these saved tables."""
    hadoop, own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, _owned.get()
    for path in list(paths):
        place = hadoop(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        if own and path in own:
            own.remove(path)


def slices(batch: pa.RecordBatch, column: int = -1, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in turn, in runs of rows whose column (of strings or bytes, without nulls) holds at most so many bytes; a longer value comes alone."""
    import numpy as np
    import pyarrow.compute as pc

    at = column % batch.num_columns
    ends = np.cumsum(pc.binary_length(batch.column(at)).to_numpy(zero_copy_only=False)) if batch.num_rows else []
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + most, "right")))
        yield batch.slice(row, end - row)
        row = end


def text_of(col: str) -> Column:
    """The text column as string, null as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def crc_part(id_col: str, parts: int) -> Column:
    """crc32 of the id written as text, modulo parts."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts
