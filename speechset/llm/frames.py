"""Small helpers that the operators share: session settings, picked columns, Arrow slices."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Text of one numpy pass: 8-byte temporaries for each word stay near a hundred MB.
SLICE_BYTES = 4 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of a session that runs these operators: Arrow batches are bounded in bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores appended until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def texts(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Only the id and the text of each row, as doc_id and text, whatever else the table holds."""
    return df.select(
        quoted(id_col).cast("bigint").alias("doc_id"), quoted(text_col).cast("string").alias("text"), *more
    )


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of ``column``, or a single longer row."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to
    give_back(False)  # a worker goes on to other tasks


def give_back(collect: bool = True) -> None:
    """Return memory that large temporaries of this process held to the system, where its allocators can."""
    import ctypes
    import gc

    if collect:
        gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library
