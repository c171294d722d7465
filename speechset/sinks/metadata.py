"""Writing metadata files."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame

from speechset.session import file_system, new_folder

# Quoted line breaks keep a CSV file from being split between tasks, so files are kept moderate.
RECORDS_PER_FILE = 500_000
# Most files that are read one by one to keep their order; a table of more is sorted again.
ORDERED_FILES = 1_000


def write_metadata_csv(df: DataFrame, path: str, order_by: Sequence[str] = ()) -> None:
    """CSV part files; with ``order_by`` the rows ascend through the files in name order."""
    ordered = df.orderBy(*order_by) if order_by else df
    (
        ordered.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .csv(path)
    )


def write_metadata_json(df: DataFrame, path: str, order_by: Sequence[str] = ()) -> None:
    """JSON Lines in UTF-8, nulls kept."""
    ordered = df.orderBy(*order_by) if order_by else df
    (
        ordered.write.mode("overwrite")
        .option("ignoreNullFields", False)
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .json(path)
    )


def store_in_order(df: DataFrame, path: str, order_by: Sequence[str]) -> DataFrame:
    """Write ``df`` to ``path`` in order and give the same rows so that they come in order without another sort."""
    spark = df.sparkSession
    df.orderBy(*order_by).write.option("compression", "zstd").parquet(path)
    store, place = file_system(path)
    files = sorted(name for name in (status.getPath().toString() for status in store.listStatus(place)) if name.endswith(".parquet"))
    read = spark.read.schema(df.schema)
    if not 0 < len(files) <= ORDERED_FILES:
        return read.parquet(path).orderBy(*order_by)
    # Spark packs the files of one scan by size; scans of a file each keep their order.
    return functools.reduce(DataFrame.unionAll, [read.parquet(name) for name in files])


def write_metadata(df: DataFrame, folder: str, name: str, order_by: Sequence[str], path: str | None = None) -> None:
    """``<name>.csv`` and ``<name>.json`` in ``folder``, both from one sorted table, kept at ``path``: the rows are
    made and shuffled once."""
    ordered = store_in_order(df, path or new_folder(df.sparkSession, name), order_by)
    write_metadata_csv(ordered, f"{folder}/{name}.csv")
    write_metadata_json(ordered, f"{folder}/{name}.json")
