"""Tables stored in buckets of a key: joins by the key, and groups of it, need no shuffle between them.

A table lives in a folder of its own. ``layout`` below it says how it is stored, and is written last: a folder
without one holds no table. Any session can open it; the name it gets in the session's catalogue is made from
its place.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from speechset.session import file_system, qualified, small_table

# Rows of a bucket that carries audio, and the most buckets that Spark takes.
BUCKET_ROWS = 2_000
MAX_BUCKETS = 100_000

_LAYOUT = "place string, key string, buckets int, partitions array<string>, columns string"


@dataclass(frozen=True)
class Layout:
    place: str
    key: str
    buckets: int
    partitions: tuple[str, ...]
    columns: str

    @property
    def name(self) -> str:
        return f"speechset_{hashlib.md5(self.place.encode()).hexdigest()}"


def buckets_for(spark: SparkSession, rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """As many buckets as the rows need, and as the cluster has cores."""
    return min(MAX_BUCKETS, max(spark.sparkContext.defaultParallelism, -(-rows // bucket_rows)))


def read_layout(spark: SparkSession, folder: str) -> Layout | None:
    """How the table in ``folder`` is stored; None if there is none."""
    try:
        rows = spark.read.schema(_LAYOUT).json(f"{folder}/layout").collect()  # one row
    except PySparkException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if not rows:
        return None
    row = rows[0]
    return Layout(row["place"], row["key"], row["buckets"], tuple(row["partitions"]), row["columns"])


def _register(spark: SparkSession, layout: Layout, compression: str | None = None) -> str:
    """The table's name in the catalogue, with all partitions that exist by now. ``compression`` is that of what this session writes."""
    if not spark.catalog.tableExists(layout.name):
        store, path = file_system(layout.place)
        store.mkdirs(path)  # a table without rows yet
        parts = ", ".join(f"`{c}`" for c in layout.partitions)
        spark.sql(
            f"CREATE TABLE {layout.name} ({layout.columns}) USING parquet "
            + (f"OPTIONS (compression '{compression}') " if compression else "")
            + (f"PARTITIONED BY ({parts}) " if parts else "")
            + f"CLUSTERED BY (`{layout.key}`) INTO {layout.buckets} BUCKETS LOCATION '{layout.place}'"
        )
    if layout.partitions:
        spark.catalog.recoverPartitions(layout.name)
    spark.catalog.refreshTable(layout.name)
    return layout.name


def _layout_of(spark: SparkSession, folder: str, schema: StructType, key: str, buckets: int, partitions: Sequence[str]) -> Layout:
    # Partition columns come last, as Spark wants them.
    ordered = StructType([f for f in schema if f.name not in partitions] + [schema[p] for p in partitions])
    return Layout(qualified(f"{folder}/data-{uuid.uuid4().hex}"), key, buckets, tuple(partitions), ordered.toDDL())


def _publish_layout(spark: SparkSession, folder: str, layout: Layout) -> None:
    row = (layout.place, layout.key, layout.buckets, list(layout.partitions), layout.columns)
    small_table(spark, [row], _LAYOUT).coalesce(1).write.mode("overwrite").json(f"{folder}/layout")


def create_bucketed(
    spark: SparkSession, folder: str, schema: StructType, key: str, buckets: int, partitions: Sequence[str] = ()
) -> None:
    """An empty table that rows can be appended to; nothing happens if there is one."""
    if read_layout(spark, folder) is None:
        layout = _layout_of(spark, folder, schema, key, buckets, partitions)
        _publish_layout(spark, folder, layout)


def _insert(df: DataFrame, layout: Layout, compression: str | None = None) -> None:
    name = _register(df.sparkSession, layout, compression)
    order = StructType.fromDDL(layout.columns).names
    df.select(*[f"`{c}`" for c in order]).write.insertInto(name)


def append_bucketed(df: DataFrame, folder: str) -> None:
    """Add rows; they appear together when Spark commits the write, or not at all."""
    layout = read_layout(df.sparkSession, folder)
    if layout is None:
        raise FileNotFoundError(f"no bucketed table in {folder}")
    _insert(df, layout)


def store_bucketed(
    df: DataFrame, folder: str, key: str, buckets: int | None = None, partitions: Sequence[str] = (), bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Store ``df`` as the table in ``folder``, in place of an earlier one, with one shuffle so that each task writes one
    bucket. Readers see the earlier table until the new one is whole."""
    buckets = buckets or buckets_for(df.sparkSession, df.count(), bucket_rows)
    return store_placed(df.repartition(buckets, key), folder, key, buckets, partitions)


def store_placed(
    df: DataFrame, folder: str, key: str, buckets: int, partitions: Sequence[str] = (), compression: str | None = None
) -> DataFrame:
    """``store_bucketed`` for rows that are dealt out by ``key`` over ``buckets`` partitions already."""
    spark = df.sparkSession
    layout = _layout_of(spark, folder, df.schema, key, buckets, partitions)
    _insert(df, layout, compression)
    _publish_layout(spark, folder, layout)
    return read_bucketed(spark, folder)


def read_bucketed(spark: SparkSession, folder: str) -> DataFrame | None:
    """The table in ``folder``, partitioned by its key; None if there is none."""
    layout = read_layout(spark, folder)
    return spark.table(_register(spark, layout)) if layout else None
