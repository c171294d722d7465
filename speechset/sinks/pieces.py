"""Tables stored in pieces of consecutive positions: a piece is a bucket, and the buckets ascend with the positions.

Values that belong to a position, such as paths and errors, are brought to the stored rows: only those are shuffled, and the
rows come in the order of their positions, whatever they carry.
"""

from __future__ import annotations

import contextlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from speechset.sinks.bucketed import buckets_for, store_placed

# The column that a stored row's piece is found by.
PIECE = "_piece"
# A join takes sides that lie by some of its keys as they lie, and a table's buckets are used.
_IN_PLACE = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.sources.bucketing.enabled": "true"}


@dataclass(frozen=True)
class Pieces:
    """``bounds``: the values, ascending, that the second piece and each later one begin with. ``labels`` has for each piece a number
    that Spark puts into the bucket of the piece's rank."""

    bounds: tuple[int, ...]
    labels: tuple[int, ...]

    def of(self, column: Column) -> Column:
        """The label of a value's piece; values below the first bound are in the first piece, and so are nulls."""
        bounds, labels, least = np.array(self.bounds, np.int64), np.array(self.labels, np.int32), np.iinfo(np.int64).min

        def label(values: pa.Array) -> pa.Array:
            return pa.array(labels[np.searchsorted(bounds, values.fill_null(least).to_numpy(zero_copy_only=False), "right")])

        return F.arrow_udf(label, "int")(column.cast("bigint"))

    def place(self, df: DataFrame, column: str = "pos") -> DataFrame:
        """``df`` dealt out by piece, with its label as ``PIECE``."""
        return df.withColumn(PIECE, self.of(F.col(column))).repartition(len(self.labels), PIECE)

    def join(self, rows: DataFrame, values: DataFrame, how: str = "inner", position: str = "pos") -> DataFrame:
        """Stored ``rows`` with the ``values`` of their positions. What is written ``in_place`` has them in order, and only the values
        are shuffled."""
        # Not broadcast, however few: then the rows would be read as files of any order.
        return rows.join(self.place(values, position).hint("merge"), [PIECE, position], how)


@contextlib.contextmanager
def in_place(spark: SparkSession) -> Iterator[None]:
    """Joins that are run inside, by piece and position, leave rows that lie by piece where they are."""
    before = {key: spark.conf.get(key) for key in _IN_PLACE}
    try:
        for key, value in _IN_PLACE.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def pieces_for(spark: SparkSession, positions: int) -> Pieces:
    """Pieces for so many positions, as many as a table with audio needs buckets."""
    n = buckets_for(spark, positions)
    width = max(1, -(-positions // n))
    return Pieces(tuple(range(width, width * n, width)), _labels(spark, n))


def pieces_of_keys(keys: DataFrame, key: str, position: str = "pos") -> tuple[Pieces, Pieces]:
    """The same pieces by position and by key, from a table of integer keys and their positions, which ascend with them. Rows of
    equal keys are in one piece, and rows without a key in the first."""
    n = buckets_for(keys.sparkSession, rows := keys.count())
    width = max(1, -(-rows // n))
    edges = keys.where((F.col(position) > 0) & (F.col(position) % width == 0)).select(key).distinct()
    # A row for each piece at most.
    firsts = keys.join(edges, key).groupBy(key).agg(F.min(position).alias(position)).orderBy(position).collect()
    labels = _labels(keys.sparkSession, n)
    return Pieces(tuple(r[position] for r in firsts), labels), Pieces(tuple(r[key] for r in firsts), labels)


def place_numbered(df: DataFrame, keys: DataFrame, key: str, by_key: Pieces, position: str = "pos") -> DataFrame:
    """``df`` dealt out by the pieces of its keys, with the positions that ``keys`` has for them, one for each row of a repeated key. What
    is written ``in_place`` is shuffled once."""

    def placed(rows: DataFrame, order: str) -> DataFrame:
        return by_key.place(rows, key).withColumn("_nth", F.row_number().over(Window.partitionBy(PIECE, key).orderBy(order)))

    rows = placed(df, key)
    numbers = placed(keys, position).select(position, *[F.col(c).alias(f"_of_{c}") for c in (PIECE, key, "_nth")])
    same = (F.col(PIECE) == F.col(f"_of_{PIECE}")) & F.col(key).eqNullSafe(F.col(f"_of_{key}")) & (F.col("_nth") == F.col("_of__nth"))
    return rows.join(numbers, same).select(*df.columns, position, PIECE)


def _labels(spark: SparkSession, n: int) -> tuple[int, ...]:
    """The smallest number of each of ``n`` buckets, by Spark's own rule. Among ``n * (log n + 20)`` numbers every bucket has one but for a
    chance of e-20; else more are tried."""
    found: dict[int, int] = {}
    tried = math.ceil(n * (math.log(n) + 20))
    while len(found) < n:
        numbers = spark.range(tried).select(F.col("id").cast("int").alias("label"))
        bucket = F.pmod(F.hash("label"), F.lit(n)).alias("bucket")
        found = {row["bucket"]: row["label"] for row in numbers.groupBy(bucket).agg(F.min("label").alias("label")).collect()}
        tried *= 2
    return tuple(found[i] for i in range(n))


def store_in_pieces(df: DataFrame, folder: str, pieces: Pieces, position: str = "pos") -> DataFrame:
    """Store ``df`` as the table in ``folder``; rows that ``Pieces.place`` has dealt out already are not shuffled again."""
    placed = df if PIECE in df.columns else pieces.place(df, position)
    with in_place(df.sparkSession):
        return store_placed(placed, folder, PIECE, len(pieces.labels), compression="zstd")
