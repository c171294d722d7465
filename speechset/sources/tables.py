"""Reading utterance tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechset.operators.shape import SourceProfile


def load_split(spark: SparkSession, root: str, split: str, column: str = "split") -> DataFrame:
    """One split of a dataset partitioned by ``column``: only its folders are read."""
    return spark.read.parquet(root).where(F.col(column) == split)


def load_splits(
    spark: SparkSession,
    root: str,
    splits: Sequence[str] | None = None,
    profile: SourceProfile | None = None,
    column: str = "split",
) -> DataFrame:
    """Several splits; the profile's default split if none are named."""
    wanted = list(splits) if splits else [profile.default_split]
    return spark.read.parquet(root).where(F.col(column).isin(*wanted))


def peek(df: DataFrame, order_by: str) -> DataFrame:
    """The first row in dataset order."""
    return df.orderBy(order_by).limit(1)


def schema_profile(df: DataFrame) -> DataFrame:
    """``column_name, data_type, n_values`` of every column; all columns are counted in one pass."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f.name).alias("n_values"),
        )
        for f in df.schema
    ]
    return counts.select(F.inline(F.array(*rows)))
