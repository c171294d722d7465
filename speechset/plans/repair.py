"""Bring the metadata of old runs to the current layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechset.functions.naming import indexed_source_name
from speechset.operators.positions import dense_positions
from speechset.operators.shape import canonical_metadata, put_first, pair_order


def join_by_position(
    left: DataFrame, right: DataFrame, left_order: str, right_order: str, out: str = "pos", how: str = "inner"
) -> DataFrame:
    """The n-th row of one table with the n-th row of the other. Both are numbered first; after that
    it is an equi join on a unique key."""
    numbered_left = dense_positions(left, left_order, out=out)
    numbered_right = dense_positions(right, right_order, out=out)
    return numbered_left.join(numbered_right, out, how)


def repair_metadata(
    metadata: DataFrame, sources: DataFrame, metadata_order: str, source_order: str,
    langs: Sequence[str] = ("en", "ar", "fr"), source_lang: str = "en",
) -> DataFrame:
    """Old metadata in canonical order, with the relative path of its n-th source clip as
    ``voice_<source_lang>`` and the source key columns. Rows without a source row keep a blank path."""
    flagged = sources.withColumn("_has_source", F.lit(True))
    joined = join_by_position(metadata, flagged, metadata_order, source_order, "pos", "left")
    path = F.concat_ws("/", F.lit("cloned_audio"), F.lit(source_lang), indexed_source_name(F.col("pos")))
    voice = F.when(F.col("_has_source"), path).otherwise("")
    fixed = canonical_metadata(joined, langs).withColumn(f"voice_{source_lang}", voice).drop("_has_source")
    return put_first(fixed, pair_order(langs))
