"""Annotate a corpus with speakers and split it so that no speaker is on both sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechset.constants import SPEAKER_RANGES, TEST_SPEAKERS
from speechset.operators.positions import dense_positions
from speechset.operators.reports import verify_split
from speechset.operators.speakers import annotate_speakers, label_split, smallest_speakers, speaker_sizes


def annotate_corpus(
    df: DataFrame,
    order_by: str,
    ranges: Sequence[tuple] | DataFrame = SPEAKER_RANGES,
    split_column: str = "original_split",
) -> DataFrame:
    """Number the rows of each split and look their speakers up. Carry keys here, not audio."""
    indexed = dense_positions(df, order_by, [split_column], out="original_index")
    return annotate_speakers(indexed, ranges, split_column, "original_index")


def speaker_split(
    df: DataFrame, n: int = TEST_SPEAKERS, speaker: str = "speaker_id", sizes: DataFrame | None = None
) -> DataFrame:
    """Add ``split``: the ``n`` smallest speakers are test. Sizes are counted from the rows, or given."""
    counted = speaker_sizes(df, speaker) if sizes is None else sizes
    tie_break = "map_order" if "map_order" in counted.columns else None
    return label_split(df, smallest_speakers(counted, n, speaker, tie_break), n, speaker)


def speaker_split_report(df: DataFrame, n: int = TEST_SPEAKERS, speaker: str = "speaker_id") -> DataFrame:
    """``split, speaker, n``: since a speaker is wholly in one split, the sizes are labelled instead of
    the rows, and the table is read once."""
    sizes = speaker_sizes(df, speaker)
    labelled = label_split(sizes, smallest_speakers(sizes, n, speaker), n, speaker)
    return labelled.select("split", speaker, F.col("n"))


def check_speaker_split(df: DataFrame, n: int = TEST_SPEAKERS, speaker: str = "speaker_id") -> DataFrame:
    """Split, then verify that the chosen speakers are in test only."""
    chosen = smallest_speakers(speaker_sizes(df, speaker), n, speaker)
    return verify_split(label_split(df, chosen, n, speaker), chosen, speaker)
