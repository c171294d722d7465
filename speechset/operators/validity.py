"""Input checks: audio first, then text; one error per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechset.constants import ERROR_NO_AUDIO, ERROR_NO_TEXT
from speechset.functions.audio import has_samples
from speechset.functions.text import is_blank


def input_error(audio: Column, text: Column, no_text: str = ERROR_NO_TEXT) -> Column:
    return (
        F.when(~has_samples(audio), F.lit(ERROR_NO_AUDIO))
        .when(is_blank(text), F.lit(no_text))
        .otherwise(F.lit(""))
    )


def mark_errors(df: DataFrame, audio: str = "audio", text: str = "text_fr") -> DataFrame:
    """Add ``error``: blank for a usable row. No row is removed."""
    return df.withColumn("error", input_error(F.col(audio), F.col(text)))
