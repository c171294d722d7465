"""A seeded sample of the whole corpus, with one clip per sampled row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from speechset.constants import SAMPLE_ROWS, SAMPLE_SEED
from speechset.functions.audio import audio_value, has_samples
from speechset.functions.naming import indexed_clip_name
from speechset.functions.text import column_or, is_empty
from speechset.operators.jobs import synthesize
from speechset.operators.positions import seeded_sample
from speechset.plans.stored_job import export_metadata, input_digest, run_stored
from speechset.session import materialize


def sampled_test_set(
    df: DataFrame,
    open_model: Callable[[], Callable],
    key: str = "_key",
    n: int = SAMPLE_ROWS,
    seed: int = SAMPLE_SEED,
    lang: str = "fr",
) -> DataFrame:
    """``selected_id, original_index, source_text_en, text_<lang>, cloned_voice_<lang>,
    cloned_length_<lang>, clip, error``. The model takes the text. No text gives a blank path, length 0 and no error.
    """
    return _say(_picked(df, key, n, seed, lang), open_model, lang).drop("source_audio_path")


def _picked(df: DataFrame, key: str, n: int, seed: int, lang: str) -> DataFrame:
    text = f"text_{lang}"
    return seeded_sample(df, n, key, seed).select(
        "selected_id",
        column_or(df, "original_index").alias("original_index"),
        column_or(df, "text_en").alias("source_text_en"),
        column_or(df, text).alias(text),
        source_path(df).alias("source_audio_path"),
    )


def source_path(df: DataFrame, column: str = "audio") -> Column:
    """The path that a row's source clip was read from, blank where there is none."""
    if column in df.columns and isinstance(df.schema[column].dataType, StructType) and "path" in df.schema[column].dataType.names:
        return F.coalesce(F.col(column)["path"], F.lit(""))
    return F.coalesce(column_or(df, "source_audio_path").cast("string"), F.lit(""))


def _say(picked: DataFrame, open_model: Callable[[], Callable], lang: str) -> DataFrame:
    text = f"text_{lang}"
    # A sample is one small partition: spread it so that the model runs in parallel.
    spread = picked.repartition("selected_id").withColumn("error", F.when(is_empty(F.col(text)), "no text").otherwise(""))
    made = synthesize(spread, open_model, [text])
    clip = audio_value(F.col("out_array"), F.col("out_rate"))
    path = F.concat(F.lit(f"cloned_audio_{lang}_test/"), indexed_clip_name(F.col("selected_id"), F.lit(lang)))
    kept = [c for c in ("input_id",) if c in picked.columns]
    return made.select(
        "selected_id", "original_index", "source_text_en", text, "source_audio_path",
        F.when(has_samples(clip), path).otherwise("").alias(f"cloned_voice_{lang}"),
        F.when(has_samples(clip), F.size("out_array")).otherwise(0).cast("bigint").alias(f"cloned_length_{lang}"),
        clip.alias("clip"),
        F.when(is_empty(F.col(text)), "").otherwise(F.col("error")).alias("error"),
        *kept,
    )


def build_test_set(
    df: DataFrame,
    open_model: Callable[[], Callable],
    folder: str,
    key: str = "_key",
    n: int = SAMPLE_ROWS,
    seed: int = SAMPLE_SEED,
    lang: str = "fr",
) -> DataFrame:
    """``sampled_test_set`` with ``source_audio_path``, stored in ``folder`` with its clips and with the metadata files
    ``metadata_<lang>_test.csv`` and ``.json``. Rows that are finished from the same text are not made again."""
    picked = _picked(df, key, n, seed, lang)
    work = materialize(picked.withColumn("input_id", input_digest(F.col("original_index"), F.col(f"text_{lang}"))), "sample")
    rows = run_stored(work, ["selected_id"], lambda todo: _say(todo, open_model, lang), folder)
    export_metadata(rows.drop("clip"), folder, f"metadata_{lang}_test", ["selected_id"])
    return rows
