"""A synthetic set: every voice says the first sentences of every language."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechset.constants import LANGUAGE_NAMES, SENTENCES_PER_LANGUAGE, VOICE_IDS
from speechset.functions.audio import audio_value
from speechset.operators.jobs import synthesize
from speechset.operators.languages import first_sentences, languages_without_text, require_known, voice_grid
from speechset.plans.stored_job import export_metadata, input_digest, keep_warnings, run_stored
from speechset.session import materialize


def speaker_language_grid(
    catalogue: DataFrame,
    langs: Sequence[str],
    open_model: Callable[[], Callable],
    voices: Sequence[str] = tuple(VOICE_IDS),
    n: int = SENTENCES_PER_LANGUAGE,
    known_voices: Sequence[str] = tuple(VOICE_IDS),
) -> DataFrame:
    """``speaker, language, language_name, text, audio_path, audio_length_samples, sample_index, clip, error``.

    ``catalogue`` has ``lang, sample_index, text``. The model takes (text, language, voice). A
    combination whose call fails keeps its row, with the error.
    """
    return _say(_grid(catalogue, langs, voices, n, known_voices), open_model)


def _grid(catalogue: DataFrame, langs: Sequence[str], voices: Sequence[str], n: int, known_voices: Sequence[str]) -> DataFrame:
    require_known(langs, list(LANGUAGE_NAMES))
    require_known(voices, known_voices, "voices")
    sentences = first_sentences(catalogue.withColumnRenamed("sample_index", "_order"), langs, n, "_order").drop("_order")
    # A few sentences per language fit one partition: spread them so that the model runs in parallel.
    return voice_grid(sentences, voices, LANGUAGE_NAMES).repartition("lang", "sample_index", "speaker")


def _say(grid: DataFrame, open_model: Callable[[], Callable]) -> DataFrame:
    made = synthesize(grid, open_model, ["text", "lang", "speaker"])
    return made.select(
        "speaker",
        F.col("lang").alias("language"),
        "language_name",
        "text",
        "audio_path",
        F.coalesce(F.when(F.col("out_array").isNotNull(), F.size("out_array")), F.lit(0)).cast("bigint").alias(
            "audio_length_samples"
        ),
        "sample_index",
        audio_value(F.col("out_array"), F.col("out_rate")).alias("clip"),
        "error",
        *[c for c in ("input_id",) if c in grid.columns],
    )


def build_grid(
    catalogue: DataFrame,
    langs: Sequence[str],
    open_model: Callable[[], Callable],
    folder: str,
    voices: Sequence[str] = tuple(VOICE_IDS),
    n: int = SENTENCES_PER_LANGUAGE,
    known_voices: Sequence[str] = tuple(VOICE_IDS),
) -> DataFrame:
    """``speaker_language_grid`` stored in ``folder`` with its clips and with ``metadata.csv`` and ``.json`` of the clips that
    were made. A language without sentences is a row of ``folder/warnings/grid``. What is finished is not made again."""
    spark = catalogue.sparkSession
    empty = [r["lang"] for r in languages_without_text(catalogue, langs).orderBy("lang").collect()]  # at most those asked for
    keep_warnings(spark, folder, "grid", [f"no texts available for language {lang}" for lang in empty])
    grid = _grid(catalogue, langs, voices, n, known_voices)
    work = grid.withColumns({"input_id": input_digest(F.col("text")), "language": F.col("lang")})
    work = materialize(work, "grid")
    rows = run_stored(work, ["speaker", "language", "sample_index"], lambda todo: _say(todo.drop("language"), open_model), folder)
    made = rows.where(F.col("error") == "").drop("clip", "error")
    export_metadata(made, folder, "metadata", ["speaker", "language", "sample_index"])
    return rows
