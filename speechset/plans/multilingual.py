"""Clips of every row in several target languages."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechset.constants import ERROR_NO_AUDIO, PROMPT_SECONDS, PROMPT_TOKEN_LIMIT
from speechset.functions.audio import AUDIO_TYPE, audio_value, has_samples, resample_audio
from speechset.functions.naming import indexed_clip_name, indexed_source_name
from speechset.functions.text import is_empty
from speechset.functions.tokens import clone_prompt, format_codes
from speechset.operators.jobs import encode_references, spread, synthesize
from speechset.operators.languages import collapse_languages, expand_languages, language_coverage, language_warnings, require_known
from speechset.operators.shape import SourceProfile, put_first, pair_order, select_profile
from speechset.plans.stored_job import input_digest, keep_results, keep_warnings, left_to_do, results_of, stored_results
from speechset.session import materialize, new_folder
from speechset.sinks.audio_files import require_written, write_audio_files
from speechset.sinks.metadata import write_metadata_csv, write_metadata_json
from speechset.sinks.pieces import PIECE, Pieces, in_place, pieces_for, store_in_pieces


@dataclass(frozen=True)
class MultilingualClips:
    metadata: DataFrame
    clips: DataFrame
    coverage: DataFrame
    warnings: list[str] = field(default_factory=list)


def clone_rows(
    df: DataFrame,
    langs: Sequence[str],
    open_encoder: Callable[[], Callable],
    open_model: Callable[[], Callable],
    encoder_rate: int | None = None,
    tasks: int | None = None,
    folder: str | None = None,
    count_tokens: Callable[[Column], Column] | None = None,
    token_limit: int = PROMPT_TOKEN_LIMIT,
    pieces: Pieces | None = None,
) -> DataFrame:
    """One row per (position, language): ``pos, lang, text, path, clip, error, trimmed, input_id``.

    ``df`` has ``pos, audio, reference_text, text_<lang>``. The reference is encoded once per row,
    before the languages fan out, and only its codes go on. The model takes (prompt, language)
    and returns (samples, rate). A row without a usable reference stays, with its error; a language
    without text gives a blank path and no error. With a ``folder``, pairs that a run there has finished from the same
    texts are left out, and rows of which nothing is left are not encoded. ``count_tokens`` turns on the prompt guard: where
    it counts more than ``token_limit`` in a prompt, the reference is encoded again from its first seconds, and ``trimmed`` says so.
    ``pieces`` says how ``df`` is stored: then neither its audio nor its texts are shuffled.
    """
    usable = df.withColumn("error", F.when(has_samples(F.col("audio")), "").otherwise(ERROR_NO_AUDIO))
    if encoder_rate:
        usable = usable.withColumn("audio", resample_audio(F.col("audio"), encoder_rate))
    texts = {lang: f"text_{lang}" for lang in langs}
    # A language without a text column has blank texts, and so blank voices.
    usable = usable.withColumns({c: F.lit("") for c in texts.values() if c not in usable.columns})
    reference = F.col("reference_text")
    narrow = usable.select("pos", "audio", "reference_text", *dict.fromkeys(texts.values()), "error", *([PIECE] if pieces else []))
    pairs = pending = None
    if folder is not None:
        pairs = expand_languages(narrow.drop("audio"), texts, ["pos", "reference_text"])
        pairs = pairs.select("pos", "lang", input_digest(reference, F.col("text")).alias("input_id"))
        if stored_results(df.sparkSession, folder) is not None:
            # What is left of a row travels with it, so that the rows of its languages, with their prompts, need no join.
            left = left_to_do(pairs, ["pos", "lang"], folder)
            pending = materialize(left.groupBy("pos").agg(F.collect_set(F.struct("lang", "input_id")).alias("_left")), "pending")
            narrow = pieces.join(narrow, pending) if pieces else narrow.join(pending, "pos")
    narrow = narrow.drop(PIECE)
    kept = ["pos", "reference_text", *(["_left"] if pending is not None else [])]
    tokens = _reference_tokens(narrow, texts, open_encoder, count_tokens, token_limit)
    long = expand_languages(tokens, texts, [*kept, "ref_tokens", "head_tokens", "error"])
    long = long.withColumn("input_id", input_digest(reference, F.col("text")))
    if pending is not None:
        long = long.where(F.array_contains("_left", F.struct("lang", "input_id"))).drop("_left")
    skip = is_empty(F.col("text"))
    whole = clone_prompt(reference, F.col("ref_tokens"), F.col("text"))
    too_long = F.coalesce(count_tokens(whole) > token_limit, F.lit(False)) & ~skip if count_tokens else F.lit(False)
    asked = long.withColumns(
        {
            "trimmed": too_long,
            "prompt": F.when(~skip, F.when(too_long, clone_prompt(reference, F.col("head_tokens"), F.col("text"))).otherwise(whole)),
            "_error": F.col("error"),
            # Anything but blank keeps the row from the model.
            "error": F.when(F.col("error") != "", F.col("error")).when(skip, "no text").otherwise(""),
        }
    ).drop("reference_text", "ref_tokens", "head_tokens")
    made = synthesize(spread(asked, tasks, "pos", "lang"), open_model, ["prompt", "lang"], drop=["prompt"])
    clip = audio_value(F.col("out_array"), F.col("out_rate"))
    name = F.concat_ws("/", F.lit("cloned_audio"), F.col("lang"), indexed_clip_name(F.col("pos"), F.col("lang")))
    return made.select(
        "pos", "lang", "text",
        F.when(has_samples(clip), name).otherwise("").alias("path"),
        clip.alias("clip"),
        F.when(skip, F.col("_error")).otherwise(F.col("error")).alias("error"),
        "trimmed", "input_id",
    )


def _reference_tokens(
    narrow: DataFrame, texts: dict[str, str], open_encoder: Callable[[], Callable], count_tokens: Callable[[Column], Column] | None, token_limit: int
) -> DataFrame:
    """``ref_tokens`` of each reference, and for rows with a prompt over the limit ``head_tokens`` of its first seconds."""
    if count_tokens is None:
        encoded = encode_references(narrow, open_encoder)
        return encoded.withColumns({"ref_tokens": format_codes(F.col("ref_codes")), "head_tokens": F.lit(None).cast("string")}).drop("ref_codes")
    # Only the first seconds are carried on for the case, not the clip.
    head = F.struct(F.slice("audio.array", F.lit(1), F.col("audio.sampling_rate") * PROMPT_SECONDS).alias("array"), F.col("audio.sampling_rate").alias("sampling_rate"))
    once = encode_references(narrow.withColumn("_head", head), open_encoder)
    once = once.withColumn("ref_tokens", format_codes(F.col("ref_codes"))).drop("ref_codes")
    prompts = [clone_prompt(F.col("reference_text"), F.col("ref_tokens"), F.coalesce(F.col(c), F.lit(""))) for c in dict.fromkeys(texts.values())]
    need = (F.col("error") == "") & F.coalesce(F.greatest(*[count_tokens(p) for p in prompts], F.lit(-1)) > token_limit, F.lit(False))
    again = once.withColumns({"_first": F.col("error"), "_need": need}).withColumns({"error": F.when(F.col("_need"), "").otherwise("-"), "audio": F.col("_head")}).drop("_head")
    twice = encode_references(again, open_encoder)
    error = F.when(F.col("_need"), F.col("error")).otherwise(F.col("_first"))
    return twice.withColumns({"head_tokens": format_codes(F.col("ref_codes")), "error": error}).drop("ref_codes", "_first", "_need")


def source_path(lang: str) -> Column:
    return F.concat_ws("/", F.lit("cloned_audio"), F.lit(lang), indexed_source_name(F.col("pos")))


def write_clip_files(df: DataFrame, clips: DataFrame, folder: str, source_lang: str = "en") -> None:
    """Write the usable source clips and all cloned clips as files below ``folder``."""
    usable = df.where(has_samples(F.col("audio")))
    sources = usable.select(source_path(source_lang).alias("path"), F.col("audio").cast(AUDIO_TYPE).alias("audio"))
    cloned = clips.where("path <> ''").select("path", F.col("clip").alias("audio"))
    require_written(write_audio_files(sources.unionByName(cloned), folder))


def wide_metadata(df: DataFrame, clips: DataFrame, langs: Sequence[str], source_lang: str = "en", pieces: Pieces | None = None) -> DataFrame:
    """Input rows (without audio) with ``voice_<lang>`` paths and ``voice_<lang>_ok`` flags, in
    canonical order. If ``pieces`` says how ``df`` is stored, only paths and errors are shuffled, and the rows come in order."""
    paths = clips.select("pos", "lang", "path", "error")
    first_error = F.min_by("error", F.when(F.col("error") != "", F.col("lang"))).alias("error")
    wide = collapse_languages(paths, ["pos"], langs, "path", "voice_", [first_error])
    if pieces:
        # Stored: each export reads them.
        joined = pieces.join(df.drop("audio"), materialize(wide, "voices"), "left").drop(PIECE)
    else:
        joined = df.drop("audio").join(wide, "pos", "left")
    voices = {f"voice_{lang}": F.coalesce(F.col(f"voice_{lang}"), F.lit("")) for lang in langs}
    flags = {f"voice_{lang}_ok": F.coalesce(F.col(f"voice_{lang}"), F.lit("")) != "" for lang in langs}
    result = joined.withColumns({**flags, **voices, "error": F.coalesce(F.col("error"), F.lit(""))})
    if source_lang not in langs:
        no_source = F.col("error") == ERROR_NO_AUDIO
        result = result.withColumn(f"voice_{source_lang}", F.when(no_source, "").otherwise(source_path(source_lang)))
    order = [source_lang, *[lang for lang in langs if lang != source_lang]]
    return put_first(result, pair_order(order))


def multilingual_clips(
    df: DataFrame,
    profile: SourceProfile,
    langs: Sequence[str],
    open_encoder: Callable[[], Callable],
    open_model: Callable[[], Callable],
    position: str = "pos",
    encoder_rate: int | None = None,
    folder: str | None = None,
    tasks: int | None = None,
    single_files: bool = False,
    source_lang: str = "en",
    shared: Sequence[str] | None = None,
    count_tokens: Callable[[Column], Column] | None = None,
    token_limit: int = PROMPT_TOKEN_LIMIT,
    pieces: Pieces | None = None,
) -> MultilingualClips:
    """Validate the languages, clone every row, and give clips, wide metadata and filled counts.

    ``df`` carries its dense position; it is read twice, so store the numbered table first. The
    clips are written as a run of their own below ``folder``, and the metadata is derived from that table without its
    audio column. A ``folder`` that is given also keeps ``metadata_cloned.csv`` and ``.json`` and the job's warnings, and
    a second action there makes only what is not finished. ``tasks`` spreads the (row, language) work list over that many partitions.
    ``single_files`` adds one WAV file per source and per cloned clip. ``shared`` names the languages that source and model share:
    others are a warning. ``count_tokens`` and ``token_limit`` turn on the prompt guard of ``clone_rows``. ``pieces`` says that and how
    ``df`` is stored by position; without it, an action with a ``folder`` stores it so.
    """
    require_known(langs, profile.languages())
    spark = df.sparkSession
    rows = select_profile(df, profile, keep=[position, *([PIECE] if pieces else [])]).withColumnRenamed(position, "pos")
    kept = folder is not None
    folder = folder or new_folder(spark, "multilingual")
    if kept and pieces is None:
        pieces = pieces_for(spark, (rows.agg(F.max("pos")).first()[0] or 0) + 1)
        rows = store_in_pieces(rows, new_folder(spark, "rows"), pieces)
    warnings = language_warnings(langs, [lang for lang in langs if f"text_{lang}" in rows.columns], langs if shared is None else shared)
    made = clone_rows(rows, langs, open_encoder, open_model, encoder_rate, tasks, folder if kept else None, count_tokens, token_limit, pieces)
    with in_place(spark):
        keep_results(made, folder)
    clips = stored_results(spark, folder).drop("run", "input_id")
    if kept:
        texts = {lang: f"text_{lang}" for lang in langs}
        blank = rows.withColumns({c: F.lit("") for c in texts.values() if c not in rows.columns})
        work = expand_languages(blank, texts, ["pos", "reference_text"])
        work = work.select("pos", "lang", input_digest(F.col("reference_text"), F.col("text")).alias("input_id"))
        clips = results_of(work, ["pos", "lang"], folder)
        keep_warnings(spark, folder, "multilingual", warnings)
    if single_files:
        write_clip_files(rows, clips, folder, source_lang)
    metadata = wide_metadata(rows, clips, langs, source_lang, pieces)
    if kept:
        plain = metadata.drop(*[f"voice_{lang}_ok" for lang in langs])
        with in_place(spark):
            write_metadata_csv(plain, f"{folder}/metadata_cloned.csv")
            write_metadata_json(plain, f"{folder}/metadata_cloned.json")
    coverage = language_coverage(metadata, {lang: f"voice_{lang}" for lang in langs})
    return MultilingualClips(metadata, clips, coverage, warnings)
