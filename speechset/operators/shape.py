"""Schema work: profiles, renames, column order, records and publication shape."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from speechset.constants import AUDIO_NAME_PARTS, CLIP_COLUMNS
from speechset.functions.text import blank_to_null, column_or, first_existing, text_or_blank
from speechset.functions.naming import under
from speechset.session import qualified


@dataclass(frozen=True)
class SourceProfile:
    """Which physical columns play which part in a source table."""

    audio: str
    reference_text: str
    texts: Mapping[str, str] = field(default_factory=dict)
    default_split: str = "train"
    row_id: str | None = None
    speaker: str | None = None

    def languages(self) -> list[str]:
        return list(self.texts)


# The two source layouts.
PAIRED_SOURCE = SourceProfile(
    audio="reference_audio_path",
    reference_text="reference_text_en",
    texts={"en": "target_text_en", "ar": "target_text_ar", "fr": "target_text_fr"},
    default_split="train",
    row_id="sample_id",
    speaker="speaker_id",
)
MULTILINGUAL_SOURCE = SourceProfile(
    audio="audio",
    reference_text="text_en",
    texts={
        "en": "text_en",
        "ar": "text_ar",
        "de": "text_de",
        "fa": "text_fa",
        "fr": "text_fr",
        "ja": "text_ja",
        "nl": "text_nl",
        "pt": "text_pt",
        "ru": "text_ru",
        "tr": "text_tr",
        "zh": "text_zh",
    },
    default_split="dev",
    row_id="index",
    speaker=None,
)


def select_profile(df: DataFrame, profile: SourceProfile, keep: Sequence[str] = ()) -> DataFrame:
    """Logical columns ``row_id, speaker_id, audio, reference_text, text_<lang>`` plus ``keep``.

    Text columns the table lacks are left out; a missing id, speaker or reference text gets a default.
    """
    columns = list(keep)
    columns.append(column_or(df, profile.row_id or "", None).alias("row_id"))
    columns.append(column_or(df, profile.speaker or "").alias("speaker_id"))
    if profile.audio in df.columns:
        columns.append(F.col(profile.audio).alias("audio"))
    columns.append(column_or(df, profile.reference_text).alias("reference_text"))
    columns += [F.col(c).alias(f"text_{lang}") for lang, c in profile.texts.items() if c in df.columns]
    return df.select(*columns)


def rename_over(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename columns; a column that already has the new name gives way. Absent ones are skipped."""
    for old, new in renames.items():
        if old in df.columns and old != new:
            df = df.drop(new).withColumnRenamed(old, new)
    return df


def put_first(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """The named columns in that order (those that exist), then the rest as they are."""
    head = [c for c in first if c in df.columns]
    return df.select(*head, *[c for c in df.columns if c not in head])


def pair_order(langs: Sequence[str]) -> list[str]:
    """``text_en, voice_en, text_ar, voice_ar, ...``"""
    return [name for lang in langs for name in (f"text_{lang}", f"voice_{lang}")]


def canonical_metadata(df: DataFrame, langs: Sequence[str]) -> DataFrame:
    """Bring old metadata to ``text_<lang>, voice_<lang>`` pairs in language order, then the rest.

    Older names are accepted, blanks replace missing texts and voices, and the columns that were
    used up are not repeated.
    """
    old_names = {
        **{f"text_{lang}": [f"text_{lang}"] for lang in langs},
        **{f"voice_{lang}": [f"cloned_voice_{lang}", f"voice_{lang}"] for lang in langs},
        "text_en": ["source_text_en", "text_en"],
    }
    used = {name for names in old_names.values() for name in names}
    head = [text_or_blank(first_existing(df, *old_names[n]).cast("string")).alias(n) for n in pair_order(langs)]
    return df.select(*head, *[c for c in df.columns if c not in used])


def clip_record(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The ten clip columns, then ``extra`` ones as they are. A text the table lacks, and every null
    text, becomes blank; the index is a number."""
    fixed = {"original_index": F.col("original_index").cast("bigint")}
    record = [fixed[c].alias(c) if c in fixed else column_or(df, c).cast("string").alias(c) for c in CLIP_COLUMNS]
    return df.select(*record, *extra)


def is_audio_name(name: str) -> bool:
    return any(part in name.lower() for part in AUDIO_NAME_PARTS)


def audio_path_columns(df: DataFrame) -> list[str]:
    """Columns that hold audio paths: named like audio, and text (a sample count is not a path)."""
    return [f.name for f in df.schema if is_audio_name(f.name) and isinstance(f.dataType, StringType)]


def publishable(df: DataFrame, folder: str) -> DataFrame:
    """Metadata in the form it is published: no internal columns, everything but audio paths as text
    with blanks for nulls, audio paths absolute or null. A relative ``folder`` is below the session's working folder."""
    if "://" not in folder and not folder.startswith("/"):
        folder = qualified(folder).removeprefix("file:")
    paths = set(audio_path_columns(df))
    columns = []
    for name in df.columns:
        if name.startswith("_"):
            continue
        if name in paths:
            columns.append(under(folder, blank_to_null(F.col(name))).alias(name))
        else:
            columns.append(text_or_blank(F.col(name).cast("string")).alias(name))
    return df.select(*columns)


def union_splits(splits: Mapping[str, DataFrame]) -> DataFrame:
    """All splits as one table with a ``split`` column; columns a split lacks are null."""
    tagged = [df.withColumn("split", F.lit(name)) for name, df in splits.items()]
    result = tagged[0]
    for other in tagged[1:]:
        result = result.unionByName(other, allowMissingColumns=True)
    return result
