"""Keys, speaker ids and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from speechset.constants import UNKNOWN_SPEAKER_ID


def speaker_id(number: Column) -> Column:
    label = F.format_string("speaker_%02d", number)
    return F.when(number.isNotNull(), label).otherwise(F.lit(UNKNOWN_SPEAKER_ID))


def resume_key(split: Column, index: Column) -> Column:
    return F.concat(split, F.lit(":"), index.cast("string"))


def file_key(key: Column) -> Column:
    return F.replace(key, F.lit(":"), F.lit("_"))


def source_clip_name(key: Column, lang: str = "en") -> Column:
    return F.concat(F.lit("original_"), file_key(key), F.lit(f"_{lang}.wav"))


def cloned_clip_name(key: Column, lang: str = "fr") -> Column:
    return F.concat(F.lit("cloned_"), file_key(key), F.lit(f"_{lang}.wav"))


def indexed_source_name(index: Column) -> Column:
    return F.format_string("original_%05d.wav", index)


def indexed_clip_name(index: Column, lang: Column) -> Column:
    return F.format_string("cloned_%05d_%s.wav", index, lang)


def voice_clip_name(voice: Column, lang: Column, index: Column, ext: str = "wav") -> Column:
    return F.format_string(f"%s_%s_%05d.{ext}", F.lower(voice), lang, index)


def under(folder: str | Column, path: Column) -> Column:
    """``folder/path``; absolute when ``folder`` is."""
    base = F.lit(folder.rstrip("/")) if isinstance(folder, str) else folder
    return F.concat(base, F.lit("/"), path)
