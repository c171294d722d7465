"""Codec codes as marker text, and prompt assembly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from speechset.constants import (
    CODE_PATTERN,
    CODE_PREFIX,
    CODE_SUFFIX,
    PROMPT_SECONDS,
    PROMPT_TOKEN_LIMIT,
    CODEC_INPUT_RATE,
    SPEECH_START,
    TURN_END,
    TURN_START,
)

_SPEECH_START_RE = r"<\|speech_start\|>"


def format_codes(codes: Column) -> Column:
    """``[3, 5]`` -> ``<|s_3|><|s_5|>``."""
    return F.array_join(
        F.transform(codes, lambda c: F.concat(F.lit(CODE_PREFIX), c.cast("string"), F.lit(CODE_SUFFIX))), ""
    )


def parse_codes(generated: Column, strict: bool = True) -> Column:
    """Codes of the last speech section, or null if there are none.

    The strict form wants at least one speech marker; the lenient form reads the whole text without one.
    """
    sections = F.split(generated, _SPEECH_START_RE)
    codes = F.regexp_extract_all(F.element_at(sections, -1), F.lit(CODE_PATTERN), F.lit(1)).cast("array<int>")
    found = F.size(codes) > 0
    if strict:
        found = found & (F.size(sections) > 1)
    return F.when(found, codes)


def count_codes(text: Column) -> Column:
    return F.regexp_count(text, F.lit(CODE_PATTERN)).cast("bigint")


def clone_prompt(reference_text: Column, reference_tokens: Column, target_text: Column) -> Column:
    """Two turns: the reference with its tokens, then the target, left open for the answer."""
    return F.concat(
        F.lit(TURN_START), reference_text, F.lit(SPEECH_START), reference_tokens, F.lit(TURN_END),
        F.lit(TURN_START), target_text, F.lit(SPEECH_START),
    )


def guard_reference(
    array: Column,
    n_tokens: Column,
    limit: int = PROMPT_TOKEN_LIMIT,
    cap: Column | int = CODEC_INPUT_RATE * PROMPT_SECONDS,
) -> Column:
    """The reference samples to encode: all of them, or the first ``cap`` if the prompt is too long.

    ``cap`` may be a column, for example ``rate * 3`` to keep three seconds at any sampling rate.
    """
    head = F.slice(array, F.lit(1), F.lit(cap) if isinstance(cap, int) else cap)
    return F.when(n_tokens > limit, head).otherwise(array)
