"""Target languages: validation, fan-out, fan-in, coverage and the voice grid."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechset.functions.naming import voice_clip_name
from speechset.functions.text import has_text, is_empty
from speechset.operators.positions import first_per_group
from speechset.session import BROADCAST_ROWS, small_table


def literal_list(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def missing_from(requested: Column, available: Column) -> Column:
    """Requested entries that are not available, sorted."""
    return F.sort_array(F.array_except(requested, available))


def in_both(requested: Column, available: Column) -> Column:
    return F.sort_array(F.array_intersect(requested, available))


def not_in(requested: DataFrame, available: DataFrame, column: str) -> DataFrame:
    """The distinct requested values that are not available, however many there are on either side."""
    return requested.select(column).distinct().join(available.select(column), column, "left_anti")


def also_in(requested: DataFrame, available: DataFrame, column: str) -> DataFrame:
    """The distinct requested values that are available."""
    return requested.select(column).distinct().join(available.select(column), column, "left_semi")


def require_known(requested: Sequence[str], available: Sequence[str], what: str = "languages") -> None:
    """Stop a job before it starts if it asks for something that does not exist."""
    unknown = [r for r in requested if r not in set(available)]
    if unknown:
        raise ValueError(f"{what} {unknown} not available; available: {list(available)}")


def language_warnings(requested: Sequence[str], in_source: Sequence[str], shared: Sequence[str]) -> list[str]:
    """One message for languages without a text column, one for those the model does not share."""
    messages = []
    no_column = [r for r in requested if r not in set(in_source)]
    not_shared = [r for r in requested if r not in set(shared)]
    if no_column:
        messages.append(f"no text column for {no_column}")
    if not_shared:
        messages.append(f"not shared by source and model: {not_shared}; shared: {sorted(shared)}")
    return messages


def expand_languages(df: DataFrame, text_columns: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """One row per (input row, language) with columns ``lang`` and ``text``. Rows without a text stay,
    with a blank one. No shuffle."""
    pairs = [
        F.struct(F.lit(lang).alias("lang"), F.coalesce(F.col(column), F.lit("")).alias("text"))
        for lang, column in text_columns.items()
    ]
    return df.select(*keep, F.inline(F.array(*pairs)))


def collapse_languages(
    df: DataFrame, key: Sequence[str], langs: Sequence[str], value: str, prefix: str, extra: Sequence[Column] = ()
) -> DataFrame:
    """Back to one row per key with a column ``<prefix><lang>`` per language. A key has at most one
    row per language, so groups are small however the data is distributed. ``extra`` aggregates are
    computed in the same shuffle."""
    cells = [F.max(F.when(F.col("lang") == lang, F.col(value))).alias(f"{prefix}{lang}") for lang in langs]
    return df.groupBy(*key).agg(*cells, *extra)


def language_coverage(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``lang, filled, total``. Every column is counted in one pass; only the counts are unpivoted."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(has_text(F.col(column))).alias(f"_filled_{lang}") for lang, column in columns.items()],
    )
    rows = [
        F.struct(F.lit(lang).alias("lang"), F.col(f"_filled_{lang}").alias("filled"), F.col("_total").alias("total"))
        for lang in columns
    ]
    return counts.select(F.inline(F.array(*rows)))


def languages_without_text(catalogue: DataFrame, langs: Sequence[str]) -> DataFrame:
    """Requested languages for which the catalogue has no sentence."""
    spark = catalogue.sparkSession
    requested = small_table(spark, [(lang,) for lang in langs], "lang string")
    present = catalogue.where(~is_empty(F.col("text"))).select("lang").distinct()
    return requested.join(present, "lang", "left_anti")


def language_name(lang: Column, names: Mapping[str, str]) -> Column:
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    return F.create_map(*pairs)[lang]


def first_sentences(catalogue: DataFrame, langs: Sequence[str], n: int, order_by: str) -> DataFrame:
    """The first ``n`` sentences of each language as ``sample_index`` 0, 1, ...; fewer where there are
    fewer. ``order_by`` is unique within a language. The keys are ranked first, so the sort carries no
    text; at most ``n * len(langs)`` of them are then looked up in the catalogue."""
    wanted = catalogue.where(F.col("lang").isin(*langs))
    picked = first_per_group(wanted.select("lang", order_by), n, ["lang"], order_by, out="sample_index")
    few = n * len(langs) <= BROADCAST_ROWS
    return wanted.join(F.broadcast(picked) if few else picked, ["lang", order_by])


def voice_grid(
    sentences: DataFrame, voices: Sequence[str], names: Mapping[str, str], folder: str = "audio"
) -> DataFrame:
    """One row per (voice, language, sentence) with its clip path. The voices are a short list, so
    each sentence row is repeated in place and nothing is shuffled."""
    grid = sentences.withColumn("speaker", F.explode(literal_list(voices)))
    lang, index = F.col("lang"), F.col("sample_index")
    file_name = voice_clip_name(F.col("speaker"), lang, index)
    return grid.withColumns(
        {
            "language_name": language_name(lang, names),
            "file_name": file_name,
            "audio_path": F.concat_ws("/", F.lit(folder), lang, file_name),
        }
    )
