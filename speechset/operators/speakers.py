"""Speaker lookup by position range, speaker sizes and the speaker-disjoint split."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechset.constants import SPEAKER_RANGES, UNKNOWN_SPEAKER_ID, UNKNOWN_SPEAKER_NAME
from speechset.functions.naming import resume_key, speaker_id
from speechset.operators.ranges import first_wins
from speechset.session import BROADCAST_ROWS, bounded_rows, materialize, small_table

# Widest bucket of the join with a large range map, as a power of two.
MAX_LEVEL = 17

_MAP_SCHEMA = "map_split string, lo bigint, hi bigint, num int, name string"


def disjoint_ranges(ranges: Iterable[tuple]) -> list[tuple]:
    """Cut overlapping (split, lo, hi, num, name) ranges so that the first listed one wins."""
    by_split: dict[str, list] = {}
    for order, (split, lo, hi, num, name) in enumerate(ranges):
        if lo <= hi:
            by_split.setdefault(split, []).append((lo, hi, order, num, name))
    result = []
    for split, items in by_split.items():
        items.sort()
        edges = sorted({edge for lo, hi, *_ in items for edge in (lo, hi + 1)})
        active: list = []
        upcoming = 0
        for start, stop in zip(edges, edges[1:]):
            while upcoming < len(items) and items[upcoming][0] <= start:
                lo, hi, order, num, name = items[upcoming]
                heapq.heappush(active, (order, hi, num, name))
                upcoming += 1
            while active and active[0][1] < start:
                heapq.heappop(active)
            if active:
                _, _, num, name = active[0]
                last = result[-1] if result else None
                if last and last[0] == split and last[2] == start - 1 and last[3:] == (num, name):
                    result[-1] = (split, last[1], stop - 1, num, name)
                else:
                    result.append((split, start, stop - 1, num, name))
    return result


def annotate_speakers(
    df: DataFrame,
    ranges: Sequence[tuple] | DataFrame = SPEAKER_RANGES,
    split_column: str = "original_split",
    index_column: str = "original_index",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add ``speaker_id``, ``speaker_name`` and ``_key`` from the range that holds the row's index.

    Ranges are inclusive; where two overlap the first one wins; a row in none is unknown. A table of
    ranges needs the columns split, lo, hi, num, name and map_order. Up to ``broadcast_rows`` ranges
    are broadcast, so the utterances are not shuffled. More of them are made disjoint by a distributed
    sweep and joined by index bucket, where each row meets one range.
    """
    spark = df.sparkSession
    if not isinstance(ranges, DataFrame) and len(ranges) > broadcast_rows:
        numbered = [(*r, order) for order, r in enumerate(ranges)]
        ranges = small_table(spark, numbered, "split string, lo bigint, hi bigint, num int, name string, map_order bigint")
    if isinstance(ranges, DataFrame):
        ordered = ranges.select("split", "lo", "hi", "num", "name", "map_order")
        if ordered.limit(broadcast_rows + 1).count() > broadcast_rows:
            matched = _bucketed_range_join(df, materialize(first_wins(ordered), "segments"), split_column, index_column)
            return _with_speaker_columns(matched, split_column, index_column)
        rows = sorted(bounded_rows(ordered, broadcast_rows), key=lambda r: r["map_order"])
        ranges = [(r["split"], r["lo"], r["hi"], r["num"], r["name"]) for r in rows]
    table = small_table(spark, disjoint_ranges(ranges), _MAP_SCHEMA)
    inside = (F.col(split_column) == F.col("map_split")) & F.col(index_column).between(F.col("lo"), F.col("hi"))
    matched = df.join(F.broadcast(table), inside, "left").drop("map_split", "lo", "hi")
    return _with_speaker_columns(matched, split_column, index_column)


def _bucketed_range_join(df: DataFrame, ranges: DataFrame, split_column: str, index_column: str) -> DataFrame:
    """Join disjoint ranges on (split, level, bucket). A range of length 2^k to 2^(k+1)-1 has level k and buckets of
    2^k positions, so it lies in at most three of them and a bucket meets at most three ranges. Levels end at
    ``MAX_LEVEL``; a longer range lies in one bucket per 2^MAX_LEVEL positions. Each row looks into one bucket per level that
    occurs, as a key without its other columns, and is met by one range at most. Rows that share a position are one key."""
    low, high = df.agg(F.min(index_column), F.max(index_column)).first()
    if low is None:
        low, high = 0, -1
    clipped = ranges.withColumns(
        {"lo": F.greatest("lo", F.lit(low).cast("bigint")), "hi": F.least("hi", F.lit(high).cast("bigint"))}
    )
    level = F.least(F.length(F.bin(F.col("hi") - F.col("lo") + 1)) - 1, F.lit(MAX_LEVEL))
    sized = clipped.where("lo <= hi").withColumn("_level", level)
    levels = sorted(bounded_rows(sized.select("_level").distinct()))
    buckets = sized.select(
        F.col("split").alias("_split"), "lo", "hi", "num", "name", "_level",
        F.explode(F.expr("sequence(shiftright(lo, _level), shiftright(hi, _level))")).alias("_bucket"),
    )
    keys = df.select(F.col(split_column).alias("_s"), F.col(index_column).cast("bigint").alias("_i")).distinct()
    places = keys.select(
        "_s",
        "_i",
        F.explode(F.array(*[F.lit(row[0]) for row in levels]).cast("array<int>")).alias("_l"),
    ).withColumn("_b", F.expr("shiftright(_i, _l)"))
    hit = (
        (F.col("_s") == F.col("_split"))
        & (F.col("_l") == F.col("_level"))
        & (F.col("_b") == F.col("_bucket"))
        & F.col("_i").between(F.col("lo"), F.col("hi"))
    )
    winners = (
        places.join(buckets, hit)
        .select("_s", "_i", "num", "name")
    )
    same = (F.col(split_column) == F.col("_s")) & (F.col(index_column) == F.col("_i"))
    return df.join(winners, same, "left").drop("_s", "_i")


def _with_speaker_columns(matched: DataFrame, split_column: str, index_column: str) -> DataFrame:
    return matched.withColumns(
        {
            "speaker_id": speaker_id(F.col("num")),
            "speaker_name": F.coalesce(F.col("name"), F.lit(UNKNOWN_SPEAKER_NAME)),
            "_key": resume_key(F.col(split_column), F.col(index_column)),
        }
    ).drop("num", "name")


def speaker_sizes(df: DataFrame, speaker: str = "speaker_id") -> DataFrame:
    return df.groupBy(speaker).agg(F.count(F.lit(1)).alias("n"))


def map_sizes(spark, ranges: Sequence[tuple] = SPEAKER_RANGES) -> DataFrame:
    """Utterances per speaker as the range map states them, with the speaker's place in the map."""
    rows = [(order, num, hi - lo + 1) for order, (_, lo, hi, num, _) in enumerate(ranges)]
    return (
        small_table(spark, rows, "map_order int, num int, width bigint")
        .groupBy(speaker_id(F.col("num")).alias("speaker_id"))
        .agg(F.sum("width").alias("n"), F.min("map_order").alias("map_order"))
    )


def smallest_speakers(sizes: DataFrame, n: int, speaker: str = "speaker_id", tie_break: str | None = None) -> DataFrame:
    """The ``n`` speakers with the fewest utterances, never the unknown one. Ties go to the earlier
    ``tie_break`` value, or to the smaller id."""
    unknown = F.coalesce(F.col(speaker) == UNKNOWN_SPEAKER_ID, F.lit(True))
    # Sorting the unknown one last and dropping it after the limit leaves the count below untouched,
    # so that a plan which also uses the sizes elsewhere counts once.
    order = [unknown, "n", *([tie_break] if tie_break else []), speaker]
    return sizes.orderBy(*order).limit(n).where(~unknown)


def _bounded(chosen: DataFrame, n: int) -> DataFrame:
    # ``n`` is the row limit of ``chosen``: hint only while it is small.
    return F.broadcast(chosen) if n <= BROADCAST_ROWS else chosen


def label_split(df: DataFrame, test_speakers: DataFrame, n: int, speaker: str = "speaker_id") -> DataFrame:
    """Add ``split``: test for the rows of the given speakers, train for all others, in one pass."""
    chosen = test_speakers.select(F.col(speaker).alias("_test"))
    return (
        df.join(_bounded(chosen, n), F.col(speaker) == F.col("_test"), "left")
        .withColumn("split", F.when(F.col("_test").isNotNull(), "test").otherwise("train"))
        .drop("_test")
    )


def test_rows(df: DataFrame, test_speakers: DataFrame, n: int, speaker: str = "speaker_id") -> DataFrame:
    return df.join(_bounded(test_speakers.select(speaker), n), speaker, "left_semi")


def train_rows(df: DataFrame, test_speakers: DataFrame, n: int, speaker: str = "speaker_id") -> DataFrame:
    return df.join(_bounded(test_speakers.select(speaker), n), speaker, "left_anti")
