import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from speechset.constants import SPEAKER_RANGES
from speechset.operators import speakers
from speechset.operators.ranges import PIECE, _windows, first_wins
from speechset.operators.reports import verify_split
from speechset.operators.speakers import (
    annotate_speakers,
    disjoint_ranges,
    label_split,
    map_sizes,
    smallest_speakers,
    speaker_sizes,
)
from speechset.plans.speaker_split import annotate_corpus, check_speaker_split, speaker_split
from tests.conftest import plan, rows


def _corpus(spark):
    return spark.sql(
        "SELECT 'dev' AS original_split, id AS original_index FROM range(468) "
        "UNION ALL SELECT 'eval', id FROM range(416)"
    )


def _first_match(ranges, split, index):
    return next(((num, name) for s, lo, hi, num, name in ranges if s == split and lo <= index <= hi), (None, None))


def test_published_numbers(spark):
    widths = [hi - lo + 1 for _, lo, hi, _, _ in SPEAKER_RANGES]
    assert widths == [107, 82, 66, 108, 105, 100, 84, 56, 90, 86]
    labelled = speaker_split(annotate_speakers(_corpus(spark)), 2)
    counts = {r.split: r["count"] for r in labelled.groupBy("split").count().collect()}
    assert counts == {"test": 122, "train": 762}
    test = labelled.where("split = 'test'").select("speaker_id", "speaker_name").distinct()
    assert rows(test) == [("speaker_03", "Michał"), ("speaker_08", "Letitia")]


def test_map_sizes_give_the_same_choice(spark):
    chosen = smallest_speakers(map_sizes(spark), 2, tie_break="map_order")
    assert rows(chosen, "speaker_id", "n") == [("speaker_03", 66), ("speaker_08", 56)]


def test_a_speaker_with_two_ranges_has_both_counted(spark):
    ranges = [("dev", 0, 9, 1, "A"), ("dev", 10, 14, 2, "B"), ("eval", 0, 4, 1, "A")]
    assert rows(map_sizes(spark, ranges), "speaker_id", "n") == [("speaker_01", 15), ("speaker_02", 5)]


def test_keys_and_unknown_speakers(spark):
    df = spark.createDataFrame([("dev", 106), ("dev", 107), ("dev", 468), ("test", 0)], "original_split string, original_index bigint")
    assert rows(annotate_speakers(df), "_key", "speaker_id", "speaker_name") == [
        ("dev:106", "speaker_01", "Elena"),
        ("dev:107", "speaker_02", "Antoine"),
        ("dev:468", "speaker_unknown", "Unknown"),
        ("test:0", "speaker_unknown", "Unknown"),
    ]


_range = st.tuples(st.sampled_from(["dev", "eval"]), st.integers(0, 60), st.integers(0, 40)).map(lambda r: (r[0], r[1], r[1] + r[2]))


@settings(max_examples=60, deadline=None)
@given(st.lists(_range, max_size=12))
def test_disjoint_ranges_keep_the_first_match(found):
    ranges = [(s, lo, hi, n, f"n{n}") for n, (s, lo, hi) in enumerate(found)]
    cut = disjoint_ranges(ranges)
    for split in ("dev", "eval"):
        for index in range(110):
            hits = [(num, name) for s, lo, hi, num, name in cut if s == split and lo <= index <= hi]
            assert len(hits) <= 1
            assert (hits[0] if hits else (None, None)) == _first_match(ranges, split, index)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_range, min_size=1, max_size=12))
def test_both_join_paths_equal_brute_force(spark, found):
    ranges = [(s, lo, hi, n, f"n{n}") for n, (s, lo, hi) in enumerate(found)]
    table = spark.createDataFrame(
        [(*r, order) for order, r in enumerate(ranges)],
        "split string, lo bigint, hi bigint, num int, name string, map_order int",
    )
    df = spark.sql("SELECT s AS original_split, id AS original_index FROM range(110), VALUES ('dev'), ('eval') AS v(s)")
    expected = {}
    for split in ("dev", "eval"):
        for index in range(110):
            num, name = _first_match(ranges, split, index)
            expected[f"{split}:{index}"] = ("speaker_unknown", "Unknown") if num is None else (f"speaker_{num:02d}", name)
    for limit in (100, 0):
        result = annotate_speakers(df, table, broadcast_rows=limit)
        assert {r._key: (r.speaker_id, r.speaker_name) for r in result.collect()} == expected


def test_range_map_is_broadcast_without_a_shuffle(spark):
    text = plan(annotate_speakers(_corpus(spark).where("original_index < 400")))
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text and "Exchange hashpartitioning" not in text


def test_long_ranges_over_capped_buckets(spark, monkeypatch):
    monkeypatch.setattr(speakers, "MAX_LEVEL", 3)
    ranges = [("dev", 50, 52, 0, "in"), ("dev", -5, 2**60, 1, "all"), ("eval", 90, 10**9, 2, "tail"), ("eval", 500, 600, 3, "none")]
    schema = "split string, lo bigint, hi bigint, num int, name string, map_order int"
    table = spark.createDataFrame([(*r, order) for order, r in enumerate(ranges)], schema)
    df = spark.sql("SELECT s AS original_split, id AS original_index FROM range(110), VALUES ('dev'), ('eval') AS v(s)")
    got = {r._key: r.speaker_name for r in annotate_speakers(df, table, broadcast_rows=0).collect()}
    assert got == {f"{s}:{i}": _first_match(ranges, s, i)[1] or "Unknown" for s in ("dev", "eval") for i in range(110)}
    assert annotate_speakers(df.where("false"), table, broadcast_rows=0).count() == 0


def test_bucketed_path_has_no_nested_loop(spark):
    table = spark.createDataFrame([("dev", 0, 9, 1, "A", 0)], "split string, lo bigint, hi bigint, num int, name string, map_order int")
    text = plan(annotate_speakers(_corpus(spark), table, broadcast_rows=0))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def _speakers(spark, **sizes):
    data = [(s.replace("unknown", "speaker_unknown"), i) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(data, "speaker_id string, i int")


def test_ties_and_unknown(spark):
    df = _speakers(spark, c=2, a=2, b=2, big=9, unknown=1)
    assert [r.speaker_id for r in smallest_speakers(speaker_sizes(df), 2).collect()] == ["a", "b"]
    counts = {r.split: r["count"] for r in speaker_split(df, 2).groupBy("split").count().collect()}
    assert counts == {"test": 4, "train": 12}
    with_null = df.union(spark.createDataFrame([(None, 0)], "speaker_id string, i int"))
    counts = {r.split: r["count"] for r in speaker_split(with_null, 2).groupBy("split").count().collect()}
    assert counts == {"test": 4, "train": 13}


def test_no_test_speakers(spark):
    assert speaker_split(_speakers(spark, a=2, b=1), 0).where("split = 'test'").count() == 0


def test_more_test_speakers_than_speakers(spark):
    assert speaker_split(_speakers(spark, a=2, b=1), 9).where("split = 'train'").count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.sampled_from("abcdef"), st.integers(1, 6), min_size=1), st.integers(0, 4))
def test_split_is_disjoint_and_complete(spark, sizes, n):
    df = _speakers(spark, **sizes)
    report = check_speaker_split(df, n).first()
    assert report.shared_speakers == 0 and report.expected_only_in_test and report.complete
    assert report.test_rows + report.train_rows == sum(sizes.values())


def test_verify_finds_a_broken_split(spark):
    df = spark.createDataFrame([("a", "test"), ("a", "train"), ("b", "train")], "speaker_id string, split string")
    report = verify_split(df, ["a"]).first()
    assert report.shared_speakers == 1 and not report.expected_only_in_test
    assert not verify_split(df, ["absent"]).first().expected_only_in_test
    assert not verify_split(df, ["b"]).first().expected_only_in_test


def test_labelling_is_one_broadcast(spark):
    df = _speakers(spark, a=2, b=1)
    chosen = spark.createDataFrame([("b",)], "speaker_id string")
    assert "BroadcastHashJoin" in plan(label_split(df, chosen, 1))


def test_annotate_corpus_numbers_each_split(spark):
    df = spark.createDataFrame([("dev", 30), ("dev", 10), ("eval", 20)], "original_split string, k bigint")
    assert rows(annotate_corpus(df, "k"), "k", "_key") == [(10, "dev:0"), (20, "eval:0"), (30, "dev:1")]


def _painted(ranges, low, high):
    """The number of the first range at each position, by painting from the last to the first."""
    owner = np.full(high - low, -1)
    for lo, hi, order in sorted(ranges, key=lambda r: -r[2]):
        owner[lo - low : hi + 1 - low] = order
    return owner


@pytest.mark.parametrize("case", ["random", "nested", "one start", "steps"])
def test_sweep_over_many_pieces(spark, case):
    rng = np.random.default_rng(4)
    n = 4 * PIECE
    if case == "random":
        lo = rng.integers(0, 20_000, n)
        bounds = [(int(a), int(a + b)) for a, b in zip(lo, rng.geometric(1e-3, n) * rng.choice([0, 1, 5], n))]
    elif case == "nested":
        bounds = [(i, 20_000 - i) for i in range(n)]
    elif case == "one start":
        bounds = [(100, 100 + 3 * i) for i in range(n)]
    else:
        bounds = [(2 * i, 2 * i) for i in range(n)]
    order = rng.permutation(len(bounds))
    ranges = [(a, b, int(o)) for (a, b), o in zip(bounds, order)]
    table = spark.createDataFrame(
        [("dev", a, b, o, f"n{o}", o) for a, b, o in ranges] + [("eval", 5, 9, 1, "e", 0), (None, 0, 9, 1, "x", 0), ("dev", 9, 8, 1, "empty", -1)],
        "split string, lo bigint, hi bigint, num int, name string, map_order int",
    ).repartition(5)
    segments = first_wins(table).collect()
    got = np.full(30_000, -1)
    for s in segments:
        if s.split == "dev":
            assert (got[s.lo : s.hi + 1] == -1).all() and s.lo <= s.hi and s.name == f"n{s.num}"
            got[s.lo : s.hi + 1] = s.num
    assert (got == _painted(ranges, 0, 30_000)).all()
    assert [(s.lo, s.hi, s.name) for s in segments if s.split != "dev"] == [(5, 9, "e")]
    assert first_wins(table.limit(0)).count() == 0


def test_a_long_list_of_ranges_needs_no_table(spark):
    ranges = [("dev", i, 10**6 - i, i % 90, f"n{i}") for i in range(10_500)][::-1]
    df = spark.createDataFrame([("dev", i) for i in (0, 5, 10_499, 500_000, 10**6, 10**6 + 1)], "original_split string, original_index bigint")
    got = {r.original_index: r.speaker_name for r in annotate_speakers(df, ranges).collect()}
    assert got == {0: "n0", 5: "n5", 10_499: "n10499", 500_000: "n10499", 10**6: "n0", 10**6 + 1: "Unknown"}


def test_runs_become_a_bounded_number_of_windows(spark):
    """However many runs there are, the windows are at most pieces times levels, and hold the same minimum at each piece."""
    rng = np.random.default_rng(7)
    pieces, x = 40, rng.integers(0, 39, 3_000)
    y = np.minimum(x + rng.integers(1, 40, len(x)), pieces)
    order = rng.permutation(len(x))
    runs = spark.createDataFrame([("dev", (int(o),), int(a), int(b)) for o, a, b in zip(order, x, y)], "split string, w struct<map_order: int>, x bigint, y bigint")
    windows = _windows(runs).collect()
    assert len(windows) <= pieces * 6 and all((r.y - r.x).bit_count() == 1 for r in windows)
    for p in range(pieces):
        wanted = min((int(o) for o, a, b in zip(order, x, y) if a <= p < b), default=None)
        assert min((r.w.map_order for r in windows if r.x <= p < r.y), default=None) == wanted
