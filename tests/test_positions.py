import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from speechset.operators.positions import concat_in_order, dense_positions, first_per_group, first_rows, seeded_sample
from tests.conftest import plan, rows


def _expected(data):
    """Brute force: (group, key) -> position."""
    result = {}
    for group in {g for g, _ in data}:
        for pos, key in enumerate(sorted(k for g, k in data if g == group)):
            result[(group, key)] = pos
    return result


def _check(spark, data, **options):
    df = spark.createDataFrame(sorted(data, key=lambda r: str(r)[::-1]), "g string, k bigint")
    got = {(r.g, r.k): r.pos for r in dense_positions(df, "k", ["g"], **options).collect()}
    assert got == _expected(data)


def test_one_group_over_many_pieces(spark):
    _check(spark, {("a", k) for k in range(0, 1000, 3)} | {("b", 7), ("b", 900)}, piece_rows=16)


def test_sparse_keys_take_the_range_path(spark):
    _check(spark, {("a", k * 10**15) for k in range(-50, 50)} | {("b", 3)}, piece_rows=1, partitions=7)


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(None, 5), (None, 2), ("a", 1)], "g string, k bigint")
    assert rows(dense_positions(df, "k", ["g"])) == sorted([(None, 5, 1), (None, 2, 0), ("a", 1, 0)], key=repr)


def test_empty_table(spark):
    df = spark.createDataFrame([], "g string, k bigint")
    result = dense_positions(df, "k", ["g"])
    assert result.count() == 0 and result.schema["pos"].dataType.simpleString() == "bigint"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.tuples(st.sampled_from("abc"), st.integers(-300, 300)), min_size=1, max_size=80))
def test_positions_equal_brute_force(spark, data):
    _check(spark, data, piece_rows=32)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.text("xyz ", max_size=5), min_size=1, max_size=60))
def test_text_keys_equal_brute_force(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r.k: r.pos for r in dense_positions(df, "k", partitions=5).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_range_path_cuts_a_dominant_group(spark):
    df = spark.range(20000).selectExpr("if(id % 100 = 0, 'small', 'big') AS g", "sha2(string(id), 256) AS k")
    placed = dense_positions(df, ["k"], ["g"], partitions=8)
    summary = placed.groupBy("g").agg({"pos": "max", "*": "count"}).collect()
    assert {(r["g"], r["max(pos)"], r["count(1)"]) for r in summary} == {("big", 19799, 19800), ("small", 199, 200)}
    assert placed.select("g", "pos").distinct().count() == 20000


def test_no_window_over_a_whole_split(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 'dev', 'eval') AS g", "id AS k")
    text = plan(dense_positions(df, "k", ["g"], piece_rows=10))
    windows = re.findall(r"row_number\(\) windowspecdefinition\(([^,]*), ([^,]*),", text)
    assert windows and all("_piece" in second for _, second in windows)


def test_concat_keeps_the_given_order(spark):
    df = spark.createDataFrame([("dev", 0), ("dev", 1), ("eval", 0), ("eval", 1), ("other", 0)], "s string, i bigint")
    assert rows(concat_in_order(df, "s", ["eval", "dev"], "i"), "s", "i", "global_pos") == [
        ("dev", 0, 2), ("dev", 1, 3), ("eval", 0, 0), ("eval", 1, 1),
    ]


def test_first_rows(spark):
    df = spark.range(10)
    assert rows(first_rows(df, 3, "id")) == [(0,), (1,), (2,)]
    assert first_rows(df, None, "id").count() == 10
    assert first_rows(df, 99, "id").count() == 10


def test_first_per_group_cuts_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 2 AS g", "id AS k")
    first = first_per_group(df, 2, ["g"], "k")
    assert rows(first, "g", "k", "pos") == [(0, 0, 0), (0, 2, 1), (1, 1, 0), (1, 3, 1)]
    assert "WindowGroupLimit" in plan(first)


def test_sample_does_not_depend_on_partitioning(spark):
    one = rows(seeded_sample(spark.range(0, 500, 1, 1), 20, "id", seed=3))
    many = rows(seeded_sample(spark.range(0, 500, 1, 9).orderBy("id", ascending=False), 20, "id", seed=3))
    assert one == many and [r[1] for r in sorted(one, key=lambda r: r[1])] == list(range(20))
    assert one != rows(seeded_sample(spark.range(500), 20, "id", seed=4))


@pytest.mark.parametrize("how", ["key range", "small pieces", "range partitions"])
def test_rows_without_a_key_come_first_and_none_is_lost(spark, how):
    data = [("a", 1), ("a", None), ("a", 3), ("a", None), ("b", None), ("b", 7), ("c", None)]
    df = spark.createDataFrame(data, "g string, k int")
    if how == "range partitions":
        df = df.withColumn("k", F.col("k").cast("double"))
    got = dense_positions(df, "k", ["g"], piece_rows=1 if how == "small pieces" else 100, partitions=3)
    found = sorted((r.g, r.pos, r.k) for r in got.collect() if r.k is not None)
    assert found == [("a", 2, 1), ("a", 3, 3), ("b", 1, 7)]
    assert sorted((r.g, r.pos) for r in got.collect()) == [("a", 0), ("a", 1), ("a", 2), ("a", 3), ("b", 0), ("b", 1), ("c", 0)]
