"""Dealing by cost, samples of any size, and numbering of tables with any columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from speechset.operators.balance import deal_by_cost
from speechset.operators.positions import content_hash, dense_positions, large_sample, seeded_sample
from speechset.streaming.incremental import first_of_keys
from tests.conftest import rows


def _loads(df):
    found = df.withColumn("t", F.spark_partition_id()).groupBy("t").agg(F.sum("cost").alias("s"), F.min("cost").alias("a"), F.max("cost").alias("b"))
    return {r.t: (r.s, r.a, r.b) for r in found.collect()}


@pytest.mark.parametrize("law", ["even", "long tail", "equal"])
def test_tasks_cost_the_same(spark, law):
    rng = np.random.default_rng(7)
    costs = {"even": rng.integers(1, 1000, 4000), "long tail": (rng.pareto(1.5, 4000) * 50 + 1).clip(0, 4000).astype(int), "equal": np.full(4000, 9)}[law]
    df = spark.createDataFrame([(i, float(c), [0.5] * 3) for i, c in enumerate(costs)], "id bigint, cost double, audio array<double>").repartition(3)
    dealt = deal_by_cost(df, F.col("cost"), 8, "id")
    loads = _loads(dealt)
    assert set(loads) == set(range(8)) and dealt.columns == df.columns
    assert max(s for s, *_ in loads.values()) <= 1.2 * min(s for s, *_ in loads.values())
    assert all(loads[t][2] <= loads[t + 1][1] for t in range(7))  # like costs lie together
    assert rows(dealt, "id") == rows(df, "id")


def test_odd_costs(spark):
    df = spark.createDataFrame([(1, None, {"a": 1}), (2, -5.0, None), (3, 100.0, {}), (3, 100.0, {}), (None, 1.0, {"b": 2})], "id int, cost double, m map<string,int>")
    for key in ("id", None):
        assert deal_by_cost(df, F.col("cost"), 3, key).count() == 5
    assert deal_by_cost(df.limit(0), F.col("cost"), 2).count() == 0
    assert deal_by_cost(df.withColumn("cost", F.lit(0.0)), F.col("cost"), 2).count() == 5
    with pytest.raises(ValueError):
        deal_by_cost(df, F.col("cost"), 0)


def test_samples_of_any_size_agree(spark):
    df = spark.range(0, 3000, 1, 5).select(F.when(F.col("id") % 100 != 0, F.col("id")).alias("id"), F.lit("x").alias("v"))
    for n in (0, 1, 29, 30, 31, 700, 2999, 3000, 9000):
        small, large = (f(df, n, "id", 3).select("id", "selected_id") for f in (seeded_sample, large_sample))
        assert rows(large, "selected_id") == sorted([(i,) for i in range(min(n, 3000))], key=repr)
        assert rows(large) == rows(small) if n > 30 else True


def test_large_samples_are_numbered_in_pieces(spark):
    plan = large_sample(spark.range(1000), 700, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan


def test_numbering_takes_any_column(spark):
    df = spark.sql("SELECT id AS `a.b`, map('k', cast(id AS int)) AS `c d`, parse_json(cast(id AS string)) AS v, named_struct('m', map(1, 2)) AS n FROM range(50)")
    got = dense_positions(df, "a.b")
    assert got.columns == ["a.b", "c d", "v", "n", "pos"] and rows(got.select("`a.b`", "pos")) == sorted([(i, i) for i in range(50)], key=repr)
    by_text = dense_positions(df.withColumn("t.u", F.format_string("%03d", "`a.b`")), ["t.u"], [], partitions=3)
    assert rows(by_text.select("`a.b`", "pos")) == sorted([(i, i) for i in range(50)], key=repr)
    grouped = dense_positions(df.withColumn("g.h", F.col("`a.b`") % 2), "a.b", ["g.h"])
    assert rows(grouped.select("`a.b`", "pos")) == sorted([(i, i // 2) for i in range(50)], key=repr)
    assert df.select(content_hash(df).alias("h")).distinct().count() == 50
    nulls = df.withColumn("a.b", F.when(F.col("`a.b`") > 9, F.col("`a.b`")))
    assert rows(dense_positions(nulls, "a.b", piece_rows=4), "pos") == sorted([(i,) for i in range(50)], key=repr)


def test_equal_rows_without_a_key_lie_in_several_pieces(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("k"), F.lit("same").alias("v"))
    done = dense_positions(df, "k", piece_rows=50)
    assert rows(done, "pos") == sorted([(i,) for i in range(1000)], key=repr)
    assert done.where("k IS NULL").agg(F.max("pos")).first()[0] == 665
    assert [r.k for r in done.where("pos >= 666").orderBy("pos").collect()] == list(range(0, 1000, 3))


def test_repeated_keys_of_tables_with_maps(spark):
    df = spark.createDataFrame([("a", {"x": 1}), ("a", {"x": 2}), (None, {"x": 3}), (None, {"x": 3})], "k string, m map<string,int>")
    first = first_of_keys(df, "k")
    assert rows(first, "k") == sorted([("a",), (None,), (None,)], key=repr)
    assert first.where("k = 'a'").first().m == first_of_keys(df.orderBy(F.desc("k")), "k").where("k = 'a'").first().m
