"""Work dealt by cost: every task gets about the same, and rows of like cost lie together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from speechset.operators.positions import PIECE_ROWS, content_hash, quoted
from speechset.session import LIST_ROWS, new_folder


def _cuts(light: DataFrame, tasks: int) -> list[tuple[float, int]]:
    """The (cost, digest) at which each task after the first begins, from exact prefix sums of the cost."""
    spark = light.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-light.count() // PIECE_ROWS))
    path = new_folder(spark, "costs")
    order = ["_cost", "_digest"]
    # Stored, since sampled bounds differ between two runs; the upper bits of the id number the piece.
    pieces = light.repartitionByRange(n, *order).sortWithinPartitions(*order)
    pieces.withColumn("_piece", F.shiftright(F.monotonically_increasing_id(), 33)).write.parquet(path)
    stored = spark.read.parquet(path)
    sums = stored.groupBy("_piece").agg(F.sum("_cost").alias("_sum"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)  # a row a piece
    starts = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0.0))).drop("_sum")
    total = sums.agg(F.sum("_sum")).first()[0] or 0.0
    if not total:
        return []
    inside = Window.partitionBy("_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A row belongs where its middle lies, so that one dear row is not all on one side.
    middle = F.col("_before") + F.sum("_cost").over(inside) - F.col("_cost") / 2
    task = F.least(F.floor(middle * tasks / F.lit(total)), F.lit(tasks - 1)).alias("_task")
    first = stored.join(starts, "_piece").select("_cost", "_digest", task).groupBy("_task").agg(F.min(F.struct(*order)).alias("_cut"))
    rows = first.where("_task > 0").select("_task", "_cut.*").collect()  # at most a row a task
    return sorted((row["_cost"], row["_digest"]) for row in rows)


def deal_by_cost(df: DataFrame, cost: Column, tasks: int, key: str | None = None) -> DataFrame:
    """The rows in ``tasks`` partitions of about equal cost, cheap ones first, in order of cost inside a partition: for jobs whose
    rows cost much more than their bytes, such as sentences to synthesise.

    ``cost`` estimates what a row takes (text length, seconds); null and negative costs count as nothing. Rows of equal cost are told
    apart by ``key``, or by their content. The cuts come from prefix sums over costs alone, so the rows themselves, audio
    included, are moved once. A task exceeds its share by at most one row's cost; a single row is not cut. Rows that are equal in
    cost and key stay together.
    """
    if not 0 < tasks <= LIST_ROWS:
        raise ValueError(f"tasks must be from 1 to {LIST_ROWS}")
    worth = F.greatest(F.coalesce(cost.cast("double"), F.lit(0.0)), F.lit(0.0))
    digest = F.xxhash64(quoted(key)) if key else content_hash(df)
    placed = df.withColumns({"_cost": worth, "_digest": digest})
    cuts = _cuts(placed.select("_cost", "_digest"), tasks)
    task = F.lit(0)
    if cuts:
        bounds = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(d).cast("bigint").alias("d")) for c, d in cuts])
        row = F.struct(F.col("_cost").alias("c"), F.col("_digest").alias("d"))
        task = F.size(F.filter(bounds, lambda b: b <= row))
    dealt = placed.withColumn("_task", task.cast("int")).repartitionById(tasks, "_task").sortWithinPartitions("_cost", "_digest")
    return dealt.drop("_cost", "_digest", "_task")
