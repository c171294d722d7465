"""Row order made explicit: dense positions, first rows, ordered concatenation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ByteType, DataType, IntegerType, LongType, MapType, ShortType, StructType, VariantType

from speechset.session import materialize, new_folder

# A piece of consecutive integer keys holds at most this many rows, unless the table is so large that
# it would need more than MAX_PIECES of them; then pieces grow.
PIECE_ROWS = 1 << 17
MAX_PIECES = 50_000
# Integer keys are called dense while they span at most this many times the row count.
MAX_SPAN_RATIO = 16
# A sample of up to this many rows is numbered in one task.
SMALL_SAMPLE = 10_000
# Bins that a larger sample's digests are counted in.
DIGEST_BINS = 1 << 16


def quoted(name: str) -> Column:
    """A column by its whole name, which may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def can_be_hashed(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(can_be_hashed(f.dataType) for f in kind)
    if isinstance(kind, ArrayType):
        return can_be_hashed(kind.elementType)
    return not isinstance(kind, (MapType, VariantType))


def content_hash(df: DataFrame, leave: Sequence[str] = ()) -> Column:
    """A hash of a row's columns; those that Spark cannot hash, such as maps, count by their JSON text."""
    fields = [f for f in df.schema if f.name not in leave]
    parts = [quoted(f.name) if can_be_hashed(f.dataType) else F.to_json(F.struct(quoted(f.name).alias("c"))) for f in fields]
    return F.xxhash64(*(parts or [F.lit(0)]))


def dense_positions(
    df: DataFrame,
    order_by: str | Sequence[str],
    partition_by: Sequence[str] = (),
    out: str = "pos",
    piece_rows: int = PIECE_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """Add the 0-based position of each row within its group, in ``order_by`` order.

    ``order_by`` must be unique within a group. A group may hold most of the table: it is cut into
    ordered pieces that are numbered in parallel, and each piece is shifted by the size of the
    pieces before it. One dense integer key is cut into equal key ranges (three passes over the
    input: bounds, sizes, rows); any other key is cut by range partitioning. Either way no row is
    lost: null keys come first, in any order among themselves.
    """
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    groups = list(partition_by)
    if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, (ByteType, ShortType, IntegerType, LongType)):
        key = quoted(keys[0])
        low, high, filled, rows = df.agg(F.min(key), F.max(key), F.count(key), F.count(F.lit(1))).first()
        low, high = low or 0, high or 0
        span = high - low + 1
        if span <= MAX_SPAN_RATIO * max(filled, piece_rows):
            width = max(piece_rows, -(-span // MAX_PIECES))
            return _by_key_range(df, keys[0], groups, out, low, width, -(-(rows - filled) // piece_rows))
    return _by_range_partition(df, keys, groups, out, partitions, piece_rows)


def _group(groups: list[str]) -> Column:
    """The group columns as one value that is never null, so that plain equality and the window's
    own partitioning serve the join as well."""
    return F.struct(*map(quoted, groups)) if groups else F.lit(0)


def _shift(numbered: DataFrame, sizes: DataFrame, out: str) -> DataFrame:
    """Add to each piece-local position the number of rows in the group's earlier pieces. ``sizes``
    has a row per piece: it is broadcast if it turns out small, and else merged without moving the
    rows, which are already partitioned and sorted by piece."""
    earlier = Window.partitionBy("_group").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    offsets = sizes.select("_group", "_piece", (before - F.col("_first")).alias("_offset"))
    placed = numbered.join(offsets, ["_group", "_piece"])
    position = (F.col("_local") + F.col("_offset")).cast("bigint")
    keep = [quoted(c) for c in numbered.columns if c not in ("_group", "_piece", "_local", "_row")]
    return placed.select(*keep, position.alias(out))


def _by_key_range(
    df: DataFrame, key: str, groups: list[str], out: str, low: int, width: int, null_pieces: int
) -> DataFrame:
    """Rows without a key are dealt over ``null_pieces`` pieces before the first range, by a number that is stored with
    them, since even equal rows must lie in several pieces and stay there when a task runs again."""
    without = F.lit(-1).cast("bigint")
    if null_pieces > 1:
        df = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        without = F.col("_row") % null_pieces - null_pieces
    piece = F.coalesce(F.expr(f"(`{key.replace('`', '``')}` - {low}L) div {width}L"), without)
    pieces = df.withColumns({"_group": _group(groups), "_piece": piece})
    sizes = pieces.groupBy("_group", "_piece").agg(F.count(F.lit(1)).alias("_rows"), F.lit(0).alias("_first"))
    inside = Window.partitionBy("_group", "_piece").orderBy(quoted(key))
    return _shift(pieces.withColumn("_local", F.row_number().over(inside) - 1), sizes, out)


def _by_range_partition(
    df: DataFrame, keys: list[str], groups: list[str], out: str, partitions: int | None, piece_rows: int
) -> DataFrame:
    """Range-partition once and keep the result as a table: sampled bounds differ between two runs,
    so the sizes and the rows must come from the same one."""
    spark = df.sparkSession
    # As many partitions as the rows need, and never fewer than the session would use.
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // piece_rows))
    path = new_folder(spark, "ordered")
    order = [quoted(c) for c in (*groups, *keys)]
    ordered = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # The upper 31 bits of this id number the partition, the lower 33 the row inside it.
    ordered.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    numbered = spark.read.parquet(path).select(
        *map(quoted, df.columns),
        _group(groups).alias("_group"),
        F.shiftright("_id", 33).alias("_piece"),
        F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_local"),
    )
    sizes = numbered.groupBy("_group", "_piece").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_local").alias("_first")
    )
    return _shift(numbered, sizes, out)


def concat_in_order(
    df: DataFrame, split_column: str, splits: Sequence[str], order_by: str, out: str = "global_pos"
) -> DataFrame:
    """Number the rows of the listed splits as one table: the splits in the given order, and inside
    a split by ``order_by``. Rows of other splits are left out."""
    chosen = df.where(F.col(split_column).isin(*splits))
    placed = dense_positions(chosen, order_by, [split_column], "_in_split")
    rank = F.array_position(F.array(*[F.lit(s) for s in splits]), F.col(split_column)).cast("int")
    sizes = chosen.groupBy(split_column).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_rank", rank)
    # One row per listed split, so this window and the broadcast stay at most len(splits) rows.
    earlier = Window.partitionBy(F.lit(0)).orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(split_column, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    return (
        placed.join(F.broadcast(starts), split_column)
        .withColumn(out, F.col("_in_split") + F.col("_start"))
        .drop("_in_split", "_start")
    )


def first_rows(df: DataFrame, n: int | None, order_by: str | Sequence[str]) -> DataFrame:
    """The first ``n`` rows; the whole table if ``n`` is None or 0."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*keys).limit(n) if n else df


def first_per_group(df: DataFrame, n: int, groups: Sequence[str], order_by: str, out: str = "pos") -> DataFrame:
    """The first ``n`` rows of each group with their position. Every task passes on at most ``n``
    rows per group, so a dominant group is cut down before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(order_by))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).select("*", (F.col("_rank") - 1).cast("bigint").alias(out)).drop("_rank")


def seeded_sample(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """``n`` rows in a shuffled order that depends on the seed and the key alone, with their place in
    it as ``selected_id``: the same rows on any cluster and partitioning. Rows without a key come first."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), quoted(key).cast("string")))
    placed = df.withColumn("_digest", digest)
    if n > SMALL_SAMPLE:
        return large_sample(df, n, key, seed)
    picked = placed.orderBy("_digest", quoted(key)).limit(n)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_digest", quoted(key)))  # n rows only
    return picked.withColumn("selected_id", (place - 1).cast("bigint")).drop("_digest")


def large_sample(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """``seeded_sample`` for any ``n``: the digests are counted in bins. Rows of the bins before the one that ``n`` falls into are
    in, rows of that one are put in order, and all are numbered in pieces, so no task holds more than a piece of the sample."""
    placed = df.withColumn("_digest", F.md5(F.concat(F.lit(f"{seed}:"), quoted(key).cast("string"))))
    bin_of = F.coalesce(F.conv(F.substr("_digest", F.lit(1), F.lit(4)), 16, 10).cast("int"), F.lit(-1))
    binned = placed.withColumn("_bin", bin_of)
    counts = binned.groupBy("_bin").agg(F.count(F.lit(1)).alias("_rows"))  # at most DIGEST_BINS + 1
    so_far = F.sum("_rows").over(Window.partitionBy(F.lit(0)).orderBy("_bin"))
    edge = counts.withColumn("_to", so_far).where(F.col("_to") >= n).orderBy("_bin").select("_bin", (F.col("_to") - F.col("_rows")).alias("_before")).first()
    if edge is None:
        picked = binned
    else:
        rest = binned.where(F.col("_bin") == edge["_bin"]).orderBy("_digest", quoted(key)).limit(n - edge["_before"])
        picked = binned.where(F.col("_bin") < edge["_bin"]).unionByName(rest)
    return dense_positions(picked.drop("_bin"), ["_digest", key], out="selected_id").drop("_digest")
