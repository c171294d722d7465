"""Which keys were finished in earlier batches, without reading all keys that ever were.

Each batch leaves its finished keys and a Bloom filter of them, in blocks of ``BLOCK_BITS`` bits for about ``BLOCK_KEYS`` keys. A key is in
one block and sets ``HASHES`` bits there, so that a new key passes a filter about once in a hundred million times. Arriving keys meet one
block of each batch; only batches where one of them passes have their keys read, and only those settle it. So the keys read for a
batch depend on how many of its rows came before, not on how long the history is; of the history every batch reads five bytes a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from speechset.session import LIST_ROWS, file_system, materialize

BLOCK_BITS = 1 << 15  # what Spark's bitmaps hold
BLOCK_KEYS = 800
HASHES = 20

_FILTERS = "blocks bigint, block bigint, bits binary, batch_id bigint"


def _position(key: Column, i: Column) -> Column:
    return F.pmod(F.xxhash64(key, i), F.lit(BLOCK_BITS)).cast("int")


def _hashes() -> Column:
    return F.sequence(F.lit(0), F.lit(HASHES - 1))


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), blocks)


def _has(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8) + 1, F.lit(1))), 16, 10).cast("bigint")
    return F.getbit(byte, position % 8) == 1


def remember(keys: DataFrame, index: str, batch_id: int) -> None:
    """Keep the finished ``key`` values of a batch, in place of what an earlier try of it left; null keys are never finished."""
    spark = keys.sparkSession
    own = keys.select(F.col("key").cast("string").alias("key")).where("key IS NOT NULL")
    n, blocks = keys.count(), 1
    while blocks * BLOCK_KEYS < n:
        blocks *= 2
    place = f"{index}/keys/batch_id={batch_id}"
    placed = own.distinct().withColumn("block", _block(F.col("key"), F.lit(blocks).cast("bigint")))
    placed.sortWithinPartitions("block").write.mode("overwrite").parquet(place)
    stored = spark.read.schema("key string, block bigint").parquet(place)
    bits = stored.select("block", F.explode(F.transform(_hashes(), lambda i: _position(F.col("key"), i))).alias("at"))
    filters = bits.groupBy("block").agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("at") + 1)).alias("bits"))
    # Filters come last: a batch that has them is whole.
    filters.select(F.lit(blocks).cast("bigint").alias("blocks"), "block", "bits").write.mode("overwrite").parquet(f"{index}/filters/batch_id={batch_id}")


def remembered(spark: SparkSession, index: str) -> set[int]:
    """The batches whose filters are whole; one entry a batch."""
    store, place = file_system(f"{index}/filters")
    jvm = spark._jvm
    if not store.exists(place):
        return set()
    found = [status.getPath() for status in store.listStatus(place) if status.isDirectory()]
    done = [p.getName() for p in found if store.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return {int(name.removeprefix("batch_id=")) for name in done if name.startswith("batch_id=")}


def look_up(keys: DataFrame, index: str, batch_id: int) -> tuple[DataFrame, DataFrame]:
    """Those ``key`` values that another batch than ``batch_id`` finished, and the stored keys that are read to know it."""
    spark = keys.sparkSession
    others = sorted(remembered(spark, index) - {batch_id})
    arriving = keys.select(F.col("key").cast("string").alias("key")).where("key IS NOT NULL").distinct()
    if not others:
        return arriving.limit(0), arriving.limit(0)
    filters = spark.read.schema(_FILTERS).parquet(f"{index}/filters").where(F.col("batch_id") != batch_id)
    sizes = [r[0] for r in filters.select("blocks").distinct().collect()]  # powers of two
    probes = arriving.select("key", F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes])).alias("blocks"))
    probes = probes.withColumn("block", _block(F.col("key"), F.col("blocks")))
    passing = F.forall(_hashes(), lambda i: _has(F.col("bits"), _position(F.col("key"), i)))  # ends at the first bit that is not set
    hits = materialize(probes.join(filters, ["blocks", "block"]).where(passing).select("key", "block", "batch_id"), "hits")
    met = [r[0] for r in hits.select("batch_id").distinct().limit(LIST_ROWS + 1).collect()]
    stored = spark.read.schema("key string, block bigint, batch_id bigint").parquet(f"{index}/keys")
    # A short list prunes folders; with a long one the join alone decides.
    read = stored.where(F.col("batch_id").isin(met)) if len(met) <= LIST_ROWS else stored
    return read.join(hits, ["batch_id", "block", "key"], "left_semi").select("key").distinct(), read.select("key")


def finished_before(keys: DataFrame, index: str, batch_id: int) -> DataFrame:
    return look_up(keys, index, batch_id)[0]
