"""Publishing in whole versions: readers see one version or the next, never a part of one.

``target/parts/v=N`` holds the rows that version N wrote, in folders by split and bucket of the key. ``target/versions/N`` is its
manifest: for every bucket of every split the version that holds its rows, with a digest of them. ``target/CURRENT`` names
the version readers use, and is replaced in one step after everything else is there. A publication writes only the buckets whose digest
changed; what a failed one left behind is in no manifest, and its failure is a row of ``target/failures``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from speechset.functions.audio import AUDIO_TYPE, declare_audio
from speechset.plans.build_steps import current_clips, step_of
from speechset.session import file_system, materialize, small_table
from speechset.sinks.bucketed import read_bucketed

BUCKET_ROWS = 2_000
MAX_BUCKETS = 10_000

_MANIFEST = "split string, bucket int, n_rows bigint, mixed bigint, total bigint, v int"
_ABOUT = "buckets int, columns string"


def current_version(spark: SparkSession, target: str) -> int | None:
    """The version that readers see; None before the first."""
    try:
        return int(spark.read.text(f"{target}/CURRENT").first()[0])
    except PySparkException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _switch(target: str, version: int) -> None:
    """Replace the pointer by a rename, which a reader sees before or after, not between."""
    store, path = file_system(f"{target}/CURRENT")
    spark = SparkSession.active()
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs
    fresh = fs.Path(f"{target}/.CURRENT-{uuid.uuid4().hex}")
    out = store.create(fresh, True)
    out.write(bytearray(f"{version}\n".encode()))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    overwrite[0] = getattr(fs, "Options$Rename").OVERWRITE
    context = fs.FileContext.getFileContext(store.makeQualified(path).toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    context.rename(store.makeQualified(fresh), store.makeQualified(path), overwrite)


def _new_version(spark: SparkSession, target: str) -> int:
    """A number above all that were ever begun, failed ones too."""
    store, path = file_system(f"{target}/parts")
    if not store.exists(path):
        return 1
    begun = [status.getPath().getName() for status in store.listStatus(path)]  # one entry a version
    return 1 + max((int(name.removeprefix("v=")) for name in begun if name.startswith("v=")), default=0)


def _about(spark: SparkSession, target: str, version: int) -> tuple[int, str]:
    return tuple(spark.read.schema(_ABOUT).json(f"{target}/about/{version}").first())


def version_manifest(spark: SparkSession, target: str, version: int) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(f"{target}/versions/{version}")


def _comparable(df: DataFrame, leave: Sequence[str]) -> list[str]:
    """Columns that tell whether a row changed: all but nested ones, such as audio."""
    return [f.name for f in df.schema if f.name not in leave and not isinstance(f.dataType, (ArrayType, MapType, StructType))]


def publish_version(dataset: DataFrame, target: str, key: str = "_key", split: str = "split", buckets: int | None = None) -> int | None:
    """Publish ``dataset`` as the next version: its splits replace those of the same name, other splits stay as they are. Returns
    the version that readers see from now on.

    Rows are told apart by their plain columns; a nested column, such as audio, must change together with one of them (a run, a path,
    a digest). Columns that begin with an underscore count for this and are not published. If anything fails, readers keep the version
    they have, the failure is a row of ``target/failures``, and it is raised.
    """
    spark = dataset.sparkSession
    version = _new_version(spark, target)
    try:
        return _publish(dataset, target, key, split, buckets, version)
    except Exception as failure:
        row = small_table(spark, [(version, time.time(), f"{type(failure).__name__}: {failure}"[:2000])], "v int, at double, report string")
        row.write.mode("append").json(f"{target}/failures")
        raise


def _publish(dataset: DataFrame, target: str, key: str, split: str, buckets: int | None, version: int) -> int | None:
    spark = dataset.sparkSession
    before = current_version(spark, target)
    if before is not None:
        buckets = _about(spark, target, before)[0]
    elif buckets is None:
        buckets = min(MAX_BUCKETS, max(1, -(-dataset.count() // BUCKET_ROWS)))
    placed = dataset.withColumns({"bucket": step_of(F.col(key).cast("string"), buckets), "_split": F.coalesce(F.col(split).cast("string"), F.lit(""))})
    placed = placed.withColumn("bucket", F.coalesce("bucket", F.lit(0)))
    content = F.xxhash64(*[F.col(f"`{c}`") for c in _comparable(dataset, [])])
    sizes = placed.groupBy(F.col("_split").alias("split"), "bucket").agg(
        F.count(F.lit(1)).alias("n_rows"), F.bit_xor(content).alias("mixed"), F.sum(F.shiftright(content, 33)).alias("total")
    )
    sizes = materialize(sizes, "digests")
    same = ["split", "bucket", "n_rows", "mixed", "total"]
    published = [f for f in dataset.schema if not f.name.startswith("_") and f.name != split]
    columns = StructType(published).toDDL()
    if before is not None and _about(spark, target, before)[1] == columns:
        old = version_manifest(spark, target, before)
        kept = sizes.join(old, same)
    else:
        old = small_table(spark, [], _MANIFEST)
        kept = old
    changed = sizes.join(kept.select("split", "bucket"), ["split", "bucket"], "left_anti")
    other = old.join(sizes.select("split").distinct(), "split", "left_anti")
    manifest = materialize(
        kept.select(*same, "v").unionByName(changed.withColumn("v", F.lit(version))).unionByName(other.select(*same, "v")), "manifest"
    )
    own = changed.select(F.col("split").alias("_split"), "bucket")
    rows = placed.join(own, ["_split", "bucket"], "left_semi").select(*[F.col(f"`{f.name}`") for f in published], F.col("_split").alias("split"), "bucket")
    rows.write.partitionBy("split", "bucket").parquet(f"{target}/parts/v={version}")
    _require_whole(spark, target, version, manifest.where(F.col("v") == version))
    small_table(spark, [(buckets, columns)], _ABOUT).coalesce(1).write.json(f"{target}/about/{version}")
    manifest.coalesce(1).write.parquet(f"{target}/versions/{version}")
    _switch(target, version)
    return version


def _require_whole(spark: SparkSession, target: str, version: int, expected: DataFrame) -> None:
    """The buckets that were written have the rows that were counted."""
    if expected.limit(1).count() == 0:
        return
    written = spark.read.schema("split string, bucket int").parquet(f"{target}/parts/v={version}")
    counts = written.groupBy("split", "bucket").agg(F.count(F.lit(1)).alias("n"))
    both = expected.join(counts, ["split", "bucket"], "full").where("NOT (n <=> n_rows)")
    wrong = both.count()
    if wrong:
        raise RuntimeError(f"{wrong} buckets were not written whole")


def read_published(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The rows of a published version with their ``split``; of the current one if None. Only the folders that the manifest
    names are read."""
    version = current_version(spark, target) if version is None else version
    if version is None:
        raise FileNotFoundError(f"nothing is published in {target}")
    columns = StructType.fromDDL(_about(spark, target, version)[1])
    schema = StructType.fromDDL("v int, split string, bucket int")
    # The condition holds for every row: it tells Spark that the manifest selects, so that it prunes folders by it.
    manifest = version_manifest(spark, target, version).select("v", "split", "bucket").where(F.col("v") <= version)
    stored = spark.read.schema(StructType([*columns.fields, *schema.fields])).parquet(f"{target}/parts")
    return stored.join(manifest, ["v", "split", "bucket"], "left_semi").select(*[f"`{c}`" for c in columns.names], "split")


def built_dataset(spark: SparkSession, corpus: str, folder: str, split: str, rate: int | None = None) -> DataFrame:
    """What ``build_in_steps`` left of a split, ready to publish: every utterance of the present input, failed ones with their
    error, with source audio and cloned clip. Both lie in buckets of the key and meet where they are. ``rate`` is
    declared for the cloned clips."""
    utterances, clips = read_bucketed(spark, corpus), read_bucketed(spark, f"{folder}/clips")
    if utterances is None:
        raise FileNotFoundError(f"no stored utterances in {corpus}")
    source = utterances.drop("_step", "error", "cloned_audio_fr", "audio_en").withColumnRenamed("audio", "audio_en")
    if clips is None:
        null = {"cloned_audio_fr": F.lit(None).cast(AUDIO_TYPE), "error": F.lit(""), "_run": F.lit(""), "_tried": F.lit(False)}
        rows = source.withColumns(null)
    else:
        made = current_clips(utterances, clips).select(
            "_key", F.col("clip").alias("cloned_audio_fr"), "error", F.col("run").alias("_run"), F.lit(True).alias("_tried")
        )
        rows = source.join(made.hint("shuffle_hash"), "_key", "left").fillna({"error": "", "_run": "", "_tried": False})
    typed = declare_audio(declare_audio(rows, "audio_en"), "cloned_audio_fr", rate)
    return typed.withColumn("split", F.lit(split))


def publish_splits(spark: SparkSession, splits: Mapping[str, tuple[str, str]], target: str, rate: int | None = None) -> DataFrame:
    """Publish the splits one after the other, each as a version of its own, as far as they are built: ``split, version, report``. A
    split that fails is a row with the reason, and the others go on. ``splits`` has (corpus, folder) by name, as few as a dataset has."""
    report = []
    for name, (corpus, folder) in splits.items():
        try:
            report.append((name, publish_version(built_dataset(spark, corpus, folder, name, rate), target), "published"))
        except Exception as failure:
            report.append((name, None, f"{type(failure).__name__}: {failure}"[:2000]))
    return small_table(spark, report, "split string, version int, report string")
