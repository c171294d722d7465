"""Find the splits of an output folder and publish them as one dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechset.functions.audio import AUDIO_TYPE, declare_audio
from speechset.functions.text import has_text
from speechset.operators.shape import audio_path_columns, publishable, union_splits
from speechset.plans.build_clips import finished_clips, last_records
from speechset.session import bounded_rows
from speechset.sinks.publish import dataset_manifest, embed_audio, write_dataset
from speechset.sources.files import discover_splits, list_metadata
from speechset.sources.metadata import read_metadata_csv


def load_published_form(spark: SparkSession, folder: str) -> DataFrame:
    """All splits found below ``folder``, in published form, with a ``split`` column.

    Every split has its own header, so the driver opens one reader per split; it sees the list of
    splits (short, and checked), never their rows.
    """
    found = bounded_rows(discover_splits(list_metadata(spark, folder)))
    if not found:
        raise FileNotFoundError(f"no split metadata below {folder}")
    splits = {}
    for row in found:
        home = f"{folder}/{row['folder']}" if row["folder"] else folder
        splits[row["split"]] = publishable(read_metadata_csv(spark, f"{home}/{row['file']}"), home)
    return union_splits(splits)


def publish_dataset(spark: SparkSession, folder: str, target: str, embed: bool = False, rate: int | None = None) -> DataFrame:
    """Write the dataset to ``target/data`` and its manifest to ``target/manifest``; returns the
    manifest. With ``embed`` the audio files are read into the dataset, in columns that declare ``rate``."""
    dataset = load_published_form(spark, folder)
    paths = audio_path_columns(dataset)
    if embed:
        for column in paths:
            dataset = declare_audio(embed_audio(dataset, column), column, rate)
    write_dataset(dataset, f"{target}/data", rebalance=not embed)
    written = spark.read.parquet(f"{target}/data")
    manifest = dataset_manifest(written, paths=paths)
    manifest.write.mode("overwrite").json(f"{target}/manifest")
    return manifest


def publish_built(
    spark: SparkSession, splits: dict[str, str], target: str, rate: int | None = None, sources: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Publish split folders as ``build_split`` left them, audio included, to ``target/data``; returns the
    manifest, which is also written to ``target/manifest``.

    ``splits`` names the folder of each split. A split has the rows of its last build, failed ones with
    their error and no clip; clips of keys that its input no longer has stay out, and so do columns that begin with an
    underscore. The audio goes from the stored clips into the dataset without a file per clip. ``sources`` gives the
    utterances of a split with ``_key`` and ``audio``: their audio is published as ``audio_en``, which is left out
    without them, since paths of files that were never written say nothing. ``rate`` is declared in the clips' column. The manifest counts
    rates, not samples. (For splits in buckets, and for publishing in versions, see ``publish_versions``.)
    """
    parts = []
    for split, folder in sorted(splits.items()):
        records, clips = last_records(spark, folder), finished_clips(spark, folder)
        if records is None or clips is None:
            continue
        named = records.drop("audio_en", "cloned_audio_fr")
        wanted = records.where(has_text(F.col("cloned_audio_fr"))).select("_key")
        made = clips.join(wanted, "_key", "left_semi").select(*named.columns, F.col("clip").alias("cloned_audio_fr"))
        failed = named.join(wanted, "_key", "left_anti").withColumn("cloned_audio_fr", F.lit(None).cast(AUDIO_TYPE))
        rows = made.unionByName(failed)
        if sources and split in sources:
            source = sources[split].select("_key", F.col("audio").cast(AUDIO_TYPE).alias("audio_en"))
            rows = declare_audio(rows.join(source, "_key", "left"), "audio_en")
        parts.append(rows.withColumn("split", F.lit(split)))
    if not parts:
        raise FileNotFoundError(f"no built clips in {sorted(splits.values())}")
    dataset = parts[0]
    for part in parts[1:]:
        dataset = dataset.unionByName(part, allowMissingColumns=True)
    dataset = dataset.drop(*[c for c in dataset.columns if c.startswith("_")])
    write_dataset(declare_audio(dataset, "cloned_audio_fr", rate), f"{target}/data", rebalance=False)
    written = spark.read.parquet(f"{target}/data")
    counted = written.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("cloned_audio_fr.sampling_rate").alias("n_cloned_audio_fr")
    )
    counted.write.mode("overwrite").json(f"{target}/manifest")
    return counted
