"""Facts of audio files from their headers, and long files in blocks, by reading byte ranges."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechset.functions.audio import decode_frames, resample_margin, resample_span, resampled_bounds, wav_format
from speechset.session import qualified
from speechset.sinks.audio_files import open_filesystem
from speechset.sources.files import list_files

# Files a task opens, and samples of a block: a megabyte of floats.
FILES_PER_TASK = 2_000
BLOCK_FRAMES = 1 << 18

_HEADER = "sampling_rate int, channels int, bits int, kind int, data_start bigint, n_frames bigint, header_bytes bigint, error string"


class _Counting:
    """A file that counts what is read from it."""

    def __init__(self, source):
        self.source, self.count = source, 0

    def at(self, place: int, size: int) -> bytes:
        self.source.seek(place)
        found = self.source.read(size)
        self.count += len(found)
        return found


def parse_header(read: Callable[[int, int], bytes], length: int) -> tuple[int, int, int, int, int, int]:
    """``rate, channels, bits, kind, data start, frames`` of a WAV file, from its chunk heads and format chunk alone. A data
    chunk without a size, or with one past the end, goes to the end of the file."""
    start = read(0, 12)
    if start[:4] != b"RIFF" or start[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, form = 12, None
    while at + 8 <= length:
        head = read(at, 8)
        name, size = head[:4], int.from_bytes(head[4:8], "little")
        if name == b"fmt ":
            form = wav_format(read(at + 8, min(size, 40)))
        if name == b"data":
            if form is None:
                break
            kind, channels, rate, bits = form
            if size == 0 or size == 0xFFFFFFFF or at + 8 + size > length:
                size = length - at - 8
            return rate, channels, bits, kind, at + 8, size // (channels * (bits // 8))
        at += 8 + size + (size & 1)
    raise ValueError("a WAV file without format or data")


def _header_rows(home: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_filesystem(home)
        for batch in batches:
            rows = []
            for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
                source = None
                try:
                    with store.open_input_file(f"{base}/{path}") as opened:
                        source = _Counting(opened)
                        rate, channels, bits, kind, start, frames = parse_header(source.at, length)
                    rows.append((rate, channels, bits, kind, start, frames, source.count, ""))
                except Exception as failure:
                    rows.append((None,) * 6 + (source.count if source else 0, f"{type(failure).__name__}: {failure}"))
            kinds = [pa.int32()] * 4 + [pa.int64()] * 3 + [pa.string()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            names = [field.split(" ")[0] for field in _HEADER.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), *columns], names=["path", "length", *names])

    return run


def read_audio_headers(spark: SparkSession, root: str, pattern: str = "*.wav", tasks: int | None = None) -> DataFrame:
    """``path, length, sampling_rate, channels, bits, n_frames, seconds, header_bytes, error`` of the audio files below ``root``.

    No samples are read: ``header_bytes`` says how many bytes were, some dozens a file however long it is. A file that is no
    audio keeps its row, with the reason. ``tasks`` deals the files to tasks; without it a listing of few tasks stays as it is."""
    facts = _headers(spark, root, pattern, tasks)
    seconds = F.col("n_frames") / F.col("sampling_rate")
    return facts.select("path", "length", "sampling_rate", "channels", "bits", "n_frames", seconds.alias("seconds"), "header_bytes", "error")


def _headers(spark: SparkSession, root: str, pattern: str, tasks: int | None) -> DataFrame:
    found = list_files(spark, root, pattern)
    found = found.repartition(tasks, "path") if tasks else found
    return found.mapInArrow(_header_rows(qualified(root)), f"path string, length bigint, {_HEADER}")


def _block_rows(home: str, target: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_filesystem(home)
        for batch in batches:
            for row in batch.to_pylist():
                yield _block(store, base, row, target)

    return run


def _block(store, base: str, row: dict, target: int | None) -> pa.RecordBatch:
    """A block of a file, mixed to one channel, and resampled if ``target`` is another rate."""
    first, rate, array, error = row["first"], row["sampling_rate"], None, row["error"]
    if not error:
        try:
            changed = target is not None and target != rate
            margin = resample_margin(rate, target) if changed else 0
            low, high = max(first - margin, 0), min(first + row["frames"] + margin, row["n_frames"])
            frame = row["channels"] * (row["bits"] // 8)
            with store.open_input_file(f"{base}/{row['path']}") as source:
                source.seek(row["data_start"] + low * frame)
                raw = source.read((high - low) * frame)
            array = decode_frames(raw, row["kind"], row["channels"], row["bits"])
            if changed:
                start, stop = resampled_bounds(first, row["frames"], rate, target)
                array, first, rate = resample_span(array, low, start, stop, rate, target), start, target
        except Exception as failure:
            array, error = None, f"{type(failure).__name__}: {failure}"
    return pa.RecordBatch.from_arrays(
        [
            pa.array([row["path"]]),
            pa.array([row["block"]], pa.int64()),
            pa.array([first], pa.int64()),
            pa.array([array if array is None else np.asarray(array, np.float32)], pa.list_(pa.float32())),
            pa.array([rate], pa.int32()),
            pa.array([error], pa.string()),
        ],
        names=["path", "block", "first", "array", "sampling_rate", "error"],
    )


def read_audio_blocks(
    spark: SparkSession, root: str, target: int | None = None, pattern: str = "*.wav", block_frames: int = BLOCK_FRAMES, tasks: int | None = None
) -> DataFrame:
    """The audio files below ``root`` in blocks: ``path, block, first, array, sampling_rate, error``, where ``first`` is the place
    of a block's first sample in its clip.

    A file of any length is read by several tasks, each by byte ranges; memory is that of a block. With ``target`` the blocks are
    resampled: each one reads as far over its edges as the filter needs, so that the blocks of a clip in order are the
    resampled clip. A file without samples has one empty block; one that is no audio has a row with the reason."""
    facts = _headers(spark, root, pattern, tasks)
    last = F.greatest(F.ceil(F.coalesce("n_frames", F.lit(0)) / block_frames) - 1, F.lit(0)).cast("bigint")
    blocks = facts.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    blocks = blocks.withColumn("first", F.col("block") * block_frames)
    frames = F.least(F.lit(block_frames), F.col("n_frames") - F.col("first")).cast("bigint")
    work = blocks.select("path", "block", "first", frames.alias("frames"), "sampling_rate", "channels", "bits", "kind", "data_start", "n_frames", "error")
    # Blocks weigh little until they are read: dealt out, so that a long file is not one task's.
    n = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = work.repartition(n, "path", "block")
    schema = "path string, block bigint, first bigint, array array<float>, sampling_rate int, error string"
    return dealt.mapInArrow(_block_rows(qualified(root), target), schema)
