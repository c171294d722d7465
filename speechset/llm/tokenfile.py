"""Token files: the ids of all documents in ascending id order, range-coded in blocks.

A file is a Parquet table in a folder, a row per block of ``rangecoder.BLOCK`` ids: ``part`` (a range of
document ids), ``block`` in it, ``n_ids``, ``checksum`` (of payload and ids), ``payload``, and the documents
that begin in the block: ``doc_ids``, ``doc_starts`` (the place of their first id in the block). A document goes on
through blocks of its part until the next one begins; a part never shares a document with another.
Each block is coded from an empty model, so any block can be read alone; ``read_blocks`` does.

Spark's writer commits the table, so a lost executor's blocks are written again. Reading checks each
block against its checksum and fails on a difference.

Cases: a null or empty text is one end id. A null document id comes first. Rows that repeat an id follow
each other by a hash of their text. An empty table gives an empty file. Other columns are not stored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from speechset.llm.frames import slices, texts
from speechset.llm.rangecoder import BLOCK, LANES, checksum, decode_blocks, encode_blocks
from speechset.llm.tokens import encoder

SCHEMA = "part int, block int, n_ids int, checksum bigint, payload binary, doc_ids array<bigint>, doc_starts array<int>"


def write_tokens(df: DataFrame, path: str, vocabulary: str, end: int, spaces: str = "dropped", id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> None:
    """Encode every whole text, append ``end`` and write the file. One shuffle, of the texts."""
    docs = texts(df, id_col, text_col).withColumn("_tie", F.xxhash64("text"))
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.repartitionByRange(n, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, spaces).encode_all
        last = int(end).to_bytes(4, "little")
        part, block = TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        size, begun = 0, []  # ids held, and the documents that begin among them
        for batch in slices(batches):
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text"))):
                data = own + last
                begun.append((doc_id, size))
                held.append(data)
                size += len(data) // 4
                while size >= BLOCK * LANES:
                    ids = np.frombuffer(b"".join(held), "<u4")
                    whole = BLOCK * LANES
                    yield _blocks(part, block, ids[:whole], [b for b in begun if b[1] < whole])
                    block += LANES
                    held, size = [ids[whole:].tobytes()], size - whole
                    begun = [(d, at - whole) for d, at in begun if at >= whole]
        if size:
            yield _blocks(part, block, np.frombuffer(b"".join(held), "<u4"), begun)

    ordered.mapInArrow(run, SCHEMA).write.parquet(path)


def _blocks(part: int, first: int, ids: np.ndarray, begun: list[tuple]) -> pa.RecordBatch:
    cut = [ids[i : i + BLOCK] for i in range(0, len(ids), BLOCK)]
    payloads = encode_blocks(cut)
    docs: list[list] = [[] for _ in cut]
    starts: list[list[int]] = [[] for _ in cut]
    for doc_id, at in begun:
        docs[at // BLOCK].append(doc_id)
        starts[at // BLOCK].append(at % BLOCK)
    return pa.RecordBatch.from_arrays(
        [pa.array([part] * len(cut), pa.int32()), pa.array(range(first, first + len(cut)), pa.int32()),
         pa.array([len(c) for c in cut], pa.int32()), pa.array([checksum(p, c) for p, c in zip(payloads, cut)], pa.int64()),
         pa.array(payloads, pa.binary()), pa.array(docs, pa.list_(pa.int64())), pa.array(starts, pa.list_(pa.int32()))],
        names=["part", "block", "n_ids", "checksum", "payload", "doc_ids", "doc_starts"],
    )


def _decoded(batch: pa.RecordBatch) -> list[np.ndarray]:
    payloads, sizes = batch.column("payload").to_pylist(), batch.column("n_ids").to_pylist()
    found = decode_blocks(payloads, sizes)
    for payload, ids, kept in zip(payloads, found, batch.column("checksum").to_pylist()):
        if checksum(payload, ids) != kept:
            raise ValueError("a block of a token file does not fit its checksum")
    return found


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """part, block, and the ids of each block; blocks are read alone, in any order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids = pa.array([i.tolist() for i in _decoded(batch)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("block"), ids], names=["part", "block", "ids"])

    return spark.read.schema(SCHEMA).parquet(path).mapInArrow(run, "part int, block int, ids array<bigint>")


def read_documents(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 of each document, from the
    decoded file; with ``ids`` also the ids, as little-endian unsigned 32-bit integers."""
    stored = spark.read.schema(SCHEMA).parquet(path)
    # A row a part: ids of the parts before. The window holds as many rows as the file has parts.
    sizes = stored.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("bigint").alias("first"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = stored.join(firsts, "part").repartition(n, "part").sortWithinPartitions("part", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_doc: list | None = None  # doc_id, start, ids so far
        part, at = None, 0
        for batch in batches:
            done: list[tuple] = []
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_pylist() for c in ("part", "first", "doc_ids", "doc_starts")]
            for found, p, first, docs, starts in zip(_decoded(batch), *columns):
                if p != part:
                    if open_doc:
                        done.append(_close(open_doc))
                    open_doc, part, at = None, p, first
                ends = [*starts, len(found)]
                if ends[0] and open_doc:
                    open_doc[2].append(found[: ends[0]])
                for doc_id, a, b in zip(docs, starts, ends[1:]):
                    if open_doc:
                        done.append(_close(open_doc))
                    open_doc = [doc_id, at + a, [found[a:b]]]
                at += len(found)
            yield _documents(done, ids)
        if open_doc:
            yield _documents([_close(open_doc)], ids)

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * ids
    return ordered.select("part", "first", "n_ids", "checksum", "payload", "doc_ids", "doc_starts").mapInArrow(run, schema)


def _close(doc: list) -> tuple:
    data = np.concatenate(doc[2]).astype("<u4").tobytes()
    return doc[0], doc[1], len(data) // 4, zlib.crc32(data), data


def _documents(rows: list[tuple], ids: bool) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
    kinds = [pa.int64()] * 4 + [pa.binary()]
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)][: 4 + ids], names=names[: 4 + ids])
