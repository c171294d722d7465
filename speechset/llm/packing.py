"""Best-fit packing of documents into sequences of a fixed number of tokens.

Bulk-synchronous best-fit: documents and gaps are sorted by size; in each sweep all documents of a
size look for their successor, the smallest gap that holds them; each gap takes one of them, by rank;
the gaps are updated and the sweep repeats, until documents without any gap open new sequences.
Sizes go from the largest down.

Sizes are whole numbers up to the capacity, so documents of one size are a class, and gaps that arose
together are a run of consecutive sequences. A sweep moves whole ranges of ranks into whole runs. The
table of these moves depends on the number of sizes, not on the number of documents (at most a few for
each pair of sizes), so it is made from the counts alone. The documents themselves stay distributed: a
range sort by size gives each its rank in its class, whatever share of them has that size, and a join
with the moves gives it its sequence and offset.

Cases: a null or empty text is one end token. Texts longer than a sequence are cut into full ones, with
the remainder first. Null and repeated ids are documents of their own. An empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speechset.llm.frames import give_back, slices, texts
from speechset.llm.tokens import encoder
from speechset.operators.positions import dense_positions
from speechset.session import materialize, small_table

CAPACITY = 2048
END = 0


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END, ids: bool = False) -> DataFrame:
    """Encode each text, add the end token and cut what is longer than a sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary, "joined")
        last = int(end).to_bytes(4, "little")
        for part in slices(batches):
            rows: list[tuple] = []
            for doc_id, own in zip(part.column("doc_id").to_pylist(), words.encode_all(part.column("text"))):
                data = own + last
                n = len(data) // 4
                start = 0
                for piece in range(-(-n // capacity)):
                    stop = n - capacity * (-(-n // capacity) - 1 - piece)
                    own = data[4 * start : 4 * stop]
                    rows.append((doc_id, piece, start, stop - start, zlib.crc32(own), own))
                    start = stop
            columns = list(zip(*rows))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns[: 5 + ids], kinds)], names=names[: 5 + ids]
            )
        words.rest()
        give_back(False)

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * ids
    return docs.mapInArrow(run, schema)


def best_fit_moves(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Sweeps over classes of sizes. Moves (size, first rank, last rank, first sequence, offset), and the
    number of sequences: rank r of the class goes to sequence first + r - first rank."""
    runs: dict[int, deque[tuple[int, int]]] = defaultdict(deque)  # gap size: runs of sequences with that gap
    gaps: list[int] = []  # sizes that have runs, ascending
    moves: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def leave(gap: int, first: int, n: int) -> None:
        if gap:
            if not runs[gap]:
                insort(gaps, gap)
            runs[gap].append((first, n))

    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            at = bisect_left(gaps, size)  # the successor
            if at == len(gaps):
                # As many new sequences as these documents fill, or one; later sweeps find the rest of them.
                first, n, gap = opened, max(left // (capacity // size), 1), capacity
                opened += n
            else:
                gap = gaps[at]
                first, held = runs[gap].popleft()
                n = min(left, held)  # one document for each gap, by rank
                if held > n:
                    runs[gap].appendleft((first + n, held - n))
                elif not runs[gap]:
                    gaps.pop(at)
            moves.append((size, rank, rank + n - 1, first, capacity - gap))
            leave(gap - size, first, n)
            rank, left = rank + n, left - n
    return moves, opened


def pack(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END, ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and with ``ids`` the
    ids as little-endian unsigned 32-bit integers."""
    spark = df.sparkSession
    cut = pieces(texts(df, id_col, text_col), vocabulary, capacity, end, ids)
    names = cut.columns
    # Stored with a number for each piece, so that the ids stay where they are until their place is known.
    cut = materialize(cut.withColumn("_at", F.monotonically_increasing_id()), "pieces")
    # At most ``capacity`` rows come to the driver.
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    moves, _ = best_fit_moves(counts, capacity)
    table = small_table(spark, moves, "size bigint, low bigint, high bigint, first bigint, offset bigint")
    ranked = dense_positions(cut.drop("ids"), ["doc_id", "piece"], ["length"], "_rank")
    place = (F.col("length") == F.col("size")) & F.col("_rank").between(F.col("low"), F.col("high"))
    sequence = (F.col("first") + F.col("_rank") - F.col("low")).alias("sequence_id")
    placed = ranked.join(F.broadcast(table), place)
    if not ids:
        return placed.select(*names, sequence, "offset")
    # One shuffle of the ids, at any size; the places are the side that is hashed.
    return cut.join(placed.select("_at", sequence, "offset").hint("shuffle_hash"), "_at").select(*names, "sequence_id", "offset")
