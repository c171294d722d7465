"""Ranked lexical search by buckets of vectors of like length (LEMP).

A document is a vector of term impacts, a query the vector of its terms' weights, and the score is their inner
product. Both sides are multiplied by the square root of the weight, so that frequent terms add little length.

* Documents are ordered by the length of their vector, over the terms that any query of the block has, by a
  range partitioning, so that a bucket (some thousand documents in a row of a task) holds vectors of about the same length.
* By Cauchy and Schwarz no score in a bucket exceeds the query's length times the longest vector's. A bucket
  below the query's threshold, the score of its k-th best document so far, is passed over.
* Inside a bucket the heaviest coordinates of the query are multiplied out; what the other coordinates can add is at
  most the product of the lengths that are left. Documents below the threshold go.
* The survivors are scored exactly, in 64-bit integers.

The threshold starts from the exact scores of the ``SEEDS`` longest vectors, and rises in each task as it goes from
long to short vectors. Bounds carry a margin for the rounding of doubles, and a document is passed over only if its bound
is strictly below the threshold, so the result is exact.

Queries go in blocks of bounded vocabulary, each with a pass over the documents: the vocabulary and weights are all that is
broadcast. Nothing is keyed by term, so frequent words make no hot key; equal vectors are ordered by a running number
besides, so that copies are cut over partitions too.

Cases: terms are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z lower-cased. A null or
termless text has none and counts for nothing. Every row is a document of its own, also if it repeats another; equal scores
go by ascending id, rows without an id last. Rows with the same item id (a null one too) are one item with all their terms.
An item without terms, or whose terms occur nowhere, has no result. Empty tables give an empty result. Other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from speechset.llm.frames import quoted, slices, texts
from speechset.llm.words import Words, column_bytes, hash_ranges
from speechset.session import materialize, small_table

# A block of queries: as many as these limits allow, and one at least.
BLOCK_ITEMS = 1024
BLOCK_TERMS = 1 << 16
BLOCK_BYTES = 4 << 20
# Longest vectors that give the first thresholds.
SEEDS = 1024
# Share of a query's squared length that its focus coordinates hold.
FOCUS = 0.5
# Documents of a task that searches, and coordinates of a bucket.
TASK_ROWS = 100_000
BUCKET_TERMS = 1 << 19

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_TO_TERMS = np.full(256, 32, np.uint8)  # separators become spaces
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _TO_TERMS[_low : _high + 1] = np.arange(_low, _high + 1)
_TO_TERMS[0x41:0x5B] += 32


def term_words(column: pa.Array) -> Words:
    """The terms of a column of texts."""
    data, offsets = column_bytes(column)
    plain = _TO_TERMS[data].tobytes()
    return Words(pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(plain)))


class Vocabulary:
    """Terms by number; ``find`` numbers the words of a column, by hash and then byte by byte."""

    def __init__(self, terms: list[str]):
        words = Words(pa.array(terms, pa.large_string()))
        hashes = words.hashes()
        order = np.argsort(hashes, kind="stable")
        self.number, self.hashes = order, hashes[order]
        self.data, self.start, self.size = words.data, words.start[order], (words.end - words.start)[order]

    def find(self, words: Words) -> np.ndarray:
        """The number of each word, -1 where it is none of the terms."""
        hashes = hash_ranges(words.data, words.start, words.end)
        out = np.full(len(hashes), -1, np.int64)
        if not len(self.hashes) or not len(hashes):
            return out
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        met = np.flatnonzero(self.hashes[at] == hashes)
        same = _equal(words.data, words.start[met], words.end[met] - words.start[met], self.data, self.start[at[met]], self.size[at[met]])
        out[met[same]] = self.number[at[met[same]]]
        return out


def _equal(a: np.ndarray, a_start: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_start: np.ndarray, b_size: np.ndarray) -> np.ndarray:
    """Which byte ranges of ``a`` equal those of ``b``, eight bytes a step."""
    same = a_size == b_size
    pad = np.zeros(8, np.uint8)
    a_at = np.ndarray((len(a) + 1,), np.dtype("<u8"), np.concatenate([a, pad]), strides=(1,))
    b_at = np.ndarray((len(b) + 1,), np.dtype("<u8"), np.concatenate([b, pad]), strides=(1,))
    masks = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
    left, done = np.flatnonzero(same & (a_size > 0)), 0
    while len(left):
        mask = masks[np.minimum(a_size[left] - done, 8)]
        ok = ((a_at[a_start[left] + done] ^ b_at[b_start[left] + done]) & mask) == 0
        same[left[~ok]] = False
        done += 8
        left = left[ok]
        left = left[a_size[left] > done]
    return same


def _count_terms(vocabulary: Vocabulary):
    """Per document: the number of its terms, and how often each term of the vocabulary occurs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A number for each row that no other has, the same when the task runs again.
        n_before, size = TaskContext.get().partitionId() << 33, len(vocabulary.hashes)
        for batch in slices(batches):
            words = term_words(batch.column("text"))
            term = vocabulary.find(words)
            known = np.flatnonzero(term >= 0)
            pairs, tf = np.unique(words.row[known] * max(size, 1) + term[known], return_counts=True)
            rows, terms = pairs // max(size, 1), pairs % max(size, 1)
            offsets = np.searchsorted(rows, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_before + np.arange(batch.num_rows)),
                    pa.array(words.count.astype(np.int64)),
                    pa.ListArray.from_arrays(offsets, pa.array(terms.astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int64))),
                ],
                names=["doc_id", "place", "n", "terms", "tfs"],
            )
            n_before += batch.num_rows

    return run


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _impacts(weights: np.ndarray, n_docs: int, n_terms: int):
    """Vectors of the terms whose weight is above 0: impacts, and the length of the weighted vector."""
    root = np.sqrt(weights.astype(np.float64))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, offsets = _flat(batch.column("terms"))
            tf, _ = _flat(batch.column("tfs"))
            n = batch.column("n").to_numpy()
            m = 100 - 50 + (50 * n * n_docs) // max(n_terms, 1)
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[row])
            used = weights[terms] > 0
            row, terms, impact = row[used], terms[used], impact[used]
            squares = np.bincount(row, (impact * root[terms]) ** 2, batch.num_rows)
            keep = np.flatnonzero(squares > 0)
            if not len(keep):
                continue
            first = np.searchsorted(row, np.arange(batch.num_rows + 1))
            sizes = np.diff(first)[keep]
            inside = np.isin(row, keep)
            starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(keep)),
                    batch.column("place").take(pa.array(keep)),
                    pa.array(np.sqrt(squares[keep])),
                    pa.ListArray.from_arrays(starts, pa.array(terms[inside].astype(np.int32))),
                    pa.ListArray.from_arrays(starts, pa.array(impact[inside].astype(np.int32))),
                ],
                names=["doc_id", "place", "length", "terms", "impacts"],
            )

    return run


class Best:
    """The ``k`` best documents of a query so far; ``floor`` is what another one must reach."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, floor
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.missing = np.zeros(0, bool)

    def add(self, score: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        self.score, self.id, self.missing = (np.concatenate(p) for p in ((self.score, score), (self.id, ids), (self.missing, missing)))
        if len(self.score) > self.k:
            best = np.lexsort((self.id, self.missing, -self.score))[: self.k]
            self.score, self.id, self.missing = self.score[best], self.id[best], self.missing[best]
        if len(self.score) == self.k:
            self.floor = max(self.floor, int(self.score.min()))


class Query:
    """A query's terms, heaviest first, with the length of what each start leaves over."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray):
        own = weights[terms]
        order = np.argsort(-own, kind="stable")
        order = order[own[order] > 0]
        self.terms, self.weights = terms[order], own[order]
        total = float(self.weights.sum())  # the squared length: roots of weights are the coordinates
        self.length = np.sqrt(total)
        self.n_focus = int(np.searchsorted(np.cumsum(self.weights), FOCUS * total) + 1) if total else 0
        self.rest = np.sqrt(max(total - float(self.weights[: self.n_focus].sum()), 0.0))


# Bounds are sums of doubles; they are taken this much larger.
MARGIN = 1 + 1e-9


def _buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds ``BUCKET_TERMS`` coordinates at most, or a single longer vector."""
    for batch in batches:
        ends = _flat(batch.column("terms"))[1][1:]
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + BUCKET_TERMS, "right")))
            yield batch.slice(at, to - at)
            at = to


def _search(queries: list[np.ndarray], weights: np.ndarray, floors: list[int], k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = [Query(terms, weights) for terms in queries]
        best = [Best(k, floor) for floor in floors]
        root = np.sqrt(weights.astype(np.float64))
        for batch in _buckets(batches):
            n = batch.num_rows
            length = batch.column("length").to_numpy()
            ids = batch.column("doc_id")
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            terms, offsets = _flat(batch.column("terms"))
            impact = _flat(batch.column("impacts"))[0].astype(np.int64)
            row = np.repeat(np.arange(n), np.diff(offsets))
            order = np.argsort(terms, kind="stable")
            terms, impact, row = terms[order], impact[order], row[order]
            first = np.searchsorted(terms, np.arange(len(weights) + 1))
            longest, squared = length.max(), length**2
            for query, top in zip(asked, best):
                if query.length * longest * MARGIN < max(top.floor, 1):
                    continue  # Cauchy and Schwarz, for the whole bucket
                partial, used = np.zeros(n), np.zeros(n)
                for term, weight in zip(query.terms[: query.n_focus], query.weights):
                    at = slice(first[term], first[term + 1])
                    partial[row[at]] += impact[at] * float(weight)
                    used[row[at]] += (impact[at] * root[term]) ** 2
                bound = partial + query.rest * np.sqrt(np.maximum(squared * MARGIN - used, 0))
                alive = bound * MARGIN >= max(top.floor, 1)
                if not alive.any():
                    continue
                score = np.zeros(n, np.int64)
                for term, weight in zip(query.terms, query.weights):
                    at = np.arange(first[term], first[term + 1])
                    at = at[alive[row[at]]]
                    score[row[at]] += impact[at] * int(weight)  # a document has a term once
                found = np.flatnonzero(alive & (score >= max(top.floor, 1)))
                if len(found):
                    top.add(score[found], ids[found], missing[found])
        for number, top in enumerate(best):
            if len(top.score):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(top.score), number, np.int32)),
                        pa.array(top.id, mask=top.missing),
                        pa.array(top.score),
                    ],
                    names=["query", "doc_id", "score"],
                )

    return run


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """Items as (id, terms), in blocks that the limits bound; the driver holds one block at a time."""
    plain = F.translate(quoted(text_col).cast("string"), _UPPER, _LOWER)
    terms = items.select(quoted(id_col).alias("item_id"), F.explode(F.regexp_extract_all(plain, F.lit(TERM), F.lit(0))).alias("term"))
    each = terms.distinct().groupBy("item_id").agg(F.array_sort(F.collect_set("term")).alias("terms"))
    block, known, size = [], set(), 0
    for item_id, own in materialize(each, "items").toLocalIterator():
        added = set(own) - known
        if block and (len(block) >= BLOCK_ITEMS or len(known) + len(added) > BLOCK_TERMS or size + sum(map(len, added)) > BLOCK_BYTES):
            yield block
            block, known, size, added = [], set(), 0, set(own)
        block.append((item_id, own))
        known |= added
        size += sum(map(len, added))
    if block:
        yield block


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", query_col: str = "text"
) -> DataFrame:
    """The ``k`` documents with the highest score above 0 for each item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    kind = items.select(quoted(item_col).alias("item_id")).schema["item_id"].dataType.simpleString()
    schema = f"item_id {kind}, rank int, doc_id bigint, score bigint"
    result = small_table(spark, [], schema)
    read = texts(docs, id_col, text_col)
    for block in _blocks(items, item_col, query_col):
        result = result.unionByName(_search_block(read, block, k, kind))
    return result


def _search_block(read: DataFrame, block: list[tuple], k: int, kind: str) -> DataFrame:
    spark = read.sparkSession
    names = sorted({term for _, own in block for term in own})
    number = {term: i for i, term in enumerate(names)}
    queries = [np.array([number[t] for t in own], np.int64) for _, own in block]
    counted = materialize(
        read.mapInArrow(_count_terms(Vocabulary(names)), "doc_id bigint, place bigint, n bigint, terms array<int>, tfs array<bigint>"), "terms"
    )
    n_docs, n_terms, n_rows = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    share = (F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)).alias("share")
    held = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = np.zeros(len(names), np.int64)
    for row in held.select("term", F.floor(1000 * F.ln(share)).alias("w")).collect():  # at most the block's terms
        weights[row["term"]] = row["w"]
    vectors = counted.mapInArrow(
        _impacts(weights, n_docs, n_terms), "doc_id bigint, place bigint, length double, terms array<int>, impacts array<int>"
    )
    found = "query int, doc_id bigint, score bigint"
    # The place of the last of them is enough to filter by: no vector is moved for it.
    longest = vectors.select("length", "place").orderBy(F.desc("length"), "place").limit(SEEDS)
    length, place = longest.agg(F.min(F.struct("length", -F.col("place"))).alias("last")).select("last.*").first()
    is_long = (F.col("length") > length) | ((F.col("length") == length) & (F.col("place") <= -(place or 0)))
    seeds = _top(vectors.where(is_long).mapInArrow(_search(queries, weights, [0] * len(queries), k), found), k)
    floors = [0] * len(queries)
    for row in seeds.where(F.col("rank") == k).collect():  # at most a row a query of the block
        floors[row["query"]] = row["score"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // TASK_ROWS))
    ordered = vectors.repartitionByRange(parts, F.desc("length"), F.col("place")).sortWithinPartitions(F.desc("length"))
    best = _top(ordered.mapInArrow(_search(queries, weights, floors, k), found), k)
    ids = small_table(spark, [(i, item_id) for i, (item_id, _) in enumerate(block)], f"query int, item_id {kind}")
    return best.join(F.broadcast(ids), "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
