"""Toxicity by a small convolutional text classifier, trained in numpy.

A word (lower-cased, letters and digits only) is embedded as the sum of three hashed vectors: two by
different hashes of the word, one by its first four bytes. Filters over one, two and three words are
max-pooled over the whole text and feed a logistic output. Vectors start at zero, so unknown words have
no say, however long the text.

The classifier is fitted on the driver, on a bounded sample of labelled rows: up to ``POSITIVES`` and
``NEGATIVES`` texts of at most ``SAMPLE_CHARS`` characters, chosen by a hash of their id. A quarter of them is
kept out of the training. The scale of the score and the threshold of each language come from all labelled
rows that are neither held out nor trained on, whole texts, however many: Spark counts their outputs in
bins by language and label. Each label's counts are weighted to its share among all labelled rows that are
not held out, since the training takes more of the one than of the other. A language with fewer than
``LEAST`` of these rows of either label has no threshold of its own and takes ``PREDICTED_FROM``. A score
depends on the text alone; the language only chooses the threshold of the verdict.

Scoring is a pass over whole texts in Arrow batches, without a shuffle. The model is of fixed size.

Cases: without rows of both labels that are not trained on, the trained ones set scale and thresholds too.
Rows that repeat an id count once. Null and wordless texts get the score of a text without known words. Unlabelled and null labels
do not train. Without both labels in the sample every score is the share of the label that is there
(0 without any). A null id is scored like any other. Other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from speechset.llm.frames import fresh, give_back, quoted, slices
from speechset.llm.words import column_bytes, hash_ranges, mix
from speechset.session import small_table

POSITIVES, NEGATIVES = 2000, 3000
SAMPLE_CHARS = 20_000
BUCKETS = 1 << 16
SIZE = 8  # of an embedding
WIDTHS, FILTERS = (1, 2, 3), 8
EPOCHS, BATCH, RATE = 4, 32, 0.05
PREDICTED_FROM = 0.7
LEAST = 10  # rows of each label that give a language its own threshold
BINS, FINE = 4096, 256  # bins of outputs, and how many of them the classes' medians lie apart in the sample

_SPLIT = np.ones(256, bool)  # bytes that separate words: all but letters, digits and parts of UTF-8
_SPLIT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def buckets_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Three embedding rows for each word of a column, and the word offset of each text."""
    data, offsets = column_bytes(column)
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    # À-Þ (but ×) are the two bytes C3 80-9E; their small letters lie 32 higher.
    latin = np.zeros(len(data), bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    data = np.where(latin, data + np.uint8(32), data)
    split, n = _SPLIT[data], len(data)
    edge = np.ones(n + 1, bool)
    edge[1:n] = split[:-1]
    edge[offsets] = True
    start = np.flatnonzero(~split & edge[:n])
    edge = np.ones(n + 1, bool)
    edge[:n] = split
    edge[offsets] = True
    end = np.flatnonzero(~split & edge[1:]) + 1
    word = hash_ranges(data, start, end)
    prefix = hash_ranges(data, start, np.minimum(end, start + 4))
    rows = np.stack([word, mix(word), prefix ^ np.uint64(1)])
    return (rows % np.uint64(BUCKETS)).astype(np.int32), np.searchsorted(start, offsets)


@dataclass
class Classifier:
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((3, BUCKETS, SIZE), np.float32))
    filters: np.ndarray = None  # (words of all widths, SIZE, FILTERS)
    bias: np.ndarray = None
    weights: np.ndarray = None
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    constant: float | None = None

    def __post_init__(self):
        if self.filters is None:
            random = np.random.default_rng(5)
            self.filters = random.normal(0, 0.5, (sum(WIDTHS), SIZE, FILTERS)).astype(np.float32)
            self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
            self.weights = random.uniform(0.2, 0.6, len(WIDTHS) * FILTERS).astype(np.float32)

    def _maps(self, rows: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embeddings of all words, and the value of each filter at each word. A filter that reaches past
        the end of its text sees nothing there."""
        x = self.vectors[0][rows[0]] + self.vectors[1][rows[1]] + self.vectors[2][rows[2]]
        n = len(x)
        left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)  # words from here to the text's end
        out = np.empty((n, len(WIDTHS) * FILTERS), np.float32)
        at = 0
        for k, width in enumerate(WIDTHS):
            part = np.zeros((n, FILTERS), np.float32)
            for i in range(width):
                own = x[i:] @ self.filters[at + i]
                if i:
                    own *= (left[: n - i] > i)[:, None]
                part[: n - i] += own
            out[:, k * FILTERS : (k + 1) * FILTERS] = part
            at += width
        return x, out

    def raw(self, rows: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The output before the logistic function, for each text."""
        pooled = np.zeros((len(offsets) - 1, len(self.bias)), np.float32)
        full = np.flatnonzero(np.diff(offsets))
        if len(full):
            pooled[full] = np.maximum.reduceat(self._maps(rows, offsets)[1], offsets[full], axis=0)
        return np.maximum(pooled + self.bias, 0) @ self.weights

    def score(self, column: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(column), self.constant)
        z = self.raw(*buckets_of(column)).astype(float)
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -30, 30)))

    def train(self, texts: list[str], labels: np.ndarray) -> None:
        random = np.random.default_rng(6)
        coded = [buckets_of(pa.array([t], pa.string())) for t in texts]
        params = [self.filters, self.bias, self.weights, self.vectors]
        squares = [np.full_like(p, 1e-2) for p in params]
        out_shift, out_square = 0.0, 1e-2
        balance = np.where(labels == 1, len(labels) / (2 * labels.sum()), len(labels) / (2 * (len(labels) - labels.sum())))
        for _ in range(EPOCHS):
            order = random.permutation(len(texts))
            for b in range(0, len(order), BATCH):
                some = order[b : b + BATCH]
                rows = np.concatenate([coded[i][0] for i in some], axis=1)
                sizes = np.array([coded[i][0].shape[1] for i in some])
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                if not len(rows[0]):
                    continue
                x, maps = self._maps(rows, offsets)
                grads = [np.zeros_like(p) for p in params[:3]]
                touched: list[np.ndarray] = []
                pushes: list[np.ndarray] = []
                shift_grad = 0.0
                for j, i in enumerate(some):
                    a, z = offsets[j], offsets[j + 1]
                    if a == z:
                        continue
                    best = a + np.argmax(maps[a:z], axis=0)
                    value = maps[best, np.arange(len(best))] + self.bias
                    active = np.maximum(value, 0)
                    p = 1 / (1 + np.exp(-np.clip(active @ self.weights + out_shift, -30, 30)))
                    delta = float((p - labels[i]) * balance[i] / len(some))
                    shift_grad += delta
                    grads[2] += delta * active
                    # Leaky below zero, so that filters that see nothing yet still learn.
                    back = delta * self.weights * np.where(value > 0, 1.0, 0.1)
                    grads[1] += back * 0.1
                    at = 0
                    for k, width in enumerate(WIDTHS):
                        own, spots = back[k * FILTERS : (k + 1) * FILTERS], best[k * FILTERS : (k + 1) * FILTERS]
                        for s in range(width):
                            inside = spots + s < z
                            place = spots[inside] + s
                            grads[0][at + s][:, inside] += x[place].T * own[inside]
                            touched.append(place)
                            pushes.append((self.filters[at + s][:, inside] * own[inside]).T)
                        at += width
                for p, q, g in zip(params[:3], squares[:3], grads):
                    q += g * g
                    p -= RATE * g / np.sqrt(q)
                self.weights[:] = np.maximum(self.weights, 0.01)
                out_square += shift_grad**2
                out_shift -= RATE * shift_grad / np.sqrt(out_square)
                place, push = np.concatenate(touched), np.concatenate(pushes)
                for t in range(3):
                    rows_t, inverse = np.unique(rows[t][place], return_inverse=True)
                    total = np.zeros((len(rows_t), SIZE), np.float32)
                    np.add.at(total, inverse, push)
                    squares[3][t][rows_t] += total * total
                    self.vectors[t][rows_t] -= RATE * total / np.sqrt(squares[3][t][rows_t])
        self.shift = out_shift

    def calibrate(self, counts: list[tuple[str | None, int, int, int, int]], unit: float) -> None:
        """Set the scale of the score so that ``PREDICTED_FROM`` lies where the labels part best, and a
        threshold for each language in the same way. ``counts`` holds language, label, bin of ``unit``, and
        the number of rows there: all, and those not trained on."""
        own: dict[str, np.ndarray] = {}
        every = np.zeros((2, 2, BINS))  # all or not trained on; label; bin
        for lang, y, at, *found in counts:
            every[:, y, at] += found
            if lang is not None:
                own.setdefault(lang, np.zeros((2, 2, BINS)))[:, y, at] += found
        free = int(every[1].sum(axis=1).min() > 0)
        share = lambda c: c[free] * (c[0].sum(axis=1) / c[free].sum(axis=1))[:, None]
        cut, width = best_cut(share(every))
        self.scale = 8.0 / max(width * unit, 1e-6)
        self.shift = float(np.log(PREDICTED_FROM / (1 - PREDICTED_FROM)) - self.scale * cut * unit)
        for lang, mine in sorted(own.items()):
            if mine[free].sum(axis=1).min() >= LEAST:
                z = self.scale * best_cut(share(mine))[0] * unit + self.shift
                self.thresholds[lang] = float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def best_cut(counts: np.ndarray) -> tuple[float, float]:
    """From the weights of both labels (0, 1) in each bin: the place, in bins, that parts the labels with the
    best F1, in the middle of the widest empty stretch with that F1, and the distance between the classes' medians."""
    bins = np.flatnonzero(counts.sum(axis=0))
    other, toxic = counts[:, bins]
    above = lambda x: x[::-1].cumsum()[::-1]  # at or above each bin
    f1 = 2 * above(toxic) / (above(toxic + other) + toxic.sum())
    before = np.concatenate([[bins[0] - FINE], bins[:-1] + 1])  # where the bin below ends
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    i = best[np.argmax((bins - before)[best])]
    median = [bins[np.searchsorted(c.cumsum(), c.sum() / 2)] for c in (other, toxic)]
    return float((bins[i] + before[i]) / 2), float(abs(median[1] - median[0]))


def held_out(id_column: Column) -> Column:
    """Rows whose label is never used: the id's checksum leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic") -> Classifier:
    """Train on the bounded sample of rows that are not held out, calibrate on all others that are not."""
    known = labels.select(quoted(id_col).cast("bigint").alias("i"), quoted(label_col).cast("int").alias("y"))
    known = known.where(F.col("y").isin(0, 1) & F.col("i").isNotNull() & ~held_out(F.col("i")))
    known = known.groupBy("i").agg(F.max("y").alias("y"))
    order = [F.xxhash64("i", F.lit(11)), F.col("i")]
    size = F.char_length(quoted(text_col).cast("string"))
    sized = docs.where(size <= SAMPLE_CHARS).select(quoted(id_col).cast("bigint").alias("i")).distinct().join(known, "i")
    picked = [sized.where(F.col("y") == y).orderBy(*order).limit(n) for y, n in ((1, POSITIVES), (0, NEGATIVES))]
    sample = picked[0].unionByName(picked[1])
    # At most POSITIVES + NEGATIVES ids are broadcast.
    texts = docs.select(quoted(id_col).cast("bigint").alias("i"), quoted(text_col).cast("string").alias("t"), quoted(lang_col).cast("string").alias("l"))
    found = texts.where(F.char_length("t") <= SAMPLE_CHARS).join(F.broadcast(sample), "i").dropDuplicates(["i"])
    rows = sorted(found.toArrow().to_pylist(), key=lambda r: r["i"])
    model = Classifier()
    y = np.array([r["y"] for r in rows], float)
    if not len(y) or y.min() == y.max():
        model.constant = float(y.mean()) if len(y) else 0.0
        return model
    apart = np.array([mix(np.array([r["i"]], np.int64).astype(np.uint64))[0] % 4 == 0 for r in rows])
    if min(y[apart].sum(), (1 - y[apart]).sum(), y[~apart].sum(), (1 - y[~apart]).sum()) < 1:
        apart = np.zeros(len(y), bool)
    train = np.flatnonzero(~apart)
    model.train([rows[i]["t"] for i in train], y[train])
    give_back()
    z = np.concatenate([model.raw(*buckets_of(pa.array([r["t"]], pa.string()))) for r in rows]).astype(float)
    unit = max(abs(np.median(z[y == 1]) - np.median(z[y == 0])), np.ptp(z) / 16, 1e-6) / FINE
    # At most POSITIVES + NEGATIVES ids are broadcast.
    ids = [rows[i]["i"] for i in train]
    del rows, found  # the texts of the sample
    give_back()
    taken = small_table(docs.sparkSession, [(i,) for i in ids], "i bigint").withColumn("taken", F.lit(1))
    scored = _binned(texts.where(F.col("i").isNotNull() & ~held_out(F.col("i"))), model, unit)
    once = scored.join(known, "i").groupBy("i").agg(F.min(F.struct("bin", "l", "y")).alias("s")).select("i", "s.*")
    marked = once.join(F.broadcast(taken), "i", "left")
    # As many rows as languages, labels and bins come to the driver.
    counts = marked.groupBy("l", "y", "bin").agg(F.count(F.lit(1)), F.sum(F.when(F.col("taken").isNull(), 1).otherwise(0)))
    model.calibrate([tuple(c) for c in counts.collect()], unit)
    return model


def _binned(rows: DataFrame, model: Classifier, unit: float) -> DataFrame:
    """i, l and the bin of the output of each text t; rows stay where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "t"):
            bins = np.clip(np.floor(model.raw(*buckets_of(part.column("t"))).astype(float) / unit), 0, BINS - 1)
            yield pa.RecordBatch.from_arrays([part.column("i"), part.column("l"), pa.array(bins.astype(np.int32))], names=["i", "l", "bin"])

    return rows.mapInArrow(run, "i bigint, l string, bin int")


def with_scores(df: DataFrame, model: Classifier, text_col: str = "text", out: str = "score") -> DataFrame:
    """Add the score of each text; rows stay where they are."""
    text = fresh(df, "_text")
    names = list(df.columns)
    wide = df.withColumn(text, quoted(text_col).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            scores = pa.array(model.score(part.column(text)), pa.float64())
            yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(names))] + [scores], names=[*names, out])

    return wide.mapInArrow(run, StructType([*df.schema, StructField(out, DoubleType())]))


def is_toxic(model: Classifier, score: Column, lang: Column) -> Column:
    """The verdict: the score reaches the threshold of the language."""
    limit = F.lit(PREDICTED_FROM)
    for name, value in model.thresholds.items():
        limit = F.when(lang.eqNullSafe(F.lit(name)), F.lit(value)).otherwise(limit)
    return score >= limit


def without_toxic(df: DataFrame, model: Classifier, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows that are not toxic, with the columns of the input."""
    score = fresh(df, "score")
    scored = with_scores(df, model, text_col, score)
    return scored.where(~is_toxic(model, F.col(score), quoted(lang_col))).select(*[quoted(c) for c in df.columns])
