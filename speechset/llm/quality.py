"""Quality rules by robust multivariate outliers.

Each text becomes a vector of transformed statistics. For every language and source a minimum
covariance determinant estimate gives the centre and the scatter of the bulk of its texts; a text is
rejected when its Mahalanobis distance from that bulk is beyond the one that holds ``WITHIN_KEPT`` of any sample whose distances
have one peak. Those of texts have a longer tail than a normal sample's: one repeated line of a short text is far out.

* Statistics are plain counts of the whole text, made in numpy inside the tasks.
* The estimate runs in Spark over all texts: in each concentration step the half of the texts nearest to
  the present centre is found from a histogram of distances, and their sums are aggregated. Only sums
  and histograms are shuffled, whatever the size of a group. A half bears nearly as many outliers: the
  start is medians of values and of deviations, which a half cannot move either. At last all texts within
  the distance that holds ``WITHIN`` of a normal sample are summed (reweighting), so that the estimate
  rests on the whole bulk.
* Groups under ``MIN_GROUP`` texts are pooled by language, and still smaller pools over all languages.
  A pool under ``MIN_POOL`` texts gives no verdict: its texts are kept.

Cases: a null or wordless text has zero counts and fails the base rule. Null languages and sources are
groups like others. Repeated rows count once each. An empty table gives an empty result. Columns of
the input are kept as they are; results are added under the given name, which must be new.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from speechset.llm.frames import fresh, quoted, slices
from speechset.llm.words import Words, grams, hash_ranges, repeats, sums
from speechset.session import materialize

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_GROUP = 200
MIN_POOL = 40
SHARE = 0.5  # of a group's texts that determine the estimate
WITHIN = 0.975  # of a normal sample: as near as these a text takes part in the reweighted estimate
STEPS = 4
# Spread below which a difference never counts, per dimension: a floor under each standard deviation.
FLOORS = (0.06, 0.03, 0.03, 0.05, 0.05)
WITHIN_KEPT = 0.975  # of any sample with one peak: a text farther out than these is an outlier
BIN = 16  # histogram bins per factor e of the squared distance
_DIMENSIONS = len(FLOORS)

COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint, n_capitals bigint"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True


def count_text(column: pa.Array) -> list[np.ndarray]:
    """The counts of ``COUNTS`` for each text of an Arrow string column."""
    words = Words(column)
    data, offsets = words.data, words.offsets
    capital = (data >= 65) & (data <= 90)
    capital[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    # Lines: a boundary after each line feed and at each end of a row.
    feeds = np.flatnonzero(data == 10)
    filled = offsets[:-1][np.diff(offsets) > 0]
    begin = np.union1d(filled, feeds + 1)
    begin = begin[begin < len(data)]
    stop = np.concatenate([begin[1:], [len(data)]]).astype(np.int64)[: len(begin)]
    stop = stop - ((stop > begin) & (data[np.maximum(stop - 1, 0)] == 10) if len(data) else 0)
    with_word = np.searchsorted(words.start, stop) > np.searchsorted(words.start, begin)
    begin, stop = begin[with_word], stop[with_word]
    line_row = np.searchsorted(offsets, begin, "right") - 1
    copies, _ = repeats(hash_ranges(data, begin, stop), line_row)
    # Words in 3-word windows that occur again in the text.
    starts = words.fits(3)
    key = grams(words.hashes(), 3)[starts]
    _, twice = repeats(key, words.row[starts])
    step = np.zeros(len(words) + 3, np.int64)
    for i in range(3):
        step[starts[twice] + i] = 1
    n = len(words.count)
    return [
        words.count,
        sums(~words.space & ((data & 0xC0) != 0x80), offsets),
        sums(_SYMBOL[data], offsets),
        np.bincount(line_row[copies], minlength=n),
        sums(step[: len(words)], words.first),
        np.bincount(line_row, minlength=n),
        sums(capital, offsets),
    ]


def with_counts(df: DataFrame, text_col: str = "text", out: str = "counts") -> DataFrame:
    """Add the struct ``out`` of ``COUNTS`` to each row; the rows stay where they are."""
    text = fresh(df, "_text")
    wide = df.withColumn(text, quoted(text_col).cast("string"))
    names = list(df.columns)
    kinds = StructType.fromDDL(COUNTS)
    flat = [fresh(df, f"_{k.name}") for k in kinds]
    schema = StructType([*df.schema, *[StructField(f, k.dataType) for f, k in zip(flat, kinds)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            counts = [pa.array(c, pa.int64()) for c in count_text(part.column(text))]
            columns = [part.column(i) for i in range(len(names))] + counts
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *flat])

    fields = F.struct(*[F.col(f).alias(k.name) for f, k in zip(flat, kinds)])
    return wide.mapInArrow(run, schema).select(*[quoted(c) for c in names], fields.alias(out))


def base_failed(counts: Column) -> Column:
    """Too few words, or more than half of them in repeated 3-word windows."""
    return (counts["n_words"] < MIN_WORDS) | (
        100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]
    )


def vector(counts: Column) -> Column:
    """The transformed statistics: logarithms and square roots bring rates near to symmetric shapes."""
    words = F.greatest(counts["n_words"], F.lit(1)).cast("double")
    chars = F.greatest(counts["word_chars"], F.lit(1)).cast("double")
    lines = F.greatest(counts["n_lines"], F.lit(1)).cast("double")
    return F.array(
        F.log(chars / words),
        F.log1p(20 * counts["n_symbols"] / chars),
        counts["n_dup_lines"] / lines,
        F.sqrt(counts["n_repeat_words"] / words),
        F.log1p(5 * counts["n_capitals"] / chars),
    )


def fit(counted: DataFrame, lang: Column, source: Column, counts: Column) -> tuple[DataFrame, DataFrame]:
    """Two tables: the estimate of each group (``_g``, ``center``, ``inverse``, ``n``), and the group of
    each language and source that has texts (``_lang``, ``_source``, ``_g``). Null-safe keys inside."""
    keyed = counted.where(~base_failed(counts)).select(
        _key(lang).alias("_lang"), _key(source).alias("_source"), vector(counts).alias("x")
    )
    stored = materialize(keyed, "vectors")
    sizes = stored.groupBy("_lang", "_source").agg(F.count(F.lit(1)).alias("_n"))
    small = F.col("_n") < MIN_GROUP
    pools = sizes.where(small).groupBy("_lang").agg(F.sum("_n").alias("_pool"))
    named = materialize(
        sizes.join(pools, "_lang", "left").select(
            "_lang",
            "_source",
            F.when(~small, F.concat("_lang", F.lit("\x1f"), "_source"))
            .when(F.col("_pool") >= MIN_GROUP, F.col("_lang"))
            .otherwise(F.lit(""))
            .alias("_g"),
            "_n",
        ),
        "groups",
    )
    enough = named.groupBy("_g").agg(F.sum("_n").alias("_all")).where(F.col("_all") >= MIN_POOL)
    groups = named.join(materialize(enough.select("_g"), "pools"), "_g").select("_lang", "_source", "_g")
    # Estimates and cutoffs are stored, a row a group: so Spark knows their size and, while it is small,
    # leaves the rows of a large group where they are.
    rows = materialize(stored.join(groups, ["_lang", "_source"]).select("_g", "x"), "grouped")
    model = materialize(_medians(rows), "medians")
    for _ in range(STEPS):
        start = rows.join(model, "_g")
        near = start.select("_g", "x", squared(F.col("x")).alias("_d")).withColumn("_bin", _bin(F.col("_d")))
        near = near.join(materialize(_cutoffs(near), "cutoffs"), "_g").where(F.col("_bin") <= F.col("_cut"))
        model = materialize(_estimates(_moments(near), SHARE), "estimate")
    bulk = rows.join(model, "_g").where(squared(F.col("x")) <= _radius(WITHIN) ** 2).select("_g", "x")
    return materialize(_estimates(_moments(bulk), WITHIN), "estimate"), groups


def _key(column: Column) -> Column:
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), text))


def _bin(d: Column) -> Column:
    return F.floor(F.log(d + 1e-9) * BIN).cast("int")


def squared(x: Column, center: str = "center", inverse: str = "inverse") -> Column:
    """Squared Mahalanobis distance of ``x`` from ``center`` by ``inverse`` (row by row)."""
    k = _DIMENSIONS
    off = [x[i] - F.col(center)[i] for i in range(k)]
    terms = [off[i] * off[j] * F.col(inverse)[i * k + j] for i in range(k) for j in range(k)]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def _moments(rows: DataFrame) -> DataFrame:
    k, x = _DIMENSIONS, F.col("x")
    parts = [F.sum(x[i]) for i in range(k)] + [F.sum(x[i] * x[j]) for i in range(k) for j in range(k)]
    return rows.groupBy("_g").agg(F.count(F.lit(1)).alias("n"), F.array(*parts).alias("s"))


def _medians(rows: DataFrame) -> DataFrame:
    """A start that nearly a half of outliers cannot move: medians, and spreads from the median deviations."""
    k = _DIMENSIONS
    middle = lambda value: F.percentile_approx(value, F.lit(0.5), F.lit(2000))
    points = rows.groupBy("_g").agg(F.array(*[middle(F.col("x")[i]) for i in range(k)]).alias("center"))
    points = materialize(points, "centers")
    spreads = rows.join(points, "_g").groupBy("_g").agg(
        F.array(*[middle(F.abs(F.col("x")[i] - F.col("center")[i])) for i in range(k)]).alias("_s")
    )
    spread = [F.greatest(F.col("_s")[i] * 1.4826, F.lit(FLOORS[i])) for i in range(k)]
    zero = F.lit(0.0)
    inverse = [1 / (spread[i] * spread[i]) if i == j else zero for i in range(k) for j in range(k)]
    return points.join(spreads, "_g").select("_g", "center", F.array(*inverse).alias("inverse"))


def _cutoffs(near: DataFrame) -> DataFrame:
    """Per group, the histogram bin with which ``SHARE`` of the rows is reached; as many bins as the
    logarithm of a distance has, however many rows."""
    from pyspark.sql import Window

    bins = near.groupBy("_g", "_bin").agg(F.count(F.lit(1)).alias("_in"))
    up = Window.partitionBy("_g").orderBy("_bin")
    run = bins.withColumn("_upto", F.sum("_in").over(up)).withColumn("_all", F.sum("_in").over(Window.partitionBy("_g")))
    return run.where(F.col("_upto") >= SHARE * F.col("_all")).groupBy("_g").agg(F.min("_bin").alias("_cut"))


def _estimates(moments: DataFrame, share: float) -> DataFrame:
    """Centre and inverse scatter of each group from the sums of its nearest ``share``: small matrices, a group a row."""
    correction = _correction(share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = _DIMENSIONS
        for batch in batches:
            n = batch.column("n").to_numpy()
            s = np.array(batch.column("s").to_pylist(), float).reshape(len(n), k + k * k)
            center = s[:, :k] / n[:, None]
            scatter = s[:, k:].reshape(-1, k, k) / n[:, None, None] - center[:, :, None] * center[:, None, :]
            # The nearest share of a normal sample spreads less than the whole: scale it back.
            scatter = scatter * correction + np.diag(np.square(FLOORS))
            inverse = np.linalg.inv(scatter) if len(n) else scatter
            yield pa.RecordBatch.from_arrays(
                [batch.column("_g"), pa.array(n), pa.array(center.tolist(), pa.list_(pa.float64())),
                 pa.array(inverse.reshape(-1, k * k).tolist(), pa.list_(pa.float64()))],
                names=["_g", "n", "center", "inverse"],
            )

    return moments.mapInArrow(run, "_g string, n bigint, center array<double>, inverse array<double>")


def _law() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The law of a normal sample's distances at a fixed grid (five degrees of freedom): distance, weight, mass up to it."""
    r = np.linspace(0, 8, 80001)
    weight = r ** (_DIMENSIONS - 1) * np.exp(-r * r / 2)
    return r, weight, np.cumsum(weight) / weight.sum()


def _radius(share: float) -> float:
    """The distance that holds ``share`` of a normal sample."""
    r, _, mass = _law()
    return float(r[np.searchsorted(mass, share)])


def _bound(share: float) -> float:
    """The distance that holds ``share`` of any sample whose distances have one peak, normal or not, by the inequality of Vysochanskij
    and Petunin about zero; the mean square of a distance is the number of dimensions."""
    return math.sqrt(4 / 9 * _DIMENSIONS / (1 - share))


def _correction(share: float) -> float:
    """Factor that makes the scatter of the nearest ``share`` consistent for normal data."""
    r, weight, mass = _law()
    inside = mass <= share
    mean_square = (r[inside] ** 2 * weight[inside]).sum() / weight[inside].sum()
    return _DIMENSIONS / mean_square


def judge(counted: DataFrame, model: DataFrame, groups: DataFrame, lang: Column, source: Column, counts: Column, out: str) -> DataFrame:
    """Add the struct ``out``: distance (null without an estimate), base_failed, kept."""
    keep = counted.columns
    names = {c: fresh(counted, c) for c in ("_lang", "_source", "center", "inverse")}
    known = groups.join(model, "_g").select(*[F.col(c).alias(name) for c, name in names.items()])
    keys = {names["_lang"]: _key(lang), names["_source"]: _key(source)}
    x = vector(counts)
    distance = F.sqrt(F.greatest(squared(x, names["center"], names["inverse"]), F.lit(0.0)))
    failed = base_failed(counts)
    verdict = F.struct(
        distance.alias("distance"),
        failed.alias("base_failed"),
        (~failed & (F.coalesce(distance, F.lit(0.0)) <= _bound(WITHIN_KEPT))).alias("kept"),
    )
    joined = counted.withColumns(keys).join(known, list(keys), "left")
    return joined.select(*[quoted(c) for c in keep], verdict.alias(out))


def quality(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Add counts and verdict of every row as the structs ``counts`` and ``verdict``. The estimate reads
    the texts once, the verdict a second time, so that no text is shuffled or stored."""
    lang, source = quoted(lang_col), quoted(source_col)
    counts, verdict = fresh(df, "counts"), fresh(df, "verdict")
    # The estimate works on three narrow columns whatever else the table holds.
    narrow = with_counts(df.select(lang.alias("l"), source.alias("s"), quoted(text_col).alias("t")), "t", "c")
    model, groups = fit(narrow.select("l", "s", "c"), F.col("l"), F.col("s"), F.col("c"))
    return judge(with_counts(df, text_col, counts), model, groups, lang, source, F.col(counts), verdict)


def quality_kept(df: DataFrame) -> DataFrame:
    """The rows that the rules keep, with the columns of the input."""
    judged = quality(df)
    verdict = fresh(df, "verdict")
    return judged.where(F.col(verdict)["kept"]).select(*[quoted(c) for c in df.columns])
