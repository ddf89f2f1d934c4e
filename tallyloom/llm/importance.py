"""Importance resampling of documents towards a target corpus.

Features are runs of one to ``n`` neighbouring words, hashed into buckets. Tasks count buckets of both corpora; the
counts, one number per bucket, become an array of gains (how much likelier a bucket is in the target, in thousandths of a
natural logarithm) that every task indexes with its features. A document's weight is its mean gain; with Gumbel noise drawn from a hash
of its id, the highest scores are a sample without replacement in proportion to exp(weight / 1000).

The cutoff is found without sorting the corpus. A quantile sketch of the scores gives a bracket around the wanted place;
exact counts of the scores outside of it tell whether it holds that place, and it is widened until it does. Only
rows in the bracket are sorted. Drawn rows get their ranks from a range partitioning, so no task holds them all.

Cases. Null or word-free text: no features, weight 0. A null id draws its noise as the text ``null``. Repeated rows count as often
as they occur; equal scores are ordered by id (null last), then by the place at which the row was written, so that the
number drawn is exact. Empty tables give no rows; an empty target gives gains from its smoothing alone. Texts of any length are read
whole. All columns are kept in ``doc``, so no name can clash.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import ROW, map_batches, schema_of, written

#: A-Z become small, other ASCII than letters and digits separates words, bytes of other characters belong to them.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Most features whose bucket a worker remembers at a time.
REMEMBERED = 500_000


class Buckets(dict):
    """Bucket of a feature, remembered; ``room`` forgets them all when there are too many."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found

    def room(self) -> None:
        if len(self) > REMEMBERED:
            self.clear()

    def of(self, text: str | None, n: int) -> tuple[np.ndarray, int]:
        """Buckets of all features of a text, and its number of words."""
        words = (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()
        self.room()
        found = list(map(self.__getitem__, words))
        for run in range(2, n + 1):
            found += [self[b" ".join(words[i : i + run])] for i in range(len(words) - run + 1)]
        return np.array(found, np.int64), len(words)


def bucket_counts(docs: DataFrame, text: Column, n: int, buckets: int) -> np.ndarray:
    """How many features of all rows fall into each bucket; what reaches the driver is one number per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(known.of(value.as_py(), n)[0], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], names=["bucket", "n"])

    counted = map_batches(docs.select(text.cast("string").alias("text")), count, "bucket: int, n: long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counted.collect():  # at most ``buckets`` rows
        out[r.bucket] = r.n
    return out


def bucket_gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """floor(1000 ln(smoothed share in the target over smoothed share in the source)) of each bucket."""
    t_all, s_all, k = int(target.sum()), int(source.sum()), len(target)
    ratio = ((int(t) + 1.0) * float(s_all + k) / ((int(s) + 1.0) * float(t_all + k)) for t, s in zip(target, source, strict=True))
    return np.array([math.floor(1000.0 * math.log(r)) for r in ratio], np.int64)


def with_weights(docs: DataFrame, gains: np.ndarray, text_col: str = "text", n: int = 1, keep: list[str] | None = None) -> DataFrame:
    """``doc`` (all columns or ``keep``), ``n_words``, ``n_features`` and ``weight``, the floored mean gain."""
    row = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias(ROW)
    rows = docs.select(row, F.col(f"`{text_col}`").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        known = Buckets(len(gain))
        for batch in batches:
            out = []
            for value in batch.column(1):
                found, words = known.of(value.as_py(), n)
                out.append((words, len(found), int(gain[found].sum()) // len(found) if len(found) else 0))
            columns = np.array(out, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names=[ROW, "n_words", "n_features", "weight"])

    return map_batches(rows, weigh, f"{schema_of(rows.select(ROW))}, n_words: long, n_features: long, weight: long")


def noisy(weight: Column, doc_id: Column, seed: int) -> Column:
    """Weight plus Gumbel noise in thousandths, from the first 32 bits of a hash of seed and id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return weight + F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def bracket(scores: DataFrame, score: str, wanted: int, total: int, accuracy: int = 1000) -> tuple[int, int, int]:
    """(low, high, rows above high) such that the ``wanted``-th highest of ``total`` scores lies from low to high.

    A quantile sketch proposes, exact counts outside the proposal decide; a side that misses is moved out twice as far each time,
    in the end to the extreme. Each round is one aggregate with map-side combine.
    """
    place, reach = 1 - wanted / total, [2.0 / accuracy, 2.0 / accuracy]
    while True:
        at = [max(0.0, place - reach[0]), min(1.0, place + reach[1])]
        low, high = scores.agg(F.percentile_approx(score, at, accuracy)).head()[0]
        low, high = (scores.agg(F.min(score)).head()[0] if at[0] == 0 else low), (scores.agg(F.max(score)).head()[0] if at[1] == 1 else high)
        above, below = scores.agg(F.count_if(F.col(score) > high), F.count_if(F.col(score) < low)).head()
        if above < wanted <= total - below:
            return low, high, above
        reach = [reach[0] * (2 if total - below < wanted else 1), reach[1] * (2 if above >= wanted else 1)]


def numbered(rows: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``rows`` with ``place`` 1, 2, 3, .. in ``order``: range partitions are sorted apart, and each starts after those before it."""
    held = [F.struct(*rows.columns).alias("held"), F.monotonically_increasing_id().alias("at")]
    laid = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*held), label)
    part = F.shiftright("at", 33)
    base, bases = 0, []
    for p, n in sorted(tuple(r) for r in laid.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()):  # one row per partition
        bases.append((p, base - (p << 33) + 1))
        base += n
    bases = rows.sparkSession.createDataFrame(bases, "p long, base long")
    return laid.join(F.broadcast(bases), part == F.col("p")).select("held.*", (F.col("at") + F.col("base")).alias("place"))


def draw(scored: DataFrame, eligible: Column, percent: int, doc_id: str, score: str = "score") -> DataFrame:
    """``scored`` with ``rank`` 1, 2, 3, .. for the floor(percent * N / 100) highest scores of N eligible rows, null for the rest."""
    marked = scored.select(F.struct(*scored.columns).alias("given"), F.col(score).alias("score"), F.col(doc_id).alias("id"), eligible.alias("may"), F.monotonically_increasing_id().alias("row"))
    rows = written(marked, "resampling-scores")
    able = rows.where("may").select("score", "id", "row")
    total = able.count()
    wanted = percent * total // 100
    nothing = F.lit(None).cast("long")
    if not wanted:
        return rows.select("given.*", nothing.alias("rank"))
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    low, high, above = bracket(able, "score", wanted, total)
    inside = numbered(able.where(F.col("score").between(low, high)), order, "resampling-bracket")
    last = inside.where(F.col("place") == wanted - above).head()
    earlier = F.coalesce(F.col("id") < last.id, F.lit(False)) if last.id is not None else F.col("id").isNotNull()
    tied = earlier | (F.col("id").eqNullSafe(F.lit(last.id)) & (F.col("row") <= last.row))
    drawn = F.col("may") & ((F.col("score") > last.score) | ((F.col("score") == last.score) & tied))
    ranked = numbered(rows.where(drawn).select("given", "score", "id", "row"), order, "resampling-drawn")
    rest = rows.where(~drawn).select("given.*", nothing.alias("rank"))
    return ranked.select("given.*", F.col("place").alias("rank")).unionByName(rest)


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    n: int = 1,
    buckets: int = 10_000,
    least_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
    keep: list[str] | None = None,
) -> DataFrame:
    """``doc``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` of every document.

    Statistics cover all rows of both tables; of the documents with at least ``least_words`` words, ``percent`` in a hundred are drawn.
    """
    if keep and doc_id not in keep:
        raise ValueError(f"keep must hold {doc_id}")
    source = bucket_counts(docs, F.col(f"`{text_col}`"), n, buckets)
    gains = bucket_gains(bucket_counts(target, F.col(f"`{target_col}`"), n, buckets), source)
    weighed = with_weights(docs, gains, text_col, n, keep)
    scored = weighed.withColumn("score", noisy(F.col("weight"), F.col(ROW)[doc_id], seed)).withColumn("_id", F.col(ROW)[doc_id])
    return draw(scored, F.col("n_words") >= least_words, percent, "_id").drop("_id")
