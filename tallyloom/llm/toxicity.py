"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; other documents are unlabelled, with an unknown share of toxic ones among
them. With class prior p, losses l+ and l- (logistic), the risk of a score z is

    p * mean_P l+(z)  +  max(0, mean_U l-(z) - p * mean_P l-(z)),

whose second term estimates the risk on negatives and is not allowed below zero: where a batch makes it negative, the
step goes the other way, so that the classifier cannot fit the positives by memory. Features are the words of a
document, each once; words are chosen by how much more (or less) often positives hold them than unlabelled ones.

The classifier is fitted on a bounded sample: at most ``MOST_POSITIVE`` and ``MOST_UNLABELLED`` documents, those with the
smallest hash of their id. Scoring covers every document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import ROW, map_batches, schema_of

MOST_POSITIVE, MOST_UNLABELLED, MOST_WORDS = 10_000, 20_000, 2_000
#: Words whose shares among positives and unlabelled documents differ by less than this many standard errors are noise.
LEAST_Z = 4.0
#: A-Z to lower case; other ASCII than letters and digits to a blank; bytes of other characters stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))


def words(text: bytes) -> set[bytes]:
    """Distinct words of a text."""
    return set(text.translate(_FOLD).split())


@dataclass
class Classifier:
    """Logistic model over the presence of words; without positives, a constant zero."""

    weights: dict[bytes, float] = field(default_factory=dict)
    bias: float = -np.inf

    def score(self, text: bytes) -> float:
        z = self.bias + sum(self.weights[w] for w in self.weights.keys() & words(text))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500)))) if np.isfinite(z) else 0.0


def fit(documents: list[np.ndarray], positive: np.ndarray, n_words: int, prior: float, steps: int = 300, batches: int = 4, rate: float = 0.05, decay: float = 1e-4) -> np.ndarray:
    """Weights (last one the bias) from documents as word numbers; Adam on the non-negative risk, in batches."""
    rng = np.random.default_rng(0)
    groups = []
    for want in (True, False):
        members = rng.permutation(np.flatnonzero(positive == want))
        groups.append([members[i::batches] for i in range(batches)])
    theta = np.zeros(n_words + 1)
    theta[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(theta), np.zeros_like(theta)

    def packed(members: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        held = [documents[i] for i in members]
        return np.repeat(np.arange(len(held)), [len(h) for h in held]), np.concatenate([*held, np.zeros(0, np.int64)]).astype(np.int64), len(held)

    data = [(packed(groups[0][i]), packed(groups[1][i])) for i in range(batches)]
    for step in range(1, steps + 1):
        (pr, pc, pn), (ur, uc, un) = data[step % batches]
        if not pn or not un:
            continue
        zp = np.bincount(pr, theta[pc], pn) + theta[-1]
        zu = np.bincount(ur, theta[uc], un) + theta[-1]
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        if negative >= 0:
            gp, gu = prior * (sp - 1) / pn - prior * sp / pn, su / un
        else:
            gp, gu = prior * sp / pn, -su / un
        slope = np.append(np.bincount(pc, gp[pr], n_words) + np.bincount(uc, gu[ur], n_words), gp.sum() + gu.sum())
        slope[:-1] += decay * theta[:-1]
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta = theta - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, positive) -> word, documents with it among positives and among unlabelled ones."""
    for batch in batches:
        counts = (Counter(), Counter())
        for text, positive in zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist(), strict=True):
            counts[not positive].update(words(text.as_py() or b""))
        both = list(counts[0].keys() | counts[1].keys())
        columns = [pa.array(both, pa.binary()), *(pa.array([c[w] for w in both], pa.int64()) for c in counts)]
        yield pa.RecordBatch.from_arrays(columns, names=["word", "in_p", "in_u"])


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    most_positive: int = MOST_POSITIVE,
    most_unlabelled: int = MOST_UNLABELLED,
    prior: float | None = None,
) -> Classifier:
    """A classifier from documents and labels; the caller leaves out what is not to be learned from.

    Only label 1 is used as a label; ``prior`` is the share of toxic documents, by default that among labelled ones.
    """
    spark = docs.sparkSession
    marks = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("label"))
    if prior is None:
        prior = marks.agg(F.avg("label")).first()[0]
    order = F.xxhash64("id")
    positives = marks.where("label = 1").select("id").orderBy(order, "id").limit(most_positive).select("id", F.lit(True).alias("positive"))
    ids = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct()
    unlabelled = ids.orderBy(F.xxhash64(F.lit("unlabelled"), "id"), "id").limit(most_unlabelled).select("id", F.lit(False).alias("positive"))
    chosen = spark.createDataFrame(positives.unionByName(unlabelled).toArrow(), "id long, positive boolean")  # bounded ids
    texts = docs.select(F.col(id_col).alias("id"), F.col(f"`{text_col}`").alias("text"))
    sample = texts.join(F.broadcast(chosen), "id").groupBy("id", "positive").agg(F.min("text").alias("text"))
    counted = map_batches(sample.select("text", "positive"), _word_counts, "word binary, in_p long, in_u long").groupBy("word").agg(F.sum("in_p").alias("p"), F.sum("in_u").alias("u"))
    n_p, n_u = (sample.agg(F.count_if("positive"), F.count_if(~F.col("positive"))).first()) or (0, 0)
    if not n_p or not n_u or not prior or prior >= 1:
        return Classifier() if not prior or prior < 1 else Classifier(bias=np.inf)
    pooled = (F.col("p") + F.col("u")) / F.lit(float(n_p + n_u))
    z = (F.col("p") / n_p - F.col("u") / n_u) / F.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / n_u) + 1e-12)
    telling = (F.col("p") + F.col("u") >= 5) & (F.abs(z) >= LEAST_Z)
    chosen_words = counted.where(telling).orderBy(F.abs(z).desc(), "word").limit(MOST_WORDS).select("word").collect()
    number = {bytes(r[0]): i for i, r in enumerate(chosen_words)}

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [sorted(number[w] for w in number.keys() & words(t.as_py() or b"")) for t in batch.column(0).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.list_(pa.int32())), batch.column(1)], names=["held", "positive"])

    rows = map_batches(sample.select("text", "positive"), numbered, "held array<int>, positive boolean").toArrow()
    documents = [np.asarray(h.values) if h.is_valid else np.zeros(0, np.int64) for h in rows["held"]]
    theta = fit(documents, rows["positive"].to_numpy(), len(number), float(prior))
    return Classifier({w: float(theta[i]) for w, i in number.items()}, float(theta[-1]))


def with_scores(docs: DataFrame, model: Classifier, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row as ``doc`` with ``score`` from 0 to 1. Null and empty texts get the score of a text without known words."""
    row = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias(ROW)
    rows = docs.select(row, F.col(f"`{text_col}`").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MOST_WORDS words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.score(t.as_py() or b"") for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=[ROW, "score"])

    return map_batches(rows, run, f"{schema_of(rows.select(ROW))}, score: double")
