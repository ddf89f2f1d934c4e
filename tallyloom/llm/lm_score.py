"""Language-model scores of whole documents: a unigram base and a gated recurrent model.

Spark counts all words of the training documents. The most frequent ones (``LOOKUP_WORDS``) are known to every task by their
counts; the counts of all other words of a text are joined by word. The recurrent model (``recurrent``) predicts the most
frequent of those words (``HEAD_WORDS``) and, for the rest, one of ``BUCKETS`` by their endings, within which a word has its
smoothed share of the counts: so the counts of the whole corpus, however many words it has, are part of the model.

Its weights are trained in rounds on shares of the training documents that ``SHARES`` fixes by the hash of the id; together the
rounds go through all training documents once. In each round every task goes through its own documents, and Spark averages the weights by tokens. A round that is
run again after a failure starts from the same weights. Only the weights and the bounded word lists come to the driver.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import recurrent
from tallyloom.llm.common import ROW, map_batches, schema_of, written

LOOKUP_WORDS, HEAD_WORDS, CLASSES, BUCKETS, HIDDEN = 300_000, 1_000, 32, 32, 16
#: Documents of about so many tokens are scored together: enough to keep all lanes busy beside a long document.
GROUP_TOKENS = 4_000_000
#: Bytes of text whose words are split and looked up at once.
PIECE_BYTES = 4 << 20
#: A round per entry: of 16 equal shares of the training documents, those it learns from; and its step size.
SHARES, RATES = (tuple(range(6)), tuple(range(6, 11)), tuple(range(11, 16))), (0.015, 0.008, 0.003)


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Runs of characters other than ASCII white space, A-Z in lower case, of all texts one after another; and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, ends = lists.flatten(), np.asarray(lists.offsets)
    real = np.asarray(pc.binary_length(flat)) > 0  # white space at the ends of a text leaves empty ones
    if not real.all():
        flat = flat.filter(pa.array(real))
        ends = np.append(0, np.cumsum(real))[ends - ends[0]]
    return flat, np.diff(ends)


def pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of ``PIECE_BYTES`` at most or of a single text: so much is split at once."""
    texts = texts.cast(pa.binary()).view(pa.string())
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)), dtype=np.int64)
    begin = 0
    while begin < len(texts):
        room = PIECE_BYTES + (ends[begin - 1] if begin else 0)
        end = max(begin + 1, int(np.searchsorted(ends, room, "right")))
        yield texts.slice(begin, end - begin)
        begin = end


def bucket(word: bytes) -> int:
    """Tail bucket of a word, by its last three bytes."""
    return zlib.crc32(word[-3:]) % BUCKETS


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) -> word, occurrences; the null word is the end of a document."""
    for batch in batches:
        for texts in pieces(batch.column(0)):
            found = words(texts)[0].value_counts()
            word = pa.concat_arrays([found.field("values").view(pa.binary()), pa.nulls(1, pa.binary())])
            n = pa.concat_arrays([found.field("counts"), pa.array([len(texts)], pa.int64())])
            yield pa.RecordBatch.from_arrays([word, n], names=["word", "n"])


@dataclass
class Model:
    """What a task needs: the looked-up words with counts and token numbers, the totals, the recurrent model."""

    lookup: bytes
    counts: np.ndarray
    tokens: np.ndarray
    end_count: int
    n: int
    v: int
    tail_room: np.ndarray
    bounds: list[int]
    flat: np.ndarray

    def __post_init__(self) -> None:
        self.shape = recurrent.Shape(self.bounds, BUCKETS, HIDDEN)

    def index(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.lookup.split(b" "))} if self.lookup else {}

    @cached_property
    def known(self) -> pa.Array:
        """The looked-up words; kept by a worker for all its tasks of a round."""
        return pa.array(self.lookup.split(b" ") if self.lookup else [], pa.binary()).view(pa.string())


@dataclass
class Numbered:
    """Words of several texts: the text of each, its place in the lookup (-1: not there) and its model token; the words not in the lookup."""

    text_of: np.ndarray
    at: np.ndarray
    tokens: np.ndarray
    missing: pa.Array
    lengths: np.ndarray

    def documents(self) -> list[np.ndarray]:
        """Model tokens of each text, with the end."""
        n = len(self.lengths)
        run = np.zeros(len(self.tokens) + n, np.int32)
        run[np.arange(len(self.tokens)) + self.text_of] = self.tokens
        ends = np.cumsum(self.lengths + 1)
        return [run[e - m - 1 : e] for e, m in zip(ends.tolist(), self.lengths.tolist(), strict=True)]


def _numbered(model: Model, texts: pa.Array) -> Numbered:
    flat, lengths = words(texts)
    at = np.asarray(pc.fill_null(pc.index_in(flat, value_set=model.known), -1))
    missing = flat.filter(pa.array(at < 0)).view(pa.binary())
    tokens = np.append(model.tokens, 0)[at]
    endings = pc.binary_slice(missing, -3).dictionary_encode()
    tokens[at < 0] = np.array([model.shape.head + bucket(e) for e in endings.dictionary.to_pylist()], np.int32)[np.asarray(endings.indices)]
    return Numbered(np.repeat(np.arange(len(lengths)), lengths), at, tokens, missing, lengths)


def _trained(batches: Iterator[pa.RecordBatch], model: Model, rate: float) -> Iterator[pa.RecordBatch]:
    """Weights after one pass over this task's texts, as (place, weight * tokens, tokens)."""
    trainer, seen = recurrent.Trainer(model.shape, model.flat, rate), 0
    for batch in batches:
        seen += trainer.learn([d for texts in pieces(batch.column(0)) for d in _numbered(model, texts).documents()])
    if seen:
        weighted = trainer.flat.astype(np.float64) * seen
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(weighted), dtype=np.int32)), pa.array(weighted), pa.array(np.full(len(weighted), seen))], names=["at", "w", "n"])


def learn(docs: DataFrame, share: Column, text_col: str = "text") -> tuple[Model, DataFrame]:
    """The model and the written counts of all words of ``docs``; ``share`` is a number from 0 to 15 per row, by which rounds choose."""
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{text_col}`").alias("text"), share.alias("share"))
    counts = written(map_batches(texts.select("text"), _counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    n, v, ends = counts.agg(F.sum("n"), F.count("*"), F.sum(F.when(F.col("word").isNull(), F.col("n")))).first()
    n, v, ends = n or 0, v or 0, ends or 0
    known = counts.where("word is not null")
    top = known.orderBy(F.desc("n"), "word").limit(LOOKUP_WORDS).toArrow()
    order = np.argsort(-top["n"].to_numpy(), kind="stable")
    ranked, held = top["word"].take(pa.array(order)).to_pylist(), top["n"].to_numpy()[order]
    head = ranked[:HEAD_WORDS]
    mass = np.cumsum(held[: len(head)])
    cuts = np.searchsorted(mass, np.arange(1, CLASSES) * (mass[-1] / (CLASSES - 1) if len(mass) else 1)) + 2
    bounds = sorted({0, 1, *(int(c) for c in cuts if c <= len(head)), len(head) + 1})
    ending = (F.crc32(F.expr("substring(word, -3, 3)")) % BUCKETS).cast("int")
    in_head = spark.createDataFrame([(w,) for w in head], "word binary")  # HEAD_WORDS rows
    tail = known.join(F.broadcast(in_head), "word", "left_anti").groupBy(ending.alias("b")).agg(F.sum("n"), F.count("*")).collect()
    tail_n, tail_v = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for b, occurrences, distinct in tail:
        tail_n[b], tail_v[b] = occurrences, distinct
    tokens = np.array([i + 1 if i < len(head) else len(head) + 1 + bucket(w) for i, w in enumerate(ranked)], np.int32)
    model = Model(b" ".join(ranked), held.astype(np.int64), tokens, ends, n, v, tail_n + 0.5 * (tail_v + 1), bounds, np.zeros(0, np.float32))
    model.flat = model.shape.first(np.concatenate([[ends + 0.5], held[: len(head)] + 0.5, model.tail_room]))
    for shares, rate in zip(SHARES, RATES, strict=True):
        shared = spark.sparkContext.broadcast(model)
        rows = texts.where(F.col("share").isin(*shares)).select("text")
        trained = map_batches(rows, lambda b, s=shared, r=rate: _trained(b, s.value, r), "at int, w double, n long")
        mean = trained.groupBy("at").agg((F.sum("w") / F.sum("n")).alias("w")).toArrow()  # as many rows as the model has weights
        if mean.num_rows:
            flat = np.zeros(model.shape.size, np.float32)
            flat[mean["at"].to_numpy()] = mean["w"].to_numpy()
            model.flat = flat
    return model, counts


def _rare(found: Numbered) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of each text that are not in the lookup, as (word, times), and how many each text has."""
    distinct = found.missing.dictionary_encode()
    of = found.text_of[found.at < 0]
    pairs, times = np.unique(of * (len(distinct.dictionary) + 1) + np.asarray(distinct.indices), return_counts=True)
    of, code = np.divmod(pairs, len(distinct.dictionary) + 1)
    word = distinct.dictionary.take(pa.array(code))
    return pa.StructArray.from_arrays([word, pa.array(times, pa.int32())], names=["word", "times"]), np.bincount(of, minlength=len(found.lengths))


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Everything about a text but the counts of its words outside the lookup, which go out as (word, times)."""
    number = TaskContext.get().partitionId() << 40
    log_count = np.append(np.log10(model.counts + 0.5), 0)  # those not in the lookup are added later
    room = np.append(np.zeros(model.shape.head), np.log10(model.tail_room))
    in_tail = np.arange(model.shape.tokens) >= model.shape.head
    for batch in batches:
        begin, held, documents, parts = 0, 0, [], []
        for texts in pieces(batch.column(1)):
            found = _numbered(model, texts)
            n, of = len(texts), found.text_of
            logs = log_count[found.at]
            known = np.bincount(of, found.at >= 0, n).astype(np.int64) + (model.end_count > 0)
            base = np.bincount(of, logs, n) + math.log10(model.end_count + 0.5)
            own = np.bincount(of, logs * in_tail[found.tokens] - room[found.tokens], n)
            parts.append((found.lengths.astype(np.int64) + 1, known, base, own, *_rare(found)))
            documents += found.documents()
            held += len(found.tokens) + n
            if held < GROUP_TOKENS and begin + len(documents) < batch.num_rows:
                continue
            *numbers, pairs, rare = zip(*parts, strict=True)
            n_tokens, known, base, own = (np.concatenate(c) for c in numbers)
            tail = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.concatenate(rare))), pa.int32()), pa.concat_arrays(pairs))
            likelihood = recurrent.score(model.shape, model.flat, documents) / math.log(10)
            rows = number + begin + np.arange(len(documents))
            arrays = [pa.array(rows), pa.array(n_tokens), pa.array(known), pa.array(base), pa.array(own + likelihood), tail]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(documents)), *arrays], names=[ROW, "row_no", "n_tokens", "n_known", "base", "model", "tail"])
            begin += len(documents)
            held, documents, parts = 0, [], []
        number += batch.num_rows


def with_scores(docs: DataFrame, model: Model, counts: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row as ``doc`` with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10).

    A null text counts as empty: the end token alone. Repeated rows are scored each. The join by word carries the words outside
    the lookup only, each at most ``1 / LOOKUP_WORDS`` of all tokens, so no key of it is hot.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    row = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias(ROW)
    rows = docs.select(row, F.col(f"`{text_col}`").alias("text"))
    columns = f"{schema_of(rows.select(ROW))}, row_no: long, n_tokens: long, n_known: long, base: double, model: double, tail: array<struct<word: binary, times: int>>"
    staged = written(map_batches(rows, lambda b: _scored(b, shared.value), columns), "lm-scored")
    tail = staged.select("row_no", F.inline("tail"))
    held = tail.join(counts.select("word", F.col("n").alias("c")).hint("merge"), "word", "left").select("row_no", "times", F.coalesce("c", F.lit(0)).alias("c"))
    sums = held.groupBy("row_no").agg(F.sum(F.col("times") * F.log10(F.col("c") + 0.5)).alias("tail_log"), F.sum(F.when(F.col("c") > 0, F.col("times"))).alias("tail_known"))
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    room = math.log10(model.n + 0.5 * (model.v + 1))
    return staged.drop("tail").join(sums, "row_no", "left").select(
        ROW,
        "n_tokens",
        (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        (F.col("base") + tail_log - F.col("n_tokens") * F.lit(room)).alias("base_score"),
        (F.col("model") + tail_log).alias("score"),
    )
