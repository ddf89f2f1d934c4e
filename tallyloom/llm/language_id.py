"""Language identification with bit-sliced Bloom filters of n-grams.

Learning counts, per language, the documents that hold each byte n-gram; an n-gram belongs to a language if at
least ``min_share`` of its documents hold it. So a language has at most (distinct n-grams per document) /
``min_share`` n-grams, however many documents there are. All languages share one filter of rows of 64 bits, a
bit per language: an n-gram sets its languages' bits in the rows that its hashes name. Reading those rows and
combining them by AND gives, at once, the mask of all languages that contain the n-gram.

A text adds up, per language, how many of its n-grams have that bit, and takes off the false positives that the
filter's filling makes expected: (hits - n * f) / (1 - f) with f = filling ** hashes. The largest wins. A text too short for any n-gram
votes by its whole words instead, each between blanks; such words are counted in learning like n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import map_batches, schema_of

GRAM = 5
HASHES = 3
#: Rows of the filter: eight for each n-gram, as a power of two within these bounds.
ROWS_LEAST, ROWS_MOST = 1 << 12, 1 << 22
#: Odd multipliers of the hash functions.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
#: Byte classes: A-Z to lower case, digits, punctuation and white space to one blank; other bytes as they are.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def grams(text: bytes) -> np.ndarray:
    """The n-grams of a text as numbers: bytes of folded words, each with a blank around it."""
    folded = b" ".join([b"", *text.translate(_FOLD).split(), b""])
    if len(folded) < GRAM:
        return np.zeros(0, np.uint64)
    code = np.frombuffer(folded, np.uint8).astype(np.uint64)
    out = code[: len(code) - GRAM + 1].copy()
    for i in range(1, GRAM):
        out |= code[i : len(code) - GRAM + 1 + i] << np.uint64(8 * i)
    return out


def short_words(text: bytes) -> np.ndarray:
    """Distinct words too short for an n-gram of their own, with a blank on both sides, as numbers below all n-grams'."""
    held = {w for w in text.translate(_FOLD).split() if len(w) < GRAM - 2}
    return np.array([int.from_bytes(b" " + w + b" ", "little") for w in sorted(held)], np.uint64)


def _rows_of(gram: np.ndarray, bits: int) -> list[np.ndarray]:
    """Filter rows of every n-gram, one array per hash function."""
    return [(gram * m) >> np.uint64(64 - bits) for m in _MIX[:HASHES]]


@dataclass
class Filter:
    """Bit-sliced Bloom filter: ``rows[i]`` has a bit for each of ``languages``."""

    languages: list[str]
    rows: np.ndarray

    def __post_init__(self) -> None:
        self.bits = max(0, len(self.rows).bit_length() - 1)
        one = np.uint64(1)
        filled = [float((self.rows >> np.uint64(i) & one).mean()) for i in range(len(self.languages))]
        self.false_share = np.array([min(f**HASHES, 0.99) for f in filled])

    def masks(self, gram: np.ndarray) -> np.ndarray:
        at = _rows_of(gram, self.bits)
        out = self.rows[at[0]]
        for more in at[1:]:
            out &= self.rows[more]
        return out

    def votes(self, text: bytes) -> tuple[np.ndarray, int]:
        """Corrected number of n-grams per language, and the number of n-grams; without any, of short words."""
        gram = grams(text)
        mask = self.masks(gram if len(gram) else short_words(text))
        hits = np.array([np.count_nonzero(mask & np.uint64(1 << i)) for i in range(len(self.languages))], float)
        return np.clip((hits - len(mask) * self.false_share) / (1 - self.false_share), 0, None), len(mask)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, lang) -> documents of each language with each n-gram, per task, let out when many."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def merged(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, inverse = np.unique(np.concatenate([k for k, _ in pairs]), return_inverse=True)
        return keys, np.bincount(inverse, np.concatenate([n for _, n in pairs])).astype(np.int64)

    def let_out() -> Iterator[pa.RecordBatch]:
        for lang, (gram, n) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        new: dict[str, list[np.ndarray]] = {}
        room = 0
        for text, lang in zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist(), strict=True):
            held_by = text.as_py()
            new.setdefault(lang, []).append(np.concatenate([np.unique(grams(held_by)), short_words(held_by)]))
            room += len(new[lang][-1])
            if room > 2_000_000:
                for k, v in new.items():
                    held[k] = merged([*([held[k]] if k in held else []), (np.concatenate(v), np.ones(sum(map(len, v)), np.int64))])
                new, room = {}, 0
        for k, v in new.items():
            held[k] = merged([*([held[k]] if k in held else []), (np.concatenate(v), np.ones(sum(map(len, v)), np.int64))])
        if sum(len(n) for _, n in held.values()) > 4_000_000:
            yield from let_out()
    yield from let_out()


def learn(docs: DataFrame, text: Column, lang: Column, min_share: float = 0.01) -> Filter:
    """A filter from all rows of ``docs`` with a text and a language; at most 64 languages.

    What comes to the driver is the filter itself: at most ``ROWS_MOST`` rows of 64 bits.
    """
    known = docs.select(text.alias("text"), lang.cast("string").alias("lang")).where("text is not null and lang is not null")
    sizes = {r[0]: r[1] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(65).collect()}
    if len(sizes) > 64:
        raise ValueError("more than 64 languages")
    languages = sorted(sizes)
    if not languages:
        return Filter([], np.zeros(ROWS_LEAST, np.uint64))
    counted = map_batches(known, _document_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    number = F.element_at(F.create_map(*[F.lit(x) for i, l in enumerate(languages) for x in (l, i)]), F.col("lang"))
    least = F.element_at(F.create_map(*[F.lit(x) for l in languages for x in (l, max(1.0, min_share * sizes[l]))]), F.col("lang"))
    owned = counted.where(F.col("n") >= least).select("gram", F.expr("1L").alias("one"), number.alias("number"))
    owned = owned.groupBy("gram").agg(F.bit_or(F.expr("shiftleft(one, number)")).alias("mask")).cache()
    total = owned.count()
    bits = min(max(8 * total, ROWS_LEAST) - 1, ROWS_MOST - 1).bit_length()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.concatenate(_rows_of(gram, bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.concat_arrays([batch.column(1)] * HASHES)], names=["at", "mask"])

    filled = map_batches(owned.select("gram", "mask"), place, "at long, mask long").groupBy("at").agg(F.bit_or("mask").alias("mask")).toArrow()
    owned.unpersist()
    rows = np.zeros(1 << bits, np.uint64)
    rows[filled["at"].to_numpy()] = filled["mask"].to_numpy().view(np.uint64)
    return Filter(languages, rows)


def _has_letters(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


def has_grams(text: Column) -> Column:
    """Whether a text has an n-gram (see ``grams``); null has none."""
    folded = F.trim(F.regexp_replace(text, "[\\x00-@\\[-`{-\\x7f]+", " "))
    return F.coalesce(F.octet_length(folded) + 2 >= GRAM, F.lit(False))


def predict(model: Filter, text: bytes) -> tuple[str, float, float]:
    """Language, its share of all votes, and the share of n-grams (of short words, if there is no n-gram) that it holds.

    ``und`` with score 0 for a text without letters (or before anything was learned). A tie goes to the first
    language by name, also where no n-gram is known.
    """
    if not model.languages or not _has_letters(text):
        return "und", 0.0, 0.0
    votes, n = model.votes(text)
    best = int(np.argmax(votes))
    total = float(votes.sum())
    return model.languages[best], float(votes[best]) / total if total else 0.0, min(1.0, float(votes[best]) / max(n, 1))


def with_language(docs: DataFrame, model: Filter, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Rows as ``doc`` with ``lang_pred``, ``score`` and ``support``. Null, empty and letterless texts: ``und``."""
    from tallyloom.llm.common import ROW

    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.languages, model.rows.tobytes()))
    row = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias(ROW)
    rows = docs.select(row, F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, data = shared.value
        local = Filter(languages, np.frombuffer(data, np.uint64))
        for batch in batches:
            found = [predict(local, t.as_py() or b"") for t in batch.column(1).cast(pa.binary())]
            lang, score, support = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(support, pa.float64())],
                names=[ROW, "lang_pred", "score", "support"],
            )

    return map_batches(rows, run, f"{schema_of(rows.select(ROW))}, lang_pred: string, score: double, support: double")
