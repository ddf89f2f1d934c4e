"""Packing of tokenised documents into windows by non-negative least squares over length combinations.

A document is cut into whole windows and one rest. What matters of the rests is how many there are of each length, so Spark counts them and the
driver solves the packing on that histogram, whose size does not depend on the corpus:

1. all combinations of at most ``depth`` lengths that fill a window exactly are listed;
2. non-negative least squares finds how often to use each so that the lengths used come closest to the histogram;
3. the repeat counts are rounded, largest first, never beyond what is there;
4. residual lengths fill windows greedily, longest first. Those that leave room are laid end to end instead and cut at the window's end.

All pieces lie on one line of tokens that way, without gaps. Windows cut it; the last tokens, fewer than a window, are cut into powers of two, which need
no padding either. Every rest has a number among those of its length (counted in its task, plus the tasks before), which tells its place: the driver
keeps one (length, number, place, distance) for each use of a length in a combination, at most ``depth`` for each of them.

Cases. Null and empty texts are the end id alone. Texts of any length are cut, never shortened. Repeated rows are packed as often as they occur.
Equal lengths are taken by number. An empty table gives no rows. All columns are kept in ``doc``, so no name can clash.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.chunk_tokens import SPACED, TextEncoder
from tallyloom.llm.common import ROW, map_batches, may_hold, schema_of, written

END = b"\0\0\0\0"
#: Texts with characters that the two libraries might class differently, or with very long runs that one of them backtracks on.
_DOUBTFUL = re.compile("[\x1c-\x1f\x85\xa0ɐ-\U0010ffff]|\\s{1000}|\\S{100000}")


# ---- lengths ----


def combinations(lengths: np.ndarray, window: int, depth: int) -> np.ndarray:
    """All falling tuples of at most ``depth`` of the given lengths that sum to ``window``, filled up with 0."""
    has = np.zeros(window + 1, bool)
    has[lengths[lengths <= window]] = True
    rows = []

    def extend(head: tuple[int, ...], room: int, most: int, left: int) -> None:
        if room <= most and has[room]:
            rows.append(np.array([[*head, room] + [0] * (depth - len(head) - 1)]))
        if left == 2:  # two more, the first at least the second
            second = np.arange(max(1, room - most), room // 2 + 1)
            second = second[has[second] & has[room - second]]
            if len(second):
                out = np.zeros((len(second), depth), np.int64)
                out[:, : len(head)] = head
                out[:, len(head)], out[:, len(head) + 1] = room - second, second
                rows.append(out)
        elif left > 2:
            for first in np.flatnonzero(has[: min(most, room - 1) + 1]).tolist():
                if first * left >= room:
                    extend((*head, first), room - first, first, left - 1)

    extend((), window, window, depth)
    return np.unique(np.vstack(rows), axis=0) if rows else np.zeros((0, depth), np.int64)


def non_negative_least_squares(parts: np.ndarray, target: np.ndarray, rounds: int = 1500, tolerance: float = 1e-7) -> np.ndarray:
    """Repeat counts x >= 0 of the rows of ``parts`` that bring the number of uses of each length closest to ``target``.

    Accelerated projected gradient with restarts; the matrix is never formed, as a column has no more entries than the depth.
    """
    if not len(parts):
        return np.zeros(0)
    size, scale = len(target), max(float(target.max()), 1.0)
    wanted = target / scale
    flat, depth = parts.ravel(), parts.shape[1]

    def uses(x):
        out = np.bincount(flat, np.repeat(x, depth), size)
        out[0] = 0
        return out

    def gradient(miss):
        return miss[parts].sum(axis=1)

    v = np.ones(len(parts))
    for _ in range(30):  # power iteration for the step
        v = gradient(uses(v))
        v /= np.linalg.norm(v)
    step = 0.95 / np.linalg.norm(gradient(uses(v)))
    x = y = np.zeros(len(parts))
    t, last = 1.0, np.inf
    for i in range(rounds):
        miss = uses(y) - wanted
        nxt = np.maximum(y - step * gradient(miss), 0)
        if ((y - nxt) * (nxt - x)).sum() > 0:
            t, y = 1.0, nxt
        else:
            t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
            y, t = nxt + (t - 1) / t_next * (nxt - x), t_next
        x = nxt
        if i % 50 == 49:
            now = float(((uses(x) - wanted) ** 2).sum())
            if last - now <= tolerance * max(now, 1e-12):
                break
            last = now
    return x * scale


def rounded(parts: np.ndarray, repeats: np.ndarray, histogram: dict[int, int]) -> list[tuple[tuple[int, ...], int]]:
    """Whole repeat counts within the histogram: first the whole part of each, then one more by falling fraction."""
    left, out = Counter(histogram), Counter()
    whole = np.floor(repeats).astype(np.int64)
    passes = [(np.argsort(-whole, kind="stable"), whole), (np.argsort(whole - repeats, kind="stable"), (repeats - whole > 1e-3).astype(np.int64))]
    for order, many in passes:
        for at in order[many[order] > 0].tolist():
            need = Counter(p for p in parts[at].tolist() if p)
            times = min(int(many[at]), *(left[p] // k for p, k in need.items()))
            if times:
                out[at] += times
                for p, k in need.items():
                    left[p] -= times * k
    return [(tuple(p for p in parts[at].tolist() if p), times) for at, times in sorted(out.items())]


class Line:
    """Rests laid on one line of tokens, which boundaries cut into sequences. Rests of a length are taken by number."""

    def __init__(self, histogram: dict[int, int]):
        self.left = Counter({length: n for length, n in histogram.items() if n})
        self.taken: Counter = Counter()
        self.laid: list[tuple[int, int, int, int]] = []
        self.end = 0

    def lay(self, length: int, times: int, at: int, stride: int) -> None:
        self.laid.append((length, self.taken[length], at, stride))
        self.taken[length] += times
        self.left[length] -= times
        if not self.left[length]:
            del self.left[length]

    def windows(self, lengths: tuple[int, ...], times: int) -> None:
        """``times`` windows, each filled by these lengths."""
        window = sum(lengths)
        for length in lengths:
            self.lay(length, times, self.end, window)
            self.end += length
        self.end += window * (times - 1)

    def row(self, length: int, times: int) -> None:
        """``times`` rests end to end, whatever boundaries they cross."""
        self.lay(length, times, self.end, length)
        self.end += length * times

    def longest_first(self, window: int) -> dict[int, int]:
        """How many of each length fit a window, longest first."""
        room, chosen = window, {}
        for length in sorted(self.left, reverse=True):
            many = min(room // length, self.left[length])
            if many:
                chosen[length] = many
                room -= many * length
        return chosen


def pack_lengths(histogram: dict[int, int], window: int, depth: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Placements (length, first number, place on the line, distance to the next number's place) and the boundaries after the last whole window."""
    line = Line(histogram)
    if line.left[window]:
        line.windows((window,), line.left[window])
    shorter = {length: n for length, n in line.left.items()}
    parts = combinations(np.array(sorted(shorter), np.int64), window, depth)
    target = np.zeros(window + 1)
    target[list(shorter)] = list(shorter.values())
    for lengths, times in rounded(parts, non_negative_least_squares(parts, target), shorter):
        line.windows(lengths, times)
    rows = []
    while line.left:  # every step uses a length up
        chosen = line.longest_first(window)
        times = min(line.left[length] // many for length, many in chosen.items())
        if sum(length * many for length, many in chosen.items()) == window:
            line.windows(tuple(length for length, many in chosen.items() for _ in range(many)), times)
        else:
            rows += [(length, many * times) for length, many in chosen.items()]
            for length, many in chosen.items():
                line.left[length] -= many * times
                if not line.left[length]:
                    del line.left[length]
    for length, times in rows:
        line.row(length, times)
    ends = [line.end // window * window]
    while ends[-1] < line.end:
        ends.append(ends[-1] + (1 << (line.end - ends[-1]).bit_length() - 1))
    return np.array(line.laid, np.int64).reshape(-1, 4), np.array(ends, np.int64)


def cut_at(place: np.ndarray, window: int, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence of each place on the line, where that begins and where it ends."""
    whole = place < ends[0]
    tail = np.searchsorted(ends, place, "right")
    begin = np.where(whole, place // window * window, ends[np.maximum(tail, 1) - 1])
    end = np.where(whole, begin + window, ends[np.minimum(tail, len(ends) - 1)])
    return np.where(whole, place // window, ends[0] // window + tail - 1), begin, end


# ---- documents ----


class Encoder(TextEncoder):
    """Ids of texts by a ``tokenizers`` file. A byte-level file whose merges are in the order of its ids, as ranks, is run by ``tiktoken``."""

    def __init__(self, path: str):
        import json

        super().__init__(path)
        with open(path, encoding="utf-8") as f:
            self.fast = self._by_ranks(json.load(f))

    def _by_ranks(self, spec: dict):
        import tiktoken

        if self.mode != SPACED:
            return None
        # fixed values: the byte-level alphabet writes printable bytes as themselves, the others as the characters from U+0100 on
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        letters = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        special = {t["content"] for t in spec.get("added_tokens", [])}
        ids = {token: i for token, i in spec["model"]["vocab"].items() if token not in special}
        merged = [ids["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        if merged != sorted(merged) or len(ids) != 256 + len(merged):
            return None
        ranks = {bytes(letters[c] for c in token): i for token, i in ids.items()}
        # the split of the byte-level pre-tokenizer, a fixed value
        split = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        return tiktoken.Encoding("by-ranks", pat_str=split, mergeable_ranks=ranks, special_tokens={})

    def encoded(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a text."""
        if self.fast is None:
            return self.ids([text])[0]
        if _DOUBTFUL.search(text) or self.special.search(text):
            return self.whole(text)
        return array("I", self.fast.encode_ordinary(text)).tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _pieces(batches: Iterator[pa.RecordBatch], tokenizer: str, window: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """(doc, text) -> whole windows and a rest, each with its number among the task's pieces of its length. Rests carry their ids."""
    model, task, seen = encoder(tokenizer), TaskContext.get().partitionId(), {}
    names = [ROW, "begin", "whole", "ids_crc32", "doc_tokens", "task", "number", "ids"]
    types = [pa.int64()] * 6 + [pa.binary()]
    for batch in batches:
        take, out, held = [], [], 0

        def flush(batch=batch, take=take, out=out):
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            made = pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(take)), *columns], names=names)
            take.clear()
            out.clear()
            return made

        for at, text in enumerate(batch.column(1)):
            ids = model.encoded(text.as_py() or "") + END
            for a in range(0, len(ids), 4 * window):
                part = ids[a : a + 4 * window]
                length = len(part) // 4
                number = seen[length] = seen.get(length, -1) + 1
                take.append(at)
                out.append((a // 4, length, zlib.crc32(part), len(ids) // 4, task, number, part if with_ids or length < window else None))
            held += len(ids)
            if held > 1 << 24:
                yield flush()
                held = 0
        if out:
            yield flush()


def pack(docs: DataFrame, tokenizer: str, text_col: str = "text", window: int = 1024, depth: int = 3, keep: list[str] | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place: ``doc`` (all columns or ``keep``), ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset`` and, on request, ``ids`` (little-endian 32-bit). A document is its ids and an end id of 0.
    """
    if window < 2 or window & (window - 1):
        raise ValueError("the window must be a power of two")
    row = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias(ROW)
    rows = docs.select(row, F.col(f"`{text_col}`").cast("string").alias("text"))
    columns = f"{schema_of(rows.select(ROW))}, begin: long, whole: long, ids_crc32: long, doc_tokens: long, task: long, number: long, ids: binary"
    pieces = written(map_batches(rows, lambda b: _pieces(b, tokenizer, window, with_ids), columns), "window-pieces")
    per_task = pieces.groupBy("task", "whole").agg(F.count("*").alias("n"))
    before = Window.partitionBy("whole").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("task", "whole", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r[0]: r[1] for r in per_task.groupBy("whole").agg(F.sum("n")).collect()}  # at most ``window`` rows
    laid, ends = pack_lengths(histogram, window, depth)
    bits = 62 - window.bit_length()  # for the number of a rest among those of its length
    keys = (laid[:, 0] << bits) + laid[:, 1]
    order = np.argsort(keys)
    shared = docs.sparkSession.sparkContext.broadcast((keys[order], laid[order], ends))
    inner = [ROW, "begin", "whole", "ids_crc32", "doc_tokens", "task", "number"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, places, ends = shared.value
        for batch in batches:
            whole, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            found = places[np.searchsorted(known, (whole << bits) + rank, "right") - 1]
            first = found[:, 2] + (rank - found[:, 1]) * found[:, 3]
            todo, at, out = np.arange(len(whole)), np.zeros(len(whole), np.int64), []
            while len(todo):
                sequence, begin, end = cut_at(first[todo] + at, window, ends)
                length = np.minimum(whole[todo] - at, end - first[todo] - at)
                out.append((todo, at, length, sequence, first[todo] + at - begin))
                more = at + length < whole[todo]
                todo, at = todo[more], (at + length)[more]
            if out:
                took, *columns = (np.concatenate(c) for c in zip(*out, strict=True))
                fields = batch.column(0).take(pa.array(took)).flatten()
                yield pa.RecordBatch.from_arrays([*fields, *map(pa.array, columns)], names=[*inner, "at", "length", "sequence_id", "offset"])

    ranked = pieces.join(bases, ["task", "whole"]).select(F.struct(*inner).alias("row"), "whole", (F.col("base") + F.col("number")).alias("rank"))
    placed = map_batches(ranked, place, f"{schema_of(ranked.select('row.*'))}, at: long, length: long, sequence_id: long, offset: long")
    placed = written(placed, "window-places")
    result = [ROW, (F.col("begin") + F.col("at")).alias("start"), "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if with_ids:
        parts = placed.join(pieces.select("task", "whole", "number", "ids"), ["task", "whole", "number"])
    else:  # ids are needed of cut pieces only: the others stay where they lie
        name = F.xxhash64("task", "whole", "number").alias("name")
        rests = pieces.where(F.col("whole") < window).select("task", "whole", "number", "ids", name)
        cut = placed.where("length < whole").select("*", name)
        parts = cut.join(rests.where(may_hold(rests, "name", cut)), ["task", "whole", "number"])
    part = F.substring("ids", F.col("at").cast("int") * 4 + 1, F.col("length").cast("int") * 4)
    parts = parts.withColumn("ids", part).withColumn("ids_crc32", F.crc32("ids"))
    if with_ids:
        return parts.select(*result, "ids")
    return placed.where("length = whole").select(*result).unionByName(parts.select(*result))


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves from ``pack(.., with_ids=True)``: ``sequence_id``, ``length``, ``ids``. Each is at most a window."""
    held = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("held"))
    return held.select("sequence_id", "length", F.expr("aggregate(held, X'', (a, x) -> concat(a, x.ids))").alias("ids"))
