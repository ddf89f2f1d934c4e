"""Best-fit decreasing packing of tokenised documents into sequences of a fixed length.

Lengths are whole numbers from 1 to ``capacity``, so all that best-fit decreasing needs to know of a corpus is
how many pieces there are of each length. Spark counts them; the driver runs the exact algorithm on that
histogram, with bins of equal content kept as runs: a segment tree over the remaining capacities finds the
tightest open bin for a length in logarithmic time. The outcome is a list of placements "pieces r to s of
length l go to bins from b on, so many in each, at this offset". Its size does not depend on the corpus: a
length adds at most four runs of bins, and a run holds at most sqrt(2 * capacity) different lengths.

Every piece then has a number among the pieces of its length (counted within its task, plus the tasks before),
and looks up its bin and offset in the placements by binary search.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.chunk_tokens import encoder, slices
from tallyloom.llm.common import ROW, map_batches, schema_of, written

END = b"\0\0\0\0"


class CapacityTree:
    """Segment tree over remaining capacities 0..most: the smallest capacity with open bins, at or above a need."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.open = [False] * (2 * self.leaves)

    def set(self, capacity: int, is_open: bool) -> None:
        node = capacity + self.leaves
        self.open[node] = is_open
        while node > 1:
            node >>= 1
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, need: int) -> int | None:
        node = need + self.leaves
        if self.open[node]:
            return need
        while node > 1:
            if not node & 1 and self.open[node + 1]:  # a right neighbour: the smallest open leaf lies below it
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit_decreasing(histogram: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Placements (length, first rank, pieces, first bin, pieces per bin, offset) and the number of bins.

    What best-fit decreasing does piece by piece, for all pieces of a length at once: a bin of remaining capacity
    c takes c // length of them before a looser bin is the tightest.
    """
    tree, runs, bins, placed = CapacityTree(capacity), {}, 0, []

    def add(capacity_left: int, first: int, count: int) -> None:
        if count and capacity_left:
            runs.setdefault(capacity_left, []).append((first, count))
            tree.set(capacity_left, True)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, count = capacity, bins, -(-left // (capacity // length))
                bins += count
            else:
                first, count = runs[room].pop()
                if not runs[room]:
                    tree.set(room, False)
            each = room // length
            full = min(count, left // each)
            rest = min(left - full * each, each) if full < count else 0
            if full:
                placed.append((length, rank, full * each, first, each, capacity - room))
                add(room - each * length, first, full)
            if rest:
                placed.append((length, rank + full * each, rest, first + full, rest, capacity - room))
                add(room - rest * length, first + full, 1)
            used = full + bool(rest)
            add(room, first + used, count - used)
            left -= full * each + rest
            rank += full * each + rest
    return np.array(placed, np.int64).reshape(-1, 6), bins


def _pieces(batches: Iterator[pa.RecordBatch], tokenizer: str, capacity: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """(doc, text) -> pieces, each with its number among the task's pieces of its length."""
    model, task, seen = encoder(tokenizer, "ids"), TaskContext.get().partitionId(), {}
    names = ["piece", "start", "length", "ids_crc32", "task", "number", *(["ids"] if with_ids else [])]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), *([pa.binary()] if with_ids else [])]
    for batch in batches:
        texts, base = [t or "" for t in batch.column(1).to_pylist()], 0
        for run in slices(texts):
            take, out = [], []
            for i, ids in enumerate(model.ids(run)):
                ids += END
                for piece, a in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[a : a + 4 * capacity]
                    length = len(part) // 4
                    number = seen[length] = seen.get(length, -1) + 1
                    take.append(base + i)
                    out.append((piece, a // 4, length, zlib.crc32(part), task, number, *((part,) if with_ids else ())))
            base += len(run)
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(take)), *columns], names=[ROW, *names])


def pack(
    docs: DataFrame, tokenizer: str, text_col: str = "text", capacity: int = 2048, keep: list[str] | None = None, with_ids: bool = False
) -> DataFrame:
    """Pieces of all documents with their place: ``doc`` (all columns or ``keep``), ``piece``, ``start``, ``length``,
    ``ids_crc32``, ``sequence_id``, ``offset`` and, on request, ``ids`` (little-endian 32-bit).

    A document is its ids and an end id of 0; null and empty texts are the end id alone. Only documents longer than
    ``capacity`` are cut, into pieces of that length and a rest. Repeated rows are packed as often as they occur.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias(ROW)
    rows = docs.select(row, F.col(f"`{text_col}`").alias("text"))
    columns = f"{schema_of(rows.select(ROW))}, piece: int, start: long, length: long, ids_crc32: long, task: long, number: long"
    columns += ", ids: binary" if with_ids else ""
    pieces = written(map_batches(rows, lambda b: _pieces(b, tokenizer, capacity, with_ids), columns), "packing-pieces")
    per_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("task", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r[0]: r[1] for r in per_task.groupBy("length").agg(F.sum("n")).collect()}  # at most ``capacity`` rows
    placed, _ = best_fit_decreasing(histogram, capacity)
    starts_of, total = np.zeros(capacity + 2, np.int64), 0
    for length in sorted(histogram, reverse=True):
        starts_of[length] = total
        total += histogram[length]
    shared = docs.sparkSession.sparkContext.broadcast((placed, starts_of))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        placements, first_of = shared.value
        begins = first_of[placements[:, 0]] + placements[:, 1]
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            found = placements[np.searchsorted(begins, first_of[length] + rank, "right") - 1]
            nth = rank - found[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.column(0).flatten(), pa.array(found[:, 3] + nth // found[:, 4]), pa.array(found[:, 5] + nth % found[:, 4] * length)],
                names=[*inner, "sequence_id", "offset"],
            )

    inner = [ROW, "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    ranked = pieces.join(bases.select("task", "length", "base"), ["task", "length"])
    ranked = ranked.select(F.struct(*inner).alias("row"), "length", (F.col("base") + F.col("number")).alias("rank"))
    return map_batches(ranked, place, f"{schema_of(ranked.select('row.*'))}, sequence_id: long, offset: long")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves from ``pack(.., with_ids=True)``: ``sequence_id``, ``length``, ``ids``."""
    held = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("held"))
    return held.select("sequence_id", "length", F.expr("aggregate(held, X'', (a, x) -> concat(a, x.ids))").alias("ids"))
