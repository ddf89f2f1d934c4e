"""SimHash near-duplicates: segment-popcount embedding, grid join under Manhattan distance, exact verification.

A 64-bit fingerprint is cut into 32 segments of two bits; the vector of their bit counts is its embedding, packed
two bits a count into one long. (Coarser segments let unrelated fingerprints meet, more of them as the corpus grows.) One differing bit moves one count by one at most, so the Manhattan
distance of two embeddings is a lower bound of the Hamming distance of their fingerprints.

Range join on the grid of embeddings: two vectors at Manhattan distance two or less have a common cell within
one step of both. Every distinct fingerprint is sent to its own cell and the cells one step away (65 at most),
and only fingerprints that meet another one in some cell go on.

Exact verification by the same meeting in the middle, bit by bit: two fingerprints differ in two bits or fewer
exactly if some 64-bit value is within one bit of both. Each remaining fingerprint is sent to the 65 values
within one bit; those that meet are linked to the smallest one there. So the links are exact, none is lost, and a
group of n near copies makes 65 n rows instead of its n * n / 2 pairs.

Components of the links are found by alternating large-star and small-star steps, each written to the shared
folder. Only distinct fingerprints that have a neighbour take part in them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import ROW, map_batches, schema_of, unwrapped, written

SEED = 42
#: Bits of each byte value, most significant first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes, words_per_shingle: int) -> int:
    """64 bits, each set if it is set in over half the XXH64 values of the word shingles, repeats counted.

    A text with fewer words is one shingle; without any word the fingerprint is zero. Words are runs of
    characters other than ASCII white space, A-Z in lower case, joined by one space.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= words_per_shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_digest
    spans = zip(starts[: len(words) - words_per_shingle + 1].tolist(), ends[words_per_shingle - 1 :].tolist(), strict=True)
    hashes = np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in spans]), np.uint8).reshape(-1, 8)
    if len(hashes) < 2000:
        ones = np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(hashes[:, i], minlength=256) @ _BITS for i in range(8)])
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch], shingles: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        found = np.array([[fingerprint(t.as_py() or b"", n) for n in shingles] for t in texts], np.uint64).reshape(-1, len(shingles))
        columns = [pa.array(np.ascontiguousarray(found[:, i]).view(np.int64)) for i in range(len(shingles))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[ROW, *[f"fp{i}" for i in range(len(shingles))]])


def with_fingerprints(docs: DataFrame, text_col: str = "text", shingles: tuple[int, ...] = (3,), keep: list[str] | None = None) -> DataFrame:
    """Rows as ``doc`` (all columns, or those in ``keep``) with a fingerprint ``fp0``, ``fp1``, .. (signed long) per shingle length.

    A null text counts as empty.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias(ROW)
    rows = docs.select(row, F.col(f"`{text_col}`").alias("text"))
    columns = "".join(f", fp{i}: long" for i in range(len(shingles)))
    return map_batches(rows, lambda b: _fingerprints(b, shingles), f"{schema_of(rows.select(ROW))}{columns}")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _mask(pattern: int) -> Column:
    return F.lit(_signed(pattern)).cast("long")


def embedding(fp: Column) -> Column:
    """Bit counts (0 to 2) of the 32 segments of two bits, packed in the order of the segments."""
    odd, even = F.shiftrightunsigned(fp, 1).bitwiseAND(_mask(0x5555555555555555)), fp.bitwiseAND(_mask(0x5555555555555555))
    return odd.bitwiseXOR(even).bitwiseOR(F.shiftleft(odd.bitwiseAND(even), 1))


def _cells(fingerprints: DataFrame) -> DataFrame:
    """``fp`` with its grid cell and those one step away, counts kept within 0 and 2."""
    steps = F.explode(F.array(*[F.lit(i) for i in range(-32, 33)])).alias("step")
    at = fingerprints.select("fp", embedding(F.col("fp")).alias("vector"), steps).selectExpr("fp", "vector", "step", "greatest(abs(step) - 1, 0) * 2 AS at")
    at = at.selectExpr("fp", "vector", "step", "at", "int(shiftrightunsigned(vector, at) & 3) AS held")
    inside = "step = 0 OR (step > 0 AND held < 2) OR (step < 0 AND held > 0)"
    # one count of the vector replaced: all its bits that differ are flipped
    return at.where(inside).selectExpr("fp", "vector ^ shiftleft(bigint(held ^ (held + int(sign(step)))), at) AS cell")


def _meeting(sent: DataFrame, place: str) -> DataFrame:
    """Places where two different fingerprints meet, with the smallest of them."""
    return sent.groupBy(place).agg(F.min("fp").alias("root"), F.max("fp").alias("other")).where("root < other").select(place, "root")


def links(fingerprints: DataFrame) -> DataFrame:
    """Star edges (``fp``, ``root``), ``root < fp``, with the components of 'differ in two bits or fewer'.

    ``fingerprints`` has one distinct long column ``fp``.
    """
    cells = _cells(fingerprints)  # Spark's size estimates do not see that rows multiply here: no broadcast
    near = cells.join(_meeting(cells, "cell").hint("merge"), "cell", "left_semi").select("fp").distinct()
    flips = F.explode(F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)).cast("long") for i in range(64)])).alias("flip")
    near = written(near, "simhash-near")
    sent = near.select("fp", flips).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
    return sent.join(_meeting(sent, "value").hint("merge"), "value").where("fp <> root").select("fp", "root").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Component of the nodes of undirected ``edges`` (``fp``, ``root``): (``fp``, ``label``), label the smallest node, which is left out itself.

    Large star: all larger neighbours of a node move to its smallest neighbour; small star: all smaller ones do.
    Alternated until nothing changes; then each node's only link leads to the smallest of its component.
    """
    edges = written(edges.select(F.greatest("fp", "root").alias("u"), F.least("fp", "root").alias("v")).where("u <> v").distinct(), "simhash-edges")
    state = _state(edges)
    while state[0]:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "simhash-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = written(small.where("u <> v").distinct(), "simhash-star")
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("u").alias("fp"), F.col("v").alias("label"))


def _state(edges: DataFrame) -> tuple:
    """Number and order-free digest of the edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())


def _classified(rows: DataFrame, id_col: str) -> DataFrame:
    """Distinct fingerprints of ``rows`` (``doc``, ``fp``, ``row_no``) with their component's smallest id and its row."""
    first = F.min(F.struct(F.col(ROW)[id_col].isNull().alias("no_id"), F.col(ROW)[id_col].alias("id"), "row_no"))
    distinct = written(rows.groupBy("fp").agg(first.alias("least")), "simhash-distinct")
    labels = components(links(distinct.select("fp")))
    labelled = distinct.join(labels, "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("least").alias("least"))
    found = labelled.select("fp", "label").join(smallest, "label")
    return written(found.select("fp", F.col("least.id").alias("component_id"), F.col("least.row_no").alias("keep_row")), "simhash-components")


def with_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3, keep: list[str] | None = None) -> DataFrame:
    """Every row as ``doc`` with ``fp`` and ``component_id``, the smallest id of its component (null only if all are null).

    Rows with equal fingerprints are linked by having one fingerprint; everything but the last join works on
    distinct fingerprints. That join is left to adaptive skew handling, as one fingerprint may hold many rows.
    """
    found = with_fingerprints(docs, text_col, (words_per_shingle,), keep or [id_col]).withColumnRenamed("fp0", "fp")
    rows = written(found.withColumn("row_no", F.monotonically_increasing_id()), "simhash-rows")
    return rows.join(_classified(rows, id_col).drop("keep_row"), "fp").select(ROW, "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingles: tuple[int, ...] = (5,)) -> DataFrame:
    """One row of each component, the one with the smallest id, with the columns it came with.

    With several shingle lengths a row goes if it is not the first of its component by some of them; as all agree on which
    row is first, what a row was close to stays, or something close to that in turn. The rows that go are found from
    narrow rows; the wide ones meet only their numbers.
    """
    found = with_fingerprints(docs, text_col, shingles)
    rows = written(found.withColumn("row_no", F.monotonically_increasing_id()), "simhash-rows")
    going = None
    for i in range(len(shingles)):
        narrow = rows.select(F.struct(F.col(ROW)[id_col].alias(id_col)).alias(ROW), F.col(f"fp{i}").alias("fp"), "row_no")
        more = narrow.join(_classified(narrow, id_col), "fp").where("row_no <> keep_row").select("row_no")
        going = more if going is None else going.unionByName(more)
    return unwrapped(rows.join(written(going.distinct(), "simhash-going"), "row_no", "left_anti"))
