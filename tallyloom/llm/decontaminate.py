"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

A test item of q distinct five-word shingles is contained in a document if the document holds at least
need = ceil(threshold * q) of them. Hashing orders the shingles of an item; its q - need + 1 smallest hashes
are its sketch. A document that holds ``need`` of q shingles misses at most q - need, so it holds at least one of
the sketch: the search loses no pair, whatever the length of the document. (Banded signatures of whole documents
would: an item of 30 shingles in a document of 20,000 has a Jaccard similarity near 0.001.) Items are partitioned by size,
which fixes the length of their sketch, and documents with fewer shingles than an item needs are not searched for it.

Step one looks up the shingle hashes of every document in the sketches and leaves pairs of ids. Step two
reads the texts of the documents in such pairs again and counts the shingles of the item that they hold, comparing the words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import ROW, ascii_lower, unwrapped, wrapped, written

WORDS = 5
THRESHOLD = 0.8
#: Item tables up to this many bytes are broadcast; larger ones are joined by shuffle, as Spark decides.
BROADCAST_BYTES = 64 << 20


def words_of(text: Column) -> Column:
    """Runs of characters other than ASCII white space, A-Z in lower case; null has none."""
    blanks = "\t\n\x0b\x0c\r"
    plain = F.trim(F.translate(ascii_lower(text), blanks, " " * len(blanks)))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " +"))


def shingled(rows: DataFrame, words: str, keep: list[str]) -> DataFrame:
    """``keep``, ``n_shingles`` and the words ``w1`` to ``w5`` of every shingle, in generated code throughout."""
    long = rows.where(F.size(words) >= WORDS).withColumn("n_shingles", F.size(words) - (WORDS - 1))
    shifted = [F.slice(words, i, F.col("n_shingles")).alias(f"w{i}") for i in range(1, WORDS + 1)]
    return long.select(*keep, "n_shingles", F.inline(F.arrays_zip(*shifted)))


def _hash() -> Column:
    return F.xxhash64(*[F.col(f"w{i}") for i in range(1, WORDS + 1)]).alias("hash")


def _shingle() -> Column:
    return F.concat_ws(" ", *[F.col(f"w{i}") for i in range(1, WORDS + 1)]).alias("shingle")


def item_shingles(items: DataFrame, item_col: str, text_col: str, threshold: float) -> DataFrame:
    """Distinct shingles of every item with their hash, the number needed and whether they are in the sketch.

    Rows with one item id are one item. Items of fewer than five words have no shingle and are found nowhere.
    """
    rows = items.select(F.col(f"`{item_col}`").alias("item_id"), words_of(F.col(f"`{text_col}`")).alias("words"))
    distinct = shingled(rows, "words", ["item_id"]).select("item_id", _shingle(), _hash()).distinct()
    sizes = distinct.groupBy(F.col("item_id").alias("of")).agg(F.count("*").alias("q"), F.sort_array(F.collect_list("hash")).alias("ordered"))
    need = F.ceil(F.lit(threshold) * F.col("q") - F.lit(1e-9)).cast("int")
    sizes = sizes.select("of", "q", need.alias("need"), F.element_at("ordered", (F.col("q") - need + 1).cast("int")).alias("last"))
    return distinct.join(sizes, F.col("item_id").eqNullSafe(F.col("of"))).select("item_id", "shingle", "hash", "q", "need", (F.col("hash") <= F.col("last")).alias("in_sketch"))


def _with_words(rows: DataFrame) -> DataFrame:
    return rows.select("id", "text_key", words_of(F.col("text")).alias("words"))


def _small(table: DataFrame, width: int) -> DataFrame:
    """Broadcast if its rows, at most ``width`` bytes each besides the shingle, are known to fit."""
    held = table.agg(F.sum(F.octet_length("shingle") + width) if "shingle" in table.columns else F.count("*") * width).first()[0] or 0
    return F.broadcast(table) if held <= BROADCAST_BYTES else table


def contained_items(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Pairs of a document and an item it contains: ``id_col``, ``text_key``, ``item_id``, ``shared``, ``item_shingles``, ``containment``.

    A document is an id together with a text (``text_key`` is the text's hash): repeated rows count once, rows with
    one id and several texts, or without an id, stay apart. Null and short texts contain nothing.
    """
    found = written(item_shingles(items, item_col, item_text_col, threshold), "decontaminate-items")
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    sketch = _small(found.where("in_sketch").select("item_id", "hash", "need"), 64)
    searched = shingled(_with_words(rows), "words", ["id", "text_key"]).select("id", "text_key", "n_shingles", _hash())
    hits = searched.join(sketch, "hash").where("need <= n_shingles")
    pairs = written(hits.select("id", "text_key", "item_id").distinct(), "decontaminate-pairs")
    suspects = pairs.select(F.col("id").alias("suspect"), F.col("text_key").alias("suspect_key")).distinct()
    again = rows.join(suspects, F.col("id").eqNullSafe(F.col("suspect")) & (F.col("text_key") == F.col("suspect_key")), "left_semi")
    shingles = shingled(_with_words(again), "words", ["id", "text_key"]).select("id", "text_key", _hash(), _shingle())
    held = shingles.join(_small(found.select("item_id", "hash", "shingle", "q", "need"), 64), ["hash", "shingle"])
    counted = held.select("id", "text_key", "item_id", "q", "need", "shingle").distinct().groupBy("id", "text_key", "item_id", "q", "need").agg(F.count("*").alias("shared"))
    return counted.where("shared >= need").select(
        F.col("id").alias(id_col), "text_key", "item_id", "shared", F.col("q").alias("item_shingles"), (F.col("shared") / F.col("q")).alias("containment")
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item."""
    found = contained_items(docs, items, id_col, text_col).select(F.col(id_col).alias("bad_id"), F.col("text_key").alias("bad_key")).distinct()
    bad = written(found, "decontaminate-found")
    same = F.col(ROW)[id_col].eqNullSafe(F.col("bad_id")) & (F.xxhash64(F.col(ROW)[text_col]) == F.col("bad_key"))
    return unwrapped(wrapped(docs).join(bad, same, "left_anti"))
