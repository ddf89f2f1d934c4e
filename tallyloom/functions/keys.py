"""Surrogate keys and pseudonyms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SEPARATOR = "|"


def key_text(*columns: Column) -> Column:
    """Columns as one text with a separator, NULL as empty, so ('1','23') and ('12','3') differ."""
    return F.concat_ws(_SEPARATOR, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def surrogate_key(*columns: Column) -> Column:
    """Signed 64-bit fingerprint of business columns."""
    return F.xxhash64(key_text(*columns))


def md5_key(*columns: Column) -> Column:
    return F.md5(key_text(*columns))


def short_key(*columns: Column) -> Column:
    """32-bit variant."""
    return F.hash(key_text(*columns))


def pseudonym(c: Column, salt: str | None = None) -> Column:
    """Binary pseudonym of a personal field; with a salt it uses SHA-256."""
    text = c.cast("string")
    if salt is None:
        return F.unhex(F.md5(text))
    return F.unhex(F.sha2(F.concat(F.lit(salt), text), 256))
