"""Bytes in UTF-16 as text: byte order, length and surrogates are checked by column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes, as Latin-1 characters, that are whole units without a surrogate that stands alone.
LITTLE = r"\A(?:[\x00-\xFF][^\xD8-\xDF]|[\x00-\xFF][\xD8-\xDB][\x00-\xFF][\xDC-\xDF])*+\z"
BIG = r"\A(?:[^\xD8-\xDF][\x00-\xFF]|[\xD8-\xDB][\x00-\xFF][\xDC-\xDF][\x00-\xFF])*+\z"


def utf16_text(data: Column) -> Column:
    """struct<text, error>: the order is what a mark at the beginning says, little-endian without one; the mark goes."""
    mark = F.hex(F.substring(data, F.lit(1), F.lit(2)))
    big = mark == "FEFF"
    body = F.when(big | (mark == "FFFE"), F.substring(data, F.lit(3), F.greatest(F.length(data) - 2, F.lit(0)))).otherwise(data)
    signs = F.decode(body, "ISO-8859-1")
    whole = F.when(big, signs.rlike(BIG)).otherwise(signs.rlike(LITTLE))
    failed = lambda message: F.struct(F.lit(None).cast("string").alias("text"), F.lit(message).alias("error"))
    text = F.when(big, F.decode(body, "UTF-16BE")).otherwise(F.decode(body, "UTF-16LE"))
    fine = F.struct(text.alias("text"), F.lit(None).cast("string").alias("error"))
    return F.when(data.isNull(), None).when(F.length(data) % 2 == 1, failed("an odd number of bytes is no UTF-16")).when(~whole, failed("a surrogate stands alone")).otherwise(fine)
