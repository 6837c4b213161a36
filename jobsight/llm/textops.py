"""Small text helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null stays null."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % n
