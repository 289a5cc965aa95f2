"""Order-independent content checksums.

Every value is marked as known or NULL, and carries its length where values are joined, so that no two different
rows have the same text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_texts(columns: Sequence[str]) -> list[Column]:
    """Every column as text, in name order: ``=`` and the value, or ``~`` for NULL."""
    return [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("~")) for c in sorted(columns)]


def checksum(columns: Sequence[str]) -> Column:
    """Sum of the 64-bit row hashes as an exact decimal; 0 for no rows."""
    hashed = F.xxhash64(*row_texts(columns)).cast("decimal(38,0)")
    return F.coalesce(F.sum(hashed), F.lit(0)).cast("decimal(38,0)")


def portable_checksum(columns: Sequence[str]) -> Column:
    """The same idea on the first 15 hex digits of md5, which other engines can repeat.  For comparison with
    those; two of our own tables are compared by ``checksum``."""
    sized = [F.concat(F.length(text).cast("string"), text) for text in row_texts(columns)]
    hashed = F.conv(F.substring(F.md5(F.concat(*sized)), 1, 15), 16, 10).cast("decimal(38,0)")
    return F.coalesce(F.sum(hashed), F.lit(0)).cast("decimal(38,0)")
