"""Order-free fingerprints of tables: row count and sums of two row hashes.

Sums merge over tasks in any order and count each copy of a row, so two tables have equal fingerprints
if they hold the same rows as often, but for a chance of about 2^-64 per hash. A null differs from every value and from a
null in another column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Salts of the two hashes, and characters that stand for a null and between values in portable text.
_SALTS = (17, 911)
NULL_TEXT, BETWEEN = "\x00", "\x1f"


def row_hashes(cols) -> list[Column]:
    """Two 64-bit hashes of a row's values, columns or names, in their order."""
    cols = [F.col(f"`{c}`") if isinstance(c, str) else c for c in cols]
    marked = [x for c in cols for x in (c, c.isNull())]
    return [F.xxhash64(F.lit(salt), *marked) for salt in _SALTS]


def portable_hash(cols) -> Column:
    """60 bits of the MD5 of a row as text: the same in every engine, for columns whose text form is."""
    text = F.concat_ws(BETWEEN, *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NULL_TEXT)) for c in cols))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def total(h) -> Column:
    """The exact sum of 64-bit hashes."""
    return F.sum((F.col(h) if isinstance(h, str) else h).cast("decimal(28,0)"))


def fingerprint(df: DataFrame, by=(), portable: bool = False) -> DataFrame:
    """(by...), rows, fingerprint (text) of the rows, over all columns but ``by``; one partial aggregate."""
    by = [by] if isinstance(by, str) else list(by)
    cols = [c for c in df.columns if c not in by]
    hashes = [portable_hash(cols)] if portable else row_hashes(cols)
    sums = F.concat_ws(":", *(F.coalesce(total(h), F.lit(0)).cast("decimal(38,0)").cast("string") for h in hashes))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), sums.alias("fingerprint"))
