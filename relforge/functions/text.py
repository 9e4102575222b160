"""Date formats, word transliteration, ordered distinct string lists.

All are column expressions over built-in functions (JVM-side, codegen'd).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Output formats of a ``YYYYMMDD`` release date.
DATE_FORMATS = {
    "ddMonthYYYY": "dd MMMM yyyy",
    "YYYYMMDD": "yyyyMMdd",
    "YYYY": "yyyy",
    "MonYY": "MMMyy",
    "ddmmyy": "dd.MM.yy",
    "YmdDashes": "yyyy-MM-dd",
}


def parse_release_date(col) -> Column:
    """Strict ``YYYYMMDD`` parse: null unless 8 characters and a real date."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.length(c) == 8, F.try_to_date(c, "yyyyMMdd"))


def date_formats(df: DataFrame, col: str) -> DataFrame:
    """Every format of a release-date column, plus ``valid`` (the check table
    that replaces the reference's exception on a bad date)."""
    d = parse_release_date(col)
    return df.select(F.col(col), d.isNotNull().alias("valid"),
                     *[F.date_format(d, fmt).alias(name) for name, fmt in DATE_FORMATS.items()])


def transliterate_words(col, words: dict) -> Column:
    """Replace each listed word by its ASCII form."""
    c = F.col(col) if isinstance(col, str) else col
    for w, a in words.items():
        c = F.replace(c, F.lit(w), F.lit(a))
    return c


def ordered_distinct_join(col, sep: str = " | ") -> Column:
    """G14 (aggregate): sorted distinct values joined by ``sep``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.array_sort(F.collect_set(c)), sep)


def uk_date(col) -> Column:
    """A date shown as ``dd/MM/yyyy`` (the reference's style-103 conversion)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "dd/MM/yyyy")


def name_suffix_date(col, width: int = 8) -> Column:
    """The ``YYYYMMDD`` suffix of a dated table name (null unless a real date)."""
    c = F.col(col) if isinstance(col, str) else col
    suffix = F.right(c, F.lit(width))
    return F.when(parse_release_date(suffix).isNotNull(), suffix)


def collate_keys(df: DataFrame, cols, collation: str = "UNICODE_CI") -> DataFrame:
    """Re-type string key columns with a collation (default case-insensitive).

    Every later join, group-by or DISTINCT on these columns then compares under it,
    which is what the reference's ``COLLATE ... CI`` on cross-database joins does;
    the operators need no change.  Binary equality stays the default.
    """
    return df.withColumns({c: F.collate(F.col(c), collation) for c in cols})
