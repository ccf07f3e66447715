"""Column functions on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Trim all Unicode white space, and the separators U+001C to U+001F."""
    left = F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+", "")
    return F.regexp_replace(left, r"(?U)[\s\x1c-\x1f]+\z", "")


def letters_digits(c: Column) -> Column:
    """Lower case with everything but letters and digits removed."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{M}\p{N}]+", "")


def words_of(c: Column) -> Column:
    """Maximal runs of letters or digits, in lower case."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))
