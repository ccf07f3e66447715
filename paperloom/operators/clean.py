"""Cleaning of question texts, types and options (column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import strip

#: What may stand before a question's text, and an option's.
HEADER = r"(?iU)^(?:Question Number\s*:\s*\d+\s*)?(?:Question Id\s*:\s*\d+\s*)?(?:Question Type\s*:\s*[A-Za-z]+\s*)?"
TEXT_PREFIX = r"(?U)^\d+\.\s*(?:…\s*)?"
OPTION_PREFIX = r"(?U)^\d+\.\s*(?:→\s*|…\s*)?"
NO_OPTIONS = ("COMPREHENSION", "NAT", "SA")
MAX_OPTIONS = 8


def clean_text(text: Column) -> Column:
    """Header remains and a number prefix taken off, stripped."""
    body = strip(F.regexp_replace(text, HEADER, ""))
    return strip(F.regexp_replace(body, TEXT_PREFIX, ""))


def branch_type(kind: Column) -> Column:
    """The type used for branching; the stored value keeps its case."""
    return F.upper(F.coalesce(kind, F.lit("MCQ")))


def clean_options(kind: Column, options: Column) -> Column:
    """No options for types that have none and for more than eight; a null
    option prints as None."""
    none = F.array().cast("array<string>")
    each = F.transform(options, lambda o: strip(F.regexp_replace(F.coalesce(o, F.lit("None")), OPTION_PREFIX, "")))
    return F.when(branch_type(kind).isin(*NO_OPTIONS) | options.isNull() | (F.size(options) > MAX_OPTIONS), none).otherwise(each)
