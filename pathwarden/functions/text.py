"""Column expressions over the other attributes of a row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pathwarden.functions.paths import segments
from pathwarden.model import ATTRIBUTE_ORDER, KEPT_LEVELS


def bucket_level_name(level: Column) -> Column:
    """Levels of interest stay, every other one (null too) becomes REGION."""
    return F.when(level.isin(KEPT_LEVELS), level).otherwise(F.lit("REGION"))


def compose_text(columns: list[Column], separator: str = " ") -> Column:
    """Join values to one text; a missing value is written as `nan`."""
    return F.concat_ws(separator, *[F.coalesce(c.cast("string"), F.lit("nan")) for c in columns])


def normalize_bool_text(text: Column) -> Column:
    """True only for the word true, whatever its case and surrounding blanks."""
    return F.coalesce(F.lower(F.trim(text)) == "true", F.lit(False))


def code_suffix_valid(path: Column, code: Column) -> Column:
    """The code is the last path segment, or that segment's first two characters, then digits."""
    last = F.element_at(segments(path), -1)
    digits = "^[0-9]+$"
    return (
        F.when(path.isNull() | code.isNull(), False)
        .when(F.startswith(code, last), F.substring(code, F.length(last) + 1, F.length(code)).rlike(digits))
        .when(F.startswith(code, F.substring(last, 1, 2)), F.substring(code, F.lit(3), F.length(code)).rlike(digits))
        .otherwise(False)
    )


def attribute_column(text: Column, ignore_case: bool = False) -> Column:
    """The first attribute, in the fixed order, that occurs in `text` as a whole word.

    `ignore_case` is the mode for problem names, where every uniqueness problem
    counts as one of NAME.
    """
    flag = "(?i)" if ignore_case else ""
    start = F.when(F.startswith(text, F.lit("UniquenessConstraint")), F.lit("NAME")) if ignore_case else None

    def step(chain, attribute):
        found = text.rlike(rf"{flag}\b{attribute}\b")
        return F.when(found, F.lit(attribute)) if chain is None else chain.when(found, F.lit(attribute))

    return reduce(step, ATTRIBUTE_ORDER, start)


def inferred_kind(value: Column) -> Column:
    """What a value looks like in text form: Unknown, Fractional, Integral, Boolean or String."""
    text = value.cast("string")
    # Fixed patterns of the data type analyzer.
    return (
        F.when(text.isNull(), "Unknown")
        .when(text.rlike(r"^(-|\+)? ?\d*\.\d*$"), "Fractional")
        .when(text.rlike(r"^(-|\+)? ?\d*$"), "Integral")
        .when(text.rlike(r"^(true|false)$"), "Boolean")
        .otherwise("String")
    )


def title_name(name: Column) -> Column:
    """Lower-case, trimmed, underscores as blanks, then each run of letters capitalised, wherever it begins."""
    plain = F.replace(F.trim(F.lower(name)), F.lit("_"), F.lit(" "))
    # A blank before each run makes it a word of its own; the mark tells which blanks to take out again.
    mark = "\u0001 "
    words = F.initcap(F.regexp_replace(plain, r"(?<!\p{L})(?=\p{L})", mark))
    return F.replace(words, F.lit(mark), F.lit(""))
