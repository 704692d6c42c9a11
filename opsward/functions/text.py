"""Text normalisation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD_RUNS = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def trimmed(c: Column) -> Column:
    """Strip spaces at both ends; blank becomes NULL. Tabs and newlines stay."""
    return F.nullif(F.btrim(c), F.lit(""))


def norm_id(c: Column) -> Column:
    return F.upper(trimmed(c))


def norm_key(c: Column) -> Column:
    """Lower-case lookup key for category mappings."""
    return F.lower(trimmed(c))


def initcap_words(c: Column) -> Column:
    """Title case where a word starts after anything that is not a letter or digit.

    Spark's ``initcap`` only starts words after spaces, which is enough for most labels; the
    regular-expression form runs only on values with other separators.
    """
    lowered = F.lower(c)
    runs = F.regexp_extract_all(lowered, F.lit(_WORD_RUNS), 1)
    return F.when(
        lowered.rlike(r"[^\p{L}\p{N} ]"), F.array_join(F.transform(runs, F.initcap), "")
    ).otherwise(F.initcap(lowered))


def norm_label(c: Column, exceptions: Mapping[str, str] | None = None) -> Column:
    """Trimmed title-case label; ``exceptions`` maps lower-case values to fixed spellings."""
    label = initcap_words(trimmed(c))
    for lowered, spelling in (exceptions or {}).items():
        label = F.when(norm_key(c) == lowered, F.lit(spelling)).otherwise(label)
    return label


def matches(c: Column, pattern: str) -> Column:
    r"""Whole-value regular expression test; ``\z`` keeps a trailing newline from matching."""
    return c.rlike(rf"^(?:{pattern})\z")


def bracketed(c: Column) -> Column:
    """Value in square brackets, so blanks around it become visible."""
    return F.concat(F.lit("["), F.coalesce(c, F.lit("NULL")), F.lit("]"))
