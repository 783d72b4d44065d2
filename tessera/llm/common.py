"""Column helpers shared by the operators of this package."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blanks between words: space and U+0009 to U+000D; the first characters of a word.
BLANKS = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).when(text.rlike("[A-Z]"), slow).otherwise(text)


def words(text: Column, gap: str = BLANKS) -> Column:
    """The words between runs of ``gap``; none for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), gap), lambda w: w != "")


def lower_words(text: Column, gap: str = BLANKS) -> Column:
    """The words with A-Z in lower case; ``gap`` must not match letters."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, words(F.lower(text), gap)).otherwise(F.transform(words(text, gap), lower_ascii))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, and only where the result is needed."""
    return F.element_at(F.transform(F.array(value), use), 1)


def text_key(text: Column) -> Column:
    """A 64-bit key of a text; null and empty texts share one."""
    return F.xxhash64(F.coalesce(text, F.lit("")))
