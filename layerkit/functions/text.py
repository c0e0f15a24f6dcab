"""Text functions as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerkit.functions._util import as_col

# Fixed value: the word pattern of the keyword classifiers, applied to the
# lower-cased text (letters and apostrophes).
WORD_PATTERN = "[a-z']+"


def normalise(col) -> Column:
    """``upper(trim(x))``; trims spaces only, like SQL ``trim``."""
    return F.upper(F.trim(as_col(col)))


def full_match(col, pattern: str) -> Column:
    """Whole-value regex match. ``\\A``/``\\z`` anchors: Java ``$`` would also
    accept a value ending in a newline."""
    return as_col(col).rlike(r"\A(?:" + pattern + r")\z")


def token_set(col, pattern: str = WORD_PATTERN, lowered: bool = False) -> Column:
    """Distinct regex tokens of the lower-cased text, as ``array<string>``
    (``lowered=True``: the column is already lower case)."""
    c = as_col(col) if lowered else F.lower(as_col(col))
    return F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), 0))


def _words(words: Iterable[str]) -> Column:
    return F.array(*[F.lit(w) for w in sorted(set(words))]).cast("array<string>")


def hits(tokens, words: Iterable[str]) -> Column:
    """Number of distinct ``tokens`` that are in ``words`` (set overlap size)."""
    return F.size(F.array_intersect(as_col(tokens), _words(words)))


def overlaps(tokens, words: Iterable[str]) -> Column:
    """True when the token set and the word list share a member."""
    return F.arrays_overlap(as_col(tokens), _words(words))


def phrase_hits(col, phrases: Iterable[str], lowered: bool = False) -> Column:
    """How many of ``phrases`` occur as substrings of the lower-cased text."""
    low = as_col(col) if lowered else F.lower(as_col(col))
    terms = [F.when(low.contains(p.lower()), 1).otherwise(0) for p in sorted(set(phrases))]
    if not terms:
        return F.lit(0)
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def contains_any(col, needles: Iterable[str]) -> Column:
    """OR of substring tests."""
    c = as_col(col)
    needles = list(needles)
    if not needles:
        return F.lit(False)
    out = c.contains(needles[0])
    for n in needles[1:]:
        out = out | c.contains(n)
    return out


def first_word(col) -> Column:
    """First word between white space, in the Unicode sense and with U+001C to
    U+001F; empty if there is none."""
    return F.regexp_extract(as_col(col), r"(?U)[^\s\x1c-\x1f]+", 0)
