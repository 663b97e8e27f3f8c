"""Character-class patterns of text values."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# The class symbols of the pattern tables.
DIGIT, UPPER, LOWER, HANGUL, DOT, BLANK, OTHER = "N", "C", "c", "가", "*", "#", "$"
HANGUL_SYLLABLES = "[가-힣]"
OUTSIDE_CLASSES = "[^NCc가*#$]"

#: Characters below this code point (ASCII and the Latin blocks) are mapped by one table.
TABLE_END = 0x250

_MODES = ("executed", "documented")


def _symbol(char: str, digit: str) -> str:
    if char in string.digits:
        return digit
    if char in string.ascii_uppercase:
        return UPPER
    if char in string.ascii_lowercase:
        return LOWER
    return {".": DOT, " ": BLANK, DOT: DOT, BLANK: BLANK}.get(char, OTHER)


def char_pattern(text: Column, mode: str = "executed") -> Column:
    """Replace every character by the symbol of its class.

    ``executed`` shows digits as the upper-case symbol: that is what profile tables
    hold, because the digit symbol is itself an upper-case letter when the letters
    are replaced. ``documented`` keeps digits as a class of their own.

    Common characters go through one ``translate``. What it leaves unmapped is not
    ASCII, so only texts with more bytes than characters meet the two regexes.
    """
    if mode not in _MODES:
        raise ValueError(f"unknown pattern mode {mode!r}; expected one of {_MODES}")
    digit = UPPER if mode == "executed" else DIGIT
    source = "".join(map(chr, range(TABLE_END)))
    mapped = F.translate(text, source, "".join(_symbol(c, digit) for c in source))
    hangul = F.regexp_replace(mapped, HANGUL_SYLLABLES, HANGUL)
    rest = F.regexp_replace(hangul, OUTSIDE_CLASSES, "\\" + OTHER)
    return F.when(F.octet_length(mapped) == F.length(mapped), mapped).otherwise(rest)
