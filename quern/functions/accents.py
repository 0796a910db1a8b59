"""Accent stripping in the JVM: compatibility decomposition without combining marks."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blocks whose letters decompose: Latin, Greek, Cyrillic, full-width forms.
_BLOCKS = ((0xA0, 0x24F), (0x1E00, 0x1FFF), (0x370, 0x52F), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF00, 0xFF5E))
_MARKS = ((0x300, 0x36F), (0x1AB0, 0x1AFF), (0x1DC0, 0x1DFF), (0x20D0, 0x20FF), (0xFE20, 0xFE2F))


def plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


@functools.cache
def _tables() -> tuple[str, str, dict[str, str]]:
    found = {chr(c): plain(chr(c)) for a, b in _BLOCKS for c in range(a, b + 1)}
    single = {c: p for c, p in found.items() if len(p) == 1 and p != c}
    marks = "".join(chr(c) for a, b in _MARKS for c in range(a, b + 1) if unicodedata.combining(chr(c)))
    ligatures = {chr(c): plain(chr(c)) for c in range(0xFB00, 0xFB07)}  # the only ones common in prose
    return "".join(single) + marks, "".join(single.values()), ligatures


def strip_accents(text: Column) -> Column:
    """Letters without accents.  Marks are dropped, ligatures of f taken apart; signs
    that decompose into several others (fractions and the like) stay."""
    source, target, ligatures = _tables()
    for sign, letters in ligatures.items():
        text = F.replace(text, F.lit(sign), F.lit(letters))
    return F.translate(text, source, target)
