"""Patterns of the text statistics and of the cleaning rules.

Every pattern is written once and serves two engines: Java (Spark) and RE2 (the
SQL that results are held against).
"""

from __future__ import annotations

import unicodedata

# Line separators, white space, and the shapes that are counted or cleaned.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
ODD_BREAKS = r"[\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# What is not one plain space already: runs of BLANK from another sign on, or of several.
BLANK_RUN = rf"[\x09-\x0d\x1c-\x1f\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]{BLANK}*| {BLANK}+"
NO_BREAK_SPACES = r"[\x{a0}\x{2007}\x{202f}]"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"\+?\d[\d\s().-]{7,}\d"
DATE = r"\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b|\b\d{4}-\d{2}-\d{2}\b"
MONEY = r"\$\s?\d|\b\d+[,.]?\d*\s?(?:USD|EUR|PLN|GBP)\b"
REDACTED = (r"Non-Responsive\s*-\s*Redacted", r"Privileged\s*-\s*Redacted")
HEADER_LINE = r"^(?:from|to|cc|bcc|sent|date|subject|attachments|importance)\s*:\s*"
LOOSE_HEADER_LINE = r"^[^\w]{0,3}(?:from|to|cc|bcc|sent|date|subject|attachments|importance)\s*:\s*"
QUOTED_PRINTABLE = r"=[0-9A-F]{2}"
TIMESTAMP_LINE = r"^\s*\d{1,2}/\d{1,2}/\d{2,4}\s+\d{1,2}:\d{2}(?::\d{2})?\s*(?:AM|PM)?\s*$"
CHAT_PREFIXES = ("source entry:", "service:", "start time:", "end time:", "last message")
TIME = r"\b\d{1,2}:\d{2}(?::\d{2})?\b"
_YEARS = r"(?:19\d{2}|20\d{2})"
_MONTH, _DAY = r"(?:0?[1-9]|1[0-2])", r"(?:0?[1-9]|[12]\d|3[01])"
NUMERIC_DATE = rf"\b(?:{_YEARS}[/-]{_MONTH}[/-]{_DAY}|{_MONTH}[/-]{_DAY}[/-](?:19\d{{2}}|20\d{{2}}|\d{{2}}))\b"
_MONTHS = "(?:jan|january|feb|february|mar|march|apr|april|may|jun|june|jul|july|aug|august|sep|sept|september|oct|october|nov|november|dec|december)"
MONTH_DATE = rf"\b{_MONTHS}\s+\d{{1,2}}(?:st|nd|rd|th)?(?:,\s*)?{_YEARS}?\b|\b\d{{1,2}}(?:st|nd|rd|th)?\s+{_MONTHS}(?:\s+{_YEARS})?\b"
YEAR = rf"\b{_YEARS}\b"
FORWARD_LINE = r"^-{2,}\s*(?:original message|forwarded message)\s*-{2,}$"
BEGIN_FORWARD_LINE = r"^begin forwarded message\s*:\s*$"
SENT_FROM_LINE = r"^sent from my (?:iphone|ipad)\b"
ON_BEHALF_LINE = r"^\s*on behalf of\b"
SLASHED_DATE = r"\b\d{1,2}/\d{1,2}/(?:\d{2}|\d{4})\b"
ANY_HEADER = r"(?m)^\s*(?:from|to|cc|bcc|sent|date|subject|importance)\s*:"
UNDERSCORES = r"_{8,}"


def _ranges(points: list[int]) -> str:
    out, start = [], None
    for a, b in zip(points, [*points[1:], None]):
        start = a if start is None else start
        if b != a + 1:
            out.append(f"\\x{{{start:x}}}-\\x{{{a:x}}}" if a > start else f"\\x{{{a:x}}}")
            start = None
    return "".join(out)


#: Digits beside decimal ones (superscripts, circled digits and so on), as a rule of Unicode.
OTHER_DIGITS = _ranges([c for c in range(0x110000) if chr(c).isdigit() and unicodedata.category(chr(c)) != "Nd"])


def java(pattern: str, fold: bool = False) -> str:
    """For Spark: classes and word bounds go by Unicode; ``fold`` ignores case."""
    return f"(?{'i' if fold else ''}U){pattern}"


def re2(pattern: str, fold: bool = False) -> str:
    return f"(?i){pattern}" if fold else pattern
