"""Strings: brand names and masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Slash and brackets, half and full width, part a brand name.
BRAND_SEPARATORS = "[/／()（）]"
EMAIL = r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*"
ADDRESS = r"[0-9]{1,3}(\.[0-9]{1,3}){3}"
NUMBER = r"\+?[0-9][0-9 ()-]{5,}[0-9]"


def brand_tokens(name: Column) -> Column:
    """The parts of a brand name, trimmed, without empty ones. Null gives null."""
    return F.filter(F.transform(F.split(name, BRAND_SEPARATORS), lambda t: F.trim(t)), lambda t: t != "")


def folded(name: Column) -> Column:
    """A key that is equal for spellings which differ in case, width or kana only;
    compare it, and cast it to string before output."""
    return F.collate(name, "UNICODE_CI")


def masked(text: Column) -> Column:
    """A text without e-mail addresses, IP addresses and long numbers."""
    for pattern, to in ((EMAIL, "<mail>"), (ADDRESS, "<address>"), (NUMBER, "<number>")):
        text = F.regexp_replace(text, pattern, to)
    return text
