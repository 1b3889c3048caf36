"""Text functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a text strip removes (all Unicode whitespace).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Accented letters and what each becomes.
ACCENTED = "áàãâéêíóôõúçÁÀÃÂÉÊÍÓÔÕÚÇ"
UNACCENTED = "aaaaeeioooucAAAAEEIOOOUC"


def strip(text: Column) -> Column:
    """Trim all Unicode whitespace.

    The plain trim takes off padding fast but knows only the space; the second one
    then has at most a few characters left to look at.
    """
    return F.btrim(F.trim(text), F.lit(WHITESPACE))


def strip_accents(text: Column) -> Column:
    return F.translate(text, ACCENTED, UNACCENTED)


def fold(text: Column) -> Column:
    """Accent- and case-insensitive form, for comparing labels."""
    return F.lower(strip_accents(text))


def after_prefix(text: Column, prefix: str) -> Column:
    """What follows a prefix of known length, trimmed."""
    return strip(F.substr(text, F.lit(len(prefix) + 1)))


def is_digits(text: Column) -> Column:
    return text.rlike("^[0-9]+$")


def truncate(text: Column, length: int = 255) -> Column:
    """Null becomes '', longer text is cut."""
    return F.substring(F.coalesce(text, F.lit("")), 1, length)


def document_type(number: Column) -> Column:
    """The part of a document number before its first ``-`` (all of it if none)."""
    return F.substring_index(number, "-", 1)


PRODUCT_SEPARATOR = " - "


def product_code(product: Column) -> Column:
    """Code before the first separator; '' when there is none."""
    text = F.coalesce(product, F.lit(""))
    return F.when(
        F.contains(text, F.lit(PRODUCT_SEPARATOR)),
        F.substring_index(text, PRODUCT_SEPARATOR, 1),
    ).otherwise("")


def product_description(product: Column) -> Column:
    """Text after the first separator; the whole text when there is none."""
    text = F.coalesce(product, F.lit(""))
    start = F.instr(text, PRODUCT_SEPARATOR)
    return F.when(
        start > 0, F.substr(text, start + len(PRODUCT_SEPARATOR))
    ).otherwise(text)


def snake_case(name: str) -> str:
    """Accent-free snake case of a column name (planning time, not per row)."""
    plain = name.translate(str.maketrans(ACCENTED, UNACCENTED))
    spaced = re.sub("(?=[A-Z])", " ", plain).lower()
    return "_".join(filter(None, re.split(r"[\s_-]+", spaced)))


def base_name(path: Column) -> Column:
    """The name of a file from its path as a scan reports it, percent signs decoded."""
    name = F.substring_index(path, "/", -1)
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
