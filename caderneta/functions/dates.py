"""Date functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caderneta.functions.text import strip

# Fixed value: day zero of spreadsheet date serials.
SERIAL_EPOCH = "1899-12-30"


def serial_to_date(serial: Column) -> Column:
    """Spreadsheet day serial (fraction dropped) as date."""
    return F.date_add(F.lit(SERIAL_EPOCH).cast("date"), serial.try_cast("int"))


# Fixed value: three whole numbers between slashes.
BR_DATE = r"^[+-]?[0-9]+\s*/\s*[+-]?[0-9]+\s*/\s*[+-]?[0-9]+$"


def br_date_parts(text: Column) -> Column:
    """``dd/mm/yy`` as struct(dia, mes, aa), null unless three whole numbers.

    The text needs 8 characters or more after trimming.  A part beyond a 64-bit number is
    null: it is in no calendar.  The year stays as
    printed: resolving it takes the document number.
    """
    trimmed = strip(text)
    numbers = [number.alias(name) for name, number in date_numbers(trimmed).items()]
    return F.when(is_br_date(trimmed), F.struct(*numbers))


def is_br_date(trimmed: Column) -> Column:
    """Whether ``br_date_parts`` has parts for a text that is trimmed already."""
    return (F.length(trimmed) >= 8) & trimmed.rlike(BR_DATE)


def date_numbers(trimmed: Column) -> dict[str, Column]:
    """The three parts of a text that ``is_br_date``."""
    parts = F.split(trimmed, "/")
    return {
        name: F.get(parts, F.lit(i)).try_cast("bigint") for i, name in enumerate(("dia", "mes", "aa"))
    }


def valid_date(year: Column, month: Column, day: Column) -> Column:
    """The calendar date, or null when there is none (31/02, month 13)."""
    text = F.format_string("%04d-%02d-%02d", year, month, day)
    return F.when(year.between(1, 9999), text.try_cast("date"))


def date_text(date: Column) -> Column:
    """ISO text; a missing date prints as ``None`` (part of the id contract)."""
    return F.coalesce(date.cast("string"), F.lit("None"))


def month_text(date: Column) -> Column:
    """``yyyy-MM``; undated rows form the month ``NaT``, which sorts last."""
    return F.coalesce(F.substring(date.cast("string"), 1, 7), F.lit("NaT"))
