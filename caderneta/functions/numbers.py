"""Number functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caderneta.functions.text import strip


# Fixed value: what counts as a number.  A cast alone would also take ``1d``, ``NaN``,
# ``Infinity`` and hexadecimal.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _parse(trimmed: Column) -> Column:
    return F.when(trimmed.rlike(NUMBER), trimmed.try_cast("double"))


def to_double(text: Column) -> Column:
    """Plain decimal text as double, null when it is not a number."""
    return _parse(strip(text))


def br_number(text: Column) -> Column:
    """``1.234,56`` as 1234.56: dots are thousands, the comma is the point.

    Blank or invalid text is 0.0.
    """
    return plain_number(br_plain(text))


def br_plain(text: Column) -> Column:
    """The plain text that ``br_number`` reads: comma to point, points dropped."""
    return F.translate(strip(text), ",.", ".")


def plain_number(plain: Column) -> Column:
    """``br_number`` of what ``br_plain`` made."""
    return F.coalesce(_parse(plain), F.lit(0.0))


def br_percent(text: Column) -> Column:
    """``64,29%`` as 64.29."""
    return br_number(F.rtrim(strip(text), F.lit("%")))


def skip_nan(value: Column) -> Column:
    """NaN as null, so that sums skip it."""
    return F.nanvl(value, F.lit(None).cast("double"))


def money_mean(total: Column, count: Column) -> Column:
    """Mean of amounts, rounded once, to cents."""
    return F.round(total / count, 2)


def number_text(number: str) -> str:
    """SQL for a double (given as SQL) in plain notation, ``150.0`` or ``12345678.9``.

    The string cast switches to ``1.0E7`` outside [1e-3, 1e7), which BI tools read
    as text.
    """
    return f"""CASE
        WHEN abs({number}) < 1e16 AND {number} = floor({number})
            THEN concat(cast({number} AS bigint), '.0')
        WHEN abs({number}) >= 1e-3 AND abs({number}) < 1e7 THEN cast({number} AS string)
        WHEN abs({number}) >= 1e-4 AND abs({number}) < 1e16
            THEN trim(TRAILING '0' FROM try_cast(cast({number} AS string) AS decimal(38, 18)))
        ELSE cast({number} AS string) END"""


def grouped_text(value: Column, decimals: int) -> Column:
    """``1_234.50``: thousands marked by underscores."""
    return F.translate(F.format_number(value, decimals), ",", "_")
