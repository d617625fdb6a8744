from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import PARSED_AMOUNT

BEYOND = r"^-?0*[1-9]\d{18,}(\.\d*)?$"
INTEGRAL_OR_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def parse_money(amount: Column, decimal_sep: str = ".") -> Column:
    """Amount text to an exact decimal; what is not one number becomes null.

    Currency signs, letters, brackets and blanks are dropped, so ``(19.90)`` is
    19.90. ``decimal_sep=","`` reads ``1.299,90`` as 1299.90. A number of 19 or
    more whole digits becomes null too; :func:`beyond_range` tells it from garbage.
    """
    plain = _plain(amount, decimal_sep)
    # Digits of other scripts are kept, but do not make a number.
    ascii_only = F.octet_length(plain) == F.char_length(plain)
    return F.when(ascii_only, plain.try_cast(PARSED_AMOUNT))


def _plain(amount: Column, decimal_sep: str) -> Column:
    text = amount.cast("string")
    if decimal_sep == ",":
        return F.replace(F.regexp_replace(text, r"[^\p{Nd},-]", ""), F.lit(","), F.lit("."))
    return F.regexp_replace(text, r"[^\p{Nd}.-]", "")


def beyond_range(amount: Column, decimal_sep: str = ".") -> Column:
    """Whether amount text is a number that is too large to be held; false for null."""
    return F.coalesce(_plain(amount, decimal_sep).rlike(BEYOND), F.lit(False))


def parse_int(number: Column) -> Column:
    """Whole-number text to bigint, sign kept; garbage and fractions become null."""
    text = number.cast("string")
    value = F.when(text.rlike(INTEGRAL_OR_DECIMAL), F.trim(text).try_cast("decimal(38,10)"))
    whole = F.when(value == F.floor(value), value.try_cast("bigint"))
    # Nearly all texts are plain digits and stop at the first cast.
    return F.coalesce(text.try_cast("bigint"), whole)


def line_total(price: Column, quantity: Column, places: int) -> Column:
    """Price times quantity, rounded half up; null where a factor is, or where it is out of range."""
    return F.round(F.try_multiply(price, quantity), places).try_cast(PARSED_AMOUNT)


def to_usd(local: Column, rate_to_usd: Column) -> Column:
    """Amount times rate (USD per local unit), rounded half up to four places."""
    return F.round(F.try_multiply(local, rate_to_usd), 4)
