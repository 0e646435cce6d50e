"""Price text to decimals, the numeric test of the quality gate, and the mid price."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickframe.schemas import PriceMode

_BLANKS = " \t\n\r\f\v"

# Text the gate counts as a number: decimal or exponent notation, digit groups joined by single
# underscores, nan, inf and infinity, any case, blanks around it.
NUMERIC_TEXT = (
    r"(?i)^\s*[+-]?("
    r"nan|inf|infinity|"
    r"(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?"
    r")\s*$"
)


def is_numeric(text: Column) -> Column:
    return text.rlike(NUMERIC_TEXT)


def parse_price(text: Column, mode: PriceMode) -> Column:
    """Price text as a decimal; NULL where it does not fit, is padded, or has too many decimals.

    A mode with a double mid rounds half-up instead, which is what it is for. Text is compared with
    the decimal at the widest scale; longer text than that holds is taken for too long.
    """
    unpadded = F.trim(text, F.lit(_BLANKS)) == text
    price = text.try_cast(mode.price_type)
    if mode.mid_is_double:
        return F.when(unpadded, price)
    whole = mode.precision - mode.scale
    exact = text.try_cast(T.DecimalType(38, 38 - whole)) == price
    return F.when(unpadded & exact & (F.length(text) <= 40), price)


def mid_price(bid: Column, ask: Column, mode: PriceMode) -> Column:
    """Middle of bid and ask; NULL when either is NULL."""
    if mode.mid_is_double:
        return (bid + ask) / F.lit(2.0)
    half = F.lit("0.5").cast("decimal(1,1)")
    return ((bid + ask) * half).cast(mode.mid_type)
