"""Numbers written as text: one grammar, used for filter values (Python) and for cells (Catalyst)."""

from __future__ import annotations

import re
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted number grammar. Surrounding blanks, one leading or trailing sign,
# thousands commas after the first digit, a decimal point with digits on either side, an exponent.
_BLANK = r"[ \t\n\x0B\f\r]*"
_UNSIGNED = r"(?:[0-9][0-9,]*(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
NUMBER_PATTERN = rf"^{_BLANK}(?:[+-]?{_UNSIGNED}|{_UNSIGNED}[+-]){_BLANK}$"
# Fixed value: the largest magnitude that takes part in a numeric comparison.
MAX_MAGNITUDE = Decimal("79228162514264337593543950335")

_BLANK_CHARACTERS = " \t\n\x0b\f\r"
#: Plain cells this short are exact as SHORT and are compared as such.
SHORT, SHORT_DIGITS = "decimal(38,15)", 15
_SHORT_PATTERN = rf"^[+-]?[0-9]{{1,{SHORT_DIGITS}}}(?:\.[0-9]{{0,{SHORT_DIGITS}}})?$"
#: Added to an exponent in a key; exponents beyond a long count as the largest.
_OFFSET, _MOST_EXPONENT = 5 * 10**18, 10**18


def parse_number(text: str) -> Decimal | None:
    """The number a filter value denotes, or None when it has to be compared as text."""
    if not re.match(NUMBER_PATTERN.replace("$", r"\Z"), text):
        return None
    digits = text.strip(_BLANK_CHARACTERS).replace(",", "")
    if digits[-1] in "+-":
        digits = digits[-1] + digits[:-1]
    number = Decimal(digits)
    return number if number.copy_abs() <= MAX_MAGNITUDE else None


def plain_digits(column: Column) -> Column:
    """The cell without commas and blanks, a trailing sign moved to the front; NULL if not a number."""
    digits = F.translate(column, "," + _BLANK_CHARACTERS, "")
    digits = F.regexp_replace(digits, r"^([^+-].*)([+-])$", "$2$1")
    return F.when(column.rlike(NUMBER_PATTERN), digits)


def number_key(number: Decimal) -> str:
    """A text that sorts as the number does, whatever its length; `_cell_key` gives that of a cell."""
    sign, digits, exponent = number.as_tuple()
    significant = "".join(map(str, digits)).lstrip("0")
    power = len(significant) + exponent
    significant = significant.rstrip("0")
    if not significant:
        return "1"
    if not sign:
        return f"2{_OFFSET + power:019d}{significant}"
    return f"0{_OFFSET - power:019d}{significant.translate(str.maketrans('0123456789', '9876543210'))}~"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, outside generated code."""
    return F.transform(F.array(value), use)[0]


def _cell_parts(digits: Column) -> Column:
    """Sign, power of ten and significant digits of a cell that `plain_digits` gave."""
    mantissa = F.regexp_replace(digits, r"^[+-]|[eE].*$", "")
    written = F.regexp_extract(digits, r"[eE]([+-]?[0-9]+)$", 1)
    most = F.when(F.startswith(written, F.lit("-")), F.lit(-_MOST_EXPONENT)).otherwise(F.lit(_MOST_EXPONENT))
    given = F.least(F.greatest(F.coalesce(written.try_cast("bigint"), most), F.lit(-_MOST_EXPONENT)), F.lit(_MOST_EXPONENT))
    exponent = F.when(written == "", F.lit(0)).otherwise(given)
    every = F.replace(mantissa, F.lit("."), F.lit(""))
    leading = F.ltrim(every, F.lit("0"))
    power = F.length(F.substring_index(mantissa, ".", 1)) + exponent - (F.length(every) - F.length(leading))
    return F.struct(F.startswith(digits, F.lit("-")).alias("below"), power.alias("power"), F.rtrim(leading, F.lit("0")).alias("significant"))


def _cell_key(parts: Column) -> Column:
    """(key, key of the magnitude)."""
    power, significant = parts["power"], parts["significant"]
    size = F.concat(F.lit("2"), F.lpad((F.lit(_OFFSET) + power).cast("string"), 19, "0"), significant)
    below = F.concat(
        F.lit("0"), F.lpad((F.lit(_OFFSET) - power).cast("string"), 19, "0"), F.translate(significant, "0123456789", "9876543210"), F.lit("~")
    )
    zero = significant == ""
    return F.struct(
        F.when(zero, F.lit("1")).when(parts["below"], below).otherwise(size).alias("key"), F.when(zero, F.lit("1")).otherwise(size).alias("size")
    )


def compare_number(column: Column, number: Decimal, compare) -> Column:
    """`compare(cell, number)` for a text cell, exact at any length; NULL when the cell is no number within `MAX_MAGNITUDE`."""
    digits = plain_digits(column)
    most, wanted = F.lit(number_key(MAX_MAGNITUDE)), F.lit(number_key(number))
    keyed = lambda cell: F.when(cell["size"] <= most, compare(cell["key"], wanted))
    exact = _bound(digits, lambda d: _bound(_cell_parts(d), lambda parts: _bound(_cell_key(parts), keyed)))
    decimals = -number.as_tuple().exponent
    if number.copy_abs() >= 10**22 or decimals > SHORT_DIGITS:
        return exact
    short = compare(digits.try_cast(SHORT), F.lit(f"{number:f}").cast(SHORT))
    return F.when(digits.rlike(_SHORT_PATTERN), short).otherwise(exact)
