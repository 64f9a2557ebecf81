"""Casts of text columns that give null for a bad value, with ANSI mode on or off.

Tables have dozens of such columns, so each cast is one SQL expression of the column's name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv

_WITH_FRACTION = r"^\s*([+-]?[0-9]*)\.[0-9]*\s*$"


def quoted(name: str) -> str:
    return f"`{name}`"


def without_suffix(name: str) -> str:
    """SQL that takes one trailing underscore off; the regex only runs where there is an underscore, but not at the end."""
    c = quoted(name)
    elsewhere = f"if(contains({c}, '_'), regexp_replace({c}, '_$', ''), {c})"
    return f"if(endswith({c}, '_'), left({c}, length({c}) - 1), {elsewhere})"


def to_int(name: str) -> Column:
    """Text to int, cutting a fraction off (``12.7`` is 12, ``.5`` is 0). The regex only runs where there is a point.

    A failed cast costs Spark an exception, far more than a good one. So none is tried on what is no integer at first sight: a
    text with a point or an underscore, or one that begins with a letter.
    """
    c = quoted(name)
    digits = f"regexp_extract({c}, r'{_WITH_FRACTION}', 1)"
    whole = f"if({digits} IN ('', '+', '-'), 0, try_cast({digits} AS INT))"
    cut = f"if({c} RLIKE r'{_WITH_FRACTION}', {whole}, NULL)"
    hopeless = f"contains({c}, '_') OR ({c} >= ':' AND {c} < '\\u007f')"
    return F.expr(f"CASE WHEN contains({c}, '.') THEN {cut} WHEN {hopeless} THEN NULL ELSE try_cast({c} AS INT) END")


def to_strict_int(name: str, pattern: str = fv.INTEGER_PATTERN) -> Column:
    """Text to int only where the whole text has the integer format."""
    c = quoted(name)
    return F.expr(f"if({c} RLIKE r'{pattern}', try_cast({c} AS INT), NULL)")


def _double(text: str) -> str:
    """An empty text, or one with an underscore, is no number; see ``to_int`` for why the cast is not tried on it."""
    return f"if({text} = '' OR contains({text}, '_'), NULL, try_cast({text} AS DOUBLE))"


def to_double(name: str, drop_suffix: bool = False) -> Column:
    c = quoted(name)
    if not drop_suffix:
        return F.expr(_double(c))
    return F.expr(f"if(contains({c}, '_'), {_double(without_suffix(name))}, {_double(c)})")


def to_float(name: str) -> Column:
    """Text to float32 by way of double, so that it rounds as a numeric column would."""
    return F.expr(f"try_cast({_double(quoted(name))} AS FLOAT)")


def to_date(name: str) -> Column:
    return F.col(name).try_cast("date")


CASTS = {"string": F.col, "int": to_int, "double": to_double, "float": to_float, "date": to_date}


def cast_to(name: str, type_name: str) -> Column:
    return CASTS[type_name](name)
