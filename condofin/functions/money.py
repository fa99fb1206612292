"""Text -> number parsers for the import files (column expressions, no UDF).

Money text mixes locales: ``41,305.27`` (comma groups, dot decimals),
``58.912,63`` (dot groups, comma decimals), ``246,175,00`` (commas only, the
last one decimal) and ``0,00``.  Rule: the last ``.`` or ``,`` followed by one
or two digits at the end is the decimal mark; every other separator groups
thousands.  A value with no such ending is an integer (``1.234`` = 1234).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import COEF, MONEY

_DEC_TAIL = r"[.,](\d{1,2})$"


def parse_money(c: Column, dtype=MONEY) -> Column:
    """Mixed-locale money text -> DECIMAL (NULL when not a number)."""
    s = F.regexp_replace(F.trim(c), r"[\s$]", "")
    has_dec = s.rlike(_DEC_TAIL)
    head = F.when(has_dec, F.regexp_extract(s, r"^(.*)" + _DEC_TAIL, 1)).otherwise(s)
    digits = F.regexp_replace(head, r"[.,]", "")
    frac = F.when(has_dec, F.regexp_extract(s, _DEC_TAIL, 1)).otherwise(F.lit("0"))
    return F.when(s == "", F.lit(None)).otherwise(
        F.concat(digits, F.lit("."), frac).try_cast(dtype))


def parse_decimal_comma(c: Column, dtype=COEF) -> Column:
    """``4,4`` -> 4.4 (a single decimal comma, no grouping)."""
    return F.regexp_replace(F.trim(c), ",", ".").try_cast(dtype)


#: How the files say yes and no, after trimming and in capitals.
YES, NO = ("SI", "S\u00cd", "S"), ("NO", "N")


def parse_flag(c: Column) -> Column:
    """Yes or no (any case, blanks around) -> boolean, NULL for anything else."""
    v = F.upper(F.trim(c))
    return F.when(v.isin(*YES), True).when(v.isin(*NO), False)


# Formatters used to derive file text from tables (inverse of parse_money).
def format_money(c: Column, shape: int) -> Column:
    """Money as text in one of the four shapes (0 US, 1 EU, 2 commas, 3 plain comma)."""
    us = F.format_number(c, 2)
    if shape == 0:
        return us
    if shape == 1:
        return F.translate(us, ",.", ".,")
    if shape == 2:
        return F.translate(us, ".", ",")
    return F.translate(c.cast(MONEY).cast("string"), ".", ",")


def format_money_by(c: Column, shape: Column) -> Column:
    """Money text whose shape (0-3) is chosen per row."""
    return (F.when(shape == 0, format_money(c, 0)).when(shape == 1, format_money(c, 1))
            .when(shape == 2, format_money(c, 2)).otherwise(format_money(c, 3)))
