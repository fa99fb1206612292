"""Exact quotients of decimals, as column expressions.

``a * p / q`` in DECIMAL arithmetic loses digits as soon as the product has
more than 38, and in DOUBLE always.  Here all three are whole numbers of units.
Amounts of cents whose product fits 64 bits, as nearly all do, are divided as
BIGINT; a product of up to 38 digits is divided at once, any other by long
division: the digits of ``a`` are taken four at a time, so no step needs more.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import SHARE

#: Decimal places of a quotient.
SCALE = SHARE.scale
_STEP = 4  # digits taken at a time
_WHOLE = "decimal(38,0)"
_REST = f"decimal({38 - _STEP - 1},0)"


def _units(c: Column, scale: int = SCALE) -> Column:
    """``c`` in units of ``scale`` decimal places (more places are rounded)."""
    return (c.cast(f"decimal(38,{scale})") * F.lit(Decimal(10) ** scale)).cast(_WHOLE)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _half_up(whole: Column, rest: Column, q: Column) -> Column:
    return whole + F.when(rest * 2 >= q, 1).otherwise(0).cast("decimal(1,0)")


#: Cents of operands that are divided as BIGINT: the square fits 64 bits.
_SMALL = 3_000_000_000


def _cents(c: Column) -> tuple[Column, Column]:
    """``c`` in cents as BIGINT, and whether that is all of it, not negative
    and small."""
    cents = c * F.lit(100)
    whole = cents.try_cast("bigint")
    return whole, (whole.cast("decimal(20,0)") == cents) & (whole >= 0) & (whole <= _SMALL)


def _of_cents(a: Column, p: Column, q: Column) -> Column:
    product, step = a * p, F.lit(10 ** (SCALE - 2)).cast("bigint")
    more = (product % q) * step
    return _div(product, q) * step + _div(more, q) + F.when((more % q) * 2 >= q, 1).otherwise(0).cast("bigint")


def _short(a: Column, p: Column, q: Column) -> Column:
    product = a.cast("decimal(19,0)") * p.cast("decimal(18,0)")
    q = q.cast("decimal(18,0)")
    return _half_up(_div(product, q).cast(_WHOLE), product % q, q).cast(_WHOLE)


def _long(a: Column, p: Column, q: Column) -> Column:
    """a * p / q = a * (p div q) + a * (p mod q) / q, the latter digit by digit."""
    q = q.cast(_REST)
    times, rest = _div(p.cast(_WHOLE), q).cast("decimal(19,0)"), (p % q).cast(_REST)
    digits = F.lpad(a.cast("string"), 40, "0")
    steps = F.array(*[F.substring(digits, i, _STEP).cast(f"decimal({_STEP},0)") for i in range(1, 41, _STEP)])
    start = F.struct(F.lit(0).cast(_WHOLE).alias("whole"), F.lit(0).cast(_REST).alias("rest"))

    def step(so_far, digit):
        now = (so_far["rest"] * F.lit(10 ** _STEP) + digit * rest).cast(_WHOLE)
        one = F.transform(F.array(now), lambda t: F.struct(
            (so_far["whole"] * F.lit(10 ** _STEP) + _div(t, q)).cast(_WHOLE).alias("whole"), (t % q).cast(_REST).alias("rest")))
        return F.element_at(one, 1)

    return F.aggregate(steps, start, step, lambda end: (
        (a * times).cast(_WHOLE) + _half_up(end["whole"], end["rest"], q)).cast(_WHOLE))


def quotient(a: Column, p: Column, q: Column) -> Column:
    """``a * p / q`` as DECIMAL(38, 6), exact and then rounded half away from
    zero at the sixth place; NULL where ``q`` is 0 or an operand NULL.

    Operands are taken at six decimal places.  ``q`` may have 27 digits before
    the point, ``a`` and ``p`` 26, and the result 32."""
    return _of([(c, *_cents(c)) for c in (a, p, q)])


def with_quotients(df: DataFrame, a: Column, parts: dict[str, Column], q: Column) -> DataFrame:
    """``df`` with a column :func:`quotient` (a, part, q) for each of ``parts``.

    Operands are columns of projections of their own, so that each is worked
    out once a row, however often a quotient names it."""
    operands = {"a__": a, "q__": q} | {f"p__{n}": c for n, c in parts.items()}
    ready = df.withColumns(operands)
    ready = ready.withColumns({f"{n}_{k}": c for n in operands for k, c in zip("cs", _cents(F.col(n)))})
    done = ready.withColumns({n: _of([(F.col(x), F.col(f"{x}_c"), F.col(f"{x}_s")) for x in ("a__", f"p__{n}", "q__")])
                              for n in parts})
    return done.drop(*operands, *[f"{n}_{k}" for n in operands for k in "cs"])


def _of(operands: list[tuple[Column, Column, Column]]) -> Column:
    (a, a_cents, a_small), (p, p_cents, p_small), (q, q_cents, q_small) = operands
    few = F.coalesce(a_small & p_small & q_small & (q_cents > 0), F.lit(False))
    place = F.lit(Decimal(1).scaleb(-SCALE))
    return F.when(few, (_of_cents(a_cents, p_cents, q_cents).cast("decimal(20,0)") * place).cast(SHARE)).otherwise(
        _any(_units(a), _units(p), _units(q), place))


def _any(a: Column, p: Column, q: Column, place: Column) -> Column:
    size_a, size_p, size_q = F.abs(a), F.abs(p), F.abs(q)
    fits = (size_a < 9 * 10 ** 18) & (size_p <= size_q) & (size_q < 10 ** 18)
    size = F.when(q == 0, None).when(fits, _short(size_a, size_p, size_q)).otherwise(_long(size_a, size_p, size_q))
    sign = (F.signum(a) * F.signum(p) * F.signum(q)).cast("decimal(1,0)")
    return (size * sign * place).cast(SHARE)
