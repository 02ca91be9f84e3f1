"""Exact money arithmetic.

Quantities and prices arrive as DOUBLE. Summing doubles gives results that
depend on the order of the rows, hence on partitioning, so two runs (or two
engines) can disagree in the last bit and, after ``ROUND(.., 2)``, in the
cent. Every sum here is taken over DECIMALs of 12 decimals and cast to DOUBLE at
the end: order-free, and the same on 8 or 8,000 cores.

Ratios (volume-weighted prices) are rounded half away from zero with integer
division, so no intermediate decimal rounding can move a value across a
half-cent boundary.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# The grid of every sum: 12 decimals, 26 digits before the point. A product is
# taken in DOUBLE, as a row's amount, and put on the grid once; the sums are
# exact from there. Values beyond 10^26 raise an overflow error, none is cut.
GRID = DecimalType(38, 12)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def on_grid(c: Column | str) -> Column:
    """The DOUBLE's shortest decimal form on the grid (12 decimals)."""
    return _col(c).cast(GRID.simpleString())


def qty(c: Column | str) -> Column:
    return on_grid(_col(c).cast("double"))


def money(q: Column | str, p: Column | str) -> Column:
    """One row's quantity times price."""
    return on_grid(_col(q).cast("double") * _col(p).cast("double"))


# Most quantities and amounts are whole ten-thousandths; those are summed as
# longs in two limbs (a limb's sum holds 8 * 10^12 rows), which costs a fraction
# of a decimal sum and gives the same total. All others go onto the grid.
_UNIT, _LIMB = 10**4, 20


def split_units(x: Column) -> Column:
    """The DOUBLE as a whole number of 1e-4, NULL if it is none (or 1e9 and more)."""
    units = F.when(F.abs(x) < 1e9, F.rint(x * float(_UNIT))).cast("long")
    return F.when(units.cast("double") / float(_UNIT) == x, units)


def limb_sums(name: str, x: Column | str, units: Column | str) -> list[Column]:
    """Three sums that ``limb_total`` joins; ``units`` is ``split_units`` of ``x``."""
    u = _col(units)
    return [F.sum(F.shiftright(u, _LIMB)).alias(f"_hi_{name}"), F.sum(u.bitwiseAND((1 << _LIMB) - 1)).alias(f"_lo_{name}"),
            F.sum(F.when(u.isNull(), on_grid(x))).alias(f"_rest_{name}")]


def limb_total(name: str) -> Column:
    """The sum on the grid, NULL if there was no value."""
    hi, lo, rest = (F.col(f"_{part}_{name}") for part in ("hi", "lo", "rest"))
    units = hi.cast("decimal(19,0)") * F.lit(1 << _LIMB).cast("decimal(7,0)") + lo.cast("decimal(19,0)")
    whole = on_grid(units * F.lit(Decimal(1) / _UNIT).cast("decimal(4,4)"))
    return on_grid(F.coalesce(whole + rest, whole, rest))


def qty_total(c: Column | str) -> Column:
    """SUM(q) on the grid, in any order the same."""
    return F.sum(qty(c))


def money_total(q: Column | str, p: Column | str) -> Column:
    """SUM(q * p) on the grid, in any order the same."""
    return F.sum(money(q, p))


def as_double(c: Column | str) -> Column:
    return _col(c).cast("double")


def round_money(c: Column | str, digits: int = 2) -> Column:
    """ROUND(x, digits) on a decimal (half away from zero), as DOUBLE."""
    return F.round(_col(c), digits).cast("double")


def rounded_ratio(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """ROUND(num / NULLIF(den, 0), digits) computed exactly, as DOUBLE.

    Both are sums on the grid. With a = |num| and q = |den|,
    ``round(a / q, d) * 10^d = floor((2 * 10^d * a + q) / (2 * q))``; ``div`` on
    decimals truncates exactly, and both operands stay within 38 digits for
    sums under 10^21 (larger ones raise an error). The sign is restored
    afterwards, which gives half away from zero.
    """
    n, d = _col(num), _col(den)
    a = F.abs(n).cast("decimal(33,12)")
    q = F.abs(d).cast("decimal(33,12)")
    scale = F.lit(2 * 10 ** digits).cast(f"decimal({digits + 1},0)")
    two = F.lit(2).cast("decimal(1,0)")
    units = _integral_divide(a * scale + q, q * two)
    signed = (F.signum(n) * F.signum(d) * units.cast("double")) / F.lit(float(10 ** digits))
    # "+ 0.0" folds a negative zero into zero.
    return F.when(d != 0, signed + F.lit(0.0))


def _integral_divide(a: Column, b: Column) -> Column:
    """``a div b`` (exact truncating division, LONG result)."""
    # Column has no operator for DIV; build it through the SQL function form.
    return F.call_function("div", a, b)


def weighted_price(amount: Column | str, quantity: Column | str, digits: int = 2) -> Column:
    """Volume-weighted price: ROUND(SUM(q*p) / NULLIF(SUM(q), 0), digits).

    Takes the two exact sums (``money_total`` and ``qty_total``).
    """
    return rounded_ratio(amount, quantity, digits)
