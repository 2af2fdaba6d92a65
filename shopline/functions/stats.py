"""Aggregate expressions that are exact, deterministic and ANSI-safe.

* Money is summed as DECIMAL, so a total does not depend on the order in which
  a thousand executors happen to add their partial sums (double addition is
  not associative).  The decimal total is turned into a double at the end.
* ``exact_mean`` is the mean of doubles with any number of binary places (an
  interpolated price): whole parts and fractions are summed apart as integers,
  so it is the same on any partitioning, too.
* ``Partial`` is a measure that another aggregate has summed in part: the sums
  and means above take it like a column, so a mart rolls up from a pre-aggregate
  to the same last digit as from the rows.
* ``safe_corr`` is Pearson's r that yields null instead of raising under ANSI
  mode when a variable is constant, has one row or no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal places kept of each summed value, and the magnitude up to which
# values are summed as decimals; DECIMAL(38, 10) has room for 1e28.
MONEY_SCALE = 10
MONEY_LIMIT = 1e24


# Units of a fraction in exact_mean, and the magnitude up to which it is exact.
FRACTION = 1 << 52
MEAN_LIMIT = float(1 << 62)


@dataclass(frozen=True)
class Partial:
    """A column that :func:`partial_sum` or :func:`partial_mean` made."""

    column: Column

    @classmethod
    def of(cls, name: str) -> Partial:
        return cls(F.col(name))


Measure = str | Column | Partial


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def given(condition: Column, c: Measure) -> Column | Partial:
    """The measure of the rows that meet a condition."""
    return Partial(F.when(condition, c.column)) if isinstance(c, Partial) else F.when(condition, _col(c))


def _sums(c: str | Column, scale: int) -> dict[str, Column]:
    x = _col(c).cast("double")
    plain = F.isnan(x) | (F.abs(x) > MONEY_LIMIT)
    return {"exact": F.sum(F.when(~plain, x).cast(f"decimal(38,{scale})")), "plain": F.sum(x), "odd": F.bool_or(plain), "n": F.count(x)}


def _mean_sums(c: str | Column) -> dict[str, Column]:
    x = _col(c).cast("double")
    odd = F.isnan(x) | (F.abs(x) > MEAN_LIMIT)
    part = lambda v: F.sum(F.when(~odd, v).cast("bigint").cast("decimal(20,0)"))
    return {"whole": part(F.floor(x)), "part": part(F.floor((x - F.floor(x)) * float(FRACTION))), "plain": F.sum(x), "odd": F.bool_or(odd), "n": F.count(x)}


def _merged(c: Column, names: dict[str, Column]) -> dict[str, Column]:
    return {k: F.bool_or(c[k]) if k == "odd" else F.sum(c[k]) for k in names}


def _struct(sums: dict[str, Column]) -> Column:
    return F.struct(*[v.alias(k) for k, v in sums.items()])


def partial_sum(c: str | Column, scale: int = MONEY_SCALE) -> Column:
    """What :func:`exact_sum` and :func:`exact_avg` need to know of a group's rows."""
    return _struct(_sums(c, scale))


def partial_mean(c: str | Column) -> Column:
    """What :func:`exact_mean` needs to know of a group's rows."""
    return _struct(_mean_sums(c))


def exact_sum(c: Measure, scale: int = MONEY_SCALE) -> Column:
    """``sum`` over DECIMAL(38, scale), returned as double.

    If any value is NaN, infinite or beyond ``MONEY_LIMIT``, the sum is the
    plain double sum.
    """
    s = _merged(c.column, _sums("x", scale)) if isinstance(c, Partial) else _sums(c, scale)
    return F.when(F.coalesce(s["odd"], F.lit(False)), s["plain"]).otherwise(s["exact"].cast("double"))


def exact_avg(c: Measure, scale: int = MONEY_SCALE) -> Column:
    """Mean = exact sum / count of non-null values (null if none)."""
    n = F.sum(c.column["n"]) if isinstance(c, Partial) else F.count(_col(c))
    return F.try_divide(exact_sum(c, scale), n.cast("double"))


def exact_mean(c: Measure) -> Column:
    """Mean of doubles, the same in any order of the rows (null if none).

    The sum of the whole parts and that of the fractions, in units of 2**-52, are
    exact integers; values from 1 up lose nothing, smaller ones what is below
    that unit.  If any value is NaN or beyond ``MEAN_LIMIT``, it is the plain mean.
    """
    s = _merged(c.column, _mean_sums("x")) if isinstance(c, Partial) else _mean_sums(c)
    unit = F.lit(FRACTION).cast("decimal(20,0)")
    rest = s["part"] % unit
    carry = ((s["part"] - rest) / unit).cast("decimal(20,0)")
    whole = (s["whole"] + carry).cast("double") + rest.cast("double") / F.lit(float(FRACTION))
    total = F.when(F.coalesce(s["odd"], F.lit(False)), s["plain"]).otherwise(whole)
    return F.try_divide(total, s["n"].cast("double"))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den``; null when the denominator is 0 or null."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def safe_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation over pairs where both values are present.

    ``covar_pop / (stddev_pop * stddev_pop)`` with ``try_divide``: null for a
    constant variable, for one pair and for no pairs, never an ANSI error.
    """
    xc, yc = _col(x).cast("double"), _col(y).cast("double")
    both = xc.isNotNull() & yc.isNotNull()
    xp, yp = F.when(both, xc), F.when(both, yc)
    return F.try_divide(F.covar_pop(xp, yp), F.stddev_pop(xp) * F.stddev_pop(yp))
