"""Column expressions.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` only,
so the work stays inside whole-stage codegen. Divisions go through
``try_divide`` so that a zero weight gives null instead of an ANSI error; null
is then skipped by ``avg``.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from censuskit.schema import SECTORS


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round6(col) -> Column:
    """Round a double to 6 places (averages differ in the last bits between
    engines because the summation order differs)."""
    return F.round(_c(col), 6)


# --- truncated percentage forms (each kept literally; they disagree near
# integers, e.g. 100*(1-(100-20)/100) truncates to 19 while 100*(20/100) is 20)


def _names(*cols) -> bool:
    return all(isinstance(c, str) for c in cols)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _dbl(w) -> str:
    return f"{float(w)!r}D"  # a DOUBLE literal (a bare 0.2 would be DECIMAL)


# Given column names, each expression is built as one SQL fragment (one call
# into the JVM); given Columns, with the Column API. Both are the same
# expression.


def pct_gap_of_sums(total, have) -> Column:
    """``int(100 * (1 - (total - have) / total))``."""
    if _names(total, have):
        t, h = _q(total), _q(have)
        return F.expr(f"CAST(100 * (1 - try_divide({t} - {h}, {t})) AS INT)")
    t, h = _c(total), _c(have)
    return (F.lit(100) * (F.lit(1) - F.try_divide(t - h, t))).cast("int")


def pct_lack(total, have) -> Column:
    """``int(100 * ((total - have) / total))``."""
    if _names(total, have):
        t, h = _q(total), _q(have)
        return F.expr(f"CAST(100 * try_divide({t} - {h}, {t}) AS INT)")
    t, h = _c(total), _c(have)
    return (F.lit(100) * F.try_divide(t - h, t)).cast("int")


def pct_have(total, have) -> Column:
    """``int(100 * (have / total))``."""
    if _names(total, have):
        t, h = _q(total), _q(have)
        return F.expr(f"CAST(100 * try_divide({h}, {t}) AS INT)")
    t, h = _c(total), _c(have)
    return (F.lit(100) * F.try_divide(h, t)).cast("int")


# --- weighted scores


def ratio_weighted_sum(weights, total) -> Column:
    """Sum of ``(measure / total) * w`` over ``weights`` (in list order)."""
    if _names(total, *[m for m, _ in weights]):
        t = _q(total)
        return F.expr(" + ".join(f"try_divide({_q(m)}, {t}) * {_dbl(w)}" for m, w in weights))
    t = _c(total)
    terms = [F.try_divide(_c(m), t) * F.lit(float(w)) for m, w in weights]
    return reduce(add, terms)


def scaled_weighted_sum(weights, total, scale=100) -> Column:
    """``(scale * sum(measure * w)) / total`` (sum first, divide once)."""
    if _names(total, *[m for m, _ in weights]):
        inner = " + ".join(f"{_q(m)} * {_dbl(w)}" for m, w in weights)
        return F.expr(f"try_divide({int(scale)} * ({inner}), {_q(total)})")
    terms = [_c(m) * F.lit(float(w)) for m, w in weights]
    return F.try_divide(F.lit(scale) * reduce(add, terms), _c(total))


# --- lookups as CASE expressions (no join needed for a fixed small mapping)


def value_map(col, mapping: dict, default=None) -> Column:
    """CASE expression mapping the values of ``col`` through ``mapping``."""
    c = _c(col)
    expr = None
    for k, v in mapping.items():
        expr = (F.when(c == F.lit(k), F.lit(v)) if expr is None
                else expr.when(c == F.lit(k), F.lit(v)))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def sector_of(mgmt_id, sectors: dict | None = None) -> Column:
    """Sector name of a school management id (null when unmapped)."""
    sectors = sectors or SECTORS
    c = _c(mgmt_id)
    expr = None
    for name, ids in sectors.items():
        cond = c.isin(*ids)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


# --- statistics


def pearson(x, y) -> Column:
    """Pearson correlation over pairs where both sides are non-null.

    ``covar_pop / (stddev_pop * stddev_pop)`` with ``try_divide``: a constant
    column gives null instead of the ANSI division error of ``corr``. Given
    column names, the expression is passed as one SQL fragment (one JVM call
    instead of a dozen when many features are correlated).
    """
    if isinstance(x, str) and isinstance(y, str):
        xs = f"CASE WHEN {_q(y)} IS NOT NULL THEN CAST({_q(x)} AS DOUBLE) END"
        ys = f"CASE WHEN {_q(x)} IS NOT NULL THEN CAST({_q(y)} AS DOUBLE) END"
        return F.expr(f"try_divide(covar_pop({xs}, {ys}), stddev_pop({xs}) * stddev_pop({ys}))")
    x, y = _c(x).cast("double"), _c(y).cast("double")
    xs = F.when(y.isNotNull(), x)
    ys = F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))
