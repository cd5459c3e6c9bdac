"""Column-expression helpers.

Null handling follows the rule engine: a comparison against NULL is "not
true" unless a default says otherwise; a rate with a missing or zero
denominator is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.timeutil import col_


def flag(cond: Column) -> Column:
    """1 when the condition holds, else 0 (NULL counts as false)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def truthy(c) -> Column:
    """NULL-safe boolean; ints 0/1 and booleans both accepted."""
    c = col_(c)
    return F.coalesce(c.cast("boolean"), F.lit(False))


# Null-safe comparison family; ``default`` is returned when an input is NULL.
def safe_gte(a, b, default: bool = False) -> Column:
    return F.coalesce(col_(a) >= b, F.lit(default))


def safe_gt(a, b, default: bool = False) -> Column:
    return F.coalesce(col_(a) > b, F.lit(default))


def safe_lte(a, b, default: bool = False) -> Column:
    return F.coalesce(col_(a) <= b, F.lit(default))


def safe_lt(a, b, default: bool = False) -> Column:
    return F.coalesce(col_(a) < b, F.lit(default))


def safe_eq(a, b, default: bool = False) -> Column:
    return F.coalesce(col_(a) == b, F.lit(default))


def safe_range(a, lo, hi, default: bool = False) -> Column:
    return F.coalesce(col_(a).between(lo, hi), F.lit(default))


def safe_abs_lte(a, bound, default: bool = False) -> Column:
    return F.coalesce(F.abs(col_(a)) <= bound, F.lit(default))


def safe_pct(num, den) -> Column:
    """100 * num / den, NULL when the denominator is NULL or <= 0."""
    den = col_(den)
    return F.when(den > 0, col_(num) / den * F.lit(100.0))


def band(value, lo, hi) -> Column:
    """Inclusive band membership as 0/1."""
    return flag(col_(value).between(lo, hi))


def any_of(*flags) -> Column:
    """1 when any flag is 1."""
    return F.greatest(*[F.coalesce(col_(f), F.lit(0)) for f in flags])


def map_label(c, mapping: dict) -> Column:
    """Enum -> label by a map literal; unknown keys give NULL."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), col_(c))


def case_label(c, mapping: dict) -> Column:
    """Enum -> label by a CASE chain."""
    out = None
    for k, v in mapping.items():
        out = F.when(col_(c) == k, F.lit(v)) if out is None else out.when(col_(c) == k, F.lit(v))
    return out


def lenient_int(c, default: int = 1) -> Column:
    """coalesce(try_cast(x as int), default)."""
    return F.coalesce(col_(c).try_cast("int"), F.lit(default))


def ladder(value, steps: list[tuple], default=0, inclusive: str = "gte") -> Column:
    """Ordered threshold ladder: first (bound, points) whose test holds."""
    out = None
    for bound, pts in steps:
        cond = safe_gte(value, bound) if inclusive == "gte" else safe_lte(value, bound)
        out = F.when(cond, F.lit(pts)) if out is None else out.when(cond, F.lit(pts))
    return out.otherwise(F.lit(default))


def rnd(c, n: int = 4) -> Column:
    return F.round(col_(c).cast("double"), n)
