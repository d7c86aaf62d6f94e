"""Value-level helpers: sentinels, safe casts and arithmetic, recodes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def present_id(col: Column | str, sentinel: str = "NA") -> Column:
    """True when an id is neither NULL nor the text sentinel ``"NA"``."""
    c = _c(col)
    return c.isNotNull() & (c.cast("string") != F.lit(sentinel))


def to_number(col: Column | str, dtype: str = "double") -> Column:
    """Cast text to a number; unparsable values become NULL (ANSI-safe)."""
    return _c(col).try_cast(dtype)


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` that yields NULL for a zero denominator instead of raising."""
    return F.try_divide(_c(num), _c(den))


def keep_or(col: Column | str, allowed: Iterable[str], other: str) -> Column:
    """Keep values in ``allowed``; anything else (NULL included) becomes ``other``."""
    c = _c(col)
    return F.when(c.isin(list(allowed)), c).otherwise(F.lit(other))


# Fixed values (must equal the reference's recode), in the reference's order:
# loyalty segment values -> class.  NULL also maps to Classic (first rule).
LOYALTY_RULES = [
    (["NA", "Prospect Emerald"], "Classic"),
    (["Platinum Plus", "Prospect Plat Plus"], "Platinum"),
    (["Prospect Platinum"], "Gold"),
    (["Prospect Gold"], "Emerald"),
    (["Standard"], "Classic"),
]


def loyalty_class(col: Column | str) -> Column:
    """Many-to-one recode of the loyalty segment; unlisted values pass through."""
    c = _c(col)
    (first_vals, first_cls), *rest = LOYALTY_RULES
    expr = F.when(c.isNull() | c.isin(first_vals), F.lit(first_cls))
    for vals, cls in rest:
        expr = expr.when(c.isin(vals), F.lit(cls))
    return expr.otherwise(c)
