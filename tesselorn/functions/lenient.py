"""Number parsing that never fails, and comparisons that NaN never wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = r"\d+(_\d+)*"
_FLOAT = rf"(?i)^[+-]?(({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})(e[+-]?{_DIGITS})?|inf(inity)?|nan)$"
_INT = rf"^[+-]?{_DIGITS}$"
NAN_TOKEN = r"(?i)(?<![a-z0-9])nan(?![a-z0-9])"


def number(text: Column) -> Column:
    """Double of a text, null where it is none. 1_0 is 10; 1.5f is none."""
    t = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.when(t.rlike(_FLOAT), F.regexp_replace(t, "_", "").try_cast("double"))


def to_float(text: Column, default: str | None = None) -> Column:
    """0.0 where a text is no number; a missing one counts as the default."""
    return F.coalesce(number(text if default is None else F.coalesce(text, F.lit(default))), F.lit(0.0))


def to_int(text: Column, default: str | None = None) -> Column:
    """0 where a text is no whole number or beyond 32 bits."""
    t = F.regexp_replace(text if default is None else F.coalesce(text, F.lit(default)), r"^\s+|\s+$", "")
    return F.coalesce(F.when(t.rlike(_INT), F.regexp_replace(t, "_", "").try_cast("int")), F.lit(0))


def above(x: Column, y) -> Column:
    return ~F.isnan(x) & (x > y)


def below(x: Column, y) -> Column:
    return ~F.isnan(x) & (x < y)


def has_nan(attrs: Column) -> Column:
    """Whether any attribute value has a NaN token."""
    return F.exists(F.map_values(attrs), lambda v: v.rlike(NAN_TOKEN))


def greatest_abs(text: Column) -> Column:
    """Greatest absolute value of a text's numbers; others and NaN are passed over."""
    tokens = F.split(F.regexp_replace(text, r"^\s+|\s+$", ""), r"\s+")
    sizes = F.transform(tokens, lambda t: F.abs(number(t)))
    return F.aggregate(sizes, F.lit(0.0), lambda a, x: F.when(x.isNotNull() & above(x, a), x).otherwise(a))
