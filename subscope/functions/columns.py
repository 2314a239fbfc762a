"""Column builders shared by the operators. Everything here stays inside codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimals that sums keep exactly. Money and ratings here have two, rates and coordinates six.
DIGITS = 6
# Sums are taken on whole units of 10**-DIGITS, cut into three limbs of 20 bits and more. Each limb
# is a plain long sum (whole-stage codegen, map-side combine), so the result does not depend on the
# order or partitioning of rows; a limb stays below 2**63 for 10**12 rows of any size.
_LIMB = 20
_LARGE = 9.0e12


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total(c: str | Column, digits: int = DIGITS) -> Column:
    """Sum of a double column: exact and independent of order in its first ``digits`` decimals.

    What the units cannot hold is summed as doubles beside them: decimals beyond ``digits``, values
    of 9e12 and more, infinity and NaN (which makes the sum NaN, as in a plain sum).
    """
    value = col(c).cast("double")
    scale = 10.0**digits
    held = F.abs(value) < _LARGE * 10.0 ** (6 - max(digits, 6))
    units = F.when(held, F.rint(value * scale)).cast("long")
    # a value that is a decimal of so many digits but for the last bits of its double has no rest
    beyond = value - units / F.lit(scale)
    rest = F.when(held & (F.abs(beyond) <= F.abs(value) * 2.0**-49), F.lit(0.0)).when(held, beyond).otherwise(value)
    low = (1 << _LIMB) - 1
    limbs = (
        F.sum(F.shiftright(units, 2 * _LIMB)),
        F.sum(F.shiftright(units, _LIMB).bitwiseAND(F.lit(low))),
        F.sum(units.bitwiseAND(F.lit(low))),
    )
    wide = [F.coalesce(x, F.lit(0)).cast("decimal(20,0)") for x in limbs]
    step = F.lit(1 << _LIMB).cast("decimal(8,0)")
    whole = ((wide[0] * step).cast("decimal(26,0)") * step + wide[1] * step + wide[2]).cast("decimal(32,0)")
    unit = F.lit(Decimal(1).scaleb(-digits)).cast(f"decimal({digits + 1},{digits})")
    return (whole * unit).cast("double") + F.sum(rest)


def mean(c: str | Column) -> Column:
    """Average from the exact sum, NULL for no values."""
    return ratio(total(c), F.count(col(c)))


def ratio(a: Column | float, b: Column | float) -> Column:
    """Division that yields NULL for an empty or zero denominator."""
    a = a if isinstance(a, Column) else F.lit(float(a))
    b = b if isinstance(b, Column) else F.lit(float(b))
    return F.try_divide(a.cast("double"), b.cast("double"))


def rounded(c: Column, digits: int = 2) -> Column:
    return F.round(c, digits)


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def count_where(condition: Column) -> Column:
    """How many rows satisfy the condition; NULL counts as not satisfied."""
    return F.sum(flag(condition))


def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Value of the first rule that holds, in the given order."""
    out = None
    for condition, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    default = default if isinstance(default, Column) else F.lit(default)
    return default if out is None else out.otherwise(default)


def band_upto(c: str | Column, limits: Sequence[tuple[float, str]], above: str) -> Column:
    """Right-closed bins: the label of the first limit that is ``>=`` the value."""
    return first_match([(col(c) <= limit, label) for limit, label in limits], above)


def band_below(c: str | Column, limits: Sequence[tuple[float, str]], above: str) -> Column:
    """Right-open bins: the label of the first limit that is ``>`` the value."""
    return first_match([(col(c) < limit, label) for limit, label in limits], above)


def band_from(c: str | Column, limits: Sequence[tuple[float, str]], below: str) -> Column:
    """Descending thresholds: the label of the first limit that is ``<=`` the value."""
    return first_match([(col(c) >= limit, label) for limit, label in limits], below)


def remap(c: str | Column, mapping: Mapping[str, object], default: object | None = None) -> Column:
    """Value lookup; without a default unmatched values (and NULL) pass unchanged."""
    c = col(c)
    other = c if default is None else F.lit(default)
    return first_match([(c == key, value) for key, value in mapping.items()], other)


def clean(c: str | Column, how: str | None = "trim") -> Column:
    """Standardise one raw column: ``trim``, ``lower`` (trimmed), ``date``, ``ts`` or as it is."""
    c = col(c)
    if how is None:
        return c
    if how == "trim":
        return F.trim(c)
    if how == "lower":
        return F.lower(F.trim(c))
    if how == "date":
        return F.to_date(c)
    if how == "ts":
        return F.to_timestamp(c)
    raise ValueError(f"unknown standardisation {how!r}")


def date_key(c: str | Column) -> Column:
    """yyyymmdd as int; NULL stays NULL."""
    c = col(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def month_key(c: str | Column) -> Column:
    """yyyymm as int, the partition column of the fact tables."""
    c = col(c)
    return (F.year(c) * 100 + F.month(c)).cast("int")


def record_hash(columns: Sequence[str | Column]) -> Column:
    """SHA-256 over the columns in order; NULL and the empty string hash alike."""
    parts = [F.coalesce(col(c).cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws("||", *parts), 256)


def hash_bucket(columns: Sequence[str | Column], n: int, method: str = "xxhash64") -> Column:
    """Stable bucket 0..n-1 of the columns.

    ``sha2`` reads the first eight hex digits of a SHA-256 over the joined text, which other
    SQL engines can reproduce; ``xxhash64`` is the faster default.
    """
    if method == "xxhash64":
        return F.pmod(F.xxhash64(*[col(c) for c in columns]), F.lit(n).cast("long"))
    if method == "sha2":
        text = F.concat_ws("|", *[col(c).cast("string") for c in columns])
        return F.pmod(
            F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long"), F.lit(n).cast("long")
        )
    raise ValueError(f"unknown bucket method {method!r}")
