"""Column expressions.

Every function here returns a ``Column`` built from ``pyspark.sql.functions``
so it stays inside whole-stage codegen; none of them is a Python UDF.  All are
safe under ANSI mode: text becomes a number through ``try_cast`` and
divisions go through ``try_divide``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Arrival-delay bucket labels and bounds (minutes).
BUCKET_EARLY = "<= -15"
BUCKET_ON_TIME = "(-15,0]"
BUCKET_SLIGHT = "(0,15)"
BUCKET_DELAYED = ">= 15"
BUCKET_UNKNOWN = "unknown"
DELAY_THRESHOLD = 15
# Stands for a null key part in key hashes.
NULL_KEY = "~null~"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: str | Column) -> Column:
    """Text or number to double; text that is not a number becomes null."""
    return col_(c).try_cast(T.DoubleType())


def is_valid_number(c: str | Column) -> Column:
    """Not null and not NaN."""
    c = col_(c)
    return c.isNotNull() & ~F.isnan(c)


def is_missing(c: str, dtype: T.DataType, na_tokens: tuple[str, ...] = ()) -> Column:
    """Missing test dispatched on the column type.

    integral and others: null; float/double: null or NaN;
    string: null, empty, or one of ``na_tokens``.
    """
    x = F.col(c)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return x.isNull() | F.isnan(x)
    if isinstance(dtype, T.StringType):
        cond = x.isNull() | (x == F.lit(""))
        if na_tokens:
            cond = cond | x.isin(*na_tokens)
        return cond
    return x.isNull()


def pct(part: Column, total: Column, scale: int = 3) -> Column:
    """``round(part / total * 100, scale)``, null on an empty total.

    The division is done first and the 100 is a double, so the same order of
    operations gives the same rounding on other engines.
    """
    return F.round(F.try_divide(part.cast("double"), total.cast("double")) * F.lit(100.0), scale)


def delay_bucket(c: str | Column, unknown_bucket: bool = True) -> Column:
    """Arrival-delay range bucket.

    With ``unknown_bucket`` null and NaN go to ``unknown`` instead of falling
    through to ``>= 15`` (D4); on cleaned input both forms are identical.
    """
    x = col_(c)
    chain = F.when(x <= -DELAY_THRESHOLD, BUCKET_EARLY)
    if unknown_bucket:
        chain = F.when(x.isNull() | F.isnan(x), BUCKET_UNKNOWN).when(x <= -DELAY_THRESHOLD, BUCKET_EARLY)
    return (chain
            .when((x > -DELAY_THRESHOLD) & (x <= 0), BUCKET_ON_TIME)
            .when((x > 0) & (x < DELAY_THRESHOLD), BUCKET_SLIGHT)
            .otherwise(BUCKET_DELAYED))


def delayed_flag(c: str | Column, threshold: float = DELAY_THRESHOLD) -> Column:
    """1 when the delay is at least ``threshold`` minutes, else 0."""
    return (col_(c) >= threshold).cast("int")


def hhmm_hour(c: str | Column, wrap24: bool = False) -> Column:
    """Hour of an ``hhmm`` integer; 745 -> 7, 2400 -> 24 (0 with ``wrap24``)."""
    x = col_(c)
    hour = (x / F.lit(100)).cast("int")
    if wrap24:
        hour = F.pmod(hour, F.lit(24))
    return F.when(x.isNull(), F.lit(None).cast("int")).otherwise(hour)


def minutes_of_day(c: str | Column) -> Column:
    """``hhmm`` to minutes after midnight."""
    x = col_(c).cast("int")
    return (F.floor(x / F.lit(100)) * 60 + F.pmod(x, F.lit(100))).cast("int")


def cyclical(minutes: Column, period: float = 1440.0) -> tuple[Column, Column]:
    """Sine and cosine encoding of a periodic value."""
    angle = minutes.cast("double") * F.lit(2.0 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def hash_unit(*keys: str | Column) -> Column:
    """Deterministic 32-bit hash bucket in ``[0, 2^32)`` of the key columns.

    Built from ``md5`` so the same rows are chosen whatever the partitioning
    and on any engine with ``md5`` (the oracle reproduces it in DuckDB).  A
    null key part hashes as ``NULL_KEY``: every row has a hash.
    """
    parts: list[Column] = []
    for i, k in enumerate(keys):
        if i:
            parts.append(F.lit("-"))
        parts.append(F.coalesce(col_(k).cast("string"), F.lit(NULL_KEY)))
    digest = F.md5(F.concat(*parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_fraction_predicate(fraction: float, *keys: str | Column) -> Column:
    """True for about ``fraction`` of rows, chosen by key hash."""
    bound = int(fraction * (1 << 32))
    return hash_unit(*keys) < F.lit(bound)


def quick_round(column: str, digits: int = 6) -> Column:
    """``round(column, digits)`` of a double, without its decimal arithmetic where no tie is near.

    Below 1e9 units of the last digit the product is exact to 1e-6 of a unit,
    so a value further than 1e-4 from a tie rounds as its decimal does; the
    quotient of two whole numbers is the double nearest to that.  All other
    values (ties, large ones, NaN, infinities) go through ``round``.
    """
    x = F.col(column)
    units = F.abs(x) * 10.0 ** digits
    whole = F.floor(units + 0.5)
    clear = (units < 1e9) & (F.abs(units - F.floor(units) - 0.5) > 1e-4)
    return F.when(clear, F.when(x < 0, -whole).otherwise(whole) / F.lit(10.0 ** digits)).otherwise(F.round(x, digits))
