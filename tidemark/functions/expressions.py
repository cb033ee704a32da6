"""Column expressions shared by the staging queries.

All of them are built-in Spark SQL functions, so they stay inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: staging and target money columns are DECIMAL(15,2).
MONEY = "decimal(15,2)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bit64_text(c: Column | str) -> Column:
    """64-character two's-complement binary text of an integer key.

    Equals ``key::bit(64)::text`` in PostgreSQL, negatives included.
    """
    return F.lpad(F.bin(_col(c).cast("bigint")), 64, "0")


def aggregate_identifier(c: Column | str) -> Column:
    """16-byte MD5 digest of the 64-bit binary text of a key; NULL stays NULL."""
    return F.unhex(F.md5(bit64_text(c)))


def identifier_hex(c: Column | str) -> Column:
    """Lower-case hex text of a binary identifier (for reports and checks)."""
    return F.lower(F.hex(_col(c)))


def money(c: Column | str) -> Column:
    """Exact decimal money value; never sum doubles."""
    return _col(c).cast(MONEY)


def money_cents(c: Column | str) -> Column:
    """Exact ``CAST(c AS DECIMAL(15,2))`` as a bigint count of cents.

    Sums of cents run on fixed-width longs inside codegen, while DECIMAL(15,2)
    sums widen to DECIMAL(25,2) buffers that Spark handles as BigDecimal
    objects. Conversion: a value within 1e-3 of whole cents (and below 1e9)
    is rounded with ``rint``, which equals the HALF_UP decimal cast there;
    every other value takes the exact decimal cast. Decimal inputs pass the
    same test: below 1e9 their double carries cents to far better than 1e-3.
    Overflow raises under ANSI mode instead of wrapping.
    """
    x = _col(c)
    exact = (x.cast(MONEY) * F.lit(100)).cast("bigint")
    scaled = x.cast("double") * F.lit(100.0)
    nearest = F.rint(scaled)
    fast = (F.abs(x.cast("double")) < F.lit(1e9)) & (F.abs(scaled - nearest) < F.lit(1e-3))
    return F.when(fast, nearest.cast("bigint")).otherwise(exact)


def cents_to_money(c: Column | str) -> Column:
    """Bigint cents back to an exact DECIMAL(15,2)."""
    return (_col(c).cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")).cast(MONEY)


def day(c: Column | str) -> Column:
    """Calendar date of a date or timestamp column."""
    return _col(c).cast("date")
