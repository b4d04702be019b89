"""Identity keys, placeholder clean-up and order-preserving encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that stand for a missing identity (fixed values).
PLACEHOLDERS = ("", "unknown", "none", "nan", "null")


def strip_blanks(c: Column) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def identity_key(c: Column, placeholders: tuple[str, ...] = PLACEHOLDERS) -> Column:
    """Case-free key without outer blanks; null where the value is missing.

    Missing: null, blank, or a placeholder word, also behind ``namespace:``.
    """
    key = F.lower(strip_blanks(c))
    bare = strip_blanks(F.regexp_replace(key, r"^[^:]*:", ""))
    return F.when(~key.isin(*placeholders) & ~bare.isin(*placeholders), key)


def double_order_key(c: Column, descending: bool = False) -> Column:
    """A BIGINT whose order is that of the double, nulls and NaN last.

    IEEE bits of positive numbers already sort as integers; those of negative
    ones are flipped. ``-0.0`` equals ``0.0``.
    """
    safe = F.when(c.isNull() | F.isnan(c), F.lit(0.0)).otherwise(c + F.lit(0.0))
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), safe).cast("bigint")
    ordered = F.when(bits < 0, bits.bitwiseXOR(F.lit(0x7FFFFFFFFFFFFFFF))).otherwise(bits)
    if descending:
        ordered = F.bitwise_not(ordered)
    return F.when(c.isNull() | F.isnan(c), F.lit(0x7FFFFFFFFFFFFFFF)).otherwise(ordered)
