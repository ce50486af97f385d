"""Rolling string hash of a user id's decimal text (bitmap UV, U2)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values that must equal the reference for identical bit offsets:
# multiplier 73, bitmap of 2^29 bits (offset = hash masked to 29 bits).
HASH_MULTIPLIER = 73
BITMAP_BITS = 29


def rolling_hash(col: Column | str, multiplier: int = HASH_MULTIPLIER,
                 bits: int = BITMAP_BITS) -> Column:
    """h = h * multiplier + code(char) over the text, masked to ``bits``.

    Reducing modulo 2^bits at every step gives the same value as a 64-bit
    wrapping fold followed by the mask (2^bits divides 2^64) and never
    overflows under ANSI mode."""
    mod = 1 << bits
    text = F.col(col).cast("string") if isinstance(col, str) else col.cast("string")
    return F.aggregate(
        F.split(text, ""), F.lit(0).cast("long"),
        lambda acc, ch: (acc * F.lit(multiplier) + F.ascii(ch).cast("long")) % F.lit(mod))
