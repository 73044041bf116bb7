"""Vector and bit-string functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FLOOR = 1e-12


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def normalized(v: Column, added: bool = False) -> Column:
    """v / max(|v|, floor), or with ``added`` v / (|v| + floor)."""
    length = norm(v) + FLOOR if added else F.greatest(norm(v), F.lit(FLOOR))
    return F.transform(v, lambda x: x / length)


def hamming_hex(a: Column, b: Column, digits: int = 64) -> Column:
    """Differing bits of two hex strings, by words of 16 digits."""

    def word(h: Column, at: int) -> Column:
        return F.conv(F.substring(h, at, 16), 16, -10).cast("long")

    out = F.lit(0)
    for at in range(1, digits + 1, 16):
        out = out + F.bit_count(word(a, at).bitwiseXOR(word(b, at)))
    return out


def open_set_label(probabilities: Column, classes: Column, threshold: float, other: str = "other") -> Column:
    """The class of the largest probability (the first on ties), ``other`` below a threshold."""
    top = F.array_max(probabilities)
    return F.when(top < threshold, F.lit(other)).otherwise(F.get(classes, F.array_position(probabilities, top).cast("int") - 1))
