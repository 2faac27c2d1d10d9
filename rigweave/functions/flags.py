"""Reason codes as bits of one number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_bits(reasons: Column, vocabulary: list[str]) -> Column:
    """One bit for each code of the vocabulary that occurs; codes outside it set none, null gives null."""
    bits = [F.when(F.array_contains(reasons, code), F.lit(1 << i)).otherwise(0) for i, code in enumerate(vocabulary)]
    return F.when(reasons.isNotNull(), sum(bits[1:], bits[0]).cast("long"))


def from_bits(bits: Column, vocabulary: list[str]) -> Column:
    """The codes whose bits are set, in the vocabulary's order."""
    return F.array_compact(F.array(*[F.when(bits.bitwiseAND(F.lit(1 << i)) != 0, F.lit(code)) for i, code in enumerate(vocabulary)]))
