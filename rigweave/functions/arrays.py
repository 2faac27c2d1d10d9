"""Vector functions built from higher-order expressions, so that they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(INF))


def all_finite(vector: Column) -> Column:
    """Whether every element is a finite number; null for a null vector."""
    return F.forall(vector, is_finite)


def flip(vector: Column, positions: tuple[int, ...]) -> Column:
    """Negate the elements at the given 0-based positions."""
    return F.transform(vector, lambda x, i: F.when(i.isin(*positions), -x).otherwise(x))


def to_float32(vector: Column) -> Column:
    return F.transform(vector, lambda x: x.cast("float"))


def float32_error(vector: Column) -> Column:
    """Largest absolute difference that storing as 32 bits makes; null where a stored element is not finite."""
    ok = F.forall(to_float32(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(INF)))
    return F.when(ok, F.array_max(F.transform(vector, lambda x: F.abs(x - x.cast("float").cast("double")))))


def difference(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))


def total(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda s, x: s + x)


def span(vector: Column, start: int, end: int) -> Column:
    """Elements [start, end), 0-based."""
    return F.slice(vector, start + 1, end - start)


def rot180(pixels: Column) -> Column:
    """A row-major image turned by half a turn."""
    return F.reverse(pixels)


def luminance(r: Column, g: Column, b: Column) -> Column:
    """Rec. 709 luminance."""
    return r * 0.2126 + g * 0.7152 + b * 0.0722


def neighbour_difference(pixels: Column, width: int, height: int) -> Column:
    """Mean of the mean absolute horizontal and vertical differences of a row-major image: higher is sharper."""
    across = [F.abs(pixels[y * width + x + 1] - pixels[y * width + x]) for y in range(height) for x in range(width - 1)]
    down = [F.abs(pixels[(y + 1) * width + x] - pixels[y * width + x]) for y in range(height - 1) for x in range(width)]
    parts = [total(F.array(*c)) / F.lit(float(len(c))) for c in (across, down) if c]
    return sum(parts[1:], parts[0]) / F.lit(float(len(parts))) if parts else F.lit(0.0)
