"""Checks of stored image bytes that need no decoder."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def jpeg_complete(content: Column) -> Column:
    """Whether the bytes begin like a JPEG image and end with its end marker; null for null, false for empty ones."""
    begins = F.hex(F.substring(content, 1, 3)) == "FFD8FF"
    ends = F.hex(F.substring(content, -2, 2)) == "FFD9"
    return F.when(content.isNotNull(), begins & ends & (F.octet_length(content) > 4))
