"""Message age rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def age_ms_seconds(later: Column, earlier: Column) -> Column:
    """Reference rule: whole seconds of each side times 1000, subtracted
    (1.9 s -> 3.1 s gives 2000)."""
    return F.unix_timestamp(later) * 1000 - F.unix_timestamp(earlier) * 1000


def age_ms_exact(later: Column, earlier: Column) -> Column:
    """Millisecond difference of the two instants (1.9 s -> 3.1 s gives 1200)."""
    return F.unix_millis(later) - F.unix_millis(earlier)
