from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_col(c: Column | str) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def lit_or_col(v) -> Column:
    """Columns pass through; Python values become literals."""
    return v if isinstance(v, Column) else F.lit(v)
