"""PRJ-1/PRJ-3 lenient casts: bad text becomes null under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGRAL = {"int", "integer", "bigint", "long", "smallint", "short", "tinyint", "byte"}

# digits with a decimal part: the legacy cast keeps the integer part
_DECIMAL_TEXT = r"^\s*([+-]?[0-9]+)\.[0-9]*\s*$"


def lenient_cast(c, type_name: str, *, truncate_decimals: bool = True) -> Column:
    """Cast like the non-ANSI cast of the Spark 3.5 jobs: invalid text -> null.

    Integral targets read decimal text by its integer part ('7.5' -> 7,
    '-7.5' -> -7, '9788936434120.0' -> 9788936434120, exactly, with no
    detour through a double); exponent forms and out-of-range values are
    null, as before. ``truncate_decimals=False`` makes decimal text null.
    """
    col = F.col(c) if isinstance(c, str) else c
    t = type_name.lower()
    if t in _INTEGRAL and truncate_decimals:
        integer_part = F.nullif(F.regexp_extract(col.cast("string"), _DECIMAL_TEXT, 1), F.lit(""))
        return F.coalesce(col.try_cast(t), integer_part.try_cast(t))
    return col.try_cast(t)
