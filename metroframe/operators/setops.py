"""SET-1..SET-3: UNION ALL by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """UNION ALL matched by column name; no shuffle, each branch keeps its
    own pruned scan."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out
