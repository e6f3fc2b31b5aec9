"""Counts taken in the pass that writes."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

ROWS = "rows"


def observe_rows(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df``, and what will have counted its rows once it has been written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias(ROWS)), seen


def metrics_of(seen: Observation) -> dict[str, int]:
    """The counts of a write that has succeeded.

    Of a plan that the optimizer knows to be empty, the counting is left out with the rest: no counts.
    """
    try:
        return dict(seen.get)
    except Py4JJavaError as e:
        if "assertion failed" in str(e):
            return {}
        raise


def rows_of(seen: Observation) -> int:
    return metrics_of(seen).get(ROWS, 0)
