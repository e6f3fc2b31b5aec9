"""DQ-1: data-quality rules, in one aggregation or in the pass that writes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from metroframe.sinks.observed import metrics_of


@dataclass(frozen=True)
class Rule:
    """One check: ``kind`` in {column_count, row_count, completeness,
    uniqueness}; the measured value is compared with ``op`` to ``threshold``."""

    kind: str
    op: str
    threshold: float
    column: str | None = None

    @property
    def name(self) -> str:
        target = f"({self.column})" if self.column else ""
        return f"{self.kind}{target} {self.op} {self.threshold:g}"


_OPS = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b,
        "<=": lambda a, b: a <= b, "=": lambda a, b: a == b}


SCHEMA_RULES = {"column_count"}
COUNTED = {"row_count", "completeness"}
RESULT = "rule_id int, rule string, value double, passed boolean"


def _checked(rules: Sequence[Rule]) -> None:
    for r in rules:
        if r.kind not in SCHEMA_RULES | COUNTED | {"uniqueness"}:
            raise ValueError(f"unknown rule kind {r.kind}")
        if r.op not in _OPS:
            raise ValueError(f"unknown operator {r.op}")


def _counts(rules: Sequence[Rule]) -> list[Column]:
    """What one pass must count for the rules that rows can be counted for."""
    if not any(r.kind in COUNTED | {"uniqueness"} for r in rules):
        return []
    columns = dict.fromkeys(r.column for r in rules if r.kind == "completeness")
    return [F.count(F.lit(1)).alias("rows"), *[F.count(F.col(c)).alias(f"filled:{c}") for c in columns]]


def _results(spark: SparkSession, rules: Sequence[Rule], columns: int, measured: dict[str, int]) -> DataFrame:
    rows = []
    total = measured.get("rows", 0)
    for i, r in enumerate(rules):
        share = {"completeness": f"filled:{r.column}", "uniqueness": f"distinct:{r.column}"}.get(r.kind)
        value = float(columns) if r.kind == "column_count" else float(total) if r.kind == "row_count" \
            else measured.get(share, 0) / total if total else 1.0
        rows.append((i, r.name, value, _OPS[r.op](value, float(r.threshold))))
    return spark.createDataFrame(rows, RESULT)


def check_quality(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: (rule, measured value, passed).

    All row-level measures are computed in a single aggregation over ``df``
    (distinct counts of several columns share one pass); the data are not
    blocked or changed by the outcome. Rules about the schema alone read no data.
    """
    _checked(rules)
    distinct = [F.count_distinct(F.col(c)).alias(f"distinct:{c}") for c in dict.fromkeys(r.column for r in rules if r.kind == "uniqueness")]
    aggs = [*_counts(rules), *distinct]
    return _results(df.sparkSession, rules, len(df.columns), df.agg(*aggs).first().asDict() if aggs else {})


class ObservedQuality:
    """DQ-1 in the pass that writes: write ``data``, then ask for ``results``.

    Rows and filled values are counted by an observation of the write itself. Rules about the schema need no
    rows. Only uniqueness needs a second look, since an observation cannot count distinct values: at its columns of what was
    written, not at the source.
    """

    def __init__(self, df: DataFrame, rules: Sequence[Rule]):
        _checked(rules)
        self.rules, self._columns, self._spark = list(rules), len(df.columns), df.sparkSession
        counts = _counts(rules)
        self._seen = Observation() if counts else None
        self.data = df.observe(self._seen, *counts) if counts else df

    def results(self, written: DataFrame | None = None) -> DataFrame:
        """One row per rule. ``written`` is the table as it can be read back, for uniqueness rules."""
        measured = metrics_of(self._seen) if self._seen else {}
        unique = dict.fromkeys(r.column for r in self.rules if r.kind == "uniqueness")
        if unique:
            if written is None:
                raise ValueError("uniqueness is counted over what was written")
            measured |= written.agg(*[F.count_distinct(F.col(c)).alias(f"distinct:{c}") for c in unique]).first().asDict()
        return _results(self._spark, self.rules, self._columns, measured)


def store_results(results: DataFrame, path: str, dataset: str, run: str) -> None:
    """Append the results of a run: dataset, run, checked_at and the columns of ``results``; a file per run."""
    (results.select(F.lit(dataset).alias("dataset"), F.lit(run).alias("run"), F.current_timestamp().alias("checked_at"), "*")
     .coalesce(1).write.mode("append").parquet(path))
