"""Removal of boilerplate lines by their spread over distinct sites.

A HyperLogLog sketch of sites per line hash merges by aggregation. Lines whose
estimate is clear of the threshold are decided by it; those near it get an exact
distinct count. A line found on enough sites goes everywhere but in its first place
(by id, then position), so no text is lost from the corpus altogether.

Only DataFrame and SQL functions: hot lines combine map-side into sketches, and the
positions to remove meet per document.

Defined cases: a null text stays null and has no lines; a line counts without the
spaces around it, if it then has ``min_chars`` characters or more; a null site
counts as one site of its own; equal rows are separate places; a document that loses
all lines keeps its row, with an empty text; other columns pass through, but for those
named n_lines or n_removed when these are added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metroframe.llm.common import written

MIN_SITES = 5
MIN_CHARS = 20
LG_K = 12  # a relative error of 1.6 percent
BAND = 0.1  # an estimate within so much of the threshold is checked exactly: six standard errors


def spread_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """(line_key) of the lines of ``lines`` (line_key, site) on ``min_sites`` sites or more."""
    sketch = F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K))
    found = written(lines.groupBy("line_key").agg(sketch.alias("sites"))
                    .filter(F.col("sites") >= min_sites * (1 - BAND)), "line_sites")
    clear = F.col("sites") > min_sites * (1 + BAND)
    near = lines.join(found.filter(~clear).select("line_key"), "line_key", "left_semi")
    exact = near.groupBy("line_key", "site").agg(F.lit(1).alias("one")).groupBy("line_key") \
        .agg(F.count("*").alias("n")).filter(F.col("n") >= min_sites)
    return found.filter(clear).select("line_key").union(exact.select("line_key"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS, counts: bool = True) -> DataFrame:
    """``docs`` with the text without boilerplate lines, and n_lines and n_removed (long) if ``counts``."""
    # the input's columns travel in a struct, so none can clash with the operator's own
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    text, site = F.col(f"doc.`{text_col}`"), F.col(f"doc.`{site_col}`")
    rows = rows.withColumn("row_key", F.xxhash64(F.col(f"doc.`{id_col}`"), text, site))
    lines = rows.filter(text.isNotNull()).select(
        F.col(f"doc.`{id_col}`").alias("id"), "row_key",
        F.coalesce(F.xxhash64(site), F.lit(0)).alias("site"),
        F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    line = F.trim("line")
    # 128 bits name a line
    lines = lines.filter(F.length(line) >= min_chars).select(
        "id", "row_key", "site", "pos", F.substring(F.md5(line.cast("binary")), 1, 32).alias("line_key"))
    wide = written(spread_lines(lines.select("line_key", "site"), min_sites), "line_wide")
    places = written(lines.join(wide, "line_key", "left_semi").select("line_key", "id", "row_key", "pos"), "line_places")
    first = places.groupBy("line_key").agg(F.min(F.struct("id", "row_key", "pos")).alias("first"))
    gone = (places.join(first, "line_key")
            .filter(~F.struct("id", "row_key", "pos").eqNullSafe(F.col("first")))
            .groupBy("row_key").agg(F.collect_set("pos").alias("gone")))
    # of equal rows the first keeps the line only once: they share their key and so their places
    found = rows.join(gone, "row_key", "left")
    all_lines = F.split(text, "\n", -1)
    left = F.filter(F.transform(all_lines, lambda x, i: F.when(
        ~F.array_contains("gone", i), F.struct(x.alias("x")))), lambda s: s.isNotNull())
    kept = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(F.transform(left, lambda s: s["x"]), "\n"))
    own = [c for c in docs.columns if not (counts and c in ("n_lines", "n_removed"))]
    added = [F.coalesce(F.size(all_lines), F.lit(0)).cast("bigint").alias("n_lines"),
             F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed")]
    return found.select(*[kept.alias(c) if c == text_col else F.col(f"doc.`{c}`").alias(c) for c in own],
                        *added[:2 * counts])


def line_dedup_sql(min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> str:
    """The same in DuckDB SQL over documents: doc_id, n_lines, n_removed, text_md5."""
    return f"""
    WITH l AS (
      SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
             unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
    k AS (SELECT doc_id, source, line, pos, CASE WHEN length(trim(line)) >= {min_chars} THEN trim(line) END AS key FROM l),
    w AS (SELECT key, min((doc_id, pos)) AS first FROM k WHERE key IS NOT NULL
          GROUP BY key HAVING count(DISTINCT source) >= {min_sites}),
    m AS (SELECT k.doc_id, k.pos, k.line, w.key IS NOT NULL AND (k.doc_id, k.pos) <> w.first AS gone
          FROM k LEFT JOIN w ON k.key = w.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
           md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS text_md5
    FROM m GROUP BY doc_id"""
