"""P-5: top keywords of event home pages.

html -> visible text (STR-9) -> word runs of a script (STR-8, or a user
tokenizer for STR-10) -> stop words out (FLT-4) -> counts with first position
(AGG-2) -> top k per page, ties by first appearance (TOP-1) -> columns (TOP-2).
Every step is a built-in expression or a hash aggregate; the page text is
processed whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metroframe import constants as K
from metroframe.functions.text import html_to_text, words
from metroframe.operators.aggregates import value_counts
from metroframe.operators.filters import exclude_words
from metroframe.operators.ranking import ranks_to_columns, top_k_per_group
from metroframe.sources.headers import list_files


# file bytes of pages per task: their words and counts, all held by the task, are many times that
BYTES_PER_TASK = 1 << 18
ROWS_PER_TASK = 125  # for files that repeat themselves, hence say little of what they hold


def spread_pages(spark: SparkSession, pages: DataFrame, id_col: str, bytes_per_task: int = BYTES_PER_TASK,
                 rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``pages``, read from files, dealt by id over as many tasks as their files' bytes or their rows (counted from the footers
    of Parquet files) ask for, so that a task's words do not grow with the input (a number that is asked for stays as it is
    at run time)."""
    files = [f for path in pages.inputFiles() for f in list_files(spark, path)]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(sum(f.length for f in files) / bytes_per_task),
                math.ceil(pages.select().count() / rows_per_task))
    return pages.repartition(tasks, id_col)


def page_words(pages: DataFrame, id_col: str, html_col: str, *, pattern: str = K.HANGUL_WORD,
               tokenizer: Callable[[Column], Column] | None = None, tag_separator: str = " ") -> DataFrame:
    """(id, pos, word) for every word of every page, in text order.

    ``tokenizer`` may replace the regex: any function from a text column to
    an array<string> column (for instance a ``pandas_udf`` wrapping a
    morphological analyser that keeps nouns only).
    """
    text = html_to_text(F.col(html_col), tag_separator)
    tokens = tokenizer(text) if tokenizer is not None else words(text, pattern)
    src = pages.where(F.col(html_col).isNotNull()).select(id_col, html_col)
    return src.select(F.col(id_col), F.posexplode(tokens).alias("pos", "word"))


def top_keywords(pages: DataFrame, id_col: str, html_col: str, *, pattern: str = K.HANGUL_WORD,
                 stop_words: Sequence[str] = K.KEYWORD_STOP_WORDS, k: int = K.TOP_KEYWORDS,
                 tokenizer: Callable[[Column], Column] | None = None, tag_separator: str = " ") -> DataFrame:
    """(id, rank, word, n): the ``k`` most frequent words per page; ties go to
    the word that appears first. Pages with a null html give no rows."""
    w = page_words(pages, id_col, html_col, pattern=pattern, tokenizer=tokenizer, tag_separator=tag_separator)
    w = exclude_words(w, "word", stop_words)
    counts = value_counts(w, [id_col], "word", count_col="n", pos="pos", first_pos="first_pos")
    top = top_k_per_group(counts, [id_col], [F.col("n").desc(), F.col("first_pos").asc()], k)
    return top.select(id_col, "rank", "word", "n")


def keyword_columns(top: DataFrame, id_col: str, names: Sequence[str] = ("Keyword_1", "Keyword_2", "Keyword_3")) -> DataFrame:
    """TOP-2: one row per page, keyword i in column names[i-1], null when fewer."""
    return ranks_to_columns(top, [id_col], "rank", "word", names)
