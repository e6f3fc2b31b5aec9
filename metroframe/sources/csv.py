"""SRC-1..SRC-3: CSV scans."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# timestamps are written and read with microseconds, so text round trips are exact
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, *,
             multiline: bool = True, encoding: str = "UTF-8", infer: bool = False,
             recursive: bool = False) -> DataFrame:
    """SRC-1: header CSV, comma, double-quote quoting and escaping.

    ``multiline`` keeps quoted line breaks inside one record (a file is then
    read by one task: such files are not splittable). With no ``schema`` and
    ``infer`` off every column is a string, as in the raw tables. A file whose
    header differs from the schema in names or order fails the read instead of
    having its columns taken by position.
    """
    reader = (spark.read.option("header", True).option("sep", ",").option("quote", '"')
              .option("escape", '"').option("multiLine", multiline).option("encoding", encoding)
              .option("mode", "PERMISSIVE").option("enforceSchema", False).option("timestampNTZFormat", TIMESTAMP_TEXT))
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_inferred(spark: SparkSession, path: str, *, encoding: str = "UTF-8") -> DataFrame:
    """SRC-2: types inferred from the data (a full extra pass; an explicit
    schema is preferred at scale)."""
    return read_csv(spark, path, infer=True, encoding=encoding)


@contextmanager
def legacy_charsets(spark: SparkSession):
    key = "spark.sql.legacy.javaCharsets"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def read_csv_charset(spark: SparkSession, path: str, encoding: str = "CP949",
                     schema: T.StructType | str | None = None, infer: bool = False) -> DataFrame:
    """SRC-3: CSV in a legacy charset such as CP949 / EUC-KR.

    Spark 4 refuses non-standard charsets unless ``spark.sql.legacy.javaCharsets``
    is on, and checks it again whenever the scan runs. In a session that has it on
    this is a plain lazy read. Otherwise the setting is turned on for this read only: the text is decoded once into a reliable checkpoint
    (in the shared ``spark.checkpoint.dir``), which later plans read instead
    of the CSV, so no other query runs with the legacy setting.
    """
    from metroframe.session import shared_dir

    if spark.conf.get("spark.sql.legacy.javaCharsets", "false") == "true":
        return read_csv(spark, path, schema, encoding=encoding, infer=infer)
    shared_dir(spark)
    with legacy_charsets(spark):
        df = read_csv(spark, path, schema, encoding=encoding, infer=infer).checkpoint(eager=True)
    return df
