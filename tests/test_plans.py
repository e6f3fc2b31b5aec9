"""Plan shape: push-down, pruning, partial top-k, no nested loops."""

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF_SMOKE


def plan_of(df) -> str:
    """The text ``df.explain("formatted")`` prints."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def Q():
    import __spark_entry__ as E

    return E.queries()


def test_scan_pushes_filters_and_prunes_columns(spark, Q):
    plan = plan_of(Q["src_parquet_scan"](spark, SF_SMOKE))
    assert "PushedFilters: [IsNotNull(l_quantity), IsNotNull(l_returnflag), GreaterThan(l_quantity,25.0), EqualTo(l_returnflag,R)]" in plan, plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in plan


def test_in_list_and_contains_reach_the_scan(spark, Q):
    assert "In(c_mktsegment" in plan_of(Q["flt_in_list"](spark, SF_SMOKE))
    assert "StringContains(p_name,red)" in plan_of(Q["flt_contains"](spark, SF_SMOKE))


@pytest.mark.parametrize("name", ["topk_keywords_per_page", "dup_key_subset"])
def test_top_k_is_limited_before_the_shuffle(spark, Q, name):
    plan = plan_of(Q[name](spark, SF_SMOKE))
    assert "WindowGroupLimit" in plan


def test_latest_snapshot_prunes_partitions(spark, Q):
    df = Q["src_latest_snapshot"](spark, SF_SMOKE)
    # only the latest folder's files are in the plan at all, so there is nothing left to filter
    dates = {f.split("request_date=")[1].split("/")[0] for f in df.inputFiles()}
    newest = spark.read.parquet(f"{SF_SMOKE}/events.parquet").select(F.date_format(F.max("ts"), "yyMMdd")).first()[0]
    assert dates == {newest}


@pytest.mark.parametrize("name", ["mart_accessibility", "jn_radius", "jn_scalar_subquery", "agg_count_distinct"])
def test_radius_queries_have_no_nested_loop(spark, Q, name):
    plan = plan_of(Q[name](spark, SF_SMOKE))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_user_tokenizer_as_pandas_udf(spark):
    from metroframe.plans.keywords import top_keywords

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def nouns(text: pd.Series) -> pd.Series:
        # a stand-in analyser: words of two or more letters, lower-cased
        return text.str.lower().str.findall(r"[a-z]{2,}")

    pages = spark.createDataFrame([(1, "<p>Red red BLUE a blue green</p>")], "id long, html string")
    got = [(r["rank"], r["word"], r["n"]) for r in top_keywords(pages, "id", "html", tokenizer=nouns, stop_words=["green"])
           .orderBy("rank").collect()]
    assert got == [(1, "red", 2), (2, "blue", 2)]
