"""Both paths of the dimension join agree, null keys included."""

from pyspark.sql import functions as F

from metroframe.operators.joins import left_dimension_join, left_join_spread_nulls


def test_dimension_join_paths_agree(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, None), (5, "z"), (5, "z")], "id int, k string")
    dim = spark.createDataFrame([("a", "X"), ("b", "Y"), ("b", "Y2")], "dk string, v string")
    small = left_dimension_join(fact, F.broadcast(dim), "k", "dk")
    large = left_dimension_join(fact, dim.hint("merge"), "k", "dk")
    rows = lambda df: sorted((r["id"], r["k"], r["v"]) for r in df.collect())
    assert rows(small) == rows(large)
    assert rows(large) == [(1, "a", "X"), (2, "b", "Y"), (2, "b", "Y2"), (3, None, None), (4, None, None),
                           (5, "z", None), (5, "z", None)]
    assert "__nk_salt" not in large.columns


def test_spread_nulls_keeps_identical_rows(spark):
    left = spark.createDataFrame([(None, 1)] * 5 + [("a", 2)], "k string, x int")
    right = spark.createDataFrame([("a", "hit")], "rk string, v string")
    out = left_join_spread_nulls(left, right, ["k"], ["rk"])
    assert out.count() == 6 and out.where("v = 'hit'").count() == 1


def test_contains_join_is_linear_in_the_text(spark):
    import time

    from metroframe.operators.joins import contains_join

    terms = spark.createDataFrame([(f"needle{k}",) for k in range(50)] + [("\U0001f600x",), ("é",), ("zz",)], "t string")

    def seconds(n):
        text = ("hay stack " * (n // 10)) + "needle7 \U0001f600x"
        rows = spark.createDataFrame([(1, text), (1, text), (2, None)], "id int, s string")
        start = time.time()
        got = contains_join(rows, "s", terms, "t").select("id", "t").collect()
        assert sorted(map(tuple, got)) == sorted([(1, "needle7"), (1, "\U0001f600x")] * 2)
        return time.time() - start

    seconds(1000)
    assert seconds(1_000_000) < 30  # quadratic work would take hours


def test_rarest_grams(spark):
    from metroframe.operators.joins import rarest_grams, text_grams

    terms = spark.createDataFrame([("abcd",), ("abce",), ("xabc",), ("ab",), ("é",), ("",), (None,), ("abcd",)], "t string")
    got = dict(tuple(r) for r in rarest_grams(terms, "t", 3).collect())
    assert got == {"abcd": "bcd", "abce": "bce", "xabc": "xab", "ab": "ab", "é": "é"}
    one = spark.createDataFrame([("aab\U0001f600é",), ("",), ("x",)], "s string").select(text_grams("s", 3).alias("g")).collect()
    assert set(one[0]["g"]) >= {"aab", "ab\U0001f600", "b\U0001f600é", "\U0001f600é", "é"} and one[1]["g"] == [] and one[2]["g"] == ["x"]


def test_contains_join_keeps_all_repeats_and_broadcasts_no_rows(spark):
    from metroframe.operators.joins import contains_join

    texts = [(1, "abcdefgh"), (1, "abcdefgh"), (2, "xab"), (None, "ab"), (3, ""), (4, None), (5, "a\nbcdefg\U0001f600"), (6, "zz")]
    listed = [("abcdef", 1), ("abcdef", 1), ("ab", 2), ("ab", 3), ("bcdefg", None), ("\U0001f600", 4), ("h", 5), ("", 6), (None, 7)]
    rows, terms = spark.createDataFrame(texts, "id int, s string"), spark.createDataFrame(listed, "t string, n int")
    out = contains_join(rows, "s", terms, "t")
    expected = [(i, s, t, n) for i, s in texts for t, n in listed if s is not None and t and t in s]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, expected))
    plan = out._jdf.queryExecution().executedPlan().toString()  # the planner takes this little table for broadcastable
    assert "NestedLoop" not in plan and "BroadcastHashJoin [__text" not in plan and plan.count("ShuffledHashJoin") >= 2


def test_contains_join_in_place_and_by_grams_agree_with_every_pair(spark):
    import random

    from metroframe.operators.joins import FEW_TERMS, REACH, contains_join

    draw = random.Random(3)
    some = lambda n: "".join(draw.choice("ab? \U0001f600\U0001f601é한\0.]\\^-&[\n") for _ in range(draw.randint(0, n)))
    texts = [(k % 17, some(draw.choice([3, 40, 200]))) for k in range(60)] + [(1, None), (None, "ab"), (2, "\U0001f600b")]
    texts += texts[:5]
    listed = [(some(3), k) for k in range(30)] + [("", 1), (None, 2), ("?b", 3), ("?b", 4), ("\0a", 5)]
    long = [t for _, t in texts if t and len(t) > 2 * REACH][:4]
    listed += [(t[1:REACH + n], n) for t in long for n in (-9, 0, 1, 2, 9)] + listed[:4]
    rows, terms = spark.createDataFrame(texts, "id int, s string"), spark.createDataFrame(listed, "t string, n int")
    expected = sorted(str((i, s, t, n)) for i, s in texts for t, n in listed if s is not None and t and t in s)
    for few in (FEW_TERMS, 0):
        got = contains_join(rows, "s", terms, "t", few=few).collect()
        assert sorted(str(tuple(r)) for r in got) == expected


def test_contains_join_hashes_nothing_that_grows_with_the_rows(spark):
    from metroframe.operators.joins import contains_join

    rows = spark.createDataFrame([(k, f"a {k} b c d") for k in range(20)], "id int, s string")
    terms = spark.createDataFrame([("a 1",), ("b c",), ("c d",)], "t string")
    for how in ({}, {"few": 0}):
        out = contains_join(rows, "s", terms, "t", **how).select("id", "t")
        assert len(out.collect()) == 20 * 2 + 11
        plan = out._jdf.queryExecution().executedPlan().toString()
        # what the texts contain is met in a merge join, which spills; a hashed side has to fit in a task's memory
        assert "HashJoin [__text" not in plan and "SortMergeJoin [__text" in plan
