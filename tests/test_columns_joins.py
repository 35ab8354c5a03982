import pytest
from pyspark.sql import functions as F

from terrace.functions.text import file_date, normalise_header, to_java_regex
from terrace.operators.columns import (clean_names, coalesce_pairs, conform, distinct_tokens, pick_column,
                                       project_report, stack_columns)
from terrace.operators.joins import equi_join


def test_coalesce_pairs(spark):
    df = spark.createDataFrame([(None, "d"), ("c", "d")], "x_c string, x_d string")
    out = coalesce_pairs(df, ["x"], "_c", "_d")
    assert out.columns == ["x"] and [r[0] for r in out.collect()] == ["d", "c"]


def test_pick_column_default_applies(spark):
    df = spark.createDataFrame([("a", 1, 2), ("b", 1, 2), ("zzz", 1, 2)], "ref string, a int, b int")
    got = [r["v"] for r in pick_column(df, "v", "ref", ["a", "b"], default=-1).collect()]
    assert got == [1, 2, -1]
    assert [r["v"] for r in pick_column(df, "v", "ref", [], default=5).collect()] == [5, 5, 5]


def test_stack_keeps_nulls_and_mixed_types(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    out = stack_columns(df, ["a", "b"], ["name", "value"])
    assert out.count() == 4
    assert sorted((r[0], r[1]) for r in out.collect() if r[1] is not None) == [("a", "1"), ("a", "2"), ("b", "x")]
    with pytest.raises(ValueError):
        stack_columns(df, ["a"], ["only_one"])


def test_distinct_tokens_skip_null_and_empty(spark):
    df = spark.createDataFrame([("a|b",), ("b|c",), ("",), (None,)], "s string")
    assert sorted(r[0] for r in distinct_tokens(df, "s", "[|]").collect()) == ["a", "b", "c"]


def test_conform_is_whole_row_distinct(spark):
    df = spark.createDataFrame([(1, "a", 9), (1, "a", 8), (1, "b", 9)], "k int, v string, extra int")
    assert conform(df, ["k", "v"]).count() == 2


def test_clean_names_and_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `c-d` int")
    assert clean_names(df).columns == ["ab", "cd"]
    with pytest.raises(ValueError):
        clean_names(spark.createDataFrame([(1, 2)], "`a b` int, ab int"))


def test_project_report_alias_length(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert project_report(df, ["a"], ["b"]).columns == ["b"]
    with pytest.raises(ValueError):
        project_report(df, ["a"], ["b", "c"])


def test_normalise_header(spark):
    raw = ["  Total Return / Local (%) ", "Account_Number", "a\tb"]
    df = spark.createDataFrame([(r,) for r in raw], "h string")
    got = [r[0] for r in df.select(normalise_header("h")).collect()]
    assert got == ["total_return_local_", "account_number", "a_b"]   # "(%)" removed after the trim leaves a trailing "_"


def test_file_date_groups(spark):
    df = spark.createDataFrame([("x_2024_01_31.csv",), ("nodate.csv",)], "n string")
    got = [r[0] for r in df.select(file_date("n", r"(\d{4})_(\d{2})_(\d{2})")).collect()]
    assert got == ["2024-01-31", None]
    named = r"(?P<day>\d{2})-(?P<month>\d{2})-(?P<year>\d{4})"
    df2 = spark.createDataFrame([("f_31-01-2024.txt",)], "n string")
    assert df2.select(file_date("n", named)).first()[0] == "2024-01-31"
    assert to_java_regex(named).startswith("(?<day>")


def _sides(spark):
    left = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 0)], "k int, v string, only_l int")
    right = spark.createDataFrame([(1, "A", 100), (3, "C", 300), (None, "N", 0)], "k int, v string, only_r int")
    return left, right


@pytest.mark.parametrize("how,rows", [("inner", 1), ("left", 3), ("right", 3), ("outer", 5)])
def test_join_kinds_suffixes_and_null_keys(spark, how, rows):
    left, right = _sides(spark)
    out = equi_join(left, right, how, ["k"])
    assert out.columns == ["k", "v_df_1", "only_l", "v_df_2", "only_r"]
    assert out.count() == rows     # NULL keys never match


def test_join_different_key_names(spark):
    left = spark.createDataFrame([(1, "a")], "lk int, v string")
    right = spark.createDataFrame([(1, "b")], "rk int, v string")
    out = equi_join(left, right, "inner", ["lk"], ["rk"])
    assert out.columns == ["lk", "v_df_1", "v_df_2"]
    with pytest.raises(ValueError):
        equi_join(left, right, "inner", ["lk"], ["rk", "v"])
    with pytest.raises(ValueError):
        equi_join(left, right, "cross", ["lk"])


def test_join_keys_swapped_positions(spark):
    left = spark.createDataFrame([(1, 2, "l")], "a int, b int, x string")
    right = spark.createDataFrame([(2, 1, "r")], "b int, a int, y string")   # left.a = right.b fails
    assert equi_join(left, right, "inner", ["a", "b"], ["b", "a"]).count() == 0
    right2 = spark.createDataFrame([(1, 2, "r")], "b int, a int, y string")
    got = equi_join(left, right2, "inner", ["a", "b"], ["b", "a"]).collect()
    assert [tuple(r) for r in got] == [(1, 2, "l", "r")]


def test_join_left_column_named_like_the_right_key_is_suffixed(spark):
    left = spark.createDataFrame([(1, "mine")], "a int, id string")
    right = spark.createDataFrame([(1, "theirs")], "id int, v string")
    out = equi_join(left, right, "inner", ["a"], ["id"])
    assert out.columns == ["a", "id_df_1", "v"] and tuple(out.first()) == (1, "mine", "theirs")
