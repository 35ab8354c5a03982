import math

from pyspark.sql import functions as F

from terrace.functions.casting import all_string_schema, cast_bool, cast_to, repair_json, repair_json_columns
from terrace.functions.dates import apply_steps, parse_dates
from terrace.specs import DateRepair
from pyspark.sql.types import StructType


def test_try_cast_bad_values_become_null(spark):
    df = spark.createDataFrame([(" 7 ", "1.9", "2024-02-30", "99999999999", "1.255"),
                                ("x", "3", "2024-01-02", "12", "abc")], "a string, b string, d string, big string, dec string")
    out = cast_to(df, {"a": "int", "b": "int", "d": "date", "big": "int", "dec": "decimal(10,2)"}).collect()
    assert out[0]["a"] == 7 and out[0]["b"] is None and out[0]["d"] is None and out[0]["big"] is None
    assert str(out[0]["dec"]) == "1.26"       # rounds half-up
    assert out[1]["a"] is None and out[1]["b"] == 3 and str(out[1]["d"]) == "2024-01-02" and out[1]["dec"] is None


def test_unknown_columns_stay_strings(spark):
    df = spark.createDataFrame([("1", "z")], "Id string, other string")
    out = cast_to(df, {"id": "bigint"})     # lookup by lower-cased name
    assert out.schema["Id"].dataType.simpleString() == "bigint"
    assert out.schema["other"].dataType.simpleString() == "string"


def test_boolean_words(spark):
    words = ["true", "T", "Yes", "y", "SI", "s", "1", "false", "f", "No", "n", "0", "maybe", None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(cast_bool("w")).collect()]
    assert got == [True] * 7 + [False] * 5 + [None, None]


def test_from_json_struct_and_array(spark):
    df = spark.createDataFrame([('{"k": 5}', '[1,2]'), ("bad", "bad")], "s string, a string")
    out = cast_to(df, {"s": "struct<k:int>", "a": "array<int>"}).collect()
    assert out[0]["s"]["k"] == 5 and out[0]["a"] == [1, 2]
    assert out[1]["s"] is None or out[1]["s"]["k"] is None
    assert out[1]["a"] is None


def test_repair_json_rewrites(spark):
    texts = ["{'@Asset-Id': 'A1', 'Price': 3}", "{key=value, n=2}", '{"Already": "ok"}']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(repair_json("t")).collect()]
    assert got[0] == '{"assetid": "A1", "price": 3}'
    assert got[1] == '{"key": "value", "n": "2"}'
    assert got[2] == '{"already": "ok"}'


def test_repair_json_columns_only_struct_targets(spark):
    df = spark.createDataFrame([("{'A': 1}", "{'A': 1}", "x")], "Pos string, plain string, `odd-name` string")
    target = StructType.fromDDL("pos struct<a:int>, plain string")
    out = repair_json_columns(df, target)
    assert out.columns == ["Pos", "plain", "oddname"]
    row = cast_to(out, target).first()
    assert row["Pos"]["a"] == 1 and row["plain"] == "{'A': 1}"


def test_parse_dates_first_format_wins_and_unparsed_kept(spark):
    df = spark.createDataFrame([("03-Jan-2024",), ("2024/01/05",), ("3-Jan-2024",), (None,), ("junk",)], "d string")
    out = [r[0] for r in parse_dates(df, DateRepair(["d"], ["dd-MMM-yyyy", "yyyy/MM/dd"])).collect()]
    assert out == ["2024-01-03", "2024-01-05", "3-Jan-2024", None, "junk"]


def test_parse_dates_missing_column_raises(spark):
    df = spark.createDataFrame([("x",)], "d string")
    try:
        apply_steps(df, [DateRepair(["nope"], ["yyyy"])])
    except ValueError as e:
        assert "nope" in str(e)
    else:
        raise AssertionError("expected a ValueError")


def test_all_string_schema():
    s = all_string_schema(["a", "b"])
    assert [f.dataType.simpleString() for f in s.fields] == ["string", "string"]


def test_normalise_keys_literals(spark):
    from terrace.functions.casting import normalise_keys
    cases = {"{'A-b': 1}": '{"ab": 1}', '{"\u00c9 x" : 1, \'B\':2}': '{"\u00e9x" : 1, "b":2}', "no keys": "no keys", "": "", "'a'": "'a'",
             "''B':1": "'\"b\":1", "x'K':'L':y": 'x"k":"l":y', "'@':1": '"":1'}
    df = spark.createDataFrame([(t,) for t in cases] + [(None,)], "t string")
    assert [r[0] for r in df.select(normalise_keys(F.col("t"))).collect()] == [*cases.values(), None]


def test_repair_json_leaves_valid_values_alone(spark):
    cases = {'{"Url": "http://h/p?x=1", "n": 1}': '{"url": "http://h/p?x=1", "n": 1}',
             '{"A": "say \'hi\': ok, b=c", "B": {"C-d": [1, "x: y"]}}': '{"a": "say \'hi\': ok, b=c", "b": {"cd": [1, "x: y"]}}',
             '{"A": "quote \\" inside: yes"}': '{"a": "quote \\" inside: yes"}',
             "{'Url': 'http://h?x=1', 'k': \"it's\"}": '{"url": "http://h?x=1", "k": "it\'s"}'}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert [r[0] for r in df.select(repair_json("t")).collect()] == list(cases.values())
