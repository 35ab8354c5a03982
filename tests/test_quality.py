import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from terrace.quality.engine import RuleError, run_controls
from terrace.quality.rules import effective_rules, master_frame, rule_violations, rules_frame


def rule(**kw):
    base = dict(control_master_id="M", control_table_id="T", control_algorithm_type="SQL", control_level="Data",
                control_threshold_type="Standard", control_description="SELECT 1", blocking_control_indicator=True,
                active_control_indicator=True)
    base.update(kw)
    return base


def test_rule_violations(spark):
    bad = [rule(control_table_id="a", control_threshold_type="Weird"),
           rule(control_table_id="b", control_threshold_min=5.0, control_threshold_max=1.0),
           rule(control_table_id="c", control_threshold_rag_min=0.9, control_threshold_rag_max=0.1),
           rule(control_table_id="d", control_threshold_rag_max=1.5),
           rule(control_table_id="e", control_threshold_type="Binary", control_threshold_min=0.0, control_threshold_max=1.0),
           rule(control_table_id="f", control_algorithm_type="Java"),
           rule(control_table_id="g", control_level="Row"),
           rule(control_table_id="h", control_description=" "),
           rule(control_table_id="ok")]
    v = rule_violations(rules_frame(spark, bad)).collect()
    ids = {r.control_table_id for r in v}
    assert ids == set("abcdefgh")
    assert any("Binary threshold takes no limits" in r.violation for r in v)


def test_effective_rules_master_defaults(spark):
    ds = rules_frame(spark, [
        rule(control_table_id="t1", control_layer="raw", control_table="x", control_threshold_type=None, control_threshold_max=None),
        rule(control_table_id="t2", control_layer="raw", control_table="x", active_control_indicator=False),
        rule(control_table_id="t3", control_layer="staging", control_table="x")])
    ms = master_frame(spark, [dict(control_master_id="M", control_level="Data", control_threshold_max=9.0,
                                   control_threshold_type="Absolute")])
    out = effective_rules(ds, ms, layer="raw", table="x").collect()
    assert len(out) == 1
    assert out[0].control_threshold_type == "Absolute" and out[0].control_threshold_max == 9.0


def _data(spark):
    return spark.createDataFrame([("1", 0.5), ("2", 1.5), ("3", float("nan")), ("4", -2.0)], "id string, v double")


def test_standard_absolute_binary_and_nan(spark):
    df = _data(spark)
    df.createOrReplaceTempView("qdata")
    rules = rules_frame(spark, [
        rule(control_table_id="std", control_description="SELECT id AS identifier, v AS result FROM qdata",
             control_threshold_min=0.0, control_threshold_max=1.0),
        rule(control_table_id="abs", control_description="SELECT id AS identifier, v AS result FROM qdata",
             control_threshold_type="Absolute", control_threshold_max=1.6),
        rule(control_table_id="bin", control_description="SELECT id AS identifier, v > 0 AS result FROM qdata",
             control_threshold_type="Binary", blocking_control_indicator=False)])
    run = run_controls(spark, df, rules, data_date="2024-01-01")
    res = {r.control_table_id: r for r in run.results.collect()}
    assert res["std"].control_outcome == "{total: 4, value: 3}"       # NaN fails a limit
    assert res["std"].control_detail == "Invalid records: 3"
    assert sorted(r.identifier for r in run.identifiers.where("control_table_id = 'std'").collect()) == ["2", "3", "4"]
    assert res["abs"].control_outcome == "{total: 4, value: 2}"       # |-2| > 1.6 and NaN
    assert res["bin"].control_outcome == "{total: 4, value: 1}"       # NaN > 0 is true in Spark
    assert math.isclose(res["std"].control_metric_value, 0.25)
    assert run.verdict() is False


def test_null_results_with_limits_error_and_strict(spark):
    spark.createDataFrame([("1", None), ("2", 0.5)], "id string, v double").createOrReplaceTempView("qnull")
    rules = rules_frame(spark, [rule(control_table_id="n", control_threshold_max=1.0,
                                     control_description="SELECT id AS identifier, v AS result FROM qnull")])
    run = run_controls(spark, None, rules)
    st = run.status.collect()
    assert st[0].status == "error"
    assert run.results.count() == 0 and run.verdict() is False
    with pytest.raises(RuleError):
        run_controls(spark, None, rules, strict=True)


def test_regex_rule_missing_column_is_isolated(spark):
    df = spark.createDataFrame([("abc", None), ("x1", "zz")], "a string, b string")
    rules = rules_frame(spark, [
        rule(control_table_id="rx", control_algorithm_type="Regex", control_field="a,b", control_description="^[a-z]+$",
             control_threshold_type="Binary"),
        rule(control_table_id="bad", control_algorithm_type="Regex", control_field="nope", control_description=".",
             control_threshold_type="Binary")])
    run = run_controls(spark, df, rules)
    res = {r.control_table_id: r for r in run.results.collect()}
    assert res["rx"].control_outcome == "{total: 4, value: 2}"     # NULL matched as '' fails ^[a-z]+$
    assert res["rx"].control_detail == "Valid columns: a, b. Invalid columns: a, b"
    errs = {r.control_table_id: r.status for r in run.status.collect()}
    assert errs == {"rx": "ok", "bad": "error"}


def test_python_rules_file_and_data_level(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")

    def data_rule(d, r, **kw):
        return d.select(F.col("x").cast("string").alias("identifier"), (F.col("x") > 1).alias("result"))

    def file_rule(r, **kw):
        return spark.createDataFrame([(kw["file_name"], kw["file_name"].endswith(".csv"))], "identifier string, result boolean")

    rules = rules_frame(spark, [
        rule(control_table_id="d", control_algorithm_type="Python", control_description="data_rule",
             control_threshold_type="Binary"),
        rule(control_table_id="f", control_algorithm_type="Python", control_level="File", control_description="file_rule",
             control_threshold_type="Binary")])
    run = run_controls(spark, df, rules, params={"file_name": "a.csv"},
                       registry={"data_rule": data_rule, "file_rule": file_rule})
    res = {r.control_table_id: r.control_outcome for r in run.results.collect()}
    assert res == {"d": "{total: 2, value: 1}", "f": "{total: 1, value: 0}"}


def test_no_rules_pass(spark):
    run = run_controls(spark, None, rules_frame(spark, []))
    assert run.verdict() is True and run.results.count() == 0


def test_save_results_with_complete_identifiers(spark, tmp_dir):
    from terrace.quality.engine import save_results
    from terrace.sinks.tables import read_target
    from terrace.specs import TableSpec
    spark.range(250).selectExpr("CAST(id AS STRING) AS identifier", "id % 2 = 0 AS result").createOrReplaceTempView("half")
    rules = rules_frame(spark, [rule(control_table_id="h", control_threshold_type="Binary",
                                     control_description="SELECT identifier, result FROM half")])
    run = run_controls(spark, None, rules, data_date="2024-01-01")
    res_spec = TableSpec(f"{tmp_dir}/res", partition_field="data_date")
    ids_spec = TableSpec(f"{tmp_dir}/ids", partition_field="data_date")
    assert save_results(spark, run, res_spec, ids_spec) == 1
    assert read_target(spark, ids_spec).count() == 125      # all invalid ids
    assert read_target(spark, res_spec).first().control_outcome == "{total: 250, value: 125}"


def test_result_type_must_fit_threshold(spark):
    spark.createDataFrame([("1", 0.5, True)], "id string, v double, b boolean").createOrReplaceTempView("qtypes")
    rules = rules_frame(spark, [
        rule(control_table_id="bin_num", control_threshold_type="Binary", control_description="SELECT id AS identifier, v AS result FROM qtypes"),
        rule(control_table_id="abs_bool", control_threshold_type="Absolute", control_threshold_max=1.0,
             control_description="SELECT id AS identifier, b AS result FROM qtypes"),
        rule(control_table_id="std_bool", control_threshold_type="Standard", control_threshold_min=1.0,
             control_description="SELECT id AS identifier, b AS result FROM qtypes")])
    run = run_controls(spark, None, rules)
    st = {r.control_table_id: r.status for r in run.status.collect()}
    assert st == {"bin_num": "error", "abs_bool": "error", "std_bool": "ok"}
    assert run.results.first().control_outcome == "{total: 1, value: 0}"     # True counts as 1


def test_failing_rule_is_isolated_at_run_time(spark):
    spark.createDataFrame([("1", "x"), ("2", "7")], "id string, v string").createOrReplaceTempView("qrun")
    rules = rules_frame(spark, [
        rule(control_table_id="cast", control_threshold_type="Binary", control_description="SELECT id AS identifier, CAST(v AS INT) > 0 AS result FROM qrun"),
        rule(control_table_id="text", control_description="SELECT id AS identifier, v AS result FROM qrun"),
        rule(control_table_id="fine", control_threshold_type="Binary", control_description="SELECT id AS identifier, v = 'x' AS result FROM qrun"),
        rule(control_table_id=None, control_threshold_type="Binary", control_description="SELECT id AS identifier, false AS result FROM qrun"),
        rule(control_table_id="two", control_threshold_type="Binary", control_description="SELECT id AS identifier, true AS result FROM qrun"),
        rule(control_table_id="two", control_threshold_type="Binary", control_description="SELECT id AS identifier, true AS result FROM qrun")])
    run = run_controls(spark, None, rules)
    got = [(r.control_table_id, r.status, r.total, r.invalid) for r in run.status.collect()]
    assert got == [("cast", "error", None, None), ("text", "error", None, None), ("fine", "ok", 2, 1), (None, "error", None, None),
                   ("two", "error", None, None), ("two", "error", None, None)]
    assert run.verdict() is False
    assert [(r.control_table_id, r.identifier) for r in run.identifiers.collect()] == [("fine", "2")]


def test_regex_rules_share_one_scan(spark, tmp_dir):
    spark.createDataFrame([("abc", "1"), ("x1", None)], "a string, b string").write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    rules = rules_frame(spark, [rule(control_table_id=str(i), control_algorithm_type="Regex", control_field="a, b", control_threshold_type="Binary",
                                     control_description=p) for i, p in enumerate(["^[a-z]+$", "^[0-9]*$", "x"])])
    run = run_controls(spark, df, rules)
    assert [(r.total, r.invalid) for r in run.status.collect()] == [(4, 3), (4, 2), (4, 3)]
    from terrace.quality.engine import regex_counts
    counts = regex_counts(df, [({**r.asDict(), "_rule": i}, ["a", "b"]) for i, r in enumerate(rules.collect())])
    assert counts[1].invalid_columns == ["a"] and counts[1].valid_columns == ["b"]


def test_rule_templates_quote_values_and_spare_braces(spark):
    spark.createDataFrame([("it's.csv", "a12"), ("x.csv", "a1")], "f string, v string").createOrReplaceTempView("named")
    rule = dict(control_master_id="M", control_table_id="T", control_algorithm_type="SQL", control_level="Data", control_threshold_type="Binary",
                control_description="SELECT v AS identifier, v RLIKE '^a[0-9]{2}$' AS result FROM named WHERE f = '{file_name}'")
    run = run_controls(spark, None, rules_frame(spark, [rule]), params={"file_name": "it's.csv", "file_date": "2024-01-01"})
    assert [(r.status, r.total, r.invalid) for r in run.status.collect()] == [("ok", 1, 0)]


def _rule_over(text, table="T", **kw):
    return dict(control_master_id="M", control_table_id=table, control_algorithm_type="SQL", control_level="Data", control_threshold_type="Binary",
                control_description=text) | kw


def test_rules_over_one_table_share_its_scan(spark, tmp_dir, monkeypatch):
    from terrace.quality import engine
    spark.range(100).selectExpr("id", "id % 10 AS v", "CAST(id AS STRING) AS name").write.parquet(f"{tmp_dir}/t")
    data = spark.read.parquet(f"{tmp_dir}/t")
    data.createOrReplaceTempView("shared_t")
    spark.range(5).createOrReplaceTempView("other_t")
    rules = [_rule_over("SELECT name AS identifier, v < 9 AS result FROM shared_t", "plain"),
             _rule_over("SELECT concat(name, ',', 'x') AS identifier, v < 5 AS result FROM shared_t WHERE id >= 50", "where"),
             _rule_over("select count(*) as identifier, true as result from shared_t", "aggregate"),
             _rule_over("SELECT DISTINCT v AS identifier, v < 3 AS result FROM shared_t", "distinct"),
             _rule_over("SELECT a.name AS identifier, false AS result FROM shared_t a JOIN other_t b ON a.id = b.id", "join"),
             _rule_over("columns_rule", "python", control_algorithm_type="Python"),
             _rule_over("SELECT CAST(id AS STRING) AS identifier, id < 4 AS result FROM other_t", "other")]
    seen = []
    monkeypatch.setattr(engine, "union_all", lambda frames, real=engine.union_all: seen.append(frames) or real(frames))
    run = run_controls(spark, data, rules_frame(spark, rules), registry={"columns_rule": lambda df, rule, **kw: (F.col("name"), F.col("v") != 0)})
    got = {r.control_table_id: (r.status, r.total, r.invalid) for r in run.status.collect()}
    assert got == {"plain": ("ok", 100, 10), "where": ("ok", 50, 25), "aggregate": ("ok", 1, 0), "distinct": ("ok", 10, 7), "join": ("ok", 5, 5),
                   "python": ("ok", 100, 10), "other": ("ok", 5, 1)}
    assert len(seen[0]) == 5    # plain, where and python are one; the others by themselves
    scans = seen[0][0]._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")
    assert scans == 1
    assert run.identifiers.where("control_table_id = 'where'").count() == 25
    assert {r.identifier for r in run.identifiers.where("control_table_id = 'where'").limit(3).collect()} <= {f"{i},x" for i in range(50, 100)}


def test_a_rule_that_fails_in_a_shared_scan_fails_alone(spark):
    spark.range(10).selectExpr("id", "CAST(id AS STRING) AS s").createOrReplaceTempView("shared_u")
    rules = [_rule_over("SELECT s AS identifier, id < 5 AS result FROM shared_u", "good"),
             _rule_over("SELECT s AS identifier, CAST(concat(s, 'x') AS INT) > 0 AS result FROM shared_u", "bad")]
    run = run_controls(spark, None, rules_frame(spark, rules))
    assert {r.control_table_id: (r.status, r.total, r.invalid) for r in run.status.collect()} == {"good": ("ok", 10, 5), "bad": ("error", None, None)}
