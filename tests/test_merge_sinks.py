import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from terrace.operators.merge import Clause, DuplicateSourceKeyError, merge_frames, plan_merge
from terrace.sinks.tables import append, delete_where, merge_into, overwrite_partitions, read_target
from terrace.specs import TableSpec

SCHEMA = "k int, v string, d string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(str(x) for x in r))


def test_upsert_keeps_null_keys_and_counts(spark):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (None, "n", "x")], SCHEMA)
    s = spark.createDataFrame([(2, "B", "x"), (3, "C", "x"), (None, "N", "x")], SCHEMA)
    plan = plan_merge(t, s, ["k"])
    out = plan.frame
    expected = [(1, "a", "x"), (2, "B", "x"), (3, "C", "x"), (None, "n", "x"), (None, "N", "x")]
    assert rows(out) == sorted(expected, key=lambda r: tuple(str(x) for x in r))
    c = plan.counts()
    assert (c.inserted, c.updated, c.kept) == (2, 1, 2)


@pytest.mark.parametrize("strategy", ["upsert", "insert_only", "update_only", "delete_matched"])
def test_plan_matches_full_outer_audit(spark, strategy):
    from terrace.operators.merge import merge_actions
    t = spark.createDataFrame([(i, f"t{i}", "x") for i in range(0, 40, 2)] + [(None, "tn", "x")], SCHEMA)
    s = spark.createDataFrame([(i, f"s{i}", "y") for i in range(0, 60, 3)] + [(None, "sn", "y")], SCHEMA)
    for upd in (None, ["d"]):
        if upd and strategy not in ("upsert", "update_only"):
            continue
        plan = plan_merge(t, s, ["k"], strategy, update_columns=upd)
        audit = merge_actions(t, s, ["k"], strategy, update_columns=upd)
        want = audit.where(F.col("_action").isin("kept", "updated", "inserted")).drop("_action")
        assert rows(plan.frame) == rows(want)
        c = plan.counts()
        acts = {r[0]: r[1] for r in audit.groupBy("_action").count().collect()}
        assert (c.inserted, c.updated, c.deleted) == (acts.get("inserted", 0), acts.get("updated", 0), acts.get("deleted", 0))


def test_null_safe_merge_matches_null_keys(spark):
    t = spark.createDataFrame([(None, "n", "x")], SCHEMA)
    s = spark.createDataFrame([(None, "N", "x")], SCHEMA)
    assert rows(merge_frames(t, s, ["k"], null_safe=True)) == [(None, "N", "x")]


@pytest.mark.parametrize("strategy,expected", [
    ("insert_only", [(1, "a", "x"), (2, "b", "x"), (3, "C", "x")]),
    ("update_only", [(1, "a", "x"), (2, "B", "x")]),
    ("delete_matched", [(1, "a", "x")]),
])
def test_strategies(spark, strategy, expected):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], SCHEMA)
    s = spark.createDataFrame([(2, "B", "x"), (3, "C", "x")], SCHEMA)
    assert rows(merge_frames(t, s, ["k"], strategy)) == expected


def test_update_subset_of_columns(spark):
    t = spark.createDataFrame([(1, "a", "x")], SCHEMA)
    s = spark.createDataFrame([(1, "A", "y")], SCHEMA)
    assert rows(merge_frames(t, s, ["k"], "upsert", update_columns=["d"])) == [(1, "a", "y")]


def test_upsert_is_idempotent_on_table(spark, tmp_dir):
    spec = TableSpec(f"{tmp_dir}/t", schema=spark.createDataFrame([], SCHEMA).schema, primary_keys=["d", "k"], partition_field="d")
    base = spark.createDataFrame([(1, "a", "2024-01-01"), (2, "b", "2024-01-02")], SCHEMA)
    append(spark, base, spec)
    src = spark.createDataFrame([(2, "B", "2024-01-02"), (3, "C", "2024-01-02")], SCHEMA)
    r1 = merge_into(spark, spec, src)
    first = rows(read_target(spark, spec))
    r2 = merge_into(spark, spec, src)
    assert rows(read_target(spark, spec)) == first == [(1, "a", "2024-01-01"), (2, "B", "2024-01-02"), (3, "C", "2024-01-02")]
    assert (r1.merge.inserted, r1.merge.updated) == (1, 1)
    assert (r2.merge.inserted, r2.merge.updated) == (0, 2)
    assert r1.partitions == ["2024-01-02"]


def test_duplicate_source_keys_matching_target_raise(spark, tmp_dir):
    spec = TableSpec(f"{tmp_dir}/t", schema=spark.createDataFrame([], SCHEMA).schema, primary_keys=["k"], partition_field=None)
    append(spark, spark.createDataFrame([(1, "a", "x")], SCHEMA), spec)
    dup = spark.createDataFrame([(1, "p", "x"), (1, "q", "x")], SCHEMA)
    with pytest.raises(DuplicateSourceKeyError):
        merge_into(spark, spec, dup)


def test_delete_where_drops_emptied_partition(spark, tmp_dir):
    spec = TableSpec(f"{tmp_dir}/t", schema=spark.createDataFrame([], SCHEMA).schema, partition_field="d")
    append(spark, spark.createDataFrame([(1, "a", "p1"), (2, "b", "p2"), (None, "n", "p2")], SCHEMA), spec)
    res = delete_where(spark, spec, "k = 1 OR v = 'b'")
    assert rows(read_target(spark, spec)) == [(None, "n", "p2")]     # NULL predicate keeps the row
    assert sorted(res.partitions) == ["p1", "p2"]
    import os
    assert not os.path.exists(f"{tmp_dir}/t/d=p1")


def test_overwrite_partitions_replaces_only_present(spark, tmp_dir):
    spec = TableSpec(f"{tmp_dir}/t", schema=spark.createDataFrame([], SCHEMA).schema, partition_field="d")
    append(spark, spark.createDataFrame([(1, "a", "p1"), (2, "b", "p2")], SCHEMA), spec)
    overwrite_partitions(spark, spark.createDataFrame([(3, "c", "p2")], SCHEMA), spec)
    assert rows(read_target(spark, spec)) == [(1, "a", "p1"), (3, "c", "p2")]


def test_append_conforms_and_dedupes(spark, tmp_dir):
    spec = TableSpec(f"{tmp_dir}/t", schema=spark.createDataFrame([], SCHEMA).schema, partition_field="d")
    df = spark.createDataFrame([(1, "a", "p1", "junk"), (1, "a", "p1", "other")], SCHEMA + ", extra string")
    assert append(spark, df, spec).rows_written == 1


def _spec(spark, tmp_dir, keys, part="d"):
    return TableSpec(f"{tmp_dir}/t", schema=spark.createDataFrame([], SCHEMA).schema, primary_keys=keys, partition_field=part)


def test_empty_inputs_write_nothing(spark, tmp_dir):
    spec = _spec(spark, tmp_dir, ["k"])
    empty = spark.createDataFrame([(1, "a", "p")], SCHEMA).where("k > 5")
    assert append(spark, empty, spec).rows_written == 0
    assert overwrite_partitions(spark, empty, spec).rows_written == 0


def test_null_partition_merge_and_delete(spark, tmp_dir):
    spec = _spec(spark, tmp_dir, ["d", "k"])
    append(spark, spark.createDataFrame([(1, "a", None), (2, "b", "p1")], SCHEMA), spec)
    merge_into(spark, spec, spark.createDataFrame([(3, "c", None)], SCHEMA))
    assert rows(read_target(spark, spec)) == sorted([(1, "a", None), (2, "b", "p1"), (3, "c", None)],
                                                    key=lambda r: tuple(str(x) for x in r))
    res = delete_where(spark, spec, "k = 1")
    assert res.merge.deleted == 1
    assert rows(read_target(spark, spec)) == sorted([(2, "b", "p1"), (3, "c", None)], key=lambda r: tuple(str(x) for x in r))


def test_whole_table_merge_after_everything_deleted(spark, tmp_dir):
    spec = _spec(spark, tmp_dir, ["k"])
    append(spark, spark.createDataFrame([(1, "a", "p1")], SCHEMA), spec)
    delete_where(spark, spec, "k = 1")
    assert read_target(spark, spec).count() == 0
    res = merge_into(spark, spec, spark.createDataFrame([(2, "b", "p2")], SCHEMA))
    assert res.merge.inserted == 1 and rows(read_target(spark, spec)) == [(2, "b", "p2")]


def test_writes_cast_to_declared_types(spark, tmp_dir):
    spec = TableSpec(f"{tmp_dir}/t", schema=spark.createDataFrame([], "k int, v double, d string").schema, partition_field="d")
    append(spark, spark.createDataFrame([(1, 2, "p")], "k bigint, v bigint, d string"), spec)
    assert [tuple(r) for r in read_target(spark, spec).collect()] == [(1, 2.0, "p")]


def test_empty_string_and_null_share_default_partition(spark, tmp_dir):
    spec = _spec(spark, tmp_dir, ["d", "k"])
    append(spark, spark.createDataFrame([(1, "a", None), (2, "b", "p1")], SCHEMA), spec)
    merge_into(spark, spec, spark.createDataFrame([(3, "c", "")], SCHEMA))
    assert sorted(r.k for r in read_target(spark, spec).collect()) == [1, 2, 3]


def test_schema_less_partition_values_keep_their_text(spark, tmp_dir):
    spec = TableSpec(f"{tmp_dir}/t", partition_field="code")
    append(spark, spark.createDataFrame([(1, "007"), (2, "007")], "k int, code string"), spec)
    res = delete_where(spark, spec, "k = 1")
    assert res.merge.deleted == 1
    assert [tuple(r) for r in read_target(spark, spec).collect()] == [(2, "007")]


def test_whole_table_merge_keeps_partitioned_layout(spark, tmp_dir):
    import os
    spec = _spec(spark, tmp_dir, ["k"])
    append(spark, spark.createDataFrame([(1, "a", "p1"), (2, "b", "p2")], SCHEMA), spec)
    merge_into(spark, spec, spark.createDataFrame([(2, "B", "p3")], SCHEMA))   # key moves partition
    assert rows(read_target(spark, spec)) == [(1, "a", "p1"), (2, "B", "p3")]
    assert not os.path.exists(f"{tmp_dir}/t/d=p2")


def test_empty_string_key_updates_null_partition_row(spark, tmp_dir):
    spec = _spec(spark, tmp_dir, ["d", "k"])
    append(spark, spark.createDataFrame([(1, "a", None)], SCHEMA), spec)
    res = merge_into(spark, spec, spark.createDataFrame([(1, "A", "")], SCHEMA), null_safe=True)
    assert (res.merge.inserted, res.merge.updated) == (0, 1)      # '' is the NULL partition key
    assert rows(read_target(spark, spec)) == [(1, "A", None)]
    res = merge_into(spark, spec, spark.createDataFrame([(1, "B", "")], SCHEMA))
    assert res.merge.inserted == 1                                # Q3: NULL keys never match by default


def test_conditional_clauses(spark, tmp_dir):
    spec = _spec(spark, tmp_dir, ["k"])
    append(spark, spark.createDataFrame([(1, "a", "p1"), (2, "b", "p1"), (3, "c", "p2"), (4, "d", "p3"), (None, "n", "p1")], SCHEMA), spec)
    src = spark.createDataFrame([(1, "A", "p1"), (2, "drop", "p1"), (3, "C", "p2"), (8, "new", "p4"), (9, "skip", "p4")], SCHEMA)
    res = merge_into(spark, spec, src, clauses=[
        Clause("matched", "delete", "s.v = 'drop'"),
        Clause("matched", "update", "t.k < 3", {"v": "concat(t.v, s.v)"}),
        Clause("not_matched", "insert", "s.v <> 'skip'", {"k": "s.k * 10", "d": "s.d"}),
        Clause("not_matched_by_source", "update", "t.k IS NULL", {"v": "'gone'"}),
        Clause("not_matched_by_source", "delete")])
    assert rows(read_target(spark, spec)) == rows(spark.createDataFrame([(1, "aA", "p1"), (3, "c", "p2"), (80, None, "p4"), (None, "gone", "p1")], SCHEMA))
    assert (res.merge.inserted, res.merge.updated, res.merge.deleted, res.merge.kept) == (1, 2, 2, 1)
    assert res.bytes_added > 0 and res.bytes_removed > 0
    with pytest.raises(ValueError):
        Clause("not_matched", "delete")


def test_unpartitioned_rewrite_failure_leaves_the_table(spark, tmp_dir):
    import os
    spec = TableSpec(f"{tmp_dir}/t", primary_keys=["k"], partition_field=None)
    append(spark, spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], SCHEMA), spec)
    merge_into(spark, spec, spark.createDataFrame([(2, "B", "x")], SCHEMA))
    assert rows(read_target(spark, spec)) == [(1, "a", "x"), (2, "B", "x")]
    with pytest.raises(Exception):
        merge_into(spark, spec, spark.createDataFrame([(1, "A", "x")], SCHEMA), clauses=[Clause("matched", "update", values={"v": "raise_error('no')"})])
    assert rows(read_target(spark, spec)) == [(1, "a", "x"), (2, "B", "x")]
    assert sorted(os.listdir(tmp_dir)) == ["t"]


def test_keyless_rows_pass_by_the_joins(spark):
    t = spark.createDataFrame([(None, f"t{i}", "x") for i in range(5)] + [(1, "a", "x")], SCHEMA)
    s = spark.createDataFrame([(None, "s", "x"), (1, "A", "x")], SCHEMA)
    for strategy, n in (("upsert", 7), ("insert_only", 7), ("update_only", 6), ("delete_matched", 5)):
        plan = plan_merge(t, s, ["k"], strategy)
        assert plan.frame.count() == n
        text = plan.frame._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in text.splitlines() if "Join" in line]
        assert joins and "isnotnull(k" in text


def test_map_columns_are_written_without_repeats(spark, tmp_dir):
    df = spark.sql("SELECT map('a', 1, 'b', 2) AS m, 'p' AS d UNION ALL SELECT map('b', 2, 'a', 1), 'p' UNION ALL SELECT map('a', 3), 'p'")
    spec = TableSpec(f"{tmp_dir}/t", schema=df.schema, partition_field="d")
    append(spark, df, spec)
    assert sorted(len(r.m) for r in read_target(spark, spec).collect()) == [1, 2]


# ------------------------------------------------------------------ commits


def names(path):
    import os
    return {n for n in os.listdir(path) if n.endswith(".parquet") and not n.startswith((".", "_"))}


@pytest.mark.parametrize("strategy", ["upsert", "update_only", "delete_matched", "insert_only"])
def test_only_files_with_a_matching_row_are_rewritten(spark, tmp_dir, strategy):
    schema = spark.createDataFrame([], SCHEMA).schema
    spec = TableSpec(f"{tmp_dir}/t", schema=schema, primary_keys=["k"], partition_field=None, clustered=True, file_rows=10)
    base = [(i, f"t{i}", "x") for i in range(0, 400, 2)] + [(None, "n", "x")]
    append(spark, spark.createDataFrame(base, SCHEMA), spec)
    before = names(spec.path)
    assert len(before) >= 20
    src = [(100, "s", "y"), (102, "s", "y"), (101, "s", "y"), (None, "s", "y")]
    res = merge_into(spark, spec, spark.createDataFrame(src, SCHEMA), strategy)
    gone = before - names(spec.path)
    assert len(gone) == res.files_removed and (len(gone) == 0 if strategy == "insert_only" else 1 <= len(gone) <= 2)
    want = merge_frames(spark.createDataFrame(base, SCHEMA), spark.createDataFrame(src, SCHEMA), ["k"], strategy)
    assert rows(read_target(spark, spec)) == rows(want)
    assert res.merge.kept == len(base) - res.merge.updated - res.merge.deleted


def test_delete_rewrites_only_files_with_a_hit(spark, tmp_dir):
    spec = TableSpec(f"{tmp_dir}/t", schema=spark.createDataFrame([], SCHEMA).schema, primary_keys=["k"], partition_field=None, clustered=True, file_rows=10)
    append(spark, spark.createDataFrame([(i, "v", "x") for i in range(100)], SCHEMA), spec)
    before = names(spec.path)
    res = delete_where(spark, spec, "k = 55")
    assert len(before - names(spec.path)) == 1 and (res.merge.deleted, res.merge.kept, res.rows_written) == (1, 99, 9)
    assert read_target(spark, spec).count() == 99
    res = delete_where(spark, spec, "k = 5555")
    assert (res.files_added, res.files_removed, res.merge.deleted) == (0, 0, 0)


def test_duplicate_null_keys_of_a_null_safe_merge_raise(spark, tmp_dir):
    spec = _spec(spark, tmp_dir, ["k"])
    append(spark, spark.createDataFrame([(None, "t", "p"), (1, "a", "p")], SCHEMA), spec)
    src = spark.createDataFrame([(None, "p", "p"), (None, "q", "p")], SCHEMA)
    with pytest.raises(DuplicateSourceKeyError):
        merge_into(spark, spec, src, null_safe=True)
    assert merge_into(spark, spec, src).merge.inserted == 2     # NULL matches nothing


def test_a_batch_with_a_token_is_written_once(spark, tmp_dir):
    spec = _spec(spark, tmp_dir, ["k"])
    batch = spark.createDataFrame([(1, "a", "p1"), (2, "b", "p2")], SCHEMA)
    first = append(spark, batch, spec, token="b1")
    assert append(spark, batch, spec, token="b1") == first and read_target(spark, spec).count() == 2
    src = spark.createDataFrame([(2, "B", "p2"), (3, "C", "p2")], SCHEMA)
    merged = merge_into(spark, spec, src, token="b2")
    delete_where(spark, spec, "k = 3", token="b3")
    assert merge_into(spark, spec, src, token="b2") == merged
    assert rows(read_target(spark, spec)) == [(1, "a", "p1"), (2, "B", "p2")]


def test_a_commit_that_was_cut_off_is_finished_by_the_next_writer(spark, tmp_dir, monkeypatch):
    from terrace.sinks import commit
    spec = _spec(spark, tmp_dir, ["k"])
    append(spark, spark.createDataFrame([(1, "a", "p1"), (2, "b", "p2")], SCHEMA), spec)
    done = commit.Commits._carry_out

    def lost(self, number, plan):
        raise KeyboardInterrupt
    monkeypatch.setattr(commit.Commits, "_carry_out", lost)
    monkeypatch.setattr("terrace.sinks.tables.delete_path", lambda *a: None)   # a lost driver clears nothing up
    with pytest.raises(KeyboardInterrupt):
        overwrite_partitions(spark, spark.createDataFrame([(9, "z", "p2")], SCHEMA), spec, token="w")
    assert rows(read_target(spark, spec)) == [(1, "a", "p1"), (2, "b", "p2")]
    monkeypatch.undo()
    assert commit.Commits._carry_out is done
    append(spark, spark.createDataFrame([(3, "c", "p3")], SCHEMA), spec)
    assert rows(read_target(spark, spec)) == [(1, "a", "p1"), (3, "c", "p3"), (9, "z", "p2")]
    assert overwrite_partitions(spark, spark.createDataFrame([(9, "z", "p2")], SCHEMA), spec, token="w").rows_written == 1
    assert read_target(spark, spec).count() == 3


def test_a_merge_is_worked_out_again_after_a_faster_writer(spark, tmp_dir, monkeypatch):
    from terrace.sinks import commit, tables
    spec = _spec(spark, tmp_dir, ["k"], part=None)
    append(spark, spark.createDataFrame([(1, "a", "x")], SCHEMA), spec)
    real, other = tables.plan_merge, []

    def slow(*args, **kwargs):
        if not other:
            other.append(append(spark, spark.createDataFrame([(2, "b", "x")], SCHEMA), spec))
        return real(*args, **kwargs)
    monkeypatch.setattr(tables, "plan_merge", slow)
    res = merge_into(spark, spec, spark.createDataFrame([(1, "A", "x"), (2, "B", "x")], SCHEMA))
    assert rows(read_target(spark, spec)) == [(1, "A", "x"), (2, "B", "x")] and (res.merge.inserted, res.merge.updated) == (0, 2)
    monkeypatch.setattr(tables, "ATTEMPTS", 1)
    other.clear()
    with pytest.raises(commit.CommitConflict):
        merge_into(spark, spec, spark.createDataFrame([(1, "C", "x")], SCHEMA))


def test_merges_of_other_partitions_do_not_disturb_each_other(spark, tmp_dir, monkeypatch):
    from terrace.sinks import tables
    spec = _spec(spark, tmp_dir, ["d", "k"])
    append(spark, spark.createDataFrame([(1, "a", "p1"), (1, "b", "p2")], SCHEMA), spec)
    real, calls = tables.plan_merge, []

    def slow(*args, **kwargs):
        calls.append(1)
        if len(calls) == 1:
            merge_into(spark, spec, spark.createDataFrame([(1, "B", "p2")], SCHEMA))
        return real(*args, **kwargs)
    monkeypatch.setattr(tables, "plan_merge", slow)
    merge_into(spark, spec, spark.createDataFrame([(1, "A", "p1")], SCHEMA))
    assert rows(read_target(spark, spec)) == [(1, "A", "p1"), (1, "B", "p2")] and len(calls) == 2


def test_key_ranges_reach_the_reader(spark, tmp_dir):
    from terrace.sinks.tables import key_ranges
    spark.range(1000).selectExpr("id AS k").write.parquet(f"{tmp_dir}/t")
    src = spark.createDataFrame([(5,), (6,), (900,), (None,)], "k long")
    near = spark.read.parquet(f"{tmp_dir}/t").where(key_ranges(src, "k"))
    assert near.count() < 100 and {r.k for r in near.collect()} >= {5, 6, 900}
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan
    assert key_ranges(src.where("k IS NULL"), "k") is None
