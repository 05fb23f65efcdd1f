from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marketlens.operators.merge import (
    append_once,
    first_per_key,
    latest_per_complete_key,
    latest_per_key,
    merge_rows,
    replace_children,
    replace_snapshot,
    upsert,
)

SCHEMA = "a bigint, k string, v string, n bigint"


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_last_and_first_arrival(spark):
    rows = spark.createDataFrame([(1, "x", "old", 1), (1, "x", None, 2), (1, "y", "b", 3)], SCHEMA)
    assert _rows(latest_per_key(rows, ["a", "k"], ["n"])) == Counter([(1, "x", None, 2), (1, "y", "b", 3)])
    assert _rows(first_per_key(rows, ["a", "k"], ["n"])) == Counter([(1, "x", "old", 1), (1, "y", "b", 3)])


def test_upsert_overwrites_with_nulls(spark):
    stored = spark.createDataFrame([(1, "x", "old"), (1, "z", "kept")], "a bigint, k string, v string")
    batch = spark.createDataFrame([(1, "x", "mid", 1), (1, "x", None, 2), (2, "x", "new", 1)], SCHEMA)
    after = upsert(stored, batch, ["a", "k"], ["n"])
    assert _rows(after) == Counter([(1, "x", None), (1, "z", "kept"), (2, "x", "new")])
    assert _rows(upsert(after, batch, ["a", "k"], ["n"])) == _rows(after)  # again: no change


def test_null_keys_never_merge(spark):
    rows = spark.createDataFrame([(1, None, "p", 1), (1, None, "q", 2), (1, "x", "r", 3), (1, "x", "s", 4)], SCHEMA)
    kept = _rows(latest_per_complete_key(rows, ["a", "k"], ["n"]))
    assert kept == Counter([(1, None, "p", 1), (1, None, "q", 2), (1, "x", "s", 4)])


def test_children_are_replaced_also_by_nothing(spark):
    schema = "a bigint, k string, v string"
    stored = spark.createDataFrame([(1, "x", "1"), (1, "x", "1"), (1, "y", "2"), (1, "z", "3")], schema)
    fresh = spark.createDataFrame([(1, "x", "9"), (1, "x", "9")], schema)
    parents = spark.createDataFrame([(1, "x"), (1, "y"), (1, "x")], "a bigint, k string")
    after = replace_children(stored, fresh, parents, ["a", "k"])
    assert _rows(after) == Counter({(1, "x", "9"): 2, (1, "z", "3"): 1})


def test_snapshot_of_loaded_accounts(spark):
    schema = "account_id bigint, k string, v string"
    stored = spark.createDataFrame([(1, "x", "old"), (2, "x", "old"), (3, "x", "old")], schema)
    batch = spark.createDataFrame(
        [(1, "y", "a", 1), (1, "y", "b", 2)], "account_id bigint, k string, v string, n bigint"
    )
    loaded = spark.createDataFrame([(1,), (2,)], "account_id bigint")
    after = replace_snapshot(stored, batch, loaded, ["account_id", "k"], ["n"])
    assert _rows(after) == Counter([(1, "y", "b"), (3, "x", "old")])


def test_append_once(spark):
    stored = spark.createDataFrame([(1, "mon")], "a bigint, d string")
    batch = spark.createDataFrame([(1, "mon", 5), (1, "tue", 6), (2, "mon", 7)], "a bigint, d string, v int")
    assert sorted(r.v for r in append_once(stored, batch, ["a", "d"]).collect()) == [6, 7]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    loads=st.lists(
        st.lists(st.tuples(st.integers(1, 2), st.sampled_from("xyz"), st.integers(0, 9)), max_size=6),
        min_size=1,
        max_size=3,
    )
)
def test_upserts_behave_like_a_dictionary(spark, loads):
    schema = "a bigint, k string, v bigint"
    stored, expected = spark.createDataFrame([], schema), {}
    for load in loads:
        numbered = [(a, k, v, n) for n, (a, k, v) in enumerate(load)]
        batch = spark.createDataFrame(numbered, schema + ", n bigint")
        latest = latest_per_key(batch, ["a", "k"], ["n"]).select("a", "k", "v")
        stored = merge_rows(stored, latest, ["a", "k"])
        expected.update({(a, k): v for a, k, v in load})
    assert {(r.a, r.k): r.v for r in stored.collect()} == expected


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(10_000).selectExpr("id % 1 a", "'hot' || (id % 1) k", "'v' v", "id n")
    latest = latest_per_key(rows, ["a", "k"], ["n"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan.split("Exchange", 1)[1]
    assert "WindowGroupLimit" in below_shuffle
    assert [r.n for r in latest.collect()] == [9_999]


def test_latest_per_complete_key_reads_its_rows_once(spark, tmp_path):
    spark.createDataFrame(
        [(1, "a", 1), (1, "a", 2), (1, None, 3), (1, None, 3), (None, None, 4)], "k bigint, name string, at bigint"
    ).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    latest = latest_per_complete_key(rows, ["k", "name"], ["at"])
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    assert latest._jdf.queryExecution().explainString(mode).count("FileScan") == 1
    assert latest.columns == ["k", "name", "at"]
    found = sorted((tuple(r) for r in latest.collect()), key=str)
    assert found == [(1, "a", 2), (1, None, 3), (1, None, 3), (None, None, 4)]
