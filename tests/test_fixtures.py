"""The seller's rows: what building them costs, and that odd line numbers are no trouble."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from workload import fixtures as fx
from workload import queries


def _tables(spark, folder, numbers):
    heads = [(n, n + 100, datetime(1996, 1, n)) for n in (5, 6)]
    spark.createDataFrame(heads, "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(f"{folder}/orders.parquet")
    lines = [(order, number, float(price), 1, 1, 1.0, 0.0, 0.0, "N", "O", datetime(1996, 2, 1)) for order, number, price in numbers]
    schema = (
        "l_orderkey long, l_linenumber int, l_extendedprice double, l_partkey long, l_suppkey long, l_quantity double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    )
    spark.createDataFrame(lines, schema).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


@pytest.fixture
def unbroadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("rows", [fx._single_lines, fx.settlement_feed])
def test_lines_are_shuffled_once_to_meet_their_orders(spark, tmp_path, unbroadcast, rows):
    folder = _tables(spark, tmp_path, [(5, 1, 10), (5, 1, 20), (6, 2, 10)])
    plan = rows(spark, folder, "week")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 2  # lines and orders


def test_line_numbers_of_two_digits_share_keys_across_orders(spark, tmp_path):
    folder = _tables(spark, tmp_path, [(5, 12, 10), (6, 2, 20), (5, 1, 1), (5, 1, 2), (6, None, 1)])
    found = fx._single_lines(spark, folder, "week").select("l_orderkey", "l_linenumber", "l_extendedprice").collect()
    assert sorted(tuple(r) for r in found if r.l_linenumber) == [(5, 1, 2.0), (6, 2, 20.0)]


def test_supply_lines_are_made_once_for_each_answer(spark, sf_dir, monkeypatch):
    made = []
    monkeypatch.setattr(queries, "_streamed_answers", lambda _, lines, *args: made.append(lines))
    monkeypatch.setattr(queries.answer_stream, "read_supplies", lambda *_: queries._payloads(spark, sf_dir))
    queries.streamed_supplies(spark, sf_dir)
    plan = made[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "parse_json" not in plan
    counts = made[0].groupBy("answer").agg(F.count("*").alias("n")).collect()
    dates = fx.table(spark, sf_dir, "orders")
    assert {r.answer: r.n for r in counts} == {
        1: dates.filter("o_orderdate < timestamp '1998-01-01'").count(),
        2: dates.filter("o_orderdate >= timestamp '1997-01-01'").count(),
    }
