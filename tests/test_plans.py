"""The physical plans are the ones meant: pruned scans, no Python, no hot groups."""

import pytest
from pyspark.sql import functions as F

from marketlens import configure, schemas
from marketlens.operators.cost import current_costs
from marketlens.operators.lookup import lookup
from marketlens.plans import facts, identity, settlement
from workload import fixtures as fx
from workload import queries


def _plan(rows, mode="formatted"):
    mode = rows.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    return rows._jdf.queryExecution().explainString(mode)


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("plans") / "lines")
    fx.settlement_lines(spark, sf_dir).write.parquet(folder)
    return spark.read.parquet(folder)


def test_summary_reads_its_columns_and_groups_once(spark, sf_dir, stored):
    plan = _plan(settlement.settlement_summary(stored, fx.accounts(spark, sf_dir)))
    schema = next(line for line in plan.splitlines() if "ReadSchema" in line and "for_pay" in line)
    assert "kiz" not in schema and "title" not in schema
    assert plan.count("HashAggregate") >= 2 and "SortAggregate" not in plan
    assert "BroadcastHashJoin" in plan  # accounts, joined after the grouping


def test_account_filter_reaches_the_scan(spark, stored):
    plan = _plan(identity.unit_identity(stored.filter("account_id = 2")))
    scans = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert scans and all("EqualTo(account_id,2)" in line for line in scans)


@pytest.mark.parametrize("name", ["resolved_lines", "unit_identity", "unit_buyout", "article_facts", "facts_load"])
def test_lines_read_several_times_are_made_once(spark, sf_dir, name):
    plan = _plan(queries.registered()[name](spark, sf_dir))
    assert "lineitem.parquet" not in plan and "settlement-lines" in plan


def test_facts_shuffle_units_once(spark, sf_dir):
    lines = fx.settlement_lines_once(spark, sf_dir, "day")
    plan = _plan(facts.article_facts(lines, fx.accounts(spark, sf_dir)), "simple")
    # Of marked and unmarked lines, of all lines for their units, and for attributes.
    assert plan.count("FileScan parquet") == 5  # with the accounts
    assert plan.count("Window [") == 1 and "article-units" not in plan


def test_units_cross_joins_without_identifiers(spark, sf_dir, tmp_path):
    """What is counted needs no identifier after the units are known."""
    fx.settlement_lines(spark, sf_dir).write.parquet(str(tmp_path / "lines"))
    lines = spark.read.parquet(str(tmp_path / "lines"))
    narrow = identity.unit_identity(lines, only=["account_id", "nm_id"])
    assert narrow.columns == ["account_id", "nm_id", "restored_kiz", "uniq_product_id"]
    wide = identity.unit_identity(lines).select(*narrow.columns)
    assert narrow.exceptAll(wide).isEmpty() and wide.exceptAll(narrow).isEmpty()


def test_small_sides_of_shuffled_joins_are_hashed(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = identity.unit_identity(configure(spark) and stored)
        found.write.format("noop").mode("overwrite").save()
        found.collect()
        plan = _plan(found, "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in plan.split("Initial Plan")[0]


def test_trusted_identifiers_scan_once(spark, stored):
    plan = _plan(identity.trusted_identifiers(stored), "simple")
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Exchange") == 1
    assert "Not(EqualTo(kiz,))" in _plan(identity.trusted_identifiers(stored))
    assert "Or(IsNull(kiz),EqualTo(kiz,))" in _plan(identity.resolve_lines(stored))


def test_lines_without_a_vendor_code_are_spread(spark, sf_dir, stored):
    blank = stored.withColumns({"vendor_code": F.lit(""), "account_id": F.lit(1).cast("bigint")})
    costs = current_costs(fx.costs(spark, sf_dir))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        enriched = settlement.settlement_enriched(blank, costs)
        sizes = enriched.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for name in settings:
            spark.conf.unset(name)
        configure(spark)
    total = sum(r["count"] for r in sizes)
    assert total == stored.count() and len(sizes) == 4
    assert max(r["count"] for r in sizes) < total / 2


#: Queries that write tables; their parts are covered by the others.
_WRITING = {
    "stored_orders", "stored_sales", "streamed_orders", "streamed_pages", "change_runs", "weekly_run", "stock_run",
    "supplies_run", "settlement_run", "quarantine_runs", "identity_update", "facts_update", "state_stream",
    "streamed_stock", "streamed_supplies",
}


@pytest.mark.parametrize("name", sorted(set(queries.registered()) - _WRITING))
def test_no_python_in_any_plan(spark, sf_dir, name):
    plan = _plan(queries.registered()[name](spark, sf_dir), "simple")
    for operator in ("Python", "ArrowEval", "MapInPandas", "CartesianProduct"):
        assert operator not in plan
    if "BroadcastNestedLoopJoin" in plan:
        pytest.fail("nested loop join")


def test_every_table_key_is_declared():
    for name, keys in schemas.KEYS.items():
        assert set(keys) <= set(schemas.TABLES[name].names), name


def _final_plan(rows):
    rows.write.format("noop").mode("overwrite").save()
    rows.collect()
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_a_hot_key_is_split_over_tasks(spark, how):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.shuffle.partitions": "16",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = spark.range(0, 300_000, 1, 8).selectExpr("if(id % 3 = 0, 7, id) as k", "uuid() as v", "id")
        # One row per key, and already partitioned by it, as grouped rows are.
        unique = spark.range(0, 300_000, 2).groupBy((F.col("id") + 1).alias("k")).agg(F.max("id").alias("m"))
        joined = lookup(rows, unique, ["k"], how)
        plan = _final_plan(joined.groupBy("id").count())
        assert "skewed=true" in plan or "skew=true" in plan, plan
        odd = rows.filter("k % 2 = 1").count()
        expected = {"left": 300_000, "inner": odd, "left_semi": odd, "left_anti": 300_000 - odd}
        assert joined.count() == expected[how]
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_supplies_are_assembled_without_broadcast(spark, sf_dir):
    # Their keys grow with the orders; the driver would gather all of them.
    plan = _final_plan(queries.registered()["supplies_assemble"](spark, sf_dir))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_feeds_are_parsed_over_more_tasks_where_there_are_more_rows(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(fx, "_ROWS_PER_TASK", 100)
    lines = fx.table(spark, sf_dir, "lineitem").count()
    tasks = min(200, 1 + lines // 100)
    assert tasks > spark.sparkContext.defaultParallelism
    # The shuffle comes before the forty columns and the texts.
    plan = _plan(fx.settlement_feed(spark, sf_dir), "simple")
    line = next(row for row in plan.splitlines() if f"RoundRobinPartitioning({tasks})" in row)
    below = plan.splitlines()[plan.splitlines().index(line) + 1]
    assert "sellerOperName" not in plan[plan.index(line):] and "retail_amount" not in below


def test_supplies_are_staged_without_what_no_table_shows(spark, sf_dir, monkeypatch):
    written = []
    write = queries.staged
    monkeypatch.setattr(queries, "staged", lambda rows, label: written.append(rows.columns) or write(rows, label))
    queries.registered()["supplies_load"](spark, sf_dir)
    assert len(written) == 1 and "supply" in written[0] and "_raw" not in written[0]
