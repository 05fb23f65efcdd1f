"""Stored tables, whole loads, and the stream that must equal them."""

import json
import os
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marketlens import schemas
from marketlens.functions import operations as op
from marketlens.operators import normalize
from marketlens.plans.loads import (
    Store,
    load_article_facts,
    load_movements,
    load_settlement,
    load_stock,
    load_supplies,
)
from marketlens.session import shared_dir
from marketlens.sources import landed, tables
from marketlens.streaming import feed_stream

NOW = "2026-06-01 12:00:00"


def _now():
    return F.lit(NOW).cast("timestamp")


def _feed(spark, feed, rows, page=0):
    lines = [
        json.dumps({"account_id": 1, "page": page, "position": n, **row}) for n, row in enumerate(rows)
    ]
    texts = spark.createDataFrame([(line,) for line in lines], "t string")
    schema = landed.landed_schema(feed)
    return texts.select(F.from_json("t", schema).alias("o")).select("o.*")


def _store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def _order(n, price, when="2026-05-03T10:00:00Z", **more):
    return {"srid": f"s{n}", "totalPrice": price, "lastChangeDate": when, **more}


def test_orders_load_is_repeatable(spark, tmp_path):
    store = _store(spark, tmp_path)
    load_movements(store, _feed(spark, "orders", [_order(n, n) for n in range(40)]), "orders")
    changed = [_order(3, 100), _order(3, 300), _order(99, 1, account_id=2)]
    expected = None
    for _ in range(2):
        load_movements(store, _feed(spark, "orders", changed, page=1), "orders")
        rows = store.read("orders").collect()
        found = Counter((r.account_id, r.record_key, int(r.total_price)) for r in rows)
        assert len(found) == len(rows) == 41
        assert found[(1, "s3", 300)] == 1 and found[(2, "s99", 1)] == 1 and found[(1, "s4", 4)] == 1
        assert expected in (None, found)
        expected = found


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names}


def test_a_load_touches_no_stored_file(spark, tmp_path):
    store = _store(spark, tmp_path)
    load_movements(store, _feed(spark, "orders", [_order(n, n) for n in range(40)]), "orders")
    store.compact()
    path = store.path("orders")
    before = {f: os.stat(f).st_mtime_ns for f in _files(path)}
    load_movements(store, _feed(spark, "orders", [_order(n, 7) for n in range(0, 60, 2)]), "orders")
    assert {f: os.stat(f).st_mtime_ns for f in _files(path) if f in before} == before
    assert len(_files(path)) > len(before)


def _prices(store, table="orders"):
    return {(r.account_id, r.record_key): int(r.total_price) for r in store.read(table).collect()}


def test_a_load_that_dies_leaves_the_old_table(spark, tmp_path):
    """Killed after the data and before the mark of a finished write."""
    store = _store(spark, tmp_path)
    load_movements(store, _feed(spark, "orders", [_order(1, 1), _order(2, 2)]), "orders")
    load_movements(store, _feed(spark, "orders", [_order(2, 20), _order(3, 30)]), "orders")
    os.remove(f"{store.path('orders')}/load=2/_SUCCESS")
    assert _prices(store) == {(1, "s1"): 1, (1, "s2"): 2}
    load_movements(store, _feed(spark, "orders", [_order(2, 21)]), "orders")
    assert sorted(n for n in os.listdir(store.path("orders"))) == ["load=1", "load=2", "load=3"]
    assert _prices(store) == {(1, "s1"): 1, (1, "s2"): 21}


def test_a_single_load_is_read_without_sorting_it(spark, tmp_path):
    """A load holds one row per key; a second one is compared with it."""
    path, keys = str(tmp_path / "orders"), schemas.KEYS["orders"]
    for load, price in enumerate((1, 2), 1):
        rows = [{"srid": s, "date": "2026-05-01", "lastChangeDate": "2026-05-01", "totalPrice": price + n} for n, s in enumerate(("a", "a", "b"))]
        batch = normalize.normalize_orders(_feed(spark, "orders", rows), ["page", "position"], _now())
        tables.upsert_table(batch, path, keys, ["page", "position"])
        read = tables.read_table(spark, path, "orders")
        plan = read._jdf.queryExecution().toString()
        assert ("Window" in plan) == (load > 1)
        assert sorted(int(r.total_price) for r in read.collect()) == [price + 1, price + 2]


@pytest.mark.parametrize("most", [0, 100])
def test_keys_of_many_loaded_rows_are_not_broadcast(spark, tmp_path, monkeypatch, most):
    path, keys = str(tmp_path / "orders"), schemas.KEYS["orders"]
    monkeypatch.setattr(tables, "_BROADCAST_ROWS", most)
    for names in ("ab", "bc"):
        rows = [{"srid": s, "date": "2026-05-01", "lastChangeDate": "2026-05-01", "totalPrice": len(names)} for s in names]
        batch = normalize.normalize_orders(_feed(spark, "orders", rows), ["page", "position"], _now())
        tables.upsert_table(batch, path, keys, ["page", "position"])
        if names == "ab":
            tables.compact(spark, path, "orders")
    read = tables.read_table(spark, path, "orders")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (most > 0)
    assert sorted(r.srid for r in read.collect()) == ["a", "b", "c"]


def test_compaction_changes_no_row_and_may_die(spark, tmp_path):
    store = _store(spark, tmp_path)
    expected = {}
    for load in range(4):
        rows = [_order(n, 10 * n + load, account_id=n % 3) for n in range(load, 12, load + 1)]
        load_movements(store, _feed(spark, "orders", rows), "orders")
        expected |= {(n % 3, f"s{n}"): 10 * n + load for n in range(load, 12, load + 1)}
        if load % 2:
            store.compact()
        assert _prices(store) == expected
    path = store.path("orders")
    # The base before and the loads after it stay for those who read them.
    assert sorted(os.listdir(path)) == ["base=2", "base=4", "load=3", "load=4"]
    store.compact()  # nothing new: nothing happens
    assert sorted(os.listdir(path)) == ["base=2", "base=4", "load=3", "load=4"]
    os.remove(f"{path}/base=4/_SUCCESS")
    assert _prices(store) == expected
    store.compact()
    assert _prices(store) == expected and os.path.exists(f"{path}/base=4/_SUCCESS")
    types = [(f.name, f.dataType) for f in store.read("orders").schema]
    assert types == [(f.name, f.dataType) for f in schemas.ORDERS_TABLE]


def test_parts_of_one_load_are_ordered_by_arrival_alone(spark, tmp_path):
    keys, arrival = schemas.KEYS["orders"], ["page", "position"]
    path = str(tmp_path / "table")
    for page in (2, 0, 1):
        rows = normalize.normalize_orders(_feed(spark, "orders", [_order(1, page)], page), arrival)
        tables.upsert_table(rows, path, keys, arrival, order=5)
    assert [int(r.total_price) for r in tables.read_table(spark, path, "orders").collect()] == [2]


def test_one_account_is_read_from_its_own_files(spark, tmp_path):
    store = _store(spark, tmp_path)
    load_movements(store, _feed(spark, "orders", [_order(n, n, account_id=n % 2) for n in range(4)]), "orders")
    store.compact()
    plan = store.read("orders").filter("account_id = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(account_id" in plan


def _line(n, **more):
    return {"reportId": 7, "rrdId": n, "dateFrom": "2026-05-01", "vendorCode": " V1 ", "nmId": 5,
            "sellerOperName": op.SALE, "forPay": "10", "srid": f"u{n}", "orderDt": "2026-05-01",
            "deliveryAmount": 1, **more}


def _accounts(store):
    rows = [(1, "shop_1", "Seller 1", True, None, None, None), (2, "shop_2", "Seller 2", True, None, None, None)]
    store.spark.createDataFrame(rows, schemas.ACCOUNTS).write.parquet(store.path("accounts"))


def test_settlement_load(spark, tmp_path):
    store = _store(spark, tmp_path)
    _accounts(store)
    load_settlement(store, _feed(spark, "finance_sales_report_details", [_line(1), _line(2)]), "settlement_daily", _now())
    assert store.read("settlement_daily").count() == 2
    placeholders = store.read("cost_prices").collect()
    assert [(r.account_id, r.vendor_code, int(r.cost)) for r in placeholders] == [(1, "V1", op.UNKNOWN_COST)]
    assert [(r.nm_id, r.buyout_units) for r in store.read("article_facts").collect()] == [(5, 2)]

    # The same day again: lines are merged, the day's facts and costs stay.
    second = [_line(2, forPay="99"), _line(3), _line(4, account_id=2)]
    load_settlement(store, _feed(spark, "finance_sales_report_details", second, 1), "settlement_daily", _now())
    assert {(r.rrd_id, int(r.for_pay)) for r in store.read("settlement_daily").collect()} == {
        (1, 10), (2, 99), (3, 10), (4, 10),
    }
    facts = store.read("article_facts")
    assert {(r.account_id, r.buyout_units) for r in facts.collect()} == {(1, 2), (2, 1)}
    assert store.read("cost_prices").count() == 2

    # The next day, without any new line.
    load_article_facts(store, F.lit("2026-06-02 12:00:00").cast("timestamp"))
    by_day = {(str(r.fact_date), r.account_id, r.buyout_units) for r in store.read("article_facts").collect()}
    assert by_day == {("2026-06-01", 1, 2), ("2026-06-01", 2, 1), ("2026-06-02", 1, 3), ("2026-06-02", 2, 1)}
    assert store.read("article_facts").schema == schemas.ARTICLE_FACTS


def test_weekly_settlement_leaves_facts_alone(spark, tmp_path):
    store = _store(spark, tmp_path)
    load_settlement(store, _feed(spark, "finance_sales_report_weekly", [_line(1)]), "settlement_weekly", _now())
    assert store.read("settlement_weekly").count() == 1
    assert store.read("article_facts").count() == 0


def test_settlement_line_without_a_key_fails(spark, tmp_path):
    store = _store(spark, tmp_path)
    bad = _feed(spark, "finance_sales_report_details", [_line(1, reportId=None)])
    with pytest.raises(Exception, match="null in required column report_id"):
        load_settlement(store, bad, "settlement_weekly", _now())
    assert store.read("settlement_weekly").count() == 0


def test_stock_load_replaces_and_clears(spark, tmp_path):
    store = _store(spark, tmp_path)

    def stock(account, name, quantity, **more):
        return {"account_id": account, "nmId": 1, "barcode": "b", "techSize": "s",
                "warehouses": [{"warehouseName": name, "quantity": quantity}], **more}

    def accounts(*ids):
        return spark.createDataFrame([(i,) for i in ids], "account_id bigint")

    rows = [stock(1, "W", 1), stock(1, "W", 2), stock(1, "W", 3, nmId=None), stock(1, "W", 4, nmId=None),
            stock(2, "W", 5), stock(3, "W", 6)]
    load_stock(store, _feed(spark, "warehouse_remains", rows), accounts(1, 2, 3))
    assert sorted((r.account_id, r.quantity) for r in store.read("stock").collect()) == [
        (1, 2), (1, 3), (1, 4), (2, 5), (3, 6),
    ]
    store.compact()
    load_stock(store, _feed(spark, "warehouse_remains", [stock(1, "X", 9)]), accounts(1, 2))
    assert sorted((r.account_id, r.warehouse_name, r.quantity) for r in store.read("stock").collect()) == [
        (1, "X", 9), (3, "W", 6),
    ]


def test_supplies_load(spark, tmp_path):
    store = _store(spark, tmp_path)

    def payload(number, goods, packages=(), details=None):
        return {"supply": {"supplyID": number}, "goods": [{"barcode": g} for g in goods], "details": details,
                "packages": [{"packageCode": p, "barcodes": [{"barcode": "x"}]} for p in packages]}

    first = [payload(n, ["a", "a"], ["P"], {"warehouseID": n}) for n in range(1, 6)]
    load_supplies(store, _feed(spark, "supply_payloads", first))
    store.compact()
    again = [payload(1, ["b"]), payload(2, []), payload(7, ["c"], ["Q"])]
    for _ in range(2):
        load_supplies(store, _feed(spark, "supply_payloads", again, 1))
        goods = Counter((r.supply_id, r.barcode) for r in store.read("supply_goods").collect())
        assert goods == Counter({(1, "b"): 1, (3, "a"): 2, (4, "a"): 2, (5, "a"): 2, (7, "c"): 1})
        assert sorted(r.supply_id for r in store.read("supply_packages").collect()) == [3, 4, 5, 7]
        assert sorted(r.supply_id for r in store.read("supply_package_barcodes").collect()) == [3, 4, 5, 7]
        assert store.read("supplies").count() == 6
        assert sorted(r.warehouse_id for r in store.read("supply_details").collect()) == [1, 2, 3, 4, 5]


def test_loads_leave_nothing_staged(spark, tmp_path):
    store = _store(spark, tmp_path)
    _accounts(store)
    before = set(os.listdir(shared_dir(spark)))
    load_settlement(store, _feed(spark, "finance_sales_report_details", [_line(1)]), "settlement_daily", _now())
    load_supplies(store, _feed(spark, "supply_payloads", [{"supply": {"supplyID": 1}, "goods": [{"barcode": "a"}]}]))
    feed_stream.load_batch(
        _feed(spark, "orders", [_order(1, 1)]), 0, "orders", str(tmp_path / "table"), str(tmp_path / "cursor")
    )
    assert set(os.listdir(shared_dir(spark))) == before


# ------------------------------------------------------------ streaming


def _land(folder, rows, page):
    os.makedirs(folder, exist_ok=True)
    lines = [json.dumps({"account_id": 1, "page": page, "position": n, **row}) for n, row in enumerate(rows)]
    with open(f"{folder}/page-{page}.json", "w") as out:
        out.write("\n".join(lines))


def _stream(spark, tmp_path, folder, checkpoint="checkpoint", max_files=1, **options):
    run = feed_stream.start_load(
        landed.stream_feed(spark, folder, "orders", max_files=max_files),
        "orders",
        str(tmp_path / "table"),
        str(tmp_path / "cursor"),
        str(tmp_path / checkpoint),
        **options,
    )
    run.awaitTermination()
    rows = tables.read_table(spark, str(tmp_path / "table"), "orders").collect()
    return {(r.account_id, r.record_key): int(r.total_price) for r in rows}


def _cursor(spark, tmp_path):
    rows = feed_stream.read_cursors(spark, str(tmp_path / "cursor")).selectExpr(
        "account_id", "date_format(cursor_timestamp, 'dd HH:mm') t", "cursor_key"
    )
    return {r.account_id: (r.t, r.cursor_key) for r in rows.collect()}


def test_stream_loads_pages_and_drops_late_rows(spark, tmp_path):
    folder = str(tmp_path / "landed")
    _land(folder, [_order(1, 1), _order(2, 2), _order(5, 5, account_id=2)], 0)
    assert _stream(spark, tmp_path, folder) == {(1, "s1"): 1, (1, "s2"): 2, (2, "s5"): 5}
    assert _cursor(spark, tmp_path) == {1: ("03 10:00", "s2"), 2: ("03 10:00", "s5")}

    time.sleep(1.1)
    _land(
        folder,
        [
            _order(3, 30),  # same time, higher key: new
            _order(1, 100),  # same time, lower key: already seen
            _order(0, 7, "2026-05-02T00:00:00Z"),  # late
            _order(2, 20, "2026-05-04T00:00:00Z"),  # changed since
            _order(9, 9, "2026-05-01T00:00:00Z", account_id=3),  # a new account
        ],
        1,
    )
    expected = {(1, "s1"): 1, (1, "s2"): 20, (1, "s3"): 30, (2, "s5"): 5, (3, "s9"): 9}
    assert _stream(spark, tmp_path, folder) == expected
    cursors = {1: ("04 00:00", "s2"), 2: ("03 10:00", "s5"), 3: ("01 00:00", "s9")}
    assert _cursor(spark, tmp_path) == cursors
    assert _stream(spark, tmp_path, folder) == expected  # nothing landed since


def test_stream_equals_batch(spark, tmp_path):
    folder = str(tmp_path / "landed")
    for page in range(3):
        _land(folder, [_order(n % 7, page * 100 + n, f"2026-05-0{page + 1}T00:00:00Z") for n in range(10)], page)
        stamp = time.time() - 100 + page
        os.utime(f"{folder}/page-{page}.json", (stamp, stamp))  # pages land in order
    streamed = _stream(spark, tmp_path, folder)
    store = _store(spark, tmp_path)
    load_movements(store, landed.read_feed(spark, folder, "orders"), "orders")
    rows = store.read("orders").collect()
    assert streamed == {(r.account_id, r.record_key): int(r.total_price) for r in rows}


@pytest.mark.parametrize("max_files", [None, 1, 2])
def test_the_size_of_batches_decides_nothing(spark, tmp_path, max_files):
    """Pages land out of order, an earlier change in a later file, a row without a date."""
    folder = str(tmp_path / "landed")
    days = {2: "2026-05-04", 0: "2026-05-02", 1: "2026-05-03", 3: "2026-05-01"}
    for place, (page, day) in enumerate(days.items()):
        _land(folder, [_order(n, 10 * page + n, f"{day}T00:00:00Z") for n in range(page, 6)], page)
        stamp = time.time() - 100 + place
        os.utime(f"{folder}/page-{page}.json", (stamp, stamp))
    expected = {(1, f"s{n}"): 10 * min(n, 3) + n for n in range(6)}
    assert _stream(spark, tmp_path, folder, max_files=max_files) == expected
    assert _cursor(spark, tmp_path) == {1: ("04 00:00", "s5")}
    assert len([n for n in os.listdir(tmp_path / "cursor") if n.startswith("batch=")]) <= 2
    if max_files == 1:
        _land(folder, [_order(1, 1, None)], 9)
        with pytest.raises(Exception, match="last_change_date"):
            _stream(spark, tmp_path, folder)


def test_a_run_that_goes_on_keeps_its_starting_cursors(spark, tmp_path):
    folder = str(tmp_path / "landed")
    _land(folder, [_order(1, 1, "2026-05-04T00:00:00Z")], 0)
    died = []

    def load(rows, batch_id, *args, **options):
        if batch_id == 1 and not died:
            died.append(batch_id)
            raise RuntimeError("lost")
        feed_stream.load_batch(rows, batch_id, *args, **options)

    _stream(spark, tmp_path, folder, load=load)
    time.sleep(1.1)
    _land(folder, [_order(2, 2, "2026-05-06T00:00:00Z")], 1)
    stamp = time.time() + 5
    _land(folder, [_order(3, 3, "2026-05-05T00:00:00Z"), _order(4, 4, "2026-05-03T00:00:00Z")], 2)
    os.utime(f"{folder}/page-2.json", (stamp, stamp))
    with pytest.raises(Exception, match="lost"):
        _stream(spark, tmp_path, folder, load=load)
    after = _stream(spark, tmp_path, folder, load=load, resumed=True)
    assert after == {(1, "s1"): 1, (1, "s2"): 2, (1, "s3"): 3}


def test_feeds_without_cursor_start_where_told(spark, tmp_path):
    folder = str(tmp_path / "landed")
    _land(folder, [_order(1, 1, "2026-03-04T00:00:00Z"), _order(2, 2, "2026-05-04T00:00:00Z")], 0)
    starts = spark.sql("select 1L account_id, 'orders' api_type, timestamp'2026-05-01 00:00:00' cursor_timestamp, "
                       "cast(null as string) cursor_key")  # fmt: skip
    assert _stream(spark, tmp_path, folder, starts=starts) == {(1, "s2"): 2}


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    table, cursor = str(tmp_path / "table"), str(tmp_path / "cursor")
    rows = _feed(spark, "orders", [_order(n, n) for n in range(5)])
    seen = []
    for _ in range(2):
        feed_stream.load_batch(rows, 0, "orders", table, cursor)
        stored = tables.read_table(spark, table, "orders")
        seen.append((sorted(r.record_key for r in stored.collect()), feed_stream.read_cursors(spark, cursor).count()))
    assert seen[0] == seen[1] == ([f"s{n}" for n in range(5)], 1)


def test_crash_between_rows_and_cursor_is_repaired(spark, tmp_path):
    table, cursor = str(tmp_path / "table"), str(tmp_path / "cursor")
    rows = _feed(spark, "orders", [_order(n, n) for n in range(5)])
    batch = normalize.normalize_orders(rows, ["page", "position"])
    tables.upsert_table(batch, table, schemas.KEYS["orders"], ["page", "position"])
    feed_stream.load_batch(rows, 0, "orders", table, cursor)
    assert tables.read_table(spark, table, "orders").count() == 5
