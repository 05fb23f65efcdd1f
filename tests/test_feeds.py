"""Landed JSON in, typed rows out."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketlens import schemas
from marketlens.operators import normalize, supplies
from marketlens.sources import landed


def _land(tmp_path, objects, name="feed"):
    folder = tmp_path / name
    folder.mkdir(exist_ok=True)
    lines = [o if isinstance(o, str) else json.dumps(o, ensure_ascii=False) for o in objects]
    (folder / f"part-{len(list(folder.iterdir()))}.json").write_text("\n".join(lines))
    return str(folder)


def _arrived(rows):
    return [{"account_id": 1, "page": 0, "position": n, **r} for n, r in enumerate(rows)]


def test_orders_are_typed(spark, tmp_path):
    rows = _arrived(
        [
            {"srid": "s1", "lastChangeDate": "2026-05-03T10:00:00", "date": "2026-05-03T10:00:00Z",
             "totalPrice": 12.345, "discountPercent": "", "nmId": 7, "isCancel": False,
             "cancelDate": "0001-01-01T00:00:00", "surprise": {"a": 1}},
            {"srid": "", "gNumber": "g", "lastChangeDate": "2026-05-03T10:00:00", "totalPrice": "7"},
            {"sticker": "t", "lastChangeDate": "2026-05-03T10:00:00"},
            {"lastChangeDate": "2026-05-03T10:00:00"},
        ]
    )
    feed = landed.read_feed(spark, _land(tmp_path, rows), "orders")
    typed = normalize.normalize_orders(feed, ["position"]).orderBy("position")
    assert typed.select(F.year("cancel_date")).first()[0] == 1
    found = typed.drop("cancel_date").collect()  # Python has no such instant in every zone
    assert [r.record_key for r in found] == ["s1", "g", "t", "None"]
    assert [r.total_price for r in found] == [Decimal("12.35"), 7, None, None]
    assert found[0].discount_percent is None and found[0].nm_id == 7
    times = normalize.normalize_orders(feed).select(F.date_format("last_change_date", "HH:mm")).first()
    assert times[0] == "07:00"
    stored = normalize.normalize_orders(feed).schema
    assert set(stored.names) == set(schemas.ORDERS_TABLE.names)
    for field in schemas.ORDERS_TABLE.fields:
        assert stored[field.name].dataType == field.dataType, field.name


def test_sale_and_settlement_keys(spark, tmp_path):
    sales = _arrived(
        [{"saleID": "S1", "srid": "r"}, {"saleID": "", "srid": "r"}, {"gNumber": "g"}, {"sticker": ""}]
    )
    feed = landed.read_feed(spark, _land(tmp_path, sales), "sales")
    assert [r[0] for r in feed.orderBy("position").select(normalize.sale_key()).collect()] == [
        "S1", "r", "g", "None",
    ]
    lines = _arrived([{"reportId": 1, "rrdId": 2}, {"rrdId": 3}])
    feed = landed.read_feed(spark, _land(tmp_path, lines, "lines"), "finance_sales_report_details")
    assert [r[0] for r in feed.orderBy("position").select(normalize.settlement_key()).collect()] == [
        "1:2", "None:3",
    ]


def test_settlement_keeps_the_source_object(spark, tmp_path):
    line = {"reportId": 1, "rrdId": 2, "dateFrom": "2026-05-03T00:00:00", "forPay": "1.5", "orderDt": "",
            "isKgvpV2": 1, "srvDbs": True, "title": "Товар"}
    feed = landed.read_feed(spark, _land(tmp_path, _arrived([line])), "finance_sales_report_details")
    rows = normalize.normalize_settlement(feed)
    assert {f.name for f in schemas.SETTLEMENT_TABLE.fields} == set(rows.columns)
    row = rows.first()
    assert (row.for_pay, row.order_dt, row.is_kgvp_v2, row.srv_dbs) == (Decimal("1.5"), None, 1, True)
    raw = json.loads(row.raw_payload)
    assert raw["title"] == "Товар" and raw["dateFrom"].startswith("2026-05-02T21:00:00")


def test_dates_of_a_source_object_are_read_once(spark, tmp_path):
    line = {"reportId": 1, "rrdId": 2, "dateFrom": "2026-05-03", "orderDt": "", "saleDt": None, "dateTo": "2026-05-03T10:00:00Z",
            "more": {"dateFrom": "2026-05-03"}}
    lines = [line, {"reportId": 1, "rrdId": 3, "createDate": 7}]
    feed = landed.read_feed(spark, _land(tmp_path, _arrived(lines)), "finance_sales_report_details")
    payloads = normalize.normalize_settlement(feed, ["position"]).orderBy("position").select("raw_payload")
    assert [r.raw_payload for r in payloads.collect()] == [
        '{"dateFrom":"2026-05-02T21:00:00.000Z","dateTo":"2026-05-03T10:00:00.000Z","more":{"dateFrom":"2026-05-03"},'
        '"orderDt":"","reportId":1,"rrdId":2,"saleDt":null}',
        '{"createDate":7,"reportId":1,"rrdId":3}',
    ]
    dates = [kind for _, _, kind in schemas.SETTLEMENT.fields() if kind.endswith("instant")]
    plan = payloads._jdf.queryExecution().analyzed().toString()
    assert plan.count("schema_of_variant(") <= len(dates)


def test_bad_rows_fail_the_read(spark, tmp_path):
    for bad in ('"text"', "{broken", '{"nmId": "not a number"}'):
        folder = _land(tmp_path, [bad], f"bad{abs(hash(bad))}")
        with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE|PARSE"):
            landed.read_feed(spark, folder, "orders").collect()


def test_blank_required_date_fails(spark, tmp_path):
    feed = landed.read_feed(spark, _land(tmp_path, _arrived([{"srid": "s", "lastChangeDate": ""}])), "orders")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        normalize.normalize_orders(feed).collect()


def test_stock_rows(spark, tmp_path):
    rows = _arrived(
        [
            {"nmId": 1, "volume": "0.5", "warehouses": [{"warehouseName": "W", "quantity": 3}, {"quantity": None}]},
            {"nmId": 2, "warehouses": []},
            {"nmId": 3},
        ]
    )
    feed = landed.read_feed(spark, _land(tmp_path, rows), "warehouse_remains")
    found = normalize.normalize_stock(feed).collect()
    assert [(r.nm_id, r.warehouse_name, r.quantity) for r in found] == [(1, "W", 3), (1, "", 0)]
    raw = json.loads(found[0].raw_payload)
    assert raw["warehouse"] == {"warehouseName": "W", "quantity": 3} and len(raw["warehouses"]) == 2


def test_stock_texts_are_made_once_a_feed_row(spark, tmp_path):
    odd = {"quantity": None, 'é"x': "a\\\n", "d": {"z": 1, "a": [1, "x", None]}}
    rows = _arrived(
        [
            {"warehouse": "its own", "weight": 1.5, "note": None, "warehouses": [odd, None, {}]},
            {"warehouses": [{"warehouseName": "W"}]},
        ]
    )
    feed = landed.read_feed(spark, _land(tmp_path, rows), "warehouse_remains")
    payloads = normalize.normalize_stock(feed, ["position"]).select("position", "warehouse_position", "raw_payload")
    found = [row.raw_payload for row in payloads.orderBy("position", "warehouse_position").collect()]
    source = {"weight": 1.5, "note": None, "warehouses": [odd, None, {}]}
    assert [json.loads(text) for text in found[:3]] == [{**source, "warehouse": own} for own in source["warehouses"]]
    assert found[3] == '{"warehouses":[{"warehouseName":"W"}],"warehouse":{"warehouseName":"W"}}'
    plan = payloads._jdf.queryExecution().optimizedPlan().toString()
    a_warehouse, _, a_feed_row = plan.partition("Generate posexplode")
    assert "StructsToJson" in a_feed_row and "StructsToJson" not in a_warehouse


PAYLOADS = [
    {"supply": {"supplyID": 5, "preorderID": "9", "statusID": "1", "createDate": "2026-05-01"},
     "details": {"warehouseID": 3, "acceptanceCost": "1.25"},
     "goods": [{"barcode": "a"}, {"barcode": "a"}, None],
     "packages": [{"packageCode": "P", "quantity": 1, "barcodes": [{"barcode": "x"}, {"barcode": ""}]},
                  {"packageCode": "", "barcodes": [{"barcode": "lost"}]},
                  {"packageCode": "Q"}]},
    {"supply": {"supplyID": "", "preorderID": 9}, "details": {}, "goods": [], "packages": []},
    {"supply": {"supplyID": None, "preorderID": ""}, "goods": [{"barcode": "lost"}]},
    {"supply": {"supplyID": 6}},
]


def _supply_rows(spark, tmp_path, payloads, name="supplies"):
    return landed.read_feed(spark, _land(tmp_path, _arrived(payloads), name), "supply_payloads")


def test_supply_payloads(spark, tmp_path):
    feed = _supply_rows(spark, tmp_path, PAYLOADS)
    batch = supplies.normalize_payloads(feed, ["position"])
    heads = batch.supplies.orderBy("position").collect()
    assert [(r.supply_key, r.supply_id, r.preorder_id) for r in heads] == [
        ("supply:5", 5, 9), ("preorder:9", None, 9), ("supply:6", 6, None),
    ]
    assert [(r.supply_key, r.warehouse_id, r.acceptance_cost) for r in batch.details.collect()] == [
        ("supply:5", 3, Decimal("1.25"))
    ]
    assert [r.barcode for r in batch.goods.collect()] == ["a", "a"]
    assert [(r.package_code, r.quantity) for r in batch.packages.collect()] == [("P", 1), ("Q", None)]
    assert [(r.package_code, r.barcode) for r in batch.barcodes.collect()] == [("P", "x")]
    parts = sum(table.count() for table in batch.tables().values())
    assert supplies.rows_processed(feed).first()[0] == parts == 3 + 1 + 2 + 2 + 1


def test_supply_loads(spark, tmp_path):
    arrival = ["position"]
    first = supplies.normalize_payloads(_supply_rows(spark, tmp_path, PAYLOADS), arrival)
    stored = supplies.Supplies(
        first.supplies.drop("position"), first.details.drop("position"), first.goods,
        first.packages.drop("position", "package_position"),
        first.barcodes.drop("position", "package_position", "barcode_position"),
    )
    again = [
        {"supply": {"supplyID": 5, "phone": "1"}, "details": {}, "goods": [{"barcode": "b"}]},
        {"supply": {"supplyID": 5, "phone": "2"}, "goods": [{"barcode": "c"}],
         "packages": [{"packageCode": "P", "quantity": 7}, {"packageCode": "P", "quantity": 8}]},
    ]
    batch = supplies.normalize_payloads(_supply_rows(spark, tmp_path, again, "again"), arrival)
    after = supplies.load_supplies(stored, batch, arrival)
    phones = {r.supply_key: r.phone for r in after.supplies.collect()}
    assert phones == {"supply:5": "2", "preorder:9": None, "supply:6": None}
    assert after.details.count() == 1  # an empty detail leaves the old one
    assert sorted(r.barcode for r in after.goods.collect()) == ["b", "c"]  # of both payloads
    assert [(r.package_code, r.quantity) for r in after.packages.collect()] == [("P", 8)]
    assert after.barcodes.count() == 0


def test_assembled_supplies(spark):
    listed = spark.createDataFrame(
        [(1, "5", None, "first", 0), (1, "5", None, "again", 1), (1, None, "9", "pre", 2), (1, None, None, "no", 3)],
        "account_id bigint, supplyID string, preorderID string, phone string, position int",
    )
    keyed = "account_id bigint, supply_key string, v int"
    fetched = spark.createDataFrame([(1, "supply:5", 1), (1, "preorder:9", 2), (1, "supply:77", 3)], keyed)
    kept, details, goods, packages = supplies.assemble_supplies(listed, fetched, fetched, fetched, ["position"])
    assert sorted(r.phone for r in kept.collect()) == ["first", "pre"]
    assert sorted(r.v for r in details.collect()) == [1, 2] == sorted(r.v for r in goods.collect())
    assert [r.v for r in packages.collect()] == [1]  # a preorder has none


def test_feed_filters(spark):
    orders = spark.createDataFrame(
        [("2026-05-01T02:59:59",), ("2026-05-01T03:00:00",)], "lastChangeDate string"
    )
    since = F.lit("2026-05-01 00:00:00").cast("timestamp")
    assert landed.changed_since(orders, since).count() == 1
    listed = spark.createDataFrame(
        [("1", "2026-05-01T00:00:00"), ("6", "2026-05-02T23:00:00"), ("7", "2026-05-01"), ("1", "2026-05-03"), (None, "2026-05-01")],
        "statusID string, createDate string",
    )
    days = [F.lit(d).cast("date") for d in ("2026-05-01", "2026-05-02")]
    assert [r.statusID for r in landed.supplies_created(listed, *days).collect()] == ["1", "6"]
