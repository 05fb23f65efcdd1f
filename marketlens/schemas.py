"""Declared schemas: landed feeds (as sent) and tables (as stored).

A feed is described once, by the type each field has in its table. From that
come both the schema the JSON is read with and the projection into the table,
so the two cannot drift apart.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from marketlens.functions.values import snake_case

# How a field of each kind arrives. Money and dates arrive as text (numbers are
# read as their digits), so no precision is lost before the typed cast.
_LANDED = {
    "instant": T.StringType(),
    "strict_instant": T.StringType(),
    "loose_long": T.StringType(),
    "loose_int": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "text": T.StringType(),
}

# How it is stored; decimal kinds are written "money18_6" and so on.
_STORED = {
    "instant": T.TimestampType(),
    "strict_instant": T.TimestampType(),
    "loose_long": T.LongType(),
    "loose_int": T.IntegerType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "text": T.StringType(),
}


def decimal_of(kind: str) -> tuple[int, int] | None:
    """Precision and scale of a ``moneyP_S`` kind, else None."""
    if not kind.startswith("money"):
        return None
    precision, scale = kind.removeprefix("money").split("_")
    return int(precision), int(scale)


@dataclass(frozen=True)
class Feed:
    """Fields of one feed object: ``kinds`` maps a kind to its field names."""

    kinds: dict[str, str]
    renamed: dict[str, str] = field(default_factory=dict)
    nested: tuple[T.StructField, ...] = ()

    def fields(self) -> list[tuple[str, str, str]]:
        """(field name, column name, kind) of every plain field."""
        return [
            (name, self.renamed.get(name, snake_case(name)), kind)
            for kind, names in self.kinds.items()
            for name in names.split()
        ]

    def landed(self) -> T.StructType:
        plain = [T.StructField(n, _LANDED.get(k, T.StringType())) for n, _, k in self.fields()]
        return T.StructType(plain + list(self.nested))

    def stored(self) -> list[T.StructField]:
        columns = []
        for _, column, kind in self.fields():
            size = decimal_of(kind)
            columns.append(T.StructField(column, T.DecimalType(*size) if size else _STORED[kind]))
        return columns


# ---------------------------------------------------------------- feeds
# Field names below are fixed values: they are the feeds' own.

_MOVEMENT_TEXTS = (
    "warehouseName warehouseType countryName oblastOkrugName regionName supplierArticle "
    "barcode category subject brand techSize sticker gNumber srid"
)

ORDERS = Feed(
    kinds={
        "strict_instant": "date lastChangeDate cancelDate",
        "long": "nmId incomeID",
        "boolean": "isSupply isRealization isCancel",
        "money18_2": "totalPrice finishedPrice priceWithDisc",
        "money10_2": "discountPercent spp",
        "text": _MOVEMENT_TEXTS,
    },
    renamed={"date": "order_date"},
)

SALES = Feed(
    kinds={
        "strict_instant": "date lastChangeDate",
        "long": "nmId incomeID",
        "boolean": "isSupply isRealization",
        "money18_2": "totalPrice paymentSaleAmount forPay finishedPrice priceWithDisc",
        "money10_2": "discountPercent spp",
        "text": "saleID " + _MOVEMENT_TEXTS,
    },
    renamed={"date": "sale_date"},
)

SETTLEMENT = Feed(
    kinds={
        "long": "reportId rrdId giId nmId shkId ppvzOfficeId orderId sellerPromoId loyaltyId",
        "int": "reportType quantity isKgvpV2",
        "boolean": "srvDbs isB2b",
        "strict_instant": "dateFrom",
        "instant": "dateTo createDate fixTariffDateFrom fixTariffDateTo orderDt saleDt rrDate",
        "money18_6": (
            "dlvPrc retailPrice retailAmount retailPriceWithDisc salePercent commissionPercent "
            "productDiscountForReport sellerPromo sellerPromoDiscount spp kvwBase kvw supRatingUp "
            "ppvzSalesCommission ppvzReward forPay acquiringFee acquiringPercent vw vwNds agencyVat "
            "deliveryAmount returnAmount deliveryService penalty additionalPayment "
            "rebillLogisticCost paidStorage paidAcceptance deduction "
            "installmentCofinancingAmount wibesDiscountPercent cashbackAmount cashbackDiscount "
            "cashbackCommissionChange loyaltyDiscount salePricePromocodeDiscountPrc "
            "salePriceAffiliatedDiscountPrc salePriceWholesaleDiscountPrc"
        ),
        "text": (
            "currency subjectName brandName vendorCode title techSize sku docTypeName officeName "
            "sellerOperName giBoxTypeName paymentProcessing acquiringBank ppvzOfficeName "
            "ppvzSupplierName ppvzSupplierInn declarationNumber bonusTypeName stickerId country "
            "rebillLogisticOrg kiz trbxId paymentSchedule deliveryMethod uuidPromocode "
            "articleSubstitution orderUid srid"
        ),
    }
)

REPORT_LIST = Feed(kinds={"long": "reportId", "instant": "dateFrom dateTo createDate"})

WAREHOUSE = T.StructType(
    [T.StructField("warehouseName", T.StringType()), T.StructField("quantity", T.IntegerType())]
)
STOCK = Feed(
    kinds={
        "text": "brand subjectName vendorCode barcode techSize",
        "long": "nmId",
        "money18_6": "volume",
    },
    nested=(T.StructField("warehouses", T.ArrayType(WAREHOUSE)),),
)

SUPPLY = Feed(
    kinds={
        "loose_long": "supplyID preorderID",
        "loose_int": "statusID boxTypeID",
        "instant": "createDate supplyDate factDate updatedDate",
        "boolean": "isBoxOnPallet",
        "text": "phone",
    }
)
SUPPLY_DETAIL = Feed(
    kinds={
        "loose_long": "warehouseID actualWarehouseID transitWarehouseID",
        "loose_int": (
            "statusID boxTypeID quantity readyForSaleQuantity acceptedQuantity "
            "unloadingQuantity depersonalizedQuantity"
        ),
        "instant": "createDate supplyDate factDate updatedDate",
        "money18_6": "acceptanceCost paidAcceptanceCoefficient",
        "boolean": "isBoxOnPallet",
        "text": (
            "phone warehouseName actualWarehouseName transitWarehouseName rejectReason "
            "supplierAssignName storageCoef deliveryCoef"
        ),
    }
)
SUPPLY_GOOD = Feed(
    kinds={
        "loose_long": "nmID",
        "loose_int": (
            "supplierBoxAmount quantity readyForSaleQuantity unloadingQuantity acceptedQuantity"
        ),
        "boolean": "needKiz",
        "text": "barcode vendorCode tnved techSize color",
    }
)
PACKAGE_BARCODE = Feed(kinds={"text": "barcode", "loose_int": "quantity"})
SUPPLY_PACKAGE = Feed(
    kinds={"text": "packageCode", "loose_int": "quantity"},
    nested=(T.StructField("barcodes", T.ArrayType(PACKAGE_BARCODE.landed())),),
)
SUPPLY_PAYLOAD = T.StructType(
    [
        T.StructField("supply", SUPPLY.landed()),
        T.StructField("details", SUPPLY_DETAIL.landed()),
        T.StructField("goods", T.ArrayType(SUPPLY_GOOD.landed())),
        T.StructField("packages", T.ArrayType(SUPPLY_PACKAGE.landed())),
    ]
)

# ---------------------------------------------------------------- tables

_ACCOUNT = T.StructField("account_id", T.LongType(), False)
_RECORD = T.StructField("record_key", T.StringType(), False)
_RAW = T.StructField("raw_payload", T.StringType())
_UPDATED = T.StructField("updated_at", T.TimestampType())
_SUPPLY_IDENTITY = [
    T.StructField("supply_key", T.StringType(), False),
    T.StructField("supply_id", T.LongType()),
    T.StructField("preorder_id", T.LongType()),
]


_NAMED = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "money": T.DecimalType(18, 6),
    "price": T.DecimalType(18, 2),
    "share": T.DecimalType(18, 4),
}


def _plain(columns: str) -> T.StructType:
    """``"id bigint, cost money"`` as a schema; needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _NAMED[kind]) for name, kind in pairs])


ORDERS_TABLE = T.StructType([_ACCOUNT, _RECORD, *ORDERS.stored(), _UPDATED])
SALES_TABLE = T.StructType([_ACCOUNT, _RECORD, *SALES.stored(), _UPDATED])
SETTLEMENT_TABLE = T.StructType([_ACCOUNT, *SETTLEMENT.stored(), _RAW, _UPDATED])
STOCK_TABLE = T.StructType(
    [_ACCOUNT, T.StructField("snapshot_at", T.TimestampType()), *STOCK.stored()]
    + [T.StructField("warehouse_name", T.StringType(), False)]
    + [T.StructField("quantity", T.IntegerType(), False), _RAW, _UPDATED]
)
SUPPLY_TABLE = T.StructType(
    [_ACCOUNT, *_SUPPLY_IDENTITY, *SUPPLY.stored()[2:], _RAW, _UPDATED]
)
SUPPLY_DETAIL_TABLE = T.StructType(
    [_ACCOUNT, *_SUPPLY_IDENTITY, *SUPPLY_DETAIL.stored(), _RAW, _UPDATED]
)
SUPPLY_GOOD_TABLE = T.StructType(
    [_ACCOUNT, *_SUPPLY_IDENTITY, *SUPPLY_GOOD.stored(), _RAW, _UPDATED]
)
PACKAGE_TABLE = _plain(
    "account_id bigint, supply_key string, supply_id bigint, package_code string, "
    "quantity int, raw_payload string, updated_at timestamp"
)
PACKAGE_BARCODE_TABLE = _plain(
    "account_id bigint, supply_key string, supply_id bigint, package_code string, "
    "barcode string, quantity int, raw_payload string, updated_at timestamp"
)

ACCOUNTS = _plain(
    "id bigint, account_code string, account_name string, enabled boolean, "
    "token_env_var string, created_at timestamp, updated_at timestamp"
)
FEED_CONFIGS = _plain(
    "id bigint, account_id bigint, api_type string, enabled boolean, schedule_seconds int, "
    "lookback_days int, batch_limit int, revision int, created_at timestamp, updated_at timestamp"
)
FEED_STATE = _plain(
    "account_id bigint, api_type string, cursor_timestamp timestamp, cursor_key string, "
    "last_started_at timestamp, last_finished_at timestamp, last_success_at timestamp, "
    "last_error_at timestamp, last_error_message string, heartbeat_at timestamp, "
    "run_id string, status string"
)
RUN_LEDGER = _plain(
    "id bigint, account_id bigint, api_type string, run_id string, started_at timestamp, "
    "finished_at timestamp, status string, rows_written int, error_message string"
)
RUN_EVENTS = _plain(
    "account_id bigint, api_type string, run_id string, seq bigint, at timestamp, kind string, "
    "rows_written int, cursor_timestamp timestamp, cursor_key string, message string"
)
COST_PRICES = _plain(
    "id bigint, account_id bigint, vendor_code string, cost money, "
    "valid_from timestamp, valid_to timestamp, created_at timestamp, updated_at timestamp"
)
ARTICLE_FACTS = _plain(
    "fact_date date, account_id bigint, account_code string, legal_entity_name string, "
    "nm_id bigint, brand_name string, vendor_code string, title string, tech_size string, "
    "buyout_basis_units bigint, ordered_units bigint, logistics_basis_units bigint, "
    "buyout_units bigint, returned_units bigint, no_final_status_units bigint, "
    "buyout_ratio_sum money, buyout_ratio_avg share, buyout_percent price, "
    "delivery_iterations money, return_iterations money, "
    "logistics_iterations money, logistics_cost_units bigint, "
    "delivery_runs money, return_runs money, logistics_runs money, "
    "logistics_cost_total money, avg_logistics_cost price"
)
# Kept up to date by loads: the least and greatest marking code seen with an identifier
# (null: none any more), and the unit of each line.
IDENTIFIERS = _plain("account_id bigint, match_type string, match_value string, low string, high string")
LINE_UNITS = _plain("account_id bigint, report_id bigint, rrd_id bigint, restored_kiz string, uniq_product_id string")
# Totals of a unit under an article, kept up to date by loads.
ARTICLE_UNITS = T.StructType(
    [
        *_plain(
            "account_id bigint, nm_id bigint, uniq_product_id string, has_order boolean, has_logistics boolean"
        ).fields,
        *(T.StructField(name, T.DecimalType(28, 6)) for name in ("deliveries", "returns", "service")),
        T.StructField("has_sale", T.BooleanType()),
        T.StructField("status", _plain("at timestamp, rrd_id bigint, report_id bigint, operation string")),
    ]
)
PRICE_SOURCES = _plain(
    "id bigint, source_code string, source_name string, url string, source_type string, "
    "enabled boolean, schedule_seconds int, extraction_config string, revision int, "
    "created_at timestamp, updated_at timestamp"
)
PRICE_SOURCE_STATE = _plain(
    "source_id bigint, last_started_at timestamp, last_finished_at timestamp, "
    "last_success_at timestamp, last_error_at timestamp, last_error_message string, "
    "heartbeat_at timestamp, run_id string, status string"
)
PRICE_SOURCE_RUNS = _plain(
    "id bigint, source_id bigint, run_id string, started_at timestamp, finished_at timestamp, "
    "status string, rows_written int, error_message string"
)
PRICE_SNAPSHOTS = _plain(
    "id bigint, source_id bigint, source_code string, observed_at timestamp, "
    "requested_url string, final_url string, page_title string, item_key string, "
    "item_name string, price price, wallet_price price, "
    "old_price price, currency string, availability string, html_sha256 string, "
    "raw_payload string, created_at timestamp"
)

TABLES = {
    "accounts": ACCOUNTS,
    "feed_configs": FEED_CONFIGS,
    "feed_state": FEED_STATE,
    "run_ledger": RUN_LEDGER,
    "run_events": RUN_EVENTS,
    "cost_prices": COST_PRICES,
    "orders": ORDERS_TABLE,
    "sales": SALES_TABLE,
    "settlement_daily": SETTLEMENT_TABLE,
    "settlement_weekly": SETTLEMENT_TABLE,
    "stock": STOCK_TABLE,
    "supplies": SUPPLY_TABLE,
    "supply_details": SUPPLY_DETAIL_TABLE,
    "supply_goods": SUPPLY_GOOD_TABLE,
    "supply_packages": PACKAGE_TABLE,
    "supply_package_barcodes": PACKAGE_BARCODE_TABLE,
    "article_facts": ARTICLE_FACTS,
    "identifiers": IDENTIFIERS,
    "line_units": LINE_UNITS,
    "article_units": ARTICLE_UNITS,
    "price_sources": PRICE_SOURCES,
    "price_source_state": PRICE_SOURCE_STATE,
    "price_source_runs": PRICE_SOURCE_RUNS,
    "price_snapshots": PRICE_SNAPSHOTS,
}

# Natural key of each upserted table.
KEYS = {
    "orders": ["account_id", "record_key"],
    "sales": ["account_id", "record_key"],
    "settlement_daily": ["account_id", "report_id", "rrd_id"],
    "settlement_weekly": ["account_id", "report_id", "rrd_id"],
    "stock": ["account_id", "nm_id", "barcode", "tech_size", "warehouse_name"],
    "supplies": ["account_id", "supply_key"],
    "supply_details": ["account_id", "supply_key"],
    "supply_packages": ["account_id", "supply_key", "package_code"],
    "supply_package_barcodes": ["account_id", "supply_key", "package_code", "barcode"],
    "identifiers": ["account_id", "match_type", "match_value"],
    "line_units": ["account_id", "report_id", "rrd_id"],
    "cost_prices": ["account_id", "vendor_code", "valid_from"],
    "article_facts": ["fact_date", "account_id", "nm_id"],
    "feed_configs": ["account_id", "api_type"],
    "feed_state": ["account_id", "api_type"],
    "accounts": ["account_code"],
}

# Tables that loads add to, and the key by which a load replaces earlier rows: a row's
# own key where it is upserted, else what owns the rows.
LOADED = {
    **{
        name: KEYS[name]
        for name in (
            "orders", "sales", "settlement_daily", "settlement_weekly", "supplies", "supply_details",
            "identifiers", "line_units", "feed_state",
        )
    },
    "article_units": ["account_id", "uniq_product_id"],
    "stock": ["account_id"],
    "supply_goods": ["account_id", "supply_key"],
    "supply_packages": ["account_id", "supply_key"],
    "supply_package_barcodes": ["account_id", "supply_key"],
}

# The feed types.
API_TYPES = (
    "orders",
    "sales",
    "finance_sales_report_details",
    "finance_sales_report_weekly",
    "warehouse_remains",
    "fbw_supplies",
)
