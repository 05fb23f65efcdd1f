"""Landed feed rows to typed table rows. Native column expressions throughout.

Every function takes rows that carry ``account_id`` and the feed's own fields and
returns the table's columns; columns listed in ``keep`` (arrival order, page
numbers) pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens import schemas
from marketlens.functions.dates import feed_instant
from marketlens.functions.values import (
    NO_KEY,
    blank_to_null,
    first_filled,
    to_decimal,
    to_int,
    to_long,
)
from marketlens.schemas import Feed, decimal_of


def typed(column: Column, kind: str) -> Column:
    size = decimal_of(kind)
    if size:
        return to_decimal(column, *size)
    converters = {
        "instant": feed_instant,
        "strict_instant": lambda c: feed_instant(c, blank_is_null=False),
        "loose_long": to_long,
        "loose_int": to_int,
    }
    return converters.get(kind, lambda c: c)(column)


def _columns(feed: Feed, prefix: str = "", skip: tuple[str, ...] = ()) -> list[Column]:
    return [
        typed(F.col(prefix + name), kind).alias(column)
        for name, column, kind in feed.fields()
        if name not in skip
    ]


# What the landing job adds to an object is no part of it.
_LANDING = ("account_id", "page", "position", "supply_key")
_OBJECT = "map<string,variant>"


def _payload(fields: Column, instants: Column | None = None) -> Column:
    """The fields of a source object as JSON text: declared or not, with their own types and
    nulls, but for those that have ``instants``."""
    if instants is not None:
        fields = F.map_zip_with(fields, instants, lambda _, value, instant: F.coalesce(instant, value))
    return F.to_json(fields).alias("raw_payload")


def _instants(source: Column, feed: Feed) -> Column | None:
    """The texts of date fields of a variant that is an object, as instants by name. Each text
    is read once; fields without one, or with a blank one, are left out."""
    texts = [_text_of(source, name) for name, _, kind in feed.fields() if kind.endswith("instant")]
    if not texts:
        return None

    def shown(entry: Column) -> Column:
        instant = F.date_format(feed_instant(entry["text"]), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
        return F.struct(entry["name"], instant.cast("variant"))

    filled = F.filter(F.array(*texts), lambda entry: entry["text"] != "")
    return F.map_from_entries(F.transform(filled, shown))


def _text_of(source: Column, name: str) -> Column:
    """A field of an object and its value, if that is a text."""
    is_text = F.schema_of_variant(F.try_variant_get(source, f"$.{name}", "variant")) == "STRING"
    text = F.when(is_text, F.try_variant_get(source, f"$.{name}", "string"))
    return F.struct(F.lit(name).alias("name"), text.alias("text"))


def _fields(source: Column) -> Column:
    """The fields of a variant that is an object, by name."""
    return F.try_variant_get(source, "$", _OBJECT)


def _without(fields: Column, *names: str) -> Column:
    return F.map_filter(fields, lambda name, _: ~name.isin(*names))


def _begun(payload: Column, name: str) -> Column:
    """The text of an object up to the value of one more field, ``name``."""
    more = F.when(payload == "{}", F.lit("")).otherwise(F.lit(","))
    return F.concat(F.left(payload, F.length(payload) - 1), more, F.lit(f'"{name}":'))


def _raw(rows: DataFrame, source: str, feed: Feed, prefix: str = "", dated: bool = True) -> Column:
    """The source object as JSON text: the variant in column ``source`` where rows were
    landed with it, else what the declared fields hold."""
    if source in rows.columns:
        instants = _instants(F.col(source), feed) if dated else None
        return _payload(_without(_fields(F.col(source)), *_LANDING), instants)
    return F.to_json(F.struct(*_declared(feed, prefix))).alias("raw_payload")


def _declared(feed: Feed, prefix: str = "") -> list[Column]:
    """The declared fields, as they show in the text of an object."""
    parts = []
    for name, _, kind in feed.fields():
        value = F.col(prefix + name)
        parts.append((typed(value, kind) if kind.endswith("instant") else value).alias(name))
    return parts + [F.col(prefix + nested.name).alias(nested.name) for nested in feed.nested]


def _elements(source: str, path: str) -> Column:
    """The elements of an array in a variant, as variants."""
    return F.try_variant_get(source, path, "array<variant>")


def with_sources(payloads: DataFrame) -> DataFrame:
    """Payloads landed whole, with the source objects of their pieces beside them."""
    if "_raw" not in payloads.columns:
        return payloads
    return payloads.withColumns(
        {
            "supply_raw": F.try_variant_get("_raw", "$.supply", "variant"),
            "details_raw": F.try_variant_get("_raw", "$.details", "variant"),
            "goods_raw": _elements("_raw", "$.goods"),
            "packages_raw": _elements("_raw", "$.packages"),
        }
    )


def _stamp(now: Column | None) -> Column:
    return (F.current_timestamp() if now is None else now).alias("updated_at")


# ------------------------------------------------------------ record keys


def order_key() -> Column:
    return first_filled(F.col("srid"), F.col("gNumber"), F.col("sticker"))


def sale_key() -> Column:
    return first_filled(F.col("saleID"), F.col("srid"), F.col("gNumber"), F.col("sticker"))


def settlement_key() -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NO_KEY)) for c in ("reportId", "rrdId")]
    return F.concat_ws(":", *parts)


def _is_filled(column: Column) -> Column:
    return blank_to_null(column).isNotNull()


# ------------------------------------------------------------ flat feeds


def normalize_orders(rows: DataFrame, keep=(), now: Column | None = None) -> DataFrame:
    return rows.select(
        "account_id", order_key().alias("record_key"), *_columns(schemas.ORDERS), _stamp(now), *keep
    )


def normalize_sales(rows: DataFrame, keep=(), now: Column | None = None) -> DataFrame:
    return rows.select(
        "account_id", sale_key().alias("record_key"), *_columns(schemas.SALES), _stamp(now), *keep
    )


def normalize_settlement(rows: DataFrame, keep=(), now: Column | None = None) -> DataFrame:
    return rows.select(
        "account_id",
        *_columns(schemas.SETTLEMENT),
        _raw(rows, "_raw", schemas.SETTLEMENT),
        _stamp(now),
        *keep,
    )


def normalize_stock(rows: DataFrame, keep=(), now: Column | None = None) -> DataFrame:
    """One row per warehouse of each article; no warehouses, no row.

    ``warehouse_position`` is added for arrival order within a feed row.
    """
    moment = F.current_timestamp() if now is None else now
    if "_raw" in rows.columns:
        rows = _with_stock_texts(rows)
        own = F.coalesce(F.get("_own", F.col("warehouse_position")), F.lit("null"))
        payload = F.concat("_shared", own, F.lit("}"))
    else:
        payload = F.to_json(F.struct(*_declared(schemas.STOCK), "warehouse"))
    stocked = rows.select("*", F.posexplode("warehouses").alias("warehouse_position", "warehouse"))
    return stocked.select(
        "account_id",
        moment.alias("snapshot_at"),
        *_columns(schemas.STOCK),
        F.coalesce("warehouse.warehouseName", F.lit("")).alias("warehouse_name"),
        F.coalesce("warehouse.quantity", F.lit(0)).alias("quantity"),
        payload.alias("raw_payload"),
        _stamp(now),
        *keep,
        "warehouse_position",
    )


def _with_stock_texts(rows: DataFrame) -> DataFrame:
    """Adds ``_shared``, the text of a feed row's payloads up to their own warehouse, and
    ``_own``, the texts of its warehouses, so that each is made once a feed row. What a
    step reads more than once is a column of the step before."""
    left_out = (*_LANDING, "warehouse")
    fields = F.col("_fields")
    # Rows without these names, which is soon seen, are not filtered field by field.
    holds = F.arrays_overlap(F.map_keys(fields), F.array(*[F.lit(name) for name in left_out]))
    shown = F.when(holds, _without(fields, *left_out)).otherwise(fields)
    elements = _elements("_raw", "$.warehouses")
    # Objects are written as maps: the names in a variant cost more to write.
    objects = F.try_variant_get("_raw", "$.warehouses", f"array<{_OBJECT}>")
    own = F.transform(objects, lambda entry, n: F.coalesce(F.to_json(entry), F.to_json(F.get(elements, n))))
    return (
        rows.withColumn("_fields", _fields(F.col("_raw")))
        .withColumns({"_payload": _payload(shown), "_own": own})
        .withColumn("_shared", _begun(F.col("_payload"), "warehouse"))
    )


# ------------------------------------------------------------ supplies


def identify_supplies(rows: DataFrame, prefix: str = "") -> DataFrame:
    """Add supply_key, supply_id, preorder_id; rows with neither id are dropped."""
    supply_id, preorder_id = to_long(F.col(prefix + "supplyID")), to_long(F.col(prefix + "preorderID"))
    key = F.coalesce(
        F.concat(F.lit("supply:"), supply_id.cast("string")),
        F.concat(F.lit("preorder:"), preorder_id.cast("string")),
    )
    return rows.select(
        "*",
        key.alias("supply_key"),
        supply_id.alias("supply_id"),
        preorder_id.alias("preorder_id"),
    ).filter(F.col("supply_key").isNotNull())


IDENTITY = ("account_id", "supply_key", "supply_id", "preorder_id")


def normalize_supplies(payloads: DataFrame, keep=(), now: Column | None = None) -> DataFrame:
    """Supply headers from identified payloads (``supply`` struct)."""
    return payloads.select(
        *IDENTITY,
        *_columns(schemas.SUPPLY, "supply.", skip=("supplyID", "preorderID")),
        _raw(payloads, "supply_raw", schemas.SUPPLY, "supply."),
        _stamp(now),
        *keep,
    )


def normalize_supply_details(payloads: DataFrame, keep=(), now: Column | None = None) -> DataFrame:
    """Supply details; an absent or empty details object gives no row."""
    return payloads.filter(_has_detail()).select(
        *IDENTITY,
        *_columns(schemas.SUPPLY_DETAIL, "details."),
        _raw(payloads, "details_raw", schemas.SUPPLY_DETAIL, "details.", dated=False),
        _stamp(now),
        *keep,
    )


def normalize_supply_goods(payloads: DataFrame, keep=(), now: Column | None = None) -> DataFrame:
    goods = payloads.select("*", F.posexplode("goods").alias("_place", "good")).filter(F.col("good").isNotNull())
    goods = _with_element(goods, "goods_raw", "_place", "good_raw")
    return goods.select(
        *IDENTITY,
        *_columns(schemas.SUPPLY_GOOD, "good."),
        _raw(goods, "good_raw", schemas.SUPPLY_GOOD, "good."),
        _stamp(now),
        *keep,
    )


def _with_element(rows: DataFrame, source: str, place: str, name: str) -> DataFrame:
    """Adds the element of ``source`` at ``place``, where there are source objects."""
    return rows.withColumn(name, F.get(source, F.col(place))) if source in rows.columns else rows


def _has_detail() -> Column:
    """The details object is there and not empty."""
    return F.coalesce(F.to_json("details"), F.lit("{}")) != "{}"


def _has_code(package: Column) -> Column:
    return _is_filled(package.getField("packageCode"))


def _has_barcode(item: Column) -> Column:
    return _is_filled(item.getField("barcode"))


def records_in(payload_rows: DataFrame) -> DataFrame:
    """Add ``records``: how many table rows of all five kinds a payload gives."""
    goods = F.filter("goods", lambda good: good.isNotNull())
    packages = F.coalesce(F.filter("packages", _has_code), F.array())
    items = F.transform(
        packages, lambda p: F.coalesce(F.size(F.filter(p.getField("barcodes"), _has_barcode)), F.lit(0))
    )
    return payload_rows.withColumn(
        "records",
        1
        + F.when(_has_detail(), 1).otherwise(0)
        + F.coalesce(F.size(goods), F.lit(0))
        + F.size(packages)
        + F.aggregate(items, F.lit(0), lambda total, n: total + n),
    )


def _packages(payloads: DataFrame) -> DataFrame:
    packed = payloads.select("*", F.posexplode("packages").alias("package_position", "package"))
    packed = _with_element(packed, "packages_raw", "package_position", "package_raw")
    return packed.filter(_has_code(F.col("package")))


def normalize_supply_packages(payloads: DataFrame, keep=(), now: Column | None = None) -> DataFrame:
    """Boxes of a supply; a box without a code is dropped."""
    packages = _packages(payloads)
    return packages.select(
        "account_id",
        "supply_key",
        "supply_id",
        F.col("package.packageCode").alias("package_code"),
        to_int(F.col("package.quantity")).alias("quantity"),
        _raw(packages, "package_raw", schemas.SUPPLY_PACKAGE, "package."),
        _stamp(now),
        *keep,
        "package_position",
    )


def normalize_package_barcodes(
    payloads: DataFrame, keep=(), now: Column | None = None
) -> DataFrame:
    """Items of a box; an item without a barcode, or in a dropped box, is dropped."""
    items = _packages(payloads).select(
        "*", F.posexplode("package.barcodes").alias("barcode_position", "item")
    )
    if "package_raw" in items.columns:
        items = items.withColumn("item_raw", F.get(_elements("package_raw", "$.barcodes"), F.col("barcode_position")))
    return items.filter(_has_barcode(F.col("item"))).select(
        "account_id",
        "supply_key",
        "supply_id",
        F.col("package.packageCode").alias("package_code"),
        F.col("item.barcode").alias("barcode"),
        to_int(F.col("item.quantity")).alias("quantity"),
        _raw(items, "item_raw", schemas.PACKAGE_BARCODE, "item."),
        _stamp(now),
        *keep,
        "package_position",
        "barcode_position",
    )
