"""Bronze table schemas.

The source system names columns only by use, so types are fixed here.
Clocks are zone-less timestamps; business dates are DATEs.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


_TS = TimestampNTZType()
_D = DateType()
_DBL = DoubleType()

BRONZE_SCHEMAS: dict[str, StructType] = {
    "customers": _schema(
        ("customer_id", LongType()), ("country_id", IntegerType()), ("company_name", StringType()),
        ("address", StringType()), ("city", StringType()), ("update_date", _TS)),
    "countries": _schema(
        ("country_id", IntegerType()), ("region_description", StringType()), ("country", StringType()),
        ("cluster", StringType()), ("update_date", _TS)),
    "products": _schema(
        ("product_id", LongType()), ("product_name", StringType()), ("brand_name", StringType()),
        ("sub_brand_name", StringType()), ("category_name", StringType()), ("update_date", _TS)),
    "orders": _schema(
        ("order_id", LongType()), ("customer_id", LongType()), ("order_date", _D),
        ("required_date", _D), ("shipped_date", _D), ("update_date", _TS)),
    "order_details": _schema(
        ("order_id", LongType()), ("product_id", LongType()), ("unit_price", _DBL),
        ("quantity", _DBL), ("discount", _DBL), ("update_date", _TS)),
    "forecast_details": _schema(
        ("product_id", LongType()), ("country_id", IntegerType()), ("update_date", _TS),
        ("forecast_date", _D), ("forecast_snapshot", _D), ("quantity", _DBL),
        ("whrs_sell_in_quantity", _DBL), ("whrs_open_quantity", _DBL), ("whrs_end_quantity", _DBL),
        ("pos_sell_out_quantity", _DBL), ("pos_open_quantity", _DBL), ("pos_end_quantity", _DBL),
        ("unit_price", _DBL)),
    "inventory_pos_history_details": _schema(
        ("product_id", LongType()), ("country_id", IntegerType()), ("update_date", _TS),
        ("transaction_date", _D), ("pos_sell_out_quantity", _DBL), ("pos_open_quantity", _DBL),
        ("pos_end_quantity", _DBL), ("unit_price", _DBL)),
    "inventory_wholesaler_history_details": _schema(
        ("customer_id", LongType()), ("product_id", LongType()), ("transaction_date", _D),
        ("update_date", _TS), ("unit_price", _DBL), ("whrs_sell_in_quantity", _DBL),
        ("whrs_open_quantity", _DBL), ("whrs_end_quantity", _DBL)),
}

BRONZE_TABLES = list(BRONZE_SCHEMAS)
