"""Silver dimensions: customers (with their country) and products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockbook.functions.audit import RunInfo, with_audit
from stockbook.functions.nulls import strict_greatest
from stockbook.operators.incremental import above_any_mark, above_mark, high_water_mark, merge_upsert
from stockbook.operators.versions import newest_row

CUSTOMER_KEYS = ("customer_id",)
CUSTOMER_UPDATE_COLS = ("country_id", "company_name", "address", "city", "region_description", "country",
                        "cluster", "customer_update_date", "country_update_date", "last_update",
                        "update_ts", "updated_by")
PRODUCT_KEYS = ("product_id",)
PRODUCT_UPDATE_COLS = ("product_name", "brand_name", "sub_brand_name", "category_name", "update_date",
                       "update_ts", "updated_by")
PRODUCT_ATTRS = ["product_name", "brand_name", "sub_brand_name", "category_name"]


def customer_rows(customers: DataFrame, countries: DataFrame) -> DataFrame:
    """Customers inner-joined to their country, both clocks and the later one.

    Not deduplicated: a customer delivered twice stays twice. ``last_update``
    is NULL when either clock is NULL. The join is a plain equi-join: the
    country side is tiny and AQE broadcasts it once its size is known.
    """
    c = customers.select("customer_id", "country_id", "company_name", "address", "city",
                         F.col("update_date").alias("customer_update_date"))
    co = countries.select("country_id", "region_description", "country", "cluster",
                          F.col("update_date").alias("country_update_date"))
    return c.join(co, "country_id").select(
        "customer_id", "country_id", "company_name", "address", "city",
        "region_description", "country", "cluster", "customer_update_date", "country_update_date",
        strict_greatest("customer_update_date", "country_update_date").alias("last_update"))


def dim_customers(customers: DataFrame, countries: DataFrame, run: RunInfo = RunInfo()) -> DataFrame:
    """First load / full refresh of the customer dimension."""
    return with_audit(customer_rows(customers, countries), run, first_load=True)


def dim_customers_incremental(customers: DataFrame, countries: DataFrame, target: DataFrame,
                              run: RunInfo = RunInfo(), on_duplicate: str = "error") -> DataFrame:
    """Rows newer than either clock's mark, merged on ``customer_id``.

    The two marks are global (one per clock), not per customer.
    """
    rows = customer_rows(customers, countries)
    changed = above_any_mark(rows, [
        ("customer_update_date", high_water_mark(target, "customer_update_date")),
        ("country_update_date", high_water_mark(target, "country_update_date")),
    ])
    src = with_audit(changed, run, first_load=False)
    return merge_upsert(target, src, CUSTOMER_KEYS, CUSTOMER_UPDATE_COLS, on_duplicate=on_duplicate,
                        combine=_latest_customer if on_duplicate == "combine" else None)


def _latest_customer(src: DataFrame) -> DataFrame:
    return newest_row(src, CUSTOMER_KEYS, "last_update", tie_break=["country_id", "company_name"])


def product_rows(products: DataFrame) -> DataFrame:
    return products.select("product_id", *PRODUCT_ATTRS, "update_date")


def _dedupe_products(rows: DataFrame) -> DataFrame:
    """Newest delivery per product; an undated delivery ranks first.

    The remaining attributes break ties so repeated runs agree.
    """
    return newest_row(rows, PRODUCT_KEYS, "update_date", tie_break=PRODUCT_ATTRS)


def dim_products(products: DataFrame, run: RunInfo = RunInfo()) -> DataFrame:
    return with_audit(_dedupe_products(product_rows(products)), run, first_load=True)


def dim_products_incremental(products: DataFrame, target: DataFrame, run: RunInfo = RunInfo(),
                             mode: str = "delta") -> DataFrame:
    """Products newer than the target's latest ``update_date``, merged on the key.

    ``delta`` uses the bare maximum, as the source model does: an empty
    target has no maximum, so nothing loads. ``recompute`` falls back to
    1900-01-01, so an empty target is filled.
    """
    fallback = None if mode == "delta" else "1900-01-01"
    changed = above_mark(product_rows(products), "update_date",
                         high_water_mark(target, "update_date", fallback=fallback))
    src = with_audit(_dedupe_products(changed), run, first_load=False)
    return merge_upsert(target, src, PRODUCT_KEYS, PRODUCT_UPDATE_COLS, on_duplicate="error")
