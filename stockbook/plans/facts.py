"""Silver facts: sales, forecast, pharmacy stock (POS), wholesaler stock.

Every fact sums the newest delivered version of its version key in one pass
(see ``operators.versions``) and rolls it up to months.
Versioning grains differ on purpose, as in the source models:
sales per order line, POS per day, wholesale per day (no customer in the
key), forecast per month and snapshot month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockbook.functions.dates import month_floor
from stockbook.functions.exact import as_double, round_money, weighted_price
from stockbook.functions.nulls import strict_greatest
from stockbook.operators.incremental import high_water_mark
from stockbook.plans.model import IncrementalModel


def _measures(quantities: list[str]) -> dict[str, Column]:
    """q0, q1, ... the quantities and a0, a1, ... a row's amounts."""
    return ({f"q{i}": F.col(c).cast("double") for i, c in enumerate(quantities)}
            | {f"a{i}": F.col(c).cast("double") * F.col("unit_price").cast("double") for i, c in enumerate(quantities)})


# ============================================================ sales

class FactSales(IncrementalModel):
    name = "s_f_sales"
    keys = ("country_id", "product_id", "shipped_date")
    update_cols = ("quantity", "discount", "amount", "unit_price", "order_details_update_date",
                   "order_update_date", "update_ts", "updated_by")
    partition_col = "shipped_date"
    version_key = ("order_id", "product_id", "country_id", "shipped_date")
    clocks = ("order_details_update_date", "order_update_date")
    dealt_by = ("product_id", "country_id")

    def rows(self, orders: DataFrame, order_details: DataFrame, customers: DataFrame) -> DataFrame:
        """Order lines with the customer's country and both clocks.

        Orders meet the customer dimension first (the smaller join), then the
        lines; both are equi-joins that AQE may turn into broadcasts.
        """
        o = orders.select(
            "order_id", "customer_id",
            month_floor("shipped_date").alias("shipped_date"),
            F.col("update_date").cast("timestamp_ntz").alias("order_update_date"))
        od = order_details.select(
            "order_id", "product_id",
            F.col("unit_price").cast("double").alias("unit_price"),
            F.col("quantity").cast("double").alias("quantity"),
            F.col("discount").cast("double").alias("discount"),
            F.col("update_date").cast("timestamp_ntz").alias("order_details_update_date"))
        c = customers.select("customer_id", "country_id")
        return (o.join(c, "customer_id").join(od, "order_id")
                .select("order_id", "country_id", "product_id", "shipped_date", "unit_price", "quantity",
                        "discount", "order_details_update_date", "order_update_date"))

    def measures(self) -> dict[str, Column]:
        return {"q": F.col("quantity"), "d": F.col("discount"), "a": F.col("quantity") * F.col("unit_price")}

    def delivery_clock(self) -> Column:
        return strict_greatest(*self.clocks)

    def rollup(self, latest: DataFrame, per_key: bool = False) -> DataFrame:
        # newest version per order LINE (order, product, country, ship month),
        # each clock at its own maximum; then country x product x month
        if per_key:
            group = list(self.keys)
            clocks = [F.max(c).alias(c) for c in self.clocks]
        else:
            group = list(self.keys) + list(self.clocks)
            clocks = []
        g = latest.groupBy(*group).agg(
            *clocks,
            *[F.sum(c).alias(c) for c in ("q", "d", "a")])
        return g.select(
            "country_id", "product_id", "shipped_date",
            as_double("q").alias("quantity"),
            as_double("d").alias("discount"),
            round_money("a").alias("amount"),
            weighted_price("a", "q").alias("unit_price"),
            F.col("order_details_update_date").cast("date").alias("order_details_update_date"),
            F.col("order_update_date").cast("date").alias("order_update_date"))

    def mark(self, target: DataFrame) -> Column:
        """The later of both clocks; lines are held against it after the joins."""
        return high_water_mark(target, strict_greatest(
            F.col("order_details_update_date").cast("timestamp_ntz"),
            F.col("order_update_date").cast("timestamp_ntz")))


# ============================================================ forecast

FORECAST_QTY = ["quantity", "whrs_sell_in_quantity", "whrs_open_quantity", "whrs_end_quantity",
                "pos_sell_out_quantity", "pos_open_quantity", "pos_end_quantity"]
FORECAST_AMT = ["amount", "whrs_sell_in_amount", "whrs_open_amount", "whrs_end_amount",
                "pos_sell_out_amount", "pos_open_amount", "pos_end_amount"]


class FactForecast(IncrementalModel):
    name = "s_f_forecast"
    keys = ("product_id", "country_id", "forecast_date", "forecast_snapshot")
    update_cols = ("forecast_update_date", *FORECAST_QTY, *FORECAST_AMT, "unit_price", "update_ts", "updated_by")
    partition_col = "forecast_snapshot"
    version_key = keys
    rolls_up = False
    clocks = ("update_date",)
    dealt_by = ("product_id", "country_id")

    def rows(self, forecast_details: DataFrame) -> DataFrame:
        """Forecast lines with both dates floored to the month up front.

        Versioning and grouping then share the same columns, which keeps the
        plan at one grouping key instead of repeating ``trunc`` in two places.
        """
        return forecast_details.select(
            "product_id", "country_id",
            F.col("update_date").cast("timestamp_ntz").alias("update_date"),
            month_floor("forecast_date").alias("forecast_date"),
            month_floor("forecast_snapshot").alias("forecast_snapshot"),
            *FORECAST_QTY, "unit_price")

    def measures(self) -> dict[str, Column]:
        return _measures(FORECAST_QTY)

    def delivery_clock(self) -> Column:
        return F.col("update_date")

    def rollup(self, latest: DataFrame, per_key: bool = False) -> DataFrame:
        # the version key is the table's key: one row a key is left
        g = latest.withColumnRenamed("update_date", "forecast_update_date")
        return g.select(
            "product_id", "country_id", "forecast_date", "forecast_snapshot", "forecast_update_date",
            *[as_double(f"q{i}").alias(c) for i, c in enumerate(FORECAST_QTY)],
            *[round_money(f"a{i}").alias(c) for i, c in enumerate(FORECAST_AMT)],
            weighted_price("a0", "q0").alias("unit_price"))

    def mark(self, target: DataFrame) -> Column:
        return high_water_mark(target, "forecast_update_date")


# ============================================================ POS

POS_QTY = ["pos_sell_out_quantity", "pos_open_quantity", "pos_end_quantity"]
POS_AMT = ["pos_sell_out_amount", "pos_open_amount", "pos_end_amount"]


class FactPos(IncrementalModel):
    name = "s_f_pos"
    keys = ("product_id", "country_id", "transaction_date")
    update_cols = (*POS_QTY, *POS_AMT, "unit_price", "pos_update_date", "update_ts", "updated_by")
    partition_col = "transaction_date"
    version_key = keys  # by day here, by month in the table
    by_day = True
    clocks = ("update_date",)
    dealt_by = ("product_id", "country_id")

    def rows(self, pos: DataFrame) -> DataFrame:
        return pos.select(
            "product_id", "country_id",
            F.col("update_date").cast("timestamp_ntz").alias("update_date"),
            F.col("transaction_date").cast("date").alias("transaction_date"),
            *[F.col(c).cast("double").alias(c) for c in POS_QTY],
            F.col("unit_price").cast("double").alias("unit_price"))

    def key_exprs(self) -> dict[str, Column]:
        return {"product_id": F.col("product_id"), "country_id": F.col("country_id"),
                "transaction_date": month_floor("transaction_date")}

    def measures(self) -> dict[str, Column]:
        return _measures(POS_QTY)

    def delivery_clock(self) -> Column:
        return F.col("update_date")

    def rollup(self, latest: DataFrame, per_key: bool = False) -> DataFrame:
        # newest version per product, country and DAY, then months
        g = (latest.groupBy("product_id", "country_id", month_floor("transaction_date").alias("transaction_date"))
             .agg(F.max("update_date").alias("pos_update_date"),
                  *[F.sum(c).alias(c) for c in _measures(POS_QTY)]))
        return g.select(
            "product_id", "country_id", "transaction_date",
            *[as_double(f"q{i}").alias(c) for i, c in enumerate(POS_QTY)],
            *[round_money(f"a{i}").alias(c) for i, c in enumerate(POS_AMT)],
            weighted_price("a0", "q0").alias("unit_price"),
            "pos_update_date")

    def mark(self, target: DataFrame) -> Column:
        return high_water_mark(target, "pos_update_date")


# ============================================================ wholesale

WH_QTY = ["whrs_sell_in_quantity", "whrs_open_quantity", "whrs_end_quantity"]
WH_AMT = ["whrs_sell_in_amount", "whrs_open_amount", "whrs_end_amount"]


class FactWholesale(IncrementalModel):
    name = "s_f_wh_data"
    keys = ("product_id", "country_id", "transaction_date")
    update_cols = (*WH_QTY, *WH_AMT, "unit_price", "whrs_update_date", "update_ts", "updated_by")
    partition_col = "transaction_date"
    version_key = keys  # by day here, by month in the table
    by_day = True
    clocks = ("whrs_update_date",)
    dealt_by = ("product_id", "country_id")

    def rows(self, inventory: DataFrame, customers: DataFrame) -> DataFrame:
        """Wholesaler lines with the wholesaler's country (inner join)."""
        inv = inventory.select(
            "customer_id", "product_id",
            F.col("transaction_date").cast("date").alias("transaction_date"),
            F.col("update_date").cast("timestamp_ntz").alias("whrs_update_date"),
            F.col("unit_price").cast("double").alias("unit_price"),
            *[F.col(c).cast("double").alias(c) for c in WH_QTY])
        c = customers.select("customer_id", "country_id")
        return inv.join(c, "customer_id").select(
            "product_id", "country_id", "transaction_date", "whrs_update_date", "unit_price", *WH_QTY)

    def key_exprs(self) -> dict[str, Column]:
        return {"product_id": F.col("product_id"), "country_id": F.col("country_id"),
                "transaction_date": month_floor("transaction_date")}

    def measures(self) -> dict[str, Column]:
        return _measures(WH_QTY)

    def delivery_clock(self) -> Column:
        return F.col("whrs_update_date")

    def rollup(self, latest: DataFrame, per_key: bool = False) -> DataFrame:
        # newest version per product, country and DAY: the wholesaler is not in
        # the key, so only those delivered last for that day count
        month = month_floor("transaction_date").alias("transaction_date")
        sums = [F.sum(c).alias(c) for c in _measures(WH_QTY)]
        if per_key:
            g = latest.groupBy("product_id", "country_id", month).agg(
                F.max("whrs_update_date").alias("whrs_update_date"), *sums)
        else:
            g = latest.groupBy("product_id", "country_id", month, "whrs_update_date").agg(*sums)
        return g.select(
            "product_id", "country_id", "transaction_date",
            *[as_double(f"q{i}").alias(c) for i, c in enumerate(WH_QTY)],
            *[round_money(f"a{i}").alias(c) for i, c in enumerate(WH_AMT)],
            weighted_price("a0", "q0").alias("unit_price"),
            F.col("whrs_update_date").cast("date").alias("whrs_update_date"))

    def mark(self, target: DataFrame) -> Column:
        return high_water_mark(target, "whrs_update_date")


FACT_SALES = FactSales()
FACT_FORECAST = FactForecast()
FACT_POS = FactPos()
FACT_WHOLESALE = FactWholesale()

__all__ = ["FACT_FORECAST", "FACT_POS", "FACT_SALES", "FACT_WHOLESALE", "FactForecast", "FactPos",
           "FactSales", "FactWholesale"]
