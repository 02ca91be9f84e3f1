"""Run the model graph on storage: silver loads, gold rebuilds, data tests.

The order follows the model dependencies: the customer and product
dimensions first, then the four facts (sales and wholesale read the stored
customer dimension), then the gold tables from the stored silver tables.
Every step reads what the previous one wrote, so a failed run can be
resumed, and each table is written once per run.

    python -m stockbook.plans.refresh --bronze s3://lake/bronze --lake s3://lake
"""

from __future__ import annotations

import argparse
import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockbook.functions.audit import RunInfo
from stockbook.operators import quality
from stockbook.plans import dimensions as dims
from stockbook.plans import gold
from stockbook.plans.facts import FACT_FORECAST, FACT_POS, FACT_SALES, FACT_WHOLESALE
from stockbook.sources.bronze import Bronze, read_bronze
from stockbook.sources.tables import load_model, load_table, save_table, table_exists

SILVER = ("s_dim_customers", "s_dim_products", "s_f_sales", "s_f_forecast", "s_f_pos", "s_f_wh_data")
GOLD = ("g_dim_dates", "g_dim_products", "g_dim_regions", "g_f_planning_book")


def _silver(lake: str, name: str) -> str:
    return f"{lake.rstrip('/')}/silver/{name}"


def _gold(lake: str, name: str) -> str:
    return f"{lake.rstrip('/')}/gold/{name}"


def _load_dimension(spark: SparkSession, path: str, full: Callable[[], DataFrame],
                    incremental: Callable[[DataFrame], DataFrame], full_refresh: bool) -> str:
    """First load, or merge into the stored dimension, which is written anew beside the old one and switched."""
    if full_refresh or not table_exists(spark, path):
        save_table(full(), path)
        return "full"
    target = load_table(spark, path, like=full())
    save_table(incremental(target), path)
    return "merged"


def refresh_silver(spark: SparkSession, bronze: Bronze, lake: str, run: RunInfo = RunInfo(),
                   mode: str = "recompute", full_refresh: bool = False, on_duplicate: str = "error") -> dict[str, str]:
    """Load the six silver tables; returns what was done per table.

    ``on_duplicate`` matters to ``delta`` runs of sales and wholesale, whose
    grain is finer than their merge key: ``error`` stops as a warehouse MERGE
    does, ``combine`` merges one combined row a key.
    """
    done = {}
    done["s_dim_customers"] = _load_dimension(
        spark, _silver(lake, "s_dim_customers"),
        lambda: dims.dim_customers(bronze.customers, bronze.countries, run),
        lambda t: dims.dim_customers_incremental(bronze.customers, bronze.countries, t, run),
        full_refresh)
    done["s_dim_products"] = _load_dimension(
        spark, _silver(lake, "s_dim_products"),
        lambda: dims.dim_products(bronze.products, run),
        lambda t: dims.dim_products_incremental(bronze.products, t, run,
                                                mode="delta" if mode == "delta" else "recompute"),
        full_refresh)
    customers = load_table(spark, _silver(lake, "s_dim_customers")).select("customer_id", "country_id")
    facts = [
        ("s_f_sales", FACT_SALES, (bronze.orders, bronze.order_details, customers), on_duplicate),
        ("s_f_forecast", FACT_FORECAST, (bronze.forecast_details,), "error"),
        ("s_f_pos", FACT_POS, (bronze.inventory_pos_history_details,), "error"),
        ("s_f_wh_data", FACT_WHOLESALE, (bronze.inventory_wholesaler_history_details, customers), on_duplicate),
    ]
    for name, model, inputs, on_dup in facts:
        done[name] = load_model(spark, model, *inputs, path=_silver(lake, name), run=run, mode=mode,
                                on_duplicate=on_dup, full_refresh=full_refresh)
    return done


def silver_tables(spark: SparkSession, lake: str) -> dict[str, DataFrame]:
    return {name: load_table(spark, _silver(lake, name)) for name in SILVER}


def refresh_gold(spark: SparkSession, lake: str, as_of: _dt.date | str | None = None) -> None:
    """Rebuild the four gold tables from the stored silver tables."""
    s = silver_tables(spark, lake)
    save_table(gold.gold_dates(spark, as_of=as_of), _gold(lake, "g_dim_dates"))
    save_table(gold.gold_products(s["s_dim_products"]), _gold(lake, "g_dim_products"))
    save_table(gold.gold_regions(s["s_dim_customers"]), _gold(lake, "g_dim_regions"))
    book = gold.planning_book(s["s_f_sales"], s["s_f_forecast"], s["s_f_pos"], s["s_f_wh_data"])
    save_table(book, _gold(lake, "g_f_planning_book"), partition_by="forecast_snapshot")


def data_tests(spark: SparkSession, lake: str) -> dict[str, DataFrame]:
    """The declared data tests; each frame lists the offending rows."""
    customers = load_table(spark, _silver(lake, "s_dim_customers"))
    return {
        "customer_column_tests": quality.column_tests(customers, "customer_id", quality.CUSTOMER_NOT_NULL,
                                                      quality.CUSTOMER_UNIQUE),
        "no_duplicate_customers": quality.check_duplicates(customers, ["customer_id"]),
        "country_data_integrity": quality.check_row_rule(customers, quality.country_integrity_rule()),
    }


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description="Load silver, rebuild gold, run data tests.")
    ap.add_argument("--bronze", required=True, help="folder with one sub-folder per bronze table")
    ap.add_argument("--lake", required=True, help="root for silver/ and gold/")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--mode", choices=("recompute", "delta"), default="recompute")
    ap.add_argument("--full-refresh", action="store_true")
    ap.add_argument("--on-duplicate", choices=("error", "combine"), default="error",
                    help="delta runs: several source rows for one key stop the run, or are combined")
    ap.add_argument("--as-of", default=None, help="date for the calendar's YTD flag (default: today)")
    ap.add_argument("--user", default=None, help="run user for the audit columns")
    args = ap.parse_args(argv)

    from stockbook.session import get_session

    spark = get_session()
    run = RunInfo(user=args.user)
    done = refresh_silver(spark, read_bronze(spark, args.bronze, args.format), args.lake, run,
                          mode=args.mode, full_refresh=args.full_refresh, on_duplicate=args.on_duplicate)
    refresh_gold(spark, args.lake, as_of=args.as_of)
    failed = 0
    for name, df in data_tests(spark, args.lake).items():
        n = df.agg(F.count(F.lit(1))).first()[0]   # one number per test
        failed += n > 0
        print(f"test {name}: {'PASS' if n == 0 else f'FAIL ({n} rows)'}")
    print("silver:", done)
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
