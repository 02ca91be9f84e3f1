"""Gold layer: calendar, product and region dimensions, the planning book."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockbook.functions.exact import on_grid
from stockbook.functions.dates import day_sequence

# Fixed values of the calendar.
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2026-12-31"


# ============================================================ dates

def gold_dates(spark: SparkSession, as_of: _dt.date | str | None = None,
               start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """Daily calendar with quarter label, YTD/BTG flag and composite keys.

    ``YTD`` compares month numbers only, in every year: months before
    ``as_of``'s month are YTD, the rest (current month included) BTG.
    ``KeyYearMonth`` is not zero padded ('20201' is January 2020).
    ``as_of=None`` means the query's current timestamp.
    """
    as_of_col = F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("date")
    days = spark.range(1).select(day_sequence(start, end, "Date"))
    d = F.col("Date")
    year, month, quarter = F.year(d), F.month(d), F.quarter(d)
    ytd = F.when(month < F.month(as_of_col), F.lit("YTD")).otherwise(F.lit("BTG"))
    return days.select(
        year.alias("Year"),
        F.concat(F.lit("Q"), quarter.cast("string")).alias("Quarter"),
        month.alias("Month"),
        d.alias("Date"),
        ytd.alias("YTD_BTG"),
        F.lit("FY").alias("FY"),
        F.concat(year.cast("string"), month.cast("string")).alias("KeyYearMonth"),
        F.concat(year.cast("string"), F.lit("Q"), quarter.cast("string")).alias("KeyYearQuarter"),
        F.concat(year.cast("string"), ytd).alias("KeyYearYTDBTG"),
        F.concat(year.cast("string"), F.lit("FY")).alias("KeyYearFY"),
    )


# ============================================================ dimensions

def gold_products(dim_products: DataFrame) -> DataFrame:
    return dim_products.select(
        F.col("product_id").alias("IdProduct"),
        F.col("product_name").alias("Name"),
        F.col("brand_name").alias("Brand"),
        F.col("sub_brand_name").alias("SubBrand"),
        F.col("category_name").alias("Category"),
    )


def gold_regions(dim_customers: DataFrame) -> DataFrame:
    """Distinct (country, cluster, region, name); one row per country only
    when its attributes agree across customers."""
    return dim_customers.select(
        F.col("country_id").alias("IDCountry"),
        F.col("cluster").alias("Cluster"),
        F.col("region_description").alias("Region"),
        F.col("country").alias("Country"),
    ).distinct()


# ============================================================ planning book

QTY_MEASURES = ["quantity", "whrs_sell_in_quantity", "whrs_open_quantity", "whrs_end_quantity",
                "pos_sell_out_quantity", "pos_open_quantity", "pos_end_quantity"]
AMT_MEASURES = ["amount", "whrs_sell_in_amount", "whrs_open_amount", "whrs_end_amount",
                "pos_sell_out_amount", "pos_open_amount", "pos_end_amount"]
MEASURES = QTY_MEASURES + AMT_MEASURES
BOOK_KEYS = ["product_id", "country_id", "financial_date", "forecast_snapshot"]
ALIGNED_COLUMNS = BOOK_KEYS + MEASURES
BOOK_COLUMNS = ["Ex_Factory", "Sales_to_pharmacies", "Open_Stock", "Close_Stock",
                "Consumer_Off_Take", "Open_Stock_Pharmacies", "Close_Stock_Pharmacies"]


def snapshot_marks(forecast: DataFrame) -> tuple[Column, Column]:
    """(current, last): the newest forecast snapshot and the month before.

    Both are uncorrelated scalar subqueries over the forecast fact: Spark runs
    the one-row aggregate once (identical subqueries are reused at run time)
    and feeds the value into every filter that needs it, so no branch is
    joined with anything. ``last`` is computed, not looked up, so it may hold
    no forecast; an empty forecast makes both NULL and the book empty.
    """
    current = forecast.select(F.max("forecast_snapshot")).scalar()
    return current, F.add_months(current, -1)


def planning_versions(forecast: DataFrame) -> DataFrame:
    """The two versions as rows: ('Current', s) and ('Last', s - 1 month)."""
    top = forecast.agg(F.max("forecast_snapshot").alias("s"))
    return top.select(F.inline(F.array(
        F.struct(F.lit("Current").alias("Version"), F.col("s").alias("forecast_snapshot")),
        F.struct(F.lit("Last").alias("Version"), F.add_months(F.col("s"), -1).alias("forecast_snapshot")),
    )))


_BRANCH_MEASURES = {
    "forecast": MEASURES,
    "sales": ["quantity", "amount"],
    "pos": ["pos_sell_out_quantity", "pos_open_quantity", "pos_end_quantity",
            "pos_sell_out_amount", "pos_open_amount", "pos_end_amount"],
    "wholesale": ["whrs_sell_in_quantity", "whrs_open_quantity", "whrs_end_quantity",
                  "whrs_sell_in_amount", "whrs_open_amount", "whrs_end_amount"],
}


def _aligned(df: DataFrame, date_col: str, branch: str, sparse: bool) -> DataFrame:
    """One branch on the canonical column list.

    Measures the branch does not carry are 0.0 (``sparse=False``, the
    aligned union as written) or NULL plus a branch tag (``sparse=True``,
    for the book's own aggregation, which then skips the fillers).
    """
    present = _BRANCH_MEASURES[branch]
    filler = F.lit(None).cast("double") if sparse else F.lit(0.0).cast("double")
    extra = [F.lit(branch).alias("_branch")] if sparse else []
    return df.select(
        F.col("product_id"), F.col("country_id"), F.col(date_col).alias("financial_date"),
        F.col("_snap").alias("forecast_snapshot"), F.col("_version").alias("Version"),
        *[(F.col(m) if m in present else filler).alias(m) for m in MEASURES], *extra)


def _as_of_versions(d: Column, current: Column, last: Column) -> Column:
    """(snapshot, label) of every version a month of actuals precedes.

    Rows reach here only when their month is before the current snapshot;
    they also belong to the last version when they precede it. A generator
    over two values: each fact row is read once and emitted once or twice,
    never paired with anything else.
    """
    return F.inline(F.array(
        F.struct(current.alias("_snap"), F.lit("Current").alias("_version")),
        F.struct(F.when(d < last, last).alias("_snap"), F.lit("Last").alias("_version")),
    ))


def planning_aligned_union(sales: DataFrame, forecast: DataFrame, pos: DataFrame, wholesale: DataFrame,
                           with_version: bool = False, sparse: bool = False) -> DataFrame:
    """Actuals before each snapshot plus forecasts from it on, on one column list.

    Forecast rows enter a version when their snapshot is that version and
    their month is not before it; sales, POS and wholesale rows enter every
    version whose snapshot lies after their month, relabelled with it.
    Only the columns a branch really carries are read; the others are
    constant zeros.
    """
    current, last = snapshot_marks(forecast)
    snap, fdate = F.col("forecast_snapshot"), F.col("forecast_date")
    fc = forecast.filter(((snap == current) & (fdate >= current)) | ((snap == last) & (fdate >= last)))
    fc = fc.select("*", snap.alias("_snap"),
                   F.when(snap == current, F.lit("Current")).otherwise(F.lit("Last")).alias("_version"))
    branches = [_aligned(fc, "forecast_date", "forecast", sparse)]
    for df, date_col, branch in [(sales, "shipped_date", "sales"), (pos, "transaction_date", "pos"),
                                 (wholesale, "transaction_date", "wholesale")]:
        d = F.col(date_col)
        keep = ["product_id", "country_id", date_col, *_BRANCH_MEASURES[branch]]
        v = (df.filter(d < current).select(*keep, _as_of_versions(d, current, last))
             .filter(F.col("_snap").isNotNull()))
        branches.append(_aligned(v, date_col, branch, sparse))
    out = reduce(DataFrame.unionByName, branches)
    return out if with_version else out.drop("Version")


def planning_book(sales: DataFrame, forecast: DataFrame, pos: DataFrame, wholesale: DataFrame) -> DataFrame:
    """Product x country x month x snapshot, in units (EA) and value (GTS).

    One aggregation over the union (partial sums per branch, one shuffle),
    then one generator writes each group out as its EA and GTS rows. The
    version label travels with the rows (it is fixed by the snapshot).

    The union is built sparse: a branch leaves the measures it does not carry
    NULL, so the exact decimal sums only touch real values (a sales row adds
    2 of the 14 measures, not 14). A measure whose group holds no real value
    is 0.0 when any other branch contributed a row to the group (its 0.0
    fillers) and NULL otherwise, which is what summing the zero-filled union
    gives.
    """
    unioned = planning_aligned_union(sales, forecast, pos, wholesale, with_version=True, sparse=True)
    has = {b: F.max((F.col("_branch") == b).cast("int")).alias(f"_has_{b}") for b in _BRANCH_MEASURES}
    sums = unioned.groupBy(*BOOK_KEYS, "Version").agg(
        *[F.sum(on_grid(m)).cast("double").alias(m) for m in MEASURES], *has.values())

    def total(m: str) -> Column:
        fillers = [b for b, carried in _BRANCH_MEASURES.items() if m not in carried]
        if not fillers:
            return F.col(m)
        filled = reduce(lambda a, b: a | b, [F.col(f"_has_{b}") == 1 for b in fillers])
        return F.coalesce(F.col(m), F.when(filled, F.lit(0.0)))

    rows = F.inline(F.array(
        F.struct(F.lit("EA").alias("Measure"), *[total(m).alias(b) for m, b in zip(QTY_MEASURES, BOOK_COLUMNS)]),
        F.struct(F.lit("GTS").alias("Measure"), *[total(m).alias(b) for m, b in zip(AMT_MEASURES, BOOK_COLUMNS)]),
    ))
    return sums.select(
        F.col("product_id").alias("IdProduct"),
        F.col("country_id").alias("IDCountry"),
        F.col("financial_date").alias("Date"),
        "forecast_snapshot",
        "Version",
        rows,
    ).select("IdProduct", "IDCountry", "Date", "forecast_snapshot", "Measure", "Version", *BOOK_COLUMNS)
