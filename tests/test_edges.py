"""Edge behaviours of the models."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import D, T, countries, customers, frame
from stockbook.functions.audit import RunInfo
from stockbook.plans import dimensions as dims
from stockbook.plans import gold
from stockbook.plans.facts import FACT_FORECAST, FACT_POS, FACT_SALES, FACT_WHOLESALE

RUN = RunInfo(user="t")


def _rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def _cust(spark):
    return dims.customer_rows(customers(spark), countries(spark))


# ----------------------------------------------------------------- POS / forecast versions

def _pos(spark, rows):
    return frame(spark, "inventory_pos_history_details", rows)


def test_q1_delta_overwrites_month_with_partial_sum_recompute_rebuilds(spark):
    # month holds days 1 and 2; later only day 2 is re-delivered
    first = [(1, 1, T("2024-02-01 00:00:00"), D("2024-01-01"), 5.0, 0.0, 0.0, 2.0),
             (1, 1, T("2024-02-01 00:00:00"), D("2024-01-02"), 7.0, 0.0, 0.0, 2.0)]
    later = first + [(1, 1, T("2024-03-01 00:00:00"), D("2024-01-02"), 9.0, 0.0, 0.0, 2.0)]
    target = FACT_POS.full(_pos(spark, first), run=RUN)
    assert _rows(target, "pos_sell_out_quantity") == [(12.0,)]
    delta = FACT_POS.incremental(_pos(spark, later), target=target, run=RUN, mode="delta")
    assert _rows(delta, "pos_sell_out_quantity") == [(9.0,)]           # day 2 only
    recompute = FACT_POS.incremental(_pos(spark, later), target=target, run=RUN, mode="recompute")
    assert _rows(recompute, "pos_sell_out_quantity") == [(14.0,)]      # day 1 + new day 2


def test_q11_pos_versions_per_day_forecast_per_month(spark):
    pos = _pos(spark, [(1, 1, T("2024-02-01 00:00:00"), D("2024-01-01"), 5.0, 0.0, 0.0, 2.0),
                       (1, 1, T("2024-02-05 00:00:00"), D("2024-01-02"), 7.0, 0.0, 0.0, 2.0)])
    assert _rows(FACT_POS.full(pos, run=RUN), "pos_sell_out_quantity") == [(12.0,)]
    fc = frame(spark, "forecast_details", [
        (1, 1, T("2024-02-01 00:00:00"), D("2024-05-01"), D("2024-02-01"), 5.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 2.0),
        (1, 1, T("2024-02-05 00:00:00"), D("2024-05-02"), D("2024-02-01"), 7.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 2.0)])
    assert _rows(FACT_FORECAST.full(fc, run=RUN), "quantity") == [(7.0,)]


def test_ties_are_kept_and_summed(spark):
    pos = _pos(spark, [(1, 1, T("2024-02-01 00:00:00"), D("2024-01-01"), 5.0, 1.0, 1.0, 2.0),
                       (1, 1, T("2024-02-01 00:00:00"), D("2024-01-01"), 6.0, 1.0, 1.0, 4.0),
                       (1, 1, T("2024-01-01 00:00:00"), D("2024-01-01"), 100.0, 1.0, 1.0, 2.0)])
    out = FACT_POS.full(pos, run=RUN)
    # newest version = the two tied rows; price = (5*2 + 6*4) / 11 = 3.09
    assert _rows(out, "pos_sell_out_quantity", "pos_sell_out_amount", "unit_price") == [(11.0, 34.0, 3.09)]


def test_q13_stock_summed_over_days(spark):
    pos = _pos(spark, [(1, 1, T("2024-02-01 00:00:00"), D("2024-01-01"), 0.0, 10.0, 8.0, 1.0),
                       (1, 1, T("2024-02-01 00:00:00"), D("2024-01-02"), 0.0, 8.0, 6.0, 1.0)])
    assert _rows(FACT_POS.full(pos, run=RUN), "pos_open_quantity", "pos_end_quantity") == [(18.0, 14.0)]


def test_op34_zero_quantity_gives_null_price(spark):
    pos = _pos(spark, [(1, 1, T("2024-02-01 00:00:00"), D("2024-01-01"), 5.0, 0.0, 0.0, 2.0),
                       (1, 1, T("2024-02-01 00:00:00"), D("2024-01-02"), -5.0, 0.0, 0.0, 2.0)])
    assert _rows(FACT_POS.full(pos, run=RUN), "pos_sell_out_quantity", "unit_price") == [(0.0, None)]


def test_q6_rows_at_or_below_mark_are_skipped(spark):
    base = [(1, 1, T("2024-02-01 00:00:00"), D("2024-01-01"), 5.0, 0.0, 0.0, 2.0)]
    target = FACT_POS.full(_pos(spark, base), run=RUN)
    late = base + [(1, 1, T("2024-02-01 00:00:00"), D("2024-01-03"), 1.0, 0.0, 0.0, 2.0),
                   (1, 1, T("2024-01-15 00:00:00"), D("2024-01-04"), 1.0, 0.0, 0.0, 2.0)]
    out = FACT_POS.incremental(_pos(spark, late), target=target, run=RUN, mode="delta")
    assert _rows(out, "pos_sell_out_quantity") == [(5.0,)]


def test_q4_delta_leaves_insert_audit_null_for_new_keys(spark):
    base = [(1, 1, T("2024-02-01 00:00:00"), D("2024-01-01"), 5.0, 0.0, 0.0, 2.0)]
    target = FACT_POS.full(_pos(spark, base), run=RUN)
    more = base + [(2, 1, T("2024-03-01 00:00:00"), D("2024-01-01"), 1.0, 0.0, 0.0, 2.0)]
    out = FACT_POS.incremental(_pos(spark, more), target=target, run=RUN, mode="delta")
    assert _rows(out, "product_id", "inserted_by") == [(1, "t"), (2, None)]
    out = FACT_POS.incremental(_pos(spark, more), target=target, run=RUN, mode="recompute")
    assert _rows(out, "product_id", "inserted_by") == [(1, "t"), (2, "t")]


# ----------------------------------------------------------------- wholesale

def test_q10_only_last_delivered_wholesaler_counts(spark):
    inv = frame(spark, "inventory_wholesaler_history_details", [
        (10, 1, D("2024-01-05"), T("2024-02-01 00:00:00"), 2.0, 5.0, 0.0, 0.0),
        (20, 1, D("2024-01-05"), T("2024-02-03 00:00:00"), 2.0, 7.0, 0.0, 0.0)])
    cust = dims.customer_rows(customers(spark, [(10, 1, "A", "a", "c", T("2024-01-01 00:00:00")),
                                                (20, 1, "B", "a", "c", T("2024-01-01 00:00:00"))]), countries(spark))
    out = FACT_WHOLESALE.full(inv, cust, run=RUN)
    assert _rows(out, "whrs_sell_in_quantity", "whrs_update_date") == [(7.0, D("2024-02-03"))]


# ----------------------------------------------------------------- sales

def _orders(spark, rows):
    return frame(spark, "orders", rows)


def _lines(spark, rows):
    return frame(spark, "order_details", rows)


def test_q2_finer_grain_and_merge_modes(spark):
    orders = _orders(spark, [(1, 10, D("2024-01-01"), D("2024-01-31"), D("2024-01-05"), T("2024-01-02 00:00:00")),
                             (2, 10, D("2024-01-01"), D("2024-01-31"), D("2024-01-07"), T("2024-01-03 00:00:00"))])
    lines = _lines(spark, [(1, 5, 2.0, 1.0, 0.1, T("2024-01-02 00:00:00")),
                           (2, 5, 2.0, 3.0, 0.1, T("2024-01-04 00:00:00"))])
    full = FACT_SALES.full(orders, lines, _cust(spark), run=RUN)
    assert full.count() == 2                       # two clock pairs, one key
    new_lines = _lines(spark, [(1, 5, 2.0, 1.0, 0.1, T("2024-01-02 00:00:00")),
                               (2, 5, 2.0, 3.0, 0.1, T("2024-01-04 00:00:00")),
                               (1, 5, 2.0, 4.0, 0.1, T("2024-02-01 00:00:00")),
                               (2, 5, 2.0, 6.0, 0.1, T("2024-02-02 00:00:00"))])
    combined = FACT_SALES.incremental(orders, new_lines, _cust(spark), target=full, run=RUN,
                                      mode="delta", on_duplicate="combine")
    # one combined source row (4 + 6) takes the place of both target rows of its key: no sum counts it twice
    assert _rows(combined, "quantity") == [(10.0,)]
    with pytest.raises(Exception):
        FACT_SALES.incremental(orders, new_lines, _cust(spark), target=full, run=RUN,
                               mode="delta", on_duplicate="error").collect()
    recompute = FACT_SALES.incremental(orders, new_lines, _cust(spark), target=full, run=RUN)
    assert _rows(recompute, "quantity") == [(4.0,), (6.0,)]


def test_two_clocks_need_one_version_holding_both_maxima(spark):
    orders = _orders(spark, [(1, 10, D("2024-01-01"), D("2024-01-31"), D("2024-01-05"), T("2024-01-02 00:00:00"))])
    # the later line version has the older header clock: both maxima sit on one row here
    lines = _lines(spark, [(1, 5, 2.0, 1.0, 0.0, T("2024-01-02 00:00:00")),
                           (1, 5, 2.0, 3.0, 0.0, T("2024-01-04 00:00:00"))])
    assert _rows(FACT_SALES.full(orders, lines, _cust(spark), run=RUN), "quantity") == [(3.0,)]


def test_q8_null_clock_vanishes_from_facts_but_not_from_products(spark):
    orders = _orders(spark, [(1, 10, D("2024-01-01"), D("2024-01-31"), D("2024-01-05"), None)])
    lines = _lines(spark, [(1, 5, 2.0, 1.0, 0.0, T("2024-01-02 00:00:00"))])
    assert FACT_SALES.full(orders, lines, _cust(spark), run=RUN).count() == 0
    prods = frame(spark, "products", [(1, "A", "B", "S", "C", None)])
    assert dims.dim_products(prods, RUN).count() == 1


def test_q9_unshipped_orders_form_a_null_month_and_stay_out_of_the_book(spark):
    orders = _orders(spark, [(1, 10, D("2024-01-01"), D("2024-01-31"), None, T("2024-01-02 00:00:00"))])
    lines = _lines(spark, [(1, 5, 2.0, 1.0, 0.0, T("2024-01-02 00:00:00"))])
    sales = FACT_SALES.full(orders, lines, _cust(spark), run=RUN)
    assert _rows(sales, "shipped_date") == [(None,)]
    later = _lines(spark, [(1, 5, 2.0, 1.0, 0.0, T("2024-01-02 00:00:00")),
                           (1, 5, 2.0, 2.0, 0.0, T("2024-01-09 00:00:00"))])
    twice = FACT_SALES.incremental(orders, later, _cust(spark), target=sales, run=RUN, mode="delta",
                                   on_duplicate="combine")
    assert twice.count() == 2                      # NULL keys never match: inserted again
    fc = frame(spark, "forecast_details", [
        (5, 1, T("2024-02-01 00:00:00"), D("2024-03-01"), D("2024-02-01"), 5.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 2.0)])
    book = gold.planning_book(sales, FACT_FORECAST.full(fc, run=RUN), _empty_pos(spark), _empty_wh(spark))
    assert book.filter(F.col("Date").isNull()).count() == 0


def test_q23_ship_month_change_counts_in_both_months(spark):
    orders = _orders(spark, [(1, 10, D("2024-01-01"), D("2024-01-31"), D("2024-01-30"), T("2024-01-02 00:00:00")),
                             (1, 10, D("2024-01-01"), D("2024-01-31"), D("2024-02-02"), T("2024-01-05 00:00:00"))])
    lines = _lines(spark, [(1, 5, 2.0, 1.0, 0.0, T("2024-01-02 00:00:00"))])
    out = FACT_SALES.full(orders, lines, _cust(spark), run=RUN)
    assert _rows(out, "shipped_date") == [(D("2024-01-01"),), (D("2024-02-01"),)]


def test_q14_unknown_customer_dropped(spark):
    orders = _orders(spark, [(1, 99, D("2024-01-01"), D("2024-01-31"), D("2024-01-05"), T("2024-01-02 00:00:00"))])
    lines = _lines(spark, [(1, 5, 2.0, 1.0, 0.0, T("2024-01-02 00:00:00"))])
    assert FACT_SALES.full(orders, lines, _cust(spark), run=RUN).count() == 0
    from stockbook.operators.quality import orphan_keys
    assert _rows(orphan_keys(orders, "customer_id", _cust(spark)), "order_id") == [(1,)]


def test_q24_removed_source_row_stays_in_target(spark):
    base = [(1, 1, T("2024-02-01 00:00:00"), D("2024-01-01"), 5.0, 0.0, 0.0, 2.0)]
    target = FACT_POS.full(_pos(spark, base), run=RUN)
    other = [(2, 1, T("2024-03-01 00:00:00"), D("2024-01-01"), 1.0, 0.0, 0.0, 2.0)]
    out = FACT_POS.incremental(_pos(spark, other), target=target, run=RUN, mode="delta")
    assert _rows(out, "product_id") == [(1,), (2,)]


# ----------------------------------------------------------------- dimensions

def test_op39_undated_product_version_wins_and_q7_empty_target(spark):
    prods = frame(spark, "products", [(1, "old", "B", "S", "C", T("2024-01-01 00:00:00")),
                                      (1, "undated", "B", "S", "C", None)])
    assert _rows(dims.dim_products(prods, RUN), "product_name") == [("undated",)]
    empty = dims.dim_products(prods, RUN).limit(0)
    assert dims.dim_products_incremental(prods, empty, RUN, mode="delta").count() == 0
    assert dims.dim_products_incremental(prods, empty, RUN, mode="recompute").count() == 1


def test_op58_last_update_null_when_a_clock_is_null(spark):
    cust = customers(spark, [(10, 1, "A", "a", "c", None)])
    out = dims.dim_customers(cust, countries(spark), RUN)
    assert _rows(out, "last_update") == [(None,)]


def test_op74_unique_skips_nulls_duplicates_do_not(spark):
    from stockbook.operators.quality import check_duplicates, check_unique
    df = spark.createDataFrame([(None,), (None,), (1,)], "k long")
    assert check_unique(df, "k").count() == 0
    assert _rows(check_duplicates(df, ["k"]), "k", "cnt") == [(None, 2)]


def test_customer_incremental_two_marks_or(spark):
    target = dims.dim_customers(customers(spark), countries(spark), RUN)
    newer_country = countries(spark, [(1, "EUROPE", "POLSKA", "C1", T("2024-05-01 00:00:00")),
                                      (2, "EUROPE", "GERMANY", "C1", T("2024-01-01 00:00:00"))])
    out = dims.dim_customers_incremental(customers(spark), newer_country, target, RUN)
    assert _rows(out, "customer_id", "country", "inserted_by") == [(10, "POLSKA", "t"), (20, "GERMANY", "t")]


# ----------------------------------------------------------------- gold

def test_q16_q17_q18_calendar(spark):
    jan = gold.gold_dates(spark, as_of="2024-01-15")
    assert jan.count() == 2557
    assert jan.agg(F.max("Date")).first()[0] == dt.date(2026, 12, 31)
    assert jan.filter(F.col("YTD_BTG") == "YTD").count() == 0
    dec = gold.gold_dates(spark, as_of="2024-12-15")
    months = {r[0] for r in dec.filter(F.col("YTD_BTG") == "YTD").select("Month").distinct().collect()}
    assert months == set(range(1, 12))
    keys = {r[0] for r in dec.filter(F.col("Date").isin(dt.date(2020, 1, 1), dt.date(2020, 11, 1)))
            .select("KeyYearMonth").collect()}
    assert keys == {"20201", "202011"}
    row = dec.filter(F.col("Date") == dt.date(2021, 5, 3)).first()
    assert (row.Year, row.Quarter, row.Month, row.FY, row.KeyYearQuarter, row.KeyYearFY, row.KeyYearYTDBTG) == \
        (2021, "Q2", 5, "FY", "2021Q2", "2021FY", "2021YTD")


def _empty_pos(spark):
    return FACT_POS.full(_pos(spark, []), run=RUN)


def _empty_wh(spark):
    return FACT_WHOLESALE.full(frame(spark, "inventory_wholesaler_history_details", []), _cust(spark), run=RUN)


def test_q19_only_one_snapshot_last_holds_actuals_only(spark):
    fc = frame(spark, "forecast_details", [
        (5, 1, T("2024-03-01 00:00:00"), D("2024-03-10"), D("2024-03-01"), 5.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 2.0)])
    pos = _pos(spark, [(5, 1, T("2024-01-20 00:00:00"), D("2024-01-10"), 3.0, 0.0, 0.0, 2.0)])
    sales = FACT_SALES.full(_orders(spark, []), _lines(spark, []), _cust(spark), run=RUN)
    book = gold.planning_book(sales, FACT_FORECAST.full(fc, run=RUN), FACT_POS.full(pos, run=RUN), _empty_wh(spark))
    got = _rows(book.filter(F.col("Measure") == "EA"), "Version", "Date", "Ex_Factory", "Consumer_Off_Take")
    assert got == [("Current", D("2024-01-01"), 0.0, 3.0), ("Current", D("2024-03-01"), 5.0, 0.0),
                   ("Last", D("2024-01-01"), 0.0, 3.0)]
    assert book.filter(F.col("Measure") == "GTS").count() == 3


def test_q20_no_forecast_rows_empty_book(spark):
    pos = _pos(spark, [(5, 1, T("2024-01-20 00:00:00"), D("2024-01-10"), 3.0, 0.0, 0.0, 2.0)])
    fc = FACT_FORECAST.full(frame(spark, "forecast_details", []), run=RUN)
    sales = FACT_SALES.full(_orders(spark, []), _lines(spark, []), _cust(spark), run=RUN)
    assert gold.planning_book(sales, fc, FACT_POS.full(pos, run=RUN), _empty_wh(spark)).count() == 0


# ----------------------------------------------------------------- checks

def test_column_tests_report_each_failure(spark):
    from stockbook.operators.quality import CUSTOMER_NOT_NULL, CUSTOMER_UNIQUE, column_tests
    cust = customers(spark, [(10, 1, "A", "a", "c", T("2024-01-01 00:00:00")),
                             (10, 1, None, "a", "c", T("2024-01-01 00:00:00")),
                             (30, 2, "C", "a", "c", None)])
    dim = dims.dim_customers(cust, countries(spark), RUN)
    got = _rows(column_tests(dim, "customer_id", CUSTOMER_NOT_NULL, CUSTOMER_UNIQUE), "test", "column", "key")
    assert got == [("not_null", "company_name", "10"), ("not_null", "last_update", "30"),
                   ("unique", "customer_id", "10"), ("unique", "customer_id", "10")]


def test_orphan_names_compare_normalised(spark):
    from stockbook.operators.quality import orphan_keys
    objects = spark.createDataFrame([(" S_F_SALES ",), ("old_backup",), ("G_DIM_DATES",)], "name string")
    managed = spark.createDataFrame([("s_f_sales",), ("g_dim_dates",)], "model string")
    assert _rows(orphan_keys(objects, "name", managed, "model", normalize=True), "name") == [("old_backup",)]


def test_view_sink_registers_sql_name(spark):
    from stockbook.sources.tables import as_view
    as_view(_cust(spark), "s_dim_customers_v")
    assert spark.sql("SELECT count(*) FROM s_dim_customers_v").first()[0] == 2


def test_q5_same_day_clock_is_reloaded_without_changing_the_result(spark):
    orders = _orders(spark, [(1, 10, D("2024-01-01"), D("2024-01-31"), D("2024-01-05"), T("2024-01-02 00:00:00"))])
    lines = _lines(spark, [(1, 5, 2.0, 3.0, 0.1, T("2024-01-04 10:30:00"))])
    target = FACT_SALES.full(orders, lines, _cust(spark), run=RUN)
    # the target keeps the clock as a DATE: the mark is midnight, so the 10:30 line passes again
    changed = FACT_SALES.changed(FACT_SALES.rows(orders, lines, _cust(spark)), target)
    assert changed.count() == 1
    again = FACT_SALES.incremental(orders, lines, _cust(spark), target=target, run=RUN, mode="delta",
                                   on_duplicate="combine")
    cols = ["country_id", "product_id", "shipped_date", "quantity", "amount", "unit_price"]
    assert _rows(again, *cols) == _rows(target, *cols)


def test_q12_moved_customer_keeps_old_country_until_full_refresh(spark):
    orders = _orders(spark, [(1, 10, D("2024-01-01"), D("2024-01-31"), D("2024-01-05"), T("2024-01-02 00:00:00"))])
    lines = _lines(spark, [(1, 5, 2.0, 3.0, 0.1, T("2024-01-04 00:00:00"))])
    target = FACT_SALES.full(orders, lines, _cust(spark), run=RUN)
    moved = dims.customer_rows(customers(spark, [(10, 2, "Apteka A", "addr", "Berlin", T("2024-03-01 00:00:00"))]),
                               countries(spark))
    inc = FACT_SALES.incremental(orders, lines, moved, target=target, run=RUN, mode="delta", on_duplicate="combine")
    assert _rows(inc, "country_id") == [(1,)]
    assert _rows(FACT_SALES.full(orders, lines, moved, run=RUN), "country_id") == [(2,)]


def test_book_null_measure_only_without_fillers(spark):
    """A NULL quantity stays NULL unless another branch put a 0.0 filler in the group."""
    from stockbook.plans.gold import MEASURES

    fc_cols = ", ".join(f"{m} double" for m in MEASURES)
    forecast = spark.createDataFrame(
        [tuple([7, 1, D("2024-05-01"), D("2024-05-01")] + [1.0] * len(MEASURES))],
        f"product_id long, country_id int, forecast_date date, forecast_snapshot date, {fc_cols}")
    sales = spark.createDataFrame(
        [(1, 1, D("2024-01-01"), None, 5.0), (2, 1, D("2024-01-01"), None, 6.0)],
        "product_id long, country_id int, shipped_date date, quantity double, amount double")
    pos_cols = ["pos_sell_out_quantity", "pos_open_quantity", "pos_end_quantity",
                "pos_sell_out_amount", "pos_open_amount", "pos_end_amount"]
    pos = spark.createDataFrame(
        [(2, 1, D("2024-01-01"), 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)],
        "product_id long, country_id int, transaction_date date, " + ", ".join(f"{c} double" for c in pos_cols))
    wh_cols = ["whrs_sell_in_quantity", "whrs_open_quantity", "whrs_end_quantity",
               "whrs_sell_in_amount", "whrs_open_amount", "whrs_end_amount"]
    wh = spark.createDataFrame([], "product_id long, country_id int, transaction_date date, "
                               + ", ".join(f"{c} double" for c in wh_cols))
    book = gold.planning_book(sales, forecast, pos, wh).filter(
        (F.col("Measure") == "EA") & (F.col("Version") == "Current"))
    got = _rows(book, "IdProduct", "Ex_Factory", "Sales_to_pharmacies", "Consumer_Off_Take")
    # product 1: sales only -> quantity NULL, wholesale measures 0.0 (sales fillers)
    # product 2: sales + POS -> the POS row's 0.0 filler makes the quantity 0.0
    assert got == [(1, None, 0.0, 0.0), (2, 0.0, 0.0, 1.0), (7, 1.0, 1.0, 1.0)]


def test_small_prices_and_quantities_keep_their_amounts(spark):
    """Nothing is cut: seven decimals, tiny times huge, and 2e14 units."""
    import datetime as dt

    from stockbook.plans.facts import FACT_POS

    day, clock = dt.date(2000, 1, 5), dt.datetime(2000, 1, 6)
    rows = [(1, 1, clock, day, 1e6, 0.0, 0.0, 0.00004), (2, 1, clock, day, 0.00004, 0.0, 0.0, 1e6),
            (3, 1, clock, day, 2e14, 0.0, 0.0, 0.5), (4, 1, clock, day, 3e6, 0.0, 0.0, 0.0000001)]
    df = spark.createDataFrame(rows, "product_id long, country_id int, update_date timestamp_ntz, transaction_date date, "
                               "pos_sell_out_quantity double, pos_open_quantity double, pos_end_quantity double, unit_price double")
    got = {r.product_id: r for r in FACT_POS.full(df).collect()}
    assert [got[k].pos_sell_out_amount for k in (1, 2, 3, 4)] == [40.0, 40.0, 1e14, 0.3]
    assert [got[k].pos_sell_out_quantity for k in (1, 2, 3, 4)] == [1e6, 0.00004, 2e14, 3e6]
    assert [got[k].unit_price for k in (1, 2, 3, 4)] == [0.0, 1e6, 0.5, 0.0]


def test_sums_beyond_the_grid_raise(spark):
    import pytest
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F

    from stockbook.functions.exact import qty_total

    with pytest.raises(PySparkException, match="NUMERIC_VALUE_OUT_OF_RANGE|overflow|OVERFLOW"):
        spark.range(1).select(F.lit(1e27).alias("q")).agg(qty_total("q")).collect()
