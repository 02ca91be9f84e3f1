"""The registered queries: each model and operator over the driver tables.

Every query shapes the driver tables into bronze (``sources.driver_tables``)
and runs library code on all of it. Incremental queries build the target
from the rows before each table's cut, materialize it (as a stored table
would be), and then load everything into it.
Audit timestamps are dropped from the outputs (they carry the run time) but
for ``audit_stamps``, which pins them; the audit users are pinned so outputs repeat.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockbook.functions.audit import RunInfo, with_audit
from stockbook.functions.dates import month_floor
from stockbook.functions.exact import as_double, money_total, qty_total, round_money, weighted_price
from stockbook.functions.nulls import strict_greatest
from stockbook.operators import quality
from stockbook.operators.incremental import merge_upsert
from stockbook.operators.versions import newest_version_sums
from stockbook.plans import dimensions as dims
from stockbook.plans import gold
from stockbook.plans.facts import FACT_FORECAST, FACT_POS, FACT_SALES, FACT_WHOLESALE
from stockbook.plans.model import IncrementalModel
from stockbook.session import ensure_checkpoint_dir
from stockbook.sources.bronze import Bronze
from stockbook.sources.driver_tables import before_cut, bronze_from_driver, fact_pieces
from stockbook.sources.keyed_tables import keyed_frame
from stockbook.sources.tables import CODEC, freed_shuffles, load_table
from stockbook.sources.version_state import load_with_state

RUN = RunInfo(user="stockbook")
_HIDDEN = ("update_ts", "insert_ts")


def _visible(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in _HIDDEN])


def _stored_table(df: DataFrame) -> DataFrame:
    """The target as an incremental run meets it: a Parquet table in the shared folder, of
    which each reader takes the columns it needs.

    It stands in for the stored silver table, so the mark, the merge and the key probes read
    one copy instead of each recomputing the first load. This runs a job when the query is built.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        df.write.option("compression", CODEC).parquet(path)
    return spark.read.parquet(path)


def _stored_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same, stored in buckets of the merge key (``sources.keyed_tables``): a merge leaves it unshuffled."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/keyed-{uuid.uuid4().hex}"
    return keyed_frame(df, path, keys, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _stored_in_pieces(model: IncrementalModel, df: DataFrame) -> DataFrame:
    """The same for a fact in pieces, stored in the parts its rows were summed in: neither the
    write nor a reader that is dealt alike (a merge, the book) moves it."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    return keyed_frame(df, path, model.dealt_by, model.pieces, placed=True, sort=model.keys)


def _bronze(spark: SparkSession, sf_dir: str) -> Bronze:
    return bronze_from_driver(spark, sf_dir)


def _customers(b: Bronze) -> DataFrame:
    """Customer rows as the facts see them (the customer dimension)."""
    return dims.customer_rows(b.customers, b.countries)


# ------------------------------------------------------------ dimensions

def dim_customers_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bronze(spark, sf_dir)
    return _visible(dims.dim_customers(b.customers, b.countries, RUN))


def dim_customers_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bronze(spark, sf_dir)
    old = before_cut(b)
    target = dims.dim_customers(old.customers, old.countries, RUN)
    return _visible(dims.dim_customers_incremental(b.customers, b.countries, target, RUN))


def dim_products_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bronze(spark, sf_dir)
    return _visible(dims.dim_products(b.products, RUN))


def dim_products_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bronze(spark, sf_dir)
    target = dims.dim_products(before_cut(b).products, RUN)
    return _visible(dims.dim_products_incremental(b.products, target, RUN))


# ------------------------------------------------------------ facts

def _fact_inputs(name: str, b: Bronze, customers: DataFrame) -> tuple:
    if name == "sales":
        return (b.orders, b.order_details, customers)
    if name == "forecast":
        return (b.forecast_details,)
    if name == "pos":
        return (b.inventory_pos_history_details,)
    return (b.inventory_wholesaler_history_details, customers)


_MODELS = {"sales": FACT_SALES, "forecast": FACT_FORECAST, "pos": FACT_POS, "wholesale": FACT_WHOLESALE}


def _model(name: str, spark: SparkSession, sf_dir: str) -> IncrementalModel:
    return _MODELS[name].in_pieces(fact_pieces(spark, sf_dir))


# facts whose grain is finer than the merge key combine the delta per key
_COMBINE = {"sales": "combine", "wholesale": "combine", "forecast": "error", "pos": "error"}


def _fact_full(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        b = _bronze(spark, sf_dir)
        return _visible(_model(name, spark, sf_dir).full(*_fact_inputs(name, b, _customers(b)), run=RUN))
    return run


def _fact_incremental(name: str, mode: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        b = _bronze(spark, sf_dir)
        customers = _customers(b)
        model = _model(name, spark, sf_dir)
        whole_key = mode == "delta" and not model.rolls_up
        if whole_key:  # a merge joins by the whole key; where versions have the same one, all is dealt by it
            model = model.in_pieces(model.pieces, by=model.keys)
        old = model.full(*_fact_inputs(name, before_cut(b), customers), run=RUN)
        if model.pieces and (whole_key or mode == "recompute"):
            target = _stored_in_pieces(model, old)
        else:
            target = _stored_by_key(old, model.keys) if mode == "delta" else _stored_table(old)
        return _visible(model.incremental(*_fact_inputs(name, b, customers), target=target, run=RUN,
                                          mode=mode, on_duplicate=_COMBINE[name]))
    return run


def _fact_state(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """The fact after a first load before the cut and one run over everything, both by its kept state."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        b = _bronze(spark, sf_dir)
        customers = _customers(b)
        model = _model(name, spark, sf_dir)
        root = f"{ensure_checkpoint_dir(spark)}/state-{uuid.uuid4().hex}"
        for bronze in (before_cut(b), b):
            inputs = _fact_inputs(name, bronze, customers)
            load_with_state(spark, model, *inputs, path=f"{root}/table", state=f"{root}/state", run=RUN)
        return _visible(load_table(spark, f"{root}/table", like=model.full(*inputs, run=RUN)))
    return run


def _silver(spark: SparkSession, sf_dir: str, store: bool = False) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The four facts. The book reads the forecast twice, its newest snapshot and its
    rows; stored first, as on a lake, the fact is computed once. In pieces all four are
    stored, one after the other, so that no two of them hold their shuffles on disk at once."""
    b = _bronze(spark, sf_dir)
    customers = _customers(b)
    models = {n: _model(n, spark, sf_dir) for n in _MODELS}
    full = {n: m.full(*_fact_inputs(n, b, customers), run=RUN) for n, m in models.items()}
    if store and models["forecast"].pieces:
        full |= {n: _stored_in_pieces(models[n], full[n]) for n in ("forecast", "wholesale", "sales", "pos")}
    elif store:
        full["forecast"] = _stored_table(full["forecast"])
    return full["sales"], full["forecast"], full["pos"], full["wholesale"]


# ------------------------------------------------------------ gold

def gold_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bronze(spark, sf_dir)
    return gold.gold_products(dims.dim_products(b.products, RUN))


def gold_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bronze(spark, sf_dir)
    return gold.gold_regions(dims.dim_customers(b.customers, b.countries, RUN))


def planning_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, forecast, _, _ = _silver(spark, sf_dir)
    return gold.planning_versions(forecast)


def planning_aligned_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.planning_aligned_union(*_silver(spark, sf_dir, store=True))


def planning_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    # stored in the same parts, the facts meet where they lie
    return gold.planning_book(*_silver(spark, sf_dir, store=True))


# ------------------------------------------------------------ operators

def merge_upsert_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain keyed merge (no mark): customers delivered from April 2000 on,
    merged into the dimension built from deliveries before July 2000, so rows
    match, insert, and stay untouched."""
    b = _bronze(spark, sf_dir)
    target = dims.dim_customers(before_cut(b).customers, b.countries, RUN)
    since = F.lit("2000-04-01").cast("timestamp_ntz")
    rows = dims.customer_rows(b.customers, b.countries).filter(F.col("customer_update_date") >= since)
    src = with_audit(rows, RUN, first_load=False)
    merged = merge_upsert(target, src, ["customer_id"],
                          ["company_name", "address", "city", "customer_update_date", "last_update",
                           "update_ts", "updated_by"])
    return _visible(merged)


FIRST_RUN, SECOND_RUN = (RunInfo(ts=_dt.datetime(2001, m, 1, 2, 3, 4), user=u) for m, u in ((1, "first"), (2, "second")))


def audit_stamps_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four audit columns after two runs with pinned times: rows loaded, updated and inserted.

    Customers before the cut are loaded by the first run; the second merges
    those delivered from April 2000 on.
    """
    b = _bronze(spark, sf_dir)
    target = dims.dim_customers(before_cut(b).customers, b.countries, FIRST_RUN)
    rows = dims.customer_rows(b.customers, b.countries).filter(
        F.col("customer_update_date") >= F.lit("2000-04-01").cast("timestamp_ntz"))
    merged = merge_upsert(target, with_audit(rows, SECOND_RUN, first_load=False), dims.CUSTOMER_KEYS, dims.CUSTOMER_UPDATE_COLS)
    return merged.select("customer_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("update_ts", "insert_ts")],
                         "updated_by", "inserted_by")


def high_water_mark_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines above the mark of the sales target built before the cut."""
    b = _bronze(spark, sf_dir)
    customers = _customers(b)
    target = _stored_table(_model("sales", spark, sf_dir).full(*_fact_inputs("sales", before_cut(b), customers), run=RUN))
    rows = FACT_SALES.rows(*_fact_inputs("sales", b, customers))
    return FACT_SALES.changed(rows, target).select(
        "order_id", "country_id", "product_id", "shipped_date", "order_details_update_date", "order_update_date")


def _weighted(od: DataFrame) -> DataFrame:
    g = od.groupBy("product_id", month_floor("update_date").alias("month")).agg(
        qty_total("quantity").alias("q"), money_total("quantity", "unit_price").alias("a"))
    return g.select("product_id", "month", as_double("q").alias("quantity"), round_money("a").alias("amount"),
                    weighted_price("a", "q").alias("unit_price"))


def weighted_price_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume-weighted price per product and month of delivery."""
    return _weighted(_bronze(spark, sf_dir).order_details)


def weighted_price_fine_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with prices a unit of a ten-thousandth: six decimals and more in the input."""
    return _weighted(_bronze(spark, sf_dir).order_details.select(
        "product_id", "update_date", (F.col("quantity") * 1000).alias("quantity"), (F.col("unit_price") / 16384).alias("unit_price")))


def newest_version_ties_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """POS rows of the newest version per product, country and day (ties summed)."""
    rows = FACT_POS.rows(_bronze(spark, sf_dir).inventory_pos_history_details)
    qcols = ["pos_sell_out_quantity", "pos_open_quantity", "pos_end_quantity"]
    latest = newest_version_sums(rows, ["product_id", "country_id", "transaction_date"], ["update_date"],
                                 {"n_rows": F.lit(1)} | {f"q_{c}": F.col(c) for c in qcols})
    return latest.select("product_id", "country_id", "transaction_date", "update_date", F.col("n_rows").cast("long").alias("n_rows"),
                         *[as_double(f"q_{c}").alias(c) for c in qcols])


def greatest_nullable_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later of ship date and line clock; NULL for unshipped orders."""
    b = _bronze(spark, sf_dir)
    o = b.orders.select("order_id", "shipped_date")
    od = b.order_details.select("order_id", "product_id", "update_date")
    return o.join(od, "order_id").select(
        "order_id", "product_id", "shipped_date",
        strict_greatest(F.col("shipped_date").cast("timestamp_ntz"), F.col("update_date")).alias("last_touch"))


def check_not_null_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales, _, _, _ = _silver(spark, sf_dir)
    return _visible(quality.check_not_null(sales, "shipped_date"))


def check_unique_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_unique(_bronze(spark, sf_dir).products, "product_id")


def check_duplicates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales, _, _, _ = _silver(spark, sf_dir)
    return quality.check_duplicates(sales, ["country_id", "product_id", "shipped_date"])


def _twice(customers: DataFrame) -> DataFrame:
    """Customers, every fortieth delivered a second time."""
    times = F.when(F.col("customer_id") % 40 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return customers.withColumn("_n", F.explode(times)).drop("_n")


def check_duplicate_customers_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer keys that occur more than once where every fortieth customer is delivered twice."""
    b = _bronze(spark, sf_dir)
    return quality.check_duplicates(dims.dim_customers(_twice(b.customers), b.countries, RUN), ["customer_id"])


def check_row_rule_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose country lacks an attribute, where every ninth country has no cluster."""
    b = _bronze(spark, sf_dir)
    countries = b.countries.withColumn("cluster", F.when(F.col("country_id") % 9 != 4, F.col("cluster")))
    return _visible(quality.check_row_rule(dims.dim_customers(b.customers, countries, RUN), quality.country_integrity_rule()))


def customer_column_tests_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer dimension's declared column tests (not_null x5, unique), with duplicates and nameless customers."""
    b = _bronze(spark, sf_dir)
    rows = _twice(b.customers).withColumn("company_name", F.when(F.col("customer_id") % 25 != 3, F.col("company_name")))
    return quality.column_tests(dims.dim_customers(rows, b.countries, RUN), "customer_id",
                                quality.CUSTOMER_NOT_NULL, quality.CUSTOMER_UNIQUE)


def orphan_keys_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines whose product is missing from a product dimension without every fiftieth part."""
    b = _bronze(spark, sf_dir)
    return quality.orphan_keys(b.order_details, "product_id", dims.dim_products(b.products.filter("product_id % 50 <> 7"), RUN))


def orphan_names_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products whose name, trimmed and lower-cased, is missing from a list without the names of 4k + 1 letters.

    Both sides write names in other cases and with blanks around them.
    """
    b = _bronze(spark, sf_dir)
    known = b.products.filter("length(product_name) % 4 <> 1").select(F.concat(F.lit(" "), F.upper("product_name"), F.lit("  ")).alias("name"))
    name, k = F.col("product_name"), F.col("product_id") % 3
    written = F.when(k == 0, F.concat(F.lit("  "), F.upper(name))).when(k == 1, F.concat(F.lower(name), F.lit(" "))).otherwise(name)
    named = dims.dim_products(b.products, RUN).select("product_id", written.alias("product_name"))
    return quality.orphan_keys(named, "product_name", known, ref_key="name", normalize=True)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "dim_customers_full": dim_customers_full,
        "dim_customers_incremental": dim_customers_incremental,
        "dim_products_full": dim_products_full,
        "dim_products_incremental": dim_products_incremental,
    }
    for name in ("sales", "forecast", "pos", "wholesale"):
        q[f"fact_{name}_full"] = _fact_full(name)
        q[f"fact_{name}_delta"] = _fact_incremental(name, "delta")
        q[f"fact_{name}_recompute"] = _fact_incremental(name, "recompute")
        q[f"fact_{name}_state"] = _fact_state(name)
    q.update({
        "gold_products": gold_products,
        "gold_regions": gold_regions,
        "planning_versions": planning_versions,
        "planning_aligned_union": planning_aligned_union,
        "planning_book": planning_book,
        "merge_upsert": merge_upsert_query,
        "audit_stamps": audit_stamps_query,
        "high_water_mark": high_water_mark_query,
        "weighted_price": weighted_price_query,
        "weighted_price_fine": weighted_price_fine_query,
        "newest_version_ties": newest_version_ties_query,
        "greatest_nullable": greatest_nullable_query,
        "check_not_null": check_not_null_query,
        "check_unique": check_unique_query,
        "check_duplicates": check_duplicates_query,
        "check_duplicate_customers": check_duplicate_customers_query,
        "check_row_rule": check_row_rule_query,
        "orphan_keys": orphan_keys_query,
        "orphan_names": orphan_names_query,
        "customer_column_tests": customer_column_tests_query,
    })
    return q
