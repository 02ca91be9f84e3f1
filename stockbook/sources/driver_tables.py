"""The driver's TPC-H-like tables shaped as bronze planning sources.

The planning models need customers, countries, products, orders, order
lines, forecasts and two stock histories. The driver ships TPC-H-like tables
instead, so this module maps them (mapping fixed in FIXTURES.md §3). Every
table is derived by Spark from the driver tables, so its size grows with them.

Re-deliveries: every line with ``l_linenumber % 3 = 0`` is delivered a second
time, 7 days later, with one more unit. The copy is produced with ``explode``
over a one- or two-element array: one scan, no self-union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockbook.functions.dates import date_lit
from stockbook.sources.bronze import Bronze, conform

# Fixed values of the mapping (FIXTURES.md §3).
EPOCH = "2000-01-01"              # base of the synthetic dimension clocks
REDELIVERY_LAG_DAYS = 7           # second delivery of a line: clock + 7 days
FORECAST_SNAPSHOTS = ("2000-07-01", "2000-06-01")
FORECAST_START = "2000-05-01"     # ship dates, taken modulo a year from SHIP_BASE on, are laid from here
SHIP_BASE = "1995-01-01"

# Update-clock cuts for incremental runs: rows before the cut build the target,
# the full tables are then merged into it.
INCREMENTAL_CUTS = {
    "customers": "2000-07-01",
    "countries": "2000-07-01",
    "products": "2000-07-01",
    "orders": "2000-01-01",
    "order_details": "2000-01-01",
    "inventory_pos_history_details": "2000-01-01",
    "inventory_wholesaler_history_details": "2000-01-01",
    "forecast_details": "2000-06-05",
}

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


#: Tables that may come as one file of one row group, which one task would read; dealt by these keys.
SPREAD_BY = {"lineitem": "l_orderkey", "orders": "o_orderkey"}
SPREAD_FROM = 4 << 20


def _dealt(df: DataFrame, key: str) -> DataFrame:
    """``df`` over all cores if it is a single file of 4 MB to 128 MB; larger tables have files enough."""
    spark, files = df.sparkSession, df.inputFiles()
    if len(files) != 1:
        return df
    path = spark._jvm.org.apache.hadoop.fs.Path(files[0])
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
    return df.repartition(spark.sparkContext.defaultParallelism, key) if SPREAD_FROM <= size <= 128 << 20 else df


#: Bytes of lineitem whose lines, as rows of any fact, one task sums up.
PIECE = 1 << 20


def fact_pieces(spark: SparkSession, sf_dir: str) -> int | None:
    """How many parts to deal a fact's rows into (``IncrementalModel.in_pieces``), by the size of lineitem; None where it is small."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return max(spark.sparkContext.defaultParallelism, -(-size // PIECE)) if size >= SPREAD_FROM else None


class _DriverTables(dict):
    """Driver tables read on first use (each read lists files and a footer)."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__()
        self._spark, self._root = spark, sf_dir.rstrip("/")

    def __missing__(self, name: str) -> DataFrame:
        if name not in DRIVER_TABLES:
            raise KeyError(name)
        df = self._spark.read.parquet(f"{self._root}/{name}.parquet")
        self[name] = _dealt(df, SPREAD_BY[name]) if name in SPREAD_BY else df
        return df


def read_driver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _DriverTables(spark, sf_dir)


def _plus_days(d: Column, n: Column | int) -> Column:
    """DATE + n days as a zone-less timestamp clock."""
    return F.date_add(d.cast("date"), n if isinstance(n, Column) else F.lit(n)).cast("timestamp_ntz")


def _lines(lineitem: DataFrame, *more: str) -> DataFrame:
    """Line deliveries: every line once (v=0), lines with number % 3 = 0 again (v=7); ``more`` columns come along."""
    v = F.explode(
        F.when(F.col("l_linenumber") % 3 == 0, F.array(F.lit(0), F.lit(REDELIVERY_LAG_DAYS)))
        .otherwise(F.array(F.lit(0)))
    ).alias("v")
    return (
        lineitem.select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_shipdate", *more, v)
        .withColumn("l_quantity", F.col("l_quantity") + F.when(F.col("v") > 0, 1).otherwise(0))
    )


def _product_id() -> Column:
    return F.col("l_partkey").alias("product_id")


def countries(t: dict[str, DataFrame]) -> DataFrame:
    n, r = t["nation"], t["region"]
    return conform(
        n.join(r, n.n_regionkey == r.r_regionkey).select(
            F.col("n_nationkey").alias("country_id"),
            F.col("r_name").alias("region_description"),
            F.col("n_name").alias("country"),
            F.concat(F.lit("CLUSTER_"), (F.col("n_regionkey") % 2).cast("string")).alias("cluster"),
            _plus_days(date_lit(EPOCH), F.col("n_nationkey")).alias("update_date"),
        ),
        "countries",
    )


def customers(t: dict[str, DataFrame]) -> DataFrame:
    return conform(
        t["customer"].select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_nationkey").alias("country_id"),
            F.col("c_name").alias("company_name"),
            F.col("c_mktsegment").alias("address"),
            F.concat(F.lit("CITY_"), F.col("c_nationkey").cast("string")).alias("city"),
            _plus_days(date_lit(EPOCH), (F.col("c_custkey") % 365).cast("int")).alias("update_date"),
        ),
        "customers",
    )


def products(t: dict[str, DataFrame]) -> DataFrame:
    """Parts, plus an older delivery (30 days earlier) of every tenth part."""
    lag = F.explode(
        F.when(F.col("p_partkey") % 10 == 0, F.array(F.lit(0), F.lit(-30))).otherwise(F.array(F.lit(0)))
    ).alias("lag")
    p = t["part"].select("p_partkey", "p_name", "p_brand", "p_type", "p_size", lag)
    return conform(
        p.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("brand_name"),
            F.col("p_type").alias("sub_brand_name"),
            F.concat(F.lit("CAT_"), (F.col("p_size") % 5).cast("string")).alias("category_name"),
            _plus_days(date_lit(EPOCH), (F.col("p_partkey") % 365).cast("int") + F.col("lag")).alias("update_date"),
        ),
        "products",
    )


def orders(t: dict[str, DataFrame]) -> DataFrame:
    od = F.col("o_orderdate").cast("date")
    unshipped = (F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 10 == 0)
    return conform(
        t["orders"].select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            od.alias("order_date"),
            F.date_add(od, 30).alias("required_date"),
            F.when(~unshipped, F.date_add(od, (F.col("o_orderkey") % 60).cast("int"))).alias("shipped_date"),
            _plus_days(od, 45).alias("update_date"),
        ),
        "orders",
    )


def order_details(t: dict[str, DataFrame]) -> DataFrame:
    line = _lines(t["lineitem"])
    return conform(
        line.select(
            F.col("l_orderkey").alias("order_id"),
            _product_id(),
            F.col("l_extendedprice").alias("unit_price"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_discount").alias("discount"),
            _plus_days(F.col("l_shipdate"), F.col("v")).alias("update_date"),
        ),
        "order_details",
    )


def wholesale(t: dict[str, DataFrame]) -> DataFrame:
    line = _lines(t["lineitem"])
    return conform(
        line.select(
            F.col("l_suppkey").alias("customer_id"),
            _product_id(),
            F.col("l_shipdate").cast("date").alias("transaction_date"),
            _plus_days(F.col("l_shipdate"), F.col("l_linenumber") + F.col("v")).alias("update_date"),
            F.col("l_extendedprice").alias("unit_price"),
            F.col("l_quantity").alias("whrs_sell_in_quantity"),
            (F.col("l_quantity") + F.col("l_linenumber")).alias("whrs_open_quantity"),
            F.col("l_linenumber").alias("whrs_end_quantity"),
        ),
        "inventory_wholesaler_history_details",
    )


def pos(t: dict[str, DataFrame]) -> DataFrame:
    line = _lines(t["lineitem"])
    s = t["supplier"].select("s_suppkey", "s_nationkey")
    return conform(
        line.join(s, line.l_suppkey == s.s_suppkey).select(
            _product_id(),
            F.col("s_nationkey").alias("country_id"),
            _plus_days(F.col("l_shipdate"), F.col("v")).alias("update_date"),
            F.col("l_shipdate").cast("date").alias("transaction_date"),
            F.col("l_quantity").alias("pos_sell_out_quantity"),
            (F.col("l_quantity") + F.col("l_linenumber")).alias("pos_open_quantity"),
            F.col("l_linenumber").alias("pos_end_quantity"),
            F.col("l_extendedprice").alias("unit_price"),
        ),
        "inventory_pos_history_details",
    )


def forecast(t: dict[str, DataFrame]) -> DataFrame:
    """Every line, once per snapshot; ship dates are shifted into the year around the snapshots.

    Orders meet customers first, so lines move to one join, and before their copies are made.
    """
    day = F.date_diff(F.col("l_shipdate").cast("date"), date_lit(SHIP_BASE)) % 365
    o = t["orders"].select("o_orderkey", "o_custkey")
    c = t["customer"].select("c_custkey", "c_nationkey")
    snap = F.explode(F.array(*[date_lit(s) for s in FORECAST_SNAPSHOTS])).alias("snapshot")
    nations = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_nationkey")
    line = t["lineitem"]
    joined = _lines(line.join(nations, line.l_orderkey == nations.o_orderkey), "c_nationkey").select("*", snap)
    return conform(
        joined.select(
            _product_id(),
            F.col("c_nationkey").alias("country_id"),
            _plus_days(F.col("snapshot"), F.col("v")).alias("update_date"),
            F.date_add(date_lit(FORECAST_START), day).alias("forecast_date"),
            F.col("snapshot").alias("forecast_snapshot"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_quantity").alias("whrs_sell_in_quantity"),
            (F.col("l_quantity") + F.col("l_linenumber")).alias("whrs_open_quantity"),
            F.col("l_linenumber").alias("whrs_end_quantity"),
            F.col("l_quantity").alias("pos_sell_out_quantity"),
            (F.col("l_quantity") + F.col("l_linenumber")).alias("pos_open_quantity"),
            F.col("l_linenumber").alias("pos_end_quantity"),
            F.col("l_extendedprice").alias("unit_price"),
        ),
        "forecast_details",
    )


def bronze_from_driver(spark: SparkSession, sf_dir: str) -> Bronze:
    t = read_driver(spark, sf_dir)
    return Bronze(
        customers=lambda: customers(t),
        countries=lambda: countries(t),
        products=lambda: products(t),
        orders=lambda: orders(t),
        order_details=lambda: order_details(t),
        forecast_details=lambda: forecast(t),
        inventory_pos_history_details=lambda: pos(t),
        inventory_wholesaler_history_details=lambda: wholesale(t),
    )


def before_cut(bronze: Bronze, cuts: dict[str, str] | None = None) -> Bronze:
    """The bronze rows whose update clock lies before each table's cut."""
    cuts = cuts or INCREMENTAL_CUTS

    def cut_table(name: str):
        cut = cuts.get(name)
        if cut is None:
            return lambda: getattr(bronze, name)
        return lambda: getattr(bronze, name).filter(F.col("update_date") < F.lit(cut).cast("timestamp_ntz"))

    return Bronze(**{name: cut_table(name) for name in bronze.names()})

