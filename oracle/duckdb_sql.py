"""Oracle SQL for DuckDB: the registered queries written a second way.

These statements restate the planning models in plain SQL over the driver
tables: the bronze shaping as UNION ALL and joins, newest versions with
``MAX(..) OVER (PARTITION BY ..)`` windows, merges as LEFT JOIN plus
NOT EXISTS. The Spark side uses other plans (aggregations, generators,
scalar subqueries), so agreement checks the semantics; both sides agree on the
12-decimal grid of the sums.

Quantities and row amounts are summed over DECIMAL(38,12), made from the doubles'
shortest text, and rounded exactly.
Audit timestamps are left out of every comparison but ``audit_stamps``; the run user is pinned.
"""

from __future__ import annotations

RUN_USER = "stockbook"

# ------------------------------------------------------------------ helpers

def _q(c: str) -> str:
    return f"CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,12))"


def _amt(q: str, p: str) -> str:
    return f"CAST(CAST({q} * {p} AS VARCHAR) AS DECIMAL(38,12))"


def _round2(a: str) -> str:
    return f"CAST(ROUND({a}, 2) AS DOUBLE)"


def _dbl(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


def _wprice(a: str, q: str) -> str:
    """ROUND(a / NULLIF(q, 0), 2) exactly: integer half-up on the 1e-12 units of both sums."""
    au, qu = (f"CAST(replace(CAST(CAST(abs({x}) AS DECIMAL(38,12)) AS VARCHAR), '.', '') AS HUGEINT)" for x in (a, q))
    return (f"(CASE WHEN {q} = 0 THEN NULL ELSE "
            f"sign({a}) * sign({q}) * ((200 * {au} + {qu}) // (2 * {qu})) / 100 END)")


def _month(c: str) -> str:
    return f"CAST(date_trunc('month', {c}) AS DATE)"


def _ts(d: str) -> str:
    return f"TIMESTAMP '{d} 00:00:00'"


def _with(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{final}"


# ------------------------------------------------------------------ bronze

BRONZE = [
    ("line", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_returnflag, l_shipdate, 0 AS v FROM lineitem
UNION ALL
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1, l_extendedprice, l_discount,
       l_returnflag, l_shipdate, 7 AS v FROM lineitem WHERE l_linenumber % 3 = 0"""),
    ("b_countries", """
SELECT n_nationkey AS country_id, r_name AS region_description, n_name AS country,
       'CLUSTER_' || CAST(n_regionkey % 2 AS VARCHAR) AS cluster,
       CAST(DATE '2000-01-01' + n_nationkey AS TIMESTAMP) AS update_date
FROM nation JOIN region ON n_regionkey = r_regionkey"""),
    ("b_customers", """
SELECT c_custkey AS customer_id, c_nationkey AS country_id, c_name AS company_name,
       c_mktsegment AS address, 'CITY_' || CAST(c_nationkey AS VARCHAR) AS city,
       CAST(DATE '2000-01-01' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP) AS update_date
FROM customer"""),
    ("b_products", """
SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand_name, p_type AS sub_brand_name,
       'CAT_' || CAST(p_size % 5 AS VARCHAR) AS category_name,
       CAST(DATE '2000-01-01' + CAST(p_partkey % 365 AS INTEGER) AS TIMESTAMP) AS update_date
FROM part
UNION ALL
SELECT p_partkey, p_name, p_brand, p_type, 'CAT_' || CAST(p_size % 5 AS VARCHAR),
       CAST(DATE '2000-01-01' + CAST(p_partkey % 365 AS INTEGER) - 30 AS TIMESTAMP)
FROM part WHERE p_partkey % 10 = 0"""),
    ("b_orders", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
       CAST(o_orderdate AS DATE) + 30 AS required_date,
       CASE WHEN o_orderstatus = 'P' AND o_orderkey % 10 = 0 THEN NULL
            ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INTEGER) END AS shipped_date,
       CAST(CAST(o_orderdate AS DATE) + 45 AS TIMESTAMP) AS update_date
FROM orders"""),
    ("b_order_details", """
SELECT l_orderkey AS order_id, l_partkey AS product_id, l_extendedprice AS unit_price,
       l_quantity AS quantity, l_discount AS discount,
       CAST(CAST(l_shipdate AS DATE) + v AS TIMESTAMP) AS update_date
FROM line"""),
    ("b_wholesale", """
SELECT l_suppkey AS customer_id, l_partkey AS product_id, CAST(l_shipdate AS DATE) AS transaction_date,
       CAST(CAST(l_shipdate AS DATE) + l_linenumber + v AS TIMESTAMP) AS update_date,
       l_extendedprice AS unit_price, l_quantity AS whrs_sell_in_quantity,
       CAST(l_quantity + l_linenumber AS DOUBLE) AS whrs_open_quantity,
       CAST(l_linenumber AS DOUBLE) AS whrs_end_quantity
FROM line"""),
    ("b_pos", """
SELECT l_partkey AS product_id, s_nationkey AS country_id,
       CAST(CAST(l_shipdate AS DATE) + v AS TIMESTAMP) AS update_date,
       CAST(l_shipdate AS DATE) AS transaction_date,
       l_quantity AS pos_sell_out_quantity, CAST(l_quantity + l_linenumber AS DOUBLE) AS pos_open_quantity,
       CAST(l_linenumber AS DOUBLE) AS pos_end_quantity, l_extendedprice AS unit_price
FROM line JOIN supplier ON l_suppkey = s_suppkey"""),
    ("b_forecast", """
SELECT l_partkey AS product_id, c_nationkey AS country_id,
       CAST(s.snapshot + v AS TIMESTAMP) AS update_date,
       DATE '2000-05-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 365 AS INTEGER) AS forecast_date,
       s.snapshot AS forecast_snapshot,
       l_quantity AS quantity, l_quantity AS whrs_sell_in_quantity,
       CAST(l_quantity + l_linenumber AS DOUBLE) AS whrs_open_quantity, CAST(l_linenumber AS DOUBLE) AS whrs_end_quantity,
       l_quantity AS pos_sell_out_quantity,
       CAST(l_quantity + l_linenumber AS DOUBLE) AS pos_open_quantity, CAST(l_linenumber AS DOUBLE) AS pos_end_quantity,
       l_extendedprice AS unit_price
FROM line JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey,
     (VALUES (DATE '2000-07-01'), (DATE '2000-06-01')) AS s(snapshot)"""),
]

CUTS = {
    "b_customers": "2000-07-01", "b_countries": "2000-07-01", "b_products": "2000-07-01",
    "b_orders": "2000-01-01", "b_order_details": "2000-01-01", "b_pos": "2000-01-01",
    "b_wholesale": "2000-01-01", "b_forecast": "2000-06-05",
}


def _cut(name: str) -> tuple[str, str]:
    return (f"{name}_cut", f"SELECT * FROM {name} WHERE update_date < {_ts(CUTS[name])}")


# ------------------------------------------------------------------ silver

def customer_rows_sql(customers: str = "b_customers", countries: str = "b_countries") -> str:
    return f"""
SELECT c.customer_id, c.country_id, c.company_name, c.address, c.city,
       co.region_description, co.country, co.cluster,
       c.update_date AS customer_update_date, co.update_date AS country_update_date,
       CASE WHEN c.update_date IS NULL OR co.update_date IS NULL THEN NULL
            ELSE greatest(c.update_date, co.update_date) END AS last_update
FROM {customers} c JOIN {countries} co ON c.country_id = co.country_id"""


CUSTOMER_COLS = ["customer_id", "country_id", "company_name", "address", "city", "region_description",
                 "country", "cluster", "customer_update_date", "country_update_date", "last_update"]
PRODUCT_COLS = ["product_id", "product_name", "brand_name", "sub_brand_name", "category_name", "update_date"]


def products_sql(products: str, where: str = "") -> str:
    return f"""
SELECT {', '.join(PRODUCT_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY update_date DESC NULLS FIRST,
      product_name ASC NULLS FIRST, brand_name ASC NULLS FIRST, sub_brand_name ASC NULLS FIRST,
      category_name ASC NULLS FIRST) AS rn
  FROM {products} {where}) x
WHERE rn = 1"""


SALES_COLS = ["country_id", "product_id", "shipped_date", "quantity", "discount", "amount", "unit_price",
              "order_details_update_date", "order_update_date"]
SALES_KEYS = ["country_id", "product_id", "shipped_date"]
SALES_UPDATE = ["quantity", "discount", "amount", "unit_price", "order_details_update_date", "order_update_date",
                "updated_by"]


def sales_lines_sql(orders: str, details: str, customers: str) -> str:
    return f"""
SELECT o.order_id, c.country_id, od.product_id, {_month('o.shipped_date')} AS shipped_date,
       od.unit_price, od.quantity, od.discount,
       CAST(od.update_date AS TIMESTAMP) AS odu, CAST(o.update_date AS TIMESTAMP) AS ou
FROM {orders} o JOIN {details} od ON o.order_id = od.order_id
JOIN {customers} c ON o.customer_id = c.customer_id"""


def sales_sql(lines: str, per_key: bool = False) -> str:
    group = "country_id, product_id, shipped_date" + ("" if per_key else ", odu, ou")
    clocks = "max(odu) AS odu, max(ou) AS ou," if per_key else "odu, ou,"
    return f"""
SELECT country_id, product_id, shipped_date, {_dbl('q')} AS quantity, {_dbl('d')} AS discount,
       {_round2('a')} AS amount, {_wprice('a', 'q')} AS unit_price,
       CAST(odu AS DATE) AS order_details_update_date, CAST(ou AS DATE) AS order_update_date
FROM (
  SELECT country_id, product_id, shipped_date, {clocks}
         SUM({_q('quantity')}) AS q, SUM({_q('discount')}) AS d, SUM({_amt('quantity', 'unit_price')}) AS a
  FROM (
    SELECT *, max(odu) OVER (PARTITION BY order_id, product_id, country_id, shipped_date) AS m_odu,
              max(ou) OVER (PARTITION BY order_id, product_id, country_id, shipped_date) AS m_ou
    FROM {lines}) w
  WHERE odu = m_odu AND ou = m_ou
  GROUP BY {group}) g"""


FQ = ["quantity", "whrs_sell_in_quantity", "whrs_open_quantity", "whrs_end_quantity",
      "pos_sell_out_quantity", "pos_open_quantity", "pos_end_quantity"]
FA = ["amount", "whrs_sell_in_amount", "whrs_open_amount", "whrs_end_amount",
      "pos_sell_out_amount", "pos_open_amount", "pos_end_amount"]
FORECAST_COLS = ["product_id", "country_id", "forecast_date", "forecast_snapshot", "forecast_update_date",
                 *FQ, *FA, "unit_price"]
FORECAST_KEYS = ["product_id", "country_id", "forecast_date", "forecast_snapshot"]
FORECAST_UPDATE = ["forecast_update_date", *FQ, *FA, "unit_price", "updated_by"]


def forecast_rows_sql(src: str) -> str:
    return f"""
SELECT product_id, country_id, CAST(update_date AS TIMESTAMP) AS update_date,
       {_month('forecast_date')} AS forecast_date, {_month('forecast_snapshot')} AS forecast_snapshot,
       {', '.join(FQ)}, unit_price
FROM {src}"""


def forecast_sql(rows: str) -> str:
    sums = ", ".join([f"SUM({_q(c)}) AS q{i}" for i, c in enumerate(FQ)]
                     + [f"SUM({_amt(c, 'unit_price')}) AS a{i}" for i, c in enumerate(FQ)])
    outs = ", ".join([f"{_dbl(f'q{i}')} AS {c}" for i, c in enumerate(FQ)]
                     + [f"{_round2(f'a{i}')} AS {c}" for i, c in enumerate(FA)])
    return f"""
SELECT product_id, country_id, forecast_date, forecast_snapshot, forecast_update_date, {outs},
       {_wprice('a0', 'q0')} AS unit_price
FROM (
  SELECT product_id, country_id, forecast_date, forecast_snapshot, max(update_date) AS forecast_update_date, {sums}
  FROM (SELECT *, max(update_date) OVER (PARTITION BY product_id, country_id, forecast_date, forecast_snapshot) AS m
        FROM {rows}) w
  WHERE update_date = m
  GROUP BY product_id, country_id, forecast_date, forecast_snapshot) g"""


PQ = ["pos_sell_out_quantity", "pos_open_quantity", "pos_end_quantity"]
PA = ["pos_sell_out_amount", "pos_open_amount", "pos_end_amount"]
POS_COLS = ["product_id", "country_id", "transaction_date", *PQ, *PA, "unit_price", "pos_update_date"]
POS_KEYS = ["product_id", "country_id", "transaction_date"]
POS_UPDATE = [*PQ, *PA, "unit_price", "pos_update_date", "updated_by"]


def pos_rows_sql(src: str) -> str:
    return f"""
SELECT product_id, country_id, CAST(update_date AS TIMESTAMP) AS update_date,
       CAST(transaction_date AS DATE) AS transaction_date, {', '.join(PQ)}, unit_price
FROM {src}"""


def pos_sql(rows: str) -> str:
    sums = ", ".join([f"SUM({_q(c)}) AS q{i}" for i, c in enumerate(PQ)]
                     + [f"SUM({_amt(c, 'unit_price')}) AS a{i}" for i, c in enumerate(PQ)])
    outs = ", ".join([f"{_dbl(f'q{i}')} AS {c}" for i, c in enumerate(PQ)]
                     + [f"{_round2(f'a{i}')} AS {c}" for i, c in enumerate(PA)])
    return f"""
SELECT product_id, country_id, tmonth AS transaction_date, {outs}, {_wprice('a0', 'q0')} AS unit_price,
       pos_update_date
FROM (
  SELECT product_id, country_id, {_month('transaction_date')} AS tmonth, max(update_date) AS pos_update_date, {sums}
  FROM (SELECT *, max(update_date) OVER (PARTITION BY product_id, country_id, transaction_date) AS m
        FROM {rows}) w
  WHERE update_date = m
  GROUP BY product_id, country_id, {_month('transaction_date')}) g"""


WQ = ["whrs_sell_in_quantity", "whrs_open_quantity", "whrs_end_quantity"]
WA = ["whrs_sell_in_amount", "whrs_open_amount", "whrs_end_amount"]
WH_COLS = ["product_id", "country_id", "transaction_date", *WQ, *WA, "unit_price", "whrs_update_date"]
WH_KEYS = ["product_id", "country_id", "transaction_date"]
WH_UPDATE = [*WQ, *WA, "unit_price", "whrs_update_date", "updated_by"]


def wh_rows_sql(src: str, customers: str) -> str:
    return f"""
SELECT inv.product_id, c.country_id, CAST(inv.transaction_date AS DATE) AS transaction_date,
       CAST(inv.update_date AS TIMESTAMP) AS whrs_update_date, inv.unit_price, {', '.join('inv.' + c for c in WQ)}
FROM {src} inv JOIN {customers} c ON inv.customer_id = c.customer_id"""


def wh_sql(rows: str, per_key: bool = False) -> str:
    sums = ", ".join([f"SUM({_q(c)}) AS q{i}" for i, c in enumerate(WQ)]
                     + [f"SUM({_amt(c, 'unit_price')}) AS a{i}" for i, c in enumerate(WQ)])
    outs = ", ".join([f"{_dbl(f'q{i}')} AS {c}" for i, c in enumerate(WQ)]
                     + [f"{_round2(f'a{i}')} AS {c}" for i, c in enumerate(WA)])
    clock = "max(whrs_update_date) AS whrs_update_date" if per_key else "whrs_update_date"
    group = f"product_id, country_id, {_month('transaction_date')}" + ("" if per_key else ", whrs_update_date")
    return f"""
SELECT product_id, country_id, tmonth AS transaction_date, {outs}, {_wprice('a0', 'q0')} AS unit_price,
       CAST(whrs_update_date AS DATE) AS whrs_update_date
FROM (
  SELECT product_id, country_id, {_month('transaction_date')} AS tmonth, {clock}, {sums}
  FROM (SELECT *, max(whrs_update_date) OVER (PARTITION BY product_id, country_id, transaction_date) AS m
        FROM {rows}) w
  WHERE whrs_update_date = m
  GROUP BY {group}) g"""


# ------------------------------------------------------------------ merge / recompute

def _audit(first_load: bool) -> str:
    ins = f"'{RUN_USER}'" if first_load else "CAST(NULL AS VARCHAR)"
    return f"'{RUN_USER}' AS updated_by, {ins} AS inserted_by"


def merge_sql(target: str, source: str, cols: list[str], keys: list[str], update: list[str], collapse: bool = False) -> str:
    """``collapse``: target rows that share a matched key become one."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    picks = ", ".join(
        (f"CASE WHEN s.{keys[0]} IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" if c in update and c not in keys
         else f"t.{c} AS {c}") for c in cols)
    left = (f"SELECT DISTINCT {picks} FROM {target} t JOIN {source} s ON {on}\nUNION ALL\n"
            f"SELECT t.{', t.'.join(cols)} FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE {on})"
            if collapse else f"SELECT {picks} FROM {target} t LEFT JOIN {source} s ON {on}")
    return f"""
{left}
UNION ALL
SELECT {', '.join('s.' + c for c in cols)} FROM {source} s
WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {on})"""


def replace_sql(target: str, rebuilt: str, touched: str, cols: list[str], keys: list[str]) -> str:
    on = " AND ".join(f"t.{k} IS NOT DISTINCT FROM k.{k}" for k in keys)
    return f"""
SELECT {', '.join('t.' + c for c in cols)} FROM {target} t
WHERE NOT EXISTS (SELECT 1 FROM {touched} k WHERE {on})
UNION ALL
SELECT {', '.join(cols)} FROM {rebuilt}"""


def _affected(rows: str, touched: str, key_exprs: dict[str, str]) -> str:
    on = " AND ".join(f"{expr} IS NOT DISTINCT FROM k.{k}" for k, expr in key_exprs.items())
    return f"SELECT r.* FROM {rows} r WHERE EXISTS (SELECT 1 FROM {touched} k WHERE {on})"


# ------------------------------------------------------------------ queries

def _q_dim_customers_full() -> str:
    return _with(BRONZE + [("d", customer_rows_sql())], f"SELECT *, {_audit(True)} FROM d")


def _q_dim_customers_incremental() -> str:
    cols = CUSTOMER_COLS + ["updated_by", "inserted_by"]
    update = [c for c in CUSTOMER_COLS if c != "customer_id"] + ["updated_by"]
    ctes = BRONZE + [
        _cut("b_customers"), _cut("b_countries"),
        ("tgt", f"SELECT *, {_audit(True)} FROM ({customer_rows_sql('b_customers_cut', 'b_countries_cut')}) x"),
        ("rows_all", customer_rows_sql()),
        ("src", f"""SELECT *, {_audit(False)} FROM rows_all
WHERE customer_update_date > COALESCE((SELECT max(customer_update_date) FROM tgt), TIMESTAMP '1900-01-01 00:00:00')
   OR country_update_date > COALESCE((SELECT max(country_update_date) FROM tgt), TIMESTAMP '1900-01-01 00:00:00')"""),
        ("merged", merge_sql("tgt", "src", cols, ["customer_id"], update)),
    ]
    return _with(ctes, "SELECT * FROM merged")


def _q_dim_products_full() -> str:
    return _with(BRONZE + [("d", products_sql("b_products"))], f"SELECT *, {_audit(True)} FROM d")


def _q_dim_products_incremental() -> str:
    cols = PRODUCT_COLS + ["updated_by", "inserted_by"]
    update = [c for c in PRODUCT_COLS if c != "product_id"] + ["updated_by"]
    ctes = BRONZE + [
        _cut("b_products"),
        ("tgt", f"SELECT *, {_audit(True)} FROM ({products_sql('b_products_cut')}) x"),
        ("src", f"SELECT *, {_audit(False)} FROM ("
                + products_sql("b_products", "WHERE update_date > (SELECT max(update_date) FROM tgt)") + ") x"),
        ("merged", merge_sql("tgt", "src", cols, ["product_id"], update)),
    ]
    return _with(ctes, "SELECT * FROM merged")


def _fact_queries(name: str, rows_fn, model_fn, cols, keys, update, hwm_where, key_exprs,
                  combine_fn=None, cut_tables=()) -> dict[str, str]:
    """full / delta / recompute statements for one fact."""
    out = {}
    base = BRONZE + [("dim_cust", customer_rows_sql())]
    out[f"{name}_full"] = _with(base + [("rows_all", rows_fn(False)), ("m", model_fn("rows_all"))],
                                f"SELECT *, {_audit(True)} FROM m")
    inc = base + [_cut(t) for t in cut_tables] + [
        ("rows_cut", rows_fn(True)),
        ("tgt", f"SELECT *, {_audit(True)} FROM ({model_fn('rows_cut')}) x"),
        ("rows_all", rows_fn(False)),
        ("changed", f"SELECT * FROM rows_all WHERE {hwm_where}"),
    ]
    allc = cols + ["updated_by", "inserted_by"]
    src_model = combine_fn or model_fn
    out[f"{name}_delta"] = _with(inc + [
        ("src", f"SELECT *, {_audit(False)} FROM ({src_model('changed')}) x"),
        ("merged", merge_sql("tgt", "src", allc, keys, update, collapse=combine_fn is not None)),
    ], "SELECT * FROM merged")
    touched = ", ".join(f"{e.replace('{r}', '')} AS {k}" for k, e in key_exprs.items())
    out[f"{name}_recompute"] = _with(inc + [
        ("touched", f"SELECT DISTINCT {touched} FROM changed"),
        ("affected", _affected("rows_all", "touched", _prefixed(key_exprs))),
        ("rebuilt", f"SELECT *, {_audit(True)} FROM ({model_fn('affected')}) x"),
        ("merged", replace_sql("tgt", "rebuilt", "touched", allc, keys)),
    ], "SELECT * FROM merged")
    return out


def _prefixed(key_exprs: dict[str, str]) -> dict[str, str]:
    out = {}
    for k, e in key_exprs.items():
        out[k] = e.replace("{r}", "r.")
    return out


def _fact_sales() -> dict[str, str]:
    def rows(cut: bool) -> str:
        sfx = "_cut" if cut else ""
        return sales_lines_sql(f"b_orders{sfx}", f"b_order_details{sfx}", "dim_cust")
    mark = ("(SELECT COALESCE(max(CASE WHEN order_details_update_date IS NULL OR order_update_date IS NULL THEN NULL "
            "ELSE greatest(CAST(order_details_update_date AS TIMESTAMP), CAST(order_update_date AS TIMESTAMP)) END), "
            "TIMESTAMP '1900-01-01 00:00:00') FROM tgt)")
    hwm = f"(CASE WHEN odu IS NULL OR ou IS NULL THEN NULL ELSE greatest(odu, ou) END) > {mark}"
    return _fact_queries("fact_sales", rows, sales_sql, SALES_COLS, SALES_KEYS, SALES_UPDATE, hwm,
                         {"country_id": "{r}country_id", "product_id": "{r}product_id",
                          "shipped_date": "{r}shipped_date"},
                         combine_fn=lambda r: sales_sql(r, per_key=True), cut_tables=("b_orders", "b_order_details"))


def _fact_forecast() -> dict[str, str]:
    def rows(cut: bool) -> str:
        return forecast_rows_sql("b_forecast_cut" if cut else "b_forecast")
    hwm = "update_date > (SELECT COALESCE(max(forecast_update_date), TIMESTAMP '1900-01-01 00:00:00') FROM tgt)"
    return _fact_queries("fact_forecast", rows, forecast_sql, FORECAST_COLS, FORECAST_KEYS, FORECAST_UPDATE, hwm,
                         {k: "{r}" + k for k in FORECAST_KEYS}, cut_tables=("b_forecast",))


def _fact_pos() -> dict[str, str]:
    def rows(cut: bool) -> str:
        return pos_rows_sql("b_pos_cut" if cut else "b_pos")
    hwm = "update_date > (SELECT COALESCE(max(pos_update_date), TIMESTAMP '1900-01-01 00:00:00') FROM tgt)"
    return _fact_queries("fact_pos", rows, pos_sql, POS_COLS, POS_KEYS, POS_UPDATE, hwm,
                         {"product_id": "{r}product_id", "country_id": "{r}country_id",
                          "transaction_date": _month("{r}transaction_date")}, cut_tables=("b_pos",))


def _fact_wholesale() -> dict[str, str]:
    def rows(cut: bool) -> str:
        return wh_rows_sql("b_wholesale_cut" if cut else "b_wholesale", "dim_cust")
    hwm = ("whrs_update_date > (SELECT COALESCE(max(CAST(whrs_update_date AS TIMESTAMP)), "
           "TIMESTAMP '1900-01-01 00:00:00') FROM tgt)")
    return _fact_queries("fact_wholesale", rows, wh_sql, WH_COLS, WH_KEYS, WH_UPDATE, hwm,
                         {"product_id": "{r}product_id", "country_id": "{r}country_id",
                          "transaction_date": _month("{r}transaction_date")},
                         combine_fn=lambda r: wh_sql(r, per_key=True), cut_tables=("b_wholesale",))


# ------------------------------------------------------------------ gold

SILVER_FULL = [
    ("dim_cust", customer_rows_sql()),
    ("s_sales", sales_sql("(" + sales_lines_sql("b_orders", "b_order_details", "dim_cust") + ")")),
    ("s_forecast", forecast_sql("(" + forecast_rows_sql("b_forecast") + ")")),
    ("s_pos", pos_sql("(" + pos_rows_sql("b_pos") + ")")),
    ("s_wh", wh_sql("(" + wh_rows_sql("b_wholesale", "dim_cust") + ")")),
]

MEASURES = FQ + FA


def _aligned(src: str, date_col: str, snap: str, present: list[str], where: str) -> str:
    cols = ", ".join((f"{m}" if m in present else f"CAST(0.0 AS DOUBLE) AS {m}") for m in MEASURES)
    return (f"SELECT product_id, country_id, {date_col} AS financial_date, {snap} AS forecast_snapshot, {cols} "
            f"FROM {src}, snapshots s WHERE {where}")


def _aligned_union() -> list[tuple[str, str]]:
    pos_present = PQ + PA
    wh_present = WQ + WA
    parts = []
    for v in ("current_snapshot", "last_snapshot"):
        parts.append(_aligned("s_forecast f", "forecast_date", "forecast_snapshot", MEASURES,
                              f"f.forecast_snapshot = s.{v} AND f.forecast_date >= s.{v}"))
        parts.append(_aligned("s_sales x", "shipped_date", f"s.{v}", ["quantity", "amount"],
                              f"x.shipped_date < s.{v}"))
        parts.append(_aligned("s_pos x", "transaction_date", f"s.{v}", pos_present, f"x.transaction_date < s.{v}"))
        parts.append(_aligned("s_wh x", "transaction_date", f"s.{v}", wh_present, f"x.transaction_date < s.{v}"))
    return [
        ("snapshots", "SELECT max(forecast_snapshot) AS current_snapshot, "
                      "CAST(max(forecast_snapshot) - INTERVAL 1 MONTH AS DATE) AS last_snapshot FROM s_forecast"),
        ("unioned", "\nUNION ALL\n".join(parts)),
    ]


BOOK_COLS = ["Ex_Factory", "Sales_to_pharmacies", "Open_Stock", "Close_Stock",
             "Consumer_Off_Take", "Open_Stock_Pharmacies", "Close_Stock_Pharmacies"]


def _q_planning_book() -> str:
    sums = ", ".join(f"CAST(SUM({_q(m)}) AS DOUBLE) AS {m}" for m in MEASURES)
    version = ("CASE WHEN forecast_snapshot = (SELECT current_snapshot FROM snapshots) "
               "THEN 'Current' ELSE 'Last' END AS Version")

    def part(measure: str, src_cols: list[str]) -> str:
        cols = ", ".join(f"{c} AS {b}" for c, b in zip(src_cols, BOOK_COLS))
        return (f"SELECT product_id AS IdProduct, country_id AS IDCountry, financial_date AS Date, forecast_snapshot, "
                f"'{measure}' AS Measure, {version}, {cols} FROM aggregated")
    ctes = BRONZE + SILVER_FULL + _aligned_union() + [
        ("aggregated", f"SELECT product_id, country_id, financial_date, forecast_snapshot, {sums} "
                       f"FROM unioned GROUP BY product_id, country_id, financial_date, forecast_snapshot"),
    ]
    return _with(ctes, part("EA", FQ) + "\nUNION ALL\n" + part("GTS", FA))


def _q_planning_aligned_union() -> str:
    return _with(BRONZE + SILVER_FULL + _aligned_union(), "SELECT * FROM unioned")


def _q_planning_versions() -> str:
    return _with(BRONZE + SILVER_FULL + _aligned_union()[:1],
                 "SELECT 'Current' AS Version, current_snapshot AS forecast_snapshot FROM snapshots "
                 "UNION ALL SELECT 'Last', last_snapshot FROM snapshots")


def _q_gold_products() -> str:
    return _with(BRONZE + [("d", products_sql("b_products"))],
                 "SELECT product_id AS IdProduct, product_name AS Name, brand_name AS Brand, "
                 "sub_brand_name AS SubBrand, category_name AS Category FROM d")


def _q_gold_regions() -> str:
    return _with(BRONZE + [("d", customer_rows_sql())],
                 "SELECT DISTINCT country_id AS IDCountry, cluster AS Cluster, region_description AS Region, "
                 "country AS Country FROM d")


# ------------------------------------------------------------------ operators

def _q_merge_upsert() -> str:
    """Plain keyed merge of the customers delivered since April 2000 into the dimension built before the cut."""
    cols = CUSTOMER_COLS + ["updated_by", "inserted_by"]
    update = ["company_name", "address", "city", "customer_update_date", "last_update", "updated_by"]
    ctes = BRONZE + [
        _cut("b_customers"),
        ("tgt", f"SELECT *, {_audit(True)} FROM ({customer_rows_sql('b_customers_cut', 'b_countries')}) x"),
        ("src", f"SELECT *, {_audit(False)} FROM ({customer_rows_sql()}) x "
                f"WHERE customer_update_date >= {_ts('2000-04-01')}"),
        ("merged", merge_sql("tgt", "src", cols, ["customer_id"], update)),
    ]
    return _with(ctes, "SELECT * FROM merged")


def _q_audit_stamps() -> str:
    """Who is stamped follows from the delivery's date alone: before April, up to the cut, from the cut on."""
    first, second = "TIMESTAMP '2001-01-01 02:03:04'", "TIMESTAMP '2001-02-01 02:03:04'"
    old, new = f"update_date < {_ts(CUTS['b_customers'])}", f"update_date >= {_ts('2000-04-01')}"
    return _with(BRONZE, f"""
SELECT customer_id, CASE WHEN {new} THEN {second} ELSE {first} END AS update_ts, CASE WHEN {old} THEN {first} END AS insert_ts,
       CASE WHEN {new} THEN 'second' ELSE 'first' END AS updated_by, CASE WHEN {old} THEN 'first' END AS inserted_by
FROM b_customers""")


def _q_high_water_mark() -> str:
    """Order lines newer than the newest clock that the target built before the cut holds.

    The target keeps a line version's two clocks at day grain only where both
    are the line's newest; the mark is the latest of the greater of the two.
    """
    ctes = [*BRONZE, _cut("b_customers"), _cut("b_countries"), _cut("b_orders"), _cut("b_order_details"),
            ("customers", customer_rows_sql()),
            ("old", sales_lines_sql("b_orders_cut", "b_order_details_cut", "customers")),
            ("newest", "SELECT *, max(odu) OVER w AS m_odu, max(ou) OVER w AS m_ou FROM old "
                       "WINDOW w AS (PARTITION BY order_id, product_id, country_id, shipped_date)"),
            ("mark", "SELECT coalesce(max(greatest(CAST(CAST(odu AS DATE) AS TIMESTAMP), CAST(CAST(ou AS DATE) AS TIMESTAMP))), "
                     "TIMESTAMP '1900-01-01 00:00:00') AS m FROM newest WHERE odu = m_odu AND ou = m_ou"),
            ("lines", sales_lines_sql("b_orders", "b_order_details", "customers"))]
    return _with(ctes, "SELECT order_id, country_id, product_id, shipped_date, odu AS order_details_update_date, "
                       "ou AS order_update_date FROM lines, mark "
                       "WHERE odu IS NOT NULL AND ou IS NOT NULL AND greatest(odu, ou) > m")


def _q_weighted_price(quantity: str = "quantity", price: str = "unit_price") -> str:
    return _with(BRONZE, f"""
SELECT product_id, {_month('update_date')} AS month, {_dbl('SUM(' + _q(quantity) + ')')} AS quantity,
       {_round2('SUM(' + _amt(quantity, price) + ')')} AS amount,
       {_wprice('SUM(' + _amt(quantity, price) + ')', 'SUM(' + _q(quantity) + ')')} AS unit_price
FROM b_order_details GROUP BY product_id, {_month('update_date')}""")


def _q_newest_version_ties() -> str:
    sums = ", ".join([f"{_dbl('SUM(' + _q(c) + ')')} AS {c}" for c in PQ])
    return _with(BRONZE + [("r", pos_rows_sql("b_pos"))], f"""
SELECT product_id, country_id, transaction_date, max(update_date) AS update_date, count(*) AS n_rows, {sums}
FROM (SELECT *, max(update_date) OVER (PARTITION BY product_id, country_id, transaction_date) AS m FROM r) w
WHERE update_date = m GROUP BY product_id, country_id, transaction_date""")


def _q_greatest_nullable() -> str:
    return _with(BRONZE, """
SELECT o.order_id, od.product_id, o.shipped_date,
       CASE WHEN o.shipped_date IS NULL OR od.update_date IS NULL THEN NULL
            ELSE greatest(CAST(o.shipped_date AS TIMESTAMP), od.update_date) END AS last_touch
FROM b_orders o JOIN b_order_details od ON o.order_id = od.order_id""")


def _q_check_not_null() -> str:
    return _with(BRONZE + SILVER_FULL, f"SELECT *, {_audit(True)} FROM s_sales WHERE shipped_date IS NULL")


def _q_check_unique() -> str:
    return _with(BRONZE, "SELECT product_id, count(*) AS n_records FROM b_products WHERE product_id IS NOT NULL "
                         "GROUP BY product_id HAVING count(*) > 1")


def _q_check_duplicates() -> str:
    return _with(BRONZE + SILVER_FULL, "SELECT country_id, product_id, shipped_date, count(*) AS cnt FROM s_sales "
                                       "GROUP BY country_id, product_id, shipped_date HAVING count(*) > 1")


_TWICE = "SELECT * FROM b_customers UNION ALL SELECT * FROM b_customers WHERE customer_id % 40 = 0"


def _q_check_row_rule() -> str:
    gaps = ("SELECT country_id, region_description, country, CASE WHEN country_id % 9 <> 4 THEN cluster END AS cluster, "
            "update_date FROM b_countries")
    return _with(BRONZE + [("gaps", gaps), ("d", customer_rows_sql(countries="gaps"))],
                 f"SELECT *, {_audit(True)} FROM d WHERE country_id IS NOT NULL "
                 "AND (country IS NULL OR region_description IS NULL OR cluster IS NULL)")


def _q_orphan_keys() -> str:
    return _with(BRONZE + [("kept", "SELECT * FROM b_products WHERE product_id % 50 <> 7"), ("d", products_sql("kept"))],
                 "SELECT od.* FROM b_order_details od WHERE NOT EXISTS "
                 "(SELECT 1 FROM d WHERE d.product_id = od.product_id)")


def _q_orphan_names() -> str:
    return _with(BRONZE + [("d", products_sql("b_products"))], """
SELECT product_id, CASE product_id % 3 WHEN 0 THEN '  ' || upper(product_name) WHEN 1 THEN lower(product_name) || ' '
                   ELSE product_name END AS product_name
FROM d WHERE lower(trim(product_name)) NOT IN (SELECT lower(trim(product_name)) FROM b_products WHERE length(product_name) % 4 <> 1)""")


def _q_check_duplicate_customers() -> str:
    return _with(BRONZE + [("twice", _TWICE), ("d", customer_rows_sql("twice"))],
                 "SELECT customer_id, count(*) AS cnt FROM d GROUP BY customer_id HAVING count(*) > 1")


def _q_customer_column_tests() -> str:
    parts = [f"SELECT 'not_null' AS test, '{c}' AS column, CAST(customer_id AS VARCHAR) AS key FROM d WHERE {c} IS NULL"
             for c in ["customer_id", "country_id", "company_name", "last_update"]]
    parts.append("SELECT 'unique' AS test, 'customer_id' AS column, CAST(customer_id AS VARCHAR) AS key FROM d "
                 "WHERE customer_id IN (SELECT customer_id FROM d WHERE customer_id IS NOT NULL "
                 "GROUP BY customer_id HAVING count(*) > 1)")
    # update_ts is always stamped by the run, so its not_null test cannot fail
    gaps = f"SELECT * REPLACE (CASE WHEN customer_id % 25 <> 3 THEN company_name END AS company_name) FROM ({_TWICE}) t"
    return _with(BRONZE + [("gaps", gaps), ("d", customer_rows_sql("gaps"))], "\nUNION ALL\n".join(parts))


def all_sql() -> dict[str, str]:
    out = {
        "dim_customers_full": _q_dim_customers_full(),
        "dim_customers_incremental": _q_dim_customers_incremental(),
        "dim_products_full": _q_dim_products_full(),
        "dim_products_incremental": _q_dim_products_incremental(),
    }
    for f in (_fact_sales, _fact_forecast, _fact_pos, _fact_wholesale):
        out.update(f())
    # a fact kept by its state equals a full refresh
    out |= {f"fact_{f}_state": out[f"fact_{f}_full"] for f in ("sales", "forecast", "pos", "wholesale")}
    out.update({
        "gold_products": _q_gold_products(),
        "gold_regions": _q_gold_regions(),
        "planning_versions": _q_planning_versions(),
        "planning_aligned_union": _q_planning_aligned_union(),
        "planning_book": _q_planning_book(),
        "merge_upsert": _q_merge_upsert(),
        "audit_stamps": _q_audit_stamps(),
        "high_water_mark": _q_high_water_mark(),
        "weighted_price": _q_weighted_price(),
        "weighted_price_fine": _q_weighted_price("(quantity * 1000)", "(unit_price / 16384)"),
        "newest_version_ties": _q_newest_version_ties(),
        "greatest_nullable": _q_greatest_nullable(),
        "check_not_null": _q_check_not_null(),
        "check_unique": _q_check_unique(),
        "check_duplicates": _q_check_duplicates(),
        "check_duplicate_customers": _q_check_duplicate_customers(),
        "check_row_rule": _q_check_row_rule(),
        "orphan_keys": _q_orphan_keys(),
        "orphan_names": _q_orphan_names(),
        "customer_column_tests": _q_customer_column_tests(),
    })
    return out
