"""Column expressions shared by every model (all JVM-side, codegen-friendly)."""

from stockbook.functions.audit import RunInfo, with_audit, AUDIT_COLUMNS
from stockbook.functions.dates import month_floor, date_lit, ts_lit, day_sequence
from stockbook.functions.exact import (
    GRID,
    as_double,
    money,
    money_total,
    qty,
    qty_total,
    round_money,
    rounded_ratio,
    weighted_price,
)
from stockbook.functions.nulls import strict_greatest

__all__ = [
    "AUDIT_COLUMNS",
    "GRID",
    "RunInfo",
    "as_double",
    "date_lit",
    "day_sequence",
    "money",
    "money_total",
    "month_floor",
    "qty",
    "qty_total",
    "round_money",
    "rounded_ratio",
    "strict_greatest",
    "ts_lit",
    "weighted_price",
    "with_audit",
]
