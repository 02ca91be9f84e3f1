"""Audit columns stamped on every silver table."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDIT_COLUMNS = ["update_ts", "updated_by", "insert_ts", "inserted_by"]


@dataclass(frozen=True)
class RunInfo:
    """Who and when of one run; pin both to make a run repeatable.

    ``ts=None`` means the query's ``current_timestamp()``, ``user=None`` the
    session's ``current_user()``.
    """

    ts: _dt.datetime | None = None
    user: str | None = None

    def ts_col(self) -> Column:
        if self.ts is None:
            return F.current_timestamp()
        return F.lit(self.ts).cast("timestamp")

    def user_col(self) -> Column:
        if self.user is None:
            return F.current_user()
        return F.lit(self.user)


def with_audit(df: DataFrame, run: RunInfo, first_load: bool) -> DataFrame:
    """``update_ts/updated_by`` always; ``insert_ts/inserted_by`` only on a first load.

    An incremental run leaves the insert pair NULL, also for the rows it
    inserts (they keep NULL once merged).
    """
    ts, user = run.ts_col(), run.user_col()
    if first_load:
        ins_ts, ins_by = ts, user
    else:
        ins_ts, ins_by = F.lit(None).cast("timestamp"), F.lit(None).cast("string")
    return df.select(
        "*",
        ts.alias("update_ts"),
        user.alias("updated_by"),
        ins_ts.alias("insert_ts"),
        ins_by.alias("inserted_by"),
    )
