"""Bronze inputs: schemas, readers, and driver tables shaped as bronze."""

from stockbook.sources.schemas import BRONZE_SCHEMAS, BRONZE_TABLES
from stockbook.sources.bronze import Bronze, read_bronze, bronze_from_frames

__all__ = ["BRONZE_SCHEMAS", "BRONZE_TABLES", "Bronze", "bronze_from_frames", "read_bronze"]
