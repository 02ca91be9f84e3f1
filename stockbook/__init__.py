"""Supply-chain planning analytics on Spark DataFrames.

Layers:
  sources    bronze schemas and readers (plus driver tables shaped as bronze)
  functions  column expressions (month floor, strict greatest, exact money)
  operators  reusable relational building blocks (newest version, merge,
             high-water marks, data checks)
  plans      the silver and gold models built from those blocks
  streaming  micro-batch wiring of the incremental models
"""

from stockbook.session import get_session

__all__ = ["get_session"]
