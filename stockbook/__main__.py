"""``python -m stockbook --bronze ... --lake ...``: load silver, rebuild gold, run the data tests."""

from stockbook.plans.refresh import main

raise SystemExit(main())
