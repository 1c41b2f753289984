"""Every query of the library with its DuckDB SQL."""

from __future__ import annotations

from leafwork.plans import audit  # noqa: F401  (registers its queries)
from leafwork.plans.queries import ORACLES, QUERIES

FLAGSHIP = QUERIES["isolated_reversal"]
