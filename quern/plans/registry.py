"""The queries of the corpus operators, with their SQL."""

from __future__ import annotations

from quern.plans import queries
from quern.plans.oracles import ORACLES

QUERIES = {f.__name__: f for f in queries.ALL}

__all__ = ["ORACLES", "QUERIES"]
