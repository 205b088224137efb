"""All queries of the engine by name, and their SQL."""

from quire.plans import evidence_queries, retrieval_queries, text_queries  # noqa: F401
from quire.plans.base import ORACLES, QUERIES  # noqa: F401
