"""Import every query module so that ``catalog.QUERIES`` / ``catalog.ORACLES`` are complete."""

from riskspark.plans import catalog
from riskspark.plans import q_model, q_policy, q_prep, q_score, q_woe, q_workflow  # noqa: F401

QUERIES = catalog.QUERIES
ORACLES = catalog.ORACLES
