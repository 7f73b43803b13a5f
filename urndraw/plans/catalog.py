"""All named queries: importing the families registers them."""

from urndraw.plans import q_facts, q_descriptive, q_quality, q_rank, q_parse, q_state, q_release  # noqa: F401, I001
from urndraw.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
