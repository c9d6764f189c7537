"""All named queries; importing the modules registers them."""

from tallygrain.plans import q_columns, q_modeling, q_orders, q_quality, q_recommend, q_relational, q_sources, q_text, q_timeseries  # noqa: F401
from tallygrain.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
