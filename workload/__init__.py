"""The registered queries: each operator run over the shared tables, with its SQL counterpart."""

from workload.registry import ORACLES, QUERIES
from workload import q_labels, q_metrics, q_models, q_sources, q_text, q_vectors  # noqa: F401  (fill the registry)

__all__ = ["ORACLES", "QUERIES"]
