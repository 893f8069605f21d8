"""All registered queries. Importing the modules fills the registry."""

from meterloom.plans import (
    check_queries,
    corpus_queries,
    cost_queries,
    evaluation_queries,
    log_queries,
    serving_queries,
    stream_queries,
)
from meterloom.plans import roundtrip_queries  # isort: skip  (builds on the others)
from meterloom.plans.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "check_queries",
    "corpus_queries",
    "cost_queries",
    "evaluation_queries",
    "log_queries",
    "roundtrip_queries",
    "serving_queries",
    "stream_queries",
]
