"""Registered queries: name -> (Spark function, SQL twin or None). Names start with the inventory id."""

from workload import dashboards, evaluation, pages, plans, records, retrieval, runs, seed, selection, signals, sources
from workload.common import REGISTRY

__all__ = [
    "REGISTRY", "dashboards", "evaluation", "pages", "plans", "records", "retrieval", "runs", "seed",
    "selection", "signals", "sources",
]
