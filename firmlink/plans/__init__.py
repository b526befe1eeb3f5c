"""Composite jobs: register staging, crawl staging, unification, end to end."""

from firmlink.plans.stage_registry import RegistryLoad, split_registry, stage_registry
from firmlink.plans.stage_crawl import crawl_rows, stage_crawl
from firmlink.plans.unify import MatchStages, match_stages, unify
from firmlink.plans.run_all import run_all

__all__ = [
    "RegistryLoad", "split_registry", "stage_registry",
    "crawl_rows", "stage_crawl",
    "MatchStages", "match_stages", "unify",
    "run_all",
]
