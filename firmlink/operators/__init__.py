"""Relational operators built from DataFrame primitives."""

from firmlink.operators.dedup import insert_if_absent, keep_first, pick_best
from firmlink.operators.match import (
    candidate_pairs,
    crawl_by_name,
    exact_name_pairs,
    name_table,
    prepare_crawl,
    prepare_registry,
    registry_by_name,
    score_pairs,
)
from firmlink.operators.confirm import answer_is_yes, apply_verdicts, typed_fuzzy_pairs
from firmlink.operators.metrics import band_counts, match_metrics, stage_metrics
from firmlink.operators.materialize import materialize
from firmlink.operators.project import project_once

__all__ = [
    "insert_if_absent", "keep_first", "pick_best",
    "candidate_pairs", "crawl_by_name", "exact_name_pairs", "name_table", "prepare_crawl",
    "prepare_registry", "registry_by_name", "score_pairs",
    "answer_is_yes", "apply_verdicts", "typed_fuzzy_pairs",
    "band_counts", "match_metrics", "stage_metrics",
    "materialize", "project_once",
]
