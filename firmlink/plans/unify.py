"""Unification: one row per (abn, domain) from exact and fuzzy name matches.

Plan (all lazy, one Spark job per action):

    registry rows --norm--> one row per (norm, abn)    --+
    crawl rows    --norm--> one row per (norm, domain) --+
    distinct names --> exact name pairs (EXACT)          |
                   --> candidates (tiles of a block's names, bounds by whole arrays)
                   --> Arrow ratio --> bands --> verdicts (FUZZY_HIGH / FUZZY_LLM)
    name pairs JOIN registry rows ON r_norm JOIN crawl rows ON c_norm
    --> best row per (abn, domain): precedence, score, then the row values

The best-row pick is an arg-min aggregate (partial aggregation before the
shuffle), so a hot (abn, domain) group never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlink.config import MatchConfig
from firmlink.functions.text import MATCH_FUZZY_LLM, precedence
from firmlink.operators.confirm import typed_fuzzy_pairs
from firmlink.operators.dedup import pick_best
from firmlink.operators.materialize import materialize
from firmlink.operators.match import (
    REGISTRY_ATTRS,
    candidate_pairs,
    crawl_by_name,
    exact_name_pairs,
    prepare_crawl,
    prepare_registry,
    registry_by_name,
    score_pairs,
)
from firmlink.schemas import UNIFIED_FIELDS


class MatchStages:
    """Intermediate DataFrames of the matching plan.

    The per-name tables are materialised once (a table under the cluster's
    checkpoint folder, else persisted): they feed the name sets, the
    candidate generation and the final join-back, and would otherwise each
    re-read and re-normalise the source tables. The keyed names of the
    candidate generation and the scored pairs are materialised on first use
    for the same reason.
    """

    def __init__(self, registry: DataFrame, crawl: DataFrame, cfg: MatchConfig, materialize_stages: bool = True):
        self.cfg = cfg
        self._materialize = materialize_stages
        self._mat = materialize if materialize_stages else (lambda d: d)
        self.reg_rows = prepare_registry(registry)       # (abn, attrs..., norm) per registry row
        self.crawl_rows = prepare_crawl(crawl)            # (domain, extracted_industry, norm)
        self.reg_best = self._mat(registry_by_name(self.reg_rows))      # one per (norm, abn)
        self.crawl_best = self._mat(crawl_by_name(self.crawl_rows))     # one per (norm, domain)
        self.reg_names = self.reg_best.select("norm").distinct()
        self.crawl_names = self.crawl_best.select("norm").distinct()
        self.exact_pairs = exact_name_pairs(self.reg_names, self.crawl_names)
        self._candidates = None
        self._scored = None

    def _pairs(self, subsequence: bool) -> DataFrame:
        hold = self._mat if self._materialize else None
        return candidate_pairs(self.reg_names, self.crawl_names, self.cfg, hold=hold, subsequence=subsequence)

    @property
    def candidates(self) -> DataFrame:
        """``(r_norm, c_norm, bk, r_len, c_len, overlap)``; the keyed names
        are materialised on first use."""
        if self._candidates is None:
            self._candidates = self._pairs(False)
        return self._candidates

    @property
    def scored(self) -> DataFrame:
        """``(r_norm, c_norm, fuzzy_score)`` with score ``>= lo``, from the
        candidates that pass the subsequence bound too."""
        if self._scored is None:
            self._scored = self._mat(score_pairs(self._pairs(True), self.cfg))
        return self._scored


def match_stages(registry: DataFrame, crawl: DataFrame, cfg: MatchConfig = MatchConfig(),
                 materialize_stages: bool = True) -> MatchStages:
    return MatchStages(registry, crawl, cfg, materialize_stages)


def expand_pairs(pairs: DataFrame, st: MatchStages) -> DataFrame:
    """Name pairs -> row pairs with the unified columns, score and type.
    Confirmed pairs need a registry key (they are joined back by ``abn``)."""
    reg = st.reg_best.withColumnRenamed("norm", "r_norm")
    crawl = st.crawl_best.withColumnRenamed("norm", "c_norm")
    rows = pairs.join(reg, "r_norm", "inner").join(crawl, "c_norm", "inner")
    rows = rows.filter(~((F.col("match_type") == MATCH_FUZZY_LLM) & F.col("abn").isNull()))
    return rows.select(*UNIFIED_FIELDS, "fuzzy_score")


def best_per_company_domain(rows: DataFrame) -> DataFrame:
    """Highest precedence, then highest score, then the smallest row values."""
    order = [-precedence("match_type"), -F.col("fuzzy_score")] + [
        F.col(c) for c in (*REGISTRY_ATTRS, "extracted_industry")
    ]
    return pick_best(rows, ["abn", "domain"], order).select(*UNIFIED_FIELDS)


def unify(
    registry: DataFrame,
    crawl: DataFrame,
    cfg: MatchConfig = MatchConfig(),
    verdicts: DataFrame | None = None,
    confirmer: Callable[[pd.DataFrame], pd.Series] | None = None,
    with_timestamp: bool = True,
    stages: MatchStages | None = None,
) -> DataFrame:
    """Unified company rows: ``abn, entity_name, entity_type, address,
    postcode, state, domain, extracted_industry, match_type`` (+
    ``processed_at``).

    ``registry`` needs ``abn, entity_name, entity_type, address, postcode,
    state``; ``crawl`` needs ``domain, extracted_name, extracted_industry``.
    Borderline pairs are confirmed by the ``verdicts`` table
    ``(reg_norm, crawl_norm, answer)`` or the ``confirmer`` function; with
    neither, only exact and high-confidence matches are kept.
    """
    st = stages if stages is not None else match_stages(registry, crawl, cfg)
    fuzzy = typed_fuzzy_pairs(st.scored, cfg, verdicts, confirmer)
    pairs = st.exact_pairs.unionByName(fuzzy)
    out = best_per_company_domain(expand_pairs(pairs, st))
    if with_timestamp:
        out = out.withColumn("processed_at", F.current_timestamp())
    return out


def exact_matches(registry: DataFrame, crawl: DataFrame, cfg: MatchConfig = MatchConfig()) -> DataFrame:
    """Only the exact-name path, one row per (abn, domain)."""
    st = match_stages(registry, crawl, cfg)
    return best_per_company_domain(expand_pairs(st.exact_pairs, st))
