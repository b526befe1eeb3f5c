"""Yes/no confirmation of borderline name pairs.

The question depends only on the two normalised names, so it is asked once per
distinct name pair, on executors. Two ways to answer:

* a verdict table ``(reg_norm, crawl_norm, answer)``, joined on the names;
* a vectorised function ``pandas.DataFrame(reg_norm, crawl_norm) -> Series of
  answers`` applied with ``mapInPandas`` (no network client in the engine;
  the caller supplies it). All pairs are asked, spread over the session's
  shuffle partitions by the pair's hash. A caller may set ``limit``: then the
  best-scoring pairs are asked (deterministic top-k) and a warning gives the
  number of pairs that were not.

An answer confirms when, stripped and lower-cased, it starts with ``yes``;
anything else (including no answer) does not. With neither a table nor a
function, no borderline pair is confirmed.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlink.config import MatchConfig
from firmlink.functions.text import MATCH_FUZZY_HIGH, MATCH_FUZZY_LLM, py_strip
from firmlink.operators.materialize import materialize


def answer_is_yes(answer: Column | str) -> Column:
    a = F.col(answer) if isinstance(answer, str) else answer
    return F.coalesce(F.lower(py_strip(a)).startswith("yes"), F.lit(False))


def _table_verdicts(verdicts: DataFrame) -> DataFrame:
    """One verdict per name pair: confirmed when any answer says yes."""
    return verdicts.groupBy(
        F.col("reg_norm").alias("r_norm"), F.col("crawl_norm").alias("c_norm")
    ).agg(F.max(answer_is_yes("answer")).alias("confirmed"))


def _function_verdicts(
    borderline: DataFrame, confirmer: Callable[[pd.DataFrame], pd.Series], limit: int | None
) -> DataFrame:
    asked = borderline.select("r_norm", "c_norm", "fuzzy_score")
    if limit is not None:
        left_out = asked.count() - limit
        if left_out > 0:
            warnings.warn(f"{left_out} borderline pairs are not asked (confirm_limit={limit})", stacklevel=4)
        asked = asked.orderBy(F.desc("fuzzy_score"), "r_norm", "c_norm").limit(limit)
    # an explicit partition count: adaptive coalescing would put few pairs,
    # however costly to ask, into one task
    parts = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = asked.repartition(parts, "r_norm", "c_norm")

    def run(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            answers = confirmer(
                pdf[["r_norm", "c_norm"]].rename(columns={"r_norm": "reg_norm", "c_norm": "crawl_norm"})
            )
            yield pd.DataFrame(
                {"r_norm": pdf["r_norm"], "c_norm": pdf["c_norm"], "answer": pd.Series(answers, dtype="object").values}
            )

    answered = asked.mapInPandas(run, "r_norm string, c_norm string, answer string")
    # written once: re-running a plan that reads the answers must not ask again
    answered = materialize(answered, "verdicts")
    return answered.select("r_norm", "c_norm", answer_is_yes("answer").alias("confirmed"))


def apply_verdicts(
    scored: DataFrame,
    cfg: MatchConfig,
    verdicts: DataFrame | None = None,
    confirmer: Callable[[pd.DataFrame], pd.Series] | None = None,
) -> DataFrame:
    """Add ``confirmed`` (boolean) to scored pairs; always false outside the
    borderline band."""
    border = (F.col("fuzzy_score") >= F.lit(cfg.lo)) & (F.col("fuzzy_score") < F.lit(cfg.hi))
    if verdicts is not None:
        v = _table_verdicts(verdicts)
    elif confirmer is not None:
        v = _function_verdicts(scored.filter(border), confirmer, cfg.confirm_limit)
    else:
        return scored.withColumn("confirmed", F.lit(False))
    joined = scored.join(v, ["r_norm", "c_norm"], "left")
    return joined.withColumn("confirmed", border & F.coalesce(F.col("confirmed"), F.lit(False)))


def typed_fuzzy_pairs(
    scored: DataFrame,
    cfg: MatchConfig,
    verdicts: DataFrame | None = None,
    confirmer: Callable[[pd.DataFrame], pd.Series] | None = None,
) -> DataFrame:
    """Accepted fuzzy name pairs with their match type: FUZZY_HIGH at or
    above ``hi``, FUZZY_LLM for confirmed borderline pairs."""
    typed = apply_verdicts(scored, cfg, verdicts, confirmer).select(
        "r_norm",
        "c_norm",
        "fuzzy_score",
        F.when(F.col("fuzzy_score") >= F.lit(cfg.hi), F.lit(MATCH_FUZZY_HIGH))
        .when(F.col("confirmed"), F.lit(MATCH_FUZZY_LLM))
        .alias("match_type"),
    )
    return typed.filter(F.col("match_type").isNotNull())
